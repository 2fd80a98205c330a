"""Best-fit-decreasing packing with certified bin counts.

Documents become token pieces of at most ``length`` tokens; pieces are packed into sequences.
Groups of pieces are packed independently by best-fit decreasing. Dual-feasible functions then
give a lower bound on the sequences that a group needs: a group that meets its bound is
*certified* and final, but for its emptiest sequence. A group with a gap keeps only its sequences
without waste. The pieces of the other sequences go to an exchange pool, are dealt into new groups
together with those of other groups, and packed again, until a round saves no sequence.

A group holds a bounded number of pieces, as numbers (no texts or ids), whatever the input's size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanwh.llm.shared import text_or_empty, written

#: Pieces that one group holds at first, and when it packs what is exchanged; rounds at most.
FIRST_GROUP, LATER_GROUP, ROUNDS = 20_000, 60_000, 6
#: The fast encoder takes texts of these characters only (Latin, general punctuation, currency,
#: line feed and space), for which the tests compare it with the library.
PLAIN = re.compile("[\n -~¡-ɏ‐-‧‰-⁞₠-₿]*")
#: Characters of white space, and of anything else, in a row that the fast encoder is slow at or, if there are
#: very many, gives up on. Runs of twice as many are always found.
LONG_SPACE, LONG_WORD = 250, 2000


def has_long_run(text: str) -> bool:
    """Whether a block of the text is all white space or has none; blocks are looked at one by one."""
    spaces = any(text[k : k + LONG_SPACE].isspace() for k in range(0, len(text) - LONG_SPACE + 1, LONG_SPACE))
    return spaces or any(text.find(" ", k, k + LONG_WORD) < 0 and text.find("\n", k, k + LONG_WORD) < 0 for k in range(0, len(text) - LONG_WORD + 1, LONG_WORD))


class Encoder:
    """Ids as ``tokenizers`` gives them for ``vocabulary``. ``ranks`` may name the same vocabulary
    as byte-pair ranks: texts of plain characters then take a faster route to the same ids. A text
    that spells a special token always goes to the library."""

    def __init__(self, vocabulary: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks and pattern:
            import base64

            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast and PLAIN.fullmatch(text) and not has_long_run(text) and not any(s in text for s in self.special):
            try:
                return np.asarray(self.fast.encode_ordinary(text), dtype="<u4")
            except BaseException as e:  # what the encoder's native code raises when it gives up is no Exception
                if type(e).__name__ != "PanicException":
                    raise
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")


def cut_into_pieces(docs: DataFrame, vocabulary: str, ranks: str | None, pattern: str | None, length: int, end_id: int,
                    id_col: str, text_col: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of each document's ids and ``end_id``. A longer
    document's first piece has what its whole pieces leave over."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(vocabulary, ranks, pattern), np.array([end_id], dtype="<u4")
        for batch in batches:
            at, number, starts, lengths, crcs = [], [], [], [], []
            for k, text in enumerate(batch.column("text")):  # one text at a time is a Python string
                ids = np.concatenate([encoder.ids(text.as_py()), end])
                cuts = [0, *range(len(ids) % length or length, len(ids), length), len(ids)]
                for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    at.append(k)
                    number.append(j)
                    starts.append(a)
                    lengths.append(b - a)
                    crcs.append(zlib.crc32(ids[a:b].tobytes()))
            numbers = [pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs))]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())), *numbers], names=["id", "piece", "start", "length", "ids_crc32"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that ``sizes`` need at least: the best of two families of dual-feasible functions.
    With f(x) such that f sums to at most 1 over any bin, the sum of f over all pieces is a bound."""
    if not len(sizes):
        return 0
    have = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((have * x).sum()) // capacity)
    # large pieces (over 1 - t) count as 1, small ones (under t) as 0
    count, total = np.cumsum(have), np.cumsum(have * x)
    for t in range(1, capacity // 2 + 1):
        large = int(count[-1] - count[capacity - t])
        middle = int(total[capacity - t] - total[t - 1])
        best = max(best, large + -(-middle // capacity))
    # pieces rounded down to multiples of 1/k, those that are multiples of 1/(k + 1) as they are
    for k in range(1, 33):
        scaled = (k + 1) * x
        f = np.where(scaled % capacity == 0, x * k, scaled // capacity * capacity)
        best = max(best, -(-int((have * f).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each piece and the space left in each bin. Each piece, largest first, goes to the
    fullest bin that has room; bins are kept by the space left, and a bit mask finds the next space."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    with_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, n, left = 0, 0, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        room = mask >> size
        if room:
            space = size + (room & -room).bit_length() - 1
            b = with_space[space].pop()
            if not with_space[space]:
                mask &= ~(1 << space)
        else:
            space, b, n = capacity, n, n + 1
            left.append(capacity)
        bins[i], offsets[i] = b, capacity - space
        left[b] = space - size
        if left[b]:
            with_space[left[b]].append(b)
            mask |= 1 << left[b]
    return bins, offsets, np.array(left, np.int64)


def packed_groups(pieces: DataFrame, groups: int, number: int, capacity: int) -> DataFrame:
    """``pieces`` dealt into ``groups`` and packed: sequence_id, offset, whether the sequence is
    final (its group is certified and it isn't the emptiest, or it has no waste) and whether this
    row starts it."""
    kind = pieces.schema["id"].dataType.simpleString()

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        sizes = group["length"].to_numpy()
        bins, offsets, left = best_fit_decreasing(sizes, capacity)
        final = (left == 0) | (len(left) == lower_bound(sizes, capacity))
        final[left.argmax()] = left.max() == 0
        first = number << 52 | int(group["grp"].iloc[0]) << 20
        return group.drop(columns="grp").assign(sequence_id=first + bins, offset=offsets, final=final[bins], starts=offsets == 0)

    # the rows come from a written table, so that a row's number is the same when a task runs again
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(number)), F.lit(groups)))
    return dealt.groupBy("grp").applyInPandas(pack, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                                    "sequence_id bigint, offset bigint, final boolean, starts boolean")


def pack_documents(docs: DataFrame, vocabulary: str, ranks: str | None = None, pattern: str | None = None, length: int = 1024,
                   end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Null texts are empty texts: one piece with the end id alone. Documents of at most ``length``
    tokens stay whole. Rows with the same id are different documents. No rows: an empty result.
    """
    pieces = written(cut_into_pieces(docs, vocabulary, ranks, pattern, length, end_id, id_col, text_col), "pieces")
    columns = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    whole = pieces.where(F.col("length") == length).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint"))
    done, pool = [whole.select(columns)], pieces.where(F.col("length") < length)
    size, before = pool.count(), None
    for number in range(ROUNDS):
        if not size:
            break
        room = FIRST_GROUP if not number else LATER_GROUP
        packed = written(packed_groups(pool, -(-size // room), number, length), "packed")
        now = packed.agg(F.count_if("starts").alias("all"), F.count_if(F.col("starts") & ~F.col("final")).alias("open"), F.count_if(~F.col("final")).alias("rows")).first()
        if before is not None and now["all"] >= before:
            break  # exchanging saved nothing: the last round's sequences stand
        if before is not None:
            done.pop()
        done += [packed.where("final").select(columns), packed.where("not final").select(columns)]
        pool, size, before = packed.where("not final").select(columns[:5]), now["rows"], now["open"]
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.withColumnRenamed("id", id_col)
