"""Token counts as a sentencepiece BPE model gives them, most of them by table lookup.

Merging never crosses certain places of a text, so it falls apart into *pre-tokens* that can be
counted one by one: no piece has a word mark after another character, so a run of spaces starts a
pre-token, and a character that is in no longer piece (line feed, tab) is one by itself. Both are
checked against the vocabulary before they are used.

Offline (once, on the driver) every vocabulary string is encoded alone; those that come back as
one token form the *whole-token table*, whose entries count 1 without any merging. Any other
pre-token is merged by the library itself and remembered, within a bound, by each Python worker.
A model without these properties, or a text with a literal word mark, goes to the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanwh.llm.shared import text_or_empty

MARK = "▁"
#: Candidates for characters that stand alone; each is checked against the vocabulary.
ALONE = "\n\t\r"
#: Merged pre-tokens that a Python worker remembers.
REMEMBERED = 200_000


def load(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def pretoken_pattern(processor) -> str | None:
    """The pattern of pre-tokens for this vocabulary, or None if texts cannot be cut safely."""
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())
              if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i))]
    joined = {c for p in pieces if len(p) > 1 for c in p}
    alone = "".join(c for c in ALONE if c not in joined)
    same = processor.normalize("  x  y \n\tz ") == (MARK * 3 + "x  y \n\tz ").replace(" ", MARK)
    if not same or "\n" not in alone or any(MARK in p.lstrip(MARK) for p in pieces):
        return None
    return f"[{alone}]| *[^ {alone}]+| +"


def merged(processor, pretoken: str) -> int:
    """Tokens of one pre-token inside a text: a leading space is the mark that the library puts
    before a text; behind a line feed it puts none."""
    if pretoken[0] != " ":
        return len(processor.encode("\n" + pretoken)) - 2
    if pretoken.isspace() and not pretoken.strip(" "):
        return len(processor.encode(pretoken[1:] + "\n")) - 1
    return len(processor.encode(pretoken[1:]))


def whole_tokens(processor) -> dict[str, int]:
    """Vocabulary strings that are one token as a pre-token, each proved by encoding it alone."""
    found = {}
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i).replace(MARK, " ")
        if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i)) and merged(processor, piece) == 1:
            found[piece] = 1
    return found


class Counter(dict):
    """Pre-token -> tokens; what is missing is merged by the library."""

    def __init__(self, processor, table: dict[str, int]):
        super().__init__(table)
        self.processor, self.table = processor, table

    def __missing__(self, pretoken: str) -> int:
        self[pretoken] = n = merged(self.processor, pretoken)
        return n

    def shrink(self) -> None:
        if len(self) > len(self.table) + REMEMBERED:
            self.clear()
            self.update(self.table)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    ``model`` is the model file's path on every machine. Null texts are empty texts: no bytes, no
    tokens. Rows are counted where they are read; nothing is shuffled, and a text is held alone.
    """
    spark = docs.sparkSession
    processor = load(model)
    pattern = pretoken_pattern(processor)
    table = spark.sparkContext.broadcast(whole_tokens(processor) if pattern else {})  # at most the vocabulary

    @F.arrow_udf("long")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = load(model)
        counts = Counter(library, table.value)
        cut = re.compile(pattern).findall if pattern else None

        def count(t: str) -> int:
            if cut is None or MARK in t:
                return len(library.encode(t))
            counts.shrink()
            return sum(map(counts.__getitem__, cut(" " + t))) if t else 0

        for texts in batches:
            yield pa.array([count(t.as_py()) for t in texts], pa.int64())

    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), tokens(text).alias("n_tokens"))
    return rows.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
