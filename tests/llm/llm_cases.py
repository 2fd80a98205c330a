"""Rows and helpers of the tests in this folder."""

MESSY = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, row string, digest string, key int, size int, t int"
LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
TEXT = "The quick brown fox jumps over the lazy dog and runs on through the old quiet forest near the river bank today"


def messy_rows():
    texts = [(1, TEXT), (2, TEXT), (2, TEXT), (3, TEXT.upper()), (4, None), (5, ""), (6, None), (7, LONG), (8, LONG + " end"),
             (9, "a b"), (10, "A B"), (11, " \n\t "), (None, TEXT), (None, "only here, with no id at all"), (12, "naïve ﬁ ① 日本 🙂 café"), (2, "same id, another text entirely")]
    return [(i, t, None, None, None, 5, "r", "d", 1, 2, 3) for i, t in texts]


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
