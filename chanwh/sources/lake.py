"""File sources: the JSON message lake (S1), the detection CSV (S2), the image lake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanwh import schemas as S


def _lake_elements(value: Column) -> Column:
    """Array of VARIANT elements of one file's text.

    A file is a JSON array of records or a single record; a file that does not parse is
    skipped as a whole. Files this library writes are JSON Lines: they begin with '{' and their
    first line is a value by itself, with others behind it (as one text, only one of the
    values would be read).
    """
    doc = F.try_parse_json(value)
    as_list = F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.array(doc))
    lines = F.filter(F.split(value, "\n", -1), lambda ln: F.trim(ln) != "")
    is_lines = F.ltrim(value).startswith("{") & (F.size(lines) > 1) & F.try_parse_json(F.get(lines, 0)).isNotNull()
    return (F.when(is_lines, F.transform(lines, lambda ln: F.try_parse_json(ln)))
            .when(doc.isNotNull(), as_list)
            .otherwise(F.array().cast("array<variant>")))


def parse_lake_text(files: DataFrame) -> DataFrame:
    """files(value, _file) → one row per JSON object element, every field as string, plus
    (_file, _pos) for a deterministic first-wins order."""
    return _records(files.select("_file", F.posexplode(_lake_elements(F.col("value"))).alias("_pos", "e")))


def _records(elements: DataFrame) -> DataFrame:
    """elements(_file, _pos, e): one row per element that is an object, every field as string."""
    el = elements.where(F.schema_of_variant("e").startswith("OBJECT"))
    fields = [F.try_variant_get("e", f"$.{f}", "string").alias(f) for f in S.LAKE_FIELDS]
    return el.select(*fields, "_file", "_pos")


#: Files up to this size are parsed whole, larger ones in pieces.
WHOLE_FILE_BYTES = 32 << 20
#: How a record of an array that is indented by two ends. A line feed inside a string is escaped and what is nested
#: is indented further, so this text stands at the end of a top-level object only.
RECORD_END = "\n  }"


def read_lake_files(spark: SparkSession, path: str, most: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Whole-file text of every *.json of at most ``most`` bytes under ``path`` (recursive)."""
    # .text() has its own wholetext=False parameter, which would override an option
    t = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    return t.where(F.col("_metadata.file_size") <= most).select("value", F.col("_metadata.file_path").alias("_file"))


def read_lake_pieces(spark: SparkSession, path: str, over: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Larger files between the ends of their records, several tasks a file: (_file, _at, value), where ``_at``
    orders the pieces of a file. A split has fewer pieces than bytes, and so have the splits that its task reads
    before it, so the place of its first byte and the number in the task give the order."""
    t = spark.read.text(path, lineSep=RECORD_END, recursiveFileLookup=True, pathGlobFilter="*.json")
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row"))
    return t.where(F.col("_metadata.file_size") > over).select(F.col("_metadata.file_path").alias("_file"), place.alias("_at"), "value")


def parse_lake_pieces(pieces: DataFrame) -> DataFrame:
    """``parse_lake_text`` for files in pieces. A piece is what precedes the end of a record: the opening bracket or a
    comma, then elements, the last of which is an object without its end; the last piece of a file has the closing
    bracket. If each piece of a file is one of these and they come in this order, the file is valid and
    its pieces are parsed one by one; any other file is put together and parsed as a whole, in one task, or skipped."""
    lead = F.regexp_extract("value", r"^\s*([\[,\]])", 1)
    inner = F.regexp_replace("value", r"^\s*[\[,]", "")
    middle = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), inner, F.lit(RECORD_END + "]"))), F.lit("$"), "array<variant>")
    last = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), F.regexp_replace("value", r"^\s*,", ""))), F.lit("$"), "array<variant>")
    kind = (F.when(F.col("middle").isNotNull() & F.col("lead").isin("[", ","), F.col("lead"))
            .when(F.col("lead").isin(",", "]") & F.col("last").isNotNull(), F.lit("]")).otherwise(F.lit("bad")))
    parsed = pieces.select("_file", "_at", lead.alias("lead"), middle.alias("middle"), last.alias("last"))
    parsed = parsed.select("_file", "_at", kind.alias("kind"), F.when(kind != "bad", F.coalesce("middle", "last")).alias("elements"))
    number = lambda k: F.count_if(F.col("kind") == k)
    files = parsed.select("_file", "_at", "kind").groupBy("_file").agg(
        number("bad").alias("bad"), number("[").alias("first"), number("]").alias("last"), F.min_by("kind", "_at").alias("a"), F.max_by("kind", "_at").alias("z"))
    whole = files.where(~((F.col("bad") == 0) & (F.col("first") == 1) & (F.col("last") == 1) & (F.col("a") == "[") & (F.col("z") == "]"))).select("_file")

    split = parsed.join(whole, "_file", "left_anti").select("_file", "_at", F.posexplode("elements").alias("k", "e"))
    split = split.select("_file", (F.shiftleft(F.col("_at.block") + F.col("_at.row"), 16) + F.col("k")).alias("_pos"), "e")
    texts = pieces.join(whole, "_file", "left_semi").groupBy("_file").agg(F.array_sort(F.collect_list(F.struct("_at", "value"))).alias("p"))
    texts = texts.select("_file", F.concat_ws(RECORD_END, F.transform("p", lambda p: p.value)).alias("value"))
    # elements one by one: a variant of the whole text would have a bound on its size
    listed = F.from_json("value", "array<string>", {"allowSingleQuotes": "false"})
    elements = F.when(listed.isNotNull(), F.transform(listed, lambda e: F.try_parse_json(e))).otherwise(_lake_elements(F.col("value")))
    rest = texts.select("_file", F.posexplode(elements).alias("_pos", "e")).withColumn("_pos", F.col("_pos").cast("long"))
    return _records(split.unionByName(rest.select(split.columns)))


def scan_message_lake(spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Records of the message lake as strings (coerce with ``coerce.coerce_messages``).

    Elements that are not objects are skipped individually; an unparseable file is skipped
    whole. Files up to ``whole_file_bytes`` are a task each; a larger array is read by several tasks, from one
    end of a record to another, if it is indented by two (``parse_lake_pieces``). ``scan_written_lake`` reads
    this library's own files line by line.
    """
    small = parse_lake_text(read_lake_files(spark, path, whole_file_bytes))
    large = parse_lake_pieces(read_lake_pieces(spark, path, whole_file_bytes))
    return small.withColumn("_pos", F.col("_pos").cast("long")).unionByName(large)


def scan_written_lake(spark: SparkSession, path: str) -> DataFrame:
    """The lake as ``write_message_lake`` files it: JSON Lines, which a task can read in part, so a
    large file is no large task. Same columns as ``scan_message_lake``, plus the partition's."""
    schema = ", ".join(f"{f} string" for f in S.LAKE_FIELDS) + ", dt string, channel string"
    df = spark.read.schema(schema).json(path)
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_pos"))


def scan_detections_csv(spark: SparkSession, path: str, quoted_line_feeds: bool = False) -> DataFrame:
    """Detection CSV(s) with header, all columns as strings, plus (_file, _pos) order. A file is read line by
    line, large ones by several tasks; ``quoted_line_feeds`` declares that a field may hold a line feed,
    and then a file is one task."""
    df = spark.read.option("header", True).option("inferSchema", False).option("multiLine", quoted_line_feeds).csv(path)
    # rows of a split are fewer than its bytes, so this orders the rows of a file
    place = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return df.select("*", F.col("_metadata.file_path").alias("_file"), place.alias("_pos"))


def parse_detection_lines(lines: DataFrame) -> DataFrame:
    """S2's parser over lines(value) without a header, in the fixed field order, all columns as strings."""
    schema = ", ".join(f"{f} string" for f in S.DETECTION_CSV_FIELDS)
    return lines.select(F.from_csv("value", F.lit(schema)).alias("r"), *[c for c in lines.columns if c != "value"]).select("r.*", *[c for c in lines.columns if c != "value"])


IMAGE_SUFFIX_GLOB = "*.{jpg,jpeg,png}"
IMAGE_PATH_RE = r"images/([^/]+)/([0-9]+)\.(jpg|jpeg|png)$"


def scan_images(spark: SparkSession, path: str) -> DataFrame:
    """Image files (three suffixes) under ``path``; only path and size are read,
    the ``content`` column is pruned so no image bytes are loaded."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
          .option("pathGlobFilter", IMAGE_SUFFIX_GLOB).load(path))
    return df.select("path", "length")


def parse_image_path(df: DataFrame, col: str = "path") -> DataFrame:
    """(channel_name, message_id) from .../images/<channel>/<id>.<ext>; others dropped."""
    # file paths are URIs (' ' → %20, '|' → %7C); a literal '+' must survive the decoding
    p = F.url_decode(F.regexp_replace(F.col(col), r"\+", "%2B"))
    ch = F.regexp_extract(p, IMAGE_PATH_RE, 1)
    mid = F.regexp_extract(p, IMAGE_PATH_RE, 2)
    out = df.select("*", ch.alias("channel_name"), mid.try_cast("bigint").alias("message_id"))
    return out.where((F.col("channel_name") != "") & F.col("message_id").isNotNull())


def images_per_channel(images: DataFrame) -> DataFrame:
    """Existing-image count per channel folder (input of the image quota)."""
    return parse_image_path(images).groupBy("channel_name").agg(F.count(F.lit(1)).alias("existing"))
