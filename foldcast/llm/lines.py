"""Lines that many documents repeat: exploded, hashed, counted by distinct document, dropped, and put together again by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.llm.common import picked, spread_join, stored

#: Code points of the shortest key that can go, and documents that must hold it.
LEAST_LENGTH = 40
LEAST_DOCUMENTS = 5
BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased and all else as it is."""
    bare = F.btrim(line, F.lit(BLANKS))
    plain = F.octet_length(bare) == F.length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def without_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS, keep: bool = True) -> DataFrame:
    """id, n_lines, n_dropped and kept_sha256 of every row, and with keep also `kept`, the remaining text.

    Lines whose key has `least_length` code points or more and stands in `least_documents` documents or more go, but for
    those of the largest id that holds it. Documents are told apart by id: rows of one id are one document, and null
    is an id below all others. Repeated lines of a document count once, and go or stay together. Null and empty texts
    are one empty line, which stays; an empty table gives no rows; other columns are ignored.

    Lines travel as two 64-bit hashes. A common line is counted with sums before the shuffle, and its lines meet the
    count under a salt; the positions to drop come back to their own row, so no task ever holds the lines of one key.
    """
    docs = picked(docs, id_col, text_col).toDF("id", "text")
    rows = stored(docs.withColumn("row", F.monotonically_increasing_id()), "line-texts", "zstd")
    parts = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    key = rows.select("row", "id", F.posexplode(parts).alias("position", "line")).withColumn("key", line_key(F.col("line")))
    lines = key.where(F.length("key") >= least_length).select("row", "id", "position", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g"))
    lines = stored(lines, "lines")
    counted = lines.select("h", "g", "id").distinct().groupBy("h", "g").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    common = counted.where(F.col("n") >= least_documents).select("h", "g", "last")
    gone = spread_join(lines, common, ["h", "g"], F.col("row")).where(~F.col("id").eqNullSafe(F.col("last")))
    dropped = gone.groupBy("row").agg(F.collect_list("position").alias("dropped"))
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("dropped"))
    found = rows.join(dropped, "row", "left").withColumn("parts", parts)
    found = found.withColumn("kept", F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.transform(left, lambda k: F.get("parts", k)), "\n")))
    n_dropped = F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped"))
    return found.select(F.col("id").alias(id_col), F.size("parts").cast("bigint").alias("n_lines"), n_dropped.cast("bigint").alias("n_dropped"), F.sha2("kept", 256).alias("kept_sha256"), *(["kept"] * keep))
