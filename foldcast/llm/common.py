"""Tables, scratch tables in the shared folder, and Arrow buffers as numpy arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def picked(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone; found by their exact name, also where another differs in case only."""
    return neutral(df).select(*(F.col(f"c{df.columns.index(x)}").alias(x) for x in names))


def neutral(df: DataFrame) -> DataFrame:
    """df with columns c0, c1, ..., which no name inside an operator meets."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only where none is set and Spark runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    found = "file://" + tempfile.mkdtemp(prefix="foldcast-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """df written to the shared folder and read back: computed once, its lineage cut, safe when executors are lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Parts into which rows of one key are dealt before they meet their row of a lookup table.
SPREAD = 128


def spread_join(rows: DataFrame, lookup: DataFrame, keys: list[str], salt: Column, how: str = "inner") -> DataFrame:
    """rows joined to a table with one row a key, where one key may hold any share of rows.

    Rows are dealt by key and salt; a lookup row is copied only to the salts that its key has, which are found with
    sums before the shuffle. Null keys meet nothing.
    """
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(SPREAD)).cast("int"))
    copies = dealt.select(*keys, "_salt").distinct().join(lookup, keys)
    return dealt.join(copies, [*keys, "_salt"], how).drop("_salt")


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and where each row begins (one more at the end); null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    begins = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[begins[0] : begins[-1]]
    return flat, begins - begins[0]


def row_blocks(begins: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `size` bytes each; a longer row is a range of its own."""
    n, i = len(begins) - 1, 0
    while i < n:
        j = int(np.searchsorted(begins, begins[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def ragged(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions begins[i] .. begins[i] + lengths[i] - 1 for every i, end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(begins - (ends - lengths), lengths)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


LONG_SPAN = 48


def hash_spans(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of values (bytes or code points)."""
    import xxhash

    lengths = ends - begins
    order = np.argsort(np.minimum(lengths, LONG_SPAN + 1).astype(np.uint8), kind="stable")[::-1]
    at, left = begins[order], lengths[order]
    h = np.full(len(order), 0xCBF29CE484222325, np.uint64)
    step = np.uint64(0x100000001B3)
    live = len(order)
    for k in range(LONG_SPAN):
        live = int(np.searchsorted(-left[:live], -k, "left")) if live and left[live - 1] <= k else live
        if not live:
            break
        part = h[:live]
        part ^= values[at[:live] + k]
        part *= step
    for i in range(live):
        if left[i] <= LONG_SPAN:
            break
        h[i] = xxhash.xxh64_intdigest(values[at[i] + LONG_SPAN : at[i] + left[i]].tobytes(), seed=int(h[i]))
    out = np.empty_like(h)
    out[order] = mix(h)
    return out


_CODES = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, all other bytes as they are.
LOWER = np.where((_CODES >= 0x41) & (_CODES <= 0x5A), _CODES + 32, _CODES).astype(np.uint8)
#: 0-9, a-z and all bytes of characters beyond ASCII.
WORD_BYTE = ((_CODES >= 0x30) & (_CODES <= 0x39)) | ((_CODES >= 0x61) & (_CODES <= 0x7A)) | (_CODES >= 0x80)


def word_spans(flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and where words begin and end in them; a word is a run of WORD_BYTE within one row."""
    low = LOWER[flat]
    if not len(low):
        return low, np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = WORD_BYTE[low]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[0] = after[-1] = False
    before[begins[:-1][begins[:-1] < len(low)]] = False
    after[begins[1:][begins[1:] > 0] - 1] = False
    return low, np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def hashed_words(flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the index of each row's first word (one more at the end)."""
    low, first, last = word_spans(flat, begins)
    return hash_spans(low, first, last), np.searchsorted(first, begins)
