"""Best-fit packing of documents into fixed-size sequences, under conflicts of source and duplicate cluster."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.llm.common import picked
from foldcast.llm.jaccard import near_duplicates
from foldcast.llm.token_counts import token_counts

#: Rows that are packed together. More rows a shard fill bins a little better; the memory of a task is bound by it.
SHARD_ROWS = 4096


class Bins:
    """Open bins by residual; bins of one residual that carry the same bitmaps stand together."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.levels: list[int] = []
        self.at: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.n = 0

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Puts an item in the tightest bin whose bitmaps it does not meet, else in a new one: bin and offset."""
        for level in self.levels[bisect_left(self.levels, length) :]:
            groups = self.at[level]
            for marks in groups:
                if not (marks[0] & source or marks[1] & cluster):
                    chosen = groups[marks].pop()
                    if not groups[marks]:
                        del groups[marks]
                        if not groups:
                            del self.at[level]
                            self.levels.remove(level)
                    self._open(chosen, level - length, (marks[0] | source, marks[1] | cluster))
                    return chosen, self.capacity - level
        self.n += 1
        self._open(self.n - 1, self.capacity - length, (source, cluster))
        return self.n - 1, 0

    def _open(self, bin_no: int, residual: int, marks: tuple[int, int]) -> None:
        if residual not in self.at:
            insort(self.levels, residual)
            self.at[residual] = {}
        self.at[residual].setdefault(marks, []).append(bin_no)


def pack_shard(items: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Packs items (doc, source, cluster, near, length), longest first; bitmaps have a bit for each source and each cluster or near class with several items."""
    sources = {x: 1 << k for k, x in enumerate(sorted(items.source.dropna().unique()))}
    several = sorted(x for x, n in Counter([*items.cluster.dropna(), *items.near.dropna()]).items() if n > 1)
    clusters = {x: 1 << k for k, x in enumerate(several)}
    bins, out = Bins(capacity), []
    items = items.assign(rest=items.length % capacity)
    for row in items.sort_values(["length", "doc"], ascending=[False, True], kind="stable").itertuples():
        for piece in range(int(row.length // capacity)):
            out.append((row.doc, piece, bins.n, 0, capacity))
            bins.n += 1
    for row in items.sort_values(["rest", "cluster", "doc"], ascending=[False, True, True], kind="stable").itertuples():
        if row.rest or not row.length:
            source = sources.get(row.source, 0) if isinstance(row.source, str) else 0
            cluster = clusters.get(row.cluster, 0) if isinstance(row.cluster, str) else 0
            cluster |= clusters.get(row.near, 0) if isinstance(row.near, str) else 0
            bin_no, offset = bins.place(int(row.rest), source, cluster)
            out.append((row.doc, int(row.length // capacity), bin_no, offset, int(row.rest)))
    return pd.DataFrame(out, columns=["doc", "piece", "bin", "bin_offset", "length"])


def approximate_tokens(text_col: str = "text") -> Column:
    """A quarter of the UTF-8 bytes, rounded up; null has none."""
    return F.ceil(F.coalesce(F.octet_length(text_col), F.lit(0)) / 4).cast("bigint")


def normal_text_key(text_col: str = "text") -> Column:
    """Equal for texts that differ in case and blanks only; null for texts without other characters."""
    # not when(plain != "", md5(plain)): Spark would work plain out twice
    return F.md5(F.nullif(F.lower(F.regexp_replace(F.col(text_col), r"\s+", "")), F.lit("")))


def near_classes(docs: DataFrame, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key and near of every text in a class of near-duplicates: a row_key, and a name of its class.

    Keys, not ids, stand for rows, so null ids and one id of several texts have the classes of their own texts.
    """
    rows = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    linked = near_duplicates(rows, threshold, id_col="key").where("n_links > 0")
    return linked.groupBy("key").agg(F.concat(F.lit("near "), F.to_json(F.min("class_id"))).alias("near"))


def row_key(id_col: str, text_col: str) -> Column:
    """Equal for rows of one id and text."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text"))


def best_fit(docs: DataFrame, capacity: int = 2048, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", length: Callable[[str], Column] = approximate_tokens, cluster: Callable[[str], Column] = normal_text_key, vocabulary: str | None = None, near: float | None = None) -> DataFrame:
    """id, piece, bin_id, bin_offset and length of every piece of every document.

    A document longer than the capacity is cut into full pieces, each a bin of its own, and a rest. A bin never
    holds two documents of one source or of one cluster (null: no conflict). Documents are dealt to shards of
    about SHARD_ROWS rows by a hash of id, so hot sources and clusters are spread, and bins do not cross shards.
    With a vocabulary, lengths are its token counts (those of `token_counts`), so a bin holds at most `capacity` tokens;
    without one they are what `length` makes of the text, by default a guess that real counts exceed. With `near`, a
    bin holds no two documents of one class of `near_duplicates` at that threshold either.
    Null and empty texts are items of length 0 with a row of their own; repeated ids and rows are packed one by one;
    an empty table gives no rows; other columns are ignored.
    """
    docs = picked(docs, *dict.fromkeys([id_col, source_col, text_col]))
    shards = max(1, -(-docs.select(id_col).count() // SHARD_ROWS))
    marks = [F.col(id_col).alias("doc"), F.col(source_col).cast("string").alias("source"), cluster(text_col).alias("cluster")]
    marks += [row_key(id_col, text_col).alias("key")] if near is not None else []
    if vocabulary is None:
        items = docs.select(*marks, length(text_col).alias("length"))
    else:
        counted = token_counts(docs.select(F.struct(*marks).alias("item"), F.col(text_col).alias("text")), vocabulary, id_col="item")
        items = counted.select("item.*", F.col("n_tokens").alias("length"))
    if near is None:
        items = items.withColumn("near", F.lit(None).cast("string"))
    else:
        items = items.join(near_classes(docs, near, id_col, text_col), "key", "left").drop("key")
    items = items.withColumn("shard", F.pmod(F.xxhash64("doc", "cluster"), F.lit(shards)))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = pack_shard(rows, capacity)
        return found.assign(bin_id=(int(key[0]) << 32) + found.bin)[["doc", "piece", "bin_id", "bin_offset", "length"]]

    kind = docs.schema[id_col].dataType.simpleString()
    packed = items.groupBy("shard").applyInPandas(pack, f"doc {kind}, piece bigint, bin_id bigint, bin_offset bigint, length bigint")
    return packed.withColumnRenamed("doc", id_col)
