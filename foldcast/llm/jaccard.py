"""Near-duplicate texts by word shingles: MinHash candidates, pruned by their posterior, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.llm.common import byte_view, neutral, picked, row_blocks, stored
from foldcast.llm.graph import components
from foldcast.llm.shingles import SHINGLE_WORDS, SIGNATURE, band_keys, set_key, shingle_sets, signature

THRESHOLD = 0.8
#: A pair is dropped once the posterior probability of reaching the threshold is below this.
TOLERANCE = 1e-7
#: MinHash values compared between two looks at the posterior.
LOOK = 32
#: A tile of a candidate group holds about so many texts and so many shingles at most.
TILE_TEXTS = 1024
TILE_SHINGLES = 1_000_000
BLOCK_BYTES = 4_000_000


@lru_cache(8)
def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """After each look, the matches below which P(J >= threshold | matches, uniform prior) < tolerance."""
    x = (np.arange(200_000) + 0.5) / 200_000
    out = {}
    for seen in range(LOOK, SIGNATURE + 1, LOOK):
        for m in range(seen + 1):
            density = m * np.log(x) + (seen - m) * np.log1p(-x)
            density = np.exp(density - density.max())
            if density[x >= threshold].sum() / density.sum() >= tolerance:
                break
        out[seen] = m
    return out


def _surviving(a: np.ndarray, b: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (signatures) that no look at the posterior drops."""
    need = least_matches(threshold, TOLERANCE)
    first = np.zeros((len(a), len(b)), np.uint8)
    for k in range(LOOK):
        first += a[:, k, None] == b[None, :, k]
    keep = first >= need[LOOK]
    if same:
        keep &= np.tri(len(a), len(a), -1, bool).T
    i, j = np.nonzero(keep)
    found = first[i, j].astype(np.int32)
    for at in range(LOOK, SIGNATURE, LOOK):
        for part in range(0, len(i), 100_000):
            s = slice(part, part + 100_000)
            found[s] += (a[i[s], at : at + LOOK] == b[j[s], at : at + LOOK]).sum(1, dtype=np.int32)
        live = found >= need[at + LOOK]
        i, j, found = i[live], j[live], found[live]
    return i, j


def _shared(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Size of the intersection of each pair: one by one for few pairs, by products of incidence matrices for many."""
    rows, columns = np.unique(i), np.unique(j)
    every = np.concatenate([a[k] for k in rows] + [b[k] for k in columns])
    kinds, back, number = np.unique(every, return_inverse=True, return_counts=True)
    common = number > 1  # only these can be in two sets
    rank = np.cumsum(common) - 1
    if len(rows) * len(columns) * int(common.sum()) * 1e-10 > len(i) * (2e-5 + 2e-8 * len(every) / (len(rows) + len(columns))):
        return np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j, strict=True)], np.int64)
    sizes = np.array([len(a[k]) for k in rows] + [len(b[k]) for k in columns])
    row = np.repeat(np.arange(len(sizes)), sizes)[common[back]]
    place = rank[back[common[back]]]
    total = np.zeros((len(rows), len(columns)), np.float32)
    for low in range(0, int(common.sum()), 4096):
        inside = (place >= low) & (place < low + 4096)
        matrix = np.zeros((len(sizes), 4096), np.float32)
        matrix[row[inside], place[inside] - low] = 1
        total += matrix[: len(rows)] @ matrix[len(rows) :].T
    return total[np.searchsorted(rows, i), np.searchsorted(columns, j)].astype(np.int64)


def linked(a: np.ndarray, a_sets: list[np.ndarray], b: np.ndarray, b_sets: list[np.ndarray], same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with Jaccard similarity of at least the threshold."""
    i, j = _surviving(a, b, same, threshold)
    if not len(i):
        return i, j
    shared = _shared(a_sets, b_sets, i, j)
    sizes = np.array([len(x) for x in a_sets])[i] + np.array([len(x) for x in b_sets])[j]
    good = shared / (sizes - shared) >= threshold
    return i[good], j[good]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return np.array([find(x) for x in range(n)], np.int64)


def _tile_links(threshold: float):
    """Compares the texts of one tile pair, or of each small group in a bucket; returns links and a forest, not pairs."""

    def compare(table: pa.Table) -> pa.Table:
        cls = table.column("cls").to_numpy()
        _, one = np.unique(cls, return_index=True)  # repeated rows of a class
        table = table.take(pa.array(one))
        cls, group, copies, tile = (table.column(x).to_numpy() for x in ("cls", "component", "copies", "tile"))
        marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, SIGNATURE)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        links = np.zeros(len(cls), np.int64)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        order = np.argsort(group, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            x = rows if low == high else rows[tile[rows] == low]
            y = x if low == high else rows[tile[rows] == high]
            i, j = linked(marks[x], [sets[k] for k in x], marks[y], [sets[k] for k in y], low == high, threshold)
            np.add.at(links, x[i], copies[y[j]])
            np.add.at(links, y[j], copies[x[i]])
            left.append(x[i])
            right.append(y[j])
        i, j = np.concatenate(left), np.concatenate(right)
        keep = np.unique(np.concatenate([i, j]))
        roots = _roots(len(cls), i, j)
        return pa.table({"cls": pa.array(cls[keep]), "links": pa.array(links[keep]), "root": pa.array(cls[roots[keep]])})

    return compare


def _marked(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, begins = byte_view(batch.column(1))
            for i, j in row_blocks(begins, BLOCK_BYTES):
                sets = shingle_sets(flat[begins[i] : begins[j]], begins[i : j + 1] - begins[i], words)
                keys = [set_key(x) if len(x) else None for x in sets]
                marks = [signature(x).tobytes() if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(keys, pa.binary()), pa.array([len(x) for x in sets], pa.int64()), pa.array(marks, pa.binary())], names=[id_col, "node", "size", "signature"])

    kind = docs.schema[id_col].dataType.simpleString()
    return stored(docs.select(id_col, text_col).mapInArrow(mark, f"`{id_col}` {kind}, node binary, size bigint, signature binary"), "signatures")


def _with_shingles(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """members with the shingles of their class's first document, read again from its text."""
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # dealt by id at every size: a broadcast of the members would only suit small inputs
    joined = members.hint("merge").join(texts, members.rep.eqNullSafe(texts._id)).drop("_id")
    names = [x for x in joined.columns if x != "_text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("_text"))
            flat, begins = byte_view(column)
            for i, j in row_blocks(begins, BLOCK_BYTES):
                sets = shingle_sets(flat[begins[i] : begins[j]], begins[i : j + 1] - begins[i], words)
                rows = pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(x)).slice(i, j - i) for x in names] + [pa.array([x.tobytes() for x in sets], pa.binary())], names=[*names, "shingles"])
                own = [set_key(x) == k for x, k in zip(sets, rows.column("node").to_pylist(), strict=True)]  # an id may have several texts
                yield rows.filter(pa.array(own))

    schema = joined.drop("_text").withColumn("shingles", F.lit(b"")).schema
    return joined.mapInArrow(cut, schema)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, class_id, n_links and kept (id = class_id) of every row.

    Two texts are linked if the Jaccard similarity of their sets of word shingles is at least the threshold (words as
    runs of 0-9, a-z and characters beyond ASCII, A-Z lower-cased; a text of fewer words is one shingle). n_links
    counts the other rows linked directly, class_id is the smallest id reachable by links. Texts without words (null,
    empty) link with nothing and are their own class; repeated rows are linked copies; other columns are ignored.

    Texts with equal sets become one class first. Classes that share a band of MinHash values form candidate groups;
    a pair at 0.8 shares none with probability 3e-6. A group is compared in tiles, spread over tasks by a hash, and
    a tile pair returns each class's number of links and a spanning forest, so no pairs are emitted however
    large a group is. Inside a tile MinHash values are compared LOOK at a time and pairs leave by their posterior;
    what is left is verified on the sets themselves.
    """
    docs = picked(docs, id_col, text_col)
    marked = _marked(docs, id_col, text_col, words)
    classes = marked.where("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min(id_col).alias("rep"), F.first("size").alias("size"), F.first("signature").alias("signature"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            flat, _ = byte_view(batch.column(1))
            keys = band_keys(flat.view(np.uint32).reshape(n, SIGNATURE)) if n else np.zeros((0, 1), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1]))], names=["key", "cls"])

    bands = classes.select("cls", "signature").mapInArrow(cut, "key bigint, cls bigint")
    shared = bands.groupBy("key").agg(F.min("cls").alias("low"), F.count("*").alias("n")).where("n > 1").select("key", "low")
    candidates = components(bands.join(shared, "key").select("cls", "low"), "cls", "low").withColumnsRenamed({"node": "cls"})
    members = classes.join(candidates, "cls")
    spread = members.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / TILE_TEXTS), F.ceil(F.sum("size") / TILE_SHINGLES)).cast("int").alias("tiles"))
    buckets = 16 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tile = F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int")
    members = members.join(spread, "component").withColumn("tile", F.when(F.col("tiles") > 1, tile).otherwise(-1))
    full = _with_shingles(docs, members.select("cls", "component", "copies", "rep", "node", "tiles", "tile", "signature"), id_col, text_col, words)
    other = F.explode(F.when(F.col("tiles") > 1, F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array(F.lit(-1))))
    pairs = full.withColumn("other", other).withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other"), "bucket": F.when(F.col("tiles") > 1, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(buckets)))})
    pairs = pairs.select("bucket", "low", "high", "cls", "component", "copies", "tile", "signature", "shingles")
    found = stored(pairs.groupBy("bucket", "low", "high").applyInArrow(_tile_links(threshold), "cls bigint, links bigint, root bigint"), "links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    groups = components(found, "cls", "root").withColumnRenamed("node", "cls")
    named = classes.select("cls", "rep").join(groups, "cls")
    named = named.join(named.groupBy("component").agg(F.min("rep").alias("class_id")), "component").select("cls", "class_id").join(links, "cls")
    by_class = classes.select("node", "cls", "rep", "copies").join(named, "cls", "left")
    by_class = by_class.select(F.col("node"), F.coalesce("class_id", "rep").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = marked.select(id_col, "node").join(by_class, "node", "left")
    out = out.select(id_col, F.coalesce("class_id", F.col(id_col)).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("class_id")))


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, the one of the smallest id, with the columns it came with.

    Where ids repeat (checked by counting), rows of the same id and text are one document; a row stays if its id
    is kept for one of its texts.
    """
    found = near_duplicates(docs, threshold, words, id_col, text_col)
    kept = stored(found.where("kept").groupBy(F.col(id_col).alias("_kept")).agg(F.count("*").alias("n")), "kept")
    id_at, text_at = (f"c{docs.columns.index(x)}" for x in (id_col, text_col))
    out = neutral(docs).join(kept.select("_kept").hint("merge"), F.col(id_at).eqNullSafe(F.col("_kept")), "left_semi")
    if kept.where("n > 1").limit(1).count():
        out = out.dropDuplicates([id_at, text_at])
    return out.toDF(*docs.columns)
