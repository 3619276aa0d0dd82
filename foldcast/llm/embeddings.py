"""Near-duplicate vectors: tiles in the order of the principal component, compared leading dimensions first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.llm.common import picked, ragged, stored
from foldcast.llm.graph import components
from foldcast.llm.jaccard import _roots

THRESHOLD = 0.95
#: Vectors that the rotation and the tiles' limits are fitted on, at most. Any rotation gives exact results.
SAMPLE = 20_000
#: Vectors of a block; a fuller tile is split into blocks by a hash.
BLOCK = 8192
#: Vectors of a square that is compared at once, and dimensions added between two looks at the bound.
SQUARE = 1024
LOOK = 16
#: Rounding that bounds in single precision are given.
SLACK = 1e-4


def unit_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector in double precision, scaled to length 1; None for null or empty ones, zeros, and null or non-finite components."""
    flat = column.flatten()
    nulls = np.array(flat.is_null()) if flat.null_count else None
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64)
    if nulls is not None:
        values[nulls] = np.nan
    sizes = np.array([0 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()], np.int64)
    out, at = [], 0
    for n in sizes:
        v = values[at : at + n]
        at += n
        top = np.abs(v).max() if n else 0.0
        if not n or not np.isfinite(top) or top == 0:
            out.append(None)
        else:
            v = v / top
            out.append(v / np.sqrt(v @ v))
    return out


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose product is at least the threshold.

    Products are accumulated from the leading dimensions on; what the rest can add is at most the product of the suffixes'
    norms, and a pair leaves as soon as that does not reach the threshold.
    """
    dims = a.shape[1]
    cuts = [*range(min(LOOK, dims), dims, LOOK), dims]
    suffix = lambda x: np.stack([np.sqrt((x[:, c:] ** 2).sum(1)) for c in cuts], 1)
    sa, sb = suffix(a), suffix(b)
    lead_a = np.concatenate([a[:, : cuts[0]], sa[:, :1]], 1).astype(np.float32)
    lead_b = np.concatenate([b[:, : cuts[0]], sb[:, :1]], 1).astype(np.float32)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x in range(0, len(a), SQUARE):
        for y in range(x if same else 0, len(b), SQUARE):
            i, j = np.nonzero(lead_a[x : x + SQUARE] @ lead_b[y : y + SQUARE].T >= threshold - SLACK)
            i, j = i + x, j + y
            if same:
                i, j = i[i < j], j[i < j]
            for part in range(0, len(i), 200_000):
                p, q = i[part : part + 200_000], j[part : part + 200_000]
                product = np.einsum("ij,ij->i", a[p, : cuts[0]], b[q, : cuts[0]])
                for k in range(1, len(cuts)):
                    product += np.einsum("ij,ij->i", a[p, cuts[k - 1] : cuts[k]], b[q, cuts[k - 1] : cuts[k]])
                    last = k == len(cuts) - 1
                    live = product >= threshold if last else product + sa[p, k] * sb[q, k] >= threshold - SLACK
                    p, q, product = p[live], q[live], product[live]
                live = product >= threshold
                left.append(p[live])
                right.append(q[live])
    return np.concatenate(left), np.concatenate(right)


def _compare(threshold: float):
    def compare(table: pa.Table) -> pa.Table:
        cls, copies, block = (table.column(x).to_numpy() for x in ("cls", "copies", "block"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        vectors = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64).reshape(len(cls), -1)
        x = np.flatnonzero(block == low)
        y = x if low == high else np.flatnonzero(block == high)
        i, j = close_pairs(vectors[x], vectors[y], threshold, low == high)
        i, j = x[i], y[j]
        links = np.bincount(i, copies[j], len(cls)) + np.bincount(j, copies[i], len(cls))
        keep = np.unique(np.concatenate([i, j]))
        roots = _roots(len(cls), i, j)
        return pa.table({"cls": pa.array(cls[keep]), "links": pa.array(links[keep].astype(np.int64)), "root": pa.array(cls[roots[keep]])})

    return compare


def _units(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if v is None else v.tobytes() for v in unit_vectors(batch.column(1))]
            keys = [None if v is None else xxhash.xxh128_digest(v) for v in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array([len(v) // 8 if v else 0 for v in found], pa.int32()), pa.array(found, pa.binary())], names=[id_col, "node", "dims", "vector"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(id_col, vector_col).mapInArrow(unit, f"`{id_col}` {kind}, node binary, dims int, vector binary")


def _links(classes: DataFrame, dims: int, threshold: float) -> DataFrame:
    """Links and a forest of all classes of one dimension."""
    spark = classes.sparkSession
    n = classes.count()
    sample = classes.select("vector").orderBy(F.xxhash64("node"), "node").limit(SAMPLE).toArrow().column(0).to_pylist()
    fitted = np.frombuffer(b"".join(sample), np.float64).reshape(-1, dims)
    _, axes = np.linalg.eigh(np.cov(fitted.T).reshape(dims, dims) if len(fitted) > 1 else np.eye(dims))
    axes = axes[:, ::-1]
    tiles = -(-n // BLOCK)
    limits = np.quantile(fitted @ axes[:, 0], [k / tiles for k in range(1, tiles)]) if tiles > 1 else np.zeros(0)

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float64).reshape(batch.num_rows, dims) @ axes
            tile = np.searchsorted(limits, x[:, 0], "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tile), pa.array([v.tobytes() for v in x], pa.binary())], names=["cls", "copies", "tile", "vector"])

    turned = stored(classes.select("cls", "copies", "vector").mapInArrow(rotate, "cls bigint, copies bigint, tile int, vector binary"), "turned")
    count = np.zeros(tiles, np.int64)
    for row in turned.groupBy("tile").count().toLocalIterator():
        count[row[0]] = row[1]
    parts = np.maximum(1, -(-count // BLOCK))
    offset = np.concatenate([[0], np.cumsum(parts)])
    # unit vectors at the threshold are at most this far apart, along any axis too
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    below, above = np.concatenate([[-np.inf], limits]), np.concatenate([limits, [np.inf]])
    first, last = offset[np.searchsorted(above, below - reach, "left")], offset[np.searchsorted(below, above + reach, "right")] - 1

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, tile = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            block = offset[tile] + cls % parts[tile]
            reached = last[tile] - first[tile] + 1
            other = ragged(first[tile], reached)
            row = np.repeat(np.arange(len(cls)), reached)
            for at in range(0, len(row), 20_000):
                r, o = row[at : at + 20_000], other[at : at + 20_000]
                b = block[r]
                taken = batch.take(pa.array(r))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(b, o)), pa.array(np.maximum(b, o)), taken.column(0), taken.column(1), pa.array(b), taken.column(3)], names=["low", "high", "cls", "copies", "block", "vector"])

    pairs = turned.mapInArrow(spread, "low bigint, high bigint, cls bigint, copies bigint, block bigint, vector binary")
    return stored(pairs.groupBy("low", "high").applyInArrow(_compare(threshold), "cls bigint, links bigint, root bigint"), "links")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, n_links (other rows of cosine >= threshold), component_id (smallest id reachable by links) and kept of every row.

    Vectors that are null, empty or zero or hold null or non-finite components link with nothing and are their own
    component; vectors of different lengths never link. Equal vectors become one class first, so copies cost nothing
    more; repeated ids and rows are linked copies; other columns are ignored.

    Vectors are rotated to principal axes. Tiles follow the first axis; a pair of blocks meets only if their ranges on
    it come within the distance that the threshold allows, and each pair of blocks is one task's work, which returns
    numbers of links and a spanning forest, not pairs. Every vector is compared; nothing is approximate.
    """
    vectors = picked(vectors, id_col, vector_col)
    units = stored(_units(vectors, id_col, vector_col), "units")
    classes = units.where("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min(id_col).alias("rep"), F.first("dims").alias("dims"), F.first("vector").alias("vector"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    found = vectors.sparkSession.createDataFrame([], "cls bigint, links bigint, root bigint")
    for dims in sorted(row[0] for row in classes.select("dims").distinct().toLocalIterator()):
        found = found.union(_links(classes.where(F.col("dims") == dims), dims, threshold))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    groups = components(found, "cls", "root").withColumnRenamed("node", "cls")
    named = classes.select("cls", "rep").join(groups, "cls")
    named = named.join(named.groupBy("component").agg(F.min("rep").alias("smallest")), "component").select("cls", "smallest").join(links, "cls")
    by_class = classes.select("node", "cls", "rep", "copies").join(named, "cls", "left")
    by_class = by_class.select("node", F.coalesce("smallest", "rep").alias("component_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = units.select(id_col, "node").join(by_class, "node", "left")
    out = out.select(id_col, F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", F.col(id_col)).alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
