"""Ranked lexical search: hashed max-sketches bound every document's score, and only documents whose bound reaches the threshold are scored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldcast.llm.common import byte_view, hashed_words, picked, ragged, row_blocks, stored

TOP = 10
#: Buckets of a sketch for each distinct term of its document, before the next power of two; and least buckets.
BUCKETS_PER_TERM = 8
LEAST_BUCKETS = 64
#: Occurrences that a bucket can hold; this number stands for itself and all larger ones.
MOST_TF = 255
BLOCK_BYTES = 4_000_000
#: Terms and items that are looked up together; a larger set of items is looked up in blocks.
BLOCK_TERMS = 40_000
BLOCK_ITEMS = 256
#: Documents that are scored between two looks at the threshold, and cells of a lookup.
SCORED_AT_ONCE = 64
CELLS = 2_000_000
#: Bounds are sums in single precision; this factor covers their rounding.
SLACK = np.float32(1.001)


def doc_terms(flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, term (hash) and occurrences of all distinct terms of each document, and the terms of each with repeats."""
    hashes, index = hashed_words(flat, begins)
    sizes = np.diff(index)
    distinct, inverse = np.unique(hashes, return_inverse=True)
    width = np.int64(max(len(distinct), 1))
    pairs, tf = np.unique(np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) * width + inverse, return_counts=True)
    return pairs // width, distinct[pairs % width], tf, sizes


def sketches(doc: np.ndarray, term: np.ndarray, tf: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The sketches of all documents end to end, and where each begins: a bucket holds the most occurrences of a term in it."""
    terms = np.bincount(doc, minlength=rows)
    size = 1 << np.ceil(np.log2(np.maximum(terms * BUCKETS_PER_TERM, LEAST_BUCKETS))).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(begins[-1], np.uint8)
    at = begins[doc] + (term & (size[doc] - 1).astype(np.uint64)).astype(np.int64)
    np.maximum.at(out, at, np.minimum(tf, MOST_TF).astype(np.uint8))
    return out, begins


@dataclass
class Index:
    """rows (id, text, row, n, sketch), frequencies (term, df), and the numbers of documents with terms and of all terms."""

    rows: DataFrame
    frequencies: DataFrame
    documents: int
    terms: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """One pass over the texts; what it finds is written once and serves any number of searches."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, begins = byte_view(batch.column(1))
            for i, j in row_blocks(begins, BLOCK_BYTES):
                own = begins[i : j + 1] - begins[i]
                doc, term, tf, sizes = doc_terms(flat[begins[i] : begins[j]], own)
                data, at = sketches(doc, term, tf, j - i)
                cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(at), pa.py_buffer(data)]).cast(pa.binary())
                columns = [*batch.slice(i, j - i).columns, pa.array(sizes, pa.int64()), cells]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(j - i, pa.int64()), pa.nulls(j - i, pa.int64())], names=names)
                found, df = np.unique(term, return_counts=True)
                blank = [pa.nulls(len(found), x.type) for x in columns]
                yield pa.RecordBatch.from_arrays([*blank, pa.array(found.view(np.int64)), pa.array(df, pa.int64())], names=names)

    names = ["id", "text", "row", "n", "sketch", "term", "df"]
    docs = picked(docs, id_col, text_col).toDF("id", "text").withColumn("row", F.monotonically_increasing_id())
    kind = docs.schema["id"].dataType.simpleString()
    both = stored(docs.mapInArrow(scan, f"id {kind}, text string, row bigint, n bigint, sketch binary, term bigint, df bigint"), "sketches")
    rows = both.where("sketch is not null").select("id", "text", "row", "n", "sketch")
    frequencies = stored(both.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")), "frequencies")
    size = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    return Index(rows, frequencies, int(size[0]), int(size[1]))


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """item and term of every distinct term of every item; rows of one id are one item."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, begins = byte_view(batch.column(1))
            doc, term, _, _ = doc_terms(flat, begins)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array(term.view(np.int64))], names=["item", "term"])

    items = picked(items, item_col, text_col).toDF("item", "text")
    return items.mapInArrow(scan, f"item {items.schema['item'].dataType.simpleString()}, term bigint").distinct()


@dataclass
class Queries:
    """A block of items: names, distinct terms (sorted hashes), and the weight of each term (rows) in each item (columns)."""

    names: pa.Array
    terms: np.ndarray
    weight: np.ndarray

    def bounds(self, sketch: np.ndarray, at: np.ndarray, m: np.ndarray) -> np.ndarray:
        """What no score can exceed: documents x items."""
        out = np.zeros((len(m), len(self.names)), np.float32)
        size = np.diff(at)
        weight = self.weight.astype(np.float32)
        for buckets in np.unique(size):
            own = np.flatnonzero(size == buckets)
            place = (self.terms & np.uint64(buckets - 1)).astype(np.int64)
            for k in range(0, len(own), step := max(1, CELLS // max(len(place), 1))):
                part = own[k : k + step]
                tf = sketch[at[part][:, None] + place].astype(np.float32)
                tf[tf == MOST_TF] = np.inf
                with np.errstate(invalid="ignore"):
                    impact = 1e6 * tf / (tf + np.float32(0.008) * m[part].astype(np.float32)[:, None])
                impact[np.isnan(impact)] = 1e6
                out[part] = impact @ weight
        return out * SLACK

    def scores(self, flat: np.ndarray, begins: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Exact scores: documents x items."""
        hashes, index = hashed_words(flat, begins)
        place = np.searchsorted(self.terms, hashes)
        place[place == len(self.terms)] = 0
        known = np.flatnonzero(self.terms[place] == hashes)
        doc = np.searchsorted(index, known, "right") - 1
        width = len(self.terms)
        pairs, tf = np.unique(doc * width + place[known], return_counts=True)
        doc = pairs // width
        impact = np.zeros((len(m), width), self.weight.dtype)
        impact.reshape(-1)[pairs] = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        return (impact @ self.weight).astype(np.int64)


def _blocks(terms: DataFrame) -> Iterator[Queries]:
    """Items in blocks of bounded size: dealt by hash, then cut."""
    size = terms.agg(F.count("*"), F.count_distinct(F.struct("item"))).first()
    n = max(1, -(-size[0] // (BLOCK_TERMS // 2)), -(-size[1] // (BLOCK_ITEMS // 2)))
    dealt = terms.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n)))
    for block in range(n):
        found = dealt.where(F.col("block") == block).select("item", "term", "w").orderBy("item", "term").toArrow().combine_chunks()
        code = pc.dictionary_encode(found["item"], null_encoding="encode").combine_chunks()
        item = code.indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(found) else np.zeros(0, np.int64)
        sizes, first = np.bincount(item), 0
        while first < len(sizes):
            upto = np.cumsum(sizes[first : first + BLOCK_ITEMS])
            last = first + max(1, int(np.searchsorted(upto, BLOCK_TERMS, "right")))
            own = (item >= first) & (item < last)
            hashes = found["term"].to_numpy()[own].view(np.uint64)
            distinct, place = np.unique(hashes, return_inverse=True)
            w = found["w"].to_numpy()[own]
            exact = np.int64 if w.max() * 1_000_000 * sizes[first:last].max() >= 1 << 53 else np.float64
            weight = np.zeros((len(distinct), last - first), exact)
            weight[place, item[own] - first] = w
            yield Queries(code.dictionary.slice(first, last - first), distinct, weight)
            first = last


def _length_terms(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    return 100 - 90 + (90 * n * documents) // max(terms, 1)


def _best(table: pa.Table, top: int) -> pa.Table:
    """The `top` rows of each item: highest score first, then lowest id, null after all others."""
    order = pc.sort_indices(table, [("item", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_end")
    table = table.take(order)
    item = table["item"].to_numpy()
    start = np.searchsorted(item, item, "left")
    return table.filter(pa.array(np.arange(len(item)) - start < top))


def _search(index: Index, queries: Queries, top: int, item_kind: str) -> DataFrame:
    """item (its name), id and score of at least the `top` best documents of each item of a block."""
    spark, documents, terms = index.rows.sparkSession, index.documents, index.terms
    sent = spark.sparkContext.broadcast(queries)
    n_items = len(queries.names)

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows with the highest bounds of each item in a task."""
        best, at = np.zeros((0, n_items), np.float32), np.zeros((0, n_items), np.int64)
        for batch in batches:
            sketch, begins = byte_view(batch.column(2))
            bound = sent.value.bounds(sketch, begins, _length_terms(batch.column(1).to_numpy(), documents, terms))
            bound, rows = np.concatenate([best, bound]), np.concatenate([at, np.repeat(batch.column(0).to_numpy()[:, None], n_items, 1)])
            keep = np.argsort(-bound, axis=0, kind="stable")[:top]
            best, at = np.take_along_axis(bound, keep, 0), np.take_along_axis(rows, keep, 0)
        item = np.broadcast_to(np.arange(n_items), best.shape)
        yield pa.RecordBatch.from_arrays([pa.array(item.ravel()), pa.array(at.ravel()), pa.array(best.ravel().astype(np.float64))], names=["item", "row", "bound"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All scores of a few documents."""
        for batch in batches:
            flat, begins = byte_view(batch.column(1))
            score = sent.value.scores(flat, begins, _length_terms(batch.column(0).to_numpy(), documents, terms))
            doc, item = np.nonzero(score)
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(score[doc, item])], names=["item", "score"])

    # the documents of highest bound: the least of their scores is a threshold that the best documents of an item reach
    tips = index.rows.select("row", "n", "sketch").mapInArrow(highest, "item bigint, row bigint, bound double")
    ranked = tips.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "row"))).where(F.col("place") <= top)
    few = stored(ranked.select("row").distinct(), "tips")  # at most top x BLOCK_ITEMS rows
    scored = index.rows.join(F.broadcast(few), "row").select("n", "text").mapInArrow(exact, "item bigint, score bigint")
    tenth = scored.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).where(F.col("place") == top)
    floor = np.ones(n_items, np.int64)
    for item, score in tenth.select("item", "score").collect():  # at most one row an item of the block
        floor[item] = max(score, 1)

    kind = index.rows.schema["id"].dataType.simpleString()

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores documents by descending bound, until no bound reaches its item's threshold, which rises on the way."""
        least, held = floor.copy(), None
        for batch in batches:
            sketch, at = byte_view(batch.column(3))
            flat, begins = byte_view(batch.column(1))
            m = _length_terms(batch.column(2).to_numpy(), documents, terms)
            bound = sent.value.bounds(sketch, at, m)
            over = (bound - least).max(axis=1)
            order = np.argsort(-over, kind="stable")
            order = order[over[order] >= 0]
            for k in range(0, len(order), SCORED_AT_ONCE):
                part = order[k : k + SCORED_AT_ONCE]
                part = part[(bound[part] >= least).any(axis=1)]
                if not len(part):
                    continue
                sizes = begins[part + 1] - begins[part]
                score = sent.value.scores(flat[ragged(begins[part], sizes)], np.concatenate([[0], np.cumsum(sizes)]), m[part])
                doc, item = np.nonzero(score >= least)
                new = pa.table({"item": pa.array(item), "id": batch.column(0).take(pa.array(part[doc])), "score": pa.array(score[doc, item])})
                held = _best(new if held is None else pa.concat_tables([held, new]), top)
                count = np.bincount(held["item"].to_numpy(), minlength=n_items)
                full = np.flatnonzero(count >= top)
                least[full] = np.maximum(least[full], held["score"].to_numpy()[np.cumsum(count)[full] - 1])
        if held is not None:
            out = pa.table({"item": sent.value.names.take(held["item"].combine_chunks()), "id": held["id"], "score": held["score"]})
            yield from out.to_batches()

    return index.rows.select("id", "text", "n", "sketch").mapInArrow(descend, f"item {item_kind}, id {kind}, score bigint")


def search(index: Index, items: DataFrame, top: int = TOP, id_col: str = "doc_id", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item, rank, id and score of the `top` best rows of an index for each item."""
    terms = item_terms(items, item_col, item_text_col).join(index.frequencies, "term")
    ratio = F.lit(float(2 * index.documents + 2)) / (2 * F.col("df") + 1).cast("double")
    terms = stored(terms.select("item", "term", F.floor(1000 * F.log(ratio)).cast("bigint").alias("w")), "query-terms")
    found = None
    for queries in _blocks(terms):
        part = _search(index, queries, top, terms.schema["item"].dataType.simpleString())
        found = part if found is None else found.unionByName(part)
    if found is None:
        kinds = [f"{name} {kind.dataType.simpleString()}" for name, kind in (("item", terms.schema["item"]), ("id", index.rows.schema["id"]))]
        found = terms.sparkSession.createDataFrame([], ", ".join([*kinds, "score bigint"]))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item, rank, id and score of the `top` best rows of docs for each item, score above 0, equal scores by ascending id.

    Terms are runs of 0-9, a-z and characters beyond ASCII, after A-Z are lower-cased. Null and empty texts have none:
    such documents are never found, such items find nothing. Rows of one item id are one item, and null is an id;
    repeated documents and ids are ranked one by one, a null id after its equals. An empty table on either side gives
    no rows; other columns are ignored.

    Each document is folded into a sketch: bucket by bucket, the most occurrences of any term that falls there, from
    which its impacts follow. A block of items is looked up in all sketches at once, for bounds. The documents of
    highest bound are scored first and give thresholds; a second look scores exactly, by descending bound, every
    document whose bound reaches one. Nothing is shuffled but the best rows of each task, and no text leaves its task.
    """
    return search(build_index(docs, id_col, text_col), items, top, id_col, item_col, item_text_col)
