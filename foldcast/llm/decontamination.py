"""Benchmark decontamination: sparse suffix arrays over training text, searched for every benchmark suffix."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.llm.common import byte_view, hashed_words, neutral, picked, ragged, row_blocks, stored

WINDOW = 10
#: Bytes of training text in one suffix array; a longer document has an array of its own.
SHARD_BYTES = 4_000_000
#: Words of benchmark text that are searched in one pass, 8 bytes each; a larger benchmark takes a further pass for each such block.
BLOCK_WORDS = 4_000_000
#: Window starts in one stored row of benchmark text; a longer item fills several rows.
SEGMENT_WORDS = 50_000
_SIEVE = 20

_SEGMENT = "item_no bigint, item string, place bigint, n_words bigint, words binary"
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_MATCHES = pa.list_(pa.struct([("item", pa.string()), ("n_words", pa.int64()), ("at", pa.int64()), ("item_at", pa.int64())]))


@dataclass
class Suffixes:
    """Windows of benchmark items, each by where it begins in a shared array of word hashes, its length, its item and its place there."""

    words: np.ndarray
    start: np.ndarray
    length: np.ndarray
    item: np.ndarray
    place: np.ndarray
    names: list[str | None]

    @classmethod
    def of(cls, names: list[str | None], texts: list[str | None], window: int) -> Suffixes:
        flat, begins = byte_view(pa.array(texts, pa.string()))
        words, index = hashed_words(flat, begins)
        sizes = np.diff(index)
        return cls.joined(names, list(range(len(names))), np.zeros(len(names), np.int64), sizes, [words[i:j] for i, j in zip(index, index[1:])], window)

    @classmethod
    def joined(cls, names: list[str | None], numbers: list[int], places: np.ndarray, sizes: np.ndarray, parts: list[np.ndarray], window: int) -> Suffixes:
        """From segments: item and its number, place of the segment's first word, words of the whole item, words held."""
        held = np.array([len(x) for x in parts], np.int64)
        length = np.minimum(np.asarray(sizes, np.int64), window)
        starts = np.where(length > 0, held - length + 1, 0)
        begins = np.cumsum(held) - held
        row = np.repeat(np.arange(len(parts)), starts)
        start = ragged(begins, starts)
        order = {number: k for k, number in enumerate(dict.fromkeys(numbers))}
        called = dict(zip(numbers, names, strict=True))
        item = np.array([order[x] for x in numbers], np.int64)
        place = np.asarray(places, np.int64)[row] + start - begins[row]
        return cls(np.concatenate([*parts, np.zeros(0, np.uint64)]), start, length[row], item[row], place, [called[x] for x in order])

    def column(self, k: int, rows: np.ndarray) -> np.ndarray:
        """The k-th words of windows longer than k."""
        return self.words[self.start[rows] + k]

    def sieve(self) -> tuple[np.ndarray, np.ndarray]:
        """Bit tables of what windows begin with: a first word of one-word windows, a first pair of the others."""
        one, two = np.zeros(1 << _SIEVE, bool), np.zeros(1 << _SIEVE, bool)
        one[self.column(0, np.flatnonzero(self.length == 1)) >> np.uint64(64 - _SIEVE)] = True
        longer = np.flatnonzero(self.length > 1)
        two[_pair(self.column(0, longer), self.column(1, longer))] = True
        return one, two


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * np.uint64(0x9E3779B97F4A7C15) + b) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - _SIEVE)


class SuffixArray:
    """Suffixes of documents, cut to `window` words and sorted word by word; only those that a sieve lets through."""

    def __init__(self, words: np.ndarray, stop: np.ndarray, sieve: tuple[np.ndarray, np.ndarray], window: int):
        """stop: for each word, the index after its document's last word."""
        one, two = sieve
        n = len(words)
        follows = np.append(words[1:], np.uint64(0))
        may = two[_pair(words, follows)] & (np.arange(n) + 1 < stop)
        if one.any():
            may |= one[words >> np.uint64(64 - _SIEVE)]
        at = np.flatnonzero(may)
        columns = np.zeros((len(at), window), np.uint64)
        for k in range(window):
            inside = at + k < stop[at]
            columns[inside, k] = words[at[inside] + k]
        order = np.lexsort(columns.T[::-1])
        self.position, self.columns = at[order], columns[order]

    def matches(self, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
        """Binary search of every suffix: the range of entries that share its longest match's words, narrowed word by word; full matches only stay."""
        low = np.zeros(len(suffixes.length), np.int64)
        high = np.full(len(suffixes.length), len(self.position), np.int64)
        for k in range(self.columns.shape[1]):
            live = np.flatnonzero((suffixes.length > k) & (low < high))
            want = suffixes.column(k, live)
            low[live], high[live] = self._bound(low[live], high[live], k, want, False), self._bound(low[live], high[live], k, want, True)
        return low, high

    def _bound(self, low: np.ndarray, high: np.ndarray, k: int, want: np.ndarray, right: bool) -> np.ndarray:
        low, high, column = low.copy(), high.copy(), self.columns[:, k]
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                return low
            mid = (low[live] + high[live]) >> 1
            up = column[mid] <= want[live] if right else column[mid] < want[live]
            low[live[up]], high[live[~up]] = mid[up] + 1, mid[~up]


def longest_matches(suffixes: Suffixes, array: SuffixArray) -> np.ndarray:
    """Words of the longest verbatim match of each suffix (at most the window)."""
    best = np.zeros(len(suffixes.length), np.int64)
    low, high = np.zeros(len(best), np.int64), np.full(len(best), len(array.position), np.int64)
    for k in range(array.columns.shape[1]):
        live = np.flatnonzero((suffixes.length > k) & (low < high))
        want = suffixes.column(k, live)
        low[live], high[live] = array._bound(low[live], high[live], k, want, False), array._bound(low[live], high[live], k, want, True)
        best[live[low[live] < high[live]]] = k + 1
    return best


def benchmark_segments(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Word hashes of every item with words, made in tasks and stored: rows of at most SEGMENT_WORDS window starts.

    A row holds window - 1 words beyond its last start, so that each window of an item lies in just one row.
    """
    rows = picked(benchmark, item_col, text_col).toDF("item", "text")
    rows = rows.select(F.col("item").cast("string"), "text").distinct().withColumn("item_no", F.monotonically_increasing_id())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, begins = byte_view(batch.column(1))
            for i, j in row_blocks(begins, SHARD_BYTES):
                words, index = hashed_words(flat[begins[i] : begins[j]], begins[i : j + 1] - begins[i])
                for row in range(i, j):
                    own = words[index[row - i] : index[row - i + 1]]
                    for place in range(0, max(len(own) - window + 1, min(len(own), 1)), SEGMENT_WORDS):
                        held = own[place : place + SEGMENT_WORDS + window - 1]
                        yield pa.RecordBatch.from_pydict({
                            "item_no": batch.column(2).slice(row, 1), "item": batch.column(0).slice(row, 1), "place": pa.array([place], pa.int64()),
                            "n_words": pa.array([len(own)], pa.int64()), "words": pa.array([held.astype("<u8").tobytes()], pa.binary())})

    return stored(rows.mapInArrow(cut, _SEGMENT), "benchmark-segments")


def _blocks(segments: DataFrame, window: int) -> Iterator[Suffixes]:
    """Stored segments in blocks of about BLOCK_WORDS words; no more than one block is held here."""
    rows, size = [], 0

    def block() -> Suffixes:
        return Suffixes.joined([r.item for r in rows], [r.item_no for r in rows], np.array([r.place for r in rows], np.int64), np.array([r.n_words for r in rows], np.int64), [np.frombuffer(r.words, "<u8") for r in rows], window)

    for row in segments.toLocalIterator():
        rows.append(row)
        size += len(row.words) // 8
        if size >= BLOCK_WORDS:
            yield block()
            rows, size = [], 0
    yield block()


def _longest(doc: np.ndarray, at: np.ndarray, which: np.ndarray, suffixes: Suffixes) -> tuple[np.ndarray, ...]:
    """doc, item, words, at, place in the item of the longest verbatim match of each document and item; the earliest of equal ones.

    Windows that match side by side on one diagonal are one match, however long it is.
    """
    item, place = suffixes.item[which], suffixes.place[which]
    order = np.lexsort((at, at - place, item, doc))
    doc, at, item, place, first = doc[order], at[order], item[order], place[order], suffixes.length[which[order]]
    opens = np.ones(len(at), bool)
    opens[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(at) != 1) | (np.diff(place) != 1)
    heads = np.flatnonzero(opens)
    n = np.diff(np.append(heads, len(at))) - 1 + first[heads]
    doc, at, item, place = doc[heads], at[heads], item[heads], place[heads]
    order = np.lexsort((place, at, -n, item, doc))
    doc, at, item, place, n = doc[order], at[order], item[order], place[order], n[order]
    best = np.ones(len(doc), bool)
    best[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0)
    return doc[best], item[best], n[best], at[best], place[best]


def _merged(old: list[dict] | None, new: list[dict]) -> list[dict]:
    """The longest match of each item name, by name; the earliest of equal ones."""
    best: dict[str | None, dict] = {}
    for match in [*(old or ()), *new]:
        known = best.get(match["item"])
        if known is None or (-match["n_words"], match["at"], match["item_at"]) < (-known["n_words"], known["at"], known["item_at"]):
            best[match["item"]] = match
    return [best[x] for x in sorted(best, key=lambda x: (x is not None, x or ""))]


def _search(docs: DataFrame, suffixes: Suffixes, window: int, text_col: str) -> DataFrame:
    """docs with what one block of items hits added to _spans (runs of hit words) and _matches."""
    sent = docs.sparkSession.sparkContext.broadcast((suffixes, suffixes.sieve()))
    where = {name: k for k, name in enumerate(docs.columns)}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes, sieve = sent.value
        for batch in batches:
            flat, begins = byte_view(batch.column(where[text_col]))
            n_words, spans, matches = [], [], []
            old_spans, old_matches = batch.column(where["_spans"]).to_pylist(), batch.column(where["_matches"]).to_pylist()
            for i, j in row_blocks(begins, SHARD_BYTES):
                words, index = hashed_words(flat[begins[i] : begins[j]], begins[i : j + 1] - begins[i])
                stop = np.repeat(index[1:], np.diff(index))
                array = SuffixArray(words, stop, sieve, window)
                lo, hi = array.matches(suffixes)
                found = np.flatnonzero(lo < hi)
                at = array.position[ragged(lo[found], (hi - lo)[found])]
                which = np.repeat(found, (hi - lo)[found])
                fits = at + suffixes.length[which] <= stop[at]
                at, which = at[fits], which[fits]
                doc = np.searchsorted(index, at, "right") - 1
                known = np.array([(index[d] + x["begin"], index[d] + x["end"]) for d in range(j - i) for x in old_spans[i + d] or ()], np.int64).reshape(-1, 2)
                marks = np.zeros(len(words) + 1, np.int64)
                np.add.at(marks, np.append(at, known[:, 0]), 1)
                np.add.at(marks, np.append(at + suffixes.length[which], known[:, 1]), -1)
                hit = np.cumsum(marks[:-1]) > 0
                own, inside = [[] for _ in range(j - i)], [[] for _ in range(j - i)]
                border = np.zeros(len(hit) + 1, bool)
                border[index] = True
                opens = np.flatnonzero(hit & (border[:-1] | ~np.roll(hit, 1)))
                closes = np.flatnonzero(hit & (border[1:] | ~np.roll(hit, -1))) + 1
                for d, b, e in zip((np.searchsorted(index, opens, "right") - 1).tolist(), opens.tolist(), closes.tolist(), strict=True):
                    own[d].append({"begin": b - int(index[d]), "end": e - int(index[d])})
                for d, item, n, a, place in zip(*(x.tolist() for x in _longest(doc, at, which, suffixes)), strict=True):
                    inside[d].append({"item": suffixes.names[item], "n_words": n, "at": a - int(index[d]), "item_at": place})
                n_words.extend(np.diff(index).tolist())
                spans.extend(own)
                matches.extend(_merged(old_matches[i + d], inside[d]) for d in range(j - i))
            columns = list(batch.columns)
            columns[where["_words"]] = pa.array(n_words, pa.int64())
            columns[where["_spans"]] = pa.array(spans, _SPANS)
            columns[where["_matches"]] = pa.array(matches, _MATCHES)
            yield pa.RecordBatch.from_arrays(columns, names=list(where))

    return docs.mapInArrow(scan, docs.schema)


def _searched(docs: DataFrame, benchmark: DataFrame, window: int, id_col: str, text_col: str, item_col: str, item_text_col: str, keep: bool) -> tuple[DataFrame, list[Column]]:
    """docs with _words, _spans and _matches, and its own columns (all of them or the id) under their names."""
    columns = docs.columns
    state = neutral(docs) if keep else picked(docs, id_col, text_col).toDF("c0", "c1")
    text = f"c{columns.index(text_col)}" if keep else "c1"
    named = [F.col(k).alias(x) for k, x in zip(state.columns if keep else ["c0"], columns if keep else [id_col], strict=True)]
    state = state.withColumns({
        "_words": F.lit(None).cast("bigint"),
        "_spans": F.lit(None).cast("array<struct<begin:bigint,end:bigint>>"),
        "_matches": F.lit(None).cast("array<struct<item:string,n_words:bigint,at:bigint,item_at:bigint>>")})
    for suffixes in _blocks(benchmark_segments(benchmark, item_col, item_text_col, window), window):
        state = _search(state, suffixes, window, text)
    return state, named


def verbatim_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """id, n_words, spans and matches of each document.

    spans are the maximal runs of hit words (begin, end exclusive, counted in words of the document). matches has,
    for each item with a window in the document, its longest verbatim match: item, n_words, at (first word in the
    document) and item_at (first word in the item); the earliest of equal ones. Rows without words or without a hit
    have empty arrays. Two texts under one item id count as one item; items with a null id are one nameless item.
    Only an item longer than BLOCK_WORDS can have a match longer than told: it is searched in parts, and a match
    that runs over the end of one counts by its longer part.
    """
    state, named = _searched(docs, benchmark, window, id_col, text_col, item_col, item_text_col, False)
    return state.select(*named, F.col("_words").alias("n_words"), F.col("_spans").alias("spans"), F.col("_matches").alias("matches"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: bool = False) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256 and contaminated of each document; with keep, after all its columns.

    Words are runs of 0-9, a-z and characters beyond ASCII, after A-Z are lower-cased. A benchmark window is
    `window` consecutive words of an item, or all words of a shorter one. Items without words (null, empty) have
    none; an item with a null id hits words but is not listed; repeated items count once by id. Documents are
    scanned where they lie, in arrays of about SHARD_BYTES: nothing is shuffled, and repeated rows and ids are answered
    one by one. Null and empty texts have no words. Items become word hashes in tasks and are stored; the
    search takes them from there in blocks of about BLOCK_WORDS words, each a further pass over the rows as they stream by.
    All columns follow from the spans and matches of `verbatim_matches`.
    """
    state, named = _searched(docs, benchmark, window, id_col, text_col, item_col, item_text_col, keep)
    items = F.array_sort(F.filter(F.transform("_matches", lambda m: m["item"]), lambda x: x.isNotNull()))
    hit = F.aggregate("_spans", F.lit(0).cast("bigint"), lambda total, x: total + x["end"] - x["begin"])
    return state.select(*named, F.col("_words").alias("n_words"), hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit, with the columns they came with.

    Null and empty texts have no words and stay; long texts are searched whole; repeated ids and rows are judged
    one by one; names of other columns may clash; an empty table gives no rows, an empty benchmark keeps all.
    """
    plain = neutral(docs)
    renamed = {"id_col": options.pop("id_col", "doc_id"), "text_col": options.pop("text_col", "text")}
    at = {k: f"c{docs.columns.index(x)}" for k, x in renamed.items()}
    item_text = options.pop("item_text_col", renamed["text_col"])
    found = contamination(plain, benchmark, keep=True, item_text_col=item_text, **at, **options).where(~F.col("contaminated"))
    return found.select(*plain.columns).toDF(*docs.columns)
