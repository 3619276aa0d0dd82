"""Repeated passages, found by a family of suffix arrays whose sizes grow geometrically."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.llm.common import byte_view, mix, picked, spread_join, stored

LENGTH = 400
#: Bytes of an anchor. Of all anchors in a string of LENGTH bytes, the one of least hash (the first of equals) stands for it.
ANCHOR = 64
#: String starts that are worked on at once; a longer text is cut into such stretches.
STRETCH = 1 << 20
#: Strings that a new batch of an index family has, and strings after which a family starts afresh at the next anchor.
BATCH_STRINGS = 20_000
FAMILY_STRINGS = 60_000
#: Different runs with one anchor, beyond which the anchor's strings are counted one by one instead of sorted in one task.
SPLIT_RUNS = 256
#: String starts, counted from the anchor, that make a cell, step by step.
CELLS = (42, 6, 1)
_RANDOM = np.random.default_rng(400)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_STEPS = _RANDOM.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(STRETCH + 2 * LENGTH, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def rolling(data: np.ndarray) -> np.ndarray:
    """Sums that give the hash of any span of up to STRETCH bytes, by span_hash."""
    up, _ = powers()
    return np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * up[: len(data)])])


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers()
    return mix((sums[end] - sums[begin]) * down[begin])


def runs(data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Maximal runs of string starts with one anchor: first and last start, hash of the anchor, hash of the run's bytes, place of the anchor.

    Equal strings have equal anchors at equal places, wherever they are; how runs are cut does not matter for that.
    """
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64))
    words = np.ndarray((n - 7,), "<u8", np.ascontiguousarray(data), strides=(1,)).copy()
    words *= np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(29)
    grams = n - anchor + 1
    h = np.zeros(grams, np.uint64)
    for k in range(anchor // 8):
        h += words[8 * k : 8 * k + grams] * _STEPS[k]
    h = mix(h)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)
    width, span = length - anchor + 1, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(place) - 1]])
    at = place[first]
    content = mix(span_hash(rolling(data), first, last + length) ^ (at - first).astype(np.uint64))
    return first, last, h[at], content, at


def stretches(size: int, length: int = LENGTH) -> Iterator[tuple[int, int]]:
    """Parts of a text, so that every string lies in one."""
    for at in range(0, max(size - length + 1, 0), STRETCH):
        yield at, min(at + STRETCH + length - 1, size)


class IndexFamily:
    """Levels of sorted strings. A batch is sorted, scanned against every level, and joins them; levels of like size merge."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.repeated: list[np.ndarray] = []
        self.size = 0

    def add(self, strings: np.ndarray) -> None:
        order = np.argsort(strings, kind="stable")
        keys, ids = strings[order], order + self.size
        self.repeated.append(np.zeros(len(strings), bool))
        marks = self.repeated[-1] if not self.size else np.concatenate(self.repeated)
        same = np.flatnonzero(keys[1:] == keys[:-1])
        marks[ids[same]] = marks[ids[same + 1]] = True
        for level, owners in self.levels:
            at = np.searchsorted(level, keys)
            hit = np.flatnonzero(level[np.minimum(at, len(level) - 1)] == keys)
            hit = hit[at[hit] < len(level)]
            marks[ids[hit]] = True
            marks[owners[at[hit]]] = True  # further equal ones of the level are marked already
        self.repeated = [marks]
        self.size += len(strings)
        self.levels.append((keys, ids))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels[-2:]
            order = np.argsort(both := np.concatenate([a, b]), kind="stable")
            self.levels[-2:] = [(both[order], np.concatenate([x, y])[order])]

    def marks(self) -> np.ndarray:
        return np.concatenate(self.repeated) if self.repeated else np.zeros(0, bool)


def strings_of(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    return np.ndarray((len(data) - length + 1,), f"S{length}", np.ascontiguousarray(data), strides=(1,))[starts]


def _anchored(docs: DataFrame) -> DataFrame:
    """Every run of every text: anchor, run (hashes), text (its number), first and last start."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "run", "text", "first", "last"]
        for batch in batches:
            flat, begins = byte_view(batch.column(1))
            texts, parts, size = batch.column(0).to_numpy(), [], 0
            for row in range(len(begins) - 1):
                whole = flat[begins[row] : begins[row + 1]]
                for a, b in stretches(len(whole)):
                    first, last, anchor, content, _ = runs(whole[a:b])
                    parts.append((anchor.view(np.int64), content.view(np.int64), np.full(len(first), texts[row]), first + a, last + a))
                    size += len(first)
                    if size > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=names)
                        parts, size = [], 0
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=names)

    return docs.select("row", "data").mapInArrow(scan, "anchor bigint, run bigint, text bigint, first bigint, last bigint")


def _packed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """columns, the number of the text, and its bytes compressed, for the shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            flat, begins = byte_view(batch.column(len(columns) + 1))
            blobs = [squeeze.compress(flat[a:b].tobytes()) for a, b in zip(begins[:-1], begins[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns) + 1], pa.array(blobs, pa.binary())], names=[*columns, "text", "packed"])

    schema = docs.select(*columns, F.lit(0).cast("bigint").alias("text"), F.lit(b"").alias("packed")).schema
    return docs.select(*columns, "row", "data").mapInArrow(pack, schema)


def _unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)


def _cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted runs of each text."""
    for batch in batches:
        for k, text in enumerate(batch.column(2).to_pylist()):
            data, runs_ = _unpacked(batch.column(0)[k].as_py()), batch.column(1)[k].as_py()
            for at in range(0, len(runs_), 2000):
                rows = [{**x, "text": text, "bytes": data[x["first"] : x["last"] + LENGTH].tobytes()} for x in runs_[at : at + 2000]]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("anchor", pa.int64()), ("run", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("many", pa.bool_()), ("text", pa.int64()), ("bytes", pa.binary())]))


def _spans(marks: np.ndarray, starts: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marked strings as stretches of consecutive starts: text, begin, end."""
    at, text = starts[marks], texts[marks]
    order = np.lexsort((at, text))
    at, text = at[order], text[order]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] > at[:-1] + 1) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    return text[first], at[first], at[last] + LENGTH


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in the order of their anchors go through index families; returns the covered spans of texts."""
    family, starts, texts, wait, waiting, last_key = IndexFamily(), [], [], [], 0, None

    def add() -> None:
        sizes = np.array([x["last"] - x["first"] + 1 for x in wait], np.int64)
        lengths = sizes + LENGTH - 1
        data = np.frombuffer(b"".join(x["bytes"] for x in wait), np.uint8)
        base = np.cumsum(lengths) - lengths
        inside = np.concatenate([np.arange(n) for n in sizes])
        family.add(strings_of(data, np.repeat(base, sizes) + inside))
        starts.append(np.repeat([x["first"] for x in wait], sizes) + inside)
        texts.append(np.repeat([x["text"] for x in wait], sizes))

    def result() -> pa.RecordBatch:
        text, begin, end = _spans(family.marks(), np.concatenate(starts), np.concatenate(texts))
        return pa.RecordBatch.from_arrays([pa.array(text), pa.array(begin), pa.array(end)], names=["text", "begin", "end"])

    for batch in batches:
        for row in batch.to_pylist():
            key = (row["anchor"], row["run"])
            if key == last_key:
                continue  # the same run of another copy of the text
            if last_key and key[0] != last_key[0] and family.size + waiting >= FAMILY_STRINGS:
                if wait:
                    add()
                yield result()
                family, starts, texts, wait, waiting = IndexFamily(), [], [], [], 0
            last_key = key
            wait.append(row)
            waiting += row["last"] - row["first"] + 1
            if waiting >= BATCH_STRINGS:
                add()
                wait, waiting = [], 0
    if wait:
        add()
    if family.size:
        yield result()


def _one_by_one(runs_: DataFrame) -> DataFrame:
    """The same for anchors with many different runs, which no task could hold together.

    Strings whose anchors stand at like places make a cell and share a core of bytes; only where the core occurs again
    can they. Cells narrow in steps to single strings, whose core is the string. Counts combine before the shuffle.
    """
    cells = runs_.select("text", F.col("first").alias("begin"), F.lit(-1).cast("bigint").alias("at"), "bytes")
    covered = None
    for size in CELLS:
        cells = stored(cells.mapInArrow(_narrowed(size), "core bigint, whole bigint, text bigint, begin bigint, at bigint, bytes binary").dropDuplicates(["core", "text", "begin"]), "cells")
        kinds = cells.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(F.struct("text", "begin")).alias("one"))
        again = kinds.groupBy("core").agg(F.sum("n").alias("all")).where("all > 1").select("core")
        cells = spread_join(cells, spread_join(kinds, again, ["core"], F.col("whole")), ["core", "whole"], F.col("text"))
        # cells that are equal as a whole are covered; one of them stays, to be compared with others
        equal = cells.where("n > 1").select("text", "begin", (F.col("begin") + F.length("bytes")).alias("end"))
        covered = equal if covered is None else covered.union(equal)
        cells = cells.where((F.col("n") == 1) | (F.struct("text", "begin") == F.col("one"))).select("text", "begin", "at", "bytes")
    return covered


def _narrowed(size: int):
    schema = pa.schema([("core", pa.int64()), ("whole", pa.int64()), ("text", pa.int64()), ("begin", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                rows = []
                for row in batch.slice(part, 500).to_pylist():
                    data = np.frombuffer(row["bytes"], np.uint8)
                    at = row["at"] if row["at"] >= 0 else int(runs(data)[4][0])  # where the anchor stands
                    last = len(data) - LENGTH
                    cell = np.arange((at - last) // size, at // size + 1)
                    begin = at - cell * size  # of the core: the last start that the cell has
                    sums, low, high = rolling(data), np.maximum(begin - size + 1, 0), np.minimum(begin, last)
                    core = mix(span_hash(sums, begin, begin + LENGTH - size + 1) + cell.astype(np.uint64)).view(np.int64)
                    whole = mix(span_hash(sums, low, high + LENGTH) + (at - low).astype(np.uint64)).view(np.int64)
                    for a, b, c, w in zip(low.tolist(), high.tolist(), core.tolist(), whole.tolist(), strict=True):
                        rows.append({"core": c, "whole": w, "text": row["text"], "begin": row["begin"] + a, "at": at - a, "bytes": row["bytes"][a : b + LENGTH]})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return cut


def covered_spans(docs: DataFrame) -> DataFrame:
    """text, begin and end of spans that cover every byte of every string that starts anywhere else too.

    docs holds texts as `data`, numbered by `row`. An anchor or a run may be that of any share of the rows: counts combine
    before the shuffle, and rows meet their count under a salt.
    """
    every = stored(_anchored(docs), "anchors", "zstd")
    again = every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    every = stored(spread_join(every, again, ["anchor"], F.col("text")), "runs")
    # runs that are equal as a whole are covered; of others, those that share an anchor are compared string by string
    kinds = every.groupBy("anchor", "run").agg(F.count("*").alias("n"), F.min(F.struct("text", "first", "last")).alias("one"))
    kinds = stored(kinds, "kinds")
    equal = spread_join(every, kinds.where("n > 1").select("anchor", "run"), ["anchor", "run"], F.col("text"))
    whole = equal.select("text", F.col("first").alias("begin"), (F.col("last") + LENGTH).alias("end"))
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    open_ = spread_join(kinds, mixed, ["anchor"], F.col("run")).select("one.text", F.struct("anchor", "run", "one.first", "one.last", (F.col("kinds") > SPLIT_RUNS).alias("many")).alias("x"))
    wanted = open_.groupBy("text").agg(F.collect_list("x").alias("runs"))
    found = _packed(docs, []).join(wanted, "text").select("packed", "runs", "text")
    found = stored(found.mapInArrow(_cut_runs, "anchor bigint, run bigint, first bigint, last bigint, many boolean, text bigint, bytes binary"), "open-runs")
    few = found.where("not many").repartition("anchor").sortWithinPartitions("anchor", "run").mapInArrow(_search, "text bigint, begin bigint, end bigint")
    return whole.union(few).union(_one_by_one(found.where("many"))).distinct()


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 of every row, and with keep also `kept`, the remaining bytes.

    A byte goes if a string of LENGTH bytes that covers it starts anywhere else too, in the same text or another.
    Null texts are empty; empty and shorter texts stay; repeated rows are copies, so all of a long one goes; other
    columns are ignored. Strings are judged on the input.

    Sparse suffixes: every string has an anchor, so only strings with an anchor that occurs again can repeat. Runs of
    strings with one anchor that are equal as a whole are settled by counting. The others are dealt out by anchor; each
    task feeds them in batches to an index family of sorted strings. An anchor with more than SPLIT_RUNS different
    runs is not gathered: its strings are counted by hash, with sums before the shuffle. Texts travel compressed, once for
    the runs in question and once for the result.
    """
    docs = picked(docs, id_col, text_col)
    # a number for each row, written with it, so that no two texts are ever taken for one and copies stay apart
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("data"), F.monotonically_increasing_id().alias("row")), "numbered", "zstd")
    spans = covered_spans(rows)
    by_text = spans.groupBy("text").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, count, sums, rest = [], [], [], [], []
            listed = pc.list_value_length(batch.column(2)).fill_null(0).to_numpy()
            upto = np.cumsum(listed)
            flat = batch.column(2).flatten()
            begins, ends = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for k in range(batch.num_rows):
                data, own = _unpacked(batch.column(1)[k].as_py()), slice(upto[k] - listed[k], upto[k])
                edge = np.bincount(begins[own], minlength=len(data) + 1) - np.bincount(ends[own], minlength=len(data) + 1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = data[~gone].tobytes()
                sizes.append(len(data))
                removed.append(int(gone.sum()))
                count.append(int((gone[1:] & ~gone[:-1]).sum() + (len(gone) and gone[0])))
                sums.append(hashlib.sha256(kept).hexdigest())
                if keep:
                    rest.append(kept)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sums, pa.string())]
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(rest, pa.binary())] * keep)], names=[*names, *(["kept"] * keep)])

    joined = _packed(rows, ["id"]).join(by_text, "text", "left").select("id", "packed", "spans")
    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(remove, f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * keep)
