"""Pooled boosted trees, grown for all folds together from shared gradient histograms.

Inputs are cut into quantile bins once. Every level of every round is one pass over the
examples: a task adds up, for each fold, node, input and bin, how many examples fall there
and their gradients, and one group per fold and node picks the best split. A fold learns
from targets before its validation range and stops when that range stops improving.
Tasks hold histograms (folds x nodes x inputs x bins), the driver trees; neither sees
examples. Gradients are whole multiples of a small unit, so that their sums, and with
them the trees for given bins, do not depend on how rows were dealt or on recomputed tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.operators.folds import Rolling
from foldcast.sources.scratch import cut_lineage

BINS, DEPTH, RATE, MIN_ROWS = 32, 4, 0.4, 20
# A fold is done once this many rounds have not made its validation error smaller by this share.
PATIENCE, TOLERANCE = 2, 0.002
# Rounds after which the forecasts reached so far are stored with the examples.
STORED_ROUNDS = 4
# Gradients are counted in this share of their bound, errors in this share of the spread.
UNIT = 2.0 ** -20
# What a row counts in a sum of gradients: exact in a double for up to 2 ** 15 rows at once.
ROW = 2.0 ** 37

SPLIT = "fold int, node int, input int, edge int, low bigint, low_n bigint, high bigint, high_n bigint"
MODEL = ("fold int, rounds int, rounds_tried int, stopped_early boolean, n_rows bigint, "
         "n_validation bigint, validation_error double, base double")


@dataclass
class Tree:
    """A full binary tree in heap order; ``value`` is indexed by leaf."""

    inputs: np.ndarray
    edges: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        # A node that is not split sends everything to its lower side.
        return cls(np.zeros(1 << depth, np.int64), np.full(1 << depth, 255, np.int64),
                   np.zeros(1 << depth))

    def nodes(self, x: np.ndarray, level: int) -> np.ndarray:
        """The node of each row at a level, counted from 0 there."""
        at, rows = np.ones(len(x), np.int64), np.arange(len(x))
        for _ in range(level):
            at = 2 * at + (x[rows, self.inputs[at]] > self.edges[at])
        return at - (1 << level)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(x, int(np.log2(len(self.value))))]


@dataclass
class Forest:
    """The trees of one fold and how they were reached."""

    fold: int
    base: float
    spread: float
    bound: float
    n_rows: int
    error: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    n_validation: int = 0
    active: bool = True

    def best(self) -> int:
        """Rounds kept: those of the smallest validation error, all without validation rows."""
        return int(np.argmin(self.errors)) if self.n_validation else len(self.trees)


def edges_of(examples: DataFrame, inputs: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Quantiles that cut each input into at most ``bins`` bins."""
    found = examples.approxQuantile(list(inputs), [k / bins for k in range(1, bins)], 0.001)
    return [np.unique(np.array(own, float)) for own in found]


def binned(examples: DataFrame, inputs: Sequence[str], edges: list[np.ndarray],
           keep: Sequence[str]) -> DataFrame:
    """The kept columns and ``x``, one byte per input: 0 if unknown, else its bin from 1."""
    schema = examples.select(*keep).schema.add("x", "binary")
    names, width = schema.names, len(inputs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros((batch.num_rows, width), np.uint8)
            for k in range(width):
                v = batch.column(k).to_numpy(zero_copy_only=False).astype(float)
                x[:, k] = np.where(np.isnan(v), 0, 1 + np.searchsorted(edges[k], v))
            yield pa.RecordBatch.from_arrays([*batch.columns[width:], _packed(x)], names=names)

    source = examples.select(*[F.col(c).cast("double").alias(f"x{i}")
                               for i, c in enumerate(inputs)], *keep)
    return source.mapInArrow(cut, schema)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1 << 15):
            yield batch.slice(start, 1 << 15)


def _blob(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    """A binary column of equally long values as a matrix, without a copy."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    if not ends[-1] - ends[0]:
        return np.zeros((len(column), 0), dtype)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(dtype).reshape(-1, width)


def _cells(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return _blob(batch.column("x"), np.uint8, width)


def _packed(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * (values.shape[1] * values.itemsize)
    data = np.ascontiguousarray(values).tobytes()
    return pa.Array.from_buffers(pa.binary(), len(values),
                                 [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def _reached(rows: DataFrame, width: int, n_folds: int, fresh: dict[int, list[Tree]]) -> DataFrame:
    """The examples with what the fresh trees add to each fold's forecast."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _cells(batch, width)
            m = _blob(batch.column("m"), np.float32, n_folds).copy()
            for fold, trees in fresh.items():
                for tree in trees:
                    m[:, fold] += tree.predict(x).astype(np.float32)
            yield batch.set_column(batch.schema.get_field_index("m"), "m", _packed(m))

    return cut_lineage(rows.mapInArrow(add, rows.schema), "boosted")


def _histograms(rows: DataFrame, width: int, n_folds: int, cells: int, level: int,
                growing: dict[int, tuple[float, float, list[Tree], Tree]]) -> DataFrame:
    """Sums of each task: fold, node (-1 for a fold's errors), v (whole numbers). A growing
    fold has a spread, a bound, trees since forecasts were stored, and the tree at hand."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        nodes = 1 << level
        for batch in _batches(batches):
            x = _cells(batch, width)
            by_input = np.ascontiguousarray(x.T)
            m = _blob(batch.column("m"), np.float32, n_folds)
            y = batch.column("target").to_numpy()
            since = batch.column("__since").to_numpy()
            learned = batch.column("__learned").to_numpy()
            for fold, (spread, bound, fresh, tree) in growing.items():
                off = y - m[:, fold]
                for earlier in fresh:
                    off -= earlier.predict(x)
                learns = learned <= fold
                if level == 0:
                    checks = (since <= fold) & ~learns
                    error = np.rint(np.abs(off) / (spread * UNIT)).astype(np.int64)
                    found = np.array([error[learns].sum(), learns.sum(),
                                      error[checks].sum(), checks.sum()], np.int64)
                    sums[fold, -1] = sums.get((fold, -1), 0) + found
                # One sum holds both: rows count ROW, and gradients never add up to half of it.
                weight = learns * (ROW + np.rint(np.clip(off / bound, -1, 1) / UNIT))
                base = tree.nodes(x, level) * cells
                both = np.empty((width, nodes, cells))
                for k in range(width):
                    both[k] = np.bincount(base + by_input[k], weight, nodes * cells).reshape(nodes, cells)
                n = np.rint(both / ROW)
                g = both - n * ROW
                pair = np.stack([n, g]).astype(np.int64)
                for node in np.flatnonzero(n[0].any(axis=1)):
                    key = (fold, int(node))
                    sums[key] = sums.get(key, 0) + pair[:, :, node].ravel()
        if sums:
            keys = np.array(list(sums), np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                 pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                names=["fold", "node", "v"])

    return rows.select("x", "target", "__since", "__learned", "m").mapInArrow(
        add, "fold int, node int, v binary")


def _splits(partial: DataFrame, width: int, cells: int) -> DataFrame:
    """The best split of every node: rows up to ``edge`` of ``input`` go low. Equal gains go
    to the first input, then to the lowest edge; input -1 means no split is left. A row of
    node -1 carries a fold's errors and counts instead."""

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v, np.int64) for v in rows.v], axis=0)
        fold, node = int(rows.fold.iloc[0]), int(rows.node.iloc[0])
        if node < 0:
            found = (fold, node, -1, -1, *map(int, total))
        else:
            n, g = total.reshape(2, width, cells)
            n_all, g_all = int(n[0].sum()), int(g[0].sum())
            n_low, g_low = np.cumsum(n, 1)[:, :-1], np.cumsum(g, 1)[:, :-1]
            n_high, g_high = n_all - n_low, g_all - g_low
            fits = (n_low >= MIN_ROWS) & (n_high >= MIN_ROWS)
            gain = np.where(fits, (g_low * UNIT) ** 2 / np.maximum(n_low, 1)
                            + (g_high * UNIT) ** 2 / np.maximum(n_high, 1)
                            - (g_all * UNIT) ** 2 / max(n_all, 1), -1.0)
            k = int(np.argmax(gain))
            i, e = divmod(k, cells - 1)
            if gain[i, e] > 1e-9:
                found = (fold, node, i, e, int(g_low[i, e]), int(n_low[i, e]),
                         int(g_high[i, e]), int(n_high[i, e]))
            else:
                found = (fold, node, -1, -1, g_all, n_all, 0, 0)
        return pd.DataFrame([found], columns=["fold", "node", "input", "edge", "low", "low_n",
                                              "high", "high_n"])

    return partial.groupBy("fold", "node").applyInPandas(best, SPLIT)


def _started(rows: DataFrame, n_folds: int) -> dict[int, Forest]:
    """Every fold with something to learn from: mean and spread of its learning targets."""
    own = rows.groupBy("__learned").agg(
        F.count("target").alias("n"),
        F.sum(F.col("target").cast("decimal(38,6)")).alias("s"),
        F.sum((F.col("target") * F.col("target")).cast("decimal(38,6)")).alias("q")).collect()
    forests = {}
    for fold in range(n_folds):
        parts = [r for r in own if r[0] <= fold]
        n = sum(r.n for r in parts)
        if not n:
            continue
        base = float(sum(r.s for r in parts)) / n
        spread = max(float(sum(r.q for r in parts)) / n - base * base, 0.0) ** 0.5
        # Targets that do not vary leave nothing to boost.
        forests[fold] = Forest(fold, base, spread or 1.0, spread or 1.0, n, active=spread > 0)
    return forests


def fit(examples: DataFrame, inputs: Sequence[str], rolling: Rolling, rounds: int = 30,
        period_col: str = "period") -> tuple[list[np.ndarray], dict[int, Forest]]:
    """Bin edges and the forest of every fold.

    ``rounds`` is an upper bound: a fold ends earlier when its validation error (mean
    absolute) has hardly improved for ``PATIENCE`` rounds, and keeps the rounds up to the
    best. Loss is Huber's, its bound the fold's last known mean absolute error. Examples
    without a target, or with one after the last test start, are not learned from; a fold
    without learning rows has no forest. Unknown inputs have a bin of their own.
    """
    spark, width = examples.sparkSession, len(inputs)
    folds = rolling.array()
    n_folds = spark.range(1).select(F.size(folds)).first()[0]

    def begun(name: str):
        starts = F.transform(folds, lambda f: f[name])
        return F.size(F.filter(starts, lambda s: s <= F.col(period_col)))

    known = examples.filter(F.col("target").isNotNull()).withColumns({
        "__since": begun("test_start_date"), "__learned": begun("val_start_date"),
        "target": F.col("target").cast("double")}).filter(F.col("__since") < n_folds)
    # What bins look like is known before the first fold is tested.
    edges = edges_of(known.filter("__learned = 0"), inputs)
    cells = 2 + max((len(e) for e in edges), default=0)
    rows = binned(known, inputs, edges, ["target", "__since", "__learned"])
    rows = cut_lineage(rows, "binned")
    forests = _started(rows, n_folds)
    # What each fold has reached for an example: one float per fold, as bytes.
    first = [forests[f].base if f in forests else 0.0 for f in range(n_folds)]
    rows = rows.withColumn("m", F.lit(np.array(first, np.float32).tobytes()))
    fresh: dict[int, list[Tree]] = {f: [] for f in forests}

    # One pass more than rounds: the first level of a round tells what the last one reached.
    for step in range(rounds + 1):
        trees = {f: Tree.empty(DEPTH) for f, forest in forests.items() if forest.active}
        for level in range(DEPTH):
            growing = {f: (forests[f].spread, forests[f].bound, fresh[f], t)
                       for f, t in trees.items()}
            if not growing:
                break
            found = _splits(_histograms(rows, width, n_folds, cells, level, growing), width,
                            cells).collect()
            for s in found:
                if s.node < 0:
                    _judge(forests[s.fold], s)
                else:
                    _grow(trees[s.fold], s, level, forests[s.fold].bound)
            if level == 0:
                trees = {f: t for f, t in trees.items() if forests[f].active and step < rounds}
        for f, t in trees.items():
            forests[f].trees.append(t)
            fresh[f].append(t)
            forests[f].bound = max(forests[f].error, forests[f].spread * 1e-6)
        if not trees:
            break
        if (step + 1) % STORED_ROUNDS == 0:
            rows = _reached(rows, width, n_folds, {f: t for f, t in fresh.items() if t})
            fresh = {f: [] for f in forests}
    return edges, forests


def _judge(forest: Forest, s) -> None:
    """Take in the errors reached so far and decide whether the fold goes on."""
    forest.n_validation = s.high_n
    forest.error = s.low / s.low_n * forest.spread * UNIT
    forest.errors.append(s.high / s.high_n * forest.spread * UNIT if s.high_n else float("nan"))
    before, recent = forest.errors[:-PATIENCE], forest.errors[-PATIENCE:]
    if s.high_n and before and min(recent) > min(before) * (1 - TOLERANCE):
        forest.active = False


def _grow(tree: Tree, s, level: int, bound: float) -> None:
    at = (1 << level) + s.node
    if s.input >= 0:
        tree.inputs[at], tree.edges[at] = s.input, s.edge
    low, high = (RATE * bound * UNIT * g / n if n else 0.0
                 for g, n in ((s.low, s.low_n), (s.high, s.high_n)))
    # Values of a level stand for all leaves below, until the next level refines them.
    below = len(tree.value) >> (level + 1)
    start = 2 * s.node * below
    tree.value[start:start + below] = low
    tree.value[start + below:start + 2 * below] = high


def models(spark, forests: dict[int, Forest]) -> DataFrame:
    """One row per fold: rounds kept and tried, whether validation ended it, counts and errors."""
    rows = [(f.fold, f.best(), len(f.trees), not f.active, f.n_rows, f.n_validation,
             float(f.errors[f.best()]) if f.n_validation else None, f.base)
            for f in forests.values()]
    return spark.createDataFrame(rows, MODEL)


def forecast(examples: DataFrame, edges: list[np.ndarray], forests: dict[int, Forest],
             inputs: Sequence[str], rolling: Rolling, days: int, series_col: str = "series",
             period_col: str = "period") -> DataFrame:
    """Forecast rows of every fold from the last origin before its test start."""
    last = F.filter(rolling.array(), lambda f: (F.col("origin") < f["test_start_date"])
                    & (F.date_add("origin", days) >= f["test_start_date"]))
    rows = examples.withColumn("__f", F.explode(last)).withColumn("fold", F.col("__f.fold"))
    rows = binned(rows, inputs, edges, ["fold", series_col, period_col])
    width = len(inputs)
    kept = {f: (forest.base, forest.trees[:forest.best()]) for f, forest in forests.items()}

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, fold = _cells(batch, width), batch.column("fold").to_numpy()
            value = np.full(len(x), np.nan)
            for f in np.unique(fold):
                if int(f) in kept:
                    base, trees = kept[int(f)]
                    own = x[fold == f]
                    value[fold == f] = sum((t.predict(own) for t in trees), np.full(len(own), base))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(value, mask=np.isnan(value))],
                names=["fold", series_col, period_col, "forecast_value"])

    schema = rows.select("fold", series_col, period_col).schema.add("forecast_value", "double")
    return rows.mapInArrow(predict, schema).filter("forecast_value IS NOT NULL").select(
        "fold", series_col, period_col, F.lit("forecast").alias("time_series_type"),
        "forecast_value",
        F.lit(None).cast("double").alias("prediction_interval_lower_bound"),
        F.lit(None).cast("double").alias("prediction_interval_upper_bound"))
