"""Boosted trees from shared histograms against trees grown row by row."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldcast.operators import boost
from foldcast.operators.folds import Rolling

ROLLING = Rolling("2019-01-07", "2020-01-06", "2020-02-03", horizon=2, step=4)
STARTS = pd.to_datetime(["2020-01-06", "2020-02-03"])
INPUTS = ["a", "b", "flat"]


@pytest.fixture(scope="module")
def table():
    random = np.random.default_rng(11)
    days = pd.date_range("2019-01-07", periods=60, freq="7D")
    rows = []
    for s in range(6):
        for k, day in enumerate(days):
            a, b = float(random.integers(0, 12)), float(k % 5)
            y = float(round(3 * (a > 6) * b + 2 * b + random.normal() + 40 * (random.random() < 0.04), 3))
            rows.append((f"s{s}", (day - pd.Timedelta(days=7)).date(), day.date(), a,
                         None if k % 13 == 0 else b, 1.0, y if k < 58 else None))
    return pd.DataFrame(rows, columns=["series", "origin", "period", *INPUTS, "target"])


def frame(spark, table, parts):
    schema = "series string, origin date, period date, a double, b double, flat double, target double"
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in table.itertuples(index=False)]
    return spark.createDataFrame(rows, schema).repartition(parts)


@pytest.fixture(scope="module")
def fitted(spark, table):
    return boost.fit(frame(spark, table, 3), INPUTS, ROLLING, rounds=3)


def grown(x, y, checks, rounds):
    """Predictions after each round and the trees, from whole rows and plain recursion."""
    learns = ~checks
    reached = np.full(len(y), y[learns].mean())
    bound, steps = y[learns].std(), [reached.copy()]
    for _ in range(rounds):
        error, added = np.abs(y - reached)[learns].mean(), np.zeros(len(y))
        g = np.rint(np.clip((y - reached) / bound, -1, 1) * 2**20) / 2**20

        def split(rows, level):
            own = rows[learns[rows]]
            best = None
            for i in range(x.shape[1]):
                for e in range(x.max() + 1):
                    low = own[x[own, i] <= e]
                    high = own[x[own, i] > e]
                    if min(len(low), len(high)) < boost.MIN_ROWS:
                        continue
                    gain = g[low].sum()**2 / len(low) + g[high].sum()**2 / len(high) - g[own].sum()**2 / len(own)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                        best = gain, i, e
            if level == boost.DEPTH or best is None:
                added[rows] = boost.RATE * bound * g[own].mean()
                return
            _, i, e = best
            split(rows[x[rows, i] <= e], level + 1)
            split(rows[x[rows, i] > e], level + 1)

        split(np.arange(len(y)), 0)
        reached = reached + added
        bound = error
        steps.append(reached.copy())
    return steps


def test_trees_equal_plain_growth(table, fitted):
    edges, forests = fitted
    x = np.column_stack([np.where(table[c].isna(), 0, 1 + np.searchsorted(edges[i], table[c]))
                         for i, c in enumerate(INPUTS)]).astype(np.uint8)
    period = pd.to_datetime(table.period)
    for fold, start in enumerate(STARTS):
        use = (table.target.notna() & (period < start)).to_numpy()
        checks = (period[use] >= start - pd.Timedelta(days=14)).to_numpy()
        y, own = table.target[use].to_numpy(), x[use]
        steps = grown(own, y, checks, len(forests[fold].trees))
        assert forests[fold].n_rows == (~checks).sum() and forests[fold].n_validation == checks.sum()
        for k, step in enumerate(steps):
            found = forests[fold].base + sum((t.predict(own) for t in forests[fold].trees[:k]), np.zeros(len(y)))
            assert found == pytest.approx(step, abs=1e-4)
            if k < len(forests[fold].errors):
                assert forests[fold].errors[k] == pytest.approx(np.abs(y - step)[checks].mean(), abs=1e-4)
        assert forests[fold].best() == np.argmin(forests[fold].errors)


def test_trees_do_not_depend_on_the_dealing_nor_on_what_follows(spark, table, fitted):
    later = table.copy()
    later.loc[pd.to_datetime(later.period) >= STARTS[0], "target"] = 1e4
    _, other = boost.fit(frame(spark, later, 7), INPUTS, ROLLING, rounds=3)
    a, b = fitted[1][0], other[0]
    assert len(a.trees) == len(b.trees) > 0 and a.errors == b.errors
    for s, t in zip(a.trees, b.trees):
        assert (s.inputs == t.inputs).all() and (s.edges == t.edges).all() and (s.value == t.value).all()


def test_forecasts_cover_the_test_start(spark, table, fitted):
    edges, forests = fitted
    rows = boost.forecast(frame(spark, table, 2), edges, forests, INPUTS, ROLLING, 7).collect()
    assert sorted((r.fold, r.series) for r in rows) == [(f, f"s{s}") for f in (0, 1) for s in range(6)]
    told = boost.models(spark, forests).orderBy("fold").collect()
    assert [r.rounds <= r.rounds_tried <= 3 for r in told] == [True, True]


def test_nothing_to_learn_from(spark, table):
    examples = frame(spark, table, 1)
    _, none = boost.fit(examples.filter("false"), INPUTS, ROLLING)
    assert none == {}
    edges, flat = boost.fit(examples.withColumn("target", F.lit(2.0)), INPUTS, ROLLING)
    rows = boost.forecast(examples, edges, flat, INPUTS, ROLLING, 7).collect()
    assert {r.forecast_value for r in rows} == {2.0}


def test_packed_matrices():
    values = np.arange(24, dtype=np.float32).reshape(8, 3)
    column = boost._packed(values)
    assert (boost._blob(column.slice(2, 5), np.float32, 3) == values[2:7]).all()
    assert boost._blob(pa.array([], pa.binary()), np.float32, 3).shape == (0, 0)
