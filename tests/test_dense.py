"""The dense pooled model against solutions on whole example tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foldcast.operators import dense, pooled
from foldcast.operators.folds import Rolling

ROLLING = Rolling("2019-01-07", "2020-01-06", "2020-03-02", horizon=2, step=4)
STARTS = ["2020-01-06", "2020-02-03", "2020-03-02"]


@pytest.fixture(scope="module")
def table():
    random = np.random.default_rng(4)
    days = pd.date_range("2019-01-07", periods=64, freq="7D")
    rows = []
    for s in range(12):
        for h in (1, 2):
            for k, day in enumerate(days):
                a, b = random.normal(5, 2), float(k % 5)
                y = 3 * h + 2 * a - b + random.normal() + (60 if random.random() < 0.06 else 0)
                known = day < pd.Timestamp("2020-03-16")
                rows.append((f"s{s}", (day - pd.Timedelta(days=7 * h)).date(), day.date(), h, a, None if k % 11 == 0 else b, 1.0, y if known else None))
    return pd.DataFrame(rows, columns=["series", "origin", "period", "h", "a", "b", "flat", "target"])


@pytest.fixture(scope="module")
def examples(spark, table):
    schema = "series string, origin date, period date, h int, a double, b double, flat double, target double"
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in table.itertuples(index=False)]
    return spark.createDataFrame(rows, schema).repartition(5)


def learned(table, fold, h):
    own = table[(table.h == h) & table.target.notna() & (pd.to_datetime(table.period) < STARTS[fold])]
    return np.column_stack([np.ones(len(own)), own.a, own.b.fillna(0)]), own.target.to_numpy()


def test_squared_loss_is_least_squares(table, examples):
    models = dense.fit(examples, ["a", "b", "flat"], ROLLING, loss="squared").collect()
    assert sorted((m.fold, m.h) for m in models) == [(f, h) for f in range(3) for h in (1, 2)]
    for m in models:
        x, y = learned(table, m.fold, m.h)
        want = np.linalg.lstsq(x, y, rcond=None)[0]
        assert np.allclose([m.intercept, *m.slopes], [*want, 0.0], atol=1e-6)
        assert m.n_rows == len(y) and m.iterations == 0 and m.converged
        assert np.isclose(m.sigma, (y - x @ want).std())


def test_huber_loss_settles_where_a_dense_fit_does(table, examples):
    models = dense.fit(examples, ["a", "b", "flat"], ROLLING, loss="huber").collect()
    for m in models:
        x, y = learned(table, m.fold, m.h)
        beta = np.linalg.lstsq(x, y, rcond=None)[0]
        sigma = (y - x @ beta).std()
        for _ in range(200):
            off = np.abs(y - x @ beta)
            bound = dense.HUBER_BOUND * sigma
            w = np.minimum(1, bound / np.maximum(off, 1e-12))
            sigma = np.sqrt((np.minimum(off, bound) ** 2).mean() / dense.HUBER_SHARE)
            beta = np.linalg.solve((x.T * w) @ x, (x.T * w) @ y)
        assert m.converged and 0 < m.iterations <= dense.MAX_ITERATIONS
        assert np.allclose([m.intercept, *m.slopes[:2]], beta, atol=0.15)
        assert abs(m.slopes[0] - 2) < 0.2 and abs(m.slopes[1] + 1) < 0.2


def test_forecasts_start_at_each_folds_last_origin(table, examples):
    models = dense.fit(examples, ["a", "b"], ROLLING, loss="squared")
    found = dense.forecast(examples, models, ["a", "b"], ROLLING, 7).toPandas()
    known = {(m.fold, m.h): m for m in models.collect()}
    want = {}
    for fold, start in enumerate(STARTS):
        origin = (pd.Timestamp(start) - pd.Timedelta(days=7)).date()
        for r in table[table.origin == origin].itertuples():
            m = known[fold, r.h]
            want[fold, r.series, r.period] = m.intercept + m.slopes[0] * r.a + m.slopes[1] * (0 if pd.isna(r.b) else r.b)
    got = {(r.fold, r.series, r.period): r.forecast_value for r in found.itertuples()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-8 for k in want)


def test_empty_and_unknown(examples):
    assert dense.fit(examples.filter(F.lit(False)), ["a"], ROLLING).count() == 0
    with pytest.raises(ValueError):
        dense.fit(examples, ["a"], ROLLING, loss="other")


def test_text_inputs_become_ranks(examples):
    numbers = pooled.as_numbers(examples, ["series", "a"])
    assert numbers.schema["series"].dataType.simpleString() == "double"
    assert pooled.as_numbers(examples, ["a"]) is examples
