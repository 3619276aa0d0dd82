"""Filtering stages on tables at their edges: empty ones, null and repeated rows, clashing names."""

import pytest
from pyspark.sql import functions as F

from foldcast.llm import decontamination, pii, quality

ITEM = "one two three four five six seven eight nine ten eleven"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, f"Before {ITEM} after", "x"), (2, None, "x"), (3, "", None), (4, "plain words", "y"),
            (4, "plain words", "y"), (None, "mail a1@site.org", "z"), (7, "word " * 20000, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, score string").withColumn("c1", F.lit(0))


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([("a", ITEM), ("b", None), (None, "")], "item_id string, text string")


def test_decontaminated_keeps_all_but_the_hit(docs, benchmark):
    kept = decontamination.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3, 4, 4, 7]


def test_empty_tables(docs, benchmark):
    assert decontamination.decontaminated(docs.filter("false"), benchmark).count() == 0
    assert decontamination.decontaminated(docs, benchmark.filter("false")).count() == 7
    empty = pii.redacted(docs.filter("false"))
    assert empty.columns == docs.columns and empty.count() == 0


def test_redacted_keeps_rows_and_other_columns(docs):
    rows = pii.redacted(docs).collect()
    assert len(rows) == 7 and {r.text for r in rows if r.doc_id is None} == {"mail [email]"}
    assert {r.text for r in rows if r.doc_id == 2} == {None}


def test_accepted_on_edges(spark, docs):
    words = {1: "clear careful useful prose about the matter", 0: "click buy now win $$$ zzz"}
    known = spark.createDataFrame(
        [(i, f"{words[i % 2]} {i}", "s", 0) for i in range(100, 400)], docs.schema)
    labels = known.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    kept = quality.accepted(known.unionByName(docs), labels)
    assert kept.columns == docs.columns
    found = {r.doc_id for r in kept.collect()}
    assert {i for i in found if i and i >= 100} <= {i for i in range(101, 400, 2)}
    repeated = kept.filter("doc_id = 4").count()
    assert repeated in (0, 2)
    assert quality.accepted(docs.filter("false"), labels).count() == 0
