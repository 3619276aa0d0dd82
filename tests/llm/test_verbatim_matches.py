"""Longest verbatim matches of benchmark items, and where they lie, against brute force."""

import random
import re

import pytest

from foldcast.llm import decontamination

WINDOW = 10


def words(text):
    return re.findall("[a-z0-9]+", (text or "").lower())


def expected(text, items):
    own, hit, best = words(text), set(), {}
    for name, item in items:
        theirs = words(item)
        least = min(WINDOW, len(theirs))
        for i in range(len(own) if theirs else 0):
            for j in range(len(theirs)):
                if i and j and own[i - 1] == theirs[j - 1]:
                    continue
                n = 0
                while i + n < len(own) and j + n < len(theirs) and own[i + n] == theirs[j + n]:
                    n += 1
                if n >= least:
                    hit.update(range(i, i + n))
                    best[name] = min(best.get(name, (0, 0, 0)), (-n, i, j))
    spans, at = [], 0
    while at < len(own):
        end = at
        while end in hit:
            end += 1
        if end > at:
            spans.append((at, end))
        at = end + 1
    found = sorted(((k, -n, i, j) for k, (n, i, j) in best.items()), key=lambda x: (x[0] is not None, x[0] or ""))
    return len(own), spans, found


@pytest.fixture(scope="module")
def tables():
    draw = random.Random(5)
    fresh = lambda n: [f"w{draw.randrange(400)}" for _ in range(n)]
    items = [("a", fresh(60)), ("b", fresh(10)), ("c", fresh(4)), ("d", fresh(200)), (None, fresh(30)), ("e", ["rep"] * 25), ("g", [])]
    copy = dict(items)
    docs = [
        fresh(20) + copy["a"][5:45] + fresh(3) + copy["a"][20:32] + fresh(5),
        copy["b"] + copy["c"] + copy["d"][:11],
        fresh(7) + copy["d"] + copy["d"][100:],
        ["rep"] * 31 + fresh(2) + copy[None][3:20],
        copy["a"][:9] + fresh(3) + copy["b"][:9],
        [], copy["c"], fresh(300)]
    items = [(k, " ".join(x)) for k, x in items] + [("b", None), ("a", " ".join(copy["a"]))]
    texts = [(k, " ".join(x).title() + ".") for k, x in enumerate(docs)]
    return [*texts, (90, None), (91, ""), (0, texts[0][1]), (None, texts[1][1])], items


@pytest.mark.parametrize("block, segment", [(4_000_000, 50_000), (4_000_000, 3), (10, 50_000)])
def test_matches_and_places(spark, tables, monkeypatch, block, segment):
    """Segments do not show; neither do blocks, where each item lies in one."""
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    monkeypatch.setattr(decontamination, "SEGMENT_WORDS", segment)
    docs, items = tables
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id string, text string")
    rows = decontamination.verbatim_matches(left, right).collect()
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.spans], [tuple(x) for x in r.matches]) for r in rows), key=repr)
    assert got == sorted(((i, *expected(t, items)) for i, t in docs), key=repr)
    assert max(m[1] for _, _, _, found in got for m in found) == 200
    assert decontamination.verbatim_matches(left.where("false"), right).count() == 0
    assert decontamination.verbatim_matches(left, right.where("false")).where("size(matches) + size(spans) > 0").count() == 0


def test_an_item_beyond_a_block_keeps_its_hits(spark, tables, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 30)
    monkeypatch.setattr(decontamination, "SEGMENT_WORDS", 20)
    docs, items = tables
    rows = decontamination.verbatim_matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")).collect()
    got = sorted(((r.doc_id, [tuple(x) for x in r.spans], [m.item for m in r.matches]) for r in rows), key=repr)
    brute = [(i, *expected(t, items)) for i, t in docs]
    assert got == sorted(((i, spans, [m[0] for m in found]) for i, _, spans, found in brute), key=repr)
