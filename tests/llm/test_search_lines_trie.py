"""Ranked search, line dedup and the prefix trie against brute force, on small tables with every awkward case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldcast.llm import lines, prefixes, ranked
from foldcast.llm.common import spread_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = "alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) + str(r.randrange(60)) * r.randrange(2) for _ in range(n))


def rows_of(df, *columns):
    return sorted((tuple(x) for x in df.select(*columns).collect()), key=repr)


# ranked search


def brute_search(docs, items, top=10):
    terms = [Counter(x.translate(LOWER) for x in TERM.findall(t or "")) for _, t in docs]
    sizes = [sum(x.values()) for x in terms]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(x for c in terms for x in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= {x.translate(LOWER) for x in TERM.findall(text or "")}
    out = []
    for item, own in wanted.items():
        scores = []
        for (doc, _), c, n in zip(docs, terms, sizes, strict=True):
            m = 100 - 90 + (90 * n * n_docs) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((1000000000 * c[x]) // (1000 * c[x] + 8 * m)) for x in own if c[x])
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, doc, -score) for k, (score, _, doc) in enumerate(scores[:top])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    base = [prose(r, r.choice([3, 20, 80, 400])) for _ in range(60)]
    rows = list(enumerate([None, "", " \n ", "one", "one", "A b", "zeta " * 3000, *base]))
    rows += [(100 + k, base[3]) for k in range(15)] + [(None, base[4]), (7, base[0]), (7, base[0]), (200, prose(r, 5000))]
    items = [("a", base[3]), ("b", None), ("c", ""), ("d", "Zeta59 unknownword"), ("e", base[9][:200]), (None, "one"), ("f", "alpha"), ("f", "beta3"), ("g", "ÉPSILON épsilon7")]
    return rows, items + [(f"i{k}", prose(r, 12)) for k in range(20)]


def test_ranked_search_is_brute_force(spark, corpus):
    rows, items = corpus
    docs = spark.createDataFrame([(i, t, "s", 0.1, 3) for i, t in rows], "doc_id long, text string, item string, score double, rank int").repartition(4)
    want = brute_search(rows, items)
    found = ranked.ranked_search(docs, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc_id int"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(found, "item_id", "rank", "doc_id", "score") == want


def test_search_in_blocks_is_the_same(spark, corpus, monkeypatch):
    rows, items = corpus
    monkeypatch.setattr(ranked, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(ranked, "BLOCK_TERMS", 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    index = ranked.build_index(docs)
    few = items[:9]
    assert rows_of(ranked.search(index, spark.createDataFrame(few, "item_id string, text string"), top=3), "item_id", "rank", "doc_id", "score") == brute_search(rows, few, 3)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.ranked_search(docs.where("false"), items).count() == 0
    assert ranked.ranked_search(docs, items.where("false")).count() == 0
    assert ranked.ranked_search(docs.withColumn("text", F.lit(None).cast("string")), items).count() == 0


def test_bounds_are_never_below_scores(corpus):
    rows, items = corpus
    texts = [(t or "").encode() for _, t in rows]
    flat, begins = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    doc, term, tf, sizes = ranked.doc_terms(flat, begins)
    sketch, at = ranked.sketches(doc, term, tf, len(texts))
    terms = np.unique(term)
    weight = np.random.default_rng(1).integers(0, 9000, (len(terms), 12)).astype(np.float64)
    queries = ranked.Queries(None, terms, weight)
    queries.names = list(range(12))
    m = ranked._length_terms(sizes, 60, int(sizes.sum()))
    assert (queries.bounds(sketch, at, m) >= queries.scores(flat, begins, m)).all()


# lines


def brute_lines(rows, least=40, documents=5):
    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(LOWER)

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        parts = (text or "").split("\n")
        kept = [x for x in parts if len(key(x)) < least or len(holders[key(x)]) < documents or doc == max(holders[key(x)], key=lambda d: (d is not None, d or 0))]
        out.append((doc, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def line_corpus():
    r = random.Random(12)
    common = ["the same line in very many documents, with É and more", "x" * 40, "y" * 39, "é" * 40, "", "Ünd noch eine Zeile, die sich oft wiederholt, hier", "only in four documents, so it stays where it is"]
    rows = [(k, "\n".join(r.choice([" " + c, c.upper() if c.isascii() else c, c + "\t\r", c + "\x0b\f"]) if r.random() < 0.6 else prose(r, 9) for c in r.sample(common[:6], 4))) for k in range(30)]
    rows += [(40 + k, common[6] + "\n" + prose(r, 8)) for k in range(4)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "\r\n".join([common[0]] * 5)), (None, common[0]), (None, common[5]), (7, rows[7][1]), (7, common[1] + "\n" + common[0])]
    return rows + [(54, "\n".join(prose(r, 12) for _ in range(3000)) + "\n" + common[0]), (99, "\xa0" + common[0] + "\xa0")]


def test_common_lines_go(spark):
    rows = line_corpus()
    docs = spark.createDataFrame([(i, t, "r", 5, "k") for i, t in rows], "doc_id long, text string, row string, position int, key string").repartition(3)
    found = lines.without_common_lines(docs)
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute_lines(rows)
    assert found.where(F.sha2("kept", 256) != F.col("kept_sha256")).count() == 0
    assert lines.without_common_lines(docs.where("false")).count() == 0
    assert sum(x[2] for x in brute_lines(rows)) > 20


def test_hot_keys_meet_their_lookup_row_once(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    lookup = spark.range(0, 5000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).union(spark.createDataFrame([(1, 7)], "k long, v long"))
    assert rows_of(spread_join(rows, lookup, ["k"], F.col("id")), "id", "v") == rows_of(rows.join(lookup, "k"), "id", "v")


# conversations


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        paths[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    saved, leaves = Counter(), Counter()
    for node, own_members in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(own_members) - 1) * words
            leaves[node[:d]] += not children[node]
    out = []
    for node, own_members in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in own_members if len(paths[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own_members), len(node), parent, len(own_members), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversation_rows():
    r = random.Random(13)
    texts = ["", None, "hello there", "a  b\tc\nd", "é à", "long " * 50]
    rows = []
    for c in list(range(0, 70)) + [200, 201, 219, 5000, 5001, -3, -20, -41, 1 << 40]:
        if c % 20 == 0 and r.random() < 0.3:
            continue
        start = r.choice([None, 0, 5])
        for k in range(r.choice([1, 1, 2, 3, 4, 5, 6, 9, 13])):
            rows.append((c, start if start is None and k == 0 else (start or 0) + k + 1, r.choice(["user", "assistant", None]) if k < 2 else "user", r.choice(texts[:3] if k < 4 else texts)))
    rows += [(300, k * 100, "user", f"turn {k}") for k in range(50)] + [(301, k, "user", f"turn {k}") for k in range(50)] + [(302, k, "user", f"turn {k if k < 30 else -k}") for k in range(41)]
    rows += [(None, 1, "user", "nobody's"), (400, 1, "user", "twice"), (400, 1, "user", "twice"), (401, None, "user", "twice"), (401, 2, "user", "twice")]
    return rows


@pytest.mark.parametrize("stretch", [8, 1024])
def test_prefix_trie_is_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(prefixes, "STRETCH", stretch)
    rows = conversation_rows()
    table = spark.createDataFrame([(*x, 1, "x", 2) for x in rows], "conv_id long, turn long, role string, text string, depth int, x string, len int").repartition(4)
    found = prefixes.prefix_trie(table)
    assert found.columns == TRIE
    assert rows_of(found, *TRIE) == brute_trie(rows)


def test_trie_of_few_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefixes.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    alone = [(c, 1, "user", "x") for c in range(21, 40)]  # some of these lose their only turn and have no base
    assert rows_of(prefixes.prefix_trie(spark.createDataFrame(alone, schema)), *TRIE) == brute_trie(alone)
    gone = [x for x in alone if zlib.crc32(str(x[0]).encode()) % 4]
    assert rows_of(prefixes.prefix_trie(spark.createDataFrame(gone, schema)), *TRIE) == brute_trie(gone)
