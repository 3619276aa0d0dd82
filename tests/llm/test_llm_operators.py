"""The operators for training text against brute force, on small tables with every awkward case."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from foldcast.llm import decontamination, embeddings, jaccard, packing, pieces, pii, quality, suffixes, toxicity, wavelet
from foldcast.llm.common import hashed_words, neutral, picked
from foldcast.llm.shingles import shingle_sets
from foldcast.llm.token_counts import token_counts

WORDS = "alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def prose(r, n):
    return " ".join(r.choice(WORDS) + str(r.randrange(60)) * r.randrange(2) for _ in range(n))


def corpus():
    """Ids and texts: nulls, empties, repeats of rows and of ids, near copies, shared passages, one long text."""
    r = random.Random(5)
    shared = prose(r, 90)
    base = [prose(r, r.randrange(3, 260)) for _ in range(40)]
    rows = list(enumerate([None, "", " \n ", "one", "one", "A b", *base]))
    rows += [(100 + k, base[k]) for k in range(5)]
    rows += [(200 + k, base[20 + k] + " changed end") for k in range(6)]
    rows += [(300 + k, prose(r, 20) + " " + shared + " " + prose(r, 25)) for k in range(4)]
    rows += [(400, "x" * 1500), (401, "ab" * 700 + "c"), (402, prose(r, 4000)), (402, "one id, two texts"), (None, "no id"), (None, None), (7, rows[7][1])]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    clashing = "doc_id long, text string, source string, score double, node string, _row long, n_words int, c0 string, begin int"
    rows = [(i, t, None if k % 7 == 0 else f"s{k % 3}", 0.5, None, k, None, "c", 1) for k, (i, t) in enumerate(corpus())]
    return spark.createDataFrame(rows, clashing).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def rows_of(df, *columns):
    return sorted((tuple(x) for x in df.select(*columns).collect()), key=repr)


def test_token_counts_are_the_librarys(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in corpus()]
    assert rows_of(token_counts(docs, path), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert token_counts(empty, path).count() == 0


def test_token_counts_of_odd_texts(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    r = random.Random(1)
    parts = ["'", "s", "'ll", "re", " ", "  ", "\n", "\t", "a", "é", "1", "!", "?", "<|endoftext|>", "\x1c", "\x85", "漢", "😀", "'S", "\r\n", " "]
    texts = ["".join(r.choices(parts, k=r.randrange(25))) for _ in range(2000)] + ["a" * 5000, " " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows_of(token_counts(df, path), "doc_id", "n_tokens") == sorted(((i, len(library.encode(t, add_special_tokens=False).ids)) for i, t in enumerate(texts)), key=repr)


def test_new_pieces_are_encoded_at_once():
    texts = ["", "a", "é漢😀", "\ud800x", " zu\u00dfach", "\U0010ffff"]
    flat, begins = pieces.code_points(texts)
    assert pieces.utf8_spans(flat, begins[:-1], begins[1:]) == [t.encode("utf-8", "surrogatepass") for t in texts]
    assert pieces.utf8_spans(flat, begins[:0], begins[:0]) == []


def test_text_key_is_worked_out_once(spark):
    texts = [None, "", " ", "\t\x0b\f\r\n ", "A b", "ab", "a\u00a0B", "İ Σ", "ΑΣ ", "x\x1cy", "d41d8"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = F.lower(F.regexp_replace("text", r"\s+", ""))
    found = df.select(packing.normal_text_key().alias("key"), F.when(plain != "", F.md5(plain)).alias("want")).collect()
    assert [r.key for r in found] == [r.want for r in found] and [r.key is None for r in found[:5]] == [True] * 4 + [False]
    plan = spark.range(3).select(F.col("id").cast("string").alias("text")).select(packing.normal_text_key().alias("key"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == 1


def test_packing_is_whole_tight_and_free_of_conflicts(docs, empty):
    found = packing.best_fit(docs, capacity=200)
    once = {i for i, n in Counter(i for i, _ in corpus()).items() if n == 1}
    source = {r.doc_id: r.source for r in docs.collect() if r.doc_id in once}
    rows = found.collect()
    length = Counter()
    for r in rows:
        length[r.doc_id] += r.length
    want = Counter()
    for i, t in corpus():
        want[i] += -(-len((t or "").encode()) // 4)
    assert length == want
    bins = {}
    for r in rows:
        bins.setdefault(r.bin_id, []).append(r)
    for members in bins.values():
        assert sum(r.length for r in members) <= 200
        at = sorted((r.bin_offset, r.length) for r in members)
        assert all(a + n <= b for (a, n), (b, _) in zip(at, at[1:], strict=False))
        assert max(Counter(x for r in members if (x := source.get(r.doc_id))).values(), default=0) <= 1
    assert packing.best_fit(empty).count() == 0


def test_packing_by_tokens_fills_bins_with_counted_tokens(spark, docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = Counter()
    for i, t in corpus():
        want[i] += len(library.encode(t or "", add_special_tokens=False).ids)
    rows = packing.best_fit(docs, capacity=200, vocabulary=path).collect()
    length, bins = Counter(), Counter()
    for r in rows:
        length[r.doc_id] += r.length
        bins[r.bin_id] += r.length
    assert length == want and max(bins.values()) <= 200
    assert packing.best_fit(empty, vocabulary=path).count() == 0


def test_packing_keeps_near_copies_apart(spark):
    r = random.Random(3)
    base = [prose(r, 60) for _ in range(4)]
    texts = [b + f" end{k}" for b in base for k in range(5)] + ["!!!", "! !!"]
    ids = [None, None, *range(2, 20), 1, 1]
    df = spark.createDataFrame([(i, f"s{k}", t) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], "doc_id long, source string, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.best_fit(df, vocabulary=path, near=0.8).collect()
    assert len(rows) == len(texts)
    bins = {}
    for row in rows:
        bins.setdefault(row.bin_id, []).append(-1 if row.doc_id is None else 4 if row.doc_id == 1 else row.doc_id // 5)
    for members in bins.values():
        members = [0 if k == -1 else k for k in members]
        assert len(set(members)) == len(members)
    assert len(bins) == 5 and len({r.bin_id for r in packing.best_fit(df, vocabulary=path).collect()}) < 5


def test_registered_packing_and_the_stage_count_tokens(spark):
    import corpus_pipeline
    from foldcast.llm import queries

    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    counts = {r.doc_id: r.n_tokens for r in token_counts(table, public_tokenizers.path("byte_bpe_50k.json")).collect()}
    for found in (queries.op3_best_fit_packing(spark, sf), corpus_pipeline.packing_stage(spark, table, sf)):
        packed = found.toPandas()
        assert packed.groupby("doc_id").length.sum().to_dict() == counts
        assert packed.groupby("bin_id").length.sum().max() <= 2048


def test_best_fit_takes_the_tightest_compatible_bin():
    bins = packing.Bins(10)
    assert bins.place(6, 1, 0) == (0, 0) and bins.place(7, 2, 0) == (1, 0)
    assert bins.place(3, 2, 0) == (0, 6)  # bin 1 is tighter but holds the source
    assert bins.place(3, 4, 0) == (1, 7) and bins.place(1, 1, 0) == (2, 0)


def brute_links(sets, same):
    n = len(sets)
    links = [[j for j in range(n) if j != i and same(sets[i], sets[j])] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *(label[j] for j in links[i])]) for i in range(n)]
    return [len(x) for x in links], label


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_jaccard_links_and_classes(docs, empty):
    rows = corpus()
    sets = [shingles(t) for _, t in rows]
    links, label = brute_links(sets, lambda a, b: bool(a and b) and len(a & b) / len(a | b) >= 0.8)
    smallest = {k: min((i for (i, _), x in zip(rows, label, strict=True) if x == k and i is not None), default=None) for k in label}
    want = sorted(((i, smallest[k] if smallest[k] is not None else i, n) for (i, _), k, n in zip(rows, label, links, strict=True)), key=repr)
    assert rows_of(jaccard.near_duplicates(docs), "doc_id", "class_id", "n_links") == want
    assert jaccard.near_duplicates(empty).count() == 0
    kept = jaccard.deduplicated(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect() if r.text and r.text.strip()]
    assert len({label[[t for _, t in rows].index(t)] for t in texts}) == len(texts)
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3, 5, 402}


@pytest.mark.parametrize("words", [0, 1, 2, 3, 4, 5, 6])
def test_shingles_of_a_table_with_one_short_text(spark, words):
    text = " ".join(WORDS[:words])
    sets = shingle_sets(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    assert [len(x) for x in sets] == [len(shingles(text))]
    if 1 <= words <= 4:
        df = spark.createDataFrame([(7, text)], "doc_id long, text string")
        assert rows_of(jaccard.near_duplicates(df), "doc_id", "class_id", "n_links", "kept") == [(7, 7, 0, True)]


def test_jaccard_tiles_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_TEXTS", 16)
    r = random.Random(9)
    base = prose(r, 120).split(" ")
    texts = []
    for _ in range(120):
        words = list(base)
        for _ in range(r.randrange(4)):
            words[r.randrange(len(words))] = "w" + str(r.randrange(10**6))
        texts.append(" ".join(words))
    links, label = brute_links([shingles(t) for t in texts], lambda a, b: len(a & b) / len(a | b) >= 0.8)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows_of(jaccard.near_duplicates(df), "doc_id", "class_id", "n_links") == sorted(zip(range(120), label, links, strict=True), key=repr)


def test_posterior_never_drops_a_likely_pair():
    need = jaccard.least_matches(0.8, 1e-7)
    assert all(m / n < 0.8 for n, m in need.items()) and need[160] > 80


def test_embedding_links(spark):
    r = np.random.default_rng(3)
    base = r.standard_normal((60, 24))
    near = [base[k] + 0.05 * r.standard_normal(24) for k in range(20) for _ in range(2)]
    rows = [(k, v.tolist()) for k, v in enumerate([*base, *near, base[0], 3 * base[1]])]
    odd = [None, [], [0.0] * 24, [1.0, None] * 12, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    rows += [(1000 + k, v) for k, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("links", F.lit(1)).repartition(3)

    def same(a, b):
        good = [v for v in (a, b) if v and None not in v and all(np.isfinite(v)) and any(v)]
        return len(good) == 2 and len(a) == len(b) and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95

    links, label = brute_links([v for _, v in rows], same)
    want = sorted(((i, n, rows[k][0]) for (i, _), n, k in zip(rows, links, label, strict=True)), key=repr)
    found = embeddings.near_duplicates(df)
    assert rows_of(found, "vec_id", "n_links", "component_id") == want
    assert found.where("kept != (vec_id = component_id)").count() == 0
    assert embeddings.near_duplicates(df.where("false")).count() == 0


def test_embedding_blocks_and_early_stops(monkeypatch):
    monkeypatch.setattr(embeddings, "SQUARE", 7)
    r = np.random.default_rng(4)
    x = r.standard_normal((50, 40))
    x[25:] = x[:25] + 0.2 * r.standard_normal((25, 40))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for threshold in (0.5, 0.9, 0.97):
        i, j = embeddings.close_pairs(x, x, threshold, True)
        want = {(a, b) for a in range(50) for b in range(a + 1, 50) if x[a] @ x[b] >= threshold}
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and len(i) == len(want)


def repeats(texts, length=400):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append((len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("split", [256, 1])
def test_repeated_passages(docs, empty, monkeypatch, split):
    monkeypatch.setattr(suffixes, "SPLIT_RUNS", split)
    monkeypatch.setattr(suffixes, "BATCH_STRINGS", 300)
    monkeypatch.setattr(suffixes, "FAMILY_STRINGS", 2000)
    rows = corpus()
    want = sorted(((i, *x) for (i, _), x in zip(rows, repeats([t for _, t in rows]), strict=True)), key=repr)
    assert rows_of(suffixes.without_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    if split == 1:
        assert suffixes.without_repeats(empty).count() == 0


def test_stretches_of_long_texts_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "STRETCH", 700)
    rows = [x for x in corpus() if x[0] is not None and (300 <= x[0] < 402 or x[1] and len(x[1]) > 2000)]
    suffixes.powers.cache_clear()
    want = repeats([t for _, t in rows])
    data = [np.frombuffer((t or "").encode(), np.uint8) for _, t in rows]
    for d in data:
        covered = np.zeros(len(d), bool)
        for a, b in suffixes.stretches(len(d)):
            first, last, *_ = suffixes.runs(d[a:b])
            for x, y in zip(first, last, strict=True):
                covered[a + x : a + y + 1] = True
        assert covered.sum() == max(0, len(d) - 399)
    assert sum(x[1] for x in want) > 0
    suffixes.powers.cache_clear()


def test_index_family_finds_all_equal_strings():
    r = np.random.default_rng(6)
    family, every = suffixes.IndexFamily(4), []
    for n in (5, 40, 3, 17, 60, 1):
        data = r.integers(0, 3, n + 3).astype(np.uint8)
        strings = suffixes.strings_of(data, np.arange(n), 4)
        family.add(strings)
        every += [data[k : k + 4].tobytes() for k in range(n)]
    count = Counter(every)
    assert family.marks().tolist() == [count[x] > 1 for x in every]
    sizes = [len(level) for level, _ in family.levels]
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:], strict=False))


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(x) if k % 2 == 0 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(d[::-1])) % 10 == 0
            if kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))) or (kind == "card" and 16 <= len(d) <= 19 and luhn) or (kind == "phone" and 8 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def test_personal_data_base_spans(spark, docs, empty):
    r = random.Random(2)
    parts = [*"ab@@..--__%+ ()0123456789", "😀", "é", "\n", "1.2.3.4", "256.1.1.1", "4111111111111111", "4111 1111 1111 1111", "+1 (988) 555-1234", "a@b.co"]
    texts = [None, "", "+" * 300, "a" * 60000, "1" * 60000, "1 " * 20000] + ["".join(r.choices(parts, k=r.randrange(50))) for _ in range(1500)]
    found = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    assert len(found) == len(texts)
    for row in found:
        want = base_spans(texts[row.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.spans.startswith(listed)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(x[0] == k for x in want) for k in KINDS)
    assert pii.personal_data(docs).count() == len(corpus()) and pii.personal_data(empty).count() == 0


def test_contexts_discover_identifiers_and_redaction_removes_them(spark):
    texts = [f"word{k % 3}x please mail to user{k}@site.org now" for k in range(30)] + ["please mail to ref-00912-4471 now", "see chapter 12345678 please"]
    df = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, _spans long")
    spans = {r.doc_id: r.spans for r in pii.personal_data(df).collect()}
    assert spans[30] == "id:15:29" and spans[31] == "" and spans[0].startswith("email:")
    out = pii.redacted(df, length_col="_spans")
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[30].text == "please mail to [id] now" and got[3].text == "word0x please mail to [email] now" and got[31].text == texts[31]
    assert all(r._spans == len(r.text) for r in got.values())


def test_wavelet_matrix_answers():
    r = np.random.default_rng(8)
    values = np.where(r.random(1500) < 0.5, r.integers(0, 49408, 1500), r.integers(0, 6, 1500)).astype(np.uint16)
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(values, 16).to_bytes())
    assert (matrix.decode() == values).all() and [matrix.access(k) for k in range(0, 1500, 11)] == values[::11].tolist()
    places = np.flatnonzero(values == 4).tolist()
    assert [matrix.select(4, k) for k in range(-1, len(places) + 1)] == [-1, *places, -1]
    assert matrix.count(3, 100, 900) == int((values[100:900] == 3).sum()) and matrix.rank(2, 700) == int((values[:700] == 2).sum())
    assert wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(values[:0], 16).to_bytes()).decode().size == 0


def test_wavelet_shards_round_trip(docs, empty, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    monkeypatch.setattr(wavelet, "SHARD_TOKENS", 500)
    rows = sorted(((i, np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for i, t in corpus()), key=lambda x: (x[0] is not None, x[0] or 0, x[1].astype("<u2").tobytes()))
    want, start = [], 0
    for i, ids in rows:
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = wavelet.read_documents(wavelet.write_shards(docs, path))
    assert rows_of(found, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    assert wavelet.read_documents(wavelet.write_shards(empty, path)).count() == 0


def test_wavelet_encoder_on_odd_texts():
    encoder = wavelet.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    r = random.Random(4)
    parts = ["'", "s", "'ll", " ", "\n", "a", "É", "ß", "1", "!", "<|endoftext|>", "<|", "\x1c", "漢", "😀", "'S", "é", "İ", "Σ"]
    texts = ["".join(r.choices(parts, k=r.randrange(20))) for _ in range(3000)]
    ids, counts = encoder.texts(texts, 2)
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == encoder.library.encode(text, add_special_tokens=False).ids + [2]
        at += n


def contamination(rows, items, window=10):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    where = {}
    for name, text in items:
        own = words(text)
        size = min(window, len(own))
        for k in range(len(own) - size + 1 if size else 0):
            where.setdefault(tuple(own[k : k + size]), set()).add(name)
    out = []
    for i, text in rows:
        own = words(text)
        hit, found = [False] * len(own), set()
        for size in {len(x) for x in where}:
            for k in range(len(own) - size + 1):
                names = where.get(tuple(own[k : k + size]))
                if names:
                    found |= names
                    hit[k : k + size] = [True] * size
        found = sorted(str(x) for x in found if x is not None)
        out.append((i, len(own), sum(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), any(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [500_000, 20])
def test_decontamination(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    rows = corpus()
    texts = [t for _, t in rows]
    items = [(1, " ".join(texts[20].split()[2:14])), (2, "one"), (3, None), (4, ""), (None, " ".join(texts[21].split()[:10])), (10, " ".join(texts[22].split()[5:30]).upper()), (11, "alpha never seen"), (12, "a B"), (1, "no id")]
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, n_words int")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert rows_of(decontamination.contamination(docs, benchmark), *names) == contamination(rows, items)
    clean = decontamination.decontaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert rows_of(picked(clean, "doc_id", "text"), "doc_id", "text") == sorted(((i, t) for i, t in rows if not contamination([(i, t)], items)[0][5]), key=repr)
    assert decontamination.contamination(empty, benchmark).count() == 0
    assert decontamination.contamination(docs, benchmark.where("false")).where("contaminated").count() == 0


def test_longest_matches():
    text = "a b c d e f g h i j k l"
    flat = np.frombuffer(text.encode(), np.uint8)
    words, _ = hashed_words(flat, np.array([0, len(flat)]))
    hashes = words
    found = decontamination.Suffixes.of(["x"], ["c d e f nothing like this was ever seen here"], 10)
    array = decontamination.SuffixArray(hashes, np.full(len(hashes), len(hashes)), found.sieve(), 10)
    assert decontamination.longest_matches(found, array)[0] == 4


@pytest.mark.parametrize("at", ["sf0.01"])
def test_classifiers_on_held_out_rows(spark, at):
    sf = f"/root/testdata/{at}"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    for found, label, least in ((quality.quality(docs, labels), "quality", 0.93), (toxicity.toxicity(docs, labels), "toxic", 0.88)):
        assert found.count() == docs.count() and found.where("score is null or score < 0 or score > 1").count() == 0
        held = found.where("held_out").join(labels, "doc_id")
        right = held.where(F.col("predicted") == F.col(label)).count() / held.count()
        assert right >= least, (label, right)


def test_classifiers_on_awkward_rows(docs, empty):
    labels = docs.where("doc_id is not null and doc_id % 3 = 0").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"), F.lit(None).cast("string").alias("text"))
    for score in (quality.quality, toxicity.toxicity):
        assert score(docs, labels).where("score between 0 and 1").count() == len(corpus())
        assert score(docs, labels.where("false")).where("score between 0 and 1").count() == len(corpus())
        assert score(empty, labels).count() == 0
    assert quality.accepted(docs, labels, threshold=-1.0).columns == docs.columns


def test_labels_are_not_taken_from_held_out_rows(spark):
    from foldcast.llm.labelled import training_sample

    docs = spark.createDataFrame([(k, f"t{k}") for k in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    seen = {r.text for r in training_sample(docs, labels, "quality", 500, 1000).collect()}
    assert seen == {f"t{k}" for k in range(200) if zlib.crc32(str(k).encode()) % 4 != 2}


def all_segments(score):
    """Maximal segments by definition: the best of the sequence, then of what is left and right of it."""
    best = max(((sum(score[a : b + 1]), -(b - a), a, b) for a in range(len(score)) for b in range(a, len(score))), default=(0,))
    if best[0] <= 0:
        return []
    a, b = best[2], best[3]
    left, right = all_segments(score[:a]), [(x + b + 1, y + b + 1, s) for x, y, s in all_segments(score[b + 1 :])]
    return [*left, (a, b, best[0]), *right]


def test_maximal_segments():
    r = random.Random(12)
    for _ in range(300):
        score = [r.choice([-0.37, -0.37, -0.37, 1.13, 0.71]) for _ in range(r.randrange(14))]
        at = [k for k, s in enumerate(score) if s > 0]
        found = toxicity.maximal_segments(at, [score[k] for k in at], 0.37)
        assert [(a, b, pytest.approx(s)) for a, b, s in found] == all_segments(score)


def test_helpers_keep_exact_names(spark):
    df = spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, other string").toDF("doc_id", "text", "TEXT")
    assert picked(df, "text").first()[0] == "a" and neutral(df).columns == ["c0", "c1", "c2"]


def contact_texts(seed, handles):
    """60 e-mails in one context, 8 unknown identifiers there, and prose without any."""
    r = random.Random(seed)
    texts = [f"{prose(r, 12)} write to contact: {r.choice('abcdefgh')}{'xyzuvwqrst'[k % 10]}{'klmnop'[k // 10]}.{r.choice(WORDS[:4])}@mail{'.example' if seed % 2 else '7.example'}.org {prose(r, 6)}" for k in range(60)]
    found = [f"{prose(r, 9)} write to contact: {h}, {prose(r, 5)}" for h in handles]
    return texts + found + [prose(r, 30) for _ in range(40)]


@pytest.mark.parametrize("seed,handles", [(1, H := "quietfox9 8blueheron oldmill7 red6kite tall-pine12 x1 salt3marsh4 0windhover".split()), (2, H)])
def test_seeds_without_digits_and_with_them_discover_the_same(spark, seed, handles):
    texts = contact_texts(seed, handles)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in pii.personal_data(df).collect()}
    for k, text in enumerate(texts):
        spans = [x.split(":") for x in rows[k].spans.split(",") if x]
        ids = [text[int(a) : int(b)] for kind, a, b in spans if kind == "id"]
        assert ids == (handles[k - 60 : k - 59] if 60 <= k < 68 else []), text
        assert rows[k].n_email == (k < 60)
