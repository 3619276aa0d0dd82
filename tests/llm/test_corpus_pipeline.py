"""The pipeline's stages, each on its own input, against brute force."""

import public_tokenizers
import pytest
from test_llm_operators import base_spans, brute_links, contamination, shingles
from tokenizers import Tokenizer

import corpus_pipeline
from foldcast.llm import jaccard
from foldcast.llm.common import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs.toPandas())]
    for name, stage in corpus_pipeline.STAGES:
        found = stored(stage(spark, docs, SF), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert found.columns == docs.columns
        docs = found
        out.append((name, found.toPandas()))
    return out


def test_stages_and_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "personal_data", "best_fit_packing"]
    assert jaccard.THRESHOLD == 0.8


def test_quality_keeps_good_documents_and_drops_bad_ones(spark, results):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    kept = set(results[1][1].doc_id)
    good, bad = set(labels[labels == 1].index), set(labels[labels == 0].index)
    assert len(good & kept) >= 0.97 * len(good) and len(bad & kept) <= 0.2 * len(bad)


def test_one_document_of_each_group_stays(results):
    before, after = results[1][1], results[2][1]
    _, label = brute_links([shingles(t) for t in before.text], lambda a, b: bool(a and b) and len(a & b) / len(a | b) >= 0.8)
    smallest = before.assign(label=label).groupby("label").doc_id.min()
    assert sorted(after.doc_id) == sorted(smallest) and len(after) < len(before)


def test_contaminated_documents_go(spark, results):
    items = [tuple(x) for x in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before, after = results[2][1], results[3][1]
    hit = {x[0] for x in contamination(list(zip(before.doc_id, before.text, strict=True)), items) if x[5]}
    assert set(after.doc_id) == set(before.doc_id) - hit and hit


def test_personal_data_is_replaced(results):
    before, after = results[3][1], results[4][1].set_index("doc_id")
    assert set(before.doc_id) == set(after.index)
    for i, text in zip(before.doc_id, before.text, strict=True):
        assert not base_spans(after.text[i]) and after.n_chars[i] == len(after.text[i])
        if not base_spans(text) and "[id]" not in after.text[i]:
            assert after.text[i] == text


def test_packing_is_whole(results):
    before, packed = results[4][1], results[5][1]
    length = packed.groupby("doc_id").length.sum()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert (length[before.doc_id].to_numpy() == [len(library.encode(t, add_special_tokens=False).ids) for t in before.text]).all()
    assert packed.groupby("bin_id").length.sum().max() <= 2048
    placed = packed.merge(before[["doc_id", "source"]])
    assert placed.groupby(["bin_id", "source"]).doc_id.nunique().max() == 1
