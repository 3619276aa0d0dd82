"""Toxicity by maximum-scoring segments of token log-odds, calibrated by extreme-value statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.llm.common import byte_view, hash_spans, mix, picked, row_blocks, stored, word_spans
from foldcast.llm.labelled import held_out, training_sample

#: Documents that the model is fitted on, at most, and the longest of them in bytes.
TRAINING_ROWS = 20_000
LONGEST_TRAINING_TEXT = 400_000
#: Weight of the Dirichlet prior, as a share of the tokens of each class: counts are shrunk towards the joint frequency.
PRIOR_SHARE = 0.04
#: Expected share of chance finds among the tokens that count as evidence, and the texts that a token must be in to be tested.
FALSE_SHARE = 0.25
TESTED_TEXTS = 4
#: Log-odds that evidence has at least: a common token of small effect says nothing, however sure the effect is.
LEAST_ODDS = 2.0
#: Share of evidence words in a toxic passage; it sets what any other word costs.
PASSAGE_RATE = 0.25
#: Expected number of chance passages up to which a passage is reported.
E_VALUE = 0.05
#: Lengths in bytes of the word openings that back a rare word up, longest first.
STEMS = (7, 6, 5)
#: Sampled texts from which on a word speaks for itself, evidence or not.
OWN_TEXTS = 5
BLOCK_BYTES = 4_000_000
_SIEVE = 20


def maximal_segments(at: list[int], score: list[float], cost: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, sum) of a sequence with `score` at positions `at` and -cost elsewhere.

    One scan that keeps candidate segments with the sums left and right of them; each is merged or kept once, so
    time is linear in the number of scored positions.
    """
    found: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum up to its end
    total, previous = 0.0, -1
    for p, s in zip(at, score, strict=True):
        total -= cost * (p - previous - 1)
        previous = p
        left, total = total, total + s
        if s <= 0:
            continue
        first, right = p, total
        while found:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= left:
                k -= 1
            if k < 0 or found[k][3] >= right:
                break
            first, left = found[k][0], found[k][2]
            del found[k:]
        found.append((first, p, left, right))
    return [(a, b, r - l) for a, b, l, r in found]


def tokens(low: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of every word (row 0) and of its openings of STEMS bytes (rows below; 0 where the word is not longer)."""
    out = np.zeros((1 + len(STEMS), len(first)), np.uint64)
    out[0] = hash_spans(low, first, last)
    for k, size in enumerate(STEMS, 1):
        longer = np.flatnonzero(last - first > size)
        out[k, longer] = mix(hash_spans(low, first[longer], first[longer] + size) + np.uint64(size))
    return out


@dataclass
class ToxicityModel:
    """Evidence tokens by hash, their log-odds (0: a word that its stem does not speak for), the cost of other words, and the calibration."""

    keys: np.ndarray
    odds: np.ndarray
    cost: float
    decay: float  # of the tail of a chance segment's score
    ln_k: float
    slope: float = 1.0
    offset: float = 0.0

    def sieve(self) -> np.ndarray:
        bits = np.zeros(1 << _SIEVE, bool)
        bits[self.keys >> np.uint64(64 - _SIEVE)] = True
        return bits

    def _scores(self, found: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words with evidence and their log-odds: a word's own, else that of its longest known stem."""
        known, odds = np.zeros(found.shape[1], bool), np.zeros(found.shape[1])
        for row in found:
            at = np.flatnonzero(sieve[row >> np.uint64(64 - _SIEVE)] & ~known)
            place = np.minimum(np.searchsorted(self.keys, row[at]), len(self.keys) - 1)
            good = self.keys[place] == row[at]
            known[at[good]] = True
            odds[at[good]] = self.odds[place[good]]
        at = np.flatnonzero(odds > 0)
        return at, odds[at]

    def segments(self, found: np.ndarray, index: np.ndarray, sieve: np.ndarray) -> list[list[tuple[int, int, float]]]:
        """Maximal segments of each row: first and last word, and the score in natural units above chance for the row's length."""
        out: list[list[tuple[int, int, float]]] = [[] for _ in range(len(index) - 1)]
        if not len(self.keys):
            return out
        at, odds = self._scores(found, sieve)
        edges = np.searchsorted(at, index)
        for row in np.flatnonzero(np.diff(edges)):
            a, b = edges[row], edges[row + 1]
            chance = self.ln_k + np.log(index[row + 1] - index[row])
            inside = (at[a:b] - index[row]).tolist()
            out[row] = [(x, y, self.decay * s - chance) for x, y, s in maximal_segments(inside, odds[a:b].tolist(), self.cost)]
        return out

    def evidence(self, segments: list[tuple[int, int, float]]) -> float:
        """Sum over segments of the surprise -ln(1 - exp(-E)), E = exp(-score) being the expected number of such chance segments."""
        return float(sum(-np.log(-np.expm1(-np.exp(-s))) if s < 30 else s for _, _, s in segments if s > -5))

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(evidence) + self.offset, -40, 40)))


def decay_rate(share: np.ndarray, odds: np.ndarray, cost: float) -> float:
    """The positive root of sum share * exp(x * score) = 1 over clean text, by bisection."""
    rest = max(1 - share.sum(), 1e-9)
    excess = lambda x: float((share * np.exp(x * odds)).sum() + rest * np.exp(-x * cost) - 1)
    high = 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    low = 0.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return max(high, 1e-3)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Fits on a bounded sample of labelled rows, none held out. Spark counts the words of both classes; evidence words come back.

    A token counts once a text, so that repetition is no evidence. Log-odds have a Dirichlet prior in proportion to
    the joint frequency; tokens are words and their stems, and evidence are those whose z-score keeps chance finds to FALSE_SHARE. Their number is
    bound by the sample. Without labelled rows of both classes there is no evidence and all scores are equal.
    """
    sample = training_sample(docs, labels, label, rows, LONGEST_TRAINING_TEXT, id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, begins = byte_view(batch.column(0))
            toxic = batch.column(1).to_numpy(zero_copy_only=False) > 0
            for i, j in row_blocks(begins, BLOCK_BYTES):
                own = begins[i : j + 1] - begins[i]
                low, first, last = word_spans(flat[begins[i] : begins[j]], own)
                row = np.searchsorted(own, first, "right") - 1
                found = tokens(low, first, last)
                for stem, keys in enumerate(found):
                    real = keys != 0
                    _, once = np.unique(keys[real] ^ mix(row[real].astype(np.uint64)), return_index=True)  # a token counts once a text
                    at = np.flatnonzero(real)[once]
                    kinds, back = np.unique(keys[at], return_inverse=True)
                    yes = np.bincount(back, toxic[i:j][row[at]], len(kinds)).astype(np.int64)
                    where = np.zeros(len(kinds), np.int64)
                    where[back] = at
                    stems = [pa.array(x[where].view(np.int64)) for x in found[1:]] if not stem else [pa.nulls(len(kinds), pa.int64())] * len(STEMS)
                    yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), *stems, pa.array(yes), pa.array(np.bincount(back, minlength=len(kinds)) - yes)], names=["token", *stem_names, "yes", "no"])

    stem_names = [f"stem{k}" for k in STEMS]
    counts = sample.mapInArrow(count, f"token bigint, {', '.join(f'{x} bigint' for x in stem_names)}, yes bigint, no bigint")
    counts = stored(counts.groupBy("token", *stem_names).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")), "toxic-counts")
    words = counts.where(F.col(stem_names[0]).isNotNull())
    everything = words.agg(F.sum("yes"), F.sum("no")).first()
    if not everything[0] or not everything[1]:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 0.3, 1.0, 0.0)
    n1, n0 = float(everything[0]), float(everything[1])
    joint = (F.col("yes") + F.col("no")) * F.lit(PRIOR_SHARE / (n1 + n0))
    one, zero = F.col("yes") + joint * n1, F.col("no") + joint * n0
    all1, all0 = n1 * (1 + PRIOR_SHARE), n0 * (1 + PRIOR_SHARE)
    delta = F.log(one / (all1 - one)) - F.log(zero / (all0 - zero))
    tested = (F.col("yes") + F.col("no")) >= TESTED_TEXTS
    judged = counts.withColumn("odds", delta).withColumn("z", F.when(tested, F.col("odds") / F.sqrt(1 / one + 1 / zero)))
    judged = judged.withColumn("sure", F.coalesce((F.col("z") >= _least_z(judged)) & (F.col("odds") >= LEAST_ODDS), F.lit(False)))
    sure = judged.where("sure").select("token", "odds", "no", F.col(stem_names[0]).isNotNull().alias("word"))
    evidence = sure.toArrow()
    stems = F.broadcast(sure.where(~F.col("word")).select(F.col("token").alias("stem")))
    plain = judged.where(F.col(stem_names[0]).isNotNull() & ~F.col("sure") & (F.col("yes") + F.col("no") >= OWN_TEXTS))
    plain = plain.select("token", F.explode(F.array(*stem_names)).alias("stem")).join(stems, "stem", "left_semi").select("token").distinct().toArrow()
    keys = np.concatenate([evidence.column(0).to_numpy().view(np.uint64), plain.column(0).to_numpy().view(np.uint64)])
    odds = np.concatenate([evidence.column(1).to_numpy().astype(np.float64), np.zeros(plain.num_rows)])
    order = np.argsort(keys)
    share = (evidence.column(2).to_numpy() + 0.5)[evidence.column(3).to_numpy(zero_copy_only=False)] / (n0 + 1)
    of_words = evidence.column(1).to_numpy()[evidence.column(3).to_numpy(zero_copy_only=False)]
    cost = float(-np.log((1 - PASSAGE_RATE) / (1 - min(share.sum(), PASSAGE_RATE / 2))))
    model = ToxicityModel(keys[order], odds[order], cost, decay_rate(share, of_words, cost), 0.0)
    return _calibrated(model, sample)


def _least_z(judged: DataFrame) -> float:
    """The least z at which chance finds are expected to be FALSE_SHARE of all finds at most; from a histogram in steps of 0.05."""
    bars = judged.where("z is not null").groupBy(F.floor(F.least(F.greatest("z", F.lit(0.0)), F.lit(40.0)) * 20).cast("int").alias("bar")).count().collect()
    tests, found = sum(x["count"] for x in bars), 0
    best = 40.0
    for bar in sorted(bars, key=lambda x: -x["bar"]):
        found += bar["count"]
        z = bar["bar"] / 20
        if z > 1.5 and tests * math.erfc(z / math.sqrt(2)) / 2 <= FALSE_SHARE * found:
            best = z
    return best


def _calibrated(model: ToxicityModel, sample: DataFrame) -> ToxicityModel:
    """Sets ln K from the best chance segments of clean sampled texts, then slope and offset by logistic regression on the sample."""
    got = _best(sample, model, ["label"]).toArrow()
    label, best, size = (got.column(k).to_numpy().astype(np.float64) for k in (0, 1, 2))
    chance = (label == 0) & (best > 0) & (size > 0)
    if chance.sum() >= 20:
        # the share of clean texts with a segment: 1 - exp(-K n exp(-decay * s)) at the median best score s
        s = float(np.median(best[chance]))
        above = float(((label == 0) & (best >= s)).sum()) / max(float((label == 0).sum()), 1)
        model.ln_k = float(np.log(-np.log1p(-min(above, 0.999))) + model.decay * s - np.log(np.mean(size[label == 0])))
    got = scored(sample, model, name="evidence", raw=True).select("label", "evidence").toArrow()
    y, x = got.column(0).to_numpy().astype(np.float64), np.log1p(got.column(1).to_numpy())
    a, b = 0.0, float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).sum() + 1e-3 * a, (p - y).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum()]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    model.slope, model.offset = float(a), float(b)
    return model


def _best(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The best segment's raw score and the number of words of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        sieve = model.sieve()
        for batch in batches:
            flat, begins = byte_view(batch.column(len(keep)))
            high, size = [], []
            for i, j in row_blocks(begins, BLOCK_BYTES):
                own = begins[i : j + 1] - begins[i]
                low, first, last = word_spans(flat[begins[i] : begins[j]], own)
                index = np.searchsorted(first, own)
                n = np.diff(index)
                size += n.tolist()
                for row, found in enumerate(model.segments(tokens(low, first, last), index, sieve)):
                    high.append(max(((s + model.ln_k + np.log(n[row])) / model.decay for _, _, s in found), default=0.0))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(high, pa.float64()), pa.array(size, pa.int64())], names=[*keep, "best", "size"])

    return docs.select(*keep, "text").mapInArrow(best, docs.select(*keep, F.lit(0.0).alias("best"), F.lit(0).cast("bigint").alias("size")).schema)


def scored(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "score", raw: bool = False) -> DataFrame:
    """docs with scores in 0 to 1 (raw: evidence), and `<name>_passages`: first byte, end byte and E-value of every significant passage."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    schema = docs.select("*", F.lit(0.0).alias(name), F.lit(None).cast("array<struct<begin:bigint,end:bigint,e_value:double>>").alias(f"{name}_passages")).schema
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("e_value", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        sieve = model.sieve()
        for batch in batches:
            flat, begins = byte_view(batch.column(at))
            evidence, spans = [], []
            for i, j in row_blocks(begins, BLOCK_BYTES):
                own = begins[i : j + 1] - begins[i]
                low, first, last = word_spans(flat[begins[i] : begins[j]], own)
                index = np.searchsorted(first, own)
                for row, found in enumerate(model.segments(tokens(low, first, last), index, sieve)):
                    evidence.append(model.evidence(found))
                    shift, base = index[row], own[row]
                    spans.append([{"begin": int(first[shift + a] - base), "end": int(last[shift + b] - base), "e_value": float(np.exp(-s))} for a, b, s in found if np.exp(-s) <= E_VALUE])
            x = np.array(evidence, np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(x if raw else model.probability(x)), pa.array(spans, kind)], names=[*batch.schema.names, name, f"{name}_passages"])

    return docs.mapInArrow(score, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted (score >= threshold) and passages of every row.

    Null and empty texts have no words and get the score of texts without evidence; repeated ids and rows are scored
    one by one; other columns are ignored; an empty table gives no rows.
    """
    found = scored(picked(docs, id_col, text_col), train(docs, labels, id_col=id_col, text_col=text_col), text_col)
    return found.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), F.col("score_passages").alias("passages"))
