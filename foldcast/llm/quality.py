"""Document quality by attention-based multiple-instance learning: passages are instances, documents are labelled bags."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.llm.common import byte_view, neutral, picked, row_blocks
from foldcast.llm.labelled import held_out, training_sample

#: Bytes of a passage. Every passage of a text is encoded; the last may be shorter.
PASSAGE_BYTES = 600
#: Documents that the model is fitted on, at most, and the longest of them in bytes.
TRAINING_ROWS = 8000
LONGEST_TRAINING_TEXT = 400_000
BLOCK_BYTES = 2_000_000

LOWER, UPPER, DIGIT, BLANK, BREAK, MARK, SIGN, BEYOND = range(8)
KIND = np.full(256, SIGN, np.uint8)
KIND[ord("a") : ord("z") + 1] = LOWER
KIND[ord("A") : ord("Z") + 1] = UPPER
KIND[ord("0") : ord("9") + 1] = DIGIT
KIND[[0x09, 0x20]] = BLANK
KIND[[0x0A, 0x0D]] = BREAK
KIND[[ord(c) for c in ".,;:?'\"-()"]] = MARK
KIND[0x80:] = BEYOND
FEATURES = 256 + 64 + 2


def passages(flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encodes every passage: roots of the shares of bytes and of pairs of byte kinds, its length, and whether it is empty.

    Returns the encodings and the index of each row's first passage (one more at the end); an empty row has one empty passage.
    """
    sizes = np.diff(begins)
    number = np.maximum(1, -(-sizes // PASSAGE_BYTES))
    index = np.concatenate([[0], np.cumsum(number)]).astype(np.int64)
    n = int(index[-1])
    out = np.zeros((n, FEATURES), np.float32)
    if len(flat):
        row = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.arange(len(flat), dtype=np.int64) - begins[row]
        passage = index[row] + inside // PASSAGE_BYTES
        size = np.bincount(passage, minlength=n).astype(np.float32)
        share = 1 / np.maximum(size, 1)[:, None]
        out[:, :256] = np.sqrt(np.bincount(passage * 256 + flat, minlength=n * 256).reshape(n, 256) * share)
        kind = KIND[flat].astype(np.int64)
        same = passage[1:] == passage[:-1]
        pair = (passage[:-1] * 64 + kind[:-1] * 8 + kind[1:])[same]
        out[:, 256:320] = np.sqrt(np.bincount(pair, minlength=n * 64).reshape(n, 64) * share)
        out[:, 320] = size / PASSAGE_BYTES
        out[:, 321] = size == 0
    else:
        out[:, 321] = 1
    return out, index


class GatedAttention:
    """h = tanh(xW + b); weight of a passage = softmax of w.(tanh(hV) * sigmoid(hU)) in its document; score = sigmoid of the weighted h."""

    def __init__(self, features: int, hidden: int = 24, gate: int = 12, seed: int = 7):
        r = np.random.default_rng(seed)
        draw = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"W": draw(features, hidden), "b": np.zeros(hidden, np.float32), "V": draw(hidden, gate), "U": draw(hidden, gate), "w": draw(gate), "c": draw(hidden), "d": np.zeros(1, np.float32)}
        self.mean, self.scale = np.zeros(features, np.float32), np.ones(features, np.float32)

    def _forward(self, x: np.ndarray, index: np.ndarray) -> dict[str, np.ndarray]:
        p, begin = self.p, index[:-1]
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        bag = np.repeat(np.arange(len(begin)), np.diff(index))
        e = np.exp(e - np.maximum.reduceat(e, begin)[bag])
        a = e / np.add.reduceat(e, begin)[bag]
        z = np.add.reduceat(a[:, None] * h, begin, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "y": y, "bag": bag}

    def score(self, x: np.ndarray, index: np.ndarray) -> np.ndarray:
        if len(index) < 2:
            return np.zeros(0)
        return self._forward((x - self.mean) / self.scale, index)["y"].astype(np.float64)

    def _gradients(self, x: np.ndarray, index: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self._forward(x, index)
        h, t, s, a, bag = f["h"], f["t"], f["s"], f["a"], f["bag"]
        out = (f["y"] - label) / len(label)
        dz = out[:, None] * p["c"]
        along = (dz[bag] * h).sum(1)
        de = a * (along - np.add.reduceat(a * along, index[:-1])[bag])
        dt, ds = de[:, None] * p["w"] * s * (1 - t * t), de[:, None] * p["w"] * t * s * (1 - s)
        dh = (a[:, None] * dz[bag] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": f["z"].T @ out, "d": out.sum(keepdims=True)}

    def fit(self, x: np.ndarray, index: np.ndarray, label: np.ndarray, rounds: int = 14, batch: int = 64, rate: float = 0.01, decay: float = 1e-4) -> GatedAttention:
        """Adam over shuffled batches of whole documents; the step shrinks to zero."""
        if not len(label):
            return self
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 0.01)
        x = (x - self.mean) / self.scale
        r, step = np.random.default_rng(11), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        total = rounds * -(-len(label) // batch)
        for _ in range(rounds):
            order = r.permutation(len(label))
            for at in range(0, len(order), batch):
                docs = np.sort(order[at : at + batch])
                sizes = np.diff(index)[docs]
                rows = np.repeat(index[docs] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                g = self._gradients(x[rows], np.concatenate([[0], np.cumsum(sizes)]), label[docs].astype(np.float32))
                step += 1
                now = rate * (1 - (step - 1) / total)
                for k, v in self.p.items():
                    grad = (g[k] + decay * v).astype(np.float32)
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad * grad
                    v -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text") -> GatedAttention:
    """Fits on a bounded sample of labelled rows, none held out; executors encode the passages. Without labelled rows scores stay near one half."""
    sample = training_sample(docs, labels, label, rows, LONGEST_TRAINING_TEXT, id_col, text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, begins = byte_view(batch.column(0))
            for i, j in row_blocks(begins, BLOCK_BYTES):
                x, index = passages(flat[begins[i] : begins[j]], begins[i : j + 1] - begins[i])
                x = x.astype(np.float16)
                blobs = [x[a:b].tobytes() for a, b in zip(index[:-1], index[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), batch.column(1).slice(i, j - i)], names=["x", "label"])

    found = sample.mapInArrow(encode, "x binary, label int").toArrow()
    order = sorted(range(found.num_rows), key=lambda i: found.column(0)[i].as_py())
    bags = [np.frombuffer(found.column(0)[i].as_py(), np.float16).reshape(-1, FEATURES) for i in order]
    label_of = np.array(found.column(1).to_pylist(), np.int64)[order] if order else np.zeros(0, np.int64)
    index = np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int64)
    x = np.concatenate(bags).astype(np.float32) if bags else np.zeros((0, FEATURES), np.float32)
    return GatedAttention(FEATURES).fit(x, index, label_of)


def scored(docs: DataFrame, model: GatedAttention, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with a column of scores in 0 to 1; null texts count as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, begins = byte_view(batch.column(at))
            parts = [np.zeros(0)]
            for i, j in row_blocks(begins, BLOCK_BYTES):
                parts.append(sent.value.score(*passages(flat[begins[i] : begins[j]], begins[i : j + 1] - begins[i])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts))], names=[*batch.schema.names, name])

    return docs.mapInArrow(score, docs.select("*", F.lit(0.0).alias(name)).schema)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted (score >= threshold) of every row.

    Null and empty texts are one empty passage and get a score like any other; repeated ids and rows are scored
    one by one; ties and other columns do not matter; an empty table gives no rows.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    found = scored(picked(docs, id_col, text_col), model, text_col)
    return found.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that score at least the threshold, with the columns they came with.

    Null and empty texts are scored as one empty passage, long ones as all their passages; a score equal to the
    threshold stays; repeated ids and rows are judged one by one; names of other columns may clash; an empty
    table gives no rows.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    found = scored(neutral(docs), model, f"c{docs.columns.index(text_col)}").where(F.col("score") >= threshold)
    return found.drop("score").toDF(*docs.columns)
