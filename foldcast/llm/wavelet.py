"""Token identifiers as wavelet matrices: one self-contained compressed file per shard of consecutive documents."""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldcast.llm import pieces as P
from foldcast.llm.common import byte_view, hash_spans, picked, ragged, row_blocks, stored

MAGIC = b"WAVM"
#: A shard is closed once it holds so many identifiers.
SHARD_TOKENS = 1 << 20
#: Distinct pieces whose identifiers a Python worker keeps; beyond it, it starts afresh.
KEPT_PIECES = 3_000_000
BLOCK_BYTES = 6_000_000


class WaveletMatrix:
    """Bit planes from the highest bit down; each plane orders its values by the bit above, zeros first.

    access(i), rank(v, i), select(v, k) and count(v, lo, hi) take one step per plane.
    """

    def __init__(self, planes: np.ndarray, n: int):
        self.planes, self.n, self.bits = planes, n, len(planes)
        ones = np.bitwise_count(planes).astype(np.int64)
        self.before = np.concatenate([np.zeros((self.bits, 1), np.int64), np.cumsum(ones, axis=1)], axis=1)
        self.zeros = n - self.before[:, -1]

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        planes = np.zeros((bits, (len(values) + 63) // 64), np.uint64)
        for row in range(bits):
            bit = (values >> (bits - 1 - row)) & 1 != 0
            packed = np.packbits(bit, bitorder="little")
            planes[row].view(np.uint8)[: len(packed)] = packed
            values = np.concatenate([values[~bit], values[bit]])
        return cls(planes, len(values))

    def _ones(self, row: int, i: int) -> int:
        word, rest = divmod(i, 64)
        found = int(self.before[row, word])
        return found + (int(self.planes[row, word]) & ((1 << rest) - 1)).bit_count() if rest else found

    def access(self, i: int) -> int:
        value = 0
        for row in range(self.bits):
            bit = (int(self.planes[row, i >> 6]) >> (i & 63)) & 1
            value = value << 1 | bit
            i = int(self.zeros[row]) + self._ones(row, i) if bit else i - self._ones(row, i)
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        for row in range(self.bits):
            a, b = self._ones(row, lo), self._ones(row, hi)
            if value >> (self.bits - 1 - row) & 1:
                lo, hi = int(self.zeros[row]) + a, int(self.zeros[row]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, value: int, lo: int, hi: int) -> int:
        """Occurrences of value in positions lo .. hi - 1."""
        lo, hi = self._range(value, lo, hi)
        return hi - lo

    def rank(self, value: int, i: int) -> int:
        return self.count(value, 0, i)

    def select(self, value: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of value; -1 if there are fewer."""
        lo, hi = self._range(value, 0, self.n)
        at = lo + k
        if k < 0 or at >= hi:
            return -1
        for row in reversed(range(self.bits)):
            bit = value >> (self.bits - 1 - row) & 1
            target = at - int(self.zeros[row]) if bit else at
            low, high = 0, self.n - 1
            while low < high:  # the first position whose bit is the target's occurrence
                mid = (low + high) // 2
                ones = self._ones(row, mid + 1)
                if (ones if bit else mid + 1 - ones) > target:
                    high = mid
                else:
                    low = mid + 1
            at = low
        return at

    def decode(self) -> np.ndarray:
        """All values in order, from the lowest plane up."""
        values = np.zeros(self.n, np.uint32 if self.bits > 16 else np.uint16)
        for row in reversed(range(self.bits)):
            bit = np.unpackbits(self.planes[row].view(np.uint8), count=self.n, bitorder="little").astype(bool)
            zeros = int(self.zeros[row])
            above = np.empty_like(values)
            above[~bit] = values[:zeros]
            above[bit] = values[zeros:] | values.dtype.type(1 << (self.bits - 1 - row))
            values = above
        return values

    def to_bytes(self) -> bytes:
        """Header (magic, bits, n) and the planes, compressed."""
        return MAGIC + struct.pack("<BQ", self.bits, self.n) + zstandard.ZstdCompressor(level=1).compress(self.planes.tobytes())

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        bits, n = struct.unpack("<BQ", blob[4:13])
        words = (n + 63) // 64
        raw = zstandard.ZstdDecompressor().decompress(blob[13:], max_output_size=max(1, bits * words * 8))
        return cls(np.frombuffer(raw, np.uint64).reshape(bits, words), n)


@lru_cache(1)
def plain_points() -> tuple[np.ndarray, np.ndarray]:
    """Code points that normal form C and lower-casing treat one by one, and their lower case."""
    plain = np.zeros(0x110000, bool)
    plain[:0x300] = plain[0x2000:0x2070] = plain[0x3400:0xA000] = True
    plain[0x130] = False
    lower = np.arange(0x110000, dtype=np.uint32)
    lower[:0x300] = [ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(0x300)]
    return plain, lower


class Encoder:
    """Identifiers by the tokenizers library. Equal pieces are encoded once per worker; texts beyond the plain code points, whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())  # the same model for pieces, which are normal and cut already
        spec["normalizer"] = None
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        self.of_pieces = Tokenizer.from_str(json.dumps(spec))
        self.bits = max(1, (max(self.library.get_vocab_size(True) - 1, 2)).bit_length())
        self.dtype = np.uint32 if self.bits > 16 else np.uint16
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begins, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.dtype)

    def _known(self, flat: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where the identifiers of each piece lie in the arrays sorted by hash."""
        keys, where, back = np.unique(hash_spans(flat, begin, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > KEPT_PIECES:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        inside = np.minimum(at, max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[inside] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            texts = [flat[begin[i] : end[i]].tobytes().decode("utf-32-le", "surrogatepass") for i in where[new]]
            found = [x.ids for x in self.of_pieces.encode_batch_fast(texts, add_special_tokens=False)]
            lengths = np.array([len(x) for x in found], np.int64)
            begins = len(self.pool) + np.cumsum(lengths) - lengths
            self.pool = np.concatenate([self.pool, np.array([y for x in found for y in x], self.dtype)])
            order = np.argsort(keys_ := np.concatenate([self.keys, keys[new]]), kind="stable")
            self.keys = keys_[order]
            self.begins = np.concatenate([self.begins, begins])[order]
            self.lengths = np.concatenate([self.lengths, lengths])[order]
        return np.searchsorted(self.keys, keys)[back]

    def texts(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all texts, end_id after each, and the number of each text's (with end_id)."""
        plain, lower = plain_points()
        flat, begins = P.code_points(texts)
        odd_points = np.concatenate([[0], np.cumsum(~plain[flat], dtype=np.int64)])
        odd = odd_points[begins[1:]] > odd_points[begins[:-1]]
        for i, text in enumerate(texts):
            odd[i] |= "<|" in text and any(x in text for x in self.special)
        flat = lower[flat]
        begin, end = P.plain_pieces(flat, begins)
        row = np.searchsorted(begins, begin, "right") - 1
        keep = ~odd[row]
        begin, end, row = begin[keep], end[keep], row[keep]
        known = self._known(flat, begin, end) if len(begin) else np.zeros(0, np.int64)
        lengths = self.lengths[known]
        ids = self.pool[ragged(self.begins[known], lengths)]
        counts = np.bincount(row, lengths, len(texts)).astype(np.int64)
        whole = {int(i): self.library.encode(texts[i], add_special_tokens=False).ids for i in np.flatnonzero(odd)}
        for i, found in whole.items():
            counts[i] = len(found)
        out = np.full(int(counts.sum()) + len(texts), end_id, self.dtype)
        stops = np.cumsum(counts + 1)
        of_text = np.ones(len(out), bool)
        of_text[stops - 1] = False
        for i, found in whole.items():
            out[stops[i] - 1 - len(found) : stops[i] - 1] = found
            of_text[stops[i] - 1 - len(found) : stops[i] - 1] = False
        out[of_text] = ids
        return out, counts + 1


@lru_cache(2)
def worker_encoder(path: str) -> Encoder:
    return Encoder(path)


def write_shards(docs: DataFrame, vocabulary: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes texts, appends end_id to each, and stores shards in ascending id order.

    A row of the stored table is a shard: its place (range_no, shard_no), the ids of its documents, the end of
    each within the shard, and `file`, a wavelet matrix in its file format. The order is that of (id, identifiers), null ids first.
    Identifiers, not texts, are shuffled; the ranges come from quantiles of the ids alone, four for each shuffle
    partition, and a range is cut into shards of about SHARD_TOKENS.

    Null and empty texts have end_id alone; repeated ids and rows stand one after the other; other columns are
    ignored; an empty table gives no shards. A text is not cut: a longer one is a larger shard.
    """
    spark = docs.sparkSession
    docs = picked(docs, id_col, text_col)
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [k / ranges for k in range(1, ranges)]
    limits = docs.agg(F.percentile_approx(id_col, cuts, 20 * ranges)).first()[0] or []
    limits = np.unique(np.array(limits, np.int64))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = worker_encoder(vocabulary)
        for batch in batches:
            flat, begins = byte_view(batch.column(1))
            for i, j in row_blocks(begins, BLOCK_BYTES):
                doc = batch.column(0).slice(i, j - i)
                ids, counts = library.texts(batch.column(1).slice(i, j - i).fill_null("").to_pylist(), end_id)
                ends = np.concatenate([[0], np.cumsum(counts) * ids.itemsize]).astype(np.int32)
                blob = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(ids.tobytes())])
                at = np.searchsorted(limits, doc.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), "left").astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(at), doc.cast(pa.int64()), blob], names=["range_no", "doc", "ids"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = worker_encoder(vocabulary)
        docs_, parts, size, here, shard = [], [], 0, None, 0

        def close() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.frombuffer(b"".join(parts), library.dtype), library.bits)
            ends = np.cumsum([len(x) // np.dtype(library.dtype).itemsize for x in parts], dtype=np.int64)
            row = [{"range_no": here, "shard_no": shard, "n_ids": matrix.n, "docs": docs_, "ends": ends.tolist(), "file": matrix.to_bytes()}]
            return pa.RecordBatch.from_pylist(row, SHARDS)

        for batch in batches:
            for range_no, doc, ids in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if parts and (range_no != here or size >= SHARD_TOKENS * np.dtype(library.dtype).itemsize):
                    yield close()
                    shard = shard + 1 if range_no == here else 0
                    docs_, parts, size = [], [], 0
                here = range_no
                docs_.append(doc)
                parts.append(ids)
                size += len(ids)
        if parts:
            yield close()

    encoded = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(encode, "range_no int, doc bigint, ids binary")
    dealt = encoded.repartition("range_no").sortWithinPartitions("range_no", "doc", "ids")
    shards = dealt.mapInArrow(build, "range_no int, shard_no int, n_ids bigint, docs array<bigint>, ends array<bigint>, file binary")
    return stored(shards, "token-shards")


SHARDS = pa.schema([("range_no", pa.int32()), ("shard_no", pa.int32()), ("n_ids", pa.int64()), ("docs", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("file", pa.binary())])


def read_documents(shards: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, start, n_tokens and ids_crc32 of each document, from the files.

    start is the number of identifiers of all documents before it: sums over the ranges, whose number is a
    setting, then over the shards of a range.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix.from_bytes(row["file"]).decode().astype("<u4").tobytes()
                ends = np.array(row["ends"], np.int64)
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begins, ends, strict=True)]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["range_no"], np.int32)), pa.array(np.full(n, row["shard_no"], np.int32)), pa.array(row["docs"], pa.int64()), pa.array(begins), pa.array(ends - begins), pa.array(sums, pa.int64())],
                    names=["range_no", "shard_no", id_col, "begin", "n_tokens", "ids_crc32"],
                )

    sizes = shards.select("range_no", "shard_no", "n_ids")
    in_range = Window.partitionBy("range_no").orderBy("shard_no").rowsBetween(Window.unboundedPreceding, -1)
    of_ranges = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.groupBy("range_no").agg(F.sum("n_ids").alias("n")).select("range_no", F.coalesce(F.sum("n").over(of_ranges), F.lit(0)).alias("range_start"))
    starts = sizes.withColumn("shard_start", F.coalesce(F.sum("n_ids").over(in_range), F.lit(0))).join(ranges, "range_no")
    starts = starts.select("range_no", "shard_no", (F.col("range_start") + F.col("shard_start")).alias("base"))
    found = shards.select("range_no", "shard_no", "docs", "ends", "file").mapInArrow(decode, f"range_no int, shard_no int, `{id_col}` bigint, begin bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(starts, ["range_no", "shard_no"]).select(id_col, (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")
