"""Token counts by byte-pair merging with a heap over a linked list; no identifiers are made."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.llm import pieces as P
from foldcast.llm.common import hash_spans, picked, row_blocks

#: Distinct pieces whose counts a Python worker keeps; beyond it, it starts afresh.
KEPT_PIECES = 4_000_000
BLOCK_BYTES = 6_000_000


@lru_cache(2)
def model(path: str) -> tuple[dict[tuple[int, int], tuple[int, int]], list[int], list[str]]:
    """Merges as pair -> (rank, new symbol), the symbol of each byte, and the special strings of a byte-level .json vocabulary."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = byte_letters()
    symbol = {shown[b]: b for b in range(256)}
    merges = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        new = symbol.setdefault(left + right, len(symbol))
        merges.setdefault((symbol[left], symbol[right]), (rank, new))
    return merges, list(range(256)), [x["content"] for x in spec["added_tokens"]]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


def merged_count(piece: bytes, merges: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Symbols left of a piece: pop the adjacent pair of lowest rank, join it, link its neighbours, until none is known."""
    n = len(piece)
    if n < 2:
        return n
    symbol = list(piece)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    get = merges.get
    heap = []
    for i in range(n - 1):
        if found := get((symbol[i], symbol[i + 1])):
            heap.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, a, b, new = heapq.heappop(heap)
        j = after[i]
        if symbol[i] != a or j >= n or symbol[j] != b:
            continue  # one of the two has been joined meanwhile
        symbol[i], symbol[j] = new, -1
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if found := get((new, symbol[k])):
                heapq.heappush(heap, (found[0], i, new, symbol[k], found[1]))
        h = before[i]
        if h >= 0 and (found := get((symbol[h], new))):
            heapq.heappush(heap, (found[0], h, symbol[h], new, found[1]))
    return left


class PieceCounts:
    """Counts of pieces seen by this worker, as arrays sorted by hash."""

    def __init__(self, path: str):
        self.merges, _, self.special = model(path)
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def of(self, flat: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        keys, where, back = np.unique(hash_spans(flat, begin, end), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        counts = np.zeros(len(keys), np.int32)
        counts[known] = self.counts[at[known]]
        new = np.flatnonzero(~known)
        merges = self.merges
        counts[new] = [merged_count(x, merges) for x in P.utf8_spans(flat, begin[where[new]], end[where[new]])]
        if len(new):
            fresh = len(self.keys) + len(new) > KEPT_PIECES
            keys_ = keys if fresh else np.concatenate([self.keys, keys[new]])
            counts_ = counts if fresh else np.concatenate([self.counts, counts[new]])
            order = np.argsort(keys_, kind="stable")
            self.keys, self.counts = keys_[order], counts_[order]
        return counts[back]

    def texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; a special string in a text is one token and parts what is around it."""
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            cut = [text]
            for special in self.special:
                if special in text:
                    cut = [y for x in cut for y in x.split(special)]
            extra[i] = len(cut) - 1
            parts += cut
            owner += [i] * len(cut)
        flat, begins = P.code_points(parts)
        begin, end = P.spaced_pieces(flat, begins)
        row = np.array(owner, np.int64)[np.searchsorted(begins, begin, "right") - 1] if len(begin) else np.zeros(0, np.int64)
        return extra + np.bincount(row, self.of(flat, begin, end), len(texts)).astype(np.int64)


@lru_cache(2)
def worker_counts(path: str) -> PieceCounts:
    return PieceCounts(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each row.

    Counts are those of the tokenizers library without added tokens; a special string inside a text is one
    token. Null and empty texts have none. Repeated ids and rows are counted one by one; other columns are
    ignored. Texts are cut into pieces whole, so nothing depends on their length.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_counts(vocabulary)
        for batch in batches:
            size = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            begins = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
            tokens = [np.zeros(0, np.int64)]
            for i, j in row_blocks(begins, BLOCK_BYTES):
                tokens.append(known.texts(batch.column(1).slice(i, j - i).fill_null("").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(np.concatenate(tokens))], names=[id_col, "n_bytes", "n_tokens"])

    kind = picked(docs, id_col).schema[id_col].dataType.simpleString()
    found = picked(docs, id_col, text_col).mapInArrow(count, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
