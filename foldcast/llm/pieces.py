"""Pre-tokenization over code points: texts to pieces by vector operations, as the tokenizers' patterns cut them."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

from foldcast.llm.common import ragged

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: Fixed values of the pattern: what may follow an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point."""
    points = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000)]
    text = "".join(points)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, text):
            out[m.start() : m.end()] = kind
    out[0xD800:0xE000] = OTHER
    return out


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end, and where each begins (one more at the end)."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)]).astype(np.int64)


def utf8_spans(flat: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
    """Each span of code points as UTF-8, all encoded at once."""
    sizes = end - begin
    points = flat[ragged(begin, sizes)]
    raw = points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    upto = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
    return [raw[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)]


def runs(flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one class within one text: begin, end, class."""
    kind = classes()[flat]
    new = np.empty(len(flat), bool)
    if len(flat):
        new[0] = True
        new[1:] = kind[1:] != kind[:-1]
        new[begins[:-1][begins[:-1] < len(flat)]] = True
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(flat)), kind[first]


def contractions(flat: np.ndarray, first: np.ndarray, last: np.ndarray, kind: np.ndarray, joined: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of letter runs that a lone apostrophe precedes and an ending opens, and the ending's length."""
    lone = np.flatnonzero((kind == OTHER) & (last - first == 1) & (flat[first] == 0x27) & ~joined)
    lone = lone[(lone + 1 < len(first))]
    after = lone + 1
    same_text = np.searchsorted(begins, first[lone], "right") == np.searchsorted(begins, first[np.minimum(after, len(first) - 1)], "right")
    after = after[(kind[np.minimum(after, len(first) - 1)] == LETTER) & same_text] if len(after) else after
    length = np.zeros(len(after), np.int64)
    at, room = first[after], last[after] - first[after]
    for ending in ENDINGS:
        hit = (length == 0) & (room >= len(ending))
        for k, c in enumerate(ending):
            hit &= flat[np.minimum(at + k, len(flat) - 1)] == ord(c)
        length[hit] = len(ending)
    return after[length > 0], length[length > 0]


def spaced_pieces(flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces that take one blank before a run along; begin and end, in order. All characters are in a piece."""
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last, kind = runs(flat, begins)
    text_end = np.zeros(len(flat) + 1, bool)
    text_end[begins[1:]] = True
    space = np.flatnonzero((kind == SPACE) & ~text_end[last])  # runs of blanks that something follows
    tail = last[space] - 1
    blank = flat[tail] == 0x20
    joined = np.zeros(len(first), bool)
    joined[space[blank] + 1] = True
    cut = np.zeros(len(flat), bool)
    cut[first[~joined]] = True
    cut[tail] = True
    word, length = contractions(flat, first, last, kind, joined, begins)
    cut[first[word]] = False
    over = first[word] + length
    cut[over[over < last[word]]] = True
    at = np.flatnonzero(cut)
    return at, np.append(at[1:], len(flat))


def plain_pieces(flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of letters or of other characters, and single numbers; blanks are in no piece."""
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last, kind = runs(flat, begins)
    cut = np.zeros(len(flat), bool)
    cut[first] = True
    of = classes()[flat]
    cut[of == NUMBER] = True
    word, length = contractions(flat, first, last, kind, np.zeros(len(first), bool), begins)
    cut[first[word]] = False
    over = first[word] + length
    cut[over[over < last[word]]] = True
    at = np.flatnonzero(cut)
    end = np.append(at[1:], len(flat))
    keep = of[at] != SPACE
    return at[keep], end[keep]
