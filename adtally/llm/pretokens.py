"""Pre-tokens of many texts at once, as ragged numpy arrays of code points.

Three splitting patterns are supported, all over maximal runs of letters,
numbers, white space and other characters:

* ``gpt``: ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
* ``letters``: runs of letters alone
* ``clip``: ``'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+``, white space dropped
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import regex

from adtally.llm.wordhash import mix

OTHER, LETTER, NUMBER, SPACE, EDGE = range(5)
LONG_TEXT = 1 << 20
U64 = np.uint64


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Kind of each code point."""
    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    table = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            lo, hi = ord(every[m.start()]), ord(every[m.end() - 1])
            table[lo : hi + 1] = kind
    table[0xD800:0xE000] = OTHER
    return table


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    r = 0x9E3779B97F4A7C15 | 1
    n = 1 << 16
    up, down = np.full(n, r, U64), np.full(n, pow(r, -1, 1 << 64), U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def cut_long(text: str, limit: int = LONG_TEXT) -> list[str]:
    """``text`` in parts, cut only before a space between two letters: no pre-token spans a cut."""
    if len(text) <= limit:
        return [text]
    parts, lo = [], 0
    while len(text) - lo > limit:
        at = text.find(" ", lo + limit)
        while at >= 0 and not (at + 1 < len(text) and text[at - 1].isalpha() and text[at + 1].isalpha()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        parts.append(text[lo:at])
        lo = at
    return [*parts, text[lo:]]


def clip_normal(text: str) -> str:
    """NFC, then lower case character by character, as the vocabulary's normalizer does.

    White space need not be folded to one space: this pattern drops all of it.
    """
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    if "Σ" in text:  # str.lower() would look at its place in the word
        text = text.replace("Σ", "σ")
    return text.lower()


class Pieces:
    """Pre-tokens of ``units``: code points, start and end of each piece, and the pieces of each unit."""

    def __init__(self, units: list[str], pattern: str):
        joined = "\0".join(units)
        self.points = points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + 1) - 1
        kinds = _kinds()[points]
        kinds[ends[:-1]] = EDGE
        start, end = {"gpt": _gpt, "clip": _clip, "letters": _letters}[pattern](points, kinds)
        order = np.argsort(start, kind="stable")
        self.start, self.end = start[order], end[order]
        self.first = np.concatenate([[0], np.searchsorted(self.start, ends, side="left")])
        self.first[-1] = len(self.start)

    def text(self, i: int) -> str:
        return self.points[self.start[i] : self.end[i]].tobytes().decode("utf-32-le")

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code of each piece, 64-bit hash of each code, and one piece that has it."""
        codes, hashes = pd.factorize(self._hashes())
        one = np.empty(len(hashes), np.int64)
        one[codes[::-1]] = np.arange(len(codes))[::-1]
        return codes, hashes, one

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), U64)
        up, down = _powers()
        at, limit = 0, len(up)
        while at < len(out):
            base = self.start[at]
            to = max(int(np.searchsorted(self.end, base + limit, side="right")), at + 1)
            size = int(self.end[to - 1] - base)
            if size > limit:  # one very long piece
                out[at] = hash(self.text(at)) & 0xFFFFFFFFFFFFFFFF
            else:
                total = np.zeros(size + 1, U64)
                np.cumsum((self.points[base : base + size].astype(U64) + U64(1)) * up[:size], out=total[1:])
                s, e = self.start[at:to] - base, self.end[at:to] - base
                out[at:to] = mix((total[e] - total[s]) * down[s] + ((e - s).astype(U64) << U64(48)))
            at = to
        return out


def _runs(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(kinds) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint8)
    start = np.concatenate([[0], np.flatnonzero(kinds[1:] != kinds[:-1]) + 1])
    return start, np.append(start[1:], len(kinds)), kinds[start]


def _contractions(points: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Letters after it that a run of one apostrophe takes along: 0, 1 or 2."""
    take = np.zeros(len(start), np.int64)
    i = np.flatnonzero((kind == OTHER) & (end - start == 1) & (points[start] == 39))
    i = i[i + 1 < len(start)]
    i = i[kind[i + 1] == LETTER]
    a = points[end[i]]
    longer = end[i + 1] - start[i + 1] > 1
    b = np.where(longer, points[np.minimum(end[i] + 1, len(points) - 1)], 0)
    one = (a == ord("s")) | (a == ord("t")) | (a == ord("m")) | (a == ord("d"))
    two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    take[i] = np.where(one, 1, np.where(two, 2, 0))
    return take


def _gpt(points: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, kind = _runs(kinds)
    if len(start) == 0:
        return start, end
    solid = kind <= NUMBER
    before_is_space = np.concatenate([[False], (kind[:-1] == SPACE) & (points[end[:-1] - 1] == 32)])
    lead = solid & before_is_space
    take = _contractions(points, start, end, kind)
    take[lead] = 0
    eaten = np.concatenate([[0], take[:-1]])
    s, e = start - lead + eaten, end + take
    keep = solid & (s < e)
    # White space: whole at the end of a text, else its last character stands apart or leads the next run.
    blank = np.flatnonzero(kind == SPACE)
    last = np.append(kind[1:], EDGE)[blank] == EDGE
    rest = blank[~last]
    body = rest[end[rest] - start[rest] > 1]
    single = rest[points[end[rest] - 1] != 32]
    starts = [s[keep], start[blank[last]], start[body], end[single] - 1]
    ends = [e[keep], end[blank[last]], end[body] - 1, end[single]]
    return np.concatenate(starts), np.concatenate(ends)


def _clip(points: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, kind = _runs(kinds)
    if len(start) == 0:
        return start, end
    take = _contractions(points, start, end, kind)
    eaten = np.concatenate([[0], take[:-1]])
    s, e = start + eaten, end + take
    keep = ((kind == OTHER) | (kind == LETTER)) & (s < e)
    digits = np.flatnonzero(kinds == NUMBER)
    return np.concatenate([s[keep], digits]), np.concatenate([e[keep], digits + 1])


def _letters(points: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, kind = _runs(kinds)
    return start[kind == LETTER], end[kind == LETTER]
