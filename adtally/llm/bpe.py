"""Byte-pair merging over ragged arrays, and the batches of texts that feed it."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex

from adtally.llm.pretokens import Pieces, clip_normal, cut_long

CACHE_PIECES = 150_000
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + other.index(b)) for b in range(256)]


def read_vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class PairTable:
    """Rank and result of symbol pairs in an open-addressed hash table of arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray):
        bits = max(4, int(len(left) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NONE, np.int32)
        self.made = np.zeros(1 << bits, np.int32)
        keys = (left.astype(np.int64) << 32) | right
        waiting = np.arange(len(keys))
        slot = self._slot(keys)
        while len(waiting):
            free = waiting[self.keys[slot[waiting]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            at = slot[placed]
            self.keys[at], self.rank[at], self.made[at] = keys[placed], placed, made[placed]
            waiting = np.setdiff1d(waiting, placed, assume_unique=True)
            slot[waiting] = (slot[waiting] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair; an empty slot has rank NONE."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(keys)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            now = self.keys[slot[open_]]
            open_ = open_[(now != keys[open_]) & (now >= 0)]
        return slot


class RankMerger:
    """Merges all sequences in step: in each round every sequence applies its own lowest-ranked
    pair, everywhere it occurs, from left to right. Finished sequences leave the arrays."""

    def __init__(self, vocabulary: dict):
        model = vocabulary["model"]
        ids, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int32)
        self.final = np.array([ids[c + suffix] for c in letters], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        self.pairs = PairTable(left, right, np.array([ids[a + b] for a, b in merges], np.int32))

    def counts(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Symbols that are left of each sequence of ``data`` bytes; ``lengths`` are all above 0."""
        out = np.zeros(len(lengths), np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        symbol = self.inner[data]
        last = np.cumsum(lengths) - 1
        symbol[last] = self.final[data[last]]
        slot = np.zeros(len(symbol), np.int64)
        rank = np.full(len(symbol), NONE, np.int32)
        self._rank(symbol, owner, slot, rank, np.arange(len(symbol)))
        while len(symbol):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            size = np.diff(np.append(first, len(owner)))
            lowest = np.minimum.reduceat(rank, first)
            done = lowest == NONE
            if done.any():
                out[owner[first[done]]] = size[done]
                stay = np.repeat(~done, size)
                owner, symbol, slot, rank = owner[stay], symbol[stay], slot[stay], rank[stay]
                lowest, size = lowest[~done], size[~done]
                if not len(owner):
                    break
            hit = rank == np.repeat(lowest, size)
            # Of pairs that overlap each other, every second one from the left is applied.
            at = np.flatnonzero(hit)
            begin = np.concatenate([[True], np.diff(at) != 1])
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
            at = at[nth % 2 == 0]
            symbol[at] = self.pairs.made[slot[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))
            owner, symbol, slot, rank = owner[keep], symbol[keep], slot[keep], rank[keep]
            self._rank(symbol, owner, slot, rank, np.unique(np.concatenate([moved, moved[moved > 0] - 1])))
        return out

    def _rank(self, symbol, owner, slot, rank, at) -> None:
        """Look the pairs that begin at ``at`` up again."""
        rank[at] = NONE
        inside = at[at + 1 < len(symbol)]
        inside = inside[owner[inside] == owner[inside + 1]]
        slot[inside] = self.pairs.find(symbol[inside], symbol[inside + 1])
        rank[inside] = self.pairs.rank[slot[inside]]


class Encoder:
    """Runs pieces of texts through ``encode_new`` once each and remembers a bounded number of them."""

    def __init__(self, vocabulary: dict, pattern: str, normal: Callable[[str], str] | None = None, special: bool = True):
        self.special = {t["content"]: t["id"] for t in vocabulary["added_tokens"]} if special else {}
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.hint = "<|" if all(s.startswith("<|") for s in self.special) else ""
        self.pattern, self.normal = pattern, normal
        self.cache: dict = {}

    def units(self, texts: list[str]) -> tuple[list[str], np.ndarray, dict[int, int]]:
        """Texts cut at special strings and, if very long, at spaces; first unit of each text; special units."""
        units: list[str] = []
        first = np.zeros(len(texts) + 1, np.int64)
        special: dict[int, int] = {}
        for i, text in enumerate(texts):
            at = 0
            if self.hint in text:
                for m in self.split.finditer(text):
                    units += cut_long(text[at : m.start()])
                    special[len(units)] = self.special[m[0]]
                    units.append("")
                    at = m.end()
            units += cut_long(text[at:] if at else text)
            first[i + 1] = len(units)
        if self.normal:
            units = [self.normal(u) for u in units]
        return units, first, special

    def lookup(self, pieces: Pieces, hashes: np.ndarray, one: np.ndarray, encode_new: Callable) -> list:
        """The remembered value of each distinct piece; ``encode_new`` gives those of unknown ones."""
        found = [self.cache.get(h) for h in hashes.tolist()]
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            values = encode_new([pieces.text(one[i]).encode() for i in new])
            if len(self.cache) + len(new) > CACHE_PIECES:
                self.cache.clear()
            for i, v in zip(new, values, strict=True):
                found[i] = v
                if len(self.cache) < CACHE_PIECES:
                    self.cache[int(hashes[i])] = v
        return found


@lru_cache(maxsize=2)
def rank_counter(path: str) -> Callable[[list[str]], np.ndarray]:
    """Token counts of texts by rank-synchronous merging, for a vocabulary of the ``clip`` kind."""
    vocabulary = read_vocabulary(path)
    merger = RankMerger(vocabulary)
    encoder = Encoder(vocabulary, "clip", clip_normal)

    def new(pieces: list[bytes]) -> list[int]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        return merger.counts(np.frombuffer(b"".join(pieces), np.uint8), lengths).tolist()

    def count(texts: list[str]) -> np.ndarray:
        units, first, special = encoder.units(texts)
        pieces = Pieces(units, "clip")
        codes, hashes, one = pieces.distinct()
        sizes = np.array(encoder.lookup(pieces, hashes, one, new), np.int64)
        total = np.concatenate([[0], np.cumsum(sizes[codes])]) if len(codes) else np.zeros(1, np.int64)
        by_unit = np.diff(total[pieces.first])
        for unit in special:
            by_unit[unit] += 1
        running = np.concatenate([[0], np.cumsum(by_unit)])
        return running[first[1:]] - running[first[:-1]]

    return count


@lru_cache(maxsize=2)
def id_encoder(path: str, special: bool = True) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """All ids of texts, one after the other, and where each text's ids start; for a byte-level vocabulary.

    Unknown pieces are merged by the installed rank encoder over the file's own vocabulary. Without
    ``special``, strings of special tokens are plain text.
    """
    import tiktoken

    vocabulary = read_vocabulary(path)
    value = {c: b for b, c in enumerate(byte_letters())}
    ranks = {bytes(value[c] for c in word): i for word, i in vocabulary["model"]["vocab"].items()}
    single = tiktoken.Encoding("bytes", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    encoder = Encoder(vocabulary, "gpt", special=special)

    def new(pieces: list[bytes]) -> list[tuple[int, ...]]:
        return [tuple(single(p)) for p in pieces]

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        units, first, special = encoder.units(texts)
        pieces = Pieces(units, "gpt")
        codes, hashes, one = pieces.distinct()
        found = encoder.lookup(pieces, hashes, one, new)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((x for ids in found for x in ids), np.uint32, int(sizes.sum()))
        begin = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        total = np.concatenate([[0], np.cumsum(counts)]) if len(codes) else np.zeros(1, np.int64)
        ids = flat[np.repeat(begin[codes] - total[:-1], counts) + np.arange(total[-1])] if len(codes) else flat
        starts = total[pieces.first]
        if special:
            at = np.array(sorted(special))
            ids = np.insert(ids, starts[at], [special[u] for u in at.tolist()])
            starts = starts + np.searchsorted(at, np.arange(len(starts)), side="left")
        return ids, starts[first]

    return encode
