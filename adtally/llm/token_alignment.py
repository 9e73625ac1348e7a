"""Alignment of two tokenizers over the same text, and how often their ids meet.

A text's tokens under A and under B cut the same bytes. Where cumulative ends of both fall
together, the text is cut into groups: each document has a dictionary from end to token index
for either side, the intersection of their keys, sorted, slices both id lists, and every slice
expands into its links (pairs of tokens whose byte ranges overlap).

1. ``align_slices``: a task tokenizes a slice of rows, portion by portion, and writes it as one row:
   per document its counts and its distinct id pairs as places in the slice's list of distinct pairs.
2. Document counts of id pairs are summed over slices, one row per slice and pair; an id's best
   count is looked up in a table of at most one row per id of A.
3. The slice's own pairs travel back with their counts, and its documents are scored there. No
   text, no token and no document leaves its slice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.bpe import byte_letters, id_encoder, read_vocabulary
from adtally.llm.store import map_batches, written
from adtally.llm.wordhash import pack64, slices, unpack

SLICE_BYTES = 2 << 20
#: Texts that are aligned at once: a task holds some hundred bytes for each of their bytes.
PORTION_BYTES = 1 << 19
BATCH_BYTES = 1 << 19
#: Slices that are read back at once: readers hold a whole row group of them.
SLICES_AT_ONCE = 4
LOW = (1 << 32) - 1
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Pieces:
    """Byte strings of some tokens, or other short strings by number, as one flat array."""

    def __init__(self, strings: list[bytes]):
        self.size = np.fromiter(map(len, strings), np.int64, len(strings))
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, which: np.ndarray) -> np.ndarray:
        size = self.size[which]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if total < 1 << 30 else np.int64
        index = np.repeat((self.start[which] - (ends - size)).astype(kind), size)
        index += np.arange(total, dtype=kind)
        return self.flat[index]


@lru_cache(maxsize=2)
def _tokenizers(path_a: str, path_b: str):
    """Both encoders, the bytes of their tokens, and the decimal digits of ids."""
    import sentencepiece

    ids_a = read_vocabulary(path_a)["model"]["vocab"]
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    value = {c: i for i, c in enumerate(byte_letters())}
    bytes_a = [b""] * (max(ids_a.values()) + 1)
    for token, i in ids_a.items():
        bytes_a[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
    byte_piece = re.compile(r"<0x([0-9A-F]{2})>")
    names = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    bytes_b = [bytes([int(m[1], 16)]) if (m := byte_piece.fullmatch(n)) else n.replace("▁", " ").encode() for n in names]
    if max(len(bytes_a), len(bytes_b)) > 1 << 16:
        raise ValueError("vocabularies of more than 65,536 ids do not fit")
    digits = Pieces([str(i).encode() + b"," for i in range(max(len(bytes_a), len(bytes_b)))])
    return id_encoder(path_a, special=False), b, Pieces(bytes_a), Pieces(bytes_b), digits


def _encoded(texts: list[str], encoders) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Ids of the texts under A and B, one after the other, and where each text's ids start."""
    a, b = encoders[:2]
    ids, first = a([" " + t for t in texts])
    flat, count, at = [], [], 0
    while at < len(texts):  # portions bound what the library holds
        to, size = at, 0
        while to < len(texts) and (to == at or size < BATCH_BYTES):
            size += len(texts[to])
            to += 1
        found = b.encode(texts[at:to], num_threads=1)
        count += map(len, found)
        flat.append(np.fromiter(chain.from_iterable(found), np.int64))
        at = to
    none = np.zeros(0, np.int64)
    return (ids.astype(np.int64), first), (np.concatenate([none, *flat]), np.concatenate([[0], np.cumsum(count, dtype=np.int64)]))


def _whole(ids: np.ndarray, first: np.ndarray, pieces: Pieces, raw: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether each document's tokens spell its ``size`` bytes of ``raw``."""
    at = np.concatenate([[0], np.cumsum(pieces.size[ids])])[first]
    same = np.diff(at) == size
    joined = pieces.joined(ids)
    if same.all() and np.array_equal(joined, raw):
        return same
    to = np.concatenate([[0], np.cumsum(size)])
    for i in np.flatnonzero(same).tolist():
        same[i] = np.array_equal(joined[at[i] : at[i + 1]], raw[to[i] : to[i + 1]])
    return same


def _cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[int], list[int]]:
    """How many tokens of A and of B lie before each common end of one document."""
    index_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1), strict=True))
    index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1), strict=True))
    common = sorted(index_a.keys() & index_b.keys())
    return [index_a[e] for e in common], [index_b[e] for e in common]


class Aligned:
    """Groups and links of a slice of documents; those without tokens have none."""

    def __init__(self, texts: list[str], encoders):
        _, _, pieces_a, pieces_b, self.digits = encoders
        self.n = len(texts)
        some = [i for i, t in enumerate(texts) if t]
        chosen = [texts[i] for i in some]
        (ids_a, first_a), (ids_b, first_b) = _encoded(chosen, encoders)
        spelled = [b" " + t.encode() for t in chosen]
        size = np.fromiter(map(len, spelled), np.int64, len(spelled))
        raw = np.frombuffer(b"".join(spelled), np.uint8)
        # Byte-level merging keeps the bytes it starts from: of A the sizes tell.
        size_a = np.diff(np.concatenate([[0], np.cumsum(pieces_a.size[ids_a])])[first_a])
        whole = (size_a == size) & _whole(ids_b, first_b, pieces_b, raw, size)
        kept = np.flatnonzero(whole)
        self.doc = np.array(some, np.int64)[kept]  # place among all texts
        self.a, self.b = (ids[np.repeat(whole, np.diff(first))] for ids, first in ((ids_a, first_a), (ids_b, first_b)))
        self.count_a, self.count_b = (np.diff(first)[kept] for first in (first_a, first_b))
        self.first_a, self.first_b = (np.concatenate([[0], np.cumsum(n)]) for n in (self.count_a, self.count_b))
        self.end_a, self.end_b = np.cumsum(pieces_a.size[self.a]), np.cumsum(pieces_b.size[self.b])
        self.bytes = int(self.end_a[-1]) if len(self.end_a) else 0
        cuts_a, cuts_b, groups = [], [], []
        for i in range(len(kept)):
            lo_a, lo_b = int(self.first_a[i]), int(self.first_b[i])
            at_a, at_b = _cuts(self.end_a[lo_a : self.first_a[i + 1]], self.end_b[lo_b : self.first_b[i + 1]])
            cuts_a.append(np.array(at_a, np.int64) + lo_a)
            cuts_b.append(np.array(at_b, np.int64) + lo_b)
            groups.append(len(at_a))
        self.groups = np.array(groups, np.int64)
        none = np.zeros(0, np.int64)
        self.cut_a, self.cut_b = np.concatenate([none, *cuts_a]), np.concatenate([none, *cuts_b])

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of A and B ids that overlap, and the document of each.

        Between two neighbouring ends of either side lies exactly one token of A and one of B, and
        a pair of tokens meets in one such stretch only; a slice of m and k tokens has m + k - 1.
        """
        ends_a, ends_b = np.zeros(self.bytes + 1, bool), np.zeros(self.bytes + 1, bool)
        ends_a[self.end_a], ends_b[self.end_b] = True, True
        stretch = np.flatnonzero(ends_a | ends_b)
        token_a, token_b = (np.cumsum(e, dtype=np.int64)[stretch] - e[stretch] for e in (ends_a, ends_b))
        doc = np.repeat(np.arange(len(self.doc)), self.count_a)[token_a]
        return (self.a[token_a] << 32) | self.b[token_b], doc

    def group_texts(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text that has tokens."""
        n = len(self.a) + len(self.b)
        if not n:
            return []
        groups_a = np.diff(np.concatenate([[0], self.cut_a]))
        groups_b = np.diff(np.concatenate([[0], self.cut_b]))
        place_a = np.arange(len(self.a)) + np.repeat(self.cut_b - groups_b, groups_a)
        place_b = np.arange(len(self.b)) + np.repeat(self.cut_a, groups_b)
        ids = np.empty(n, np.int64)
        ids[place_a], ids[place_b] = self.a, self.b
        text = self.digits.joined(ids)
        ends = np.cumsum(self.digits.size[ids])
        text[ends[place_a[self.cut_a - 1]] - 1] = ord("|")
        text[ends[place_b[self.cut_b - 1]] - 1] = ord(";")
        stop = ends[self.first_a[1:] + self.first_b[1:] - 1]
        data = text.tobytes()
        return [data[a : b - 1] for a, b in zip([0, *stop[:-1].tolist()], stop.tolist(), strict=True)]

    def spread(self, values: np.ndarray) -> np.ndarray:
        """A number of each text with tokens, 0 for the others."""
        out = np.zeros(self.n, np.int64)
        out[self.doc] = values
        return out


def _portion(part: pa.RecordBatch, encoders, groups: bool) -> tuple:
    """Of some documents: distinct id pairs, documents that hold each, and by document the pairs it has as
    places in the first; ``[times, n_a, n_b, n_groups, n_links, n_entries]``; ``[sha, groups]``."""
    made = Aligned([t or "" for t in part.column("text").to_pylist()], encoders)
    pair, doc = made.links()
    # Ids of A and B take 16 bits each, so that plain numbers sort for documents and pairs at once.
    entry, times = np.unique((doc << 32) | (pair >> 32 << 16) | (pair & LOW), return_counts=True)
    distinct, entry_pair = np.unique(entry & LOW, return_inverse=True)
    distinct = (distinct >> 16 << 32) | (distinct & 0xFFFF)
    entries = np.bincount(entry >> 32, minlength=len(made.doc))
    held = np.bincount(entry_pair, minlength=len(distinct))
    texts, sha = [""] * made.n, [""] * made.n
    for i, text in zip(made.doc.tolist(), made.group_texts(), strict=True):
        sha[i] = hashlib.sha256(text).hexdigest()
        if groups:
            texts[i] = text.decode()
    numbers = [made.spread(x) for x in (made.count_a, made.count_b, made.groups, made.count_a + made.count_b - made.groups, entries)]
    return distinct, held, entry_pair.astype(np.int32), [times.astype(np.int32), *numbers], [sha, texts]


def _merged(made: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of all portions, documents that hold each, and the places of ``entry_pair`` among them."""
    pairs = np.unique(np.concatenate([m[0] for m in made]))
    held, places = np.zeros(len(pairs), np.int64), []
    for distinct, count, entry_pair in made:
        at = np.searchsorted(pairs, distinct).astype(np.int32)
        held[at] += count
        places.append(at[entry_pair])
    return pairs, held, np.concatenate(places)


def align_slices(docs: DataFrame, vocabulary_a: str, model_b: str, id_column: str = "doc_id", text_column: str = "text", groups: bool = False) -> DataFrame:
    """One row per slice of documents: counts and groups of each, and its id pairs (see the module)."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _tokenizers(vocabulary_a, model_b)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                made = [_portion(p, encoders, groups) for p in slices(part, "text", PORTION_BYTES)]
                pairs, held, entry_pair = _merged([m[:3] for m in made])
                times, *numbers = (np.concatenate(x) for x in zip(*(m[3] for m in made), strict=True))
                columns = [pa.array([number], pa.int64()), _one(part.column("id")), *(_one(pa.array(x)) for x in numbers)]
                columns += [_one(pa.array(list(chain.from_iterable(x)), pa.string())) for x in zip(*(m[4] for m in made), strict=True)]
                columns += [_one(pa.array(pairs)), _one(pa.array(held)), *(pa.array([pack64(x)], pa.binary()) for x in (entry_pair, times))]
                yield pa.RecordBatch.from_arrays(columns, names)
                number += 1

    names = ["slice", "ids", *COUNTS, "n_entries", "sha", "groups", "pairs", "held", "entry_pair", "entry_times"]
    schema = f"slice long, ids array<{kind}>, {', '.join(f'{c} array<long>' for c in (*COUNTS, 'n_entries'))}, sha array<string>, groups array<string>, pairs array<long>, held array<long>, entry_pair binary, entry_times binary"
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_batches(rows, run, schema)


def _one(values) -> pa.Array:
    """A list column of one row."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _list(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks().flatten()


def _score(rated: pa.Table, part: pa.Table) -> pa.Table:
    """Documents of one slice, with the corpus-wide counts of its pairs."""
    where = rated.column("place").to_numpy()
    count, best = np.zeros(len(where), np.int64), np.zeros(len(where), np.int64)
    count[where], best[where] = rated.column("n").to_numpy(), rated.column("top").to_numpy().astype(np.int64)
    pair, times = (unpack(part.column(c)[0].as_py(), np.int32).astype(np.int64) for c in ("entry_pair", "entry_times"))
    stop = np.concatenate([[0], np.cumsum(_list(part, "n_entries").to_numpy())])
    n_best, count_sum = (np.diff(np.concatenate([[0], np.cumsum(times * v[pair])])[stop]) for v in (best, count))
    columns = [_list(part, "ids"), *(_list(part, c) for c in COUNTS), pa.array(n_best), pa.array(count_sum), _list(part, "sha"), _list(part, "groups")]
    return pa.Table.from_arrays(columns, ["id", *COUNTS, "n_best", "count_sum", "groups_sha256", "groups"])


def align_tokens(docs: DataFrame, vocabulary_a: str, model_b: str, id_column: str = "doc_id", text_column: str = "text", groups: bool = False) -> DataFrame:
    """``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256`` of every row.

    A: byte-level vocabulary file over a space and the text; B: sentence-piece model over the text.
    ``groups=True`` adds the groups themselves as text. Defined cases: null and empty texts, and
    texts that the tokens of A or B do not spell byte by byte (say, one that holds U+2581), have no
    tokens, zeros and an empty string; repeated rows count as documents of their own; null ids
    stay; strings of special tokens are plain text; a very long text is a slice of its own; an
    empty table gives no rows; other columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    made = written(align_slices(docs, vocabulary_a, model_b, id_column, text_column, groups), "aligned", SLICES_AT_ONCE)
    pairs = made.select("slice", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "x")).select("slice", "place", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    counts = written(pairs.groupBy("pair").agg(F.sum("held").alias("n")), "pair-counts")
    id_a = F.shiftright("pair", 32)
    best = counts.groupBy(id_a.alias("a")).agg(F.max("n").alias("most"))  # at most one row per id of A
    rated = counts.withColumn("a", id_a).join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("top"))
    looked = pairs.select("slice", "place", "pair").join(rated, "pair").select("slice", "place", "n", "top")
    schema = f"id {kind}, {', '.join(f'{c} long' for c in (*COUNTS, 'n_best', 'count_sum'))}, groups_sha256 string, groups string"
    whole = made.drop("pairs", "held").withColumnRenamed("slice", "of_slice")
    out = looked.groupBy("slice").cogroup(whole.groupBy("of_slice")).applyInArrow(_score, schema)
    return out.withColumnRenamed("id", id_column) if groups else out.drop("groups").withColumnRenamed("id", id_column)
