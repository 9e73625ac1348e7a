"""Language identification by word-first backoff.

A known word is scored by its log frequency in each language. A word that is not known
is scored by its longest known character n-grams: all of length five, else all of
length four, and so on down to single letters. The scores of a text's words add up.

The model is fitted on a bounded sample of the labelled rows, chosen by a hash of the
id: about ``sample_rows`` of them, all if there are fewer. It keeps the ``words`` most
frequent words and, for each length, the ``grams`` most frequent n-grams of each
language; these bounds are parameters and do not grow with the data.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.pretokens import Pieces, cut_long
from adtally.llm.store import map_batches, written
from adtally.llm.wordhash import slices

LONGEST = 5
BACKOFF = 0.4
EVIDENCE = 20.0
CACHE_WORDS = 150_000
SLICE_BYTES = 1 << 20
UNKNOWN = "und"


@dataclass
class Model:
    """Rows of ``scores`` (a column per language) for words and for n-grams; the last row is that of neither."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray


def held_out_fold(id_column: str):
    """Rows the model never learns from: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _padded_grams(word: str, n: int) -> list[str]:
    w = f"<{word}>" if n > 1 else word
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def _lower_units(texts: list[str]) -> tuple[list[str], np.ndarray]:
    units, first = [], np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        units += cut_long(t.lower())
        first[i + 1] = len(units)
    return units, first


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            langs, texts = part.column("lang").to_pylist(), part.column("text").to_pylist()
            for lang in sorted(set(langs)):
                units, _ = _lower_units([t for t, x in zip(texts, langs, strict=True) if x == lang])
                pieces = Pieces(units, "letters")
                codes, _, one = pieces.distinct()
                counts = np.bincount(codes, minlength=len(one))
                columns = [pa.array([lang] * len(one), pa.string()), pa.array([pieces.text(i) for i in one], pa.string()), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
            for size in range(1, LONGEST + 1):
                for g in _padded_grams(word, size):
                    found[lang, g] += n
        columns = [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])


def fit(labelled: DataFrame, id_column: str, text_column: str, lang_column: str, sample_rows: int = 10_000, words: int = 10_000, grams: int = 5_000) -> Model:
    """Model of the labelled rows; rows without text or label teach nothing."""
    rows = labelled.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")).where("text is not null and lang is not null")
    total = labelled.where(F.col(lang_column).isNotNull()).count()
    share = min(1.0, sample_rows / max(total, 1))
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("text", "lang")
    counted = written(map_batches(sample, _count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    spelled = map_batches(counted, _count_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))

    def top(df: DataFrame, by: list, name: str, most: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("n"), name)
        return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).select("lang", F.col(name).alias("item"), "n")

    word_rows = top(counted, ["lang"], "word", words).collect()
    gram_rows = top(written(spelled, "grams"), ["lang", F.length("gram")], "gram", grams).collect()
    languages = sorted({r["lang"] for r in word_rows})
    return _model(languages, word_rows, gram_rows)


def _model(languages: list[str], word_rows: list, gram_rows: list) -> Model:
    column = {x: i for i, x in enumerate(languages)}
    tables, parts = [], []
    for rows, lengths in ((word_rows, [0]), (gram_rows, list(range(1, LONGEST + 1)))):
        index: dict[str, int] = {}
        for r in rows:
            index.setdefault(r["item"], len(index))
        counts = np.zeros((len(index), len(languages)))
        for r in rows:
            counts[index[r["item"]], column[r["lang"]]] += r["n"]
        size = np.array([len(x) if lengths != [0] else 0 for x in index], np.int64)
        scores = np.zeros_like(counts)
        for n in lengths:  # frequencies are among items of one length
            at = size == n
            scores[at] = np.log((counts[at] + 0.5) / (counts[at].sum(axis=0) + 0.5 * max(int(at.sum()), 1)))
        tables.append(index)
        parts.append(scores)
    base = len(tables[0])
    grams = {g: base + i for g, i in tables[1].items()}
    none = np.zeros((1, len(languages)))
    return Model(languages, tables[0], grams, np.concatenate([*parts, none]).astype(np.float32))


def _rows_of(word: str, model: Model) -> tuple[list[int], float]:
    """Rows of the model that score a word, and their weight."""
    i = model.words.get(word)
    if i is not None:
        return [i], 1.0
    weight = 1.0
    for n in range(LONGEST, 0, -1):
        weight *= BACKOFF if n < LONGEST else 1.0
        known = [g for g in (model.grams.get(x) for x in _padded_grams(word, n)) if g is not None]
        if known:
            return known, weight
    return [len(model.scores) - 1], 1.0


def _scorer(model: Model):
    cache: dict[int, int] = {}
    vectors = np.zeros((0, len(model.languages)), np.float32)

    def score(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of word scores of each text by language, and its number of words."""
        nonlocal vectors
        units, first = _lower_units(texts)
        pieces = Pieces(units, "letters")
        codes, hashes, one = pieces.distinct()
        if len(cache) > CACHE_WORDS:
            cache.clear()
            vectors = vectors[:0]
        keys = hashes.tolist()
        new = [i for i, h in enumerate(keys) if h not in cache]
        if new:
            found = [_rows_of(pieces.text(one[i]), model) for i in new]
            flat = np.fromiter((r for rows, _ in found for r in rows), np.int64)
            size = np.fromiter((len(rows) for rows, _ in found), np.int64, len(found))
            mean = np.add.reduceat(model.scores[flat], np.cumsum(size) - size, axis=0) / size[:, None]
            weight = np.array([w for _, w in found], np.float32)
            for k, i in enumerate(new):
                cache[keys[i]] = len(vectors) + k
            vectors = np.concatenate([vectors, mean * weight[:, None]])
        at = np.fromiter((cache[h] for h in keys), np.int64, len(keys))[codes] if len(codes) else np.zeros(0, np.int64)
        total = np.zeros((len(at) + 1, len(model.languages)))
        np.cumsum(vectors[at], axis=0, out=total[1:])
        bound = pieces.first[first]
        return total[bound[1:]] - total[bound[:-1]], np.diff(bound)

    return score


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``lang_pred`` and ``score`` (0 to 1) of every row, from its text alone; ``keep`` names columns to pass on.

    ``score`` is the share of the best language when evidence is worth at most ``EVIDENCE`` words.
    Defined cases: null texts and texts without letters, or a model without languages, give ``und``
    with score 0; equal sums go to the first language by name; repeated rows and null ids stay one
    row each; very long texts are scored whole; an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        score = _scorer(known)
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                n = len(part)
                if known.languages:
                    sums, words = score([t or "" for t in part.column("_text").to_pylist()])
                    scaled = sums * (np.minimum(words, EVIDENCE) / np.maximum(words, 1))[:, None]
                    best = sums.argmax(axis=1)
                    share = 1 / np.exp(scaled - scaled.max(axis=1, keepdims=True)).sum(axis=1)
                    names = [known.languages[b] if w else UNKNOWN for b, w in zip(best.tolist(), words.tolist(), strict=True)]
                    share = np.where(words > 0, share, 0.0)
                else:
                    names, share = [UNKNOWN] * n, np.zeros(n)
                rest = [part.column(c) for c in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(names, pa.string()), pa.array(share, pa.float64())], [*part.schema.names[:-1], "lang_pred", "score"])

    columns = [id_column] if keep is None else keep
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col(text_column).alias("_text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    out = map_batches(rows, run, f"{schema}, lang_pred string, score double" if schema else "lang_pred string, score double")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], "lang_pred", "score")
