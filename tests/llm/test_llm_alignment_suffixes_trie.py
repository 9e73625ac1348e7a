"""Token alignment, suffix dedup and prefix trie against plain versions, on odd rows and on hot groups."""

import collections
import hashlib
import random
import re
import urllib.parse
import zlib

import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from adtally.llm import prefix_trie, store, suffix_dedup, token_alignment
from adtally.llm.bpe import byte_letters
from adtally.llm.queries import BYTE_VOCABULARY, PIECE_MODEL, op11_token_alignment, rebuilt_conversations, vocabulary

DATA = "/root/testdata/sf0.001"


def read(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


# Token alignment


def plain_alignment(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) by comparing all byte ranges."""
    a = Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_MODEL))
    value = {c: i for i, c in enumerate(byte_letters())}
    made = []
    for text in texts:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        bytes_a = [bytes(value[c] for c in a.id_to_token(i)) for i in ids_a]
        names = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace("▁", " ").encode() for n in names]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            made.append(([], [], [], []))
            continue
        ends_a, ends_b = ([sum(map(len, x[: i + 1])) for i in range(len(x))] for x in (bytes_a, bytes_b))
        links = [
            (ids_a[i], ids_b[j])
            for i in range(len(ids_a))
            for j in range(len(ids_b))
            if max(ends_a[i] - len(bytes_a[i]), ends_b[j] - len(bytes_b[j])) < min(ends_a[i], ends_b[j])
        ]
        groups, last = [], 0
        for e in sorted(set(ends_a) & set(ends_b)):
            side = lambda ids, ends: ",".join(str(x) for x, y in zip(ids, ends, strict=True) if last < y <= e)  # noqa: B023, E731
            groups.append(side(ids_a, ends_a) + "|" + side(ids_b, ends_b))
            last = e
        made.append((ids_a, ids_b, groups, links))
    count = collections.Counter(p for *_, links in made for p in set(links))
    best = collections.defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [
        (len(x), len(y), len(g), len(ln), sum(count[p] == best[p[0]] for p in ln), sum(count[p] for p in ln), ";".join(g))
        for x, y, g, ln in made
    ]


ODD_TEXTS = [
    None, "", " ", "a", "x▁y", "café naïve \U0001f600\U0001f600 中文", "<|endoftext|> <s> </s> <unk> <0x41>", "  two  spaces\n\n\ttabs ", "a" * 3000, "same text", "same text",
    " no-break em", "\x00\x01", "1234567890 3.14",
]


@pytest.mark.parametrize("slice_bytes", [64, 1 << 20])
def test_alignment_agrees_with_all_ranges_compared(spark, monkeypatch, slice_bytes):
    texts = [r["text"] and r["text"][:400] for r in read("documents")[:25]] + ODD_TEXTS
    want = collections.Counter(plain_alignment(texts))
    docs = spark.createDataFrame([(i if i % 7 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, slice string").repartition(3)
    monkeypatch.setattr(token_alignment, "SLICE_BYTES", slice_bytes)
    rows = token_alignment.align_tokens(docs, vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_MODEL), groups=True).collect()
    got = collections.Counter((r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in rows)
    assert got == want
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in rows)
    assert sum(r["doc_id"] is None for r in rows) == len([i for i in range(len(texts)) if i % 7 == 0])


def test_alignment_of_portions_agrees_with_one(spark, monkeypatch):
    docs = spark.createDataFrame([(i, r["text"]) for i, r in enumerate(read("documents")[:40])] + list(enumerate(ODD_TEXTS)), "doc_id long, text string").coalesce(1)
    found = []
    for size in (1 << 30, 2000, 1):
        monkeypatch.setattr(token_alignment, "PORTION_BYTES", size)
        found.append(collections.Counter(map(tuple, token_alignment.align_tokens(docs, vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_MODEL), groups=True).collect())))
    assert found[0] == found[1] == found[2] and sum(found[0].values()) == 40 + len(ODD_TEXTS)


def test_alignment_holds_bounded_bytes(spark, monkeypatch):
    """what a task gets, aligns and reads back at once follows from bytes, however many rows there are."""
    kept, written = [], token_alignment.written

    def spy(df, name, *more):
        kept.append(written(df, name, *more))
        return kept[-1]

    spark.conf.unset(store.BATCH_CONF)
    monkeypatch.setattr(token_alignment, "written", spy)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words 12 "), 2200).alias("text")).coalesce(1)
    assert token_alignment.align_tokens(docs, vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_MODEL)).count() == 400
    made = kept[0]
    assert made.schema["entry_pair"].dataType.simpleString() == "binary"  # arrays take levels of 8 bytes an entry when they are read
    assert max(r["n"] for r in made.select(F.size("ids").alias("n")).collect()) * 2200 * 14 <= 2 << 20
    files = [pq.ParquetFile(urllib.parse.urlparse(f).path).metadata for f in made.inputFiles()]
    groups = [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert sum(groups) >= 6 and max(groups) <= 4
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(store.BATCH_CONF))
    assert limit <= 4 << 20


def test_alignment_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.align_tokens(docs, vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_MODEL)).count() == 0


def test_alignment_query_links_are_groups_and_tokens(spark):
    for r in op11_token_alignment(spark, DATA).collect():
        assert r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"]
        assert r["n_best"] <= r["n_links"] <= r["count_sum"]


# Suffix dedup


def plain_byte_dedup(rows, length):
    """(n_bytes, removed spans, kept) of rows in the order given."""
    seen, out = set(), []
    for _, text in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if b[i : i + length] in seen:
                gone[i : i + length] = [True] * length
            seen.add(b[i : i + length])
        edges = [i for i in range(len(b) + 1) if (gone[i] if i < len(b) else False) != (gone[i - 1] if i else False)]
        out.append((len(b), tuple(zip(edges[::2], edges[1::2], strict=True)), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def copied_texts(seed, letters, size):
    """Copies at all offsets and with edits, runs of one letter, and repeats within a text."""
    rng = random.Random(seed)
    new = lambda n: "".join(rng.choice(letters) for _ in range(n))
    base = [new(size) for _ in range(4)]
    rows = []
    for i in range(60):
        x = rng.choice(base)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(x) + 1)
            x = x[:at] + new(rng.randint(0, 2)) + x[at + rng.randint(0, 2) :]
        lo = rng.randrange(len(x) + 1)
        rows.append((i, new(rng.randint(0, 9)) + x[lo:] + rng.choice(["", x[: rng.randrange(len(x) + 1)]]) if rng.random() < 0.8 else new(rng.randint(0, size))))
    return rows + [(100 + i, base[0]) for i in range(15)] + [(200, letters[0] * 3 * size), (201, "é" * size), (202, ""), (203, None), (300, None)]


@pytest.mark.parametrize("length, letters, size", [(1, "ab", 3), (4, "ab", 12), (13, "abc", 60), (40, "abcd", 200), (100, "abcdefgh é", 700), (100, "ab", 300)])
def test_byte_dedup_agrees_with_a_set_of_windows(spark, monkeypatch, length, letters, size):
    monkeypatch.setattr(suffix_dedup, "BLOCK_MB", 0.004)
    rows = copied_texts(length, letters, size)
    shuffled = random.Random(1).sample(rows, len(rows))
    docs = spark.createDataFrame([(i, t, 0) for i, t in shuffled], "doc_id long, text string, block int").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], tuple((s["start"], s["end"]) for s in r["removed"]), bytes(r["kept"]), r["n_removed"]) for r in suffix_dedup.remove_repeated_bytes(docs, length).collect()}
    for (i, _), (n, spans, kept) in zip(rows, plain_byte_dedup(rows, length), strict=True):
        assert got[i] == (n, spans, kept, n - len(kept)), i


def test_byte_dedup_of_repeated_rows_and_null_ids(spark):
    text, other = "0123456789" * 30, "abcdefghij" * 30
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (None, other), (2, other), ("9", "")][:5] + [(9, "")], "doc_id long, text string")
    rows = suffix_dedup.remove_repeated_bytes(docs, 100).collect()
    first = plain_byte_dedup([(1, text)], 100)[0][2]
    assert sorted((str(r["doc_id"]), len(r["kept"])) for r in rows) == sorted([("1", len(first)), ("1", 0), ("None", 0), ("None", 0), ("2", len(first)), ("9", 0)])
    assert suffix_dedup.remove_repeated_bytes(docs.limit(0), 100).count() == 0


def test_covers_reach_every_shift():
    for period, cover in suffix_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


# Prefix trie


def plain_trie(paths):
    """Rows of the trie over {conv: [(role, text), ...]}."""
    members = collections.defaultdict(list)
    for conv in sorted(paths):
        for d in range(len(paths[conv]) + 1):
            members[tuple(paths[conv][:d])].append(conv)
    kids = collections.Counter(p[:-1] for p in members if p)
    saved, leaves = collections.Counter(), collections.Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(who) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += p not in kids
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(str(c) for c in m if len(paths[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items()
    )


def plain_order(rows):
    out = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(turns)] for c, turns in out.items()}


def trie_rows(df):
    return sorted(tuple(r) for r in df.collect())


def chats(seed, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(10**12), 40) + list(range(20)):
        n = rng.randint(0, longest)
        rows += [(c, t, "user" if t % 2 else "bot", f"é{rng.choice('ab')}" if t < 5 or rng.random() < 0.1 else "same") for t in range(max(n, 1))]
    rows += [(7, None, None, None), (7, None, "user", None), (7, 1, "user", "z"), (7, 1, "user", "z"), (None, 1, "user", "a")]
    return rng.sample(rows, len(rows))


@pytest.mark.parametrize("segment, shard_rows, longest", [(50_000, 100_000, 6), (3, 10, 20), (1, 7, 9), (2, 1000, 30)])
def test_trie_agrees_with_a_plain_one(spark, segment, shard_rows, longest):
    rows = chats(segment, longest)
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, position string").repartition(6)
    got = prefix_trie.prefix_trie(prefix_trie.number_turns(turns), segment_turns=segment, shard_rows=shard_rows)
    assert trie_rows(got) == plain_trie(plain_order(rows))


def test_trie_keeps_conversations_without_turns(spark):
    turns = spark.createDataFrame([(3, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    ids = spark.createDataFrame([(3,), (1,), (2,)], "conv_id long")
    assert trie_rows(prefix_trie.prefix_trie(prefix_trie.number_turns(turns), ids)) == plain_trie({3: [("user", "a")], 1: [], 2: []})
    assert prefix_trie.prefix_trie(prefix_trie.number_turns(turns.limit(0))).count() == 0


def test_rebuilt_conversations_agree_with_a_plain_version(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in read("conversations")] + chats(9, 15)
    said = plain_order(rows)
    paths = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = said.get(c - c % 5, [])[:h] + own[h:]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert trie_rows(prefix_trie.prefix_trie(*rebuilt_conversations(turns))) == plain_trie(paths)


def test_node_table_gives_each_digest_a_slot_of_its_own():
    import numpy as np

    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 63, 5000).astype(np.uint64) for _ in range(2))
    a[:2500] = 5  # one lane alone does not tell them apart
    table = prefix_trie.NodeTable(a, b)
    assert sorted(table.find(a, b).tolist()) == list(range(5000))
    assert (table.find(a, b ^ np.uint64(1 << 40)) == -1).all()


def test_queries_are_registered():
    assert {"op11_token_alignment", "op12_suffix_dedup", "op13_prefix_trie"} <= set(entry.queries())
    assert {"op12_suffix_dedup", "op13_prefix_trie"} <= set(entry.oracle_sql())
