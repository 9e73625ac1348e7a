"""Language, secrets, token counts, chat and packing against plain versions and on odd rows."""

import collections
import hashlib
import re
import zlib

import pytest

from adtally.llm import bpe, chat, language_id, packing, pretokens, secrets, token_counts
from adtally.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY, vocabulary

tokenizers = pytest.importorskip("tokenizers")
FIELDS = "doc_id long, text string, lang string, source string, length int, n string"
ODD = [
    (1, None, "en", "s", 1, "x"), (2, "", "en", "s", 1, "x"), (3, "123 !", None, None, None, None), (None, "the and of", "en", "s", 1, "x"),
    (4, "the and of", "en", "s", 1, "x"), (4, "the and of", "en", "s", 1, "x"), (5, "der die und " * 30_000, "de", "s", 1, "x"),
]
TEXTS = [
    "", "a's 's don't we'll I'm '' '''s 're  'revx'd\n\n x \t\n  ", "<|endoftext|> a <|startoftext|><|endoftext|>  ", "a <|endoftext|>b  <|endoftext|>", "  ", "\n",
    "Ὀδυσσεύς ΣΑΣ Σ", "İstanbul ǅ ﬁ Ⅷ ½ ٣", "é Å ẛ̣", "''ll 'll it's' 1'st", "a" * 700, "ab" * 300 + " 一二三", "\x1c\x1d\x85 ​　x", "'S DON'T", "á́ b",
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, FIELDS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], FIELDS)


def every_kind() -> list[str]:
    return TEXTS + ["a" + c + "b " + c + " " + c + c + "'" + c for c in map(chr, [*range(0, 0x600, 3), *range(0x2000, 0x3100, 7)])]


def test_counts_are_those_of_the_library():
    known = tokenizers.Tokenizer.from_file(vocabulary(WORD_VOCABULARY))
    want = [len(e.ids) for e in known.encode_batch(every_kind(), add_special_tokens=False)]
    assert bpe.rank_counter(vocabulary(WORD_VOCABULARY))(every_kind()).tolist() == want


def test_ids_are_those_of_the_library():
    known = tokenizers.Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
    ids, start = bpe.id_encoder(vocabulary(BYTE_VOCABULARY))(every_kind())
    got = [ids[a:b].tolist() for a, b in zip(start[:-1], start[1:])]
    assert got == [e.ids for e in known.encode_batch(every_kind(), add_special_tokens=False)]


def test_long_texts_are_cut_between_words_only():
    text = "ab cd  ef\n gh " * 50
    parts = pretokens.cut_long(text, 40)
    assert "".join(parts) == text and len(parts) > 5 and all(re.match(r" \w", p) for p in parts[1:])


def test_token_counts_of_odd_rows(odd, empty):
    got = token_counts.count_tokens(odd, vocabulary(WORD_VOCABULARY), 2048)
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert len(rows) == 7 and (1, 0, 0, False) in rows and (2, 0, 0, False) in rows and rows.count((4, 10, 3, False)) == 2
    assert (None, 10, 3, False) in rows and (5, 360_000, 90_000, True) in rows
    assert token_counts.count_tokens(empty, vocabulary(WORD_VOCABULARY), 2048).count() == 0


def plain_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_packing_is_gapless_and_holds_every_piece(spark, odd, empty):
    docs = odd.union(spark.range(300).selectExpr("id + 100", "repeat('word ', cast(id * 7 % 500 AS int))", "'en'", "'s'", "1", "'x'"))
    rows = packing.pack_documents(docs, vocabulary(BYTE_VOCABULARY), 128, rounds=40).collect()
    known = tokenizers.Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
    ids = {(r.doc_id, r.text): [*known.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    want = collections.Counter()
    for r in docs.collect():
        x = ids[r.doc_id, r.text]
        head = len(x) - (-(-len(x) // 128) - 1) * 128
        for i, a in enumerate([0, *range(head, len(x), 128)]):
            piece = x[a : head if i == 0 else a + 128]
            want[r.doc_id, i, a, len(piece), zlib.crc32(b"".join(n.to_bytes(4, "little") for n in piece))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for x in places.values():
        x.sort()
        assert [a for a, _ in x] == [sum(n for _, n in x[:i]) for i in range(len(x))] and sum(n for _, n in x) <= 128
    assert len(places) <= plain_best_fit([r.length for r in rows], 128) + 1
    assert packing.pack_documents(empty, vocabulary(BYTE_VOCABULARY), 128).count() == 0


def test_plans_cover_the_histogram():
    histogram = {1: 400, 7: 90, 50: 33, 64: 21, 99: 12, 128: 4}
    plan = packing.plan_sequences(histogram, 128, 60)
    taken = collections.Counter()
    for n, low, high, *_ in plan.runs:
        assert low == taken[n]
        taken[n] = high
    assert taken == histogram


@pytest.mark.parametrize("low, high", [(1, 512), (175, 512), (125, 275), (85, 87)])
def test_plans_are_never_worse_than_best_fit(low, high):
    import numpy as np

    lengths, counts = np.unique(np.random.default_rng(5).integers(low, high + 1, 4000), return_counts=True)
    plan = packing.plan_sequences(dict(zip(lengths.tolist(), counts.tolist(), strict=True)), 512)
    assert plan.sequences <= sum(times for _, times in packing._best_fit(lengths, counts.copy(), 512))
    assert sum((h - lo) * n for n, lo, h, *_ in plan.runs) == int((lengths * counts).sum())


def test_configurations_that_are_not_full_count_and_the_bound_holds():
    import numpy as np

    histogram = {1025: 1200, 513: 1200, 512: 1200, 342: 1200, 341: 1200}
    plan = packing.plan_sequences(histogram, 2048)
    lengths = np.array(sorted(histogram))
    best_fit = sum(times for _, times in packing._best_fit(lengths, np.array([histogram[n] for n in lengths.tolist()]), 2048))
    assert plan.bound <= plan.sequences < best_fit and plan.programmed > 0
    # a 7 leaves room for one 3, and what is left of the 3s stands in threes: 50 + 17
    exact = packing.plan_sequences({3: 100, 7: 50}, 10)
    assert exact.sequences == 67 and 65 <= exact.bound <= 67


def test_language_is_learned_and_odd_texts_have_none(spark, odd, empty):
    words = {"en": "the and of with that", "fr": "les des une avec est", "de": "der die und ist nicht"}
    train = spark.createDataFrame([(i, " ".join([w[i % 5], *w]), lang) for lang, t in words.items() for w in [t.split()] for i in range(10)], "doc_id long, text string, lang string")
    model = language_id.fit(train, "doc_id", "text", "lang")
    got = {(r.doc_id, r.text[:9] if r.text else r.text): r for r in language_id.identify(odd, model, keep=["doc_id", "text", "n"]).collect()}
    assert got[4, "the and o"].lang_pred == got[None, "the and o"].lang_pred == "en" and got[5, "der die u"].lang_pred == "de"
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in ((1, None), (2, ""), (3, "123 !")))
    unseen = spark.createDataFrame([(1, "theta"), (2, "nichts")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language_id.identify(unseen, model).collect()} == {1: "en", 2: "de"}
    assert language_id.identify(empty, model).count() == 0
    nothing = language_id.fit(empty, "doc_id", "text", "lang")
    assert {r.lang_pred for r in language_id.identify(odd, nothing).collect()} == {"und"}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], secrets.KINDS.index(x[0])))


@pytest.mark.parametrize(
    "text",
    [
        'é token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"###', "PASSWORD:secret=abcdefgh", "secretoken: abcdef", "token=ab token=abcdef passwd='x", "api_key=abcdef apikey : ABCDEF",
        "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "AKIA" + "C" * 20, "ABCDEFabcdef0123456789abcdefABCDEF", "a" * 23 + " " + "b" * 24, "İſecret=abcdefg paſſword=abcdefg Kapi_Key='x1y2z3'",
        "token" * 40 + "=abcdef", "", "deadbeef" * 3 + "g" + "feed" * 6,
    ],
)
def test_base_secrets_are_those_of_the_expressions(text):
    assert [s for s in secrets.find_secrets(text) if s[0] in secrets.BASE] == base_spans(text)


def test_checksums_decide():
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    good, bad = f"ghp_{body}{secrets.checksum62(body)}", f"ghp_{body}000000"
    text = f"x {good} y {bad} npm_{body}{secrets.checksum62(body)}"
    assert [(k, text[a:b]) for k, a, b in secrets.find_secrets(text)] == [("github", good), ("npm", f"npm_{body}{secrets.checksum62(body)}")]
    import base64

    data = bytes(range(60))
    block = "-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: 1\n\n" + base64.b64encode(data).decode() + "\n={}\n-----END PGP PRIVATE KEY BLOCK-----"
    right = block.format(base64.b64encode(secrets.crc24(data).to_bytes(3, "big")).decode())
    assert [s[0] for s in secrets.find_secrets("k " + right)] == ["pgp"] and secrets.find_secrets(block.format("AAAA")) == []


def test_secrets_of_odd_rows_and_redaction(spark, odd, empty):
    assert {r.doc_id: r.spans for r in secrets.scan_secrets(odd).collect()}[1] == []
    assert secrets.scan_secrets(empty).count() == secrets.redact_secrets(empty).count() == 0
    df = spark.createDataFrame([(1, "a token=abcdefgh b", 3), (2, None, None), (3, "x" + "0" * 30 + "y", 1)], "doc_id long, text string, n int")
    assert sorted(tuple(r) for r in secrets.redact_secrets(df).collect()) == [(1, "a [SECRET] b", 3), (2, None, None), (3, "x[SECRET]y", 1)]


def test_events_fold_into_messages_and_back(spark):
    log = [
        (1, 1, 1, "message", "user", "hi <turn> &lt; \n"), (1, 2, 2, "delta", "assistant", "He"), (1, 3, 2, "delta", None, "llo"), (1, 5, 2, "delta", None, "new"), (1, 4, 2, "regenerate", None, None),
        (1, 6, 3, "message", "user", "x"), (1, 7, 3, "edit", None, "y"), (1, 8, 4, "message", "assistant", None), (None, 1, 1, "message", None, "z"), (1, 9, 5, "odd", "assis\ntant", "t"),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, message long, kind string, role string, text string").repartition(3)
    out = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold_events(events))).collect()}
    assert [tuple(t) for t in out[1].turns] == [("user", "hi <turn> &lt; \n"), ("assistant", "new"), ("user", "y"), ("assistant", ""), ("assis\ntant", "t")]
    assert out[1].trained == ["new", ""] and [tuple(t) for t in out[None].turns] == [("", "z")]
    for m, text in zip(out[1].mask, out[1].trained):
        assert out[1].formatted[m.start : m.end] == text
    assert chat.render(chat.fold_events(events.where("false"))).count() == 0


def test_repeated_turns_are_turns_of_their_own(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "first"), (2, 0, "assistant", "long " * 50_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold_events(chat.events_of_turns(turns)))).collect()}
    assert [t.text for t in out[1].turns] == ["first", "a", "a"] and out[2].trained == ["long " * 50_000]
    assert out[1].n_turns == 3 and hashlib.sha256(out[2].formatted.encode()).digest()


def test_held_out_fold(spark):
    got = {r.id: r.h for r in spark.range(50).select("id", language_id.held_out_fold("id").alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)}
