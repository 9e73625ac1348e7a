"""URL filter, top-k, dedup, decontamination, Jaccard join and the pipeline against plain versions and on odd rows."""

import collections
import math
import random
import re
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from adtally.llm import decontamination, language_id, mtree_search, ngram_jaccard, packing, secrets, store, substring_dedup, url_filter
from adtally.llm.checks import SQL
from adtally.llm.queries import BYTE_VOCABULARY, URL_RULES, vocabulary

DATA = Path("/root/testdata/sf0.001")
ODD = [(None, None), (None, ""), (5000, "a b"), (5000, "A b"), (5001, "a b c"), (5002, " \t "), (5003, "x" * 100_000), (5004, "é a b c d e f"), (5004, "é a b c d e f")]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def noisy_copies(seed=3):
    """Groups of near copies of all degrees, exact copies, shared passages and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    line, rows = [word() for _ in range(12)], []
    for size, edits in ((60, 2), (40, 5), (25, 9), (6, 1)):
        base = [word() for _ in range(90)]
        for _ in range(size):
            x = list(base)
            for _ in range(rng.randint(0, edits)):
                x[rng.randrange(len(x))] = word()
            rows.append(x + line * (rng.random() < 0.3))
    rows += [[word() for _ in range(rng.randint(1, 60))] + line * (rng.random() < 0.5) for _ in range(60)]
    rows += [list(rng.choice(rows)) for _ in range(30)]
    return [(i, " ".join(x)) for i, x in enumerate(rows)]


def linked(rows, k=5, percent=80):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    holders = collections.defaultdict(list)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        shared = collections.Counter(j for g in x for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= percent * (len(x) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in x:
            holders[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted([(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)], key=repr), len({find(i) for i in range(len(rows)) if sets[i]})


@pytest.mark.parametrize("block", [2, 5, 16])
def test_jaccard_components_match_all_pairs(spark, block):
    rows = noisy_copies() + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).repartition(4)
    want, groups = linked(rows)
    got = ngram_jaccard.similar_sets(df, block=block).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == want
    if block == 5:
        kept = ngram_jaccard.keep_one_each(df)
        blank = sum(not (t or "").strip() for _, t in rows)
        assert kept.columns == df.columns and kept.count() == groups + blank


def test_near_copies_take_about_one_product_a_set(spark, monkeypatch):
    """One large group of near copies: no turn before the last multiplies out more pairs than there are sets."""
    rng = random.Random(11)
    base, rows = [f"w{rng.randrange(10**6)}" for _ in range(120)], []
    for i in range(150):
        x = list(base)
        for _ in range(rng.randint(0, 3)):
            x[rng.randrange(len(x))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(x)))
    rows += [(200 + i, t) for i, t in noisy_copies()]
    asked, overlaps = [], ngram_jaccard._overlaps
    monkeypatch.setattr(ngram_jaccard, "FEW_PAIRS", 0, raising=False)
    monkeypatch.setattr(ngram_jaccard, "_overlaps", lambda pairs, sets: asked.append(pairs.count()) or overlaps(pairs, sets))
    got = ngram_jaccard.similar_sets(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == linked(rows)[0]
    assert sum(asked) <= 2 * len({t for _, t in rows})


def test_signatures_never_differ_more_than_the_sets(spark):
    """Sets of 1 to 3,000 n-grams: folded signatures bound the difference from below, and tell unlike large sets apart."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    texts = ["", "a", *(" ".join(base[:n]) for n in (6, 36, 37, 500, 517, 640, 2052, 2053, 2560, 3000))]
    texts += [" ".join(f"v{rng.randrange(10**6)}" for _ in range(n)) for n in (40, 600, 2500)]
    sets = ngram_jaccard.Sets(pa.array(texts), 5)
    signs = sets.signs().to_pylist()
    assert [64 * len(x) for x in signs] == ngram_jaccard.sign_bits(sets.count).tolist()
    assert all(2 * n <= 64 * len(x) and (64 * len(x) < 4 * n or n <= 32) for n, x in zip(sets.count, signs, strict=True))
    grams = [set(sets.gram[sets.first[i] : sets.first[i + 1]].tolist()) for i in range(len(texts))]
    pairs = [(i, j) for i in range(1, len(texts)) for j in range(i + 1, len(texts)) if 100 * min(len(grams[i]), len(grams[j])) >= 80 * max(len(grams[i]), len(grams[j]))]
    rows = [(i, j, len(grams[i]), len(grams[j]), signs[i], signs[j]) for i, j in pairs]
    df = spark.createDataFrame(rows, "i int, j int, n long, m long, sx array<long>, sy array<long>")
    kept = {(r.i, r.j) for r in df.where(ngram_jaccard._can_reach(80, "n", "m")).collect()}
    similar = {(i, j) for i, j in pairs if 180 * len(grams[i] & grams[j]) >= 80 * (len(grams[i]) + len(grams[j]))}
    assert similar <= kept
    assert any(len(signs[i]) != len(signs[j]) for i, j in similar)
    assert not {(i, j) for i, j in kept if not grams[i] & grams[j]}


def test_jaccard_of_nothing(spark):
    assert ngram_jaccard.similar_sets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def without_repeats(rows, length):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone |= set(range(i, i + length))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [1, 4, 12, 35])
def test_repeats_go_as_in_a_count_of_all_windows(spark, length):
    rows = noisy_copies(5)[:150] + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring_dedup.remove_repeats(df, length).collect()
    assert sorted((tuple(r) for r in got), key=repr) == without_repeats(rows, length)
    assert substring_dedup.remove_repeats(df.where("false"), length).count() == 0


@pytest.mark.parametrize("period", substring_dedup.COVERS)
def test_covers_align_any_two_positions(period):
    cover = set(substring_dedup.COVERS[period])
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def leaks(docs, items, length=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = pattern.findall(lower(t))
        n = min(length, len(w))
        for j in range(len(w) - n + 1):
            if n:
                windows[tuple(w[j : j + n])].add(i)
    out = []
    for d, t in docs:
        w, hit, found = pattern.findall(lower(t)), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if items_of := windows.get(tuple(w[j : j + n])):
                    hit |= set(range(j, j + n))
                    found |= items_of
        out.append((d, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("listed", [0, 20_000])
def test_leaks_match_a_scan_of_all_windows(spark, monkeypatch, listed):
    monkeypatch.setattr(decontamination, "LISTED_TERMS", listed)
    rows = noisy_copies(7)[:120] + ODD + [(6000, "Ä1-b_c, the THE the"), (6001, "the")]
    items = [(1, rows[0][1][:200]), (2, "x; " + rows[70][1]), (12, "the"), (3, ""), (4, None), (None, "a b c"), (5, "nothing of this kind"), (6, rows[0][1][:120])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(7)).repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_leaks(docs, tests).select("doc_id", "n_words", "n_hit", "items").collect()
    assert sorted((tuple(r) for r in got), key=repr) == leaks(rows, items)
    assert decontamination.find_leaks(docs, tests.where("false")).where("contaminated").count() == 0
    assert decontamination.find_leaks(docs.where("false"), tests).count() == 0


def near_counts(docs, items, length=10, slop=10):
    """Places of a window's rarest term in a span of ``slop`` words more than the window that holds all its words."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    texts = [(d, split(t)) for d, t in docs]
    n = collections.Counter(w for _, words in texts for w in words)
    windows = {tuple(w[j : j + length]) for w in (split(t) for _, t in items) for j in range(max(len(w) - length + 1, 1)) if w}
    near = []
    for d, words in texts:
        at = set()
        for window in windows:
            rarest, need, wide = min(window, key=lambda t: (n[t], t)), collections.Counter(window), len(window) + slop
            for j in range(len(words)):
                span = words[j : j + wide]
                if need <= collections.Counter(span):
                    at |= {j + i for i, w in enumerate(span) if w == rarest}
        near.append((d, len(at)))
    return sorted(near, key=repr)


@pytest.mark.parametrize("listed", [0, 20_000])
def test_near_hits_match_a_scan_of_all_spans(spark, monkeypatch, listed):
    monkeypatch.setattr(decontamination, "LISTED_TERMS", listed)
    window = "rare b c d e f g h i j".split()
    spaced = lambda before, after: " ".join(["b c d e"] + ["z"] * before + ["rare"] + ["z"] * after + ["f g h i j"])
    rows = [(i, spaced(a, b)) for i, (a, b) in enumerate([(0, 0), (5, 5), (6, 5), (10, 0), (14, 14), (0, 10), (0, 11)])]
    rows += [(20, " ".join(window)), (21, "two two k l m n o p q uniq"), (22, "two k l m n o p q uniq"), (23, "uniq " + "z " * 9 + "two k l m n two o p q"), (None, None), (24, "")]
    rows += [(30 + i, t) for i, (_, t) in enumerate(noisy_copies(7)[:40])]
    items = [(1, " ".join(window)), (2, "k l m n o p q two two uniq"), (3, rows[-1][1][:150]), (4, "q p o"), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = decontamination.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).select("doc_id", "n_near").collect()
    want = near_counts(rows, items)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert [dict(want)[i] for i in (0, 1, 2, 4, 20, 21, 22)] == [1, 1, 0, 0, 1, 2, 1]


def nearest(rows, step, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in ok if i % step == 0}):
        mine = [v for j, v in ok if j == i]
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for v in mine for j, w in ok if j != i and len(w) == len(v))
        out += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_top_k_matches_all_products(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)]) for i in range(300)] + [(i, [0.25, 0.5, -0.5]) for i in range(300, 500)]
    rows += [(600, None), (610, [None, 1.0, 2.0]), (620, [float("nan"), 1.0, 1.0]), (630, [float("inf"), 0.0, 0.0]), (640, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (650, [3.0, 4.0]), (660, [])]
    rows += [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(700, 900)] + [(700, rows[0][1])]
    rows += [(i, [rng.choice([9e6, -9e6, 0.5, 3e5]), rng.gauss(0, 1)]) for i in range(900, 960)]  # products beyond 2**53
    rows += [rows[350], rows[350], rows[300], rows[300], (720, rows[530][1])]  # repeated rows and ids
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    rounded = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    got = sorted(tuple(r) for r in mtree_search.top_k(df, F.col("vec_id") % 10 == 0, tree_rows=40, query_rows=7).collect())
    want = nearest(rounded, 10)
    assert got == want
    assert mtree_search.top_k(df.where("false"), F.col("vec_id") % 10 == 0).count() == 0


def test_trees_skip_what_their_bounds_rule_out():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(2)
    centers = rng.normal(0, 40, (20, 6))
    v = np.floor(centers[rng.integers(0, 20, 3000)] + rng.normal(0, 1, (3000, 6)))
    norm = (v * v).sum(axis=1)
    pages = mtree_search.build_pages(v, np.arange(3000), np.sqrt(norm.max() - norm))
    tree = mtree_search.Tree(pd.DataFrame(pages).assign(largest=math.sqrt(norm.max())))
    for q in range(0, 3000, 300):
        s = v @ v[q]
        s[q] = -math.inf
        assert [x for x, _ in tree.search(v[q], q, 5, -math.inf)] == sorted(s, reverse=True)[:5]
    assert tree.computed < 10 * 3000 * 0.9


def test_urls_are_judged_by_rules_then_by_links(spark):
    link = '<a href="{}">'.format
    rows = [
        (1, "https://A.com/x?q#f", link("http://friend.org/1") + link("/local")), (2, "http://www.example.com/en/1", None), (3, "http://m.example.com/en/1", ""), (4, "http://x.net/fr/", link("http://same.net/")),
        (5, "http://friend.org/p", None), (6, "http://spam.org/", link("//bad.net/fr/") * 3), (7, "http://bad.net/fr/x", None), (8, None, None), (9, "no scheme", "<a"), (10, "http://notcom/", None),
        (10, "http://notcom/", None), (None, "http://com", "x"), (11, "http://lone.io", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    out = collections.defaultdict(list)
    for r in url_filter.judge(pages, URL_RULES).collect():
        out[r.page_id].append((r.host, r.path, r.rule, r.verdict))
    assert out[1] == [("a.com", "/x", "com/", "allow")] and out[2] == [("www.example.com", "/en/1", "www.example.com/en/", "allow")]
    assert out[3] == [("m.example.com", "/en/1", "example.com/en/", "block")] and out[4][0][2:] == ("net/fr/", "block") and out[7][0][2:] == ("net/fr/", "block")
    assert out[5] == [("friend.org", "/p", None, "allow")] and out[6] == [("spam.org", "/", None, "block")]
    assert out[8] == [("", "", None, "allow")] and out[9] == out[8] and out[10] == [("notcom", "/", None, "allow")] * 2
    assert out[None] == [("com", "", None, "allow")] and out[11] == [("lone.io", "", None, "allow")]
    assert url_filter.judge(pages.where("false"), URL_RULES).count() == 0


def test_ranks_match_power_iteration(spark):
    import numpy as np

    rng = random.Random(4)
    edges = list({(rng.randrange(12), rng.randrange(12)) for _ in range(30)} - {(i, i) for i in range(12)})
    df = spark.createDataFrame([("k", str(a), str(b), 1.0 + a) for a, b in edges], "kind string, src string, dst string, weight double")
    seeds = spark.createDataFrame([("k", "3", 3.0), ("k", "5", 1.0)], "kind string, node string, amount double")
    got = {r.node: r.rank for r in url_filter.spread(df, seeds, tolerance=1e-9, rounds=60).collect()}
    m, s = np.zeros((12, 12)), np.zeros(12)
    s[3], s[5] = 0.75, 0.25
    for a, b in edges:
        m[b, a] = 1 / sum(x == a for x, _ in edges)
    r = s.copy()
    for _ in range(200):
        flow = 0.85 * m @ r
        r = flow + (1 - flow.sum()) * s
    assert all(abs(got.get(str(i), 0.0) - r[i]) < 1e-6 for i in range(12))


def test_distrust_reaches_far_hosts_behind_many_seeds(spark):
    """Chains of several hops and a link among very many, behind 20,000 equal seeds of each kind, at the default parameters."""
    link = '<a href="{}">'.format
    seeds = spark.range(20_000).select("id", F.explode(F.array(F.lit("http://good%d.com/"), F.lit("http://bad%d.net/es/"))).alias("url"))
    seeds = seeds.select(F.col("id").alias("page_id"), F.expr("format_string(url, id)").alias("url"), F.lit("").alias("html"))
    rows = [(100_000 + i, f"http://hop{i}.org/", link(f"http://hop{i - 1}.org/" if i else "http://bad7.net/")) for i in range(6)]
    rows += [(200_000, "http://crowd.org/", link("//bad8.net/") * 100_000), (200_001, "http://once.org/", link("//bad8.net/")), (200_002, "http://sub.hop3.org/", None), (200_003, "http://free.org/", None)]
    pages = seeds.union(spark.createDataFrame(rows, "page_id long, url string, html string"))
    verdicts = {r.page_id: r.verdict for r in url_filter.judge(pages, URL_RULES).where("page_id >= 100000").collect()}
    assert verdicts.pop(200_003) == "allow"
    assert verdicts == dict.fromkeys(verdicts, "block") and len(verdicts) == 9


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = entry.queries()[name](spark, str(DATA))
    cursor = con.execute(SQL[name])
    assert table(df.columns, df.collect()) == table([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
def test_every_operator_has_a_query():
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
def test_stages_keep_clean_documents_and_act_on_the_others(spark):
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    extra = [(None, None, None, None, None), (900_001, "", "en", "s", 0), (900_002, "12 34", "en", "s", 5), (900_003, "and the of token=abcdefgh1 with", None, None, None)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    sizes, before = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        before[name] = {(r.doc_id, r.text) for r in docs.collect()}
        out = stage(spark, docs, str(DATA))
        if name != "best_fit_packing":
            assert out.dtypes == docs.dtypes
            docs = corpus_pipeline.written(out, name)
            sizes[name] = {(r.doc_id, r.text) for r in docs.collect()}
    letters = lambda t: any(c.isalpha() for c in t or "")
    assert sizes["language_id"] == {x for x in before["language_id"] if letters(x[1])}
    rows = sorted(before["ngram_jaccard_join"])
    assert {d for d, _ in sizes["ngram_jaccard_join"]} == {c for *_, c in linked(rows)[0]}
    items = [tuple(r) for r in spark.read.parquet(str(DATA / "benchmark.parquet")).select("item_id", "text").collect()]
    dirty = {d for d, _, n, _ in leaks(sorted(before["benchmark_decontamination"]), items) if n}
    assert {d for d, _ in sizes["benchmark_decontamination"]} == {d for d, _ in before["benchmark_decontamination"]} - dirty
    assert sizes["secret_scan"] == {(d, secrets.redact(t, secrets.find_secrets(t))) for d, t in before["secret_scan"]}
    packed = corpus_pipeline.run(spark, str(DATA))
    assert packed.where("offset + length > 2048").isEmpty() and packed.select("doc_id").distinct().count() > 0


def test_python_tasks_get_batches_of_bounded_bytes(spark):
    """what a stage of the pipeline holds of its input follows from bytes, not from a number of rows."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())], ["n", "size"])

    spark.conf.unset(store.BATCH_CONF)
    long = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word " * 20), 500).alias("text")).coalesce(1)
    language_id.identify(long, language_id.Model([], {}, {}, None))
    seen = long.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in seen) == 300 and max(r["size"] for r in seen) <= 1.5 * store.BATCH_BYTES

    spark.conf.set(store.BATCH_CONF, "1m")  # a smaller setting stays
    secrets.redact_secrets(long)
    assert spark.conf.get(store.BATCH_CONF) == "1m"
    spark.conf.unset(store.BATCH_CONF)


def test_the_packing_plan_starts_no_python_workers_of_its_own(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "d " * 5000)], "doc_id long, text string")
    for rows in (docs, docs.limit(0)):
        packed = packing.pack_documents(rows, vocabulary(BYTE_VOCABULARY))
        plan = packed._jdf.queryExecution().toString()
        assert "ExistingRDD" not in plan and "LocalRelation" in plan
        assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in rows.collect()}
