"""Brute-force checks and edge cases of the corpus operators."""

import datetime as dt
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmetric.llm import (
    decontaminate,
    kd_shards,
    langid,
    license_scan,
    mixing,
    ngram_join,
    pseudonyms,
    topk,
    toxicity,
    url_filter,
    wordhash,
)


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text, width=5):
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)}


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in groups[find(i)] if x is not None]
        out.append((d, len(sets[i]), min(known) if known else None))
    return Counter(out)


# ---------------------------------------------------------------- 1
def test_word_hashes_do_not_depend_on_position_or_pieces():
    text = " ".join(f"w{i % 977}" for i in range(400_000)).encode()
    whole = wordhash.text_word_hashes(text)
    assert len(whole) == 400_000
    assert np.array_equal(whole[:977], whole[977:1954])
    single = dict(wordhash.batched_word_hashes([b"w0 W1", None, b"", b"w0"]))
    assert single[0][0] == single[3][0] == whole[0] and single[0][1] == whole[1]
    assert len(single[1]) == len(single[2]) == 0


def test_join_edge_rows(docs, empty):
    got = ngram_join.ngram_jaccard_join(docs).collect()
    exp = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == exp
    assert ngram_join.ngram_jaccard_join(empty).count() == 0


def test_join_matches_brute_force_on_copies_and_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(ngram_join, "SEARCHES", 3)
    rnd = random.Random(5)
    vocab = [f"v{i}" for i in range(300)]
    passage = [rnd.choice(vocab) for _ in range(50)]
    base = [rnd.choice(vocab) for _ in range(90)]
    rows = []
    for d in range(160):
        kind = d % 4
        if kind == 0:  # near copies with up to four changed words
            w = list(base)
            for _ in range(rnd.randrange(5)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
        elif kind == 1:  # a shared passage with little of its own
            w = passage + [rnd.choice(vocab) for _ in range(rnd.randrange(4, 40))]
        elif kind == 2:
            w = [rnd.choice(vocab) for _ in range(rnd.randrange(1, 60))]
        else:
            w = rows[rnd.randrange(len(rows))][1].split() if rnd.random() < 0.5 else [rnd.choice(vocab[:9]) for _ in range(7)]
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(df).collect())
    assert got == brute_components(rows)


def test_join_keeps_links_of_short_sets_in_split_buckets(spark, monkeypatch):
    # a text and the text plus one word: 6 and 7 shingles are classes of their own once their bucket is split
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 4)
    rnd = random.Random(11)

    def shares(words):
        (_, hashed), = wordhash.batched_word_hashes([" ".join(words).encode()])
        return np.sort(wordhash.shingle_hashes(hashed, 5)).astype(float) / 2.0 ** 64

    def family(k):
        return [f"f{k}x{i}" for i in range(10)], f"f{k}end"

    # the text's first shingle lies in 0.4..0.5 of the hash range, the others from 0.5 on; the longer one's new shingle comes before
    def crossing(k):
        w, end = family(k)
        h = shares(w)
        return 0.4 < h[0] < 0.5 <= h[1] and shares([*w, end][-5:])[0] < h[0]

    rows = []
    for k in [*range(40), *[k for k in range(40, 4_000) if crossing(k)][:8]]:
        w, end = family(k)
        texts = [w, [*w, end], *[w[i:i + 5] for i in range(6)], *[w[i:] for i in range(1, rnd.randrange(2, 5))]]
        rows += [(len(rows) + i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(df).collect())
    assert got == brute_components(rows)


def test_tree_of_many_short_sets_is_small():
    import tracemalloc

    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 40, 5).astype(np.uint64)) for _ in range(8_000)]
    sets += [np.concatenate([s[:-1], s[-1:] + np.uint64(1)]) for s in sets]
    tracemalloc.start()
    tree = ngram_join.PrefixTree(sets, np.ones(len(sets), dtype=bool))
    found = []
    tree.search(np.arange(len(sets)), 60, lambda i, near: found.append(len(near)))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [2] * 16_000 and most < 200e6


def test_tree_search_equals_pairwise_overlaps():
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(3, 40)).astype(np.uint64)) for _ in range(30)]
    found = set()
    ngram_join.PrefixTree(sets, np.ones(30, dtype=bool)).search(
        np.arange(30), 60, lambda i, near: found.update((i, j) for j in near.tolist()))
    exp = {(i, j) for i in range(30) for j in range(30)
           if 100 * len(np.intersect1d(sets[i], sets[j])) >= 60 * len(np.union1d(sets[i], sets[j]))}
    assert found == exp


# ---------------------------------------------------------------- 2
def test_decontamination(spark, docs, empty):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    items = spark.createDataFrame([(1, item), (2, "two words"), (3, None), (4, ""), (1, item)], "item_id long, text string")
    long = " ".join(f"x{i}" for i in range(30_000))
    extra = spark.createDataFrame([
        (20, f"{long} {item.upper()} {long}", "en", "a", "q", 0), (21, item.replace("mu", "other"), "en", "a", "q", 0),
        (22, item.replace("zeta", "other"), "en", "a", "q", 0)], docs.schema)
    all_docs = docs.unionByName(extra)
    hit = {(r.doc_id, r.item_id, r.matched, r.n) for r in decontaminate.contained_items(all_docs, items).collect()}
    assert hit == {(20, 1, 8, 8), (21, 1, 7, 8), (8, 2, 1, 1), (9, 2, 1, 1)}
    left = decontaminate.decontaminate(all_docs, items)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([1, 2, 3, 4, 5, 6, 7, None, 22])
    assert decontaminate.contained_items(empty, items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == docs.count()


# ---------------------------------------------------------------- 3
def test_toxicity(spark, docs, empty):
    rnd = random.Random(1)
    rows, labels = [], []
    for d in range(240):
        w = [f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(5, 60))]
        bad = d % 3 == 0
        for _ in range(rnd.randrange(1, 6) if bad else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(["scumbag", "Moronic", "idiotz"]))
        rows.append((d, " ".join(w)))
        labels.append((d, int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels[:160] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(df, lab)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, model).collect()}
    assert sum(got[d].toxic == (d % 3 == 0) for d in range(160, 240)) >= 76
    one, many = (toxicity.score_toxicity(spark.createDataFrame([(1, t)], "doc_id long, text string"), model).first().severity
                 for t in ("fine scumbag text", "scumbag moronic idiotz text"))
    assert many > one
    out = toxicity.score_toxicity(docs, model)
    assert out.count() == docs.count() and out.where("toxic").count() == 0
    assert toxicity.score_toxicity(empty, model).count() == 0
    assert toxicity.fit_toxicity(df, lab.where("toxic = 0")) is None
    assert toxicity.score_toxicity(docs, None).where("severity <> 0").count() == 0


# ---------------------------------------------------------------- 4
def test_url_rules(spark):
    urls = ["http://A.Example.NET/en/1?x", "http://example.net/de/", "https://b.org/fr/x#t", "http://example.net", None, "",
            "no scheme/net/", "http://internet/", "http://x.net/", "http://example.com/de/1", "http://example.com/dex", "http://x.net/"]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = url_filter.rule_table(spark, [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")])
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[1] == ("example.net", "/de/", "net/", "block")
    assert got[2] == ("b.org", "/fr/x", "org/fr/", "allow")
    assert got[3] == ("example.net", "", None, "allow")
    assert got[4] == got[5] == got[6] == ("", "", None, "allow")
    assert got[7] == ("internet", "/", None, "allow")
    assert got[8] == got[11] == ("x.net", "/", "net/", "block")
    assert got[9][2:] == ("example.com/de/", "block") and got[10][2:] == (None, "allow")
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


# ---------------------------------------------------------------- 5
def brute_license(text):
    low = (text or "").lower()
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    starts = [(i, lab) for lab, p, e in license_scan.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in starts]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({v for _, v in starts}))


def test_license_scan(spark, docs, empty):
    texts = ["Licensed under the Apache License, Version 2.0. And the MIT License! mit\nlicense", "CC BY-NC 4.0", None, "",
             "licensed under the new apache license version 2 0", "mit licenses", "x " * 9000 + "GNU General Public License",
             "gnu general public licence", "cc by cc by"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "doc_id long, text string")
    got = license_scan.license_report(license_scan.license_spans(df)).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_license(texts[r.doc_id]), r
    by = {r.doc_id: r for r in got}
    assert by[0].labels == "apache,apache-2.0,mit" and by[0].score == 1.0
    assert "apache-2.0" in by[4].labels and by[2].labels == "" and by[2].score == 0.0
    assert license_scan.license_report(license_scan.license_spans(empty)).count() == 0
    assert license_scan.license_report(license_scan.license_spans(docs)).count() == docs.count()


# ---------------------------------------------------------------- 6
def test_language_id(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit_language_model(langid.training_rows(table), per_label=60)
    got = langid.predict_languages(table, model).where(langid.held_out()).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    odd = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict_languages(
        spark.createDataFrame([(1, None), (2, ""), (3, "123 !?")], "doc_id long, text string"), model).collect()}
    assert set(odd.values()) == {("und", 0.0)}
    assert langid.fit_language_model(empty) is None
    assert langid.predict_languages(docs, None).where("lang_pred <> 'und'").count() == 0
    assert langid.keep_identified(docs, model).columns == docs.columns
    text = "abc" * 700_000
    assert np.array_equal(langid.gram_counts(text).sum(), 3 * len(text) - 3)


# ---------------------------------------------------------------- 7
def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 8)
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.round(rnd.normal(size=6), 1)]) for i in range(130)]
    rows += [(131, None), (132, [float("nan")] * 6), (133, [None] * 6), (150, [1.0, 2.0]), (151, [2.0, 1.0]), (7, rows[7][1]), (None, rows[0][1])]
    rows += [(53, rows[50][1])] * 7 + [(100, rows[100][1])]  # repeated rows are candidates each, repeated queries one query
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.exact_top_k(df, k=5).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    data = [(i, tuple(np.floor(256 * np.array(v)).astype(int))) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for q, v in set(data):
        if q % 50 == 0:
            exp = sorted((-int(np.dot(v, w)), i) for i, w in data if i != q and len(w) == len(v))[:5]
            assert [got[q][k + 1] for k in range(len(exp))] == [(i, -s) for s, i in exp]
    assert topk.exact_top_k(df.limit(0)).count() == 0


def test_block_pruning_skips_blocks_and_loses_nothing():
    near = np.full((64, 4), 100)
    far = np.full((64, 4), 1)
    s, i, scored = topk.block_max_search(np.array([[10, 10, 10, 10]]), np.array([-1]), np.vstack([far, near]), np.arange(128), 5, 16)
    assert i[0].tolist() == [64, 65, 66, 67, 68] and scored == 4


# ---------------------------------------------------------------- 8
def test_mixing(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    weights = mixing.by_code_point(table, [3.0, 1.0, 2.0])
    plan = {r.source: r for r in mixing.mixing_plan(table, weights).collect()}
    size = {s: r.source_size for s, r in plan.items()}
    w = {s: [3, 1, 2][i % 3] for i, s in enumerate(sorted(size))}
    target = dict.fromkeys(size, 0.0)
    left, open_ = 1.5 * sum(size.values()), set(size)
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level > 2 * size[s]}
        for s in full or open_:
            target[s] = 2.0 * size[s] if full else w[s] * level
            left -= target[s] if full else 0
        open_ = open_ - full if full else set()
    for s, r in plan.items():
        assert r.target == pytest.approx(target[s])
    mixed = mixing.mix_sources(table, weights)
    assert mixed.columns == table.columns
    taken, largest = Counter(), Counter()
    for r in mixed.collect():
        taken[r.source] += len(words_of(r.text))
    for r in table.collect():
        largest[r.source] = max(largest[r.source], len(words_of(r.text)))
    for s in size:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1
    odd = mixing.mix_sources(docs, mixing.by_code_point(docs, [3.0, 1.0, 2.0]))
    assert odd.columns == docs.columns and max(Counter((r.doc_id, r.text) for r in odd.collect()).values()) <= 4
    assert mixing.mix_sources(empty, mixing.by_code_point(empty, [1.0])).count() == 0


def test_mixing_of_null_and_repeated_ids(spark):
    rows = [(None if i % 10 else i, "w " * (1 + i % 30), "a") for i in range(1000)] + [(5, "x y", "b")] * 3
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    words = sum(1 + i % 30 for i in range(1000))
    taken = Counter()
    for r in mixing.mix_sources(table, mixing.by_code_point(table, [1.0, 3.0]), share=0.5).collect():
        taken[r.source] += len(words_of(r.text))
    repeated = max(Counter((r[0], r[1]) for r in rows).values()) * 30
    assert abs(taken["a"] - (0.5 * (words + 6) - 12)) <= repeated / 2


# ---------------------------------------------------------------- 9
def luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if c > "4" else int(c) * 2) for i, c in enumerate(reversed(d))) % 10 == 0


def test_pseudonyms(spark, docs, empty):
    texts = ["card 4041894974608795, again 4041-8949-7460-8795.", "x 4041894974608796 y", "call +1 (988) 555-2485 or (988) 555-2485",
             "ip 70.123.182.155 not 1.2.3.4.5 nor 300.1.1.1", "born 1999-02-28, 28.02.1999 and 02/28/1999 not 1999-02-30",
             "ssn 123-45-6789 not 666-45-6789", "mail Bob.42@mail8.example.com bob.42@MAIL8.example.com", None, "", "no numbers"]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, pii string")
    got = {r.doc_id: r for r in pseudonyms.pseudonymise(df, pseudonyms.key_table(spark, "k")).collect()}
    a, b = re.findall(r"\d[\d-]{12,}\d", got[0].text)
    assert a == b.replace("-", "") != "4041894974608795" and luhn(a) and a[0] == "4" and b.count("-") == 3
    assert got[1].text == texts[1] and got[7].text is None and got[8].text == "" and got[9].text == texts[9]
    one, two = re.search(r"\+1 (\(\d{3}\) \d{3}-\d{4}) or (.*)", got[2].text).groups()
    assert one == two != "(988) 555-2485"
    assert re.fullmatch(r"ip (\d+\.){3}\d+ not 1\.2\.3\.4\.5 nor 300\.1\.1\.1", got[3].text) and got[3].text != texts[3]
    iso, dot, us = re.search(r"born (\S+), (\S+) and (\S+) not 1999-02-30", got[4].text).groups()
    day = dt.date.fromisoformat(iso)
    assert dot == day.strftime("%d.%m.%Y") and us == day.strftime("%m/%d/%Y") and iso != "1999-02-28"
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4} not 666-45-6789", got[5].text) and "123-45-6789" not in got[5].text
    x, y = got[6].text.split()[1:]
    assert x == y and "bob" not in x.lower()
    assert got[2].pii == {"phone": 2} and got[9].pii == {}
    assert pseudonyms.pseudonymise(docs, pseudonyms.key_table(spark, "k")).count() == docs.count()
    assert pseudonyms.pseudonymise(empty, pseudonyms.key_table(spark, "k")).count() == 0


def test_pseudonyms_next_to_other_numbers(spark):
    values = {"4111 1111 1111 1111": "card", "4111111111111111": "card", "4041894974608795": "card",
              "555-123-4567": "phone", "123-45-6789": "ssn"}
    texts = ["4111 1111 1111 1111 12/25", "4111111111111111 123", "4111 1111 1111 1111 123", "12 4041894974608795",
             "1234 4111 1111 1111 1111", "1234 555-123-4567", "2024 555-123-4567", "2023 555-123-4567", "555-123-4567 1234",
             "1234 123-45-6789", "4111 1111 1111 1111 555-123-4567", "a \ue000 555-123-4567 \ue000 b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pseudonyms.pseudonymise(df, pseudonyms.key_table(spark, "k")).collect():
        held = [v for v in values if v in texts[r.doc_id]]
        assert r.pii == Counter(values[v] for v in held), texts[r.doc_id]
        rest = texts[r.doc_id]
        for v in held:
            assert v not in r.text
            rest = rest.replace(v, "|")
        assert re.fullmatch(".+".join(map(re.escape, rest.split("|"))), r.text), (texts[r.doc_id], r.text)
    same = ["4111 1111 1111 1112", "4111111111111112 99", "1" * 25]
    df = spark.createDataFrame(list(enumerate(same)), "doc_id long, text string")
    assert {r.text for r in pseudonyms.pseudonymise(df, pseudonyms.key_table(spark, "k")).collect()} == set(same)


def test_pseudonyms_of_phones_and_dates(spark):
    found = {"+19885552485": "phone", "(988)555-2485": "phone", "030 123 4567": "phone", "988 555 2485": "phone",
             "25/12/1999": "date", "2099-12-31": "date"}
    left = ["9885552485", "100 200 3000 items", "rooms 12 345 6789 sold", "13/13/1999", "2100-01-01", "988 155 2485"]
    df = spark.createDataFrame([(i, f"at {t} there") for i, t in enumerate([*found, *left])], "doc_id long, text string")
    done = pseudonyms.pseudonymise(df, pseudonyms.key_table(spark, "the-secret"))
    rows = {r.doc_id: r for r in done.collect()}
    for i, (t, kind) in enumerate(found.items()):
        assert rows[i].pii == {kind: 1} and t not in rows[i].text, t
    for i, t in enumerate(left, len(found)):
        assert rows[i].text == f"at {t} there" and rows[i].pii == {}, t
    plan = done._jdf.queryExecution().toString() + done._jdf.queryExecution().logical().toString()
    assert "the-secret" not in plan


def test_feistel_is_a_permutation(spark):
    d = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    out = d.select(F.expr(pseudonyms.digits_permuted("d", "'k'", "'t'")).alias("p")).collect()
    assert sorted(r.p for r in out) == [f"{i:03d}" for i in range(1000)]
    days = spark.sql("select cast(date_add(date'1900-01-01', cast(id as int)) as string) as d from range(0, 73049, 7)")
    got = [r.p for r in days.select(F.expr(pseudonyms._date("d", "'k'")).alias("p")).collect()]
    assert len(set(got)) == len(got) and all(dt.date.fromisoformat(g) for g in got)


# ---------------------------------------------------------------- 10
def test_kd_shards(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = kd_shards.kd_shards(table, 8, slots=True).collect()
    total, load, slots = 0, Counter(), {}
    for r in rows:
        assert r.size == len(r.text.encode()) + 1 and r.text_crc32 == zlib.crc32(r.text.encode())
        load[r.shard] += r.size
        total += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == table.count() and set(load) == set(range(8))
    assert max(load.values()) - min(load.values()) < 0.02 * total / 8 + 40_000
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    many = kd_shards.kd_shards(table, None, target_bytes=total // 5 + 1)
    assert many.select("shard").distinct().count() == 5
    odd = kd_shards.kd_shards(docs, 8, slots=True)
    assert Counter(r.doc_id for r in odd.collect()) == Counter(r.doc_id for r in docs.collect())
    assert set(docs.columns) <= set(odd.columns)
    assert kd_shards.kd_shards(empty, 8, slots=True).count() == 0
    same = spark.range(40).selectExpr("id as doc_id", "'same text' as text")
    assert sorted(Counter(r.shard for r in kd_shards.kd_shards(same, 8).collect()).values()) == [5] * 8
