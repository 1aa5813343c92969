"""Merkle manifest, quality classifier and spelling groups against brute force and held-out rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmetric.llm import merkle, quality, spelling

COLS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


# ---------------------------------------------------------------- Merkle manifest
def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def _siblings(levels, i):
    for nodes in levels[:-1]:
        run = i - i % 3
        yield nodes[run:i], nodes[i + 1:run + 3]
        i //= 3


def _manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        trees[s] = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
    levels = {s: _levels([_leaf(r) for r in trees[s]]) for s in order}
    top = _levels([levels[s][-1][0] for s in order])
    out = []
    for no, s in enumerate(order):
        for i, r in enumerate(trees[s]):
            path = [*_siblings(levels[s], i), *_siblings(top, no)]
            now = _leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                now = _leaf((*r[:4], r[4] and r[4].replace("\n", "")))
            for before, after in path:
                now = _h("".join(before) + now + "".join(after))
            out.append((r[0], _leaf(r), levels[s][-1][0], top[-1][0],
                        _h("".join(x for b, a in path for x in b + a)), now, now == top[-1][0]))
    return sorted(out, key=str)


def _verified(docs):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    got = merkle.verified_manifest(docs, COLS, "source", "doc_id", merkle.leaf_hash([*[F.col(c) for c in COLS[:4]], text]))
    return sorted((tuple(r) for r in got.collect()), key=str)


def _rows(n, sources, seed=0):
    rng = random.Random(seed)
    return [(i if rng.random() > 0.05 else rng.choice([None, i, 3]), rng.choice(sources), rng.choice(["en", None, "é"]),
             rng.choice([None, 5]), rng.choice([None, "", "one\ntwo", "größer\n", f"t{i}"])) for i in range(n)]


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_merkle_equals_brute_force(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "_BLOCK", merkle.FAN ** depth)
    rows = _rows(230, ["a"] * 6 + ["b", None, "", "é", "B"]) + [(1, "lone", None, None, "x\ny")]
    rows += rows[:9]  # repeated rows are leaves of their own
    assert _verified(spark.createDataFrame(rows, SCHEMA).repartition(5)) == _manifest(rows)


def test_merkle_sizes_around_powers(spark):
    for n in (1, 3, 4, 28):
        rows = [(i, "s", None, i, "x\n" * (i % 3)) for i in range(n)]
        assert _verified(spark.createDataFrame(rows, SCHEMA)) == _manifest(rows)


def test_merkle_odd_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert _verified(docs) == []
    long = [(7, None, None, None, "line\n" * 300_000)]
    extra = spark.createDataFrame(long, SCHEMA).selectExpr("*", "1 AS tree", "2 AS idx", "'x' AS digest", "3 AS id", "4 AS rest")
    assert _verified(extra) == _manifest(long)
    same = [(5, "hot", "en", 1, "a\nb")] * 400
    assert _verified(spark.createDataFrame(same, SCHEMA).repartition(7)) == _manifest(same)


def test_postorder_places(spark):
    """The closed form numbers the nodes in the order in which their last leaf is complete."""
    for leaves, levels in ((1, 0), (1, 3), (7, 2), (9, 2), (10, 3), (26, 3), (27, 3), (5, 6)):
        nodes = [(k, j) for k in range(levels + 1) for j in range(-(-leaves // 3 ** k))]
        want = {n: i for i, n in enumerate(sorted(nodes, key=lambda n: (min((n[1] + 1) * 3 ** n[0], leaves), n[0])))}
        got = spark.createDataFrame(nodes, "level int, j int").select(
            "level", "j", merkle.postorder(F.col("level"), F.col("j"), F.lit(leaves), F.lit(levels)).alias("at")).collect()
        assert {(r.level, r.j): r.at for r in got} == want


# ---------------------------------------------------------------- spelling
def _near(counts):
    near = {w: set() for w in counts}
    cut = {}
    for w in counts:
        for i in range(len(w)):
            d = w[:i] + w[i + 1:]
            if d in counts:
                near[w].add(d)
                near[d].add(w)
            cut.setdefault((i, len(w), d), set()).add(w)
    for group in cut.values():
        for w in group:
            near[w] |= group - {w}
    return near


def _groups(counts):
    near, form = _near(counts), {}
    for w in counts:
        if near[w]:
            best = min(near[w], key=lambda x: (-counts[x], x))
            if counts[best] >= 2 * counts[w]:
                form[w] = best
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.append((w, counts[w], len(near[w]), form.get(w), counts[form[w]] if w in form else None, root))
    return sorted(out)


def _spelled(words, *more):
    return sorted(tuple(r) for r in spelling.spelling_groups(words, *more).select(
        "word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.mark.parametrize("alphabet,parts,most", [("ab", 4, 4096), ("abé", 2, 8), ("abcdefgh", 1, 4), ("aÿ×", 3, 16)])
def test_spelling_equals_brute_force(spark, alphabet, parts, most):
    rng = random.Random(len(alphabet) * parts)
    counts = {}
    for _ in range(500):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9)))
        counts[w] = rng.choice([1, 1, 2, 3, 4, 4, 8, 16, 32, 64])
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert _spelled(words, parts, most) == _groups(counts)


def test_spelling_ties_long_words_and_empty(spark):
    long = "x" * 3_000
    counts = {"banana": 2, "bananas": 9, "bananaz": 9, "bandana": 9, long: 5, long + "y": 11, "x" * 2_990 + "z" + "x" * 10: 3,
              "other": 7}
    words = spark.createDataFrame([*counts.items(), (None, 4)], "word string, n long")
    got = _spelled(words)
    assert got == _groups(counts)
    assert ("banana", 2, 3, "bananas", 9, "bananas") in got  # equal counts: smallest word
    assert spelling.spelling_groups(words.limit(0)).count() == 0


def test_spelling_words_of_texts(spark):
    rows = [(1, "Größe GRÖSSE größe, über-übergroß naïve's x1abcde", 0, "q"), (2, None, 0, "q"), (3, "", 0, "q"),
            (4, "größe " * 70_000, 0, "q"), (None, "größe naïve", 0, "q"), (4, "naïve naïve", 0, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, word string")
    got = {r.word: r.n for r in spelling.word_counts(docs, min_count=1).collect()}
    assert got == {"größe": 70_003, "grÖsse": 1, "übergroß": 1, "naïve": 4, "abcde": 1}


def test_spelling_hot_list_is_dealt_again(spark):
    words = [f"aaaaaaaa{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    lists = spelling.sorted_lists(df, 4, 8).groupBy("size", "lo", "hi", "rest").count().collect()
    assert max(r["count"] for r in lists if r.hi - r.lo > 1) <= 8
    assert _spelled(df, 4, 8) == _groups({w: 5 for w in words})


# ---------------------------------------------------------------- quality
def test_pairs_by_the_sum_of_squares():
    rng = np.random.default_rng(0)
    machine = quality.FactorisationMachine(0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    rows = [(np.sort(rng.choice(30, size=k, replace=False)), rng.normal(size=k)) for k in (1, 2, 7, 13)]
    for (no, x), got in zip(rows, machine.scores(rows)):
        want = 0.3 + machine.weights[no] @ x + sum(
            machine.factors[no[i]] @ machine.factors[no[j]] * x[i] * x[j] for i in range(len(no)) for j in range(i))
        assert abs(got - want) < 1e-9


def test_quality_on_held_out_rows(spark):
    base = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text", "n_chars")
    labels = spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality")
    machine = quality.fit_quality(docs, labels.where(~quality.held_out()), meta=["n_chars"])
    held = quality.score_quality(docs, machine, meta=["n_chars"]).where(quality.held_out()).join(labels, "doc_id")
    got = {(r.quality, r.predicted): r["count"] for r in held.groupBy("quality", "predicted").count().collect()}
    assert got[0, 0] >= 0.9 * (got[0, 0] + got.get((0, 1), 0))
    assert got[1, 1] >= 0.98 * (got[1, 1] + got.get((1, 0), 0))


def test_quality_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 0), (8, 0), (9, None), (None, 1), (4, 1)], "doc_id long, quality int")
    odd = docs.selectExpr("*", "0.5D AS score", "'x' AS predicted", "CAST(NULL AS INT) AS h")
    machine = quality.fit_quality(odd, labels, meta=["repeats"])
    long = odd.limit(1).selectExpr(*[f"'{'word ' * 120_000}{'y' * 600_000}' AS text" if c == "text" else c for c in odd.columns])
    got = quality.score_quality(odd.unionByName(long), machine, meta=["repeats"])
    assert got.columns == [c for c in odd.columns if c not in ("score", "predicted")] + ["score", "predicted"]
    rows = got.collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 8}) == 1
    assert quality.fit_quality(odd, labels.where("quality = 1")) is None
    assert quality.fit_quality(empty, labels) is None
    assert quality.score_quality(empty, machine, meta=["repeats"]).count() == 0
    assert {r.predicted for r in quality.score_quality(docs, None).collect()} == {1}
    again = quality.fit_quality(odd.repartition(3), labels, meta=["repeats"])
    assert np.array_equal(machine.weights, again.weights)


def test_long_text_features_equal_short_pieces():
    text = "Some words, other words!\nlines 12 ***\n" * 20_000  # above one piece
    (_, whole), = quality.text_features([text])
    (_, part), = quality.text_features([text[: 38 * 500]])
    assert set(part[0]) == set(whole[0])
    assert np.allclose(whole[2][2:5], part[2][2:5], atol=1e-3)
