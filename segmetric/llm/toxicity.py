"""Toxicity by cumulative-link ordinal regression.

Severity grades 0 (clean) to 3 are predicted from sparse word features: P(grade > k) =
sigmoid(w . x - t_k) with one weight vector for all ordered thresholds t_0 < t_1 < t_2. The
labels say only whether a document is toxic; a toxic document's grade in training is the
tercile, among the toxic ones, of how many different toxic-leaning features it holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetric.llm.common import small_side, written
from segmetric.llm.sampling import label_quota
from segmetric.llm.wordhash import SEGMENT, Words, _segments, distinct_sorted, mix

#: Byte lengths of the word beginnings that are features beside the whole word.
PREFIXES = (4, 5, 6)


def _piece_features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    w = Words(np.frombuffer(data, dtype=np.uint8))
    length = w.ends - w.starts
    found = [mix(w.hashes(w.starts, w.ends) + np.uint64(1))]
    place = [w.starts]
    for n in PREFIXES:
        some = length > n
        s = w.starts[some]
        found.append(mix(w.hashes(s, s + n) + np.uint64(100 + n)))
        place.append(s)
    return np.concatenate(found), np.concatenate(place)


class FeatureSet:
    """Sorted feature hashes with a bitmap in front, to look many hashes up fast."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.bitmap = np.zeros(1 << 16, dtype=bool)
        self.bitmap[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` that hold a feature, and its number."""
        if not len(self.hashes):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        at = np.flatnonzero(self.bitmap[(h & np.uint64(0xFFFF)).astype(np.int64)])
        no = np.searchsorted(self.hashes, h[at])
        no[no == len(self.hashes)] = 0
        good = self.hashes[no] == h[at]
        return at[good], no[good]


def document_features(texts: list[bytes], keep: FeatureSet | None) -> Iterator[tuple[int, np.ndarray]]:
    """(index, distinct features) for every text: their hashes, or with ``keep`` their numbers."""
    group: list[int] = []
    size = 0

    def flush():
        data = b"\n".join(texts[i] for i in group)
        if not data:
            for i in group:
                yield i, np.empty(0, dtype=np.uint64)
            return
        h, place = _piece_features(data)
        bounds = np.cumsum([0] + [len(texts[i]) + 1 for i in group])
        if keep is not None:
            at, no = keep.find(h)
            h, place = no, place[at]
        owner = np.searchsorted(bounds, place, side="right") - 1
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(group) + 1))
        for k, i in enumerate(group):
            yield i, distinct_sorted(h[order[cuts[k]:cuts[k + 1]]])

    for i, text in enumerate(texts):
        if len(text) >= SEGMENT:  # read in pieces; only distinct features are kept
            whole = None
            for at, to in _segments(text):
                h, _ = _piece_features(text[at:to]) if to - at < SEGMENT else (np.empty(0, dtype=np.uint64), None)
                h = keep.find(h)[1] if keep is not None else h
                whole = distinct_sorted(h if whole is None else np.concatenate([whole, h]))
            yield i, whole
            continue
        if size + len(text) + 1 > SEGMENT and group:
            yield from flush()
            group, size = [], 0
        group.append(i)
        size += len(text) + 1
    if group:
        yield from flush()


def _raw(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if t is not None else b"" for t in texts]


def _features_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        got = dict(document_features(_raw(b["text"]), None))
        yield pd.DataFrame({"row": b["row"], "toxic": b["toxic"], "f": [got[i].view(np.int64) for i in range(len(b))]})


@dataclass
class OrdinalModel:
    features: np.ndarray  # sorted uint64 hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; P(grade > k) = sigmoid(w . x - thresholds[k])

    def above(self, numbers: np.ndarray) -> np.ndarray:
        s = self.weights[numbers].sum() - self.thresholds
        return 1.0 / (1.0 + np.exp(-np.clip(s, -60, 60)))


def ordinal_fit(x: list[np.ndarray], grade: np.ndarray, sample_weight: np.ndarray, features: int, grades: int,
                steps: int = 400, rate: float = 0.1, l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the cumulative-link likelihood (Adam on the whole
    sample). Thresholds are a first value plus exponentials, so they stay ordered."""
    rows = np.repeat(np.arange(len(x)), [len(a) for a in x])
    cols = np.concatenate(x) if len(x) else np.empty(0, dtype=np.int64)
    k = grades - 1
    theta = np.zeros(features + k)
    theta[features] = 1.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    weight = sample_weight / sample_weight.sum()
    for t in range(1, steps + 1):
        w, cut = theta[:features], np.cumsum(np.concatenate((theta[features:features + 1], np.exp(theta[features + 1:]))))
        s = np.bincount(rows, weights=w[cols], minlength=len(x))
        up = 1.0 / (1.0 + np.exp(-np.clip(s[:, None] - cut[None, :], -60, 60)))  # P(grade > j)
        full = np.concatenate([np.ones((len(x), 1)), up, np.zeros((len(x), 1))], axis=1)
        at = np.arange(len(x))
        p = np.maximum(full[at, grade] - full[at, grade + 1], 1e-12)
        slope = full * (1 - full)
        ds = weight * (slope[at, grade] - slope[at, grade + 1]) / p
        dcut = np.zeros((len(x), k + 2))
        dcut[at, grade] -= weight * slope[at, grade] / p
        dcut[at, grade + 1] += weight * slope[at, grade + 1] / p
        dc = dcut[:, 1:-1].sum(axis=0)
        tail = np.cumsum(dc[::-1])[::-1]
        grad = np.concatenate([np.bincount(cols, weights=ds[rows], minlength=features) - l2 * w, tail[:1],
                               tail[1:] * np.exp(theta[features + 1:])])
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta = theta + rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return theta[:features], np.cumsum(np.concatenate((theta[features:features + 1], np.exp(theta[features + 1:]))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 toxic_col: str = "toxic", per_label: int = 3000, max_features: int = 4000,
                 min_docs: int = 4, min_z: float = 4.0, grades: int = 4) -> OrdinalModel | None:
    """Model of the labelled documents; None where either label is missing.

    Fitted on a bounded sample: about ``per_label`` labelled ids for each label, chosen by a hash of
    the id, weighted back to the labels' true shares. Features that at least ``min_docs`` sampled
    documents hold are ranked by their correlation with the label; of those whose test statistic
    reaches ``min_z`` the ``max_features`` strongest stay. Ids labelled both ways or more than once count as toxic if any label says so.
    """
    clean = (labels.where(F.col(id_col).isNotNull() & F.col(toxic_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(toxic_col)).cast("int").alias("toxic")))
    share = {r[0]: r[1] for r in clean.groupBy("toxic").count().collect()}
    if not share.get(0) or not share.get(1):
        return None
    picked = label_quota(clean, "toxic", F.col("id"), per_label)
    texts = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("text")).join(
        small_side(picked, 1_000_000), F.col("d") == F.col("id"))
    rows = written(texts.select(F.xxhash64("id", "text").alias("row"), "toxic", "text")
                   .mapInPandas(_features_of, "row long, toxic int, f array<long>").dropDuplicates(["row"]), "features")
    size = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        return None
    n = pos + neg
    counts = rows.select("toxic", F.explode("f").alias("f")).groupBy("f").agg(
        F.sum("toxic").alias("a"), F.count("*").alias("c")).where(F.col("c") >= min_docs)
    lean = F.col("a") * float(n) - F.col("c") * float(pos)
    chi = lean / F.sqrt(F.col("c").cast("double") * (n - F.col("c") + 0.5) * pos * neg)
    best = counts.select("f", chi.alias("chi")).where(F.abs("chi") * float(n) ** 0.5 >= min_z).orderBy(F.abs("chi").desc(), "f").limit(max_features).collect()
    best.sort(key=lambda r: r[0] & 0xFFFFFFFFFFFFFFFF)
    features = np.array([r[0] for r in best], dtype=np.int64).view(np.uint64)
    leaning = np.array([r[1] for r in best])
    wanted = docs.sparkSession.createDataFrame([(r[0], i) for i, r in enumerate(best)], "f long, no int")
    sparse = (rows.select("row", "toxic", F.explode_outer("f").alias("f")).join(F.broadcast(wanted), "f", "left")
              .groupBy("row", "toxic").agg(F.sort_array(F.collect_list("no")).alias("x")).orderBy("row").collect())
    x = [np.array(r[2], dtype=np.int64) for r in sparse]  # at most max_features numbers a row of the sample
    toxic = np.array([r[1] for r in sparse])
    strong = leaning > 0
    dose = np.array([strong[a].sum() for a in x])
    edges = np.quantile(dose[toxic == 1], np.arange(1, grades - 1) / (grades - 1))
    grade = np.where(toxic == 1, 1 + np.searchsorted(edges, dose, side="left"), 0)
    weight = np.where(toxic == 1, share[1] / pos, share[0] / neg)
    w, cut = ordinal_fit(x, grade, weight, len(features), grades)
    return OrdinalModel(features, w, cut)


def score_toxicity(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with p_toxic (P(grade > 0)), severity (expected grade), grade (most likely one)
    and toxic (p_toxic at or above ``threshold``).

    Reads whole texts. Null and blank texts hold no feature and get the clean base rate; without
    a model every row is clean with 0. Columns of ``docs`` with these names are replaced.
    """
    new = ["p_toxic", "severity", "grade", "toxic"]
    kept = [c for c in docs.columns if c.lower() not in new]

    @F.pandas_udf("p_toxic double, severity double, grade int")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        keep = FeatureSet(model.features) if model is not None else None
        for t in texts:
            if model is None:
                yield pd.DataFrame({"p_toxic": 0.0, "severity": 0.0, "grade": 0}, index=range(len(t)))
                continue
            rows = [(0.0, 0.0, 0)] * len(t)
            for i, found in document_features(_raw(t), keep):
                up = model.above(found.astype(np.int64))
                p = -np.diff(np.concatenate(([1.0], up, [0.0])))
                rows[i] = (float(up[0]), float(up.sum()), int(p.argmax()))
            yield pd.DataFrame(rows, columns=["p_toxic", "severity", "grade"])

    return docs.select(*[F.col(f"`{c}`") for c in kept], judge(F.col(f"`{text_col}`")).alias("__judged")).select(
        *[F.col(f"`{c}`") for c in kept], "__judged.p_toxic", "__judged.severity", "__judged.grade",
        (F.col("__judged.p_toxic") >= threshold).alias("toxic"))
