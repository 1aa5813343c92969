"""Language identification: sparse multinomial logistic regression on TF-IDF weighted
character n-grams, trained with follow-the-regularised-leader (per-coordinate steps,
elastic-net penalties), then calibrated with one temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetric.llm.common import arrow_rows, written
from segmetric.llm.sampling import label_quota

#: Hash buckets of the n-grams, their lengths, and characters read at a time.
BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
PIECE = 1 << 18
#: Texts of one Arrow batch during the fit.
BATCH_ROWS = 1_000

_FACTORS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed character n-grams of the whole lower-cased text, piece by piece."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    longest = max(ORDERS)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    for at in range(0, max(len(text), 1), PIECE):
        # a piece begins with the last characters of the one before, which only longer n-grams use
        lead = min(at, longest - 1)
        code = np.frombuffer(text[at - lead:at + PIECE].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for n in ORDERS:
            c = code[max(0, lead - (n - 1)):]
            if len(c) < n:
                continue
            h = c[: len(c) - n + 1] * _FACTORS[0] + np.uint32(n)
            for k in range(1, n):
                h = (h ^ (h >> np.uint32(15))) * _FACTORS[1] + c[k: len(c) - n + 1 + k] * _FACTORS[2]
            h = (h ^ (h >> np.uint32(13))) * _FACTORS[0]
            counts += np.bincount(h >> shift, minlength=BUCKETS)
    return counts


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _tf(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    return at, 1.0 + np.log(counts[at])


def _weighted(at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = tf * idf[at]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm > 0 else x


@dataclass
class LanguageModel:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (BUCKETS + 1, labels); the last row is the bias
    temperature: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        at, tf = _tf(counts)
        z = (_weighted(at, tf, self.idf) @ self.weights[at] + self.weights[-1]) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def _document_frequency(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per bucket and task: in how many of the task's texts it occurs."""
    df, n = np.zeros(BUCKETS, dtype=np.int64), 0
    for b in batches:
        for text in b["text"]:
            if text is not None:
                df += gram_counts(text) > 0
                n += 1
    at = np.flatnonzero(df)
    yield pd.DataFrame({"bucket": np.append(at, -1).astype(np.int64), "df": np.append(df[at], n)})


def _sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [_tf(gram_counts(t or "")) for t in b["text"]]
        yield pd.DataFrame({"h": b["h"], "label": b["label"], "at": [r[0].astype(np.int32) for r in rows],
                            "tf": [r[1].astype(np.float32) for r in rows]})


class _Sample:
    """The fitting sample as a stream of (buckets, values, class) in the order of the ids' hash. The
    driver holds one slice of about ``most`` n-grams at a time, whatever the sample's size."""

    def __init__(self, rows: DataFrame, labels: list[str], idf: np.ndarray, most: int = 1 << 21):
        self.rows, self.idf = rows, idf
        self.number = {v: k for k, v in enumerate(labels)}
        grams, self.count = rows.agg(F.coalesce(F.sum(F.size("at")), F.lit(0)), F.count("*")).first()
        slices = max(1, -(-int(grams) // most))
        step = (1 << 64) // slices
        self.cuts = [-(1 << 63) + k * step for k in range(slices)] + [1 << 63]
        self.kept = None  # a single slice is fetched once

    def _slice(self, k: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
        if self.kept is not None:
            return self.kept
        h = F.col("h")
        table = self.rows.where((h >= self.cuts[k]) & (h <= self.cuts[k + 1] - 1)).toArrow().combine_chunks()
        found = []
        if table.num_rows:
            columns = {n: table.column(n).chunk(0) for n in table.column_names}
            off = {n: columns[n].offsets.to_numpy() for n in ("at", "tf")}
            val = {n: columns[n].values.to_numpy() for n in ("at", "tf")}
            sizes = np.diff(off["at"])
            total = [float(val["tf"][a:b].sum()) for a, b in zip(off["tf"][:-1], off["tf"][1:])]
            names, keys = columns["label"].to_pylist(), columns["h"].to_numpy()
            for i in sorted(range(len(keys)), key=lambda i: (keys[i], names[i], sizes[i], total[i])):
                found.append((val["at"][off["at"][i]:off["at"][i + 1]], val["tf"][off["tf"][i]:off["tf"][i + 1]],
                              self.number[names[i]]))
        if len(self.cuts) == 2:
            self.kept = found
        return found

    def _stream(self, held: bool) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        no = 0
        for k in range(len(self.cuts) - 1):
            for at, tf, label in self._slice(k):
                if (no % 5 == 0) == held:
                    at = at.astype(np.int64)
                    yield at, _weighted(at, tf.astype(np.float64), self.idf), label
                no += 1

    def fit_rows(self) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        return self._stream(self.count < 2)

    def held_rows(self) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        return self._stream(True)


def ftrl_fit(rows, labels: int, passes: int = 3, alpha: float = 0.5,
             beta: float = 1.0, l1: float = 0.02, l2: float = 1.0) -> np.ndarray:
    """FTRL-proximal for a softmax over ``labels``; ``rows()`` streams (buckets, values, class),
    once a pass. The last weight row is the bias, without penalty."""
    z = np.zeros((BUCKETS + 1, labels))
    n = np.zeros((BUCKETS + 1, labels))

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(zi) <= l1] = 0.0
        if at[-1] == BUCKETS:
            w[-1] = -zi[-1] / ((beta + np.sqrt(n[BUCKETS])) / alpha)
        return w

    for _ in range(passes):
        for at, x, y in rows():
            at = np.append(at, BUCKETS)
            x = np.append(x, 1.0)
            w = weights(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1.0
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(BUCKETS + 1))


def fit_temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """Temperature that minimises the log loss of scores / T, by golden-section search on log T."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = scores / np.exp(t)
        m = s.max(axis=1)
        return float((m + np.log(np.exp(s - m[:, None]).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    lo, hi, g = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       per_label: int = 800, passes: int = 3) -> LanguageModel | None:
    """Model of the labelled rows of ``docs``; None where there are none.

    Document frequencies come from all labelled rows. The weights are fitted on a bounded
    sample: about ``per_label`` rows for each of the 200 most frequent labels, chosen by a hash
    of the id; every fifth row of it (by that hash) is kept out and sets the temperature.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("label")).where(
        F.col("text").isNotNull() & F.col("label").isNotNull())
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        freq = (rows.select("text").mapInPandas(_document_frequency, "bucket long, df long")
                .groupBy("bucket").agg(F.sum("df").alias("df")).toPandas())  # at most BUCKETS + 1 rows
    total = int(freq.loc[freq["bucket"] == -1, "df"].sum())
    if not total:
        return None
    df = np.zeros(BUCKETS)
    known = freq[freq["bucket"] >= 0]
    df[known["bucket"].to_numpy()] = known["df"].to_numpy()
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0
    key = F.xxhash64(F.col("id").cast("string"))
    sample = label_quota(rows, "label", F.col("id").cast("string"), per_label)
    rows = written(sample.select(key.alias("h"), "label", "text").mapInPandas(
        _sparse, "h long, label string, at array<int>, tf array<float>"), "grams", BATCH_ROWS)
    labels = [r[0] for r in rows.select("label").distinct().orderBy("label").collect()]
    data = _Sample(rows, labels, idf)
    weights = ftrl_fit(data.fit_rows, len(labels), passes)
    scores, y = [], []
    for at, x, label in data.held_rows():
        scores.append(x @ weights[at] + weights[-1])
        y.append(label)
    scores, y = np.array(scores), np.array(y, dtype=np.int64)
    return LanguageModel(labels, idf.astype(np.float32), weights.astype(np.float32),
                         fit_temperature(scores, y))


def predict_languages(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (calibrated probability of the predicted label).

    ``und`` with score 0 where the text is null or has no letter, or without a model. Every
    row is judged from its whole text alone; ties go to the first label by name. Columns of
    ``docs`` named lang_pred or score are replaced; all others come back as they were.
    """
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]

    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for t in texts:
            labels, scores = [], []
            for text in t:
                if model is None or text is None or not has_letter(text):
                    labels.append("und")
                    scores.append(0.0)
                    continue
                p = model.probabilities(gram_counts(text))
                labels.append(model.labels[int(p.argmax())])
                scores.append(float(p.max()))
            yield pd.DataFrame({"lang_pred": labels, "score": scores})

    return docs.select(*[F.col(f"`{c}`") for c in kept], judge(F.col(f"`{text_col}`")).alias("__judged")).select(
        *[F.col(f"`{c}`") for c in kept], "__judged.lang_pred", "__judged.score")


def keep_identified(docs: DataFrame, model: LanguageModel | None, min_score: float = 0.4, text_col: str = "text") -> DataFrame:
    """Rows whose language is found with at least ``min_score``; ``und`` rows go. A table
    without any labelled row gives no model, and then nothing is rejected."""
    if model is None:
        return docs
    p = predict_languages(docs.select("*", F.lit(None).alias("__none")), model, text_col)
    return p.where((F.col("lang_pred") != "und") & (F.col("score") >= min_score)).select(*[F.col(f"`{c}`") for c in docs.columns])


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose crc32(id as text) mod 4 is not 2 (null ids count as empty text)."""
    return docs.where(~held_out(id_col))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


__all__ = ["LanguageModel", "fit_language_model", "ftrl_fit", "gram_counts", "held_out", "keep_identified",
           "predict_languages", "training_rows", "written"]
