"""Document quality by a factorisation machine.

A score is a bias, one weight a feature and, for every pair of features, the product of
their values with the inner product of their factor vectors. The pairs are never formed: the
square of a factor's weighted sum less the sum of its squares is twice their sum, so a text
is scored in time linear in its features.

Features are hashed tokens (runs of letters and digits, runs of symbols), structure
statistics of the whole text and numeric metadata columns. A statistic lies between two of a
row of fixed points and counts for both, by nearness; so factors can tie ranges of it to words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmetric.llm.common import arrow_rows, small_side, written
from segmetric.llm.sampling import label_quota
from segmetric.llm.wordhash import SEGMENT, Words, _segments, distinct_sorted

#: Hash buckets of the tokens, and points of each statistic.
BUCKETS = 1 << 15
POINTS = 16
#: Structure statistics, each scaled to 0..1, in this order.
STATISTICS = ["length", "token_length", "upper", "digit", "symbol", "line_length", "distinct_tokens", "repeated_neighbours",
              "distinct_lines", "open_lines", "line_upper", "line_symbol", "line_repeated"]
#: Lines with fewer letters and symbols don't count for the three extremes over lines.
LINE_LEAST = 40
BATCH_ROWS = 1_000

_BLANK, _LETTER, _SYMBOL = 0, 1, 2


def _classes() -> np.ndarray:
    kind = np.full(256, _SYMBOL, dtype=np.int8)
    kind[[9, 10, 11, 12, 13, 32]] = _BLANK
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        kind[lo:hi] = _LETTER
    return kind


_KIND = _classes()


class _Text:
    """Running sums over the pieces of one text."""

    def __init__(self):
        self.sums = np.zeros(8)  # bytes, letters, upper, digits, symbols, tokens, repeated neighbours, open lines
        self.tokens: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.lines: list[np.ndarray] = []
        self.n_lines = 0
        self.most = np.zeros(3)

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token buckets, their values, and the statistics."""
        size, letters, upper, digits, symbols, tokens, repeated, open_lines = self.sums
        bucket = np.concatenate(self.tokens) if self.tokens else np.empty(0, dtype=np.int64)
        count = np.concatenate(self.counts) if self.counts else np.empty(0)
        if len(self.tokens) > 1:
            bucket, inverse = np.unique(bucket, return_inverse=True)
            count = np.bincount(inverse, weights=count, minlength=len(bucket))
        lines = distinct_sorted(np.concatenate(self.lines)) if self.lines else np.empty(0)
        shown = max(letters + symbols, 1.0)
        stats = np.array([
            np.log2(size + 1) / 24, min(1.0, letters / max(tokens, 1.0) / 16), upper / max(letters, 1.0), digits / shown,
            symbols / shown, min(1.0, np.log2(size / max(self.n_lines, 1) + 1) / 16), len(bucket) / max(tokens, 1.0),
            repeated / max(tokens, 1.0), len(lines) / max(self.n_lines, 1), open_lines / max(self.n_lines, 1), *self.most])
        value = np.log1p(count)
        norm = np.sqrt((value * value).sum())
        return bucket, value / norm if norm > 0 else value, np.clip(stats, 0.0, 1.0)


def _read(data: bytes, bounds: np.ndarray, into: list[_Text]) -> None:
    """Adds the texts data[bounds[i]:bounds[i + 1]] (with a line break at each end) to their sums."""
    raw = np.frombuffer(data, dtype=np.uint8)
    kind = _KIND[raw]
    edge = np.flatnonzero(np.diff(kind, prepend=np.int8(_BLANK), append=np.int8(_BLANK)))
    starts, ends = edge[:-1], edge[1:]
    shown = kind[starts] != _BLANK
    starts, ends = starts[shown], ends[shown]
    words = Words(raw)
    token = words.hashes(starts, ends)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    n = len(into)

    upper = (raw >= 65) & (raw <= 90)
    digit = (raw >= 48) & (raw <= 57)
    sums = np.zeros((len(raw) + 1, 5), dtype=np.int64)
    for k, mark in enumerate((kind == _LETTER, upper, digit, kind == _SYMBOL)):
        np.cumsum(mark, out=sums[1:, k])
    same = np.zeros(len(token), dtype=bool)
    if len(token) > 2:  # equal to its neighbour, or to the one after it where a symbol run stands between
        same[1:] = token[1:] == token[:-1]
        same[2:] |= (token[2:] == token[:-2]) & (kind[starts[1:-1]] == _SYMBOL) & (kind[starts[2:]] == _LETTER)
        same[1:] &= owner[1:] == owner[:-1]
        same[2:] &= owner[2:] == owner[:-2]
    repeated = np.concatenate(([0], np.cumsum(same)))

    # lines with anything to see, from the first to the last such byte
    breaks = np.flatnonzero(raw == 10)
    line_of = np.searchsorted(breaks, starts, side="left")
    head = np.flatnonzero(np.concatenate(([True], line_of[1:] != line_of[:-1]))) if len(starts) else np.empty(0, dtype=np.int64)
    tail = np.append(head[1:], len(starts))
    if len(head):
        at, to = starts[head], ends[tail - 1]
        line_owner = owner[head]
        line = words.hashes(at, to)
        per = sums[to] - sums[at]
        seen = per[:, 0] + per[:, 3]
        long = seen >= LINE_LEAST
        share = np.stack([per[:, 1] / np.maximum(per[:, 0], 1), per[:, 3] / np.maximum(seen, 1),
                          (repeated[tail] - repeated[head]) / (tail - head)], axis=1) * long[:, None]
        is_open = ~np.isin(raw[to - 1], np.frombuffer(b".!?:;\"')]", dtype=np.uint8))
    token_cut = np.searchsorted(owner, np.arange(n + 1))
    line_cut = np.searchsorted(line_owner, np.arange(n + 1)) if len(head) else np.zeros(n + 1, dtype=np.int64)
    whole = sums[bounds[1:]] - sums[bounds[:-1]]
    bucket = (token >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    # distinct buckets of each text, by one sort
    key = np.sort(owner * BUCKETS + bucket)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, dtype=np.int64)
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    cut = np.searchsorted(key, np.arange(n + 1) * BUCKETS)
    for i, text in enumerate(into):
        a, b = token_cut[i], token_cut[i + 1]
        c, d = line_cut[i], line_cut[i + 1]
        text.sums[0] += bounds[i + 1] - bounds[i]
        text.sums[1:5] += whole[i, :4]
        text.sums[5] += b - a
        text.sums[6] += repeated[b] - repeated[a]
        text.tokens.append(key[cut[i]:cut[i + 1]] - i * BUCKETS)
        text.counts.append(times[cut[i]:cut[i + 1]].astype(np.float64))
        if d > c:
            text.sums[7] += is_open[c:d].sum()
            text.lines.append(line[c:d])
            text.n_lines += d - c
            text.most = np.maximum(text.most, share[c:d].max(axis=0))


def text_features(texts: list[str | None]) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(index, features) of every whole text, in order. Short texts share numpy calls; long ones
    are read in pieces of 256 KB cut at blanks (a line across a cut counts as two)."""
    group: list[int] = []
    raw: list[bytes] = []
    size = 0

    def flush():
        into = [_Text() for _ in group]
        if any(raw):
            _read(b"\n".join(raw) + b"\n", np.cumsum([0] + [len(r) + 1 for r in raw]), into)
        for i, t in zip(group, into):
            yield i, t.features()

    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if text is not None else b""
        if size + len(data) + 1 > SEGMENT and group:
            yield from flush()
            group, raw, size = [], [], 0
        if len(data) >= SEGMENT:
            whole = _Text()
            for at, to in _segments(data):
                for k in range(at, to, SEGMENT):  # a single word longer than a piece
                    piece = data[k:min(to, k + SEGMENT)] + b"\n"
                    _read(piece, np.array([0, len(piece)]), [whole])
            yield i, whole.features()
            continue
        group.append(i)
        raw.append(data)
        size += len(data) + 1
    if group:
        yield from flush()


def _pointed(values: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of statistics in 0..1: the points below and above each."""
    at = values * (POINTS - 1)
    low = np.minimum(at.astype(np.int64), POINTS - 2)
    near = at - low
    base = offset + np.arange(len(values)) * POINTS + low
    return np.concatenate([base, base + 1]), np.concatenate([1 - near, near]) / np.sqrt(len(values))


def _scaled(meta: list) -> np.ndarray:
    """Metadata on a signed logarithmic scale to 0..1; null and NaN as 0.5, the scale's zero."""
    x = np.array([0.0 if v is None else float(v) for v in meta])
    x = np.nan_to_num(x, nan=0.0, posinf=1e300, neginf=-1e300)
    return np.clip(0.5 + np.sign(x) * np.log2(1 + np.abs(x)) / 64, 0.0, 1.0)


def _row(found: tuple[np.ndarray, np.ndarray, np.ndarray], meta: list) -> tuple[np.ndarray, np.ndarray]:
    bucket, value, stats = found
    no, x = _pointed(np.concatenate([stats, _scaled(meta)]), BUCKETS)
    return np.concatenate([bucket, no]), np.concatenate([value, x])


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray  # (features,)
    factors: np.ndarray  # (features, rank)

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Logits of the rows (feature numbers, values), by the sum-of-squares identity."""
        if not rows:
            return np.empty(0)
        no, x, cut = _flat(rows)
        return self.bias + _sums(self.weights[no] * x, cut) + _pairs(self.factors[no] * x[:, None], cut)[0]


def _flat(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cut = np.cumsum([0] + [len(r[0]) for r in rows])
    return np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), cut


def _sums(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Sums of the rows' stretches; no stretch is empty, as every text has its statistics."""
    return np.add.reduceat(values, cut[:-1], axis=0)


def _pairs(vx: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = _sums(vx, cut)
    return 0.5 * ((total * total).sum(axis=1) - _sums((vx * vx).sum(axis=1), cut)), total


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, sample_weight: np.ndarray, features: int,
                rank: int = 8, passes: int = 20, steps: int = 400, batch: int = 256, rate: float = 0.02,
                l2: float = 1e-3, seed: int = 7) -> FactorisationMachine:
    """Weights and factors that lessen the weighted log loss (Adam on batches in a seeded order;
    squared penalty on the features of the batch). As many passes as give ``steps`` batches,
    ``passes`` at least. Deterministic."""
    rng = np.random.default_rng(seed)
    theta = np.zeros((features, rank + 1), dtype=np.float64)
    theta[:, 1:] = rng.normal(0, 0.05, (features, rank))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    weight = sample_weight / sample_weight.mean()
    share = float((weight * y).sum() / weight.sum())
    bias, bias_m, bias_v = np.log(max(share, 1e-6) / max(1 - share, 1e-6)), 0.0, 0.0
    step = 0
    batches = -(-len(rows) // batch)
    for _ in range(max(passes, -(-steps // batches))):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            pick = order[at:at + batch]
            no, x, cut = _flat([rows[i] for i in pick])
            vx = theta[no, 1:] * x[:, None]
            pairs, total = _pairs(vx, cut)
            logit = bias + _sums(theta[no, 0] * x, cut) + pairs
            g = weight[pick] * (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y[pick]) / len(pick)
            owner = np.repeat(np.arange(len(pick)), np.diff(cut))
            gx = g[owner] * x
            used, inverse = np.unique(no, return_inverse=True)
            grad = np.empty((len(used), rank + 1))
            grad[:, 0] = np.bincount(inverse, weights=gx, minlength=len(used))
            inner = gx[:, None] * (total[owner] - vx)
            for k in range(rank):
                grad[:, k + 1] = np.bincount(inverse, weights=inner[:, k], minlength=len(used))
            grad += l2 * theta[used] / batches
            step += 1
            m[used] = 0.9 * m[used] + 0.1 * grad
            v[used] = 0.999 * v[used] + 0.001 * grad * grad
            fix = np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            theta[used] -= rate * fix * m[used] / (np.sqrt(v[used]) + 1e-8)
            bias_m, bias_v = 0.9 * bias_m + 0.1 * g.sum(), 0.999 * bias_v + 0.001 * g.sum() ** 2
            bias -= rate * fix * bias_m / (np.sqrt(bias_v) + 1e-8)
    return FactorisationMachine(float(bias), theta[:, 0].astype(np.float32), theta[:, 1:].astype(np.float32))


def _n_features(meta: list[str]) -> int:
    return BUCKETS + POINTS * (len(STATISTICS) + len(meta))


def _rows_of(meta: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            given = list(zip(*[b[f"meta{k}"].tolist() for k in range(len(meta))])) if meta else [()] * len(b)
            rows = [_row(found, list(given[i])) for i, found in text_features(b["text"].tolist())]
            yield pd.DataFrame({"h": b["h"], "label": b["label"], "no": [r[0].astype(np.int32) for r in rows],
                                "x": [r[1].astype(np.float32) for r in rows]})
    return run


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", meta: list[str] | None = None, per_label: int = 3000,
                **options) -> FactorisationMachine | None:
    """Machine fitted to the labelled documents; None where either label is missing.

    Fitted on a bounded sample: about ``per_label`` labelled ids for each label, chosen by a
    hash of the id and weighted back to the labels' true shares, so scores are shares of label
    1. Null ids and labels don't count; an id labelled both ways counts as 0. ``meta`` names numeric
    columns of ``docs`` that are features beside the text.
    """
    meta = meta or []
    clean = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.min((F.col(label_col) > 0).cast("int")).alias("label")))
    share = {r[0]: r[1] for r in clean.groupBy("label").count().collect()}
    if not share.get(0) or not share.get(1):
        return None
    picked = small_side(written(label_quota(clean, "label", F.col("id"), per_label).select("id", "label"), "picked"), 1_000_000)
    chosen = docs.select(F.col(f"`{id_col}`").alias("d"), F.col(f"`{text_col}`").alias("text"),
                         *[F.col(f"`{c}`").cast("double").alias(f"meta{k}") for k, c in enumerate(meta)]).join(
        picked, F.col("d") == F.col("id"))
    key = F.xxhash64("id", F.coalesce("text", F.lit("")))
    cols = ["h", "label", "text", *[f"meta{k}" for k in range(len(meta))]]
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        got = (chosen.withColumn("h", key).select(*cols).dropDuplicates(["h"])
               .mapInPandas(_rows_of(meta), "h long, label int, no array<int>, x array<float>").toArrow())
    order = np.argsort(got.column("h").to_numpy(), kind="stable")
    y = got.column("label").to_numpy()[order].astype(np.float64)
    held = {n: got.column(n).combine_chunks() for n in ("no", "x")}
    rows = [(held["no"][int(i)].values.to_numpy(zero_copy_only=False).astype(np.int64),
             held["x"][int(i)].values.to_numpy(zero_copy_only=False).astype(np.float64)) for i in order]
    del got, held
    if not len(y) or y.min() == y.max():
        return None
    weight = np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum())
    return fit_machine(rows, y, weight, _n_features(meta), **options)


def score_quality(docs: DataFrame, machine: FactorisationMachine | None, text_col: str = "text",
                  meta: list[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """``docs`` with score (probability of label 1) and predicted (1 if it reaches ``threshold``).

    Whole texts are read. Null and empty texts have no token and are scored by their
    statistics; equal texts with equal metadata get equal scores. Without a machine every score is 1.
    Columns of ``docs`` named score or predicted are replaced.
    """
    meta = meta or []
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]

    @F.pandas_udf("double")
    def judge(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            columns = columns if isinstance(columns, tuple) else (columns,)  # one column comes by itself
            texts = columns[0].tolist()
            if machine is None:
                yield pd.Series(np.ones(len(texts)))
                continue
            given = list(zip(*[c.tolist() for c in columns[1:]])) if meta else [()] * len(texts)
            out = np.zeros(len(texts))
            rows: list[tuple[np.ndarray, np.ndarray]] = []
            at: list[int] = []
            for i, found in text_features(texts):
                rows.append(_row(found, list(given[i])))
                at.append(i)
                if len(rows) == 256:
                    out[at] = machine.scores(rows)
                    rows, at = [], []
            if rows:
                out[at] = machine.scores(rows)
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -60, 60))))

    inputs = [F.col(f"`{text_col}`"), *[F.col(f"`{c}`").cast("double") for c in meta]]
    scored = docs.select(*kept, judge(*inputs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(id_col: str = "doc_id", parts: int = 5) -> Column:
    """Whether the unsigned crc32 of the id as text is a multiple of ``parts`` (null as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == 0
