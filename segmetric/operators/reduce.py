"""Dimension reduction as Spark ML stages: centred PCA (X6) and the binary
linear discriminant axis (X7, full and partial).

Second moments come from a distributed Gramian: each partition sums
(count, x, x x^T) per class with numpy (``mapInPandas``), Spark adds the
partials with a grouped sum over the d*d slots, and only the d x d result
reaches the driver. The projection itself is a dot product expression.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetric.operators.prep import _Stage


def gramian(df: DataFrame, vec_col: str, by: str | None = None) -> dict:
    """{group: (n, sum x (d,), sum x x^T (d, d))} for a vector or array column."""
    key = by or "__g"
    src = df.select((F.col(by) if by else F.lit(0)).cast("long").alias(key),
                    vector_to_array(vec_col).alias("v") if dict(df.dtypes)[vec_col] == "vector"
                    else F.col(vec_col).cast("array<double>").alias("v"))

    def partial(it):
        acc: dict = {}
        for pdf in it:
            for g, part in pdf.groupby(key):
                x = np.stack(part["v"].to_numpy()).astype(np.float64)
                n, s, ss = acc.get(g, (0, 0.0, 0.0))
                acc[g] = (n + len(x), s + x.sum(0), ss + x.T @ x)
        rows = []
        for g, (n, s, ss) in acc.items():
            d = len(s)
            rows.append(pd.DataFrame({key: g, "slot": np.arange(-1 - d, d * d), "val": np.concatenate(
                [[float(n)], s, ss.ravel()])}))
        yield pd.concat(rows) if rows else pd.DataFrame({key: [], "slot": [], "val": []})

    sums = src.mapInPandas(partial, f"{key} long, slot long, val double").groupBy(key, "slot").agg(
        F.sum("val").alias("val")).collect()
    out: dict = {}
    for r in sums:
        out.setdefault(r[key], {})[r["slot"]] = r["val"]
    res = {}
    for g, slots in out.items():
        d = int(round((-1 - min(slots)) if slots else 0))
        n = slots[-1 - d]
        s = np.array([slots[-d + i] for i in range(d)])
        ss = np.array([slots[i] for i in range(d * d)]).reshape(d, d)
        res[g if by else None] = (n, s, ss)
    return res


def _dot(arr: F.Column, w: list[float]) -> F.Column:
    return F.aggregate(F.zip_with(arr, F.array(*[F.lit(float(x)) for x in w]), lambda a, b: a * b),
                       F.lit(0.0), lambda acc, v: acc + v)


class _ProjParams(HasInputCol, HasOutputCol):
    k = Param(Params._dummy(), "k", "number of output axes", TypeConverters.toInt)


class CentredPCA(Estimator, _ProjParams, _Stage):
    """PCA of centred data; each axis signed so its largest |loading| is positive."""

    def __init__(self, inputCol: str = "features", outputCol: str = "pca", k: int = 2):
        super().__init__()
        self._set_all(inputCol=inputCol, outputCol=outputCol, k=k)

    def _fit(self, df):
        n, s, ss = gramian(df, self.getInputCol())[None]
        mean = s / n
        cov = (ss - n * np.outer(mean, mean)) / (n - 1)
        vals, vecs = np.linalg.eigh(cov)
        order = np.argsort(vals)[::-1][: min(self.getOrDefault(self.k), len(mean))]
        comps = vecs[:, order].T
        for c in comps:
            if c[np.argmax(np.abs(c))] < 0:
                c *= -1
        return CentredPCAModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
                               mean=mean.tolist(), components=[c.tolist() for c in comps],
                               explained=[float(vals[i]) for i in order])


class CentredPCAModel(Model, _ProjParams, _Stage):
    mean = Param(Params._dummy(), "mean", "training mean", TypeConverters.toListFloat)
    components = Param(Params._dummy(), "components", "axes (rows)", TypeConverters.toList)
    explained = Param(Params._dummy(), "explained", "explained variance per axis", TypeConverters.toListFloat)

    def __init__(self, inputCol=None, outputCol=None, mean=None, components=None, explained=None):
        super().__init__()
        self._set_all(inputCol=inputCol, outputCol=outputCol, mean=mean, components=components, explained=explained)

    def _transform(self, df):
        arr = vector_to_array(self.getInputCol())
        mean = np.array(self.getOrDefault(self.mean))
        axes = [(_dot(arr, c) - F.lit(float(np.dot(mean, c)))) for c in self.getOrDefault(self.components)]
        return df.withColumn(self.getOutputCol(), array_to_vector(F.array(*axes)))


class DiscriminantAxis(Estimator, _ProjParams, _Stage):
    """Binary linear discriminant direction w = pinv(Sw) (mu1 - mu0), Sw the
    pooled within-class covariance (divided by n - 2), scaled to unit
    within-class variance; output centred on the prior-weighted mean."""

    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    passthrough = Param(Params._dummy(), "passthrough", "slot indexes appended unchanged", TypeConverters.toListInt)
    slots = Param(Params._dummy(), "slots", "slot indexes projected (empty = all)", TypeConverters.toListInt)

    def __init__(self, inputCol="features", outputCol="lda", labelCol="label", slots=(), passthrough=()):
        super().__init__()
        self._set_all(inputCol=inputCol, outputCol=outputCol, labelCol=labelCol, slots=list(slots),
                      passthrough=list(passthrough), k=1)

    def _fit(self, df):
        slots = self.getOrDefault(self.slots)
        arr = vector_to_array(self.getInputCol())
        sub = F.array(*[arr[i] for i in slots]) if slots else arr
        g = gramian(df.select(F.col(self.getOrDefault(self.labelCol)).cast("long").alias("y"), sub.alias("v")),
                    "v", by="y")
        n0, s0, ss0 = g[0]
        n1, s1, ss1 = g[1]
        m0, m1 = s0 / n0, s1 / n1
        sw = (ss0 - n0 * np.outer(m0, m0) + ss1 - n1 * np.outer(m1, m1)) / (n0 + n1 - 2)
        w = np.linalg.pinv(sw, rcond=1e-10, hermitian=True) @ (m1 - m0)
        var = float(w @ sw @ w)
        w = w / np.sqrt(var) if var > 0 else w
        centre = (n0 * m0 + n1 * m1) / (n0 + n1)
        return DiscriminantAxisModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), slots=slots,
                                     passthrough=self.getOrDefault(self.passthrough), weights=w.tolist(),
                                     offset=float(centre @ w))


class DiscriminantAxisModel(Model, _ProjParams, _Stage):
    slots = Param(Params._dummy(), "slots", "slot indexes projected (empty = all)", TypeConverters.toListInt)
    passthrough = Param(Params._dummy(), "passthrough", "slot indexes appended unchanged", TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "projection weights", TypeConverters.toListFloat)
    offset = Param(Params._dummy(), "offset", "projection of the centre", TypeConverters.toFloat)

    def __init__(self, inputCol=None, outputCol=None, slots=None, passthrough=None, weights=None, offset=None):
        super().__init__()
        self._set_all(inputCol=inputCol, outputCol=outputCol, slots=slots, passthrough=passthrough,
                      weights=weights, offset=offset)

    def _transform(self, df):
        arr = vector_to_array(self.getInputCol())
        slots = self.getOrDefault(self.slots)
        sub = F.array(*[arr[i] for i in slots]) if slots else arr
        z = _dot(sub, self.getOrDefault(self.weights)) - F.lit(self.getOrDefault(self.offset))
        keep = [arr[i] for i in self.getOrDefault(self.passthrough)]
        return df.withColumn(self.getOutputCol(), array_to_vector(F.array(z, *keep)))
