"""Leakage-free feature preparation as Spark ML stages.

Fitted statistics (modes, vocabularies, medians, means, population standard
deviations) are computed with grouped aggregates on the training rows only and
stored as plain Params, so the stages persist with ``PipelineModel.save``.
Transforms are built-in column expressions plus a ``VectorAssembler``; output
vectors carry the feature names as ML attribute metadata.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from segmetric.operators.quantiles import quantiles


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    def _set_all(self, **kw):
        self._set(**{k: v for k, v in kw.items() if v is not None})
        return self


def _value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(name, sval, nkey, count) of non-null values; nkey orders numeric columns by value."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("sval"),
                 (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("nkey"))
        for c in cols])).alias("p")).select("p.*")
    return long.where(F.col("sval").isNotNull()).groupBy("name", "sval", "nkey").count()


def column_modes(df: DataFrame, cols: list[str]) -> dict[str, str]:
    """Most frequent non-null value per column; ties go to the smallest value."""
    counts = _value_counts(df, cols)
    best = counts.groupBy("name").agg(F.min_by("sval", F.struct(-F.col("count"), "nkey", "sval")).alias("mode"))
    return {r["name"]: r["mode"] for r in best.collect()}


def column_vocabulary(df: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null values per column (numeric columns by value).
    The vocabulary is the output dimension of the encoding, so it is collected."""
    rows = _value_counts(df, cols).select("name", "sval", "nkey").collect()
    out: dict[str, list] = {c: [] for c in cols}
    for r in sorted(rows, key=lambda r: (r["name"], r["nkey"] if r["nkey"] is not None else 0.0, r["sval"])):
        out[r["name"]].append(r["sval"])
    return out


# ------------------------------------------------------------------ X1
class ModeImputer(Estimator, HasInputCols, _Stage):
    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        self._set_all(inputCols=inputCols)

    def _fit(self, df):
        cols = self.getInputCols()
        modes = column_modes(df, cols)
        return ModeImputerModel(inputCols=cols, fills=[modes.get(c) for c in cols])


class _FillParams(HasInputCols):
    fills = Param(Params._dummy(), "fills", "fill value per input column (as text)", TypeConverters.toList)


class ModeImputerModel(Model, _FillParams, _Stage):
    def __init__(self, inputCols: list[str] | None = None, fills: list | None = None):
        super().__init__()
        self._set_all(inputCols=inputCols, fills=fills)

    def _transform(self, df):
        fills = dict(zip(self.getInputCols(), self.getOrDefault(self.fills)))
        return df.select(*[
            F.coalesce(F.col(c), F.lit(fills[c]).cast(df.schema[c].dataType)).alias(c)
            if c in fills and fills[c] is not None else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ X2
class MedianImputer(Estimator, HasInputCols, _Stage):
    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        self._set_all(inputCols=inputCols)

    def _fit(self, df):
        cols = self.getInputCols()
        med = {r["column"]: r["value"] for r in quantiles(df, cols, [0.5]).collect()}
        return MedianImputerModel(inputCols=cols, fills=[med.get(c) for c in cols])


class MedianImputerModel(Model, _FillParams, _Stage):
    def __init__(self, inputCols: list[str] | None = None, fills: list | None = None):
        super().__init__()
        self._set_all(inputCols=inputCols, fills=fills)

    def _transform(self, df):
        fills = dict(zip(self.getInputCols(), self.getOrDefault(self.fills)))
        return df.select(*[
            F.coalesce(F.col(c).cast("double"), F.lit(fills[c]).cast("double")).alias(c)
            if c in fills and fills[c] is not None else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ X3
class CategoryEncoder(Estimator, HasInputCols, _Stage):
    """Full one-hot (no dropped level); categories sorted; unknown -> all zeros.
    Output columns are named ``{prefix}{col}_{value}``."""

    prefix = Param(Params._dummy(), "prefix", "output name prefix", TypeConverters.toString)

    def __init__(self, inputCols: list[str] | None = None, prefix: str = "cat__"):
        super().__init__()
        self._set_all(inputCols=inputCols, prefix=prefix)

    def _fit(self, df):
        cols = self.getInputCols()
        vocab = column_vocabulary(df, cols)
        return CategoryEncoderModel(inputCols=cols, prefix=self.getOrDefault(self.prefix),
                                    vocabulary=[vocab[c] for c in cols])


class CategoryEncoderModel(Model, HasInputCols, _Stage):
    prefix = Param(Params._dummy(), "prefix", "output name prefix", TypeConverters.toString)
    vocabulary = Param(Params._dummy(), "vocabulary", "sorted categories per column", TypeConverters.toList)

    def __init__(self, inputCols=None, prefix=None, vocabulary=None):
        super().__init__()
        self._set_all(inputCols=inputCols, prefix=prefix, vocabulary=vocabulary)

    def output_names(self) -> list[str]:
        p = self.getOrDefault(self.prefix)
        return [f"{p}{c}_{v}" for c, vs in zip(self.getInputCols(), self.getOrDefault(self.vocabulary)) for v in vs]

    def _transform(self, df):
        p = self.getOrDefault(self.prefix)
        ind = []
        for c, vs in zip(self.getInputCols(), self.getOrDefault(self.vocabulary)):
            text = F.col(c).cast("string")
            ind += [F.coalesce((text == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{p}{c}_{v}") for v in vs]
        return df.select("*", *ind)


# ------------------------------------------------------------------ X4
class PopulationScaler(Estimator, HasInputCols, _Stage):
    """Standardise with the population std (ddof=0); zero variance divides by 1.
    Output columns are ``{prefix}{col}``."""

    prefix = Param(Params._dummy(), "prefix", "output name prefix", TypeConverters.toString)

    def __init__(self, inputCols: list[str] | None = None, prefix: str = "num__"):
        super().__init__()
        self._set_all(inputCols=inputCols, prefix=prefix)

    def _fit(self, df):
        cols = self.getInputCols()
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        means = [float(row[f"m{i}"]) if row[f"m{i}"] is not None else 0.0 for i in range(len(cols))]
        stds = [float(row[f"s{i}"]) if row[f"s{i}"] else 1.0 for i in range(len(cols))]
        return PopulationScalerModel(inputCols=cols, prefix=self.getOrDefault(self.prefix), means=means, stds=stds)


class PopulationScalerModel(Model, HasInputCols, _Stage):
    prefix = Param(Params._dummy(), "prefix", "output name prefix", TypeConverters.toString)
    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population standard deviations (0 -> 1)", TypeConverters.toListFloat)

    def __init__(self, inputCols=None, prefix=None, means=None, stds=None):
        super().__init__()
        self._set_all(inputCols=inputCols, prefix=prefix, means=means, stds=stds)

    def output_names(self) -> list[str]:
        return [f"{self.getOrDefault(self.prefix)}{c}" for c in self.getInputCols()]

    def _transform(self, df):
        p = self.getOrDefault(self.prefix)
        out = [((F.col(c).cast("double") - F.lit(m)) / F.lit(s)).alias(f"{p}{c}")
               for c, m, s in zip(self.getInputCols(), self.getOrDefault(self.means), self.getOrDefault(self.stds))]
        return df.select("*", *out)


# ------------------------------------------------------------------ X5 assembly
class FeatureAssembler(Estimator, HasOutputCol, _Stage):
    """Collects the prepared columns (by prefix, categorical block first) at fit
    time and assembles them into one vector; names go to the vector metadata."""

    prefixes = Param(Params._dummy(), "prefixes", "column prefixes in block order", TypeConverters.toListString)
    dropPrefixes = Param(Params._dummy(), "dropPrefixes", "P2: drop names with these prefixes",
                         TypeConverters.toListString)
    dropNames = Param(Params._dummy(), "dropNames", "P2: drop these exact names", TypeConverters.toListString)

    def __init__(self, outputCol: str = "features", prefixes=("cat__", "num__"), dropPrefixes=(), dropNames=()):
        super().__init__()
        self._set_all(outputCol=outputCol, prefixes=list(prefixes), dropPrefixes=list(dropPrefixes),
                      dropNames=list(dropNames))

    def _fit(self, df):
        names = []
        for p in self.getOrDefault(self.prefixes):
            names += [c for c in df.columns if c.startswith(p)]
        drop_p = self.getOrDefault(self.dropPrefixes)
        drop_n = set(self.getOrDefault(self.dropNames))
        keep = [c for c in names if c not in drop_n and not any(c.startswith(p) for p in drop_p)]
        return FeatureAssemblerModel(outputCol=self.getOutputCol(), inputCols=keep,
                                     nBefore=len(names))


class FeatureAssemblerModel(Model, HasInputCols, HasOutputCol, _Stage):
    nBefore = Param(Params._dummy(), "nBefore", "feature count before filtering", TypeConverters.toInt)

    def __init__(self, outputCol=None, inputCols=None, nBefore=None):
        super().__init__()
        self._set_all(outputCol=outputCol, inputCols=inputCols, nBefore=nBefore)

    def _transform(self, df):
        va = VectorAssembler(inputCols=self.getInputCols(), outputCol=self.getOutputCol(), handleInvalid="keep")
        out = va.transform(df)
        return out.select(*[c for c in out.columns if not (c in self.getInputCols())])


def build_preprocessor(categorical: list[str], numeric: list[str], *, drop_prefixes=(), drop_names=(),
                       output_col: str = "features") -> Pipeline:
    """Categorical block (mode impute -> one-hot) then numeric block
    (median impute -> population standardise); other columns pass through."""
    return Pipeline(stages=[
        ModeImputer(inputCols=categorical),
        CategoryEncoder(inputCols=categorical),
        MedianImputer(inputCols=numeric),
        PopulationScaler(inputCols=numeric),
        FeatureAssembler(outputCol=output_col, dropPrefixes=list(drop_prefixes), dropNames=list(drop_names)),
    ])


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the vector slots, in order, from the ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs += group
    return [a["name"] for a in sorted(attrs, key=lambda a: a["idx"])]


def feature_names_frame(df: DataFrame, col: str = "features") -> DataFrame:
    names = feature_names(df, col)
    return df.sparkSession.createDataFrame(list(enumerate(names)), "idx int, name string")


def feature_filter_meta(model_or_stage, *, drop_state: bool, drop_area_code: bool, drop_charges: bool) -> dict:
    """P2 metadata: before/after/removed counts of the assembled features."""
    asm = model_or_stage.stages[-1] if hasattr(model_or_stage, "stages") else model_or_stage
    before = asm.getOrDefault(asm.nBefore)
    after = len(asm.getInputCols())
    return {"drop_state": drop_state, "drop_area_code": drop_area_code, "drop_charges": drop_charges,
            "n_features_before": before, "n_features_after": after, "removed_features_count": before - after}


def slice_features(df: DataFrame, names: list[str], input_col: str = "features",
                   output_col: str = "features_sliced") -> DataFrame:
    """P2 after assembly: keep named slots with VectorSlicer."""
    return VectorSlicer(inputCol=input_col, outputCol=output_col, names=names).transform(df)
