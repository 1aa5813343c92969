"""Scalar helpers and guards."""

import pytest
from pyspark.sql import functions as F

from segmetric.functions import scalar as S
from segmetric.operators import validate as V


def test_safe_name_and_label_text(spark):
    df = spark.createDataFrame([("Total day minutes",), ("__Área code!",)], "s string")
    out = [r[0] for r in df.select(S.safe_name("s")).collect()]
    assert out == ["total_day_minutes", "área_code"]
    assert df.select(S.label_text(F.lit(" true "))).first()[0] == "TRUE"


def test_try_double_and_category_order(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(S.try_double("v")).collect()] == [1.5, None, None]
    m = spark.createDataFrame([("rf",), ("zz",), ("logreg",)], "m string")
    order = [r.m for r in m.orderBy(S.category_order("m", ["logreg", "knn", "rf"]), "m").collect()]
    assert order == ["logreg", "rf", "zz"]


def test_linspace_grid_and_comma_list(spark):
    g = spark.range(1).select(S.linspace_grid(201).alias("g")).first().g
    assert len(g) == 201 and g[0] == 0.0 and g[-1] == 1.0 and g[140] == pytest.approx(0.7)
    assert S.comma_list(" logreg, knn,,xgb ") == ["logreg", "knn", "xgb"]


def test_guards(spark):
    with pytest.raises(ValueError, match="empty"):
        V.require_non_empty(spark.range(0), "metrics")
    with pytest.raises(ValueError, match="out-of-fold"):
        V.require_complete(spark.createDataFrame([(1, 0.5), (2, None)], "row_id long, score double"), "score")
    with pytest.raises(ValueError, match="alt"):
        V.require_model_set("original", True)
    V.require_model_set("alt", True)
