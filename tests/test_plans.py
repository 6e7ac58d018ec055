"""Plan checks over the registered queries: no Python UDF, pruned scans."""

import pytest

from featurekit.catalogue import QUERIES
from tests.conftest import SF_SMALL

LIGHT = sorted(set(QUERIES) - {"split_scan", "halving", "recipe_a", "recipe_b", "recipe_c",
                             "knn_classify", "knn_impute_wide"})   # more than three features: compared in numpy


@pytest.mark.parametrize("name", LIGHT)
def test_no_python_udf(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert marker not in plan


def test_transform_projection_prunes_scan(spark):
    from pyspark.sql import functions as F

    from featurekit import RobustScale, TukeyClip
    from featurekit.plans.chain import FeatureChain

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    model = FeatureChain([TukeyClip("l_quantity"), RobustScale("l_quantity")]).fit(li)
    out = model.transform(li).where(F.col("l_returnflag") == "R").select("l_orderkey", "l_quantity")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in plan
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
