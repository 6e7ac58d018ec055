import math

import pytest
from pyspark.sql import functions as F

from featurekit.functions.stats import bucket_of, exact_quantiles, rint2
from featurekit.operators import CorrelationPruner, RobustScale, SigmaClip, TargetEncode, TukeyClip, correlation_pairs
from featurekit.plans.chain import FeatureChain


def col_values(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_pearson_pairwise_complete_and_constant(spark):
    df = spark.createDataFrame([(1.0, 1.0, 5.0), (2.0, None, 5.0), (3.0, 3.0, 5.0), (4.0, 9.0, 5.0)],
                               "x double, y double, z double")
    got = {(r.col_i, r.col_j): r.corr for r in correlation_pairs(df).collect()}
    assert round(got[("x", "y")], 6) == 0.891042
    assert got[("x", "z")] is None


def test_prune_worked_example(spark):
    b = list(range(1, 9))
    sign = [1 if i % 2 == 0 else -1 for i in range(8)]
    rows = [(bb + 0.9 * s, float(bb), bb - 0.9 * s) for bb, s in zip(b, sign)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    model = CorrelationPruner(0.9).fit(df)
    assert model.columns == ["b", "c"]
    assert model.transform(df).columns == ["a"]
    with pytest.raises(TypeError):
        CorrelationPruner(1)


def test_sigma_walls_and_single_row(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (100.0,), (None,)], "x double")
    m = SigmaClip("x").fit(df)
    assert round(m.low, 6) == -120.520407 and round(m.high, 6) == 173.520407
    assert col_values(m.transform(df), "x")[-1] is None
    one = spark.createDataFrame([(1.0,)], "x double")
    assert col_values(SigmaClip("x").fit_transform(one), "x") == [1.0]
    with pytest.raises(TypeError):
        SigmaClip("x").fit(spark.createDataFrame([(1,)], "x long"))


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (100.0,), (float("nan"),)], "x double")
    m = SigmaClip("x").fit(df)
    assert round(m.low, 6) == -120.520407
    assert col_values(m.transform(df), "x")[-1] is None


def test_quartiles_and_robust_golden(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (100.0,)], "x double")
    m = RobustScale("x").fit(df)
    assert (m.median, m.iqr) == (2.5, 25.5)
    assert [round(v, 6) for v in col_values(m.transform(df), "x")] == [-0.058824, -0.019608, 0.019608, 3.823529]
    assert exact_quantiles(df, F.col("x"), [0.25, 0.5, 0.75]) == [1.75, 2.5, 27.25]


def test_robust_iqr_zero_is_cast_only(spark):
    df = spark.createDataFrame([(7,), (7,), (7,), (7,), (7,), (9,)], "x int")
    out = RobustScale("x").fit_transform(df)
    assert col_values(out, "x") == [7.0, 7.0, 7.0, 7.0, 7.0, 9.0]
    assert dict(out.dtypes)["x"] == "double"


def test_tukey_fences_and_types(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (1000.0,)], "x double")
    m = TukeyClip("x", "inner").fit(df)
    assert (m.low, m.high) == (3.75 - 1.5 * 253.75, 257.5 + 1.5 * 253.75)
    with pytest.raises(ValueError):
        TukeyClip("x", "middle")
    with pytest.raises(TypeError):
        TukeyClip("s").fit(spark.createDataFrame([("a",)], "s string"))


def test_tukey_then_robust_sees_clipped_values(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (1000.0,)], "x double")
    chain = FeatureChain([TukeyClip("x", "inner"), RobustScale("x")])
    assert [len(g) for g in chain.plan_groups()] == [1, 1]
    model = chain.fit(df)
    clipped = model.models[0].transform(df)
    q3 = exact_quantiles(clipped, F.col("x"), [0.75])[0]
    assert q3 == 167.03125
    assert model.models[1].iqr == q3 - exact_quantiles(clipped, F.col("x"), [0.25])[0]


def test_bracketed_quantiles_match_exact(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003 / 3.0).alias("x"))
    exact = df.agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
    assert exact_quantiles(df, F.col("x"), [0.25, 0.5, 0.75], accuracy=100) == list(exact)
    m1 = RobustScale("x").fit(df)
    m2 = RobustScale("x", quantiles="bracketed").fit(df)
    assert (m1.median, m1.iqr) == (m2.median, m2.iqr)


def test_target_golden_and_missing(spark):
    df = spark.createDataFrame([("A", 1), ("B", 0), ("A", 1), ("C", 0)], "c string, y int")
    m = TargetEncode("c", "y", 5.0).fit(df)
    assert {k: round(v, 6) for k, v in m.inline.items()} == {"A": 0.642857, "B": 0.416667, "C": 0.416667}
    new = spark.createDataFrame([("A", 0), ("Z", 0), (None, 0)], "c string, y int")
    assert [None if v is None else round(v, 6) for v in col_values(m.transform(new), "c")] == [0.642857, None, None]
    df2 = spark.createDataFrame([("A", 1), ("A", None), ("B", None), (None, 1)], "c string, y int")
    m2 = TargetEncode("c", "y", 0.0).fit(df2)
    assert m2.inline["A"] == 1.0 and m2.inline["B"] is None and m2.global_mean == 1.0
    with pytest.raises(ValueError):
        TargetEncode("c", "y", -1.0)


def test_target_large_table_joins(spark, monkeypatch):
    from featurekit.operators import target

    monkeypatch.setattr(target, "INLINE_MAX", 3)
    df = spark.range(100).select((F.col("id") % 10).alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    m = TargetEncode("c", "y", 2.0).fit(df)
    assert m.inline is None and m.n_categories == 10
    got = {r.c0: r.c for r in m.transform(df.withColumn("c0", F.col("c"))).select("c0", "c").distinct().collect()}
    assert got[0] == pytest.approx((10 * 0.0 + 2 * 0.5) / 12)
    assert got[1] == pytest.approx((10 * 1.0 + 2 * 0.5) / 12)


def test_fused_chain_equals_stage_by_stage(spark):
    df = spark.range(500).select(
        F.col("id"), (F.col("id") % 7).cast("string").alias("a"), (F.col("id") % 3).cast("string").alias("b"),
        ((F.col("id") * 37) % 101).cast("double").alias("x"), ((F.col("id") * 11) % 53).cast("double").alias("z"),
        (F.col("id") % 2).cast("int").alias("y"))
    stages = lambda: [TargetEncode("a", "y"), TargetEncode("b", "y", 5.0), TukeyClip("x"), SigmaClip("z"),
                      RobustScale("x")]
    fused = FeatureChain(stages()).fit(df)
    single = FeatureChain(stages(), fuse=False).fit(df)
    assert [len(g) for g in FeatureChain(stages()).plan_groups()] == [4, 1]
    for a, b in zip(fused.models, single.models):
        assert a.params() == b.params()
    assert sorted(map(tuple, fused.transform(df).collect())) == sorted(map(tuple, single.transform(df).collect()))


def test_rint_rounding_and_buckets(spark):
    vals = [0.125, 0.375, 0.285, 0.575, 0.675, 1.005, 0.145]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert [r[0] for r in df.select(rint2(F.col("x"))).collect()] == [0.12, 0.38, 0.28, 0.57, 0.68, 1.0, 0.14]
    b = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 0.5, 1.0, 2.0]], "x double")
    assert [r[0] for r in b.select(bucket_of(F.col("x"), [0.0, 1.0, 0.5])).collect()] == [0, 1, 2, 3, 3]
    assert not math.isnan(0.0)


def test_bracketed_quantiles_narrow_large_brackets(spark):
    df = spark.range(20000).select(((F.col("id") * 7919) % 20011 / 7.0).alias("x"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    exact = df.agg(F.percentile("x", F.array(*[F.lit(p) for p in probs]))).first()[0]
    # brackets of a coarse sketch hold thousands of rows; a 300-row cap forces narrowing rounds
    assert exact_quantiles(df, F.col("x"), probs, accuracy=50, max_bracket_rows=300) == list(exact)
    ties = spark.range(5000).select((F.col("id") % 3).cast("double").alias("x"))
    exact_t = ties.agg(F.percentile("x", F.array(F.lit(0.5), F.lit(0.9)))).first()[0]
    assert exact_quantiles(ties, F.col("x"), [0.5, 0.9], accuracy=50, max_bracket_rows=10) == list(exact_t)
