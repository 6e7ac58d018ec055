"""Fits by groups: the same numbers as one fit per group, in one set of jobs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurekit import FeatureChain, KnnImpute, RobustScale, SigmaClip, TargetEncode, TukeyClip, ValueMapper
from featurekit.contracts import group_of
from featurekit.functions.stats import exact_quantiles_by
from featurekit.operators import CorrelationPruner, KnnClassifier
from featurekit.operators.knn_blocks import BlockIndex, nearest_in_blocks
from featurekit.plans import evaluate as ev
from featurekit.plans import split as sp
from featurekit.plans.persist import load_model, save_model
from featurekit.plans.search import split_stability


@pytest.fixture(scope="module")
def rows(spark):
    g = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "a").otherwise("b")
    x = F.when(F.col("id") % 7 != 0, F.rand(1) * F.exp(F.rand(2) * 6))
    return spark.range(240).select(
        F.col("id").alias("k"), g.alias("g"), (F.col("id") % 5 == 0).cast("int").alias("y"), x.alias("x"),
        F.when(F.col("id") % 2 == 0, F.lit(4.0)).otherwise(F.col("id").cast("double")).alias("z"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("c"), F.col("id") % 4)).alias("c")).cache()


@pytest.mark.parametrize("most", [2_000_000, 10])
def test_quantiles_by_group(spark, rows, most):
    wanted = [(F.col("x"), [0.25, 0.5, 0.75]), (F.col("z"), [0.1, 0.9])]
    own = rows.unionByName(spark.createDataFrame([(999, "empty", 1, None, None, None)], "k long, g string, y int, x double, z double, c string"))
    got = {r["__g"]: (r.q0, r.q1) for r in exact_quantiles_by(own, group_of(["g"]), wanted, max_bracket_rows=most).collect()}
    one = own.groupBy(group_of(["g"]).alias("o")).agg(F.percentile("x", [0.25, 0.5, 0.75]).alias("a"), F.percentile("z", [0.1, 0.9]).alias("b"))
    want = {r.o: (r.a or [None] * 3, r.b or [None] * 2) for r in one.collect()}
    assert got == want


def _chain(by=()):
    return FeatureChain([ValueMapper("c", {"c0": "zero"}, unmapped="keep"), TargetEncode("c", "y", 3.0), TukeyClip("x", "inner"), SigmaClip("z"), RobustScale("x"),
                         RobustScale("z"), KnnImpute("k", ["x", "z", "c"], k=3, keep=["y"])], by=by)


def test_chain_by_group_equals_a_fit_per_group(spark, rows, tmp_path):
    model = _chain(["g"]).fit(rows)
    save_model(model, str(tmp_path / "m"))
    loaded = load_model(spark, str(tmp_path / "m"))
    for m in (model, loaded):
        got = {r.k: r for r in m.transform(rows).collect()}
        assert len(got) == 240
        for part in ("g IS NULL", "g = 'a'", "g = 'b'"):
            own = rows.where(part).drop("g")
            for r in _chain().fit(own).transform(own).collect():
                assert [got[r.k][c] for c in ("x", "z", "c")] == pytest.approx([r.x, r.z, r.c], abs=1e-9), r.k
    other = model.transform(rows.withColumn("g", F.lit("unknown"))).first()
    assert other.c is None and other.x is None            # nothing was fitted for this group


def test_stages_that_change_columns_have_no_groups():
    with pytest.raises(ValueError, match="CorrelationPruner"):
        FeatureChain([CorrelationPruner(0.9)], by=["g"])


@pytest.mark.parametrize("most", [1_000_000, 3])
def test_split_by_seeds_equals_single_splits(rows, most):
    got = sp.split_by_seeds(rows, "y", "k", [3, 8], max_rank_rows=most)
    tests = {(r.seed, r.k) for r in got.where("is_test").select("seed", "k").collect()}
    assert got.count() == 480
    assert tests == {(s, r.k) for s in (3, 8) for r in sp.stratified_split(rows, "y", "k", seed=s)[1].collect()}


def test_scan_equals_a_plain_loop(rows):
    df, seeds = rows.drop("g"), [0, 1]
    best, res = split_stability(df, "y", "k", _chain(), seeds=seeds, min_train_f1=0.01)
    got = {r.seed: r for r in res.collect()}
    kept = {}
    for seed in seeds:
        train, test, _ = sp.prepare(df, "y", _chain(), "k", seed, 0.2)
        voter = KnnClassifier("k", "y", None).fit(train)
        a, b = (ev.confusion(voter.transform(x), "y", prediction_col="prediction").first()["f1"] for x in (train, test))
        assert got[seed].train_f1 == pytest.approx(a) and got[seed].skipped == (a < 0.01)
        if a >= 0.01:
            kept[seed] = b / a
            assert got[seed].test_f1 == pytest.approx(b)
    mean = sum(kept.values()) / len(kept)
    assert best == min(kept, key=lambda s: (abs(kept[s] - mean), s))
    with pytest.raises(ValueError, match="every seed"):
        split_stability(df, "y", "k", _chain(), seeds=[0], min_train_f1=1.1)


def test_levels_of_boxes(spark):
    """Exact over several levels and groups; pairs of boxes tested grow slower than blocks squared."""
    rng = np.random.default_rng(5)
    tested = {}
    for n in (600, 2400):
        x = rng.uniform(0, 1, (n, 2))
        x[rng.uniform(size=(n, 2)) < 0.02] = np.nan
        data = [(i, *[None if np.isnan(v) else float(v) for v in r], str(i % 2)) for i, r in enumerate(x)]
        donors = spark.createDataFrame(data, "__dk long, a double, b double, g string")
        queries = donors.select(F.col("__dk").alias("__qk"), F.lit(-1).alias("__t"), F.array("a", "b").alias("x"), "g")
        counts = []
        got = nearest_in_blocks(queries, donors, ["a", "b"], 3, block_rows=4, count_pairs=counts)
        by_group = BlockIndex.pack(donors, ["a", "b"], None, "g", 4).nearest(queries, 3, "g")
        for found, same in ((got, False), (by_group, True)):
            near = {}
            for r in found.collect():
                near.setdefault(r["__qk"], []).append((r["__dist"], r["__did"]))
            for i in range(0, n, 97):
                both = ~np.isnan(x) & ~np.isnan(x[i])
                c = both.sum(axis=1)
                d = np.sqrt(2 / np.maximum(c, 1) * np.where(both, (x - x[i]) ** 2, 0).sum(axis=1))
                want = sorted((d[j], j) for j in range(n) if c[j] and (not same or j % 2 == i % 2))[:3]
                found_here = sorted(near.get(i, []))
                assert [j for _, j in found_here] == [j for _, j in want]
                assert [d for d, _ in found_here] == pytest.approx([d for d, _ in want])
        compared, possible, tested[n] = counts[0]
        assert compared < possible / 4
    assert tested[2400] < 10 * tested[600]                # blocks squared: 16 times


def test_donors_are_packed_once(rows, monkeypatch):
    from featurekit.operators import knn_blocks

    packed = []
    monkeypatch.setattr(knn_blocks, "_pack", lambda *a, pack=knn_blocks._pack: packed.append(a[-1]) or pack(*a))
    data = rows.select("k", *[(F.col("x") + i).alias(f"x{i}") for i in range(4)])
    model = KnnImpute("k", k=2).fit(data)
    assert packed == ["d"]
    first, second = model.transform(data).collect(), model.transform(data).collect()
    assert packed == ["d", "q", "q"] and sorted(first) == sorted(second)
