"""Correlation by sums, logistic regressions in shared passes, and a sink that survives a restart."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from featurekit.operators.correlation import correlation_pairs
from featurekit.plans import glm
from featurekit.plans import search
from featurekit.streaming.apply import read_table, start_stream, table_sink


@pytest.mark.parametrize("p,missing", [(5, 0.0), (4, 0.3), (30, 0.2)])
def test_correlation_equals_pandas(spark, p, missing):
    rng = np.random.default_rng(p)
    x = rng.normal(size=(300, p)) @ rng.normal(size=(p, p)) + 1e6
    x[:, 1] = 0.1                                                       # constant
    x[:, 2] = np.where(np.arange(300) < 4, np.nan, x[:, 2])
    x[rng.uniform(size=x.shape) < missing] = np.nan
    x[:, 3] = np.where(np.isnan(x[:, 2]), rng.normal(size=300), 5.0)    # constant wherever column 2 is present
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(p)])
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in r] for r in x], ", ".join(f"c{i} double" for i in range(p))).repartition(3)
    want = frame.corr()
    rows = correlation_pairs(df).collect()
    assert len(rows) == p * (p - 1) // 2
    for r in rows:
        expected = want.iloc[r.i, r.j]
        if 1 in (r.i, r.j) or {r.i, r.j} == {2, 3}:
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(expected, abs=1e-9)


def test_correlation_of_an_empty_table(spark):
    rows = correlation_pairs(spark.createDataFrame([], "a double, b double, c double")).collect()
    assert [(r.i, r.j, r["corr"]) for r in sorted(rows)] == [(0, 1, None), (0, 2, None), (1, 2, None)]


def test_many_columns(spark):
    df = spark.range(200).select(*[F.rand(i).alias(f"c{i}") for i in range(500)])
    rows = correlation_pairs(df)
    assert rows.count() == 500 * 499 // 2 and rows.where("corr is null or abs(corr) > 0.5").count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    x = [F.rand(s) for s in (3, 4, 5)]
    y = (x[0] * 3 - x[1] * 2 + F.rand(9) > 1.0).cast("int")
    return spark.range(900).select(F.col("id").alias("k"), *[v.alias(c) for v, c in zip(x, "abc")], (x[2] * 100).alias("d"), y.alias("y")).cache()


def test_shared_fits_equal_mllib(spark, labelled):
    features = ["a", "b", "d"]
    rows = search._with_folds(labelled.withColumn("label", F.col("y").cast("double")),
                              {float(r["y"]): r["count"] for r in labelled.groupBy("y").count().collect()}, "k", 1235, 3)
    own = rows.select(F.array(*features).alias("x"), "y", F.col("__fold").alias("fold")).cache()
    cands = [{"regParam": 0.0, "elasticNetParam": 0.0}, {"regParam": 0.1, "elasticNetParam": 0.0}, {"regParam": 0.02, "elasticNetParam": 0.5},
             {"regParam": 5.0, "elasticNetParam": 1.0}]
    got = glm.fit_logistic(own, cands, 3, 3)
    data = VectorAssembler(inputCols=features, outputCol="features").transform(rows)
    for i, c in enumerate(cands):
        for f in range(2):
            m = LogisticRegression(maxIter=500, tol=1e-12, **c).fit(data.where(F.col("__fold") != f))
            assert got[i, f] == pytest.approx([*m.coefficients, m.intercept], rel=1e-3, abs=2e-4)
    assert not got[3, :, :-1].any()                                     # all weights are penalised away
    aucs = glm.fold_aucs(own, got)
    assert aucs[3] == [0.5] * 3 and all(v > 0.8 for v in aucs[0])


def test_both_searches_agree(labelled):
    grid = {"regParam": [0.01, 1.0], "elasticNetParam": [0.0, 0.5]}
    shared, best, model = search.halving_logistic(labelled, "y", "k", ["a", "b"], grid, folds=3)
    single, want, _ = search.halving_search(labelled, "y", "k", ["a", "b"], lambda p: LogisticRegression(maxIter=200, tol=1e-10, **p), grid, folds=3)
    assert [tuple(r)[:4] for r in sorted(shared.collect())] == [tuple(r)[:4] for r in sorted(single.collect())]
    means = [{(r.rung, r.candidate_id): r.mean_score for r in x.collect()} for x in (shared, single)]
    assert means[0] == pytest.approx(means[1], abs=1e-4)
    assert best["regParam"] == want["regParam"] and model.coefficients.size == 2


class _Same:
    def transform(self, df):
        return df


def test_restart_between_sink_and_commit(spark, tmp_path):
    rows = spark.range(40).select("id", (F.col("id") % 3).alias("v"))
    for part in range(4):
        rows.where(F.col("id") % 4 == part).coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
    stream = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, sink = str(tmp_path / "out"), table_sink(str(tmp_path / "out"))
    stopped = []

    def stops_once(df, batch_id):
        if batch_id == 1 and not stopped:
            df.limit(1).write.mode("overwrite").parquet(f"{out}/data/__batch=1")   # a part of the batch, not recorded
            stopped.append(batch_id)
            raise RuntimeError("stopped before the record")
        sink(df, batch_id)
        if batch_id == 2 and len(stopped) == 1:
            stopped.append(batch_id)
            raise RuntimeError("stopped between the sink and the commit")

    for expected in (10, 30, 40):
        query = start_stream(_Same(), stream(), stops_once, checkpoint=str(tmp_path / "ck"), available_now=True, name="restarts")
        try:
            query.awaitTermination()
        except Exception:  # noqa: BLE001
            pass
        assert read_table(spark, out, rows.schema).count() == expected
    assert stopped == [1, 2]
    assert sorted(read_table(spark, out).collect()) == sorted(rows.collect())
