import os
import tempfile

from pyspark.sql import functions as F

from featurekit.operators import KnnImpute, RobustScale, TargetEncode, TukeyClip, ValueMapper
from featurekit.operators import target
from featurekit.plans.chain import FeatureChain
from featurekit.plans.persist import load_model, save_model
from featurekit.streaming.apply import needs_micro_batches, start_stream, transform_stream
from tests.conftest import SF_SMALL


def _events(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    return e.select("event_id", "event_type", (F.col("user_id") % 10).cast("string").alias("u"), "value",
                    (F.col("event_id") % 3 == 0).cast("int").alias("y"))


def rows(df, key):
    return sorted(tuple(r) for r in df.orderBy(key).collect())


def test_save_load_roundtrip(spark, monkeypatch):
    monkeypatch.setattr(target, "INLINE_MAX", 3)      # force a table-backed encoder
    df = _events(spark)
    chain = FeatureChain([ValueMapper("event_type", {"click": 0, "view": 1}, unmapped="null"),
                          TargetEncode("u", "y"), TukeyClip("value"), RobustScale("value"),
                          KnnImpute("event_id", k=3, keep=["y"])])
    model = chain.fit(df)
    path = tempfile.mkdtemp(prefix="fk-model-")
    save_model(model, path)
    loaded = load_model(spark, path)
    assert rows(loaded.transform(df), "event_id") == rows(model.transform(df), "event_id")


def test_stream_matches_batch(spark):
    df = _events(spark)
    model = FeatureChain([TargetEncode("event_type", "y"), TukeyClip("value"), RobustScale("value")]).fit(df)
    assert not needs_micro_batches(model)
    src = tempfile.mkdtemp(prefix="fk-src-")
    df.write.mode("overwrite").parquet(os.path.join(src, "in"))
    stream = spark.readStream.schema(df.schema).parquet(os.path.join(src, "in"))
    streamed = transform_stream(model, stream)
    out = os.path.join(src, "out")
    q = (streamed.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(src, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.read.parquet(out), "event_id") == rows(model.transform(df), "event_id")


def test_stream_with_knn_uses_micro_batches(spark):
    df = _events(spark).withColumn("value", F.when(F.col("event_id") % 4 == 0, None).otherwise(F.col("value")))
    df = df.select("event_id", "value", F.col("event_id").cast("double").alias("t"), "y")
    model = FeatureChain([KnnImpute("event_id", k=3, keep=["y"])]).fit(df)
    assert needs_micro_batches(model)
    src = tempfile.mkdtemp(prefix="fk-src-")
    df.write.mode("overwrite").parquet(os.path.join(src, "in"))
    stream = spark.readStream.schema(df.schema).parquet(os.path.join(src, "in"))
    out = os.path.join(src, "out")
    q = start_stream(model, stream, lambda b, i: b.write.mode("append").parquet(out),
                     checkpoint=os.path.join(src, "ck"), available_now=True, name="knn_test")
    q.awaitTermination()
    assert rows(spark.read.parquet(out), "event_id") == rows(model.transform(df), "event_id")
