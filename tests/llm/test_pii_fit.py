"""op4's thresholds count every candidate, however many there are."""

from pyspark.sql import functions as F

from featurekit.llm import jaccard, pii


def test_all_candidates_count(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "threshold", lambda bins, *a, was=pii.threshold: seen.append(sum(n for n, _ in bins.values())) or was(bins, *a))
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("ref 10-20-30-"), F.col("id") % 90 + 10).alias("text"))
    pii.fit(docs)
    half = docs.where(F.pmod(F.shiftright(F.xxhash64("doc_id", F.lit(4), F.lit(pii.BASE + 2), F.lit(pii.SEED)), 32), F.lit(2)) != 0).count()
    assert 14_000 < half < 16_000 and sum(seen) == half


def test_texts_are_taken_in_slices(spark, monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(1200))], ["id"])
    assert [b.num_rows for b in jaccard._slices([batch])] == [500, 500, 200]
