"""Apply fitted models to streaming DataFrames (extension E1).

Mapping, fitted one-hot, drop/keep, clipping, robust scaling and target encoding transform a
streaming DataFrame directly: they are projections or stream-static joins (the encoding table is
the static side), so no state and no watermark are needed.  KNN imputation ranks neighbours with a
window, which Structured Streaming does not allow on a stream, so a chain containing it runs per
micro-batch through ``foreachBatch``.

``foreachBatch`` runs a batch again if the query stopped before it was committed.  ``table_sink`` writes every batch to a
folder of its own, named by the batch id, and then a record of it; a batch that comes again replaces its folder, and
``read_table`` reads recorded batches alone, so rows are neither lost nor repeated, nor seen in part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from featurekit.operators.knn import KnnClassifierModel, KnnImputeModel
from featurekit.plans.chain import FeatureChainModel
from featurekit.session import ensure_checkpoint_dir


def _stages(model):
    return model.models if isinstance(model, FeatureChainModel) else [model]


def needs_micro_batches(model) -> bool:
    return any(isinstance(m, (KnnImputeModel, KnnClassifierModel)) for m in _stages(model))


def transform_stream(model, stream: DataFrame) -> DataFrame:
    """The lazily transformed stream; raises for models that need ``start_stream``."""
    if needs_micro_batches(model):
        raise ValueError("this model ranks neighbours; use start_stream (foreachBatch)")
    return model.transform(stream)


def start_stream(model, stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str | None = None,
                 available_now: bool = False, name: str | None = None) -> StreamingQuery:
    """Run ``model`` over every micro-batch and hand the result to ``sink(batch_df, batch_id)``.

    The query checkpoint defaults to ``<spark checkpoint dir>/streams/<name>`` on shared storage, so a
    restarted query resumes where it stopped; ``sink`` should be idempotent per batch id.
    """
    spark = stream.sparkSession
    base = ensure_checkpoint_dir(spark)
    name = name or "featurekit"
    writer = stream.writeStream.foreachBatch(lambda df, batch_id: sink(model.transform(df), batch_id))
    writer = writer.option("checkpointLocation", checkpoint or f"{base}/streams/{name}").queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def table_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A sink for :func:`start_stream`: ``path/data/__batch=<id>`` holds the rows of a batch (Parquet), ``path/done/__batch=<id>`` their number."""

    def sink(df: DataFrame, batch_id: int) -> None:
        own = f"{path}/data/__batch={batch_id}"
        df.write.mode("overwrite").parquet(own)
        rows = df.sparkSession.read.schema(df.schema).parquet(own).count()
        df.sparkSession.createDataFrame([(rows,)], "rows long").coalesce(1).write.mode("overwrite").json(f"{path}/done/__batch={batch_id}")

    return sink


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The rows of all recorded batches that :func:`table_sink` wrote; ``schema`` if given, else that of the files."""
    done = [r[0] for r in spark.read.schema("rows long, __batch long").json(f"{path}/done").select("__batch").distinct().collect()]   # a row per batch
    reader = spark.read.option("basePath", f"{path}/data")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*[f"{path}/data/__batch={b}" for b in sorted(done)]).drop("__batch")
