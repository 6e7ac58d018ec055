"""Save and load fitted models.

Layout under ``path`` (any Hadoop-compatible folder, written through Spark so it works on shared
storage): ``metadata/`` one JSON text line describing the stages (class, JSON params, table names),
and ``stage_<i>/<table>/`` Parquet for the fitted tables (large target encodings, KNN donors).
"""

from __future__ import annotations

import importlib
import json

from pyspark.sql import SparkSession

from featurekit.operators.base import StageModel
from featurekit.plans.chain import FeatureChainModel


def _models(model) -> list[StageModel]:
    return model.models if isinstance(model, FeatureChainModel) else [model]


def save_model(model, path: str) -> None:
    models = _models(model)
    meta = {"chain": isinstance(model, FeatureChainModel), "stages": []}
    for i, m in enumerate(models):
        tables = m.tables()
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{path}/stage_{i}/{name}")
        meta["stages"].append({"class": f"{type(m).__module__}.{type(m).__qualname__}", "params": m.params(),
                               "tables": sorted(tables)})
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta),)], "v string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model(spark: SparkSession, path: str):
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    models = []
    for i, st in enumerate(meta["stages"]):
        mod, _, cls = st["class"].rpartition(".")
        klass = getattr(importlib.import_module(mod), cls)
        tables = {name: spark.read.parquet(f"{path}/stage_{i}/{name}") for name in st["tables"]}
        models.append(klass.restore(st["params"], tables))
    return FeatureChainModel(models) if meta["chain"] else models[0]
