"""A corpus pipeline over ``documents``: quality rules, near copies, benchmark passages, secrets, source mix.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage's result as Parquet to the session's shared checkpoint folder and
reads it again for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from featurekit.llm.common import ensure_checkpoint_dir, table
from featurekit.llm.decontaminate import drop_contaminated
from featurekit.llm.jaccard import drop_near_copies
from featurekit.llm.mixing import mix_documents
from featurekit.llm.quality import quality_filter
from featurekit.llm.secrets import redact_secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes boilerplate lines; documents that the rules reject go."""
    return quality_filter(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, that with the least id."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts."""
    return redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes words of, with the words taken and the copies they make."""
    return mix_documents(docs)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", decontaminate),
          ("secret scans", secret_scan), ("mixing sources", mix_sources)]

#: SQL cannot express the entropy windows and the line hashes.  Tests hold the stages against small cases; no plain Python
#: version of the whole pipeline exists.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
