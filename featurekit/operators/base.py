"""Fit/transform contract shared by every stage.

A stage is a ``pyspark.ml.Estimator`` (so it drops into ``pyspark.ml.Pipeline``); its fitted
``Model`` is a lazy projection or join.  Stages also describe their fit so the chain planner can
fuse several fits into one job:

* ``fit_kind = "none"``    - nothing to learn (mapping, drop/keep)
* ``fit_kind = "global"``  - a handful of global aggregates (moments, quantiles): ``global_aggs`` +
  ``from_global_row``; fused stages share a single ``agg``
* ``fit_kind = "quantile"`` - exact quantiles (``quantile_request`` + ``from_quantiles``); all of a
  group are found together by ``exact_quantiles_multi`` in three bounded-memory jobs
* ``fit_kind = "grouped"`` - per-category aggregates (target encoding): ``group_key`` +
  ``group_aggs`` + ``from_group_table``; fused stages share one ``GROUPING SETS`` job
* ``fit_kind = "own"``     - runs its own jobs (correlation pruning, KNN, one-hot)

Fits by groups (``keyed``): the same aggregates with the group as a key, in the same number of jobs whatever the number of
groups.  What is fitted then is a table with a row per group, and the model joins it.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from featurekit.contracts import group_of
from featurekit.functions.stats import MAX_GROUPS_SENT


class Stage(Estimator):
    fit_kind = "own"

    def __init__(self) -> None:
        super().__init__()

    # -- planner metadata --------------------------------------------------------------------
    def reads(self) -> set[str]:
        """Columns the fit reads (label included)."""
        return set()

    def writes(self) -> set[str]:
        """Columns whose values the transform changes, adds or removes."""
        return set()

    # -- fusable fits ---------------------------------------------------------------------------
    def global_aggs(self, df: DataFrame) -> list[Column]:
        raise NotImplementedError

    def from_global_row(self, row: Row, df: DataFrame) -> "StageModel":
        raise NotImplementedError

    def group_key(self) -> str:
        raise NotImplementedError

    def group_aggs(self, df: DataFrame) -> list[Column]:
        raise NotImplementedError

    def from_group_table(self, table: DataFrame, global_row: Row, df: DataFrame) -> "StageModel":
        raise NotImplementedError

    def validate(self, df: DataFrame) -> None:
        """Schema checks at plan time (no job)."""

    # -- fits of many groups at once ------------------------------------------------------------
    def keyed(self, by: list[str], keep: list[str] = ()) -> "Stage":
        """The stage to fit for every group of rows with equal values of ``by``; ``keep`` are columns to carry along."""
        if self.fit_kind == "own":
            raise ValueError(f"{type(self).__name__} can't be fitted by groups: its columns would differ between them")
        return self

    def keyed_model(self, fitted: DataFrame, by: list[str], groups: int) -> "StageModel":
        """The model of all groups, from a table with ``__g`` and this stage's aggregates (``q``: its quantiles)."""
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> "StageModel":
        # Single-stage fit goes through the same fused planner with a group of one.
        from featurekit.plans.chain import fit_group

        return fit_group([self], df)[0]

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def alias(self, what: str) -> str:
        return f"{self.uid}__{what}"


class StageModel(Model):
    """A fitted stage.  ``params()`` is JSON-able; ``tables()`` are DataFrames persisted with it."""

    kind = "model"

    def __init__(self) -> None:
        super().__init__()

    def params(self) -> dict:
        return {}

    def tables(self) -> dict[str, DataFrame]:
        return {}

    @classmethod
    def restore(cls, params: dict, tables: dict[str, DataFrame]) -> "StageModel":
        raise NotImplementedError


class Stateless(Stage):
    """A stage with nothing to fit: it is its own model."""

    fit_kind = "none"

    def model(self) -> StageModel:
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> StageModel:
        self.validate(df)
        return self.model()

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model().transform(df)


def join_groups(df: DataFrame, fitted: DataFrame, by: list[str], groups: int, *and_on: Column) -> DataFrame:
    """``df`` with the columns of its group's row of ``fitted`` (``__g`` and others), which is broadcast up to MAX_GROUPS_SENT rows."""
    cond = group_of(by) == F.col("__g")
    for c in and_on:
        cond = cond & c
    return df.join(F.broadcast(fitted) if groups <= MAX_GROUPS_SENT else fitted, cond, "left")
