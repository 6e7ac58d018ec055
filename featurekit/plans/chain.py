"""Stage chaining (O15) with fit fusion.

Semantics are sequential, as in the reference: every stage is fitted on the output of the stages
before it.  The planner groups consecutive stages whose fits are independent (no stage reads a
column an earlier member writes) and fits a group with a few fused jobs:

* all moments of the group in one ``agg``, and all exact quantiles of the group together in three
  bounded-memory jobs (``exact_quantiles_multi``; no column's values gathered in one task);
* all target encoders of the group in one ``GROUPING SETS ((c1), (c2), ..., ())`` aggregate, the
  empty set giving the global label mean; the result is written to the checkpoint folder once and
  each encoder's table is read back from it.

Stateless stages (mapping, drop) cost no job; one whose columns the open group does not touch is
applied to the group's frame without closing it.  Transforms are lazy projections/joins, so a fitted
chain is one Spark plan that Catalyst collapses (``CollapseProject``) and prunes to the Parquet scan.
"""

from __future__ import annotations

import logging

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.contracts import col, group_of, require_columns
from featurekit.operators.base import Stage, StageModel

log = logging.getLogger("featurekit")


def fit_group(stages: list[Stage], df: DataFrame) -> list[StageModel]:
    """Fit mutually independent stages on the same frame with fused jobs; models in stage order."""
    for s in stages:
        s.validate(df)
    models: dict[int, StageModel] = {}
    glob = [s for s in stages if s.fit_kind == "global"]
    grouped = [s for s in stages if s.fit_kind == "grouped"]
    quant = [s for s in stages if s.fit_kind == "quantile"]
    if quant:
        from featurekit.functions.stats import exact_quantiles_multi

        found = exact_quantiles_multi(df, [s.quantile_request(df) for s in quant])
        for s, qs in zip(quant, found):
            models[id(s)] = s.from_quantiles(qs)
    if glob:
        row = df.agg(*[a for s in glob for a in s.global_aggs(df)]).first()
        for s in glob:
            models[id(s)] = s.from_global_row(row, df)
    if grouped:
        for s, m in zip(grouped, _fit_grouped(grouped, df)):
            models[id(s)] = m
    for s in stages:
        if s.fit_kind == "none":
            models[id(s)] = s.fit(df)
        elif s.fit_kind == "own":
            models[id(s)] = s.fit(df)
    return [models[id(s)] for s in stages]


def fit_group_by(stages: list[Stage], df: DataFrame, by: list[str]) -> list[StageModel]:
    """As :func:`fit_group` for every group of rows with equal values of ``by``: as many jobs as for one group."""
    from featurekit.functions.stats import exact_quantiles_by
    from featurekit.operators.target import TargetEncodeByGroup
    from featurekit.session import durable

    require_columns(df, by, "FeatureChain")
    for s in stages:
        s.validate(df)
    models: dict[int, StageModel] = {}
    own = group_of(by)
    quant = [s for s in stages if s.fit_kind == "quantile"]
    glob = [s for s in stages if s.fit_kind == "global"]
    grouped = [s for s in stages if s.fit_kind == "grouped"]
    tables = []
    if quant:
        found = exact_quantiles_by(df, own, [s.quantile_request(df) for s in quant])
        tables.append((quant, durable(found.select("__g", *[F.col(f"q{r}").alias(s.alias("q")) for r, s in enumerate(quant)]))))
    if glob:
        tables.append((glob, durable(df.groupBy(own.alias("__g")).agg(*[a for s in glob for a in s.global_aggs(df)]))))
    for members, fitted in tables:
        groups = fitted.count()
        for s in members:
            models[id(s)] = s.keyed_model(fitted, by, groups)
    if grouped:
        keys = list(dict.fromkeys(s.group_key() for s in grouped))
        base = df.withColumn("__g", own)
        sets = [[F.col("__g"), col(k)] for k in keys] + [[F.col("__g")]]
        fused = durable(base.groupingSets(sets, F.col("__g"), *[col(k) for k in keys]).agg(
            F.grouping_id().alias("__gid"), *[a for s in grouped for a in s.group_aggs(df)]))
        every = (1 << len(keys)) - 1
        overall = fused.where(F.col("__gid") == every)
        for s in grouped:
            i = keys.index(s.group_key())
            table = fused.where(F.col("__gid") == every - (1 << (len(keys) - 1 - i))).select(
                "__g", col(keys[i]).alias("value"), *[F.col(s.alias(x)).alias(x) for x in ("n", "sy", "ny")])
            sums = overall.select("__g", F.col(s.alias("sy")).alias("gsy"), F.col(s.alias("ny")).alias("gny"))
            encoded = durable(s.keyed_table(table, sums))
            models[id(s)] = TargetEncodeByGroup(s.column, by, encoded, encoded.count())
    for s in stages:
        if s.fit_kind in ("none", "own"):
            models[id(s)] = s.fit(df)
    return [models[id(s)] for s in stages]


def _fit_grouped(stages: list[Stage], df: DataFrame) -> list[StageModel]:
    from featurekit.session import durable

    keys: list[str] = []
    for s in stages:
        if s.group_key() not in keys:
            keys.append(s.group_key())
    nk = len(keys)
    sets = [[col(k)] for k in keys] + [[]]
    aggs = [a for s in stages for a in s.group_aggs(df)]
    fused = df.groupingSets(sets, *[col(k) for k in keys]).agg(F.grouping_id().alias("__gid"), *aggs)
    fused = durable(fused)   # one pass over the data; every encoder reads its slice from here
    all_bits = (1 << nk) - 1
    global_row = fused.where(F.col("__gid") == all_bits).first()
    out = []
    for s in stages:
        i = keys.index(s.group_key())
        gid = all_bits - (1 << (nk - 1 - i))
        table = fused.where(F.col("__gid") == gid).select(
            col(keys[i]).alias("value"), F.col(s.alias("n")).alias("n"),
            F.col(s.alias("sy")).alias("sy"), F.col(s.alias("ny")).alias("ny"))
        out.append(s.from_group_table(table, global_row, df))
    return out


class FeatureChainModel(Model):
    def __init__(self, models: list[StageModel]) -> None:
        super().__init__()
        self.models = list(models)

    def _transform(self, df: DataFrame) -> DataFrame:
        for m in self.models:
            df = m.transform(df)
        return df


class FeatureChain(Stage):
    """An ordered list of stages fitted sequentially with fusion; ``fuse=False`` fits one by one.

    With ``by``, every group of rows with equal values there is fitted on its own, all of them in the same jobs; the
    columns of ``by`` stay, and so do those of ``keep`` where a stage drops what it doesn't know.
    """

    def __init__(self, stages: list[Stage], fuse: bool = True, by: list[str] = (), keep: list[str] = ()) -> None:
        super().__init__()
        self.by = list(by)
        self.stages, self.fuse = [s.keyed(self.by, list(keep)) for s in stages] if self.by else list(stages), fuse

    def keyed(self, by: list[str], keep: list[str] = ()) -> "FeatureChain":
        return FeatureChain(self.stages, self.fuse, by, keep)

    def reads(self):
        return set().union(*[s.reads() for s in self.stages]) if self.stages else set()

    def writes(self):
        return set().union(*[s.writes() for s in self.stages]) if self.stages else set()

    def plan_groups(self) -> list[list[Stage]]:
        """The fusion groups the fit will use (exposed for tests and explain)."""
        return [g for g, _ in self._groups()]

    def _groups(self):
        groups: list[tuple[list[Stage], list[Stage]]] = []   # (fitted stages, stateless stages after them)
        pending: list[Stage] = []
        touched: set[str] = set()        # columns read or written by any open member
        fit_writes: set[str] = set()     # columns written by fitted (non-stateless) open members

        def conflicts(a: set[str], b: set[str]) -> bool:
            return bool(a & b) or ("*" in a and bool(b)) or ("*" in b and bool(a))

        for s in self.stages:
            if not self.fuse:
                groups.append(([s], []))
                continue
            kind = s.fit_kind
            if kind == "own":
                if pending:
                    groups.append((pending, []))
                groups.append(([s], []))
                pending, touched, fit_writes = [], set(), set()
                continue
            # A stateless member is applied before the group's fits, so it may not touch what
            # earlier members see; a fitted member may not read what an earlier fitted member writes.
            clash = (conflicts(s.writes() | s.reads(), touched) if kind == "none"
                     else conflicts(s.reads(), fit_writes))
            if pending and clash:
                groups.append((pending, []))
                pending, touched, fit_writes = [], set(), set()
            pending.append(s)
            touched |= s.reads() | s.writes()
            if kind != "none":
                fit_writes |= s.writes()
        if pending:
            groups.append((pending, []))
        return groups

    def _fit(self, df: DataFrame) -> FeatureChainModel:
        models: list[StageModel] = []
        current = df
        groups = self._groups()
        for gi, (group, _) in enumerate(groups):
            # Stateless members sit in the group only when the fitted members do not touch their
            # columns, so applying them first leaves every fit unchanged.
            frame = current
            for s in group:
                if s.fit_kind == "none":
                    frame = s.fit(frame).transform(frame)
            fitted = [s for s in group if s.fit_kind != "none"]
            fitted_models = iter((fit_group_by(fitted, frame, self.by) if self.by else fit_group(fitted, frame)) if fitted else [])
            by_stage = {}
            for s in group:
                by_stage[id(s)] = next(fitted_models) if s.fit_kind != "none" else s.fit(current)
            for s in group:
                m = by_stage[id(s)]
                models.append(m)
                if gi < len(groups) - 1:       # the last group's output is not needed for fitting
                    current = m.transform(current)
            log.info("fitted group of %d stage(s)", len(group))
        return FeatureChainModel(models)
