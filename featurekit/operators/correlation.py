"""Pairwise Pearson table (O6) and correlation pruning (O7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.contracts import NUMERIC_TYPES, as_double, require_columns
from featurekit.operators.base import Stage
from featurekit.operators.columns import ColumnsModel


def _check_numeric(df: DataFrame, cols: list[str], who: str) -> None:
    require_columns(df, cols, who)
    bad = [c for c in cols if not isinstance(df.schema[c].dataType, NUMERIC_TYPES)]
    if bad:
        raise TypeError(f"{who}: non-numeric column(s) {bad}")


#: Sums in one aggregate; more columns than that allows go through blocks of rows.
MAX_SUMS = 80
#: Variance as a share of the mean square (around the column's mean) below which values count as constant: rounding alone.
FLAT = 1e-13
_PAIR = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def correlation_pairs(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long table ``(i, j, col_i, col_j, corr)`` for every pair i<j, pairwise-complete rows.

    Two scans: counts and means of all columns, then the sums of products of values less their means.  A pair of columns
    without missing values needs one sum of its own, one with missing values up to six.  Up to MAX_SUMS of them are one aggregate; beyond,
    tasks multiply blocks of rows (the matrices of counts, sums and products of all pairs), and Spark adds the matrices up.
    The correlation is NULL without two different values on both sides.  Every pair is listed, also over an empty table.
    """
    cols = list(df.columns) if cols is None else list(cols)
    _check_numeric(df, cols, "correlation_pairs")
    spark = df.sparkSession
    pairs = [(i, j, cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    names = spark.createDataFrame(pairs, "i int, j int, col_i string, col_j string")
    if not pairs:
        return names.withColumn("corr", F.lit(None).cast("double"))
    x = df.select(*[as_double(df, c).alias(f"x{i}") for i, c in enumerate(cols)])
    first = x.agg(F.count(F.lit(1)).alias("n"), *[f(f"x{i}").alias(f"{a}{i}") for i in range(len(cols)) for f, a in ((F.count, "c"), (F.avg, "m"))]).first()
    whole = [first[f"c{i}"] == first["n"] for i in range(len(cols))]
    means = [first[f"m{i}"] or 0.0 for i in range(len(cols))]
    if len(pairs) + 2 * len(cols) + 5 * sum(not (whole[i] and whole[j]) for i, j, _, _ in pairs) <= MAX_SUMS:
        sums = spark.createDataFrame(_one_aggregate(x, pairs, whole, means, first["n"]), _PAIR)
    else:
        sums = _blocks(x, means)
    n, sx, sy, sxx, syy, sxy = (F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy"))
    vx, vy = sxx - F.try_divide(sx * sx, n), syy - F.try_divide(sy * sy, n)
    varies = (vx > FLAT * sxx) & (vy > FLAT * syy)
    corr = sums.select("i", "j", F.when(varies, F.try_divide(sxy - F.try_divide(sx * sy, n), F.sqrt(vx) * F.sqrt(vy))).alias("corr"))
    return F.broadcast(names).join(corr, ["i", "j"], "left").select("i", "j", "col_i", "col_j", "corr")


def _one_aggregate(x: DataFrame, pairs: list, whole: list[bool], means: list[float], rows: int) -> list[tuple]:
    d = [F.col(f"x{i}") - F.lit(means[i]) for i in range(len(means))]
    aggs = [f.alias(f"{a}{i}") for i in range(len(d)) for f, a in ((F.sum(d[i]), "s"), (F.sum(d[i] * d[i]), "q"))]
    for i, j, _, _ in pairs:
        aggs.append(F.sum(d[i] * d[j]).alias(f"p{i}_{j}"))
        if not (whole[i] and whole[j]):
            both = d[i].isNotNull() & d[j].isNotNull()
            aggs.append(F.count(F.when(both, 1)).alias(f"n{i}_{j}"))
            aggs += [F.sum(F.when(both, f)).alias(f"{a}{i}_{j}") for f, a in ((d[i], "a"), (d[j], "b"), (d[i] * d[i], "c"), (d[j] * d[j], "d"))]
    r = x.agg(*aggs).first()
    out = []
    for i, j, _, _ in pairs:
        if whole[i] and whole[j]:
            found = (rows, r[f"s{i}"], r[f"s{j}"], r[f"q{i}"], r[f"q{j}"], r[f"p{i}_{j}"])
        else:
            found = tuple(r[f"{a}{i}_{j}"] for a in "nabcdp")
        out.append((i, j, *[float(v or 0) for v in found]))
    return out


def _blocks(x: DataFrame, means: list[float]) -> DataFrame:
    """The sums of every pair, from matrix products inside the tasks."""
    p, center = len(means), np.array(means)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, c = np.zeros((4, p, p))
        for b in batches:
            values = b.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, p) - center
            for part in np.array_split(values, max(1, len(values) // 4096)):
                has = ~np.isnan(part)
                d, seen = np.where(has, part, 0.0), has.astype(float)
                n += seen.T @ seen
                s += d.T @ seen                                 # of column i over rows that have column j
                q += (d * d).T @ seen
                c += d.T @ d
        i, j = np.triu_indices(p, 1)
        columns = [i.astype(np.int32), j.astype(np.int32), n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], c[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], [f.split()[0] for f in _PAIR.split(", ")])

    rows = x.select(F.array(*[F.col(c) for c in x.columns]).alias("x")).mapInArrow(products, _PAIR)
    return rows.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


class CorrelationPruner(Stage):
    """Drop column j when some earlier column i<j has |corr| strictly above ``threshold``.

    Earlier columns count even when they are dropped themselves; an undefined correlation never drops.
    ``keep`` names columns that are neither compared nor dropped (the label, the key); without ``cols`` all
    others are compared.
    """

    def __init__(self, threshold: float, cols: list[str] | None = None, keep: list[str] = ()) -> None:
        super().__init__()
        if not isinstance(threshold, float):
            raise TypeError("CorrelationPruner: threshold must be a float")
        self.threshold, self.cols, self.keep = threshold, cols, list(keep)

    def reads(self):
        return set(self.cols or ["*"])

    def writes(self):
        return {"*"}

    def _fit(self, df: DataFrame) -> ColumnsModel:
        cols = [c for c in (df.columns if self.cols is None else self.cols) if c not in self.keep]
        pairs = correlation_pairs(df, cols)
        # p(p-1)/2 rows at most: bounded by the schema width, not by the data.
        dropped = (pairs.where(F.abs("corr") > F.lit(self.threshold))
                   .select("j", "col_j").distinct().orderBy("j").collect())
        return ColumnsModel([r["col_j"] for r in dropped], "drop")


def pruning_decisions(df: DataFrame, threshold: float, cols: list[str] | None = None) -> DataFrame:
    """``(col_pos, col_name, dropped)`` for every column: the pruner's decision as a lazy DataFrame."""
    cols = list(df.columns) if cols is None else list(cols)
    pairs = correlation_pairs(df, cols)
    hits = pairs.groupBy("j").agg(F.max(F.coalesce(F.abs("corr") > F.lit(threshold), F.lit(False))).alias("hit"))
    spark = df.sparkSession
    names = spark.createDataFrame([(k, c) for k, c in enumerate(cols)], "col_pos int, col_name string")
    return names.join(hits, names["col_pos"] == hits["j"], "left").select(
        "col_pos", "col_name", F.coalesce(F.col("hit"), F.lit(False)).alias("dropped"))
