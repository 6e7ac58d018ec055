"""Plan-time checks and column hygiene shared by all stages (no Spark job is started here)."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("featurekit")

FLOAT_TYPES = (T.DoubleType, T.FloatType)
INTEGRAL_TYPES = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
NUMERIC_TYPES = FLOAT_TYPES + INTEGRAL_TYPES + (T.DecimalType,)


class NotFittedError(RuntimeError):
    """Raised when a model is used before its estimator was fitted."""


def q(name: str) -> str:
    """Backtick-quote a column name so dots and spaces resolve (trap T8)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def require_columns(df: DataFrame, cols, who: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{who}: unknown column(s) {missing}; have {df.columns}")


def require_str(value, who: str, what: str = "column") -> None:
    if not isinstance(value, str):
        raise TypeError(f"{who}: {what} must be a string, got {type(value).__name__}")


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def require_type(df: DataFrame, name: str, allowed: tuple, who: str) -> None:
    dt = dtype_of(df, name)
    if not isinstance(dt, allowed):
        raise TypeError(f"{who}: column {name!r} has type {dt.simpleString()}, expected one of "
                        f"{[a.__name__ for a in allowed]}")


def as_double(df: DataFrame, name: str) -> Column:
    """The column as double with NaN normalised to NULL (trap T1).

    Strings go through ``try_cast`` so unparsable text becomes NULL rather than failing under ANSI.
    """
    dt = dtype_of(df, name)
    c = col(name)
    if isinstance(dt, T.StringType):
        d = F.expr(f"try_cast({q(name)} AS DOUBLE)")
    else:
        d = c.cast("double")
    if isinstance(dt, FLOAT_TYPES) or isinstance(dt, T.StringType):
        d = F.nanvl(d, F.lit(None).cast("double"))
    return d


def nan_to_null(df: DataFrame, cols=None) -> DataFrame:
    """Replace NaN by NULL in floating columns (decision D1), as one projection."""
    targets = set(cols) if cols is not None else set(df.columns)
    exprs = []
    for f in df.schema.fields:
        if f.name in targets and isinstance(f.dataType, FLOAT_TYPES):
            exprs.append(F.nanvl(col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(col(f.name))
    return df.select(*exprs)


def group_of(by: list[str]) -> Column:
    """One string for the columns ``by``; NULLs are values like any other."""
    return F.to_json(F.struct(*[col(c) for c in by]))


def require_unique(df: DataFrame, key: str | list[str], who: str) -> None:
    """Raises when two rows share a key (partial counts inside the tasks first, then one shuffle of keys)."""
    keys = [key] if isinstance(key, str) else list(key)
    twice = df.groupBy(*[col(c).alias(f"k{i}") for i, c in enumerate(keys)]).agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1)
    if twice:
        raise ValueError(f"{who}: key {', '.join(map(repr, keys))} is not unique ({', '.join(repr(x) for x in twice[0][:-1])} occurs more than once)")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in set(exclude)]


def replace_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Project ``expr`` in place of ``name``, keeping column order (one Project node)."""
    return df.select(*[expr.alias(c) if c == name else col(c) for c in df.columns])
