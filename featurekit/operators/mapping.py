"""Value mapping (O1) and its coverage report (O2)."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.contracts import col, replace_column, require_columns
from featurekit.operators.base import Stateless, StageModel

log = logging.getLogger("featurekit")

CASE_MAX_KEYS = 32          # literal CASE chain up to here
MAP_MAX_KEYS = 5000         # literal map lookup up to here, a broadcast join of the (driver-sized) dict above


def _spark_type(values) -> T.DataType:
    vals = [v for v in values if v is not None]
    if not vals:
        return T.StringType()
    if all(isinstance(v, bool) for v in vals):
        return T.BooleanType()
    if all(isinstance(v, int) and not isinstance(v, bool) for v in vals):
        return T.LongType()
    if all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in vals):
        return T.DoubleType()
    return T.StringType()


def _lit(v, dt: T.DataType) -> Column:
    return F.lit(v).cast(dt) if v is not None else F.lit(None).cast(dt)


class ValueMapperModel(StageModel):
    def __init__(self, column: str, mapping: dict, unmapped: str = "keep") -> None:
        super().__init__()
        self.column, self.mapping, self.unmapped = column, dict(mapping), unmapped

    def params(self) -> dict:
        return {"column": self.column, "mapping": [[k, v] for k, v in self.mapping.items()],
                "unmapped": self.unmapped}

    @classmethod
    def restore(cls, params, tables):
        return cls(params["column"], {k: v for k, v in params["mapping"]}, params["unmapped"])

    def out_type(self, df: DataFrame) -> T.DataType:
        src = df.schema[self.column].dataType
        dt = _spark_type(self.mapping.values())
        # Mapping into the column's own type keeps unmapped values verbatim.
        if isinstance(src, T.StringType) and isinstance(dt, T.StringType):
            return src
        # Numbers mapped to numbers: wide enough for the values that stay.
        if self.unmapped not in ("null", "error") and isinstance(src, T.NumericType) and isinstance(dt, T.NumericType):
            if isinstance(src, T.FractionalType):
                return T.DoubleType()
            return T.LongType() if isinstance(src, T.LongType) and isinstance(dt, T.IntegralType) else dt
        return dt

    def _fallback(self, x: Column, src: T.DataType, dt: T.DataType) -> Column:
        if self.unmapped == "null":
            return F.lit(None).cast(dt)
        if self.unmapped == "error":
            return F.raise_error(F.concat(F.lit(f"unmapped value in {self.column}: "),
                                          x.cast("string"))).cast(dt)
        if src == dt:
            return x
        return x.try_cast(dt)

    def expression(self, df: DataFrame) -> Column:
        x = col(self.column)
        src = df.schema[self.column].dataType
        dt = self.out_type(df)
        items = list(self.mapping.items())
        null_items = [v for k, v in items if k is None]
        keyed = [(k, v) for k, v in items if k is not None]
        fallback = self._fallback(x, src, dt)
        if len(keyed) <= CASE_MAX_KEYS:
            expr = None
            for k, v in keyed:
                # a key of another kind is compared as the column's type; what can't be cast matches nothing
                cond = x == (F.lit(k).try_cast(src) if isinstance(k, str) != isinstance(src, T.StringType) else F.lit(k))
                expr = F.when(cond, _lit(v, dt)) if expr is None else expr.when(cond, _lit(v, dt))
            expr = fallback if expr is None else expr.otherwise(fallback)
        else:
            kt = _spark_type([k for k, _ in keyed])
            m = F.create_map(*[e for k, v in keyed for e in (F.lit(k).cast(kt), _lit(v, dt))])
            xk = x.cast(kt) if not isinstance(kt, type(src)) else x
            expr = F.when(F.map_contains_key(m, xk), F.try_element_at(m, xk)).otherwise(fallback)
        if null_items:
            expr = F.when(x.isNull(), _lit(null_items[0], dt)).otherwise(expr)
        return expr

    def _transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, [self.column], "ValueMapper")
        if len(self.mapping) > MAP_MAX_KEYS:
            return self._transform_join(df)
        return replace_column(df, self.column, self.expression(df))

    def _transform_join(self, df: DataFrame) -> DataFrame:
        # The dict lives on the driver, so its size is known: broadcasting it is bounded by it.
        spark = df.sparkSession
        src = df.schema[self.column].dataType
        dt = self.out_type(df)
        kt = _spark_type(list(self.mapping.keys()))
        mdf = spark.createDataFrame(
            [(k, v) for k, v in self.mapping.items()],
            T.StructType([T.StructField("__k", kt), T.StructField("__v", dt), ]),
        ).withColumn("__hit", F.lit(True))
        x = col(self.column)
        joined = df.join(F.broadcast(mdf), x.cast(kt).eqNullSafe(F.col("__k")), "left")
        out = F.when(F.col("__hit"), F.col("__v")).otherwise(self._fallback(x, src, dt))
        return joined.select(*[out.alias(c) if c == self.column else col(c) for c in df.columns])


class ValueMapper(Stateless):
    """Replace values found as keys of ``mapping`` (simultaneously); others pass through.

    ``unmapped``: ``keep`` (default: unmapped values kept, cast to the mapped type, NULL if not
    castable), ``null`` or ``error``.
    """

    def __init__(self, column: str, mapping: dict, unmapped: str = "keep") -> None:
        super().__init__()
        if not isinstance(mapping, dict):
            raise TypeError(f"ValueMapper: mapping must be a dict, got {type(mapping).__name__}")
        if unmapped not in ("keep", "null", "error"):
            raise ValueError("ValueMapper: unmapped must be keep, null or error")
        self.column, self.mapping, self.unmapped = column, mapping, unmapped

    def reads(self):
        return {self.column}

    def writes(self):
        return {self.column}

    def validate(self, df):
        require_columns(df, [self.column], "ValueMapper")

    def model(self) -> ValueMapperModel:
        return ValueMapperModel(self.column, self.mapping, self.unmapped)

    def coverage(self, df: DataFrame) -> DataFrame:
        return mapping_coverage(df, self.column, self.mapping)


def mapping_coverage(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Two set differences between the column's distinct values and the mapping keys (O2).

    Returns ``(value string, side string)`` with side ``key_not_in_data`` or ``value_without_key``;
    a missing value counts as a value.  The distinct values stay distributed (anti joins).
    """
    require_columns(df, [column], "mapping_coverage")
    spark = df.sparkSession
    values = df.select(col(column).cast("string").alias("value")).distinct()
    keys = spark.createDataFrame([(None if k is None else str(k),) for k in mapping], "value string")
    cond_k = keys["value"].eqNullSafe(values["value"])
    key_missing = keys.join(values, cond_k, "left_anti").select(
        keys["value"], F.lit("key_not_in_data").alias("side"))
    cond_v = values["value"].eqNullSafe(keys["value"])
    value_missing = values.join(F.broadcast(keys), cond_v, "left_anti").select(
        values["value"], F.lit("value_without_key").alias("side"))
    return key_missing.unionByName(value_missing)
