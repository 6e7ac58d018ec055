"""One-hot encoding (O3): one 0/1 int column per distinct non-missing value, appended in value order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.contracts import col, nan_to_null, require_columns, require_str
from featurekit.operators.base import Stage, StageModel


class OneHotModel(StageModel):
    def __init__(self, column: str, categories: list) -> None:
        super().__init__()
        self.column, self.categories = column, list(categories)

    def params(self):
        return {"column": self.column, "categories": self.categories}

    @classmethod
    def restore(cls, params, tables):
        return cls(params["column"], params["categories"])

    def output_names(self) -> list[str]:
        return [f"{self.column}_{v}" for v in self.categories]

    def _transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, [self.column], "OneHot")
        x = col(self.column)
        keep = [col(c) for c in df.columns if c != self.column]
        dummies = [F.coalesce((x == F.lit(v)).cast("int"), F.lit(0)).alias(name)
                   for v, name in zip(self.categories, self.output_names())]
        return df.select(*keep, *dummies)


class OneHot(Stage):
    """Fit collects the sorted distinct values, one output column each; NaN is missing, like NULL.
    ``max_categories``, if given, is the caller's bound: more raise an error.  By default there is none;
    ``transform`` on the estimator itself re-derives them from the frame, as the reference does."""

    def __init__(self, column: str, max_categories: int | None = None) -> None:
        super().__init__()
        require_str(column, "OneHot")
        self.column, self.max_categories = column, max_categories

    def reads(self):
        return {self.column}

    def writes(self):
        return {self.column}

    def validate(self, df):
        require_columns(df, [self.column], "OneHot")

    def _fit(self, df: DataFrame) -> OneHotModel:
        self.validate(df)
        x = col(self.column)
        values = nan_to_null(df.select(x.alias("v"))).where(F.col("v").isNotNull()).distinct()
        if self.max_categories is not None:
            values = values.limit(self.max_categories + 1)
        rows = values.orderBy("v").collect()
        if self.max_categories is not None and len(rows) > self.max_categories:
            raise ValueError(f"OneHot: {self.column} has more than {self.max_categories} categories")
        return OneHotModel(self.column, [r["v"] for r in rows])

    def transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)
