"""Drop (O4) and keep (O5) columns."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from featurekit.contracts import col
from featurekit.operators.base import Stateless, StageModel

log = logging.getLogger("featurekit")


class ColumnsModel(StageModel):
    def __init__(self, columns: list[str], action: str) -> None:
        super().__init__()
        self.columns, self.action = list(columns), action

    def params(self):
        return {"columns": self.columns, "action": self.action}

    @classmethod
    def restore(cls, params, tables):
        return cls(params["columns"], params["action"])

    def _transform(self, df: DataFrame) -> DataFrame:
        unknown = [c for c in self.columns if c not in df.columns]
        if self.action == "keep":
            if unknown:
                raise ValueError(f"KeepColumns: unknown columns to keep: {unknown}")
            return df.select(*[col(c) for c in self.columns])
        if unknown:
            log.warning("DropColumns: unknown columns to drop: %s", unknown)
        drop = set(self.columns)
        return df.select(*[col(c) for c in df.columns if c not in drop])


class DropColumns(Stateless):
    def __init__(self, columns: list[str]) -> None:
        super().__init__()
        if not isinstance(columns, list):
            raise TypeError("DropColumns: columns must be a list")
        self.columns = columns

    def reads(self):
        return set()

    def writes(self):
        return set(self.columns)

    def model(self):
        return ColumnsModel(self.columns, "drop")


class KeepColumns(Stateless):
    def __init__(self, columns: list[str]) -> None:
        super().__init__()
        if not isinstance(columns, list):
            raise TypeError("KeepColumns: columns must be a list")
        self.columns = columns

    def keyed(self, by: list[str], keep: list[str] = ()) -> "KeepColumns":
        return KeepColumns([*self.columns, *[c for c in (*by, *keep) if c not in self.columns]])

    def reads(self):
        return set(self.columns)

    def writes(self):
        return {"*"}

    def model(self):
        return ColumnsModel(self.columns, "keep")
