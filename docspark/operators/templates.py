"""Stored search templates (P7): named, parameterised Spark SQL.

A template is SQL text with named parameters (``:name``) and ``{frame}`` placeholders for the collections it reads.
``search`` binds parameters through Spark's parameterised SQL (values are never spliced into the text); when either
``size`` or ``from_`` is given, both are added to the parameters (``from`` defaults to 0, ``size`` to 10).
"""

from __future__ import annotations

from typing import Any, Mapping

from pyspark.sql import DataFrame, SparkSession


class TemplateRegistry:
    def __init__(self):
        self._templates: dict[str, str] = {}

    def put(self, name: str, sql: str) -> None:
        self._templates[name] = sql

    def get(self, name: str) -> str:
        if name not in self._templates:
            raise KeyError(f"no template {name!r}")
        return self._templates[name]

    def delete(self, name: str) -> None:
        self._templates.pop(name, None)

    def search(self, spark: SparkSession, name: str, params: Mapping[str, Any] | None = None, size: int | None = None,
               from_: int | None = None, frames: Mapping[str, DataFrame] | None = None) -> DataFrame:
        args = dict(params or {})
        if size is not None or from_ is not None:
            args["size"] = 10 if size is None else size
            args["from"] = 0 if from_ is None else from_
        return spark.sql(self.get(name), args=args, **dict(frames or {}))
