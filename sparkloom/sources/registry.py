"""The label registry, a dimension that callers bring: (idx, name, domain, description, keywords, confusable)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "idx int, name string, domain string, description string, keywords array<string>, confusable array<string>"


def from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    full = [(i, r["name"], r.get("domain"), r.get("description", ""), list(r.get("keywords", [])), list(r.get("confusable", []))) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def subset(registry: DataFrame, names: list[str] | None) -> DataFrame:
    """The labels of these names, in the registry's order; all, if none are given."""
    return registry.filter(registry["name"].isin(names)) if names else registry


def from_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of labels, read on the driver."""
    with open(path, encoding="utf-8") as f:
        return from_rows(spark, json.load(f))
