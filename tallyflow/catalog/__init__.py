"""Named queries over the given tables, each with its check in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[["Tables"], DataFrame]
CASES: dict[str, tuple[Build, str | None]] = {}


class Tables:
    """The given parquet tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def case(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        if name in CASES:
            raise ValueError(f"query {name} is registered twice")
        CASES[name] = (build, sql)
        return build

    return register


def load_all() -> dict[str, tuple[Build, str | None]]:
    from tallyflow.catalog import (  # noqa: F401
        basics,
        engagement,
        evaluating,
        features,
        modelling,
        profiling,
        scalars,
        texts,
    )

    return CASES
