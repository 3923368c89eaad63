"""Registry of queries, and access to the tables they run on."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from reelsift.session import shared_root


@dataclass(frozen=True)
class Tables:
    """``tables.orders`` scans the orders table of a data folder."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self) -> str:
        """A fresh folder for what a sink query writes."""
        return f"{shared_root(self.spark)}/{uuid.uuid4().hex}"

    def database(self) -> str:
        """A fresh database for what a sink query writes."""
        name = f"reelsift_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE DATABASE {name} LOCATION '{self.scratch()}'")
        return name


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``<operator id>_<word>``."""

    def register(run: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register
