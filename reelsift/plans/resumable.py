"""Enrichment that goes on where it was: batches, and how far each of them is, are tables.

A run is planned once: its ids are numbered in batches, and that table never changes. For each batch in turn the answers are
asked for, landed, and merged; after each step a row says so. A run that ends anywhere is started again with the same call: what was
asked and landed is not asked again, a batch that was merged is left alone, and one that was being merged is merged again, which
``merge`` has to allow, as upserts by key do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.operators.ranking import assign_batches
from reelsift.session import shared_root

ANSWERED, MERGED = "answered", "merged"


class EnrichmentRun:
    """The run ``name`` in the folder ``base_path``: ``ids``, ``answers`` by batch, and ``progress``."""

    def __init__(self, spark: SparkSession, name: str, base_path: str | None = None):
        self.spark, self.folder = spark, f"{base_path or shared_root(spark)}/{name}"

    def _exists(self, part: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{part}/_SUCCESS")
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    def plan(self, pending: DataFrame, id_column: str, size: int) -> None:
        """Number the distinct non-null ids in batches of ``size``, unless the run is planned already."""
        if not self._exists("ids"):
            ids = pending.select(F.col(id_column).alias("id")).where("id IS NOT NULL").distinct()
            # A half-written plan of a stopped run has no mark of success and is written over.
            assign_batches(ids, "id", size).write.mode("overwrite").partitionBy("batch_id").parquet(f"{self.folder}/ids")

    def ids(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/ids")

    def progress(self) -> dict[int, set[str]]:
        """The steps that are done, by batch: one row per batch and step."""
        done: dict[int, set[str]] = {}
        for step in (ANSWERED, MERGED):
            if self._exists(f"progress/{step}"):
                for r in self.spark.read.schema("batch_id long").parquet(f"{self.folder}/progress/{step}").distinct().collect():
                    done.setdefault(r.batch_id, set()).add(step)
        return done

    def _mark(self, batch: int, step: str) -> None:
        self.spark.range(batch, batch + 1).select(F.col("id").alias("batch_id")).coalesce(1).write.mode("append").parquet(f"{self.folder}/progress/{step}")

    def answers(self, batch: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/answers/{batch}")

    def run(self, ask: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], object], most: int | None = None) -> int:
        """Go on with the run, with ``most`` batches at most; returns how many were merged now.

        ``ask`` gets a batch's ids (``id``) and returns their answers, which are landed before anything is done with them.
        """
        done, merged = self.progress(), 0
        batches = sorted(r.batch_id for r in self.ids().select("batch_id").distinct().collect())
        for batch in batches:
            steps = done.get(batch, set())
            if MERGED in steps:
                continue
            if most is not None and merged == most:
                break
            if ANSWERED not in steps:
                asked = self.ids().where(F.col("batch_id") == batch).select("id")
                ask(asked).write.mode("overwrite").parquet(f"{self.folder}/answers/{batch}")
                self._mark(batch, ANSWERED)
            merge(self.answers(batch))
            self._mark(batch, MERGED)
            merged += 1
        return merged
