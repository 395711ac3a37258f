"""The shop's tables on disk: landed, synced and built once per session and data folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.operators import bronze, landing
from ordermill.plans import models
from ordermill.schemas import BRONZE
from ordermill.session import work_dir
from ordermill.sources import tables


@dataclass(frozen=True)
class Layers:
    """Stored tables of one data folder; every executor reaches their files.

    A table is written when it is first asked for, from the one before it, and then read; a table that a crash left
    unfinished is written again.
    """

    spark: SparkSession
    sf_dir: str
    root: str

    @property
    def bronze(self) -> DataFrame:
        return self._kept("bronze", lambda: bronze.bronze_rows(tables.order_events(self.spark, self.sf_dir)), BRONZE)

    @property
    def silver(self) -> DataFrame:
        return self._kept("silver", lambda: models.silver_items(self.bronze))

    @property
    def quarantine(self) -> DataFrame:
        return self._kept("quarantine", lambda: models.quarantine(self.bronze))

    @property
    def gold(self) -> DataFrame:
        return self._kept("gold", lambda: models.gold_fact(self.silver))

    def _kept(self, name: str, rows: Callable[[], DataFrame], schema: StructType | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        if not _done(self.spark, path):
            rows().write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(path)


def _path(spark: SparkSession, sf_dir: str, kind: str) -> str:
    return f"{work_dir(spark)}/{kind}-{hashlib.md5(sf_dir.encode()).hexdigest()[:16]}"


def _done(spark: SparkSession, path: str) -> bool:
    return bronze._exists(spark, f"{path}/_SUCCESS")


def landed(spark: SparkSession, sf_dir: str) -> str:
    """The order events as landing files with their manifest; returns the folder."""
    root = _path(spark, sf_dir, "landing")
    if not _done(spark, f"{root}/manifest/batch=0"):
        stamp = F.lit("2026-01-01").cast("timestamp")
        landing.land_batch(tables.order_events(spark, sf_dir), root, 0, ingested_at=stamp)
    return root


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Bronze, silver with its quarantine, and gold."""
    return Layers(spark, sf_dir, _path(spark, sf_dir, "models"))
