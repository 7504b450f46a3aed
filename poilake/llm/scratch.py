"""Intermediate tables in the shared folder, removed as soon as nothing reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from poilake.session import scratch_path, store
from poilake.sources.files import delete_folder


class Scratch:
    """Tables of one run below ``spark.checkpoint.dir``; a lost executor cannot lose them."""

    def __init__(self, spark, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self._stored = 0

    def path(self, name: str) -> str:
        self._stored += 1
        return f"{self.root}/{self._stored}-{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: short lineage, and a true size for the optimizer."""
        return self.store_at(df, name)[0]

    def store_at(self, df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = self.path(name)
        return store(df, path), path

    def drop(self, *paths: str | None) -> None:
        """Remove tables that no later step reads."""
        for path in paths:
            if path:
                delete_folder(self.spark, path)
