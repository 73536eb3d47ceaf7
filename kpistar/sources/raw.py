"""Readers for the driver's parquet tables.

Each table is read lazily with ``spark.read.parquet``; Catalyst prunes the
columns and pushes filters into the scan, so reading a table here costs
nothing until a plan uses it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events")


class RawTables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def region(self) -> DataFrame:
        return self.read("region")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.read("supplier")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")
