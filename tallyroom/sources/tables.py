"""Table namespaces: the one place a pipeline's inputs come from."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tallyroom.sources.sample import PARQUET, SAMPLE_SQL


class _Namespace:
    """Attribute access to tables: ``t.dim_recipe`` is a DataFrame."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._cache: dict[str, DataFrame] = {}

    def _load(self, name: str) -> DataFrame:
        raise NotImplementedError

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self._load(name)
        return self._cache[name]


class CatalogTables(_Namespace):
    """Tables of a catalog, one namespace per layer.

    ``layers`` maps a table to its namespace when it differs from the default,
    so one pipeline can read master, event and forecast layers together.
    """

    def __init__(self, spark: SparkSession, namespace: str, layers: dict[str, str] | None = None):
        super().__init__(spark)
        self._namespace = namespace
        self._layers = layers or {}

    def _load(self, name: str) -> DataFrame:
        df = self.spark.table(f"{self._layers.get(name, self._namespace)}.{name}")
        return df.toDF(*[c.lower() for c in df.columns])


class GivenTables(_Namespace):
    """Tables handed in as DataFrames (tests, notebooks)."""

    def __init__(self, spark: SparkSession, **tables: DataFrame):
        super().__init__(spark)
        self._cache.update(tables)

    def _load(self, name: str) -> DataFrame:
        raise AttributeError(f"table {name} was not given")


class SampleTables(_Namespace):
    """The driver's parquet folder, mapped onto the retail model."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark)
        self.folder = folder.rstrip("/")

    def _load(self, name: str) -> DataFrame:
        if name in PARQUET:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name not in SAMPLE_SQL:
            raise AttributeError(name)
        sql = SAMPLE_SQL[name]
        inputs = {ref: getattr(self, ref) for ref in set(re.findall(r"\{(\w+)\}", sql))}
        return self.spark.sql(sql, **inputs)
