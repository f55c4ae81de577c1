"""Silver tables laid out by (region, hour), so that gold needs no exchange.

A bucketed table keeps the rows of one hash of (region, hour) in one file of each
partition.  Both silver feeds with the same number of buckets are co-partitioned
in storage: the hourly roll-up groups, and the gold join matches, within a bucket,
and Spark plans both without moving a row.  The price of it is a fixed number of
tasks (the buckets) and as many files in each partition, so the number is chosen
for the data: about the cores of the cluster, with month partitions unless a day
fills its buckets.

Buckets are known to a catalog only, so these layers are external tables whose
files stay under the layout; ``attach`` registers existing files with a session
whose catalog does not know them.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridmart.plans.silver import with_hour
from gridmart.schemas import SILVER_PRICE, SILVER_WEATHER
from gridmart.sources import tables
from gridmart.sources.tables import Layout

KEYS = ("region", "hour_utc")


@dataclass(frozen=True)
class BucketedTable:
    """A partitioned, bucketed external table of the session catalog."""
    name: str
    path: str
    schema: T.StructType
    partition_col: str
    buckets: int
    keys: tuple[str, ...] = KEYS

    def _create(self, spark: SparkSession, name: str, path: str) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet PARTITIONED BY (`{self.partition_col}`) "
                  f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def exists(self, spark: SparkSession) -> bool:
        tables.settle(spark, self.path)
        return tables.exists(spark, self.path)

    def attach(self, spark: SparkSession) -> None:
        """Makes the session's catalog know the table and its partitions."""
        if not spark.catalog.tableExists(self.name):
            self._create(spark, self.name, self.path)
            spark.catalog.recoverPartitions(self.name)

    def detach(self, spark: SparkSession) -> None:
        spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")       # the files stay

    def read(self, spark: SparkSession) -> DataFrame:
        if not self.exists(spark):
            return spark.createDataFrame([], self.schema)
        self.attach(spark)
        return spark.table(self.name)

    def _insert(self, df: DataFrame, name: str) -> None:
        """Rows into the buckets of their partitions, each partition replaced."""
        spark = df.sparkSession
        columns = [f.name for f in self.schema if f.name != self.partition_col] + [self.partition_col]
        # dealt out by the bucket keys, a task holds few buckets and writes few files
        (df.select(*columns).repartition(self.buckets, *self.keys)
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name))
        spark.catalog.refreshTable(name)

    def overwrite(self, df: DataFrame) -> int:
        """Full replacement, written beside the old files and swapped in."""
        spark = df.sparkSession
        tables.settle(spark, self.path)
        fresh, name = f"{self.path}.new-{uuid.uuid4().hex}", f"{self.name}_{uuid.uuid4().hex[:8]}"
        self._create(spark, name, fresh)
        try:
            self._insert(df, name)
            rows = spark.table(name).count()
        finally:
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        self.detach(spark)
        tables._swap(spark, fresh, self.path)
        self.attach(spark)
        return rows

    def replace(self, df: DataFrame, staged: bool) -> None:
        """Replaces just the partitions that ``df`` holds."""
        self.attach(df.sparkSession)
        self._insert(df, self.name)


def silver_table(layout: Layout, feed: str):
    """The silver layer of a feed, as the layout keeps it."""
    schema = SILVER_PRICE if feed == "price" else SILVER_WEATHER
    path = layout.silver_price if feed == "price" else layout.silver_weather
    if not layout.buckets:
        return tables.PathTable(path, schema, "utc_date", tables.LAYER_CLUSTERS[f"silver_{feed}"])
    mark = hashlib.sha256(layout.root.encode()).hexdigest()[:12]
    with_key = T.StructType([*schema.fields, T.StructField("hour_utc", T.TimestampType(), True)])
    return BucketedTable(f"gridmart_silver_{feed}_{mark}", path, with_key, "utc_date", layout.buckets)


def for_table(table, silver: DataFrame) -> DataFrame:
    """Silver rows with the columns that ``table`` keeps."""
    return with_hour(silver) if isinstance(table, BucketedTable) else silver
