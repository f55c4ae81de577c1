"""Keyed upsert (MERGE: update all columns on match, insert otherwise).

Plain parquet has no MERGE, and Spark refuses to overwrite a path that the
same job reads.  ``upsert_frame`` is the pure relational form:

    result = target LEFT ANTI JOIN source ON keys  UNION ALL  source

``upsert_path`` applies it to a partitioned parquet table whose partition
column is derived from the key's time (so a key never changes partition), and
``upsert_into`` to a bucketed catalog table as well:
it reads only the partitions the source touches, writes the merged rows to a
fresh staging folder under the shared ``spark.checkpoint.dir`` (cutting the
lineage on storage that survives executor loss), then replaces just those
partitions with a dynamic partition overwrite and removes the staging folder.
Re-running the same source is idempotent.  Not atomic across partitions: a
failure between the two writes leaves the target as before or with some
partitions replaced by their final content, never with partial partitions.

The touched partitions stay a table.  The target is joined with them by equality
on its partition column, so Spark prunes its scan at run time to exactly those
partitions, however far apart they lie (``Touched.rows_of``); the NULL partition,
which no equality finds, is read by a filter of its own.

Like MERGE, NULL keys never match.  A row without a full key (say, a malformed
time) can not be identified by it; ``upsert_path`` identifies such rows by their
whole content but the audit columns, so loading the same bad row twice leaves
one.  Several source rows for one full key are refused (MERGE raises for them
too); ``latest_per_key`` resolves them first when the caller wants "latest wins".
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.session import remove_path, shared_dir, staging_path
from gridmart.sources.tables import PathTable

# Columns that tell when a row was loaded, not what it says.
AUDIT_COLUMNS = ("ingestion_time",)


class DuplicateSourceKeys(ValueError):
    """The upsert source holds a key more than once."""


def full_key(keys: list[str]) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def duplicate_key_count(df: DataFrame, keys: list[str]) -> int:
    return (df.filter(full_key(keys)).groupBy(*keys).count()
              .filter(F.col("count") > 1).limit(1).count())


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    if duplicate_key_count(df, keys):
        raise DuplicateSourceKeys(f"upsert source has repeated keys {keys}")


def latest_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """One row per key: the row with the greatest ``order_col``.

    ``max_by`` over a struct is a partial aggregate, so a hot key is reduced
    map-side before the shuffle instead of landing whole in one task.
    """
    others = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*others), F.col(order_col)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def latest_landed(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """``latest_per_key`` for rows with a full key; every other row stays.
    ``order_col`` is dropped."""
    whole = latest_per_key(df.filter(full_key(keys)), keys, order_col)
    rest = df.filter(~full_key(keys))
    return whole.unionByName(rest).drop(order_col)


def upsert_frame(target: DataFrame, source: DataFrame, keys: list[str],
                 check_unique: bool = True) -> DataFrame:
    """Target rows not replaced by the source, plus every source row."""
    if check_unique:
        assert_unique(source, keys)
    src = source.select(*target.columns)
    kept = target.join(src.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(src)


def _without_repeated_content(target: DataFrame, src: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows but those without a full key that the source holds again."""
    content = [c for c in target.columns if c not in AUDIT_COLUMNS]
    again = src.filter(~full_key(keys)).select(*[F.col(c).alias(f"_s_{c}") for c in content]).distinct()
    same = functools.reduce(lambda a, b: a & b,
                            [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in content])
    odd = target.filter(~full_key(keys)).join(again, same, "left_anti")
    return target.filter(full_key(keys)).unionByName(odd)


#: Up to so many touched partitions are broadcast (a few dozen bytes each), the
#: form in which Spark prunes a scan at run time.  More are joined by a shuffle.
MAX_BROADCAST_PARTITIONS = 100_000


@dataclass(frozen=True)
class Touched:
    """The partition values a load touched: a one-column table in the shared
    folder, its range and its size."""
    values: DataFrame
    column: str
    low: object
    high: object
    has_null: bool
    count: int

    @staticmethod
    def of(df: DataFrame, column: str) -> "Touched":
        values = df.select(column).distinct().checkpoint(eager=True)
        r = values.agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("n"),
                       F.count_if(F.col(column).isNull()).alias("nulls")).first()
        return Touched(values, column, r["lo"], r["hi"], r["nulls"] > 0, r["n"])

    def union(self, other: "Touched | None") -> "Touched":
        if other is None:
            return self
        both = other.values.withColumnRenamed(other.column, self.column)
        return Touched.of(self.values.unionByName(both), self.column)

    def rows_of(self, df: DataFrame, column: str | None = None) -> DataFrame:
        """The rows of ``df`` in these partitions (its ``column``).

        The literal range serves the listing of partitions; which of them are
        read is decided at run time by the join.  Its filter on the values is
        what makes Spark take them for a selection worth pruning by."""
        column = column or self.column
        parts = []
        if self.low is not None:
            values = self.values.select(F.col(self.column).alias("_touched")) \
                .filter(F.col("_touched").between(F.lit(self.low), F.lit(self.high)))
            if self.count <= MAX_BROADCAST_PARTITIONS:
                values = F.broadcast(values)
            inside = df.filter(F.col(column).between(F.lit(self.low), F.lit(self.high)))
            parts.append(inside.join(values, F.col(column) == F.col("_touched"), "left_semi"))
        if self.has_null:
            parts.append(df.filter(F.col(column).isNull()))
        return functools.reduce(DataFrame.unionByName, parts) if parts else df.limit(0)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def upsert_path(spark: SparkSession, target_path: str, source: DataFrame,
                keys: list[str], partition_col: str, check_unique: bool = True,
                cluster: tuple[str, ...] = ()) -> tuple[int, Touched | None]:
    """``upsert_into`` the Parquet folder at ``target_path``, the rows of its
    partitions clustered by ``cluster`` (see ``tables.clustered``)."""
    # the schema is the source's: a table without a data file, or whose only
    # partition is the NULL one, has none that could be inferred
    table = PathTable(target_path, _nullable(source.schema), partition_col, cluster)
    return upsert_into(spark, table, source, keys, check_unique)


def upsert_into(spark: SparkSession, table, source: DataFrame, keys: list[str],
                check_unique: bool = True) -> tuple[int, Touched | None]:
    """Upsert ``source`` into a ``PathTable`` or ``BucketedTable``.

    Returns the number of source rows applied and the partitions they touch;
    (0, None) for an empty source, which writes nothing.
    """
    shared_dir(spark)          # the touched partitions are checkpointed there
    partition_col = table.partition_col
    src = source.cache()
    try:
        if check_unique:
            # row count and key uniqueness from one aggregation
            st = (src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
                     .agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n"),
                          F.max(F.when(full_key(keys), F.col("_c"))).alias("m")).first())
            if st["m"] is not None and st["m"] > 1:
                raise DuplicateSourceKeys(f"upsert source has repeated keys {keys}")
            n = int(st["n"])
        else:
            n = src.count()
        if n == 0:
            return 0, None
        touched = Touched.of(src, partition_col)
        if not table.exists(spark):
            table.replace(src, staged=False)
            return n, touched
        target = touched.rows_of(table.read(spark)).select(*src.columns)
        merged = upsert_frame(_without_repeated_content(target, src, keys), src, keys, check_unique=False)
        stage = staging_path(spark, "upsert")
        try:
            (merged.hint("rebalance", partition_col)
                   .write.mode("overwrite").partitionBy(partition_col).parquet(stage))
            staged = spark.read.schema(_nullable(src.schema)).parquet(stage).select(*src.columns)
            table.replace(staged, staged=True)
        finally:
            remove_path(spark, stage)
        return n, touched
    finally:
        src.unpersist()
