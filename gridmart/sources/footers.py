"""Answers from Parquet footers: counts and ranges without reading a data page.

Spark's Parquet reader can answer ``count``, ``min`` and ``max`` from the
statistics in the footers (aggregate push-down), by whole tables or by partition.
That needs the second reader interface and a setting of its own, so these
questions are put by a session beside the caller's, with the same catalog and
cluster; no setting of the caller changes.

What footers can not answer is read instead, by the same functions and with the
same result: the range of text (its statistics may be cut short) and files
written without statistics.  The reader gives no ranges of times, but of the
64-bit integers they are stored as (``session.REQUIRED_CONF``), so times are
asked as microseconds and turned back.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.sources import tables

#: Types whose ranges Parquet footers hold whole.
RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType,
          T.DateType, T.TimestampType, T.TimestampNTZType)


def _session(spark: SparkSession) -> SparkSession:
    own = getattr(spark, "_gridmart_footers", None)
    if own is None:
        own = spark.newSession()
        own.conf.set("spark.sql.session.timeZone", "UTC")
        own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
        own.conf.set("spark.sql.sources.useV1SourceList", "")
        own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        spark._gridmart_footers = own
    return own


def _is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType))


def table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path`` by the reader that answers from footers;
    times come as microseconds since 1970 (UTC).  For aggregates only."""
    stored = T.StructType([T.StructField(f.name, T.LongType() if _is_time(f) else f.dataType, True) for f in schema])
    return _session(spark).read.schema(stored).parquet(path)


def _answer(spark: SparkSession, path: str, schema: T.StructType, aggregates: dict[str, tuple[str, str | None]],
            by: list[str] | None = None) -> DataFrame:
    """``aggregates`` (result: function and column, no column for all rows) as a
    small frame of the caller's session; times as UTC wall clocks."""
    functions = {"count": F.count, "min": F.min, "max": F.max}
    asked = [functions[f](F.lit(1) if c is None else c).alias(out) for out, (f, c) in aggregates.items()]
    times = [out for out, (f, c) in aggregates.items() if f != "count" and _is_time(schema[c])]
    rows = None
    if tables.has_data(spark, path):
        try:
            frame = table(spark, path, schema).groupBy(*(by or [])).agg(*asked)
            rows = frame.withColumns({t: F.timestamp_micros(t).cast("timestamp_ntz") for t in times}).collect()
        except (PySparkException, Py4JJavaError) as error:
            if "aggregatePushdown" not in str(error):
                raise                                   # else a file without the statistics asked for
    frame = tables.read(spark, path, schema).groupBy(*(by or [])).agg(*asked)
    frame = frame.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})
    return frame if rows is None else spark.createDataFrame(rows, frame.schema)


def row_count(spark: SparkSession, path: str, schema: T.StructType, out: str = "rows") -> DataFrame:
    """One row: the number of rows (``profiles.row_count``)."""
    return _answer(spark, path, schema, {out: ("count", None)})


def counts_by_partition(spark: SparkSession, path: str, schema: T.StructType, partition_col: str,
                        out: str = "rows") -> DataFrame:
    """Rows of each partition; the result has one row for each, however many
    rows they hold."""
    return _answer(spark, path, schema, {out: ("count", None)}, [partition_col])


def null_profile(spark: SparkSession, path: str, schema: T.StructType, columns: list[str],
                 suffix: str = "_nulls") -> DataFrame:
    """One row: NULLs of each column (``profiles.null_profile``)."""
    counted = _answer(spark, path, schema, {"_rows": ("count", None), **{f"_{c}": ("count", c) for c in columns}})
    return counted.select(*[(F.col("_rows") - F.col(f"_{c}")).alias(f"{c}{suffix}") for c in columns])


def value_profile(spark: SparkSession, path: str, schema: T.StructType, columns: list[str]) -> DataFrame:
    """One row: min and max of each column (``profiles.value_profile``).

    Columns of a type without whole ranges are asked apart, so that they do not
    keep the others from being answered by the footers."""
    ranged = [c for c in columns if isinstance(schema[c].dataType, RANGED)]
    parts = [_answer(spark, path, schema, {f"{f}_{c}": (f, c) for c in some for f in ("min", "max")})
             for some in (ranged, [c for c in columns if c not in ranged]) if some]
    row = {k: v for part in parts for k, v in part.first().asDict().items()}
    kinds = {f.name: f for part in parts for f in part.schema}
    names = [f"{n}_{c}" for c in columns for n in ("min", "max")]
    found = spark.createDataFrame([tuple(row[n] for n in names)], T.StructType([kinds[n] for n in names]))
    # instants again, under the UTC pin
    return found.select(*[F.col(f"{n}_{c}").cast(schema[c].dataType).alias(f"{n}_{c}")
                          for c in columns for n in ("min", "max")])


def time_range(spark: SparkSession, path: str, schema: T.StructType, col: str,
               lo: str = "min_hour", hi: str = "max_hour") -> DataFrame:
    """One row: first and last time (``profiles.time_range``)."""
    return value_profile(spark, path, schema, [col]).toDF(lo, hi)


def latest_wall(spark: SparkSession, path: str, schema: T.StructType, col: str):
    """The latest time as a UTC wall clock, or None: the mark of a whole layer."""
    return _answer(spark, path, schema, {"m": ("max", col)}).first()["m"]


def range_walls(spark: SparkSession, path: str, schema: T.StructType, col: str):
    """First and last time as UTC wall clocks (or None)."""
    r = _answer(spark, path, schema, {"lo": ("min", col), "hi": ("max", col)}).first()
    return r["lo"], r["hi"]
