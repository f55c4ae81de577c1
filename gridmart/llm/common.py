"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words: space, tab, line feed, vertical tab,
#: form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"

#: Text bytes a Python worker handles at once; bounds its temporaries.
SLICE_BYTES = 1 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package's source files to the executors (once a session), so
    that workers can import it wherever they start.  Spark copies the archive
    to them itself; nothing else reads it."""
    sc = spark.sparkContext
    if getattr(sc, "_gridmart_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="gridmart-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(archive)
    sc._gridmart_shipped = True


def columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Only the named columns, cast to the types the operator works on.

    Columns the operator does not read are dropped here, so their names can
    not clash with the operator's own.
    """
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in wanted.items()])


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not hold in any letter case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], text: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows that hold about ``limit`` text bytes
    (always whole rows, at least one)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        sizes = pc.binary_length(col).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            size = size or 0
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def byte_texts(col: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8 bytes, null as empty."""
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def ensure_checkpoints(spark: SparkSession) -> None:
    """Reliable checkpoints go to the shared folder named in the session's
    ``spark.checkpoint.dir``.  Only where that is unset and the session is
    local (tests) a temporary folder of this machine is used."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the "
                               "driver and all executors share")
        shared = os.path.join(tempfile.gettempdir(), "gridmart-checkpoints")
    sc.setCheckpointDir(shared)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage that this session wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder; later reads do not
    depend on any executor.  With ``cleanCheckpoints`` Spark removes the files
    when the frame is no longer referenced."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)
