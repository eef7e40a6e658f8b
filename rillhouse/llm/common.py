"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.session import shared_dir

#: White space of the word rule: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = "\\x20\\x09-\\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's name below the one that all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage, survives lost executors."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffles and broadcasts of finished rounds now: it does so once the driver has collected what named them,
    which is seldom in jobs of many small rounds."""
    spark._jvm.System.gc()


def give_back() -> None:
    """Returns to the system what this process has freed: a Python worker outlives its task and serves later stages, whose
    memory would come on top. What the C library keeps of many small arrays goes back only where it is glibc."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lower_ascii(text):
    """A-Z in lower case, all else unchanged."""
    return F.translate(text, UPPER, LOWER)


def crc_mod5(doc_id):
    """crc32 of the id as text, modulo 5; null ids count as remainder of the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def map_rows(df: DataFrame, f: Callable[..., dict], schema: str) -> DataFrame:
    """``f`` gets each Arrow batch's columns as Python lists and returns columns by name, in order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = f(*[c.to_pylist() for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), arrow.types)], schema=arrow)

    return df.mapInArrow(run, schema)


def fenced(column):
    """The value unchanged. Filters on it stay above the projection that computes it; pushed below, they
    would compute it anew for each use."""
    return F.when(F.spark_partition_id() >= 0, column)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the Python workers, once per application; they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parents[1]
        # A small file of the driver's own, which Spark serves to the executors.
        archive = Path(tempfile.mkdtemp(prefix="rillhouse-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in root.rglob("*.py"):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)
    return spark
