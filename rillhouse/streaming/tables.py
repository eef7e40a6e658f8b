"""Tables written by micro-batches.

Outputs are plain folders, one for each batch (``append_batch``): a batch that runs again after a failure replaces what it
wrote. What later batches read again is a ``BatchTable``. Under its path lie

    rows/piece=batch-<n>/bucket=<b>    what batch n added
    rows/piece=base-<n>/bucket=<b>     merged rows of all batches up to n, of the buckets that changed since the base before
    bases/<n>.json                     the pieces that make up the base of batch n; the newest base counts

Rows are dealt to buckets by a hash of their key. A reader takes the newest base and the batches after it in one scan, of only
the buckets it asks for. A new base rewrites only buckets that were added to, then its file appears under ``bases`` in
one step; pieces that neither it nor the base before needs are removed, so readers that began before may go on for one more base.
A table thus has at most two bases and twice ``every`` batches, however many have run.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A new base after so many batches.
COMPACT_EVERY = 50
BUCKETS = 16


def append_batch(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = (),
                 fmt: str = "parquet") -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(f"{path}/batches/batch={batch_id}")


class Folder:
    """Names, small files and removal in one folder, through Spark's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, inside: str = "") -> list[str]:
        at = self._at(inside)
        return [s.getPath().getName() for s in self.files.listStatus(at)] if self.files.exists(at) else []

    def has(self, name: str) -> bool:
        return self.files.exists(self._at(name))

    def read(self, name: str) -> str:
        stream = self.files.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The whole file appears at once."""
        hidden = self._at(f"_{name}")
        stream = self.files.create(hidden, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.files.rename(hidden, self._at(name))

    def remove(self, name: str) -> None:
        self.files.delete(self._at(name), True)


@dataclass(frozen=True)
class BatchTable:
    """Rows that batches add to and read back. ``merge`` reduces the rows of whole keys; merging merged rows with more must be the same
    as merging all at once."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    merge: Callable[[DataFrame], DataFrame] = lambda rows: rows
    # Whether batches add rows that are merged already, so that rows of one batch or base need not be merged again.
    merged_batches: bool = False
    buckets: int = BUCKETS
    every: int = COMPACT_EVERY

    def bucket(self, *keys):
        """The bucket of a key's columns; of the table's own, if none are given."""
        return F.pmod(F.xxhash64(*(keys or self.keys)), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, piece: str) -> None:
        dealt = rows.select(*self.schema.names, self.bucket().alias("bucket"))
        # The rebalance splits buckets that hold much and keeps others in one file.
        dealt.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows/piece={piece}")

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """What a batch adds, in place of what it may have added before; every ``every`` batches a new base is made first."""
        if batch_id and batch_id % self.every == 0:
            self.compact(rows.sparkSession, batch_id - 1)
        self._write(rows, f"batch-{batch_id}")

    def _bases(self, folder: Folder) -> list[int]:
        return sorted(int(name[:-5]) for name in folder.names() if name.endswith(".json") and not name.startswith(("_", ".")))

    def _state(self, spark: SparkSession, upto: int | None) -> tuple[int, dict[str, str], list[str]]:
        """Number and pieces by bucket of the newest base up to ``upto``, and the finished batches after it up to there."""
        folder, rows = Folder(spark, f"{self.path}/bases"), Folder(spark, f"{self.path}/rows")
        bases = [n for n in self._bases(folder) if upto is None or n <= upto]
        start = bases[-1] if bases else -1
        pieces = json.loads(folder.read(f"{start}.json")) if bases else {}
        numbers = sorted(int(name.split("-")[1]) for name in rows.names() if name.startswith("piece=batch-"))
        found = [f"piece=batch-{n}" for n in numbers if n > start and (upto is None or n <= upto)]
        return start, pieces, [p for p in found if rows.has(f"{p}/_SUCCESS")]

    def _scan(self, spark: SparkSession, folders: list[str], buckets: list[int] | None) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        root = f"{self.path}/rows"
        full = T.StructType([*self.schema.fields, T.StructField("piece", T.StringType()), T.StructField("bucket", T.IntegerType())])
        rows = spark.read.schema(full).option("basePath", root).parquet(*[f"{root}/{f}" for f in folders])
        return (rows if buckets is None else rows.where(F.col("bucket").isin(buckets))).select(*self.schema.names)

    def read(self, spark: SparkSession, upto: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of all finished batches up to ``upto``, of the buckets given, in one scan and not yet merged with each other."""
        _, base, batches = self._state(spark, upto)
        return self._scan(spark, [f"{p}/bucket={b}" for b, p in base.items() if buckets is None or int(b) in buckets] + batches, buckets)

    def merged(self, spark: SparkSession, upto: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        _, base, batches = self._state(spark, upto)
        rows = self.read(spark, upto, buckets)
        return rows if self.merged_batches and len(batches) + bool(base) == 1 else self.merge(rows)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """A new base of the batches up to ``upto``, unless it is there already."""
        start, base, batches = self._state(spark, upto)
        rows, bases = Folder(spark, f"{self.path}/rows"), Folder(spark, f"{self.path}/bases")
        if upto <= start or not batches:
            return
        touched = sorted({name.split("=")[1] for p in batches for name in rows.names(p) if name.startswith("bucket=")}, key=int)
        old = [f"{base[b]}/bucket={b}" for b in touched if b in base]
        if touched:
            self._write(self.merge(self._scan(spark, old + batches, None)), f"base-{upto}")
        kept = {b: f"piece=base-{upto}" for b in touched if rows.has(f"piece=base-{upto}/bucket={b}")}
        bases.write(f"{upto}.json", json.dumps({**{b: p for b, p in base.items() if b not in touched}, **kept}))
        self._clean(rows, bases, start)

    def _clean(self, rows: Folder, bases: Folder, before: int) -> None:
        """Removes what neither the newest base nor ``before``, the one before it, needs."""
        for n in self._bases(bases):
            if n < before:
                bases.remove(f"{n}.json")
        needed = {f"{p}/bucket={b}" for n in self._bases(bases) for b, p in json.loads(bases.read(f"{n}.json")).items()}
        for name in rows.names():
            kind, _, number = name.partition("=")[2].partition("-")
            if kind == "batch" and int(number) <= before:
                rows.remove(name)
            elif kind == "base" and int(number) <= before:
                inside = [b for b in rows.names(name) if b.startswith("bucket=")]
                for b in inside:
                    if f"{name}/{b}" not in needed:
                        rows.remove(f"{name}/{b}")
                if not any(f"{name}/{b}" in needed for b in inside):
                    rows.remove(name)
