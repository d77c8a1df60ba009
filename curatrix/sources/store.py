"""Tables as Parquet folders with versions: append, keyed update and delete, resume.

Parquet has no UPDATE or DELETE, so a change writes the next version beside the current one and then
moves a small pointer file, written under another name and renamed over it in one step; readers see the old table or
the new one.  Paths go through Hadoop's file systems.  The rename is one step on HDFS and local disks; on an
object store it is as atomic as its connector makes it.

Rows are kept in folders ``__batch=...`` of the version.  An append with a batch id overwrites the folder
of that id alone when it commits, so it can be repeated after a crash and leaves one copy.

A change notes the version it starts from and refuses to move the pointer if another writer has moved it since;
two that move it at the very same moment are not told apart, so a table has one writer at a time by agreement.
Appends with different batch ids do not disturb one another.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import add_columns, align


#: Column that names the folder of an append.
BATCH = "__batch"


class ConcurrentWrite(RuntimeError):
    """Another writer has changed the table since this change began."""


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _pointer(self, name: str) -> str:
        return f"{self.root}/{name}/CURRENT"

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(self._pointer(name)))

    def tables(self) -> list[str]:
        if not self._fs.exists(self._path(self.root)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.root)) if s.isDirectory()]
        return sorted(n for n in names if self.exists(n))

    def location(self, name: str) -> str:
        stream = self._fs.open(self._path(self._pointer(name)))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def read(self, name: str) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "true").parquet(self.location(name))

    def columns(self, name: str) -> list[str]:
        return self.read(name).columns

    def _current(self, name: str) -> str | None:
        return self.location(name) if self.exists(name) else None

    def replace(self, name: str, df: DataFrame, per_file: int = 0) -> None:
        """Create the table or put ``df`` in its place, in files of at most ``per_file`` rows if that is given.

        The version before stays until the next change, for readers that have begun with it.
        """
        old = self._current(name)
        path = f"{self.root}/{name}/v-{uuid.uuid4().hex}"
        df.write.option("maxRecordsPerFile", per_file).parquet(f"{path}/{BATCH}=0")
        if self._current(name) != old:
            self._fs.delete(self._path(path), True)
            raise ConcurrentWrite(f"table {name} has been changed by another writer")
        self._point(name, path)
        keep = {p.rsplit("/", 1)[1] for p in (path, old) if p}
        for entry in self._fs.listStatus(self._path(f"{self.root}/{name}")):
            if entry.isDirectory() and entry.getPath().getName() not in keep:
                self._fs.delete(entry.getPath(), True)

    def _point(self, name: str, path: str) -> None:
        pointer, new = self._path(self._pointer(name)), self._path(f"{self._pointer(name)}-{uuid.uuid4().hex}")
        out = self._fs.create(new, True)
        out.write(path.encode())
        out.close()
        gateway, jvm = self.spark.sparkContext._gateway, self.spark.sparkContext._jvm
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        overwrite = gateway.new_array(rename, 1)
        overwrite[0] = rename.valueOf("OVERWRITE")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        files.rename(self._fs.makeQualified(new), self._fs.makeQualified(pointer), overwrite)

    def create(self, name: str, df: DataFrame) -> None:
        if self.exists(name):
            raise ValueError(f"table {name} exists")
        self.replace(name, df)

    def create_if_absent(self, name: str, df: DataFrame) -> bool:
        """Create the table unless it is there; whether it was created."""
        if self.exists(name):
            return False
        self.replace(name, df)
        return True

    def append(self, name: str, df: DataFrame, batch: str | None = None) -> None:
        """Add rows, aligned to the table's columns; a batch that has an id is there once, however often it is appended."""
        rows = align(df, self.read(name).schema).withColumn(BATCH, F.lit(f"b-{batch or uuid.uuid4().hex}"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(self.location(name))

    def append_or_create(self, name: str, df: DataFrame, batch: str | None = None) -> None:
        """Append; a table that is not there is first made with no rows, so the batch id holds from the start."""
        self.create_if_absent(name, df.limit(0))
        self.append(name, df, batch)

    def sizes(self, name: str) -> tuple[int, int]:
        """Bytes of the last replacement and of the appends since, from the folders' listing alone."""
        base = self.location(name)
        whole = self._fs.getContentSummary(self._path(base)).getLength()
        first = self._path(f"{base}/{BATCH}=0")
        kept = self._fs.getContentSummary(first).getLength() if self._fs.exists(first) else 0
        return kept, whole - kept

    def add_columns(self, name: str, columns: dict[str, str]) -> None:
        if any(c not in self.columns(name) for c in columns):
            self.replace(name, add_columns(self.read(name), columns))

    def update(self, name: str, source: DataFrame, key: str, columns: list[str], merge_max: tuple[str, ...] = ()) -> None:
        self.replace(name, updated(self.read(name), source, key, columns, merge_max))

    def delete(self, name: str, keys: DataFrame, key: str) -> None:
        self.replace(name, deleted(self.read(name), keys, key))


def updated(target: DataFrame, source: DataFrame, key: str, columns: list[str], merge_max: tuple[str, ...] = ()) -> DataFrame:
    """The target with ``columns`` taken from the source where the key matches, null included.

    Columns in ``merge_max`` keep the larger of both values.  The source has one row for each key.
    """
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    wide = add_columns(target, {c: kinds[c] for c in columns})
    src = source.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias("__hit"))
    joined = wide.join(src, F.col(key) == F.col("__key"), "left")
    hit = F.col("__hit").isNotNull()
    new = {}
    for c in columns:
        value = F.col(f"__new_{c}")
        if c in merge_max:
            value = F.greatest(F.coalesce(F.col(c), value), value)
        new[c] = F.when(hit, value).otherwise(F.col(c))
    return joined.withColumns(new).select(*wide.columns)


def deleted(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The target without the rows whose key is among the keys."""
    gone = keys.select(F.col(key).alias("__key"))
    return target.join(gone, F.col(key) == F.col("__key"), "left_anti")
