"""A keyed table on the shared folder: update what is there, insert what is not, without a database.

Rows are dealt into buckets by a hash of their key. A version of the table is one commit file that names, for each bucket,
the folder its rows lie in. A batch rewrites the buckets that it touches into a folder of its own and then commits, so

* bytes written follow the batch, not the table (a batch that touches all buckets rewrites all, once),
* readers see whole versions only, and a batch that died before its commit never shows,
* a replayed batch finds its number committed and changes nothing, and can still read the table as it was before itself.

One writer at a time: a second one fails at the commit, which refuses to replace a file. :meth:`KeyedTable.vacuum` drops
what no kept version names.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "__dealt"
# How a value that is there and the one of the batch make the new one; null is no value.
COMBINE = {
    "last": lambda old, new, there: F.when(there, new).otherwise(old),
    "sum": lambda old, new, there: F.when(old.isNull(), new).when(new.isNull(), old).otherwise(old + new),
    "min": lambda old, new, there: F.least(old, new),
    "max": lambda old, new, there: F.greatest(old, new),
    "first": lambda old, new, there: F.coalesce(old, new),
}


class _Files:
    """Small files in a folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark.sparkContext._jvm
        self.folder = self._path(folder)
        self.system = self.folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        path = self.jvm.org.apache.hadoop.fs.Path
        return path(self.folder, "/".join(parts)) if hasattr(self, "folder") else path(parts[0])

    def names(self, *parts: str) -> list[str]:
        at = self._path(*parts)
        return sorted(s.getPath().getName() for s in self.system.listStatus(at)) if self.system.exists(at) else []

    def read(self, *parts: str) -> str:
        stream = self.system.open(self._path(*parts))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, text: str, *parts: str) -> None:
        """All of a file that was not there, or an error: written aside and then renamed."""
        target, aside = self._path(*parts), self._path(*parts[:-1], f".{uuid.uuid4().hex}")
        stream = self.system.create(aside, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if self.system.exists(target) or not self.system.rename(aside, target):
            self.system.delete(aside, False)
            raise FileExistsError(f"{target.toString()} was committed by another writer")

    def delete(self, *parts: str) -> None:
        self.system.delete(self._path(*parts), True)


@dataclass(frozen=True)
class Version:
    """What a commit file says: its number, the batch that made it, the columns, and the folder of each bucket."""

    number: int
    batch: int
    schema: dict
    folders: dict[str, str]


@dataclass(frozen=True)
class KeyedTable:
    """One row for each ``keys`` under ``path``; one table belongs to one checkpoint. ``by`` are the keys that deal the
    rows into buckets (all, unless given), by which they can be looked up. ``kept`` versions stay readable: two are what a
    replay needs."""

    path: str
    keys: tuple[str, ...]
    buckets: int = 64
    kept: int = 2
    by: tuple[str, ...] = ()

    def _versions(self, spark: SparkSession) -> list[str]:
        return [n for n in _Files(spark, self.path).names("commits") if n.endswith(".json")]

    def version(self, spark: SparkSession, before_batch: int | None = None) -> Version | None:
        """The newest version, or the newest that a batch before ``before_batch`` made."""
        files = _Files(spark, self.path)
        for name in reversed(self._versions(spark)):
            found = Version(**json.loads(files.read("commits", name)))
            if before_batch is None or found.batch < before_batch:
                return found
        return None

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(self.by or self.keys)), F.lit(self.buckets)).cast("int")

    def _rows(self, spark: SparkSession, version: Version, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(version.schema)
        wanted = None if buckets is None else {str(b) for b in buckets}
        paths = [f"{self.path}/{folder}/{BUCKET}={b}" for b, folder in version.folders.items() if wanted is None or b in wanted]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def read(self, spark: SparkSession, schema: StructType | None = None, before_batch: int | None = None) -> DataFrame:
        """All rows. A table without a version reads as one without rows if ``schema`` is given."""
        found = self.version(spark, before_batch)
        if found is None:
            if schema is None:
                raise FileNotFoundError(f"no version in {self.path}")
            return spark.createDataFrame([], schema)
        return self._rows(spark, found)

    def _touched(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in rows.select(self._bucket().alias(BUCKET)).distinct().collect()]  # a row a bucket

    def lookup(self, rows: DataFrame, schema: StructType, before_batch: int | None = None) -> DataFrame:
        """The table's rows in the buckets that ``rows`` touches; the others are not read."""
        spark = rows.sparkSession
        found = self.version(spark, before_batch)
        return self._rows(spark, found, self._touched(rows)) if found else spark.createDataFrame([], schema)

    def upsert(self, rows: DataFrame, batch_id: int, combine: Mapping[str, str] | None = None,
               merge: Callable[[DataFrame], DataFrame] | None = None) -> Version:
        """Updates and inserts ``rows``, which hold each key once and all columns of the table; the new version, or the one that
        is there if this batch or a later one made it.

        ``combine`` says for a column how the old and the new value make one (``last``, the default, ``sum``, ``min``, ``max``,
        ``first``). ``merge`` makes one row for each key of old and new rows together instead; it leaves a key's only row as
        it is.
        """
        spark = rows.sparkSession
        now = self.version(spark)
        if now is not None and now.batch >= batch_id:
            # A stateful query writes its own state as its rows are read, also those of a batch that is committed here.
            rows.write.format("noop").mode("overwrite").save()
            return now
        values = [c for c in rows.columns if c not in self.keys]
        rows = rows.persist()
        try:
            touched = self._touched(rows)
            schema = now.schema if now else json.loads(rows.schema.json())
            new = rows.withColumn("__new", F.lit(True)).alias("n")
            if now and merge:
                merged = merge(self._rows(spark, now, touched).unionByName(rows))
            elif now:
                old = self._rows(spark, now, touched).alias("o")
                same = functools.reduce(Column.__and__, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in self.keys])
                there = F.col("n.__new").isNotNull()
                merged = new.join(old, same, "full_outer").select(
                    *[F.when(there, F.col(f"n.{k}")).otherwise(F.col(f"o.{k}")).alias(k) for k in self.keys],
                    *[COMBINE[(combine or {}).get(v, "last")](F.col(f"o.{v}"), F.col(f"n.{v}"), there).alias(v) for v in values])
            else:
                merged = rows
            types = {f.name: f.dataType for f in StructType.fromJson(schema)}
            merged = merged.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
            folder = f"data/{batch_id:012d}-{uuid.uuid4().hex}"
            if touched:
                merged.withColumn(BUCKET, self._bucket()).repartition(min(len(touched), self.buckets), BUCKET).write.partitionBy(
                    BUCKET).parquet(f"{self.path}/{folder}")
        finally:
            rows.unpersist()
        number = now.number + 1 if now else 0
        folders = {**(now.folders if now else {}), **{str(b): folder for b in touched}}
        made = Version(number, batch_id, schema, folders)
        _Files(spark, self.path).write_new(json.dumps(made.__dict__), "commits", f"{number:012d}.json")
        if self.kept:
            self.vacuum(spark, self.kept)
        return made

    def vacuum(self, spark: SparkSession, keep: int = 2) -> None:
        """Drops versions before the newest ``keep`` and the folders that no kept version names. For the writer, between
        batches; whoever still reads a dropped version loses it."""
        files = _Files(spark, self.path)
        names = self._versions(spark)
        if len(names) <= keep:
            return
        used = {f for name in names[-keep:] for f in json.loads(files.read("commits", name))["folders"].values()}
        for name in names[:-keep]:
            files.delete("commits", name)
        for name in files.names("data"):
            if f"data/{name}" not in used:
                files.delete("data", name)
