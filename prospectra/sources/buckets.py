"""Keyed tables in buckets, with versions that writers commit only if nobody was faster.

A table is a fixed number of buckets by hash of its keys, each sorted, and a manifest per
version that names the folder of every bucket. A merge reads and rewrites the buckets that
the source touches: the table's rows are joined where they lie, without a shuffle, and all
other buckets stay as they are. A version exists once its manifest does; that file is put in
place only if it is absent, so of two writers one is first. The other looks at what the first
one touched: other buckets, and it commits after it; the same, and it works anew on the new
version. A run that fails before its commit leaves nothing but unnamed folders.

The commit is atomic where the store's rename into an existing name fails as a whole, as in
HDFS, and on local disks by a hard link. Manifests hold one entry per bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from prospectra.operators.merge import merge_upsert

BUCKET = "_b"


class Conflict(Exception):
    """Other writers touched the same buckets in every attempt."""


class _Store:
    """Small files through the session's file systems."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        path = self.path(folder)
        fs = path.getFileSystem(self.conf)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.path(name).getFileSystem(self.conf).open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put_absent(self, name: str, text: str) -> bool:
        """Writes a whole file under a name that nobody has; False if somebody was faster."""
        path, draft = self.path(name), self.path(f"{name}.{uuid.uuid4().hex}")
        fs = path.getFileSystem(self.conf)
        out = fs.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if fs.getUri().getScheme() == "file":
                place = lambda p: self.jvm.java.io.File(p.toUri().getPath()).toPath()
                self.jvm.java.nio.file.Files.createLink(place(path), place(draft))
            else:
                options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
                options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.conf).rename(draft, path, options)
            return True
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getSimpleName():
                raise
            return False
        finally:
            if fs.exists(draft):
                fs.delete(draft, False)


@dataclass(frozen=True)
class Manifest:
    """One version of a table."""

    version: int
    keys: list[str]
    count: int
    schema: str
    folders: dict[str, str]
    touched: list[int] = field(default_factory=list)

    def text(self) -> str:
        return json.dumps(self.__dict__)


class BucketTable:
    """A versioned table under a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), _Store(spark)

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.store.names(f"{self.root}/versions") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> Manifest:
        version = max(self.versions()) if version is None else version
        return Manifest(**json.loads(self.store.read(f"{self.root}/versions/{version:020d}.json")))

    def _commit(self, manifest: Manifest) -> bool:
        return self.store.put_absent(f"{self.root}/versions/{manifest.version:020d}.json", manifest.text())

    def _write(self, df: DataFrame, keys: list[str], count: int) -> dict[str, str]:
        """Writes rows into a new folder, a folder per bucket; returns bucket -> folder."""
        folder, name = f"{self.root}/data/{uuid.uuid4().hex}", f"written_{uuid.uuid4().hex}"
        rows = df.withColumn(BUCKET, self._bucket(keys, count))
        rows.write.partitionBy(BUCKET).bucketBy(count, *keys).sortBy(*keys).format("parquet").option("path", folder).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        return {n.split("=")[1]: f"{folder}/{n}" for n in self.store.names(folder) if n.startswith(f"{BUCKET}=")}

    @staticmethod
    def _bucket(keys: list[str], count: int) -> Column:
        """Spark's own bucket of a row."""
        return F.pmod(F.hash(*keys), F.lit(count))

    @classmethod
    def buckets_of(cls, keys_of: DataFrame, m: Manifest) -> list[int]:
        """The buckets of a version that hold the keys of a DataFrame; at most all of them."""
        return sorted(r[0] for r in keys_of.select(cls._bucket(m.keys, m.count).alias(BUCKET)).distinct().collect())

    def create(self, df: DataFrame, keys: list[str], buckets: int) -> Manifest:
        """The first version, of a DataFrame that is unique on its keys."""
        folders = self._write(df.repartition(buckets, *keys), keys, buckets)
        made = Manifest(1, keys, buckets, df.schema.json(), folders, sorted(map(int, folders)))
        if not self._commit(made):
            raise Conflict(f"{self.root} has a first version already")
        return made

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """A version, or some of its buckets; joins on the keys need no shuffle of it."""
        return self._read(self.manifest(version), buckets)

    def _read(self, m: Manifest, buckets: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(m.schema))
        wanted = {b: f for b, f in m.folders.items() if buckets is None or int(b) in set(buckets)}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        name = f"version_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(f"`{k}`" for k in m.keys)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {m.count} BUCKETS LOCATION '{self.root}/data'")
        places = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{f}'" for b, f in wanted.items())
        self.spark.sql(f"ALTER TABLE {name} ADD {places}")
        return self.spark.table(name).drop(BUCKET)

    def change(self, keys_of: DataFrame, make: Callable[[DataFrame], DataFrame], attempts: int = 5) -> Manifest:
        """Replaces the buckets that hold the keys of a DataFrame by what ``make`` makes of their rows, and commits.

        ``make`` must keep rows in the buckets of their keys. It runs again on the new version
        when another writer touched one of the buckets in between.
        """
        base = self.manifest()
        touched = self.buckets_of(keys_of, base)
        for _ in range(attempts):
            folders = self._write(make(self._read(base, touched)), base.keys, base.count) if touched else {}
            done = self._committed(base, folders, touched)
            if done:
                return done
            base = self.manifest()
        raise Conflict(f"{self.root}: other writers were faster {attempts} times")

    def _committed(self, base: Manifest, folders: dict[str, str], touched: list[int]) -> Manifest | None:
        """The version after ``base``, or after later ones that touched other buckets; None after a conflict."""
        while True:
            live = {b: f for b, f in base.folders.items() if int(b) not in set(touched)} | folders
            made = Manifest(base.version + 1, base.keys, base.count, base.schema, live, touched)
            if self._commit(made):
                return made
            base = self.manifest(base.version + 1)
            if set(base.touched) & set(touched):
                return None

    def merge(self, source: DataFrame, attempts: int = 5, **how) -> Manifest:
        """Upserts a source that is unique on the keys; see ``merge_upsert`` for policies."""
        m = self.manifest()
        rows = source.repartition(m.count, *m.keys)  # the source goes to the table's buckets, never the other way
        names = [f.name for f in StructType.fromJson(json.loads(m.schema))]
        return self.change(source, lambda old: merge_upsert(old, rows, m.keys, **how).select(*names), attempts)
