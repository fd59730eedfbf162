"""Tables made of parts that a small manifest names, so that a writer touches only some of them."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faultlens.session import materialise


class Manifest:
    """Numbered versions of a JSON document in a shared folder; the newest one is in force.

    A version appears whole, by a rename, and never replaces one: of two writers
    that started from the same version the second fails.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _open(self, name: str):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        return path.getFileSystem(self._conf), path

    def read(self) -> tuple[int, dict]:
        fs, folder = self._open("_manifest")
        if not fs.exists(folder):
            return 0, {}
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        newest = max((int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)
        if not newest:
            return 0, {}
        stream = fs.open(self._open(f"_manifest/{newest}.json")[1])
        try:
            return newest, json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, version: int, content: dict) -> None:
        fs, draft = self._open(f"_manifest/.{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(json.dumps(content).encode())
        stream.close()
        _, path = self._open(f"_manifest/{version}.json")
        if fs.exists(path) or not fs.rename(draft, path):
            fs.delete(draft, False)
            raise RuntimeError(f"version {version} of {self.base} was written by someone else")

    def drop(self, name: str) -> None:
        fs, path = self._open(name)
        fs.delete(path, True)


class KeyedTable:
    """One row per key, in buckets by the hash of the key; an upsert rewrites only the buckets it touches.

    The number of buckets is fixed by the first write.  ``version`` columns say which row of
    a key is newest; of equal ones the row written later wins.  Readers see
    a version whole; parts no manifest in force names are left until ``vacuum``.
    """

    def __init__(self, spark: SparkSession, base: str, keys: tuple = ("incident_id",), version: tuple = ("updated_at",), buckets: int = 64):
        self.spark, self.keys, self.version, self.buckets = spark, list(keys), list(version), buckets
        self.manifest = Manifest(spark, base)
        self.base = self.manifest.base

    def upsert(self, updates: DataFrame) -> int:
        """Write the updates; returns the number of buckets rewritten."""
        n, state = self.manifest.read()
        parts, buckets = state.get("parts", {}), state.get("buckets", self.buckets)
        schema = StructType.fromJson(state["schema"]) if parts else updates.schema
        added = [f for f in updates.schema.fields if f.name not in schema.fieldNames()]
        schema = StructType([*schema.fields, *added])
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")
        rows = materialise(self._newest(updates.withColumn("_age", F.lit(1))).withColumn("_bucket", bucket), "updates")
        touched = sorted(r[0] for r in rows.select("_bucket").distinct().collect())  # no more than there are buckets
        if not touched:
            return 0
        old = [parts[str(b)] for b in touched if str(b) in parts]
        if old:
            before = self._read(old, schema).withColumn("_age", F.lit(0)).withColumn("_bucket", bucket)
            rows = self._newest(rows.unionByName(before, allowMissingColumns=True))
        part = f"data/{n + 1}-{uuid.uuid4().hex}"
        rows.select(*schema.names, "_bucket").repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.base}/{part}")
        parts = parts | {str(b): f"{part}/_bucket={b}" for b in touched}
        self.manifest.commit(n + 1, {"buckets": buckets, "parts": parts, "schema": schema.jsonValue()})
        return len(touched)

    def _newest(self, rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(*rows.columns), F.struct(*self.version, "_age"))
        return rows.groupBy(*self.keys).agg(newest.alias("_row")).select("_row.*")

    def _read(self, parts: list[str], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/{p}" for p in parts])

    def rows(self) -> DataFrame:
        """The table as of now; a table without a write has no columns to show."""
        _, state = self.manifest.read()
        if not state:
            raise FileNotFoundError(f"nothing was written to {self.base}")
        return self._read(sorted(state["parts"].values()), StructType.fromJson(state["schema"]))

    def vacuum(self) -> int:
        """Remove parts that the version in force does not name; no reader may be on an older one."""
        _, state = self.manifest.read()
        live = set(state.get("parts", {}).values())
        fs, folder = self.manifest._open("data")
        gone = [f"data/{w.getPath().getName()}/{b.getPath().getName()}" for w in fs.listStatus(folder) if w.isDirectory()
                for b in fs.listStatus(w.getPath()) if b.isDirectory()]
        gone = [p for p in gone if p not in live]
        for p in gone:
            self.manifest.drop(p)
        return len(gone)


class MergedTable:
    """Batches whose rows can be merged, in levels: ``fan`` parts of one level become one of the next.

    ``merge`` makes one frame of several, in any order and grouping.  A batch is written
    once for each level it rises through, and a read opens fewer than ``fan`` parts a
    level, however many batches there were.  A batch that comes again is not added twice.
    """

    def __init__(self, spark: SparkSession, base: str, merge, fan: int = 8):
        self.spark, self.merge, self.fan = spark, merge, fan
        self.manifest = Manifest(spark, base)
        self.base = self.manifest.base

    def add(self, rows: DataFrame, batch_id: int) -> None:
        n, state = self.manifest.read()
        if batch_id <= state.get("last", -1):
            return
        levels = state.get("levels", [])
        part = f"data/0-{batch_id}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.base}/{part}")
        levels, old, level = [list(x) for x in levels], [], 0
        while True:
            if level == len(levels):
                levels.append([])
            levels[level].append(part)
            if len(levels[level]) < self.fan:
                break
            full, levels[level] = levels[level], []
            level += 1
            part = f"data/{level}-{batch_id}-{uuid.uuid4().hex}"
            self.merge(self._read(full, rows.schema)).write.parquet(f"{self.base}/{part}")
            old += full
        self.manifest.commit(n + 1, {"last": batch_id, "levels": levels, "schema": rows.schema.jsonValue()})
        for p in old:  # an earlier version may still be read elsewhere; there is one writer and it reads through ``rows``
            self.manifest.drop(p)

    def _read(self, parts: list[str], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/{p}" for p in parts])

    def parts(self) -> list[str]:
        return [p for level in self.manifest.read()[1].get("levels", []) for p in level]

    def rows(self) -> DataFrame:
        """All batches, merged within parts but not across them."""
        _, state = self.manifest.read()
        if not state:
            raise FileNotFoundError(f"nothing was written to {self.base}")
        return self._read(self.parts(), StructType.fromJson(state["schema"]))
