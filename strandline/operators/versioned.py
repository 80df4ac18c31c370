"""A ledger of keyed rows as a log: a commit writes a delta and a small manifest, whatever the size of the ledger.

    <path>/data/<id>/          the rows of one commit, or a compacted base
    <path>/manifest/v<n>.json  version n: its base, the deltas since, and the last batch of each stream

A version exists from the moment its manifest is renamed into place; the rename fails if another writer was first, and
the commit is tried again on top of that. What an interrupted commit leaves is in no manifest. Rows of later deltas
replace those of earlier ones with the same key: a read merges the deltas, which are small, and takes the base as it is but
for their keys. After COMPACT deltas a new base is written. Old versions can be read until `vacuum` removes them.
"""

from __future__ import annotations

import functools
import json
import operator
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.operators.ledger import write_verified

#: Deltas that a version may have before its rows are written as a new base.
COMPACT = 16


class Conflict(RuntimeError):
    """Another writer has published this version."""


class Ledger:
    """Rows of `schema` with unique `key`s at `path`. All of the state is on disk: any process may open it."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: list[str], compact: int = COMPACT):
        self.spark, self.path, self.key, self.compact_after = spark, path.rstrip("/"), list(key), compact
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self._of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._of(self.path).getFileSystem(self._conf)

    # --- manifests

    def versions(self) -> list[int]:
        folder = self._of(f"{self.path}/manifest")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, the newest by default; version 0 is the empty ledger before the first commit."""
        found = self.versions()
        version = (found[-1] if found else 0) if version is None else version
        if version == 0:
            return {"version": 0, "base": None, "deltas": [], "batches": {}, "properties": {}}
        if version not in found:
            raise ValueError(f"there is no version {version}")
        stream = self._fs.open(self._of(f"{self.path}/manifest/v{version:012d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        name = f"{self.path}/manifest/v{manifest['version']:012d}.json"
        temp = f"{self.path}/manifest/.{uuid.uuid4().hex}"
        out = self._fs.create(self._of(temp), False)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._of(name).toUri(), self._conf)
        try:
            context.rename(self._of(temp), self._of(name), gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as error:
            self._fs.delete(self._of(temp), False)
            if self._fs.exists(self._of(name)):
                raise Conflict(name) from error
            raise

    # --- commits

    def commit(self, rows: DataFrame, stream: str = "default", batch: int | None = None, properties: dict | None = None) -> int:
        """Rows replace those with their keys; returns the version. A batch number of a stream that is not above the last
        one is not applied again. Keys that occur twice in `rows` are refused."""
        delta = None
        while True:
            head = self.manifest()
            if batch is not None and head["batches"].get(stream, -1) >= batch:
                return head["version"]
            if delta is None:
                delta = self._write(rows)
            batches = head["batches"] | ({stream: batch} if batch is not None else {})
            deltas = head["deltas"] + ([delta] if delta["rows"] else [])
            try:
                self._publish(head | {"version": head["version"] + 1, "deltas": deltas, "batches": batches, "properties": head["properties"] | (properties or {})})
            except Conflict:
                continue
            if len(deltas) > self.compact_after:
                self.compact()
            return head["version"] + 1

    def _write(self, rows: DataFrame) -> dict:
        name = uuid.uuid4().hex
        back = write_verified(rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema]), f"{self.path}/data/{name}")
        count = back.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
        if (count["most"] or 0) > 1:
            self._fs.delete(self._of(f"{self.path}/data/{name}"), True)
            raise ValueError("a key occurs twice in one commit")
        if not count["rows"]:
            self._fs.delete(self._of(f"{self.path}/data/{name}"), True)
        return {"id": name, "rows": count["rows"] or 0}

    def compact(self) -> int:
        """Write the newest version's rows as one base; a writer who comes in between wins, and nothing is lost."""
        head = self.manifest()
        name = uuid.uuid4().hex
        write_verified(self.read(head["version"]), f"{self.path}/data/{name}")
        try:
            self._publish(head | {"version": head["version"] + 1, "base": name, "deltas": []})
        except Conflict:
            self._fs.delete(self._of(f"{self.path}/data/{name}"), True)
        return self.manifest()["version"]

    # --- reads

    def _data(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{name}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default."""
        head = self.manifest(version)
        base = self._data(head["base"]) if head["base"] else self.spark.createDataFrame([], self.schema)
        if not head["deltas"]:
            return base
        parts = [self._data(d["id"]).withColumn("__d", F.lit(k)) for k, d in enumerate(head["deltas"])]
        row = F.struct(*[F.col(f"`{f.name}`") for f in self.schema])
        every = functools.reduce(DataFrame.unionByName, parts)
        newest = every.groupBy(*self.key).agg(F.max_by(row, "__d").alias("__row")).select("__row.*") if len(parts) > 1 else every.drop("__d")
        if not head["base"]:
            return newest
        keys = newest.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.key)])
        same = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(self.key)])
        return base.join(keys, same, "left_anti").unionByName(newest)

    def changes(self, before: int, after: int, value: Column) -> DataFrame:
        """Keys that differ between two versions: added, changed or missing."""
        one = lambda version, side: self.read(version).select(*self.key, F.lit(side).alias("__side"), F.struct(value.alias("v")).alias("__v"))
        of = lambda side: F.first(F.when(F.col("__side") == side, F.col("__v")), True).alias(side)
        both = one(before, "old").unionByName(one(after, "new")).groupBy(*self.key).agg(of("old"), of("new"))
        verdict = F.when(F.col("new").isNull(), "missing").when(F.col("old").isNull(), "added").when(~F.col("old.v").eqNullSafe(F.col("new.v")), "changed")
        return both.select(*self.key, verdict.alias("verdict")).filter("verdict is not null")

    def vacuum(self, keep: int = 10, grace: float = 3600.0) -> int:
        """Remove all but the last `keep` versions, and data in none of these that is older than `grace` seconds (a commit
        may be under way). Returns how many folders went."""
        found = self.versions()
        for version in found[:-keep] if keep else found:
            self._fs.delete(self._of(f"{self.path}/manifest/v{version:012d}.json"), False)
        held = set()
        for version in found[-keep:] if keep else []:
            m = self.manifest(version)
            held |= {m["base"], *(d["id"] for d in m["deltas"])}
        gone = 0
        folder = self._of(f"{self.path}/data")
        for status in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
            if status.getPath().getName() not in held and time.time() - status.getModificationTime() / 1000 >= grace:
                self._fs.delete(status.getPath(), True)
                gone += 1
        return gone
