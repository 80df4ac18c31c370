"""Files of packed 12-bit samples as a data source, with a reader that splits files and a writer that publishes whole sets.

Two samples take three bytes: the high eight bits of each, then a byte with both low nibbles, the first sample's below. A set
is a folder of such files with a manifest, `_manifest.json`, that names each file with its number of samples and SHA-256;
only files of the manifest are read. Every task writes a file of its own into a staging folder. `commit` removes what the
tasks of the set did not report (attempts that were killed), moves the staging folder into place with one rename and
replaces the manifest with another; `abort` removes the staging folder. A reader sees the old set or the new one. A task
that is still running when its job is aborted may leave a staging folder, which no manifest names; `swept` removes old ones.

Folders must be reachable from all executors, by any store that pyarrow opens. `register(spark)` makes the format known:

    df.select("value").write.format("packed12").mode("append").save(path)
    spark.read.format("packed12").load(path)        # file, at, value
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Samples that one task reads, an even number.
RANGE = 1 << 22
_MANIFEST = "_manifest.json"


def pack(values: np.ndarray) -> bytes:
    """Samples of 12 bits, an even number of them, as bytes."""
    pairs = values.astype(np.uint16).reshape(-1, 2)
    low = (pairs[:, 1] & 15) << 4 | pairs[:, 0] & 15
    return np.stack([pairs[:, 0] >> 4, pairs[:, 1] >> 4, low], axis=1).astype(np.uint8).tobytes()


def unpack(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)[: len(data) // 3 * 3].reshape(-1, 3).astype(np.uint16)
    return np.stack([b[:, 0] << 4 | b[:, 2] & 15, b[:, 1] << 4 | b[:, 2] >> 4], axis=1).ravel()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _manifest(store: fs.FileSystem, root: str) -> list[dict]:
    if store.get_file_info(f"{root}/{_MANIFEST}").type == fs.FileType.NotFound:
        return []
    with store.open_input_stream(f"{root}/{_MANIFEST}") as f:
        return json.loads(f.readall())["files"]


@dataclass
class _Range(InputPartition):
    name: str
    first: int
    last: int

    def __init__(self, name: str, first: int, last: int):
        super().__init__((name, first, last))
        self.name, self.first, self.last = name, first, last


class _Reader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[_Range]:
        store, root = _store(self.path)
        return [_Range(f["name"], k, min(k + self.size, f["samples"])) for f in _manifest(store, root) for k in range(0, f["samples"], self.size)] or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        store, root = _store(self.path)
        with store.open_input_file(f"{root}/{partition.name}") as f:
            for k in range(partition.first, partition.last, 1 << 17):
                n = min(1 << 17, partition.last - k)
                f.seek(k // 2 * 3)
                values = unpack(f.read((n + 1) // 2 * 3))[:n]
                if len(values) != n:
                    raise ValueError(f"{partition.name} is shorter than its manifest says")
                name = pa.array([partition.name]).take(pa.array(np.zeros(n, np.int64)))
                yield pa.RecordBatch.from_arrays([name, pa.array(np.arange(k, k + n)), pa.array(values.astype(np.int32))], names=["file", "at", "value"])


@dataclass
class _Written(WriterCommitMessage):
    name: str
    samples: int
    sha256: str


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.id = path, overwrite, uuid.uuid4().hex

    def _places(self) -> tuple[fs.FileSystem, str, str]:
        store, root = _store(self.path)
        return store, root, f"{root}/.staging-{self.id}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        store, _, staging = self._places()
        store.create_dir(staging, recursive=True)
        name, digest, total, rest = f"{uuid.uuid4().hex}.p12", hashlib.sha256(), 0, np.zeros(0, np.int64)
        try:
            with store.open_output_stream(f"{staging}/{name}") as f:

                def put(values: np.ndarray) -> None:
                    data = pack(values)
                    digest.update(data)
                    f.write(data)

                for batch in iterator:
                    if batch.column("value").null_count:
                        raise ValueError("a sample is null")
                    values = np.concatenate([rest, batch.column("value").to_numpy().astype(np.int64)])
                    if len(values) and (values.min() < 0 or values.max() > 4095):
                        raise ValueError("a sample has more than 12 bits")
                    even = len(values) // 2 * 2
                    total += even
                    put(values[:even])
                    rest = values[even:]
                if len(rest):
                    total += 1
                    put(np.append(rest, 0))
        except BaseException:  # an attempt that fails takes its file along, also where the abort came before it
            with contextlib.suppress(OSError):
                store.delete_file(f"{staging}/{name}")
            raise
        return _Written(name, total, digest.hexdigest())

    def commit(self, messages: list[_Written | None]) -> None:
        store, root, staging = self._places()
        done = {m.name: m for m in messages if m is not None and m.samples}
        store.create_dir(staging, recursive=True)
        for info in store.get_file_info(fs.FileSelector(staging)):
            if info.base_name not in done:
                store.delete_file(info.path)
        old = _manifest(store, root)
        store.move(staging, f"{root}/set-{self.id}")
        files = [] if self.overwrite else list(old)
        files += [{"name": f"set-{self.id}/{m.name}", "samples": m.samples, "sha256": m.sha256} for m in sorted(done.values(), key=lambda m: m.name)]
        temp = f"{root}/.{_MANIFEST}-{self.id}"
        with store.open_output_stream(temp) as f:
            f.write(json.dumps({"files": files}).encode())
        store.move(temp, f"{root}/{_MANIFEST}")
        if self.overwrite:
            for folder in {f["name"].split("/")[0] for f in old}:
                store.delete_dir(f"{root}/{folder}")

    def abort(self, messages: list[_Written | None]) -> None:
        store, _, staging = self._places()
        if store.get_file_info(staging).type == fs.FileType.Directory:
            store.delete_dir(staging)


class Packed12(DataSource):
    """Options: path; `range`, the samples that one task reads."""

    @classmethod
    def name(cls) -> str:
        return "packed12"

    def schema(self) -> str:
        return "file string, at long, value int"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("range", RANGE)) // 2 * 2)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Packed12)


def verify(spark: SparkSession, path: str):
    """(file, samples, good): every file of the manifest against its SHA-256, one task a file."""
    store, root = _store(path)
    rows = [(f["name"], f["samples"], f["sha256"]) for f in _manifest(store, root)]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = _store(path)
        for batch in batches:
            good = []
            for name, want in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                digest = hashlib.sha256()
                with own.open_input_stream(f"{at}/{name}") as f:
                    while data := f.read(1 << 20):
                        digest.update(data)
                good.append(digest.hexdigest() == want)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(good)], names=["file", "samples", "good"])

    files = spark.createDataFrame(rows, "file string, samples long, sha256 string")
    return files.repartition(max(1, len(rows))).mapInArrow(check, "file string, samples long, good boolean")


def swept(path: str, older: float = 86_400.0) -> int:
    """Remove staging folders that nothing has written to for `older` seconds; returns how many."""
    store, root = _store(path)
    gone = 0
    for info in store.get_file_info(fs.FileSelector(root)):
        if info.base_name.startswith(".staging-") and info.type == fs.FileType.Directory and time.time() - info.mtime.timestamp() >= older:
            store.delete_dir(info.path)
            gone += 1
    return gone
