"""WARC archives with a capture index that is merged externally.

1. Payload digests (SHA-1) are taken of every page; of equal payloads of REVISIT_BYTES or more, the row with the largest
   page_id is the response and the others revisit it. Only (digest, id) is aggregated, payloads do not move for it.
2. Spark sorts each partition by URL key and timestamp (spilling where it must); a task writes the records as they come
   (gzip members, one a record) into archives of the shared folder, begins a new one beyond ARCHIVE_BYTES, and returns
   their index: one locally sorted capture run an archive. File names and contents depend on the partition alone and are
   put in place by a rename, so a task that runs again replaces its files by the same ones.
3. The runs are range-partitioned by (URL key, timestamp, row) into ranges of about MERGE_ROWS rows or less. What a task
   gets of a run is one or more sorted pieces, which a loser tree merges as they are. Partitions are in order, so the
   whole is a globally ordered capture history.
4. Reading: every archive is read as a stream in pieces of PIECE bytes, parsed member by member, and matched with the
   history by (archive, offset). Digests of responses are recomputed.

Null html is an empty payload, a null url is no target (key ''). Rows with equal page_ids are rows of their own; of
those, one is the response. A null page_id is a response only if no row with an id has the payload. Any 64-bit page_id
will do: the capture time is made from the id's remainder by SPAN seconds. An empty table gives no archive and no rows.
Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import as_binary, partitions, shared_dir, stored, table, with_order

REVISIT_BYTES = 1000
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes after which the next archive begins, bytes read at once, and index rows of one range of the merge.
ARCHIVE_BYTES, PIECE, MERGE_ROWS = 1 << 30, 1 << 15, 1 << 20
_EPOCH = datetime(2024, 1, 1, tzinfo=UTC)
#: Seconds over which capture times are spread.
SPAN = 10 * 365 * 86_400


class LoserTree:
    """Merge k sorted iterators; every inner node holds the loser of its match, so one path is replayed per item."""

    def __init__(self, runs: list[Iterator]):
        self.runs = [iter(r) for r in runs]
        self.k = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.tree = [-1] * max(1, self.k)  # 0: the winner
        for i in range(self.k):
            self._replay(i)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _replay(self, i: int) -> None:
        winner, node = i, (i + self.k) // 2
        while node:
            if self.tree[node] < 0:  # the first to come waits for its opponent
                self.tree[node] = winner
                return
            if self._beats(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self):
        while self.k and self.heads[self.tree[0]] is not None:
            w = self.tree[0]
            yield self.heads[w]
            self.heads[w] = next(self.runs[w], None)
            winner, node = w, (w + self.k) // 2
            while node:
                if self._beats(self.tree[node], winner):
                    self.tree[node], winner = winner, self.tree[node]
                node //= 2
            self.tree[0] = winner


def url_key(url: Column) -> Column:
    """Host parts in reverse, then path and query, in lower case: com,example)/a?b=1; '' without a url."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^\s+|\s+$", ""), "^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    place = F.substring_index(rest, "/", 1)
    path = F.substring(rest, F.char_length(place) + 1, F.char_length(rest))
    host = F.regexp_replace(F.lower(F.regexp_replace(place, "^.*@", "")), r"^www\d*\.", "")
    name = F.substring_index(host, ":", 1)
    port = F.substring(host, F.char_length(name) + 2, F.char_length(host))
    key = F.concat(F.array_join(F.reverse(F.split(name, r"\.")), ","), F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port)), F.lit(")"), F.lower(path))
    return F.when(F.coalesce(url, F.lit("")) == "", "").otherwise(key)


def _clean(value: str) -> str:
    return re.sub(r"[\r\n]+", "%0A", value)


def record(page_id, uid: int, url, captured: str, payload: bytes | None, size: int, digest: str, refers, refers_uid) -> bytes:
    """One WARC/1.1 record; payload None: a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if payload is None else http + payload
    head = [f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: <urn:x-row:{uid}>", f"WARC-Date: {captured}", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if payload is None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-row:{refers_uid}>"]
        if refers is not None:
            head.append(f"X-Refers-To-Page: {refers}")
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, HTTP head and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def members(source, piece: int = PIECE) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member of a stream. What a piece holds beyond a member is the start of the next,
    so the work is linear in the stream's length; one member is held at a time."""
    at = 0  # bytes of the stream before `data`
    data = source.read(piece)
    while data:
        start, parts, d = at, [], zlib.decompressobj(31)
        while True:
            parts.append(d.decompress(data))
            if d.eof:
                at += len(data) - len(d.unused_data)
                data = d.unused_data
                break
            at += len(data)
            data = source.read(piece)
            if not data:
                raise ValueError("the archive ends within a member")
        yield start, b"".join(parts)
        data = data or source.read(piece)


class _Archives:
    """The archives of one partition; an archive takes its name once it is whole."""

    def __init__(self, folder: str, partition: int, most: int):
        self.fs, self.base = pyarrow.fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.base, recursive=True)
        self.partition, self.most, self.number, self.out = partition, most, -1, None

    def add(self, member: bytes) -> tuple[str, int, int]:
        """(archive, position in it, offset) of the new member."""
        if self.out is None or self.at >= self.most:
            self.close()
            self.number, self.seq, self.at = self.number + 1, 0, 0
            self.name = f"part-{self.partition:06d}-{self.number:05d}.warc.gz"
            self.temp = f"{self.base}/.{self.name}-{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temp, compression=None)
        self.out.write(member)
        place = self.name, self.seq, self.at
        self.seq, self.at = self.seq + 1, self.at + len(member)
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temp, f"{self.base}/{self.name}")
            self.out = None


def _write(folder: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = None
        for batch in batches:
            archives = archives or _Archives(folder, TaskContext.get().partitionId(), most)
            *slim, html = batch.columns
            payloads, index = as_binary(html), []
            for k, (key, page_id, uid, url, captured, size, digest, refers, refers_uid) in enumerate(zip(*[c.to_pylist() for c in slim], strict=True)):
                stamp = (_EPOCH + timedelta(seconds=captured)).strftime("%Y-%m-%dT%H:%M:%SZ")
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                raw = record(page_id, uid, url, stamp, payloads[k].as_py() if refers_uid is None else None, size, digest, refers, refers_uid)
                member = pack.compress(raw) + pack.flush()
                name, seq, at = archives.add(member)
                index.append((name, seq, key, captured, uid, at, len(member)))
            if index:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*index, strict=True)], names=["archive", "seq", "url_key", "captured", "uid", "offset", "length"])
        if archives:
            archives.close()

    return run


def sorted_pieces(rows: pa.Table) -> list[tuple[int, int]]:
    """Row ranges that are in order as they stand: rows of one archive with rising places."""
    if not rows.num_rows:
        return []
    archive, seq = rows.column("archive").combine_chunks().dictionary_encode(), rows.column("seq").to_numpy()
    code = (archive.chunk(0) if isinstance(archive, pa.ChunkedArray) else archive).indices.to_numpy()
    cuts = np.flatnonzero((code[1:] != code[:-1]) | (seq[1:] <= seq[:-1])) + 1
    return list(itertools.pairwise([0, *cuts.tolist(), rows.num_rows]))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the index: rows in sorted pieces -> rows in one order. Rows stay in Arrow; keys are made as they come."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    key, captured, uid = (rows.column(c) for c in ("url_key", "captured", "uid"))

    def piece(a: int, b: int) -> Iterator[tuple]:
        for s in range(a, b, 1024):
            n = min(1024, b - s)
            yield from zip(*[c.slice(s, n).to_pylist() for c in (key, captured, uid)], range(s, s + n), strict=True)

    part, position = TaskContext.get().partitionId(), 0
    tree = iter(LoserTree([piece(a, b) for a, b in sorted_pieces(rows)]))
    columns = ["url_key", "captured", "uid", "archive", "offset", "length"]
    while order := [x[3] for x in itertools.islice(tree, 10_000)]:
        some = rows.select(columns).take(pa.array(order)).combine_chunks()
        n = len(order)
        arrays = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(position, position + n)), *[c.chunk(0) for c in some.columns]]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "position", *columns])
        position += n


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["archive", "offset", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        for path in batch.column(0).to_pylist():
            fs, file = pyarrow.fs.FileSystem.from_uri(path)
            rows = []
            with fs.open_input_stream(file, compression=None) as source:
                for offset, raw in members(source):
                    fields, http, payload = parse(raw)
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{path}: the payload at {offset} is damaged")
                    as_id = lambda name, f=fields: int(f[name]) if name in f else None
                    rows.append((os.path.basename(file), offset, as_id("X-Page-Id"), size, digest, kind, as_id("X-Refers-To-Page")))
                    if len(rows) >= 5000:
                        yield batch_of(rows)
                        rows = []
            if rows:
                yield batch_of(rows)


def write_archives(pages: DataFrame, folder: str | None = None, least: int = REVISIT_BYTES, most: int = ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """Write pages (page_id, url, html) as archives; returns their folder and the index, a sorted run for each archive."""
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/strandline/warc-{uuid.uuid4().hex}"
    base = with_order(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")), "page_id")
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    slim = stored(base.select("uid", "page_id", F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("size")), "payloads")
    best = slim.filter(F.col("size") >= least).groupBy("digest", "size").agg(F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "uid", "page_id")).alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = slim.join(best.select("digest", "size", F.col("top.uid").alias("top_uid"), F.col("top.page_id").alias("top_id")), ["digest", "size"]).filter("uid != top_uid")
    revisits = again.select("uid", F.col("top_id").alias("refers"), F.col("top_uid").alias("refers_uid"))
    facts = slim.join(revisits, "uid", "left").select("uid", "digest", "size", "refers", "refers_uid")
    captured = F.pmod(F.coalesce("page_id", F.lit(0).cast("long")), F.lit(SPAN).cast("long"))
    # a revisit's payload stays where it is
    rows = base.join(facts, "uid").select(url_key(F.col("url")).alias("url_key"), "page_id", "uid", "url", captured.alias("captured"), "size", "digest", "refers", "refers_uid", F.when(F.col("refers_uid").isNull(), F.col("html")).alias("html"))
    placed = rows.repartition(partitions(spark), "uid").sortWithinPartitions("url_key", "captured", "uid")
    index = stored(placed.mapInArrow(_write(folder, most), "archive string, seq long, url_key string, captured long, uid long, offset long, length long"), "runs")
    return folder, index


def merge_index(index: DataFrame) -> DataFrame:
    """The globally ordered history: bucket and position give the order by (url_key, captured, uid)."""
    n = max(partitions(index.sparkSession), -(-index.count() // MERGE_ROWS))
    return index.repartitionByRange(n, "url_key", "captured", "uid").mapInArrow(_merge, "bucket int, position long, url_key string, captured long, uid long, archive string, offset long, length long")


def read_archives(spark, folder: str) -> DataFrame:
    """One row per record of all archives of the folder. Only names go through Spark's listing; tasks stream the bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path")
    return files.repartition(partitions(spark), "path").mapInArrow(_read, "archive string, offset long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def captures(spark, folder: str, history: DataFrame) -> DataFrame:
    """The records that the history points to, with their place in it. Both sides grow with the pages, so neither is sent
    to all executors."""
    return read_archives(spark, folder).join(history.hint("merge"), ["archive", "offset"])


def op5_warc(spark, sf_dir: str) -> DataFrame:
    folder, index = write_archives(table(spark, sf_dir, "pages"))
    if not index.take(1):
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return captures(spark, folder, merge_index(index)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = r"""
with p as (select page_id, coalesce(html, '') as html from pages), b as (select html, max(page_id) as best from p where strlen(html) >= 1000 group by html)
select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as payload_digest, case when best is null or best = page_id then 'response' else 'revisit' end as record_type,
  case when best <> page_id then best end as refers_to from p left join b using (html)
"""
