"""Near-duplicate groups by SimHash with a bit-sliced comparison.

1. Fingerprint: A-Z are lower-cased, words are `[^\\x20\\x09-\\x0D]+`, shingles are SHINGLE words in a row with repeats
   (fewer words: the whole sequence). A bit is set if more than half of the shingles' XXH64 (seed 42) have it. No word:
   fingerprint zero, which links like any other.
2. Equal fingerprints are one class from here on.
3. Two fingerprints within RADIUS bits are equal in at least b - RADIUS of b bit blocks, so every choice of b - RADIUS
   blocks is one table of buckets. b grows with the number of classes, the bucket size stays.
4. A bucket is cut into tiles, and every pair of tiles is one cell, so no task holds more than two tiles. In a cell,
   the lanes' bits stand vertically (bit plane k holds bit k of 64 lanes a word); carry-save counters add the planes'
   differences for all lanes at once; a query row is abandoned once all its lanes exceed the radius.
5. A cell returns a spanning forest of its links (no link between classes is lost for components), and components are
   found by alternating star steps.

Nulls and empty texts have fingerprint zero; rows with equal ids are rows of their own.

`similar_groups` groups by the similarity of the sets of SIMILAR_SHINGLE words instead:
1. Equal sets are one class (128 bits of hash). Only a sketch of each text is kept: its class, its band keys, and its
   fingerprint of PRINT_WORDS words, made as above but of distinct shingles.
2. Sets at SIMILARITY differ in 15 % of the bits, so no block of bits must be equal and no choice of blocks finds them all.
   The buckets are MIN_BANDS bands of MIN_ROWS minimum hashes instead, which a pair at SIMILARITY shares with a chance of
   0.9993, whatever the length of the texts and the number of documents.
3. The fingerprints of a bucket are compared as above, in cells of at most two tiles, by bit planes and carry-save counters,
   and abandoned beyond NEAR_RADIUS. Many small cells are one block of lanes. Only classes with another one of their
   bucket within the radius are candidates; of pairs at SIMILARITY, fewer than 1 in 100,000 are farther apart.
4. `set_links.verified` compares the full sets of candidates, so that no fingerprint alone decides: whole components of
   candidates that are small, and what shares a bucket of larger ones.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import as_binary, byte_view, partitions, stored, table, texts, with_order
from strandline.llm.components import components
from strandline.llm.set_links import SET_TILE, min_keys, remix, shingle_hashes, sketches, verified

SHINGLE, RADIUS = 3, 3
#: Fingerprints a bucket should hold, and the most of one tile.
BUCKET, TILE = 512, 2048
#: For similar_groups: shingle size, similarity, bands of minimum hashes and their rows.
SIMILAR_SHINGLE, SIMILARITY, MIN_BANDS, MIN_ROWS = 5, 0.8, 24, 6
#: For similar_groups: words of a fingerprint, the bits in which candidates may differ (sets of 4 and 5 shingles at the
#: similarity differ in 48 of 256 on average, larger ones in 40), and rows of small cells that are compared at once.
PRINT_WORDS, NEAR_RADIUS, BLOCK = 4, 76, 256

_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _count_bits(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set in each group of hashes."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int32)


def fingerprints(texts: list[bytes], size: int = SHINGLE, words: int = 1) -> np.ndarray:
    """A row of 64-bit words for each text."""
    counts, total = np.zeros((len(texts), 64 * words), np.int64), np.zeros(len(texts), np.int64)
    held: list[list[int]] = []
    of: list[int] = []

    def flush():
        if held:
            starts = np.cumsum([0] + [len(x) for x in held[:-1]])
            hashes, rows = np.array([y for x in held for y in x], np.uint64), np.array(of)
            for k in range(words):
                np.add.at(counts, (rows[:, None], np.arange(64 * k, 64 * k + 64)[None, :]), _count_bits(remix(hashes, k), starts))
            held.clear()
            of.clear()

    waiting = 0
    for i, text in enumerate(texts):
        for some in shingle_hashes(text, size):
            held.append(some)
            of.append(i)
            total[i] += len(some)
            waiting += len(some)
            if waiting >= 1 << 16:
                flush()
                waiting = 0
    flush()
    bits = (2 * counts > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _fingerprint_batches(size: int, words: int = 0):
    """words 0: one word as a bigint; otherwise that many as binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, values in texts(batch.column(batch.num_columns - 1), 1 << 20):
                part, fp = batch.slice(i, j - i), fingerprints(values, size, words or 1)
                col = pa.array([r.tobytes() for r in fp], pa.binary()) if words else pa.array(fp.ravel().view(np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], col], names=[*part.schema.names[:-1], "fp"])

    return run


def block_scheme(n: int, radius: int, bucket: int = BUCKET) -> list[list[tuple[int, int]]]:
    """The tables for n fingerprints: for each, the (first bit, width) of the pieces that make its key."""
    need = max(0, math.ceil(math.log2(max(1, n) / bucket)))
    for b in range(radius + 1, 65):
        edges = [64 * k // b for k in range(b + 1)]
        blocks = [(edges[k], edges[k + 1] - edges[k]) for k in range(b)]
        keep = b - radius
        if sum(sorted(w for _, w in blocks)[:keep]) >= need:
            break
    tables = []
    for chosen in itertools.combinations(blocks, keep):
        left, pieces = need, []
        for at, width in chosen:
            pieces.append((at, min(width, left)))
            left -= pieces[-1][1]
        tables.append([p for p in pieces if p[1]])
    return tables


def _planes(fp: np.ndarray) -> np.ndarray:
    """Bit plane k, lane i: bit k of row i; 64 lanes a word."""
    lanes = -(-len(fp) // 64) * 64
    bits = np.zeros((lanes, 64 * fp.shape[1]), np.uint8)
    bits[: len(fp)] = np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(len(fp), -1), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int, same: bool, rows: int = 256) -> Iterator[tuple[int, np.ndarray]]:
    """(row of left, rows of right within the radius); `same`: left is right, and only later rows are returned.

    Counters begin at 2**c - 1 - radius, so that a lane overflows as soon as its distance exceeds the radius."""
    planes, counters = _planes(right), max(1, int(radius).bit_length())
    begin = (1 << counters) - 1 - radius
    spare = np.zeros(planes.shape[1] * 64, np.uint8)
    spare[len(right) :] = 1
    blank = np.packbits(spare, bitorder="little").view(np.uint64)
    for at in range(0, len(left), rows):
        q = left[at : at + rows]
        index = np.arange(at, at + len(q))
        over = np.repeat(blank[None, :], len(q), axis=0)
        if same:
            done = np.arange(planes.shape[1] * 64)[None, :] <= index[:, None]
            over |= np.packbits(done, axis=1, bitorder="little").view(np.uint64)
        count = [np.full_like(over, _FULL if begin >> c & 1 else 0) for c in range(counters)]
        for k in range(len(planes)):
            carry = planes[k][None, :] ^ (np.uint64(0) - ((q[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)))[:, None]
            for c in range(counters):
                spill = count[c] & carry
                count[c] ^= carry
                carry = spill
            over |= carry
            if k % 8 == 7 and k >= 2 * radius:
                alive = (over != _FULL).any(axis=1)
                if not alive.any():
                    index = index[:0]
                    break
                if alive.mean() < 0.75:
                    q, index, over, count = q[alive], index[alive], over[alive], [x[alive] for x in count]
        if not len(index):
            continue
        hit = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")
        for r in np.flatnonzero(hit.any(axis=1)):
            yield int(index[r]), np.flatnonzero(hit[r])


def _forest(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> tuple[list[int], list[int]]:
    """A spanning forest of the links of one cell: rows of left and of right."""
    label = np.arange(len(left)) if same else np.arange(len(left) + len(right))
    shift = 0 if same else len(left)
    u: list[int] = []
    v: list[int] = []
    for i, hits in close_pairs(left, right, radius, same):
        own = label[i]
        labels, first = np.unique(label[hits + shift], return_index=True)
        new = labels != own
        if new.any():
            for k in hits[first[new]]:
                u.append(i)
                v.append(int(k))
            label[np.isin(label, labels[new])] = own
    return u, v


def _compare_cells(radius: int):
    """Rows (bucket, a, b, tile, fp) sorted by cell; a cell can go over several batches."""

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        cell = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(4)], axis=1)
        return cell, batch.column(4).to_numpy().view(np.uint64).reshape(-1, 1)

    def solve(cell: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = cell[0, 1], cell[0, 2]
        if a == b:
            u, v = _forest(fp, fp, radius, True)
            return fp[u], fp[v]
        left, right = fp[cell[:, 3] == a], fp[cell[:, 3] == b]
        u, v = _forest(left, right, radius, False)
        return left[u], right[v]

    def column(rows: list[np.ndarray]) -> pa.Array:
        all_rows = np.ascontiguousarray(np.concatenate(rows))
        return pa.array(all_rows.ravel().view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, np.ndarray] | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            if batch is None:
                if rest is None:
                    return
                cell, fp = rest
            else:
                cell, fp = read(batch)
                if rest is not None:
                    cell, fp = np.concatenate([rest[0], cell]), np.concatenate([rest[1], fp])
            new = np.append(True, (cell[1:, :3] != cell[:-1, :3]).any(axis=1))
            cut = np.append(np.flatnonzero(new), len(cell))
            rest = None if batch is None else (cell[cut[-2] :], fp[cut[-2] :])
            us, vs = [], []
            for s, e in itertools.pairwise(cut if batch is None else cut[:-1]):
                if e - s > 1:
                    u, v = solve(cell[s:e], fp[s:e])
                    if len(u):
                        us.append(u)
                        vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays([column(us), column(vs)], names=["u", "v"])

    return run


def _compared(rows: DataFrame, radius: int, tile: int) -> DataFrame:
    """Links of rows (bucket, fp) that share a bucket."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    cells = (
        rows.join(sizes, "bucket").withColumn("tile", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("bucket", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "fp")
    )
    return (
        cells.repartition(partitions(rows.sparkSession), "bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")
        .mapInArrow(_compare_cells(radius), "u long, v long").distinct()
    )


def links(classes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET, tile: int = TILE) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints `fp` that a chain of links within the radius connects."""
    tables = block_scheme(classes.count(), radius, bucket)
    keys = []
    for t, pieces in enumerate(tables):
        key = F.lit(0).cast("long")
        for at, width in pieces:
            key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned("fp", at).bitwiseAND((1 << width) - 1))
        keys.append(F.struct(F.lit(t).alias("t"), key.alias("key")))
    rows = classes.select("fp", F.explode(F.array(*keys)).alias("k")).select(F.xxhash64("k.t", "k.key").alias("bucket"), "fp")
    return _compared(rows, radius, tile)


def _min_bands(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The band keys of each set of hashes, a column a band; sets are not empty."""
    return min_keys(flat, starts, MIN_BANDS, MIN_ROWS)


def _set_prints(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The fingerprint of each set of hashes, PRINT_WORDS words a row; sets are not empty."""
    total = np.diff(np.append(starts, len(flat)))[:, None]
    words = [np.packbits(2 * _count_bits(remix(flat, k), starts) > total, axis=1, bitorder="little").view(np.uint64) for k in range(PRINT_WORDS)]
    return np.concatenate(words, axis=1)


def _near_cells(radius: int):
    """Rows (bucket, a, b, tile, c, fp) sorted by cell, its first three -> (bucket, c) of all classes that have another one of
    their cell within the radius; a cell can go over several batches, and small cells are compared many at once."""

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        rows = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(5)], axis=1)
        return rows, np.ascontiguousarray(byte_view(as_binary(batch.column(5)))[0]).view(np.uint64).reshape(len(rows), -1)

    def solve(rows: np.ndarray, fp: np.ndarray, cell: np.ndarray) -> pa.RecordBatch:
        """One cell, or several of one tile each; `cell` numbers them."""
        near = np.zeros(len(rows), bool)
        if rows[0, 1] != rows[0, 2]:
            left, right = np.flatnonzero(rows[:, 3] == rows[:, 1]), np.flatnonzero(rows[:, 3] == rows[:, 2])
            found = ((left[i], right[hits]) for i, hits in close_pairs(fp[left], fp[right], radius, False)) if len(left) and len(right) else ()
        else:
            found = close_pairs(fp, fp, radius, True)
        for i, hits in found:
            hits = hits[cell[hits] == cell[i]]
            near[hits] = True
            near[i] |= len(hits) > 0
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[near, k])) for k in (0, 4)], names=["bucket", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, np.ndarray] | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None and not batch.num_rows or batch is None and rest is None:
                continue
            rows, fp = rest if batch is None else read(batch)
            if batch is not None and rest is not None:
                rows, fp = np.concatenate([rest[0], rows]), np.concatenate([rest[1], fp])
            new = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1))
            cut, cell = np.append(np.flatnonzero(new), len(rows)), np.cumsum(new)
            rest, most = (None, len(cut) - 1) if batch is None else ((rows[cut[-2] :], fp[cut[-2] :]), len(cut) - 2)
            k = 0
            while k < most:
                e = k + 1
                if rows[cut[k], 1] == rows[cut[k], 2]:
                    while e < most and cut[e + 1] - cut[k] <= BLOCK and rows[cut[e], 1] == rows[cut[e], 2]:
                        e += 1
                at = slice(cut[k], cut[e])
                if cut[e] - cut[k] > 1:
                    yield solve(rows[at], fp[at], cell[at])
                k = e

    return run


def _near_buckets(classes: DataFrame, radius: int, tile: int) -> DataFrame:
    """(bucket, c) of the classes (c, bands, fp) that are within the radius of another one of the bucket."""
    rows = classes.select(F.explode("bands").alias("bucket"), "c")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    cells = (
        rows.join(sizes, "bucket").withColumn("tile", F.pmod(F.xxhash64("c", F.lit(7)), F.col("tiles")).cast("int")).join(classes.select("c", "fp"), "c")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("bucket", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "c", "fp")
    )
    found = cells.repartition(partitions(classes.sparkSession), "bucket", "a", "b").sortWithinPartitions("bucket", "a", "b").mapInArrow(_near_cells(radius), "bucket long, c long")
    return stored(found.distinct(), "near")


def _named(kept: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    roots = components(found, "simhash").withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return kept.join(rooted.join(ids, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def _similar_classes(docs: DataFrame, text_col: str, id_col: str, similarity: float, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches (id, f1, f2), classes (f1, f2, c), and (node, root) of the classes that are not the least of their group.
    Ids are unique whole numbers, and a class goes by its least id."""
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    sketch = stored(base.mapInArrow(sketches(size, _min_bands, _set_prints), "id long, f1 long, f2 long, n long, bands array<long>, fp binary"), "sketches")
    classes = stored(sketch.groupBy("f1", "f2").agg(F.min("id").alias("c"), *[F.first(x).alias(x) for x in ("n", "bands", "fp")]), "classes")
    found = verified(base, classes.select("c", "n"), _near_buckets(classes, NEAR_RADIUS, TILE), similarity, size, SET_TILE)
    return sketch.select("id", "f1", "f2"), classes.select("f1", "f2", "c"), components(found, "similar")


def similar_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", similarity: float = SIMILARITY, size: int = SIMILAR_SHINGLE) -> DataFrame:
    """One row per row of docs: id and component_id, the least id of its group of similar texts. Ids are unique whole numbers."""
    sketch, classes, moved = _similar_classes(docs, text_col, id_col, similarity, size)
    named = classes.join(moved.withColumnRenamed("node", "c"), "c", "left").select("f1", "f2", F.coalesce("root", "c").alias("component_id"))
    return sketch.join(named, ["f1", "f2"]).select("id", "component_id")


def near_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """One row per row of docs: id, fp (bigint) and component_id, the least id of its group (null if it has none)."""
    kept = stored(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_fingerprint_batches(size), f"id {docs.schema[id_col].dataType.simpleString()}, fp long"),
        "fingerprints",
    )
    classes = stored(kept.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    return _named(kept, classes, links(classes.select("fp"), radius))


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of docs that are the first of their group of similar texts, by id (nulls last) and, among equal ids, by content.

    Null and empty texts are one group. Rows keep all their columns, whatever their names."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # so that no column can clash with the handle
    base = with_order(docs.select(row, F.col(f"`{id_col}`").alias("own"), F.col(f"`{text_col}`").cast("string").alias("text")), "own")
    _, classes, moved = _similar_classes(base, "text", "uid", SIMILARITY, SIMILAR_SHINGLE)
    first = classes.select(F.col("c").alias("uid")).join(moved.select(F.col("node").alias("uid")), "uid", "left_anti")
    return base.join(first, "uid", "left_semi").select("row.*")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
