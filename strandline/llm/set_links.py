"""Links between texts by the similarity of their sets of shingles: sets, sketches, and the exact check of candidates.

Texts with equal sets are one class (128 bits of hash), which goes by its least id. Candidates are classes in one bucket.
`verified` finds links that join all classes that links within buckets join:
1. A component of candidates whose sets fit one tile is compared in one cell: each text travels once.
2. In a larger one every class is first compared with the least, tile by tile. What is linked to it is settled, and settled
   classes are never compared with each other.
3. The others meet everything that they may be linked to, either in the component's tiles or in its buckets (those with
   the same members are one), whichever moves fewer bytes. A cell holds two tiles.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import as_binary, partitions, stored, texts
from strandline.llm.components import components

#: Bytes of sets in one tile, and the most classes with candidates whose ids (8 bytes each) are broadcast to pick their texts.
SET_TILE, IDS = 1 << 22, 1_000_000


def shingle_hashes(text: bytes, size: int, block: int = 1 << 17) -> Iterator[list[int]]:
    words = text.lower().split()  # bytes: only A-Z, only \x20 and \x09-\x0D
    if not words:
        return
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        yield [h(joined, 42)]
        return
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.append(0, ends[:-1])[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    for k in range(0, len(starts), block):
        yield [h(joined[a:b], 42) for a, b in zip(starts[k : k + block], stops[k : k + block], strict=False)]


def shingle_set(text: bytes, size: int) -> np.ndarray:
    some = [np.array(x, np.uint64) for x in shingle_hashes(text, size)]
    return np.unique(np.concatenate(some)) if some else np.zeros(0, np.uint64)


def remix(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash of a shingle, made from its first."""
    if not k:
        return h
    z = h + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def min_keys(flat: np.ndarray, starts: np.ndarray, keys: int, rows: int) -> np.ndarray:
    """For each set of hashes `keys` keys, each of `rows` minimum hashes; sets are not empty. The hashes are well mixed
    already, so that multiply and add give the orders of which the minima are taken."""
    times, plus = remix(np.arange(1, 2 * keys * rows + 1, dtype=np.uint64), 1).reshape(2, keys, rows)
    times, out = times | np.uint64(1), np.empty((len(starts), keys), np.uint64)
    for b in range(keys):
        key = np.full(len(starts), np.uint64(b))
        for r in range(rows):
            key = remix(key ^ np.minimum.reduceat(flat * times[b, r] + plus[b, r], starts), 1)
        out[:, b] = key
    return out.view(np.int64)


def sketches(size: int, keys: Callable[[np.ndarray, np.ndarray], np.ndarray], prints: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None):
    """(id, text) -> (id, f1, f2, n, bands): the hash of the set of shingles, its size, and its keys (none if it is empty).
    With `prints`, a column fp follows: the bytes of the set's row of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, values in texts(batch.column(1), 1 << 20):
                part, sets = batch.slice(i, j - i), [shingle_set(text, size) for text in values]
                bands: list = [()] * len(sets)
                fps: list = [b""] * len(sets)
                full = [k for k, x in enumerate(sets) if len(x)]
                lens = np.cumsum([0] + [len(sets[k]) for k in full])
                at = 0
                while at < len(full):  # about 65,000 hashes at once
                    e = max(at + 1, int(np.searchsorted(lens, lens[at] + (1 << 16), "right")) - 1)
                    flat = np.concatenate([sets[k] for k in full[at:e]])
                    for k, row in zip(full[at:e], keys(flat, lens[at:e] - lens[at]), strict=True):
                        bands[k] = row
                    for k, row in zip(full[at:e], prints(flat, lens[at:e] - lens[at]), strict=True) if prints else ():
                        fps[k] = row.tobytes()
                    at = e
                name = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.tobytes()) for x in sets), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(name[:, 0]), pa.array(name[:, 1]), pa.array([len(x) for x in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64())), *([pa.array(fps, pa.binary())] if prints else [])],
                    names=["id", "f1", "f2", "n", "bands", *(["fp"] if prints else [])],
                )

    return run


def set_forest(sets: list[np.ndarray], left: int, similarity: float, label: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs of sets with at least this Jaccard similarity: of all sets, or, if left is not 0,
    of pairs of one of the first `left` sets with one of the others. Sets with equal labels are joined already."""
    n, size = len(sets), np.array([len(x) for x in sets])
    starts = np.cumsum(size) - size
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    mark, label = np.zeros(len(values), bool), np.arange(n) if label is None else label.copy()
    u: list[int] = []
    v: list[int] = []
    for i in range(left or n):
        other = np.arange(left or i + 1, n)
        lower, upper = np.minimum(size[other], size[i]), np.maximum(size[other], size[i])
        other = other[(label[other] != label[i]) & (lower / upper >= similarity)]
        if not len(other):
            continue
        own = code[starts[i] : starts[i] + size[i]]
        mark[own] = True
        if 2 * len(other) > n:
            both = np.add.reduceat(mark[code], starts, dtype=np.int64)[other]
        else:
            begin = np.cumsum(size[other]) - size[other]
            both = np.add.reduceat(mark[code[np.arange(size[other].sum()) + np.repeat(starts[other] - begin, size[other])]], begin, dtype=np.int64)
        mark[own] = False
        hits = other[both / (size[i] + size[other] - both) >= similarity]
        labels, first = np.unique(label[hits], return_index=True)
        u += [i] * len(first)
        v += hits[first].tolist()
        label[np.isin(label, labels)] = label[i]
    return u, v


def _stars(similarity: float, size: int):
    """Rows (g, tile, lead, c, text), sorted, the leading row of a tile first -> links (u, v) of classes to the leading one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, hub = None, np.zeros(0, np.uint64)
        for batch in batches:
            lead, c = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            us: list[int] = []
            vs: list[int] = []
            for i, _, values in texts(batch.column(4)):
                for k, text in enumerate(values, i):
                    own = shingle_set(text, size)
                    if not lead[k]:
                        head, hub = c[k], own
                        continue
                    both = len(np.intersect1d(hub, own, assume_unique=True))
                    if both / (len(hub) + len(own) - both) >= similarity:
                        us.append(c[k])
                        vs.append(head)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def _cells(similarity: float, size: int):
    """Rows (kind, g, a, b, tile, settled, c, text) sorted by cell, its first four -> links (u, v); a cell can go over
    several batches."""

    def solve(rows: pa.Table, two: bool) -> tuple[np.ndarray, np.ndarray]:
        tile, settled, c = (rows.column(k).to_numpy() for k in ("tile", "settled", "c"))
        order = np.argsort(tile, kind="stable")
        values = as_binary(rows.column("text")).to_pylist()
        left = int((tile == tile.min()).sum()) if two else 0
        if two and left == len(tile):
            return c[:0], c[:0]
        label = np.where(settled[order] != 0, len(tile), np.arange(len(tile)))
        u, v = set_forest([shingle_set(values[k], size) for k in order], left, similarity, label)
        return c[order[u]], c[order[v]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            if batch is None and rest is None:
                return
            rows = rest if batch is None else pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            cell = np.stack([rows.column(k).to_numpy().astype(np.int64) for k in range(4)], axis=1)
            cut = np.append(np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]).any(axis=1))), len(cell))
            rest = None if batch is None else rows.slice(int(cut[-2]))
            for s, e in itertools.pairwise(cut if batch is None else cut[:-1]):
                if e - s < 2:
                    continue
                u, v = solve(rows.slice(s, e - s), cell[s, 2] != cell[s, 3])
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def verified(base: DataFrame, classes: DataFrame, buckets: DataFrame, similarity: float, size: int, tile: int = SET_TILE) -> DataFrame:
    """Links (u, v) between classes (c, n), n the size of a class's set, that share a bucket of (bucket, c). base: (id, text)."""
    n = partitions(base.sparkSession)
    heads = buckets.groupBy("bucket").agg(F.min("c").alias("v"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("bucket", "v")
    roots = components(buckets.join(heads, "bucket").select(F.col("c").alias("u"), "v").filter("u != v").distinct(), "candidates")
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())  # a root is no node of its own
    members = classes.select("c", F.col("n").alias("own")).join(roots.withColumnRenamed("node", "c"), "c")
    sizes = members.groupBy("root").agg((F.sum("own") * 8).alias("bytes"))
    members = stored(members.join(sizes, "root"), "members")
    tiles = lambda b: F.ceil(b / F.lit(tile)).cast("int")
    dealt = lambda by: F.pmod(F.xxhash64("c", F.lit(7)), F.greatest(by, F.lit(1))).cast("int")
    few = members.limit(IDS + 1).count() <= IDS
    ids = members.select(F.col("c").alias("id"))
    texts_of = stored(base.join(F.broadcast(ids) if few else ids, "id").select(F.col("id").alias("c"), "text"), "texts")
    with_text = lambda rows: texts_of.join(rows, "c")

    large = members.filter(F.col("bytes") > tile)
    spokes = large.filter("c != root").select(F.col("root").alias("g"), dealt(tiles(F.col("bytes"))).alias("tile"), F.lit(1).alias("lead"), "c")
    hubs = large.filter("c = root").select(F.col("root").alias("g"), F.explode(F.sequence(F.lit(0), tiles(F.col("bytes")) - 1)).alias("tile"), F.lit(0).alias("lead"), "c")
    order = ["g", "tile", "lead"]
    rays = with_text(hubs.unionByName(spokes)).select(*order, "c", "text").repartition(n, "g", "tile").sortWithinPartitions(*order)
    rays = stored(rays.mapInArrow(_stars(similarity, size), "u long, v long"), "stars")
    held = large.join(rays.select(F.col("u").alias("c"), F.lit(True).alias("linked")), "c", "left").withColumn("settled", F.coalesce("linked", F.col("c") == F.col("root")))
    held = stored(held.select("c", "root", (F.col("own") * 8).alias("bytes"), "settled"), "settled")

    parts = [F.coalesce(F.sum(F.when(F.col("settled") == s, F.col("bytes"))), F.lit(0)).alias(name) for s, name in ((False, "fresh"), (True, "old"))]
    cost = tiles(F.col("fresh")) * (F.col("fresh") + F.col("old")) + tiles(F.col("old")) * F.col("fresh")
    whole = held.groupBy("root").agg(*parts).filter("fresh > 0").withColumn("whole_cost", cost)
    same = [F.bit_xor(F.xxhash64("c")).alias("x"), F.sum(F.xxhash64("c", F.lit(1)).cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("k")]
    each = buckets.join(held, "c").groupBy("root", "bucket").agg(*parts, *same).filter("fresh > 0 and k > 1")
    each = each.groupBy("root", "x", "s", "k").agg(F.min("bucket").alias("bucket"), F.first("fresh").alias("fresh"), F.first("old").alias("old"))
    each = stored(each.select("root", "bucket", "fresh", "old", cost.alias("cost")), "buckets")
    way = whole.join(each.groupBy("root").agg(F.sum("cost").alias("bucket_cost")), "root").select("root", "fresh", "old", (F.col("bucket_cost") < F.col("whole_cost")).alias("by_bucket"))
    by_bucket = each.join(way.filter("by_bucket").select("root"), "root").join(buckets, "bucket").join(held.select("c", "root", "settled"), ["root", "c"])
    shape = lambda kind, g: [F.lit(kind).alias("kind"), F.col(g).alias("g"), "c", "settled", tiles(F.col("fresh")).alias("tu"), tiles(F.col("old")).alias("tr")]
    cells = members.filter(F.col("bytes") <= tile).select(F.lit(0).alias("kind"), F.col("root").alias("g"), "c", F.lit(False).alias("settled"), F.lit(1).alias("tu"), F.lit(0).alias("tr"))
    cells = cells.unionByName(held.join(way.filter("not by_bucket"), "root").select(*shape(1, "root"))).unionByName(by_bucket.select(*shape(2, "bucket")))
    cells = (
        cells.withColumn("tile", F.when(F.col("settled"), F.col("tu") + dealt(F.col("tr"))).otherwise(dealt(F.col("tu"))))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("settled"), F.col("tu")).otherwise(F.col("tu") + F.col("tr")) - 1)))
        .select("kind", "g", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", F.col("settled").cast("int").alias("settled"), "c")
    )
    cell = ["kind", "g", "a", "b"]
    found = with_text(cells).select(*cell, "tile", "settled", "c", "text").repartition(n, *cell).sortWithinPartitions(*cell).mapInArrow(_cells(similarity, size), "u long, v long")
    return rays.unionByName(stored(found, "links"))
