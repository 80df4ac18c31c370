"""Benchmark decontamination by the q-gram lemma and banded alignment.

Text is read as bytes with A-Z in lower case and runs of white space as one space. An item of m bytes may occur with
up to e = floor(RATE * m) edits (fewer for very short items, so that the lemma's bound stays positive). Such an
occurrence shares at least m - q + 1 - q * e q-grams with the item, and they lie on diagonals at most e apart.

1. The items' q-grams form a sorted array with a bit table in front; documents are looked up at every position.
2. Hits are counted for (document, item, diagonal band). Bands are 2 (e + 1) wide and start every e + 1 diagonals, so
   one of them holds all the diagonals of an occurrence. Bands below the lemma's bound go.
3. What is left is verified: the item against the band's region by dynamic programming inside the band.

The benchmark is taken in blocks of about BLOCK bytes (an item is never split); each block is one broadcast and one pass
over the documents, so a task holds one index at a time and every item meets every document. Of a pass only the rows with
leaks are written, and they are joined to the documents at the end. Items shorter than Q bytes have no q-gram: they are
looked up as whole words. Items that are null or white space are not searched. Null and empty texts have no leaks. Texts
are folded as a whole; those beyond PIECE bytes are searched in pieces of the folded text that overlap by more than the
longest item. Rows with equal ids are rows of their own; own columns named `leaks` are replaced, others stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import as_binary, byte_view, chunks, stored, table, text_column, with_order

Q, RATE = 10, 0.08
BLOCK, PIECE = 1 << 20, 1 << 23
#: Hits that are expanded at once.
SLICE = 1 << 20

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32
_SLOTS = 22
#: Bytes that make words, for items shorter than Q: letters, digits and all beyond ASCII.
_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def _grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q bytes from every position."""
    x = data.astype(np.uint64)
    for width in (1, 2, 4):
        x = (x[:-width] << _U(8 * width)) | x[width:]
    y = x * _U(0x9E3779B97F4A7C15)
    y ^= y >> _U(31)
    more = Q - 8
    return y[: len(y) - more] * _U(0xC2B2AE3D27D4EB4F) + x[more:]


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - _SLOTS)).astype(np.int64)


def fold(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes and where each one stands in data."""
    low = _LOWER[data]
    space = low == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    if len(keep):
        keep[0] = True
    at = np.flatnonzero(keep)
    return low[at], at


def align(item: np.ndarray, text: np.ndarray, low: int, width: int, most: int) -> tuple[int, int]:
    """(edits, end) of the best occurrence of the whole item in text on the diagonals low ... low + width - 1 (a
    diagonal is the text position minus the item position), or (most + 1, -1)."""
    o = np.arange(width)
    big = len(item) + most + 2
    row = np.where((o + low >= 0) & (o + low <= len(text)), 0, big)
    padded = np.full(len(text) + 2 * (width + len(item)) + 2, 256, np.int16)
    shift = width + len(item)
    padded[shift : shift + len(text)] = text
    for i in range(1, len(item) + 1):
        p = low + i - 1  # text index that diagonal o = 0 compares with
        start = p + shift
        if start < 0 or start + width > len(padded):
            cost = np.ones(width, np.int64)
        else:
            cost = (padded[start : start + width] != item[i - 1]).astype(np.int64)
        new = row + cost
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        inside = (o + low + i >= 0) & (o + low + i <= len(text))
        new[~inside] = big
        row = np.minimum.accumulate(new - o) + o
        row[~inside] = big
        if row.min() > most:
            return most + 1, -1
    k = int(row.argmin())
    return int(row[k]), low + len(item) + k


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted table's key changes."""
    new = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    return np.flatnonzero(np.append(True, new))


class Items:
    """The q-gram index of one block of items."""

    def __init__(self, items: list[tuple[int, bytes]]):
        folded = [(i, fold(np.frombuffer(t, np.uint8))[0]) for i, t in items]
        trimmed = ((i, t.tobytes().strip(b" ")) for i, t in folded)
        self.short: dict[int, dict[bytes, list[int]]] = {}  # by length: text -> ids
        for i, t in trimmed:
            if 0 < len(t) < Q:
                self.short.setdefault(len(t), {}).setdefault(t, []).append(i)
        folded = [(i, t) for i, t in folded if len(t) >= Q]
        self.ids = np.array([i for i, _ in folded], np.int64)
        self.texts = [t for _, t in folded]
        m = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.minimum((RATE * m).astype(np.int64), np.maximum((m - Q) // Q, 0))
        self.bound = m - Q + 1 - Q * self.edits
        keys = np.concatenate([_grams(t) for t in self.texts]) if folded else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(folded)), m - Q + 1) if folded else np.zeros(0, np.int64)
        offset = np.concatenate([np.arange(n - Q + 1) for n in m]) if folded else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.first = np.append(first, len(keys))
        self.owner, self.offset = owner[order].astype(np.int32), offset[order].astype(np.int32)
        self.table = np.zeros(1 << _SLOTS, bool)
        self.table[_slot(self.keys)] = True

    def bands(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first diagonal of the band, first and last hit) of all bands that meet the lemma's bound."""
        if len(data) < Q or not len(self.keys):
            return []
        keys = _grams(data)
        at = np.flatnonzero(self.table[_slot(keys)])
        k = np.searchsorted(self.keys, keys[at])
        k[k == len(self.keys)] = 0
        hit = self.keys[k] == keys[at]
        at, k = at[hit], k[hit]
        doc = np.searchsorted(off, at, "right") - 1
        inside = at + Q <= off[doc + 1]
        at, k, doc = at[inside], k[inside], doc[inside]
        n = self.first[k + 1] - self.first[k]
        ends = np.cumsum(n)
        parts, s = [], 0
        while s < len(at):  # hits are expanded and counted in slices, so a repetitive text and item stay in memory
            base = ends[s - 1] if s else 0
            e = max(s + 1, int(np.searchsorted(ends, base + SLICE, "right")))
            parts.append(self._count(at[s:e], k[s:e], doc[s:e], n[s:e], off))
            s = e
        if not parts:
            return []
        doc, item, band, count, low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((band, item, doc))
        doc, item, band, count, low, high = (x[order] for x in (doc, item, band, count, low, high))
        cut = _starts(doc, item, band)
        count, low, high = np.add.reduceat(count, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
        good = count >= self.bound[item[cut]]
        cut, low, high = cut[good], low[good], high[good]
        return list(zip(doc[cut].tolist(), item[cut].tolist(), (band[cut] * (self.edits[item[cut]] + 1)).tolist(), low.tolist(), high.tolist(), strict=True))

    def _count(self, at, k, doc, n, off):
        """Hits of some positions by (text, item, band): count, first and last position in the text."""
        row = np.repeat(np.arange(len(at)), n)
        e = np.arange(len(row)) + np.repeat(self.first[k] - (np.cumsum(n) - n), n)
        item, pos, doc = self.owner[e].astype(np.int64), at[row] - off[doc[row]], doc[row]
        band = (pos - self.offset[e]) // (self.edits[item] + 1)  # and the band before it
        doc, item, band, pos = (np.concatenate(x) for x in ((doc, doc), (item, item), (band, band - 1), (pos, pos)))
        order = np.lexsort((band, item, doc))
        doc, item, band, pos = doc[order], item[order], band[order], pos[order]
        cut = _starts(doc, item, band)
        return doc[cut], item[cut], band[cut], np.diff(np.append(cut, len(doc))), np.minimum.reduceat(pos, cut), np.maximum.reduceat(pos, cut)

    def words(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, id, start, end) of the short items that stand as whole words; data is folded."""
        if not self.short or not len(data):
            return
        word = _WORD[data]
        opens, closes = np.append(True, ~word[:-1]) | ~word, np.append(~word, True)
        closes[1:] |= ~word
        opens[off[:-1][off[:-1] < len(data)]] = True
        closes[off] = True
        for length, items in self.short.items():
            start = np.flatnonzero(opens[: max(0, len(data) - length + 1)])
            start = start[closes[start + length]]
            keys = np.zeros(len(start), np.uint64)
            for k in range(min(8, length)):
                keys = (keys << _U(8)) | data[start + k].astype(np.uint64)
            start = start[np.isin(keys, np.array(sorted({int.from_bytes(t[:8], "big") for t in items}), np.uint64))]
            doc = np.searchsorted(off, start, "right") - 1
            for d, s in zip(doc.tolist(), start.tolist(), strict=True):
                if s + length <= off[d + 1]:
                    for i in items.get(data[s : s + length].tobytes(), ()):
                        yield d, i, s - int(off[d]), s - int(off[d]) + length

    def leaks(self, data: np.ndarray, off: np.ndarray) -> dict[int, dict[int, tuple[int, int, int]]]:
        """For each text, the verified items by id: edits and the range of their shared q-grams."""
        out: dict[int, dict[int, tuple[int, int, int]]] = {}
        for doc, item, diagonal, low, high in self.bands(data, off):
            e = int(self.edits[item])
            text = data[off[doc] : off[doc + 1]]
            start = max(0, diagonal - e)
            region = text[start : max(0, diagonal + 2 * (e + 1) + len(self.texts[item]) + 2 * e)]
            edits, _ = align(self.texts[item], region, diagonal - e - start, 2 * (e + 1) + 2 * e, e)
            if edits <= e:
                mine = out.setdefault(doc, {})
                best = mine.get(item)
                if best is None or (edits, low) < best[:2]:
                    mine[item] = (edits, low, high + Q)
        found: dict[int, dict[int, tuple[int, int, int]]] = {}
        for doc, mine in out.items():
            for item, x in mine.items():  # several items can have one id
                i, own = int(self.ids[item]), found.setdefault(doc, {})
                own[i] = min(x, own.get(i, x))
        for doc, i, s, e in self.words(data, off):
            found.setdefault(doc, {}).setdefault(i, (0, s, e))
        return found


LEAKS = "array<struct<item_id:long,edits:int,s:long,e:long>>"


def _folded_pieces(raw: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The folded text in pieces, each with the last `overlap` folded bytes before it, and where its bytes stand in raw."""
    low, at, space_before = np.zeros(0, np.uint8), np.zeros(0, np.int64), False
    for s in range(0, len(raw), PIECE):
        part = _LOWER[raw[s : s + PIECE]]
        space = part == 32
        keep = ~space
        keep[1:] |= ~space[:-1]
        keep[0] |= not space_before
        space_before = bool(space[-1])
        low, at = np.concatenate([low[-overlap:], part[keep]]), np.concatenate([at[-overlap:], np.flatnonzero(keep) + s])
        yield low, at


def _points(raw: np.ndarray):
    """A function from byte positions of raw to code points."""
    steps = [0]
    for s in range(0, len(raw), 1 << 16):
        steps.append(steps[-1] + int(((raw[s : s + (1 << 16)] & 0xC0) != 0x80).sum()))
    return lambda p: steps[p >> 16] + int(((raw[p >> 16 << 16 : p] & 0xC0) != 0x80).sum())


def _search(shared):
    """A function from texts to their leaks."""
    items: Items = shared.value
    overlap = int(max((len(t) for t in items.texts), default=0) * (1 + 2 * RATE)) + 2 * Q + 8
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("s", pa.int64()), ("e", pa.int64())]))

    def of(col: pa.Array) -> pa.Array:
        data, off = byte_view(as_binary(col))
        found: list[list[dict]] = [[] for _ in range(len(col))]

        def take(row, mine, at, point):
            for item, (edits, s, e) in mine.items():
                found[row].append({"item_id": item, "edits": edits, "s": point(int(at[s])), "e": point(int(at[e - 1]) + 1)})

        for i, j in chunks(off):
            raw, cuts = data[off[i] : off[j]], off[i : j + 1] - off[i]
            if j == i + 1 and len(raw) > PIECE:
                point = _points(raw)
                for low, at in _folded_pieces(raw, overlap):
                    for mine in items.leaks(low, np.array([0, len(low)])).values():
                        take(i, mine, at, point)
                continue
            low, at = fold_rows(raw, cuts)
            inner = np.searchsorted(at, cuts)
            for doc, mine in items.leaks(low, inner).items():
                take(i + doc, mine, at[inner[doc] : inner[doc + 1]] - cuts[doc], _points(raw[cuts[doc] : cuts[doc + 1]]))
        for k, mine in enumerate(found):
            best: dict[int, dict] = {}
            for x in mine:
                if x["item_id"] not in best or (x["edits"], x["s"]) < (best[x["item_id"]]["edits"], best[x["item_id"]]["s"]):
                    best[x["item_id"]] = x
            found[k] = [best[i] for i in sorted(best)]
        return pa.array(found, kind)

    return of


def fold_rows(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`fold` for several texts one after another: white space is not joined across texts."""
    low = _LOWER[raw]
    space = low == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    starts = cuts[:-1][cuts[:-1] < len(raw)]
    keep[starts] = True
    at = np.flatnonzero(keep)
    return low[at], at


def with_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """docs with `leaks`, the benchmark items (item_id, text) that each text holds. The id is read only for a benchmark of
    several blocks, where it makes the handle by which what the passes found is put together."""
    spark = docs.sparkSession
    items = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block))
    def index(b: int):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        return spark.sparkContext.broadcast(Items([(r["item_id"], r["text"].encode()) for r in part]))

    def leaks_in(shared):
        return text_column(lambda: _search(shared), LEAKS)(F.col(f"`{text_col}`").cast("string"))

    own = docs.select(*[f"`{c}`" for c in docs.columns if c != "leaks"])
    if blocks == 1:
        return own.select(*[f"`{c}`" for c in own.columns], leaks_in(index(0)).alias("leaks"))
    base = with_order(own, id_col, "__uid")
    every = None
    for b in range(blocks):
        shared = index(b)
        hits = stored(base.select("__uid", leaks_in(shared).alias("__found")).filter(F.size("__found") > 0), "leaks")
        shared.destroy()
        every = hits if every is None else every.unionByName(hits)
    joined = every.groupBy("__uid").agg(F.array_sort(F.flatten(F.collect_list("__found"))).alias("leaks"))
    return base.join(joined, "__uid", "left").withColumn("leaks", F.coalesce("leaks", F.array().cast(LEAKS))).select(*[f"`{c}`" for c in own.columns], "leaks")


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = with_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.item_id", "x.edits", F.col("x.s").alias("start"), F.col("x.e").alias("end"))
