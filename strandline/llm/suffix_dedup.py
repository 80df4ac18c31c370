"""Exact removal of repeated substrings with a sparse suffix array.

A window is a string of `WINDOW` bytes at one start; a window is a repeat if the same string also starts earlier
(smaller document, or same document and smaller start). Every byte that a repeat covers is removed.

1. Every window has one anchor: the position inside it of the 32-byte string with the least hash (leftmost of equals).
   The anchor depends on the window's bytes alone, so equal windows have equal anchors at equal offsets. Neighbouring
   windows share anchors, so a document of n bytes has about n / 35 runs (windows in a row with one anchor).
2. Runs meet by anchor hash. Runs alone with their anchor hold no repeats. Equal runs (128 bits of BLAKE2b over all their
   bytes) are collapsed to the earliest, first inside each batch of documents and then across them; the others are
   repeats whole and no longer travel to their anchor's partition, so a text in a third of all documents is a few rows
   there. Anchors that a sample shows to be frequent are dealt by the run's hash as well, so a common string with many
   different surroundings is not one task's work. Earliest runs whose anchor has other variants are the suffixes that
   have to be sorted.
3. Those suffixes are range-partitioned by their leading tokens (the first 6 bytes of the anchor) with splitters sampled
   from themselves, into buckets of about BUCKET_RUNS runs or less. A token sequence that fills several buckets is dealt
   over all of them by longer tokens: first the whole anchor. Runs of one that is still more than a bucket's share are
   cut by the place of the anchor in the window, twice (CUTS), and dealt by all bytes that the windows of such a piece have
   in common. Equal windows have equal ones, so they meet in one bucket, and the pieces are a few a run. Equal pieces of
   a text that is more than a bucket's share are repeats of the earliest whole.
4. Each bucket expands its runs into windows and sorts them by multikey quicksort: 8-byte words from the left, where
   only the groups that are still equal go on to the next word. Equal neighbours are repeats of the first. Runs of one
   anchor with more than LARGE windows are sorted one place of the anchor after the other, a window a run at a time.
5. What is more than a bucket's share after both cuts is dealt by its place; its windows, up to 6 a piece, are compared
   across the bucket boundaries by a grouped minimum.

Nulls and empty texts have no windows and lose nothing. Rows with equal or null ids, and ids that are not whole numbers,
are ordered by (id nulls last, hash of the row). A text of any length is read in overlapping pieces. An empty table gives
no rows, and other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.common import as_binary, byte_view, chunks, partitions, stored, with_order

WINDOW = 100
GRAM = 32
#: Runs sampled for the splitters and documents sampled for frequent anchors (both up to twice as many), the most runs
#: that a bucket should hold, and the share of sampled documents from which on an anchor is frequent.
SPLITTER_RUNS, ANCHOR_DOCS, BUCKET_RUNS, FREQUENT = 20_000, 2000, 1 << 18, 0.005
#: Places of the anchor in a window that a piece of a frequent anchor's run covers, cut by cut, and the fewest runs or
#: pieces with one key that are cut further or dealt by their place.
CUTS, SHARE = (24, 6), 100

_U = np.uint64
_C1, _C2, _C3 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
_POS_BITS = 28
_POS = _U((1 << _POS_BITS) - 1)


def _mix(z: np.ndarray) -> np.ndarray:
    z = z ^ (z >> _U(32))
    z *= _C1
    z ^= z >> _U(29)
    return z


def _words8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position as one big-endian number."""
    x = data.astype(np.uint64)
    for width in (1, 2, 4):
        x = (x[:-width] << _U(8 * width)) | x[width:]
    return x


def _gram_hash(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from every position."""
    x = _words8(data)
    h = _mix(_mix(x[:-8]) * _C2 + x[8:])
    return _mix(h[:-16] * _C2 + h[16:])


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    m, have = keys, 1
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def anchor_runs(data: np.ndarray, off: np.ndarray, window: int = WINDOW) -> dict[str, np.ndarray]:
    """The runs of several values: document, first window, windows, anchor offset and anchor hash.

    A value must be shorter than 2**28 bytes; longer ones come in overlapping pieces (see `_pieces`)."""
    lens = np.diff(off)
    nwin = np.maximum(lens - window + 1, 0)
    total = int(nwin.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return {"doc": none, "q0": none, "n": none, "ao": none, "h": none}
    h = _gram_hash(data)
    best = _sliding_min((h & ~_POS) | np.arange(len(h), dtype=np.uint64), window - GRAM + 1)
    doc = np.repeat(np.arange(len(lens)), nwin)
    q = np.arange(total) + (off[:-1] - (np.cumsum(nwin) - nwin))[doc]
    a = (best[q] & _POS).astype(np.int64)
    new = np.ones(total, bool)
    new[1:] = (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, total))
    q0, a, doc = q[first], a[first], doc[first]
    return {"doc": doc, "q0": q0 - off[doc], "n": n, "ao": a - q0, "h": h[a].view(np.int64)}


def digests(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """128 bits of BLAKE2b of each stretch of bytes, as two numbers."""
    view, blake = memoryview(np.ascontiguousarray(data)), hashlib.blake2b
    return np.frombuffer(b"".join([blake(view[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), (start + length).tolist(), strict=True)]), np.int64).reshape(-1, 2)


def _pieces(col: pa.LargeBinaryArray, window: int, limit: int = 1 << 20, most: int = 1 << 26) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, offset in it, bytes, offsets): groups of rows; a very long value in pieces that overlap by window - 1 bytes."""
    data, off = byte_view(col)
    for i, j in chunks(off, limit):
        size = off[j] - off[i]
        if size <= most:
            yield i, 0, data[off[i] : off[j]], off[i : j + 1] - off[i]
            continue
        for s in range(0, size, most):
            e = min(size, s + most + window - 1)
            yield i, s, data[off[i] + s : off[i] + e], np.array([0, e - s])


#: How a run takes part: by its anchor, by its anchor and bytes (frequent anchors), or not (a copy in its batch).
_PLAIN, _DEALT, _COPY = 0, 1, 2


def _collapse(h: np.ndarray, dig: np.ndarray, uid: np.ndarray, loc: np.ndarray) -> np.ndarray:
    """True for rows that equal an earlier one (by uid and loc) in h and dig."""
    order = np.lexsort((loc, uid, dig[:, 1], dig[:, 0], h))
    again = np.zeros(len(h), bool)
    again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (dig[order[1:]] == dig[order[:-1]]).all(axis=1)
    return again


def _emit_runs(window: int, frequent: np.ndarray):
    """All runs of a batch of documents; copies within the batch are marked and spread evenly by their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch.column(0).to_numpy(zero_copy_only=False)
            held: list[tuple[np.ndarray, ...]] = []
            for i, start, data, off in _pieces(as_binary(batch.column(1)), window):
                r = anchor_runs(data, off, window)
                if len(r["doc"]):
                    held.append((r["h"], digests(data, off[r["doc"]] + r["q0"], r["n"] + window - 1), uid[i + r["doc"]], ((r["q0"] + start) << 16) | (r["n"] << 8) | r["ao"]))
            if held:
                h, dig, u, loc = (np.concatenate(x) for x in zip(*held, strict=True))
                role = np.where(_collapse(h, dig, u, loc), _COPY, np.where(np.isin(h, frequent), _DEALT, _PLAIN)).astype(np.int8)
                mixed = lambda x: _mix(x.view(np.uint64).copy()).view(np.int64)
                key = np.where(role == _COPY, mixed(u ^ (loc << 20)), np.where(role == _DEALT, mixed(h ^ dig[:, 0]), h))
                for s in range(0, len(h), 100_000):
                    e = s + 100_000
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[s:e])) for x in (key, dig[:, 0], dig[:, 1], u, loc, role)], names=["h", "d1", "d2", "uid", "loc", "role"])

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs sorted by (role, h, d1, d2, uid, loc): kind 0 for copies of an earlier equal run, 1 for suffixes to be sorted.

    The first variant of an anchor is held until a second one turns up, so one row is carried between batches. Variants of
    a frequent anchor are in different places and are sorted whether they have others or not."""
    carry: tuple | None = None  # role, h, d1, d2 of the last row
    held: tuple[int, int] | None = None  # the only variant so far of the last anchor
    for batch in batches:
        if not batch.num_rows:
            continue
        h, d1, d2, uid, loc, role = (batch.column(k).to_numpy() for k in range(6))
        done = int(np.searchsorted(role, _COPY))  # known copies come last
        if done < len(h):
            yield pa.RecordBatch.from_arrays([pa.array(uid[done:]), pa.array(loc[done:]), pa.array(np.zeros(len(h) - done, np.int8))], names=["uid", "loc", "kind"])
            h, d1, d2, uid, loc, role = (x[:done] for x in (h, d1, d2, uid, loc, role))
        n = len(h)
        if not n:
            continue
        same_h = np.zeros(n, bool)
        same_h[1:] = (h[1:] == h[:-1]) & (role[1:] == role[:-1])
        same_h[0] = carry is not None and (role[0], h[0]) == carry[:2]
        copy = np.zeros(n, bool)
        copy[1:] = same_h[1:] & (d1[1:] == d1[:-1]) & (d2[1:] == d2[:-1])
        copy[0] = same_h[0] and (d1[0], d2[0]) == carry[2:]
        group = np.cumsum(~same_h)  # 0: goes on from the batch before
        reps = np.flatnonzero(~copy)
        count = np.bincount(group[reps], minlength=int(group[-1]) + 1)
        check = reps[(count[group[reps]] >= 2) | ((group[reps] == 0) & same_h[0]) | (role[reps] == _DEALT)]
        out_u, out_l = [uid[check]], [loc[check]]
        if same_h[0]:
            if held is not None and count[0]:
                out_u.append(np.array([held[0]]))
                out_l.append(np.array([held[1]]))
                held = None
        last = int(group[-1])
        if last > 0 or not same_h[0]:  # another anchor is the last one now
            own = reps[group[reps] == last]
            held = (int(uid[own[0]]), int(loc[own[0]])) if len(own) == 1 and role[own[0]] == _PLAIN else None
        carry = (role[-1], h[-1], d1[-1], d2[-1])
        cu, cl = np.concatenate(out_u), np.concatenate(out_l)
        du, dl = uid[copy], loc[copy]
        kind = np.concatenate([np.ones(len(cu), np.int8), np.zeros(len(du), np.int8)])
        if len(kind):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([cu, du])), pa.array(np.concatenate([cl, dl])), pa.array(kind)], names=["uid", "loc", "kind"])


#: Windows of one anchor's runs beyond which they are sorted place by place.
LARGE = 400_000


def _emit_suffixes(splitters: np.ndarray, window: int):
    """From (uid, text, locs): each run with its bytes, its bucket, whether its leading tokens span several, and its anchor's hash."""
    lo_of, hi_of = (lambda x: np.searchsorted(splitters, x, "left")), (lambda x: np.searchsorted(splitters, x, "right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = batch.column(0).to_numpy(zero_copy_only=False)
            data, off = byte_view(as_binary(batch.column(1)))
            locs = batch.column(2)
            loc = locs.flatten().to_numpy(zero_copy_only=False)
            per = np.diff(locs.offsets.to_numpy())
            row = np.repeat(np.arange(len(uids)), per)
            for s in range(0, len(loc), 100_000):
                at, r = loc[s : s + 100_000], row[s : s + 100_000]
                q0, n, ao = at >> 16, (at >> 8) & 255, at & 255
                start = off[r] + q0
                length = n + window - 1
                ends = np.cumsum(length)
                flat = np.arange(ends[-1]) + (start - (ends - length)).repeat(length)
                lead = np.zeros(len(at), np.uint64)
                for k in range(8):
                    lead = (lead << _U(8)) | data[start + ao + k].astype(np.uint64)
                lead &= ~_U(0xFFFF)  # as in the splitters
                lo, hi = lo_of(lead), hi_of(lead)
                key = _mix(_mix(np.stack([_gathered(data, start + ao + 8 * k) for k in range(GRAM // 8)]) * _C2).sum(axis=0) + lead).view(np.int64)
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(data[flat])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lo.astype(np.int32)), pa.array(hi > lo), pa.array(key), pa.array(uids[r]), pa.array(at), raw.cast(pa.binary())], names=["bucket", "spans", "key", "uid", "loc", "ctx"]
                )

    return run


def _cut(width: int, window: int):
    """From (uid, loc, ctx): runs cut into pieces of `width` places of the anchor. Their key is a hash of the bytes that all
    windows of those places have in common, d1 and d2 are a digest of all bytes of the piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, loc = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            data, off = byte_view(as_binary(batch.column(2)))
            q0, n, ao = loc >> 16, (loc >> 8) & 255, loc & 255
            per = ao // width - (ao - n + 1) // width + 1
            row = np.repeat(np.arange(len(loc)), per)
            least = (ao[row] // width - (np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per))) * width
            most = np.minimum(least + width - 1, window - GRAM)
            first, last = np.minimum(ao[row], most), np.maximum(ao[row] - n[row] + 1, least)
            skip, some = ao[row] - first, first - last + 1
            start, length = off[row] + skip, some + window - 1
            common = digests(data, off[row] + ao[row] - least, window - (most - least))[:, 0]
            dig = digests(data, start, length)
            key = _mix((common ^ (least << 32)).view(np.uint64)).view(np.int64)
            ends = np.cumsum(length)
            flat = np.arange(ends[-1] if len(ends) else 0) + (start - (ends - length)).repeat(length)
            raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(data[flat])])
            at = (q0[row] + skip) << 16 | some << 8 | first
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(dig[:, 0].copy()), pa.array(dig[:, 1].copy()), pa.array(uid[row]), pa.array(at), raw.cast(pa.binary())], names=["key", "d1", "d2", "uid", "loc", "ctx"])

    return run


def _dealt(spread: DataFrame, share: int, buckets: int, window: int) -> tuple[DataFrame, DataFrame | None]:
    """Runs (key, uid, loc, ctx) whose leading tokens span buckets -> rows (bucket, spans, uid, loc, ctx), and (uid, loc) of pieces
    that are repeats whole. Keys with more than `share` rows are cut further; they are fewer than rows / share, and broadcast."""
    place, key = F.xxhash64("uid", "loc"), F.xxhash64("key")
    row = lambda by, spans: [F.pmod(by, F.lit(buckets)).cast("int").alias("bucket"), F.lit(spans).alias("spans"), "uid", "loc", "ctx"]
    out, copies, now = [], None, spread
    for width in (*CUTS, None):
        hot = stored(now.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > share).select("key"), "hot")
        if hot.isEmpty():
            out.append(now.select(*row(key, False)))
            break
        out.append(now.join(F.broadcast(hot), "key", "left_anti").select(*row(key, False)))
        rest = now.join(F.broadcast(hot), "key", "left_semi")
        if "d1" in now.columns:
            same = rest.groupBy("key", "d1", "d2").agg(F.min(F.struct("uid", "loc")).alias("first"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > share).drop("n")
            known = rest.join(F.broadcast(stored(same, "same")), ["key", "d1", "d2"], "left").withColumn("copy", F.coalesce(F.struct("uid", "loc") != F.col("first"), F.lit(False)))
            found = known.filter("copy").select("uid", "loc")
            copies, rest = found if copies is None else copies.unionByName(found), known.filter("not copy")
        if width is None:
            out.append(rest.select(*row(place, True)))
        else:
            now = stored(rest.select("uid", "loc", "ctx").mapInArrow(_cut(width, window), "key long, d1 long, d2 long, uid long, loc long, ctx binary"), "pieces")
    return functools.reduce(DataFrame.unionByName, out), copies


def _gathered(data: np.ndarray, at: np.ndarray, n: int = 8) -> np.ndarray:
    """The n bytes from each position on as a big-endian word: `_words8` for few positions of much data."""
    word = np.zeros(len(at), np.uint64)
    for k in range(n):
        word = (word << _U(8)) | data[at + k].astype(np.uint64)
    return word


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order the rows of a matrix of big-endian words; also the class of each ordered row (equal rows share one).

    Multikey quicksort over words: all rows are split by the first word; only groups of two or more equal rows are
    split again by the next word. Ties keep the given order."""
    n, width = words.shape
    order = np.arange(n)
    group = np.zeros(n, np.int64)
    active = np.arange(n)
    for d in range(width):
        if len(active) < 2:
            break
        w = words[order[active], d]
        sub = np.lexsort((w, group[active]))  # stable
        order[active] = order[active][sub]
        w, g = w[sub], group[active]
        cut = np.ones(len(active), bool)
        cut[1:] = (g[1:] != g[:-1]) | (w[1:] != w[:-1])
        first = np.maximum.accumulate(np.where(cut, np.arange(len(active)), 0))
        group[active] = active[first]
        size = np.bincount(first, minlength=len(active))[first]
        active = active[size > 1]
    return order, group


def _sort_bucket(window: int):
    width = -(-window // 8)

    def expand(ctx_data, ctx_off, n):
        """All windows of the runs as words, and the run and offset of each."""
        run = np.repeat(np.arange(len(n)), n)
        o = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        start = ctx_off[run] + o
        x = _words8(np.concatenate([ctx_data, np.zeros(8 * width + 8, np.uint8)]))
        words = np.empty((len(run), width), np.uint64)
        for d in range(width):
            words[:, d] = x[start + 8 * d]
        if window % 8:
            words[:, -1] >>= _U(64 - 8 * (window % 8))
        return run, o, words

    def spans(uid, q):
        """Maximal rows of windows as byte ranges; windows come sorted by (uid, q)."""
        if not len(uid):
            return uid, q, q
        new = np.ones(len(uid), bool)
        new[1:] = (uid[1:] != uid[:-1]) | (q[1:] > q[:-1] + 1)
        i = np.flatnonzero(new)
        return uid[i], q[i], q[np.append(i[1:], len(q)) - 1] + window

    def emit(kind, uid, s, e, dig=None):
        none = np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(uid), kind, np.int8)), pa.array(uid), pa.array(s), pa.array(e), pa.array(dig[0] if dig else np.zeros(len(uid), np.int64)), pa.array(dig[1] if dig else np.zeros(len(uid), np.int64))]
            if len(uid) else [pa.array(none.astype(np.int8))] + [pa.array(none)] * 5,
            names=["kind", "uid", "s", "e", "d1", "d2"],
        )

    def digest(words):
        d1, d2 = np.full(len(words), _C1), np.full(len(words), _C3)
        for d in range(width):
            d1, d2 = _mix(d1 * _C2 + words[:, d]), _mix((d2 ^ words[:, d]) * _C2 + _C1)
        return d1.view(np.int64), d2.view(np.int64)

    def solve(spanning, uid, loc, data, off):
        """One group of runs that share their anchors' leading tokens, or several such groups whole."""
        q0, n, ao = loc >> 16, (loc >> 8) & 255, loc & 255
        run, o, words = expand(data, off, n)
        # equal windows have the anchor at the same offset; the order of ties is by document and start
        by = np.lexsort(((q0[run] + o), uid[run]))
        run, o, words = run[by], o[by], words[by]
        order, group = multikey_order(words)
        first = np.ones(len(order), bool)
        first[1:] = group[1:] != group[:-1]
        repeat = order[~first]
        repeat.sort()
        u, s, e = spans(uid[run[repeat]], q0[run[repeat]] + o[repeat])
        yield emit(0, u, s, e)
        far = order[first]
        far = far[spanning[run[far]]]
        if len(far):
            q = q0[run[far]] + o[far]
            yield emit(1, uid[run[far]], q, q + window, digest(words[far]))

    def solve_large(spanning, uid, loc, data, off, rows):
        """One group with very many runs: equal windows have the anchor at the same place, so one place after another is
        sorted, with one window a run. What repeats is kept as (run, offset) and joined to byte ranges at the end."""
        rows = rows[np.lexsort((loc[rows] >> 16, uid[rows]))]  # by document and start
        q0, n, ao = loc[rows] >> 16, (loc[rows] >> 8) & 255, loc[rows] & 255
        again: list[np.ndarray] = []
        for place in range(int((ao - n + 1).min()), int(ao.max()) + 1):
            o = ao - place
            own = np.flatnonzero((o >= 0) & (o < n))
            if not len(own):
                continue
            start = off[rows[own]] + o[own]
            words = np.stack([_gathered(data, start + 8 * d, min(8, window - 8 * d)) for d in range(width)], axis=1)
            order, group = multikey_order(words)
            first = np.append(True, group[1:] != group[:-1])
            repeat = own[order[~first]]
            again.append(repeat << 8 | o[repeat])
            far = order[first]
            far = far[spanning[rows[own[far]]]]
            if len(far):
                at = own[far]
                yield emit(1, uid[rows[at]], q0[at] + o[at], q0[at] + o[at] + window, digest(words[far]))
        found = np.sort(np.concatenate(again)) if again else np.zeros(0, np.int64)
        cut, owner = 0, uid[rows]  # ascending
        while cut < len(found):  # whole documents of some 1,000,000 windows
            at = int(found[min(len(found), cut + 1_000_000) - 1] >> 8)
            end = int(np.searchsorted(found, int(np.searchsorted(owner, owner[at], "right")) << 8, "left"))
            part = found[cut:end]
            at = part >> 8
            yield emit(0, *spans(uid[rows[at]], q0[at] + (part & 255)))
            cut = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        whole = pa.Table.from_batches(got).combine_chunks()
        spanning = whole["spans"].to_numpy(zero_copy_only=False)
        uid, loc = whole["uid"].to_numpy(), whole["loc"].to_numpy()
        data, off = byte_view(as_binary(whole["ctx"]))
        ao = loc & 255
        # the suffixes of the anchors, by their first 32 bytes; runs with different ones cannot hold equal windows
        words = np.stack([_gathered(data, off[:-1] + ao + 8 * k) for k in range(GRAM // 8)], axis=1)
        order, group = multikey_order(words)
        cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        ends = np.append(cuts[1:], len(order))
        wins = np.cumsum((loc[order] >> 8) & 255)
        i = 0
        while i < len(cuts):  # as many whole groups as make 200,000 windows
            base = wins[cuts[i]]
            j = max(i + 1, int(np.searchsorted(wins[ends - 1], base + 200_000, "right")))
            rows = order[cuts[i] : ends[j - 1]]
            if wins[ends[j - 1] - 1] - base > LARGE:
                yield from solve_large(spanning, uid, loc, data, off, rows)
                i = j
                continue
            length = off[rows + 1] - off[rows]
            stop = np.cumsum(length)
            flat = np.arange(stop[-1]) + (off[rows] - (stop - length)).repeat(length)
            yield from solve(spanning[rows], uid[rows], loc[rows], data[flat], np.concatenate([[0], stop]))
            i = j

    return run


def _frequent(docs: DataFrame, window: int) -> np.ndarray:
    """Anchors that a bounded sample of documents shows with different runs in at least the share FREQUENT of them. It only
    decides how runs are dealt, never which are compared."""
    some = docs.filter(F.pmod(F.xxhash64("uid"), F.lit(max(1, docs.count() // ANCHOR_DOCS))) == 0).select("uid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, off in _pieces(as_binary(batch.column(1)), window):
                r = anchor_runs(data, off, window)
                if len(r["doc"]):
                    yield pa.RecordBatch.from_arrays([pa.array(r["h"]), pa.array(digests(data, off[r["doc"]] + r["q0"], r["n"] + window - 1)[:, 0].copy())], names=["h", "d1"])

    found = some.mapInArrow(run, "h long, d1 long").groupBy("h").agg(F.count_distinct("d1").alias("n")).filter(F.col("n") >= max(8, int(ANCHOR_DOCS * FREQUENT)))
    return np.array([r["h"] for r in found.orderBy(F.desc("n"), "h").limit(4096).collect()], np.int64)


def _leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, locs) -> the leading tokens of the runs' anchors: 6 bytes, so that quantiles, which are doubles, are exact."""
    for batch in batches:
        data, off = byte_view(as_binary(batch.column(0)))
        locs = batch.column(1)
        loc, per = locs.flatten().to_numpy(zero_copy_only=False), np.diff(locs.offsets.to_numpy())
        at = np.repeat(off[:-1], per) + (loc >> 16) + (loc & 255)
        lead = np.zeros(len(at), np.uint64)
        for k in range(8):
            lead = (lead << _U(8)) | data[at + k].astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array((lead >> _U(16)).astype(np.int64))], names=["lead"])


def _splitters(docs: DataFrame, wanted: DataFrame, total: int, n: int) -> np.ndarray:
    """n - 1 quantiles of the leading tokens of a bounded sample (by hash) of the `total` suffixes that are to be sorted."""
    if n < 2:
        return np.zeros(0, np.uint64)
    some = wanted.filter(F.pmod(F.xxhash64("uid", "loc"), F.lit(max(1, total // SPLITTER_RUNS))) == 0).groupBy("uid").agg(F.collect_list("loc").alias("locs"))
    leads = docs.select("uid", "text").join(F.broadcast(some), "uid").select("text", "locs").mapInArrow(_leads, "lead long")
    found = leads.agg(F.percentile_approx("lead", [k / n for k in range(1, n)], 20000).alias("p")).first()["p"]
    return np.sort(np.array(found or [], np.int64)).astype(np.uint64) << _U(16)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc_id, text, spans): what is left of each text."""
    for batch in batches:
        data, off = byte_view(as_binary(batch.column(1)))
        spans = batch.column(2)
        rows = []
        for i in range(batch.num_rows):
            text = data[off[i] : off[i + 1]]
            got = spans[i].as_py() if spans[i].is_valid else None
            merged: list[list[int]] = []
            if got:
                flat = np.array(got, np.int64)
                s, e = flat >> 32, flat & 0xFFFFFFFF
                o = np.argsort(s, kind="stable")
                s, e = s[o], np.maximum.accumulate(e[o])
                new = np.append(True, s[1:] > e[:-1])
                k = np.flatnonzero(new)
                merged = list(zip(s[k].tolist(), e[np.append(k[1:], len(s)) - 1].tolist(), strict=True))
            kept, at = hashlib.sha256(), 0
            for s0, e0 in merged:
                kept.update(text[at:s0])
                at = e0
            kept.update(text[at:])
            rows.append((len(text), sum(e0 - s0 for s0, e0 in merged), len(merged), kept.hexdigest(), merged))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()),
                pa.array([[{"s": a, "e": b} for a, b in m] for m in cols[4]], pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
        )


def repeated_substrings(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte ranges."""
    if not 2 * GRAM <= window <= 120:
        raise ValueError("window must be from 64 to 120 bytes")
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    base = with_order(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    runs = base.select("uid", "text").mapInArrow(_emit_runs(window, _frequent(base, window)), "h long, d1 long, d2 long, uid long, loc long, role byte")
    settled = stored(runs.repartition(n, "h").sortWithinPartitions("role", "h", "d1", "d2", "uid", "loc").mapInArrow(_settle, "uid long, loc long, kind byte"), "settled")

    suffixes_of = settled.filter("kind = 1")
    total = suffixes_of.count()
    splitters = _splitters(base, suffixes_of, total, max(n, -(-total // BUCKET_RUNS)))
    wanted = suffixes_of.groupBy("uid").agg(F.collect_list("loc").alias("locs"))
    suffixes = (
        base.select("uid", "text").join(wanted, "uid").select("uid", "text", "locs")
        .mapInArrow(_emit_suffixes(splitters, window), "bucket int, spans boolean, key long, uid long, loc long, ctx binary")
    )
    buckets, pieces = len(splitters) + 1, None
    if len(np.unique(splitters)) < len(splitters):
        suffixes = stored(suffixes, "suffixes")
        spread, pieces = _dealt(suffixes.filter("spans").select("key", "uid", "loc", "ctx"), max(SHARE, total // (2 * buckets)), buckets, window)
        suffixes = suffixes.filter("not spans").drop("key").unionByName(spread)
    else:
        suffixes = suffixes.drop("key")
    sorted_ = stored(suffixes.repartitionById(buckets, F.col("bucket")).mapInArrow(_sort_bucket(window), "kind byte, uid long, s long, e long, d1 long, d2 long"), "sorted")

    far = sorted_.filter("kind = 1").select("uid", "s", "e", "d1", "d2")
    least = far.groupBy("d1", "d2").agg(F.min(F.struct("uid", "s")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("d1", "d2", "first")
    across = far.join(least, ["d1", "d2"]).filter("uid != first.uid or s != first.s").select("uid", "s", "e")
    copies = settled.filter("kind = 0").select("uid", "loc")
    copies = (copies if pieces is None else copies.unionByName(pieces)).select("uid", F.shiftright("loc", 16).alias("s"), (F.shiftright("loc", 16) + F.shiftright("loc", 8).bitwiseAND(255) + (window - 1)).alias("e"))
    spans = copies.unionByName(sorted_.filter("kind = 0").select("uid", "s", "e")).unionByName(across)
    packed = spans.groupBy("uid").agg(F.collect_list(F.shiftleft("s", 32).bitwiseOR(F.col("e"))).alias("spans"))
    return base.join(packed, "uid", "left").select("doc_id", "text", "spans").mapInArrow(
        _finish, T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)] + T._parse_datatype_string("n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<s:long,e:long>>").fields)
    )


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    from strandline.llm.common import table

    return repeated_substrings(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


#: Windows are first thinned by a hash of their bytes, then compared as strings.
OP1_SQL = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
a as (select doc_id, p, hash(substr(h, 2 * p + 1, 200)) as k from (select doc_id, h, unnest(range(0, len(h) // 2 - 99)) as p from d where len(h) >= 200)),
w as (select a.doc_id, p, substr(h, 2 * p + 1, 200) as s from a join (select k from a group by k having count(*) > 1) using (k) join d on d.doc_id = a.doc_id),
r as (select doc_id, p from (select doc_id, p, row_number() over (partition by s order by doc_id, p) as n from w) where n > 1),
g as (select *, sum(case when prev is null or p > prev + 100 then 1 else 0 end) over (partition by doc_id order by p) as g from (select *, lag(p) over (partition by doc_id order by p) as prev from r)),
spans as (select doc_id, g, min(p) as s, max(p) + 100 as e from g group by doc_id, g),
cut as (select *, coalesce(lag(e) over (partition by doc_id order by s), 0) as before from spans),
kept as (select doc_id, count(*) as n_spans, sum(e - s) as n_removed, max(e) as last_e, string_agg(substr(any_h, 2 * before + 1, 2 * (s - before)), '' order by s) as head
  from (select cut.*, d.h as any_h from cut join d using (doc_id)) group by doc_id)
select d.doc_id, (len(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last_e, 0) + 1))) as kept_sha256 from d left join kept using (doc_id)
"""
