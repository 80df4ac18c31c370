"""Language identification with interpolated Kneser-Ney character models, one for each language.

Text is read as lower-case letters; everything else is one space between words, and a text begins with spaces. Counts
of all 5-character strings are gathered over all learnable documents (aggregated in each task, then by key). From
those, each language gets discounted, interpolated probabilities of order 5 down to 1; lower orders use continuation
counts. The model is stored in sorted arrays of 64-bit hashes with one column of log-probabilities a language, so one
look-up a position serves all languages; strings that no language has seen back off through the context arrays.

The language with the least cross-entropy per character wins. `score` is a logistic function of the margin to the
second, fitted on a bounded set of documents that a first model leaves out; `rejected` marks texts whose cross-entropy is
beyond what that set shows for the language (mean and REJECT standard deviations).

Null texts and texts without a letter are `und` with score 0. A text of any length is read in pieces that carry the
characters before them, which changes no count and no score. Rows with equal ids are rows of their own; an empty table
or one without languages makes every prediction `und`.

No string is left out. The model is cut into blocks by the two characters before the last one: a string, its contexts
and what it backs off to lie in one block down to order 3, pairs of characters are in each block that needs them, and
single characters in all. The number of blocks grows with the number of strings, CELLS bounds the size of one.
Executors build the blocks; each is a broadcast of its own, and whoever scores holds one of them at a time.
"""

from __future__ import annotations

import pickle
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import stored, table, text_column, texts

ORDER = 5
#: Documents for calibration; distinct strings held in a task before they are passed on.
CALIBRATION, HELD = 4000, 2_000_000
#: Cells (strings of a language times columns) of one block of the model, and bytes of one row of its stored form.
CELLS, SLICE = 1 << 22, 1 << 22
REJECT = 6.0
PIECE = 400_000

_U = np.uint64
_P, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _fold_table() -> np.ndarray:
    """Code point -> its lower-case letter, or space; beyond the first plane, by `isalpha` when met."""
    out = np.full(65536, 32, np.uint32)
    for c in range(65536):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if unicodedata.category(ch)[0] in "LM":
            low = ch.lower()
            out[c] = ord(low[0]) if ord(low[0]) < 65536 else c
    return out


_FOLD = _fold_table()
_LETTER = np.array([0 if 0xD800 <= c < 0xE000 else chr(c).isalpha() for c in range(65536)], bool)


_START = np.full(ORDER - 1, 32, np.uint32)


def _folded(text: str) -> tuple[np.ndarray, bool]:
    """The folded code points, and whether one of them is a letter."""
    raw = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    wide = raw >= 65536
    if not wide.any():
        return _FOLD[raw], bool(_LETTER[raw].any())
    raw = raw.copy()
    far = np.array([c if chr(c).isalpha() else 32 for c in raw[wide].tolist()], np.uint32)
    raw[wide] = 32
    out, has = _FOLD[raw], bool(_LETTER[raw].any()) or bool((far != 32).any())
    out[wide] = far
    return out, has


def pieces(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(the ORDER - 1 codes before, codes with single spaces) for every piece of at most PIECE characters; none if the text
    has no letter. A piece goes on where the last one ended, so where a text is cut changes no count and no score."""
    starts = range(0, len(text), PIECE)
    if len(starts) > 1 and not any(_folded(text[s : s + PIECE])[1] for s in starts):
        return
    before = _START
    for s in starts:
        out, has = _folded(text[s : s + PIECE])
        if len(starts) == 1 and not has:
            return
        space = out == 32
        keep = ~space
        keep[1:] |= ~space[:-1]
        if s and before[-1] != 32:
            keep[0] = True
        elif not s:
            keep[0] = True
        out = out[keep]
        if len(out):
            yield before, out
            before = np.concatenate([before, out])[1 - ORDER :]


def codes(text: str) -> np.ndarray:
    """All codes of a text; empty if it has no letter."""
    return np.concatenate([np.zeros(0, np.uint32), *[c for _, c in pieces(text)]])


def _padded(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All codes, each piece after the codes before it, the positions of the pieces' own characters, and their piece."""
    lens = np.array([len(c) for _, c in held], np.int64)
    out = np.concatenate([np.zeros(0, np.uint32), *[x for piece in held for x in piece]])
    of = np.repeat(np.arange(len(held), dtype=np.int32), lens)
    pos = np.arange(int(lens.sum())) + (ORDER - 1) * (of + 1)
    return out, pos, of


def _keys(out: np.ndarray, pos: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n characters that end at each position."""
    c = out.astype(np.uint64) + _U(1)
    k = np.full(len(pos), _U(n))
    for i in range(n - 1, -1, -1):
        k = k * _P + c[pos - i]
    return _mixed(k)


def _mixed(k: np.ndarray) -> np.ndarray:
    k = (k ^ (k >> _U(30))) * _M1
    k = (k ^ (k >> _U(27))) * _M2
    return k ^ (k >> _U(31))


def _gram_keys(grams: np.ndarray) -> np.ndarray:
    """The same hash of the rows of a code matrix."""
    k = np.full(len(grams), _U(grams.shape[1]))
    for i in range(grams.shape[1]):
        k = k * _P + grams[:, i].astype(np.uint64) + _U(1)
    return _mixed(k)


def _batches_of(values: list, limit: int = 1 << 19) -> Iterator[tuple[list[int], list[tuple[np.ndarray, np.ndarray]]]]:
    """Groups of pieces of about `limit` characters: the rows they belong to, and the pieces."""
    rows: list[int] = []
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for i, raw in enumerate(values):
        for piece in pieces(raw.decode("utf-8", "replace")):
            rows.append(i)
            held.append(piece)
            size += len(piece[1])
            if size >= limit:
                yield rows, held
                rows, held, size = [], [], 0
    if rows:
        yield rows, held


def _add(held: list[np.ndarray], out: np.ndarray, pos: np.ndarray) -> None:
    """Add the strings that end at `pos` to sorted hashes, their strings and counts; only new strings are looked at."""
    keys = _keys(out, pos, ORDER)
    found, n = np.unique(keys, return_counts=True)
    at = np.searchsorted(held[0], found)
    known = held[0][np.minimum(at, len(held[0]) - 1)] == found if len(held[0]) else np.zeros(len(found), bool)
    held[2][at[known]] += n[known]
    new = found[~known]
    if len(new):
        place = np.minimum(np.searchsorted(new, keys), len(new) - 1)
        rows = np.flatnonzero(new[place] == keys)
        some = np.empty(len(new), np.int64)
        some[place[rows]] = pos[rows]
        for k, values in enumerate((new, out[some[:, None] + np.arange(1 - ORDER, 1)], n[~known])):
            held[k] = np.insert(held[k], at[~known], values, axis=0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, gram, n), summed within the task."""
    sums: dict[str, list[np.ndarray]] = {}

    def passed_on():
        for lang, (_, grams, counts) in sums.items():
            text = np.ascontiguousarray(grams).tobytes().decode("utf-32-le")
            for s in range(0, len(counts), 50_000):
                e = min(len(counts), s + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (e - s), pa.string()), pa.array([text[i : i + ORDER] for i in range(s * ORDER, e * ORDER, ORDER)], pa.string()), pa.array(counts[s:e])],
                    names=["lang", "gram", "n"],
                )
        sums.clear()

    for batch in batches:
        every = np.array(batch.column(0).to_pylist(), object)
        for i, j, values in texts(batch.column(1), 1 << 23):
            langs = every[i:j]
            for lang, held in ((lang, held) for lang in sorted(set(langs)) for _, held in _batches_of([values[k] for k in np.flatnonzero(langs == lang)])):
                out, pos, _ = _padded(held)
                _add(sums.setdefault(lang, [np.zeros(0, np.uint64), np.zeros((0, ORDER), np.uint32), np.zeros(0, np.int64)]), out, pos)
        if sum(len(s[0]) for s in sums.values()) > HELD:
            yield from passed_on()
    yield from passed_on()


def _discount(once: float, twice: float) -> float:
    return min(max(once / (once + 2 * twice) if once else 0.5, 0.05), 0.95)


def _pairs(before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """The character before the last one, and the one before that, as one number."""
    return before.astype(np.int64) << 21 | earlier.astype(np.int64)


class KneserNey:
    """Interpolated Kneser-Ney models of several languages in sorted hash arrays."""

    def __init__(
        self,
        counts: dict[str, tuple[np.ndarray, np.ndarray]],
        discounts: dict[tuple[str, int], float] | None = None,
        given: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] | None = None,
        floor: float | None = None,
    ):
        """counts: for each language, the code matrix of its strings and their counts. For one block of a model: the
        discounts, the strings of orders that reach beyond the block, and the floor."""
        self.langs = sorted(counts)
        self._starts: dict[tuple[str, int], tuple[np.uint64, np.ndarray]] = {}
        own: list[list[tuple]] = []
        seen: list[list[np.ndarray]] = [[] for _ in range(ORDER + 1)]
        chars: set[int] = set()
        for lang in self.langs:
            grams, n = counts[lang]
            chars.update(np.unique(grams).tolist())
            levels = []
            for order in range(ORDER, 0, -1):
                grams, n = (given or {}).get((lang, order), (grams, n))
                keys = _gram_keys(grams)
                context, at = np.unique(_gram_keys(grams[:, :-1]) if order > 1 else np.zeros(len(grams), np.uint64), return_inverse=True)
                total = np.bincount(at, n)
                once, twice = float((n == 1).sum()), float((n == 2).sum())
                d = _discount(once, twice) if discounts is None else discounts[lang, order]
                weight = d * np.bincount(at) / total
                levels.append((order, keys, grams, np.maximum(n - d, 0) / total[at], context, weight))
                seen[order].append(grams)
                # continuation counts: how many different characters come before
                shorter, back = np.unique(_gram_keys(grams[:, 1:]) if order > 1 else np.zeros(len(grams), np.uint64), return_inverse=True)
                if order > 1:
                    pick = np.zeros(len(shorter), np.int64)
                    pick[back] = np.arange(len(back))
                    grams, n = grams[pick, 1:], np.bincount(back).astype(np.float64)
            own.append(levels)
        self.floor = float(np.log(1 / (len(chars) + 1))) if floor is None else floor
        self.keys: list[np.ndarray] = [np.zeros(0, np.uint64)] * (ORDER + 1)
        self.logp: list[np.ndarray] = [np.zeros((0, len(self.langs)), np.float32)] * (ORDER + 1)
        self.contexts: list[np.ndarray] = [np.zeros(0, np.uint64)] * (ORDER + 1)
        self.backoff: list[np.ndarray] = [np.zeros((0, len(self.langs)), np.float32)] * (ORDER + 1)
        for order in range(1, ORDER + 1):
            if not self.langs:
                continue
            grams = np.concatenate(seen[order])
            keys, first = np.unique(_gram_keys(grams), return_index=True)
            grams = grams[first]
            level = [x[ORDER - order] for x in own]
            contexts = np.unique(np.concatenate([x[4] for x in level]))
            backoff = np.zeros((len(contexts), len(self.langs)))
            for k, x in enumerate(level):
                backoff[np.searchsorted(contexts, x[4]), k] = np.log(x[5])
            lower = np.exp(self._below(order - 1, grams[:, 1:]))
            at = np.searchsorted(contexts, _gram_keys(grams[:, :-1]) if order > 1 else np.zeros(len(grams), np.uint64))
            prob = np.exp(backoff[at]) * lower
            for k, x in enumerate(level):
                prob[np.searchsorted(keys, x[1]), k] += x[3]
            self.keys[order], self.logp[order] = keys, np.log(prob).astype(np.float32)
            self.contexts[order], self.backoff[order] = contexts, backoff.astype(np.float32)

    def __getstate__(self):
        return vars(self) | {"_starts": {}}

    def _find(self, kind: str, n: int, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of hashes in a sorted array, and whether they are there. Hashes are spread evenly, so their first bits
        give a place from which it is a step or two; a binary search would touch far more memory."""
        table = getattr(self, kind)[n]
        if not len(table):
            return np.zeros(len(k), np.int64), np.zeros(len(k), bool)
        if (kind, n) not in self._starts:
            bits = len(table).bit_length() + 1
            shift = np.uint64(64 - bits)
            self._starts[kind, n] = shift, np.minimum(np.searchsorted(table, np.arange(1 << bits, dtype=np.uint64) << shift), len(table) - 1)
        shift, starts = self._starts[kind, n]
        at = starts[k >> shift]
        rows = np.flatnonzero(table[at] < k)
        while len(rows):
            rows = rows[at[rows] < len(table) - 1]
            at[rows] += 1
            rows = rows[table[at[rows]] < k[rows]]
        return at, table[at] == k

    def _below(self, order: int, grams: np.ndarray) -> np.ndarray:
        """Log-probabilities of the last character of each row by the model of this order."""
        if order == 0:
            return np.full((len(grams), len(self.langs)), self.floor)
        return self._look(order, _gram_keys(grams), lambda rows, n: _gram_keys(grams[rows][:, :-1]) if n > 1 else np.zeros(len(rows), np.uint64), lambda rows, n: _gram_keys(grams[rows][:, order - n :]))

    def _look(self, order, keys, context_of, key_of) -> np.ndarray:
        at, hit = self._find("keys", order, keys)
        found = self.logp[order].take(at, axis=0) if len(self.logp[order]) else np.zeros((len(keys), len(self.langs)), np.float32)
        rows = np.flatnonzero(~hit)
        found[rows] = 0
        for n in range(order, 0, -1):  # what is not there backs off: its context's weight, and the next order
            if n < order:
                at, hit = self._find("keys", n, key_of(rows, n))
                found[rows[hit]] += self.logp[n][at[hit]]
                rows = rows[~hit]
            if not len(rows):
                return found
            at, known = self._find("contexts", n, context_of(rows, n))
            found[rows[known]] += self.backoff[n][at[known]]
        found[rows] += self.floor
        return found

    def score(self, out: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Log-probability of the character at each position, a column a language."""
        return self._look(
            ORDER, _keys(out, pos, ORDER), lambda rows, n: _keys(out, pos[rows] - 1, n - 1) if n > 1 else np.zeros(len(rows), np.uint64), lambda rows, n: _keys(out, pos[rows], n)
        )

    def entropies(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text for each language, and the number of characters."""
        return _entropies_of(self.langs, [], lambda _: self, values)


def _entropies_of(langs: list[str], cuts: list[int], part_of, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts are folded once; then one block of the model after the other scores the positions that lie in it."""
    total, n = np.zeros((len(values), len(langs))), np.zeros(len(values), np.int64)
    waiting: list[tuple] = []
    for rows, held in _batches_of(values):
        out, pos, of = _padded(held)
        index = np.array(rows)
        np.add.at(n, index, [len(c) for _, c in held])
        block = np.searchsorted(np.array(cuts), _pairs(out[pos - 1], out[pos - 2]), "right").astype(np.int16) if cuts else None
        waiting.append((out, pos.astype(np.int32), of, index, block))
    for b in range(len(cuts) + 1):
        if not waiting:
            break
        part = part_of(b)
        for out, pos, of, index, block in waiting:
            mine = np.arange(len(pos)) if block is None else np.flatnonzero(block == b)
            for s in range(0, len(mine), 1 << 18):
                use = mine[s : s + (1 << 18)]
                logp, o = part.score(out, pos[use]), of[use]
                cut = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
                np.add.at(total, index[o[cut]], np.add.reduceat(logp, cut, axis=0, dtype=np.float64))
    return -total / np.maximum(n, 1)[:, None], n


class Blocks:
    """A model in blocks, each the broadcast bytes of a KneserNey; cuts are the first pairs of all blocks but the first."""

    def __init__(self, langs: list[str], parts: list, cuts: list[int]):
        self.langs, self.parts, self.cuts = langs, parts, cuts
        self._loaded = None

    def __getstate__(self):
        return vars(self) | {"_loaded": None}

    def _part(self, b: int) -> KneserNey:
        if len(self.parts) > 1:
            part = pickle.loads(self.parts[b].value)
            vars(self.parts[b]).pop("_value", None)  # the loaded bytes; the broadcast's file stays and is read again
            return part
        if self._loaded is None:
            self._loaded = pickle.loads(self.parts[b].value)
        return self._loaded

    def entropies(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return _entropies_of(self.langs, self.cuts, self._part, values)


def _matrix(grams, order: int) -> np.ndarray:
    return np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, order)


def _build_block(langs: list[str], discounts: dict, ones: dict, floor: float):
    """Rows (block, lang, gram, n) of orders ORDER and 2 of one block -> its pickled KneserNey in slices."""

    def run(rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        lang, gram = (np.array(rows.column(c).to_pylist(), object) for c in ("lang", "gram"))
        n, order = rows.column("n").to_numpy().astype(np.float64), np.fromiter(map(len, gram), np.int64, len(gram))
        counts, given = {}, dict(ones)
        for k in langs:
            for size in (ORDER, 2):
                use = (lang == k) & (order == size)
                got = (_matrix(gram[use], size), n[use])
                if size == ORDER:
                    counts[k] = got
                else:
                    given[k, 2] = got
        whole = pickle.dumps(KneserNey(counts, discounts, given, floor), 5)
        data = [whole[s : s + SLICE] for s in range(0, len(whole), SLICE)]
        return pa.table({"block": pa.array([block] * len(data), pa.int32()), "k": pa.array(range(len(data)), pa.int32()), "data": pa.array(data, pa.binary())})

    return run


def build(grams: DataFrame) -> Blocks:
    """The model of all strings of grams (lang, gram, n)."""
    spark = grams.sparkSession
    levels = {ORDER: grams}
    for order in range(ORDER - 1, 0, -1):  # continuation counts: how many different characters come before
        levels[order] = levels[order + 1].groupBy("lang", F.substring("gram", 2, order).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    levels[2] = stored(levels[2], "grams-2")
    levels[1] = levels[2].groupBy("lang", F.substring("gram", 2, 1).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    many = None
    for order, level in levels.items():
        part = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"), F.count(F.lit(1)).alias("m")).withColumn("order", F.lit(order))
        many = part if many is None else many.unionByName(part)
    stats = many.collect()
    discounts = {(r["lang"], r["order"]): _discount(r["once"], r["twice"]) for r in stats}
    langs = sorted({r["lang"] for r in stats})
    if not langs:
        return Blocks([], [], [])
    single = levels[1].toPandas()
    ones = {}
    for k in langs:
        mine = single[single["lang"] == k]
        ones[k, 1] = (_matrix(mine["gram"], 1), mine["n"].to_numpy(np.float64))
    floor = float(np.log(1 / (len({*single["gram"], " "}) + 1)))
    code = lambda at: F.ascii(F.substring("gram", at, 1)).cast("long")
    pair = code(ORDER - 1) * (1 << 21) + code(ORDER - 2)
    blocks = -(-sum(r["m"] for r in stats if r["order"] == ORDER) * (len(langs) + 2) // CELLS)
    cuts: list[int] = []
    if blocks > 1:
        keyed = grams.select(pair.cast("double").alias("p"))
        quantiles = keyed.approxQuantile("p", [k / blocks for k in range(blocks)], 0.1 / blocks)
        least = keyed.agg(F.min("p").alias("p")).first()["p"]
        cuts = sorted({int(q) for q in quantiles if q > least})
    block_of = lambda p: F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= p)) if cuts else F.lit(0)
    first = code(1) * (1 << 21)
    twos = levels[2].withColumn("block", F.explode(F.sequence(block_of(first), block_of(first + ((1 << 21) - 1)))))
    rows = grams.withColumn("block", block_of(pair)).unionByName(twos).select("block", "lang", "gram", "n")
    made = stored(rows.groupBy("block").applyInArrow(_build_block(langs, discounts, ones, floor), "block int, k int, data binary"), "model")
    parts = []
    for b in range(len(cuts) + 1):
        whole = b"".join(r["data"] for r in made.filter(F.col("block") == b).orderBy("k").collect())
        parts.append(spark.sparkContext.broadcast(whole))
    return Blocks(langs, parts, cuts)


class Identifier:
    """The models with the calibration of scores and of rejection."""

    def __init__(self, model: KneserNey | Blocks, h: np.ndarray | None = None, n: np.ndarray | None = None, langs: list[str] = ()):
        """h, n, langs: cross-entropies by the model, characters and true languages of the texts to calibrate with."""
        self.model, self.slope, self.shift = model, 8.0, 0.0
        self.limit = np.full(len(model.langs), np.inf)
        if not len(langs) or not model.langs:
            return
        use = n > 0
        if not use.any():
            return
        h, n, truth = h[use], n[use], np.array(langs, object)[use]
        best = h.argmin(axis=1)
        right = np.array([model.langs[b] == t for b, t in zip(best, truth, strict=True)], float)
        x = self._margin(h, n)
        a, b = self.slope, self.shift
        for _ in range(300):  # logistic regression, held near its start by a small penalty
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            a -= 0.5 * (((p - right) * x).mean() + 1e-3 * (a - 8.0))
            b -= 0.5 * ((p - right).mean() + 1e-3 * b)
        self.slope, self.shift = max(a, 0.1), b
        for k in range(len(model.langs)):
            mine = h[(best == k) & (right > 0), k]
            if len(mine) >= 20:
                self.limit[k] = mine.mean() + REJECT * mine.std()

    @staticmethod
    def _margin(h: np.ndarray, n: np.ndarray) -> np.ndarray:
        if h.shape[1] < 2:
            return np.ones(len(h))
        two = np.partition(h, 1, axis=1)[:, :2]
        return (two[:, 1] - two[:, 0]) * np.sqrt(np.minimum(n, 400) / 20)

    def with_model(self, model: KneserNey | Blocks) -> Identifier:
        """The same calibration for another model; a language that it did not know is never rejected."""
        out = Identifier(model)
        out.slope, out.shift = self.slope, self.shift
        known = dict(zip(self.model.langs, self.limit, strict=True))
        out.limit = np.array([known.get(k, np.inf) for k in model.langs])
        return out

    def predict(self, values: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and rejection of each text."""
        if not self.model.langs:
            none = np.zeros(len(values))
            return ["und"] * len(values), none, none, np.zeros(len(values), bool)
        h, n = self.model.entropies(values)
        best = h.argmin(axis=1)
        least = h[np.arange(len(h)), best]
        score = 1 / (1 + np.exp(-np.clip(self.slope * self._margin(h, n) + self.shift, -30, 30)))
        langs = [self.model.langs[b] if k else "und" for b, k in zip(best, n, strict=True)]
        return langs, np.where(n > 0, score, 0.0), np.where(n > 0, least, 0.0), (n > 0) & (least > self.limit[best])


def _grams(rows: DataFrame) -> DataFrame:
    return rows.select("lang", "text").mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a few MB of text, the last column, with their texts."""
    for batch in batches:
        for i, j, values in texts(batch.column(batch.num_columns - 1), 1 << 22):
            yield batch.slice(i, j - i), values


def _entropies(model: Blocks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values in _parts(batches):
            h, n = model.entropies(values)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(h), pa.list_(pa.float64())), pa.array(n)], names=["lang", "h", "n"])

    return run


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Identifier:
    """Learn from all rows of docs that have a text and a language. At most CALIBRATION different ones, chosen by the hashes of
    whole rows, are left out of a first model and calibrate scores and rejection with it; the model that predicts has
    their counts too. Ids may repeat: equal rows count once for the calibration."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang is not null and text is not null")
    rows = rows.withColumn("h", F.xxhash64("id", "lang", "text"))
    drawn = F.expr("crc32(cast(concat('calibrate', id) as binary)) % 20 = 0")
    last = rows.filter(drawn).select("h").distinct().orderBy("h").limit(CALIBRATION).agg(F.max("h").alias("h")).first()["h"]
    if last is None:
        return Identifier(build(stored(_grams(rows), "grams")))
    held = F.coalesce(drawn & (F.col("h") <= last), F.lit(False))
    first = stored(_grams(rows.filter(~held)), "grams")
    model = build(first)
    found = rows.filter(held).dropDuplicates(["h"]).select("lang", "text").mapInArrow(_entropies(model), "lang string, h array<double>, n long").collect() if model.langs else []
    calibrated = Identifier(model, np.array([r["h"] for r in found]).reshape(-1, len(model.langs)), np.array([r["n"] for r in found], np.int64), [r["lang"] for r in found])
    model.parts = []  # the driver's copies of the first model's blocks can go
    every = first.unionByName(_grams(rows.filter(held))).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return calibrated.with_model(build(stored(every, "grams")))


def identify(docs: DataFrame, known: Identifier, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score, entropy and rejected; own columns of those names are replaced."""
    new = ("lang_pred", "score", "entropy", "rejected")

    def of(col: pa.Array) -> pa.Array:
        got = [known.predict(values) for _, _, values in texts(col, 1 << 22)]
        langs = pa.array([x for g in got for x in g[0]], pa.string())
        return pa.StructArray.from_arrays([langs, *[pa.array(np.concatenate([np.zeros(0, kind), *[g[k] for g in got]])) for k, kind in ((1, float), (2, float), (3, bool))]], names=list(new))

    found = text_column(lambda: of, "struct<lang_pred:string,score:double,entropy:double,rejected:boolean>")(F.col(f"`{text_col}`").cast("string"))
    kept = docs.select(*[f"`{c}`" for c in docs.columns if c not in new], found.alias("__found"))
    return kept.select(*[f"`{c}`" for c in kept.columns[:-1]], *[F.col(f"__found.{c}").alias(c) for c in new])


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    # without an id a row can't be shown to be learnable
    known = learn(docs.filter(F.col("doc_id").isNotNull() & ~held_out))
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), known).drop("text")
