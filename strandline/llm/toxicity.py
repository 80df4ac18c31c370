"""Toxicity by a classifier chain with out-of-fold predictions.

The categories are predicted one after another: `junk` (labels.quality is 0), then `toxic` (labels.toxic is 1), the two
that the labels carry; any list of 0/1 label columns can be given. Each is a linear (logistic) model over word features
(whole words, first 4 and first 5 letters, present or not), the logarithm of the length, and the probabilities of the
earlier categories. In training, those probabilities come from models fitted on the other folds, so that a later model
sees them as unsure as they will be on new documents.

1. At most LABELLED labelled documents (least hashes of ids) train the chain. Features are counted for each fold and label
   in the tasks, and summed by key; the strongest FEATURES of each category and fold complement are kept.
2. The rows' kept features (a few numbers a row) go to the driver, where the models are fitted.
3. Every document is scored by set intersections with the kept features.

The threshold of a category is the one with the best F1 of the out-of-fold predictions. Null and empty texts have no
features and are scored by the intercepts. Labels without an id or with a null category are left out; a label counts for
every document of its id, within LABELLED. Without labelled documents every probability is 0.5 and nothing is toxic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.common import bounded, byte_view, stored, table, text_column, texts

LABELLED, FEATURES, FOLDS = 20_000, 1500, 3
LEAST_DOCS, RIDGE = 4, 1.0
#: Distinct features that a task holds before it passes their counts on.
HELD = 100_000
CATEGORIES = ("junk", "toxic")

_SPACES = bytes(32 if chr(c) in ".,;:!?\"'()[]{}<>|*#$%&/\\=+~^`_" or c < 33 else c for c in range(256))


def features(text: bytes) -> tuple[set[str], set[str], set[str], int]:
    words = text.translate(_SPACES).decode("utf-8", "replace").lower().split(" ")
    own = set(words)
    own.discard("")
    return own, {w[:4] for w in own if len(w) > 4}, {w[:5] for w in own if len(w) > 5}, len(words)


def _count(n_labels: int):
    """(fold, label ..., text) -> how many documents have a feature, by fold and label."""
    width = FOLDS * (n_labels + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[dict[str, int]] = [{}, {}, {}]  # by kind: feature -> its row of sums
        sums, n = np.zeros((1 << 14, width), np.int32), 0

        def passed_on():
            for kind, rows in enumerate(known):
                words = list(rows)
                for s in range(0, len(words), 20_000):
                    part = words[s : s + 20_000]
                    flat = sums[[rows[w] for w in part]].astype(np.int64).ravel()
                    ends = np.arange(len(part) + 1, dtype=np.int32) * width
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part, pa.string()), pa.ListArray.from_arrays(ends, pa.array(flat))], names=["kind", "word", "n"])
                rows.clear()

        for batch in batches:
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            y = np.stack([batch.column(1 + k).to_numpy(zero_copy_only=False) for k in range(n_labels)], axis=1)
            for i, _, values in texts(batch.column(1 + n_labels)):
                for k, text in enumerate(values, i):
                    rows = []
                    for kind, found in zip(known, features(text)[:3], strict=True):
                        for w in found:
                            at = kind.get(w)
                            if at is None:
                                at = kind[w] = n
                                n += 1
                            rows.append(at)
                    while n > len(sums):
                        sums = np.concatenate([sums, np.zeros_like(sums)])
                    at = fold[k] * (n_labels + 1)
                    sums[rows, at] += 1
                    for label in np.flatnonzero(y[k]):
                        sums[rows, at + 1 + label] += y[k, label]
                    if n > HELD:
                        yield from passed_on()
                        sums, n = np.zeros((1 << 14, width), np.int32), 0
        yield from passed_on()

    return run


def _extract(known: list[dict[str, int]], n_labels: int):
    """(id, fold, labels, text) -> the same with `has`, the kept features as packed 32-bit numbers, and the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [set(k) for k in known]
        for batch in batches:
            out, size = [], []
            for _, _, values in texts(batch.column(batch.num_columns - 1)):
                for text in values:
                    *sets, n = features(text)
                    out.append(np.array(sorted(known[k][w] for k in range(3) for w in sets[k] & keys[k]), np.int32).tobytes())
                    size.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.binary()), pa.array(size, pa.int64())], names=[*batch.schema.names[:-1], "has", "size"])

    return run


class Linear:
    """Logistic regression over sparse 0/1 features and a few dense columns, by L-BFGS with a ridge penalty."""

    def __init__(self, width: int, dense: int):
        self.w, self.d, self.b = np.zeros(width), np.zeros(dense), 0.0

    @staticmethod
    def _blocks(ptr: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
        """Row ranges of about `most` entries, so that no temporary is as long as all entries."""
        at, n = 0, len(ptr) - 1
        while at < n:
            end = min(n, max(at + 1, int(np.searchsorted(ptr, ptr[at] + most, "right")) - 1))
            yield at, end
            at = end

    @classmethod
    def _row_sums(cls, w: np.ndarray, idx: np.ndarray, ptr: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ptr) - 1)
        for a, b in cls._blocks(ptr):
            total = np.concatenate([[0.0], np.cumsum(w[idx[ptr[a] : ptr[b]]])])
            out[a:b] = total[ptr[a + 1 : b + 1] - ptr[a]] - total[ptr[a:b] - ptr[a]]
        return out

    @classmethod
    def _column_sums(cls, r: np.ndarray, idx: np.ndarray, ptr: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros(width)
        for a, b in cls._blocks(ptr):
            out += np.bincount(idx[ptr[a] : ptr[b]], np.repeat(r[a:b], np.diff(ptr[a : b + 1])), width)
        return out

    def margin(self, idx, ptr, dense):
        return self._row_sums(self.w, idx, ptr) + dense @ self.d + self.b

    def fit(self, idx, ptr, dense, y, allowed=None, ridge=RIDGE, steps=120):
        nw, nd = len(self.w), len(self.d)
        mask = np.ones(nw) if allowed is None else allowed.astype(float)

        def value(theta):
            w, d, b = theta[:nw] * mask, theta[nw : nw + nd], theta[-1]
            m = self._row_sums(w, idx, ptr) + dense @ d + b
            loss = np.logaddexp(0, m).sum() - (y * m).sum() + 0.5 * ridge * (w @ w + 0.1 * d @ d)
            r = 1 / (1 + np.exp(-np.clip(m, -35, 35))) - y
            grad = np.concatenate([(self._column_sums(r, idx, ptr, nw) + ridge * w) * mask, dense.T @ r + 0.1 * ridge * d, [r.sum()]])
            return loss, grad

        theta = np.zeros(nw + nd + 1)
        f, g = value(theta)
        past: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(steps):
            q, alphas = g.copy(), []
            for s, z in reversed(past):
                a = (s @ q) / (s @ z)
                alphas.append(a)
                q -= a * z
            if past:
                s, z = past[-1]
                q *= (s @ z) / (z @ z)
            else:
                q /= max(1.0, np.linalg.norm(q))
            for (s, z), a in zip(past, reversed(alphas), strict=True):
                q += (a - (z @ q) / (s @ z)) * s
            step = 1.0
            while step > 1e-8:
                new = theta - step * q
                f2, g2 = value(new)
                if f2 <= f - 1e-4 * step * (q @ g):
                    break
                step /= 2
            else:
                break
            s, z = new - theta, g2 - g
            if s @ z > 1e-10:
                past = [*past[-9:], (s, z)]
            done = f - f2 < 1e-7 * max(1.0, abs(f))
            theta, f, g = new, f2, g2
            if done:
                break
        self.w, self.d, self.b = theta[:nw] * mask, theta[nw : nw + nd], float(theta[-1])
        return self


def _sigmoid(m):
    return 1 / (1 + np.exp(-np.clip(m, -35, 35)))


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    if not y.sum():
        return 0.5
    o = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[o])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(p[o][1:] != p[o][:-1], True)  # equal scores are on one side
    k = int(np.where(last, f1, -1).argmax())
    low = p[o][k + 1] if k + 1 < len(p) else 0.0
    return float((p[o][k] + low) / 2)


class Chain:
    """Models of the categories in order, their features and thresholds."""

    def __init__(self, categories, known, models, thresholds):
        self.categories, self.known, self.models, self.thresholds = list(categories), known, models, thresholds

    def probabilities(self, idx, ptr, size) -> np.ndarray:
        dense, out = np.log1p(size.astype(float))[:, None] / 10, []
        for model in self.models:
            p = _sigmoid(model.margin(idx, ptr, dense))
            out.append(p)
            dense = np.column_stack([dense, p])
        return np.stack(out, axis=1) if out else np.zeros((len(size), 0))


def _strongest(counts: DataFrame, names: list[str], n: np.ndarray, k: int, f: int, most: int) -> list[tuple[int, str]]:
    """The (kind, word) of the `most` features that tell label k best without fold f (FOLDS: with all folds), by the z
    of the two shares; n: documents and labels by fold. Ranked on the executors; at most `most` rows come back."""
    width = n.shape[1]
    of = lambda j: sum((F.col(names[g * width + j]) for g in range(FOLDS) if g != f), F.lit(0).cast("long"))
    total = n.sum(axis=0) - (n[f] if f < FOLDS else 0)
    every, marked = float(total[0]), float(total[k + 1])
    if not marked or marked == every:
        return []
    docs, pos = of(0), of(k + 1)
    share = docs / every
    z = F.abs(pos / marked - (docs - pos) / (every - marked)) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / marked + 1 / (every - marked)))
    best = counts.filter(docs >= LEAST_DOCS).select("kind", "word", z.alias("z")).filter("z > 2").orderBy(F.desc("z"), "kind", "word").limit(most)
    return [(r["kind"], r["word"]) for r in best.select("kind", "word").collect()]


def learn(docs: DataFrame, labelled: DataFrame, categories: tuple[str, ...] = CATEGORIES, text_col: str = "text", id_col: str = "doc_id", most: int = LABELLED) -> Chain:
    """Fit the chain; labelled has the id and a 0/1 column for each category, and only rows with all of them count."""
    n = len(categories)
    full = labelled.filter(F.col(id_col).isNotNull())
    for c in categories:
        full = full.filter(F.col(c).isNotNull())
    chosen = full.select(F.col(id_col).alias("__id"), *[F.col(c).cast("int").alias(c) for c in categories]).distinct().orderBy(F.xxhash64("__id"), "__id", *categories).limit(most)
    own = bounded(docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "__id"), "__id", most)
    own = own.select("__id", F.pmod(F.xxhash64("__id", F.lit(3)), F.lit(FOLDS)).cast("int").alias("fold"), *categories, "text")
    width = FOLDS * (n + 1)
    counts = (
        own.select("fold", *categories, "text").mapInArrow(_count(n), "kind int, word string, n array<long>")
        .groupBy("kind", "word").agg(*[F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(width)])
        .filter(sum((F.col(f"n{f * (n + 1)}") for f in range(FOLDS)), F.lit(0)) >= LEAST_DOCS)
    )
    totals = np.zeros((FOLDS, n + 1), np.int64)
    for r in own.groupBy("fold").agg(F.count(F.lit(1)).alias("docs"), *[F.sum(c).alias(c) for c in categories]).collect():
        totals[r["fold"]] = [r["docs"], *[r[c] for c in categories]]
    counts = stored(counts, "features")
    names = [f"n{k}" for k in range(width)]
    chosen_of = [[_strongest(counts, names, totals, k, f, FEATURES) for f in range(FOLDS + 1)] for k in range(n)]
    used = sorted({key for x in chosen_of for y in x for key in y})
    place = {key: at for at, key in enumerate(used)}
    known: list[dict[str, int]] = [{}, {}, {}]
    for (kind, word), at in place.items():
        known[kind][word] = at
    schema = T.StructType([*own.drop("text").schema.fields, *T._parse_datatype_string("has binary, size long").fields])
    rows = own.mapInArrow(_extract(known, n), schema).orderBy("__id", *categories, "size", "has").toArrow()
    has = rows.column("has").combine_chunks().cast(pa.large_binary())
    packed, ptr = byte_view(has.chunk(0) if isinstance(has, pa.ChunkedArray) else has)
    idx, ptr = packed.view(np.int32), ptr // 4
    fold, dense = rows.column("fold").to_numpy(), np.log1p(rows.column("size").to_numpy().astype(float))[:, None] / 10

    def part(mask):
        keep = np.repeat(mask, np.diff(ptr))
        return idx[keep], np.concatenate([[0], np.cumsum(np.diff(ptr)[mask])])

    models, thresholds = [], []
    for k, c in enumerate(categories):
        y = rows.column(c).to_numpy().astype(float)
        flags = []
        for keys in chosen_of[k]:
            m = np.zeros(len(used), bool)
            m[[place[key] for key in keys]] = True
            flags.append(m)
        apart = np.full(len(y), y.mean() if len(y) else 0.0)
        if len(y):
            for f in range(FOLDS):
                train, test = fold != f, fold == f
                if train.any() and test.any():
                    i, p = part(train)
                    model = Linear(len(used), dense.shape[1]).fit(i, p, dense[train], y[train], flags[f])
                    i, p = part(test)
                    apart[test] = _sigmoid(model.margin(i, p, dense[test]))
        final = Linear(len(used), dense.shape[1])
        if len(y):
            final.fit(idx, ptr, dense, y, flags[FOLDS])
        models.append(final)
        thresholds.append(_best_threshold(apart, y))
        dense = np.column_stack([dense, apart])
    return Chain(categories, known, models, thresholds)


def classify(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """docs with p_<category> and is_<category> for each category; own columns of those names are replaced."""
    new = {**{f"p_{c}": "double" for c in chain.categories}, **{f"is_{c}": "boolean" for c in chain.categories}}
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def work():
        c = shared.value
        keys = [set(k) for k in c.known]

        def of(col: pa.Array) -> pa.Array:
            parts = [np.zeros((0, len(c.categories)))]
            for _, _, values in texts(col):
                has, size = [], []
                for text in values:
                    *sets, n = features(text)
                    has.append([c.known[k][w] for k in range(3) for w in sets[k] & keys[k]])
                    size.append(n)
                ptr = np.concatenate([[0], np.cumsum([len(x) for x in has])]).astype(np.int64)
                parts.append(c.probabilities(np.array([y for x in has for y in x], np.int64), ptr, np.array(size)))
            p = np.concatenate(parts)
            flags = p >= np.array(c.thresholds)[None, :]
            return pa.StructArray.from_arrays([*map(pa.array, p.T.copy()), *map(pa.array, flags.T.copy())], names=list(new))

        return of

    kept = docs.select(*[f"`{c}`" for c in docs.columns if c not in new], text_column(work, "struct<" + ",".join(f"`{n}`:{t}" for n, t in new.items()) + ">")(F.col(f"`{text_col}`").cast("string")).alias("__p"))
    return kept.select(*[f"`{c}`" for c in kept.columns[:-1]], *[F.col(f"__p.`{n}`").alias(n) for n in new])


def labels_of(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classify(docs, learn(docs, labels_of(spark, sf_dir)))
    return scored.select("doc_id", "p_junk", "p_toxic", F.col("is_toxic").alias("toxic"))
