"""Quality classifier: a sparse rule ensemble over document statistics, compiled to Spark columns.

1. One pass over each whole text gives statistics (`STATISTICS`).
2. Labelled documents (at most LABELLED, those with the least hashes of their ids) train shallow boosted trees; every path
   from a root to a node is a conjunctive rule over the statistics.
3. A lasso logistic regression over the rules (proximal gradient steps) keeps a few of them; its penalty is chosen on a
   fifth of the labelled rows.
4. The rules are compiled to one Spark column expression, so scoring needs no Python beyond the statistics.

Null and empty texts have all statistics zero and are scored by the rules like any other text. A label counts for every
document of its id, within LABELLED; rows with equal ids are scored alike only if their texts are. With too few labels,
or labels of one kind, every score is their rate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import bounded, table, text_column, texts

#: The most labelled rows that train the model.
LABELLED = 20_000
TREES, DEPTH, RATE, BINS, LEAST_LEAF = 40, 3, 0.3, 32, 20
PENALTIES = (0.03, 0.01, 0.003, 0.001)

STATISTICS = (
    "n_words", "word_length", "long_words", "short_words", "distinct_words", "upper", "digits", "symbols", "stops", "exclaims", "marks",
    "repeated_lines", "line_words", "stopped_lines", "repeated_windows", "most_common_word",
)

# classes of bytes: 1 upper-case letter, 2 digit, 3 symbol, 4 full stop and comma, 5 exclamation mark, 6 other marks, 7 lower-case or non-ASCII
_CLASS = np.zeros(256, np.uint8)
_CLASS[128:] = 7
for _k, _chars in ((1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b"0123456789"), (3, b"#*$%&|<>"), (4, b".,"), (5, b"!"), (6, b"()[]{}'\"?:;@/\\^~`_+=-"), (7, b"abcdefghijklmnopqrstuvwxyz")):
    _CLASS[list(_chars)] = _k


def statistics(text: bytes) -> tuple[float, ...]:
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    kinds = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=8) / len(text)
    lens = np.fromiter(map(len, words), np.int64, n)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    return (
        float(n), float(lens.mean()), float((lens > 12).mean()), float((lens < 4).mean()), len(seen) / n, float(kinds[1]), float(kinds[2]), float(kinds[3]), float(kinds[4]),
        float(kinds[5]), float(kinds[6]), 1 - len(set(lines)) / len(lines), n / len(lines), sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines),
        1 - len(set(windows)) / len(windows) if windows else 0.0, max(seen.values()) / n,
    )


def _measured(col: pa.Array) -> pa.Array:
    rows = [statistics(t) for _, _, values in texts(col) for t in values]
    columns = np.array(rows, np.float64).reshape(len(rows), len(STATISTICS)).T
    return pa.StructArray.from_arrays([pa.array(c.copy()) for c in columns], names=[f"q_{s}" for s in STATISTICS])


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with a column q_<name> for each statistic; own columns of those names are replaced."""
    names = [f"q_{s}" for s in STATISTICS]
    measure = text_column(lambda: _measured, "struct<" + ",".join(f"{n}:double" for n in names) + ">")
    kept = docs.select(*[f"`{c}`" for c in docs.columns if c not in names], measure(F.col(f"`{text_col}`").cast("string")).alias("__q"))
    return kept.select(*[f"`{c}`" for c in kept.columns[:-1]], *[F.col(f"__q.{n}").alias(n) for n in names])


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, greater, threshold) ... all must hold


def _tree(binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, rules: set[Rule], out: np.ndarray) -> None:
    """Grow one tree on gradients; add its paths to rules and its leaf values to out."""

    def grow(rows: np.ndarray, path: Rule, depth: int):
        if path:
            rules.add(tuple(sorted(path)))
        best = (1e-6, -1, -1)
        if depth < DEPTH and len(rows) >= 2 * LEAST_LEAF:
            total_g, total_h = g[rows].sum(), h[rows].sum()
            base = total_g**2 / (total_h + 1)
            for f in range(binned.shape[1]):
                b = binned[rows, f]
                n = np.bincount(b, minlength=BINS)
                sg, sh, sn = (np.cumsum(x)[:-1] for x in (np.bincount(b, g[rows], BINS), np.bincount(b, h[rows], BINS), n))
                gain = sg**2 / (sh + 1) + (total_g - sg) ** 2 / (total_h - sh + 1) - base
                gain[(sn < LEAST_LEAF) | (len(rows) - sn < LEAST_LEAF)] = -1
                gain = gain[: len(edges[f])]
                if len(gain) and gain.max() > best[0]:
                    best = (float(gain.max()), f, int(gain.argmax()))
        if best[1] < 0:
            out[rows] -= RATE * g[rows].sum() / (h[rows].sum() + 1)
            return
        _, f, k = best
        left = binned[rows, f] <= k
        grow(rows[left], (*path, (f, False, float(edges[f][k]))), depth + 1)
        grow(rows[~left], (*path, (f, True, float(edges[f][k]))), depth + 1)

    grow(np.arange(len(g)), (), 0)


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The paths of boosted trees as rules."""
    edges, binned = [], np.zeros(x.shape, np.int64)
    for f in range(x.shape[1]):
        cut = np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS))
        edges.append(cut)
        binned[:, f] = np.searchsorted(cut, x[:, f], "left")  # value <= edge k: bin <= k
    rules: set[Rule] = set()
    rate = np.clip(y.mean(), 0.01, 0.99)
    out = np.full(len(y), np.log(rate / (1 - rate)))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-out))
        _tree(binned, edges, p - y, p * (1 - p), rules, out)
    return sorted(rules)


def apply_rules(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    out = np.ones((len(x), len(rules)), np.float32)
    for k, rule in enumerate(rules):
        for f, greater, at in rule:
            out[:, k] *= (x[:, f] > at) if greater else (x[:, f] <= at)
    return out


def lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 250) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 penalty, by accelerated proximal gradient steps; the intercept is free."""
    n, m = r.shape
    rate = np.clip(y.mean(), 0.01, 0.99)
    w, b = np.zeros(m, np.float32), float(np.log(rate / (1 - rate)))
    scale = np.sqrt((r * r).sum(axis=0).max() * m / n) + 1
    v = np.random.default_rng(0).random(m).astype(np.float32)
    for _ in range(12):  # the largest eigenvalue bounds the step
        v = r.T @ (r @ v) / n
        scale = float(np.linalg.norm(v))
        if scale == 0:
            return w, b
        v /= scale
    step = 4 / (1.1 * scale + 1)
    prev, pb, t = w.copy(), b, 1.0
    for _ in range(steps):
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = w + (t - 1) / t2 * (w - prev), b + (t - 1) / t2 * (b - pb)
        prev, pb, t = w, b, t2
        d = (1 / (1 + np.exp(-(r @ z + zb))) - y).astype(np.float32)
        w = z - step * (r.T @ d) / n
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        b = zb - step * float(d.mean())
    return w, b


class RuleModel:
    def __init__(self, rules: list[Rule], weights: list[float], shift: float):
        self.rules, self.weights, self.shift = rules, weights, shift

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> RuleModel:
        if len(y) < 4 * LEAST_LEAF or y.min() == y.max():
            rate = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
            return cls([], [], float(np.log(rate / (1 - rate))))
        rules = tree_rules(x, y)
        r = apply_rules(x, rules)
        fifth = np.arange(len(y)) % 5 == 0
        loss = {}
        for penalty in PENALTIES:
            w, b = lasso(r[~fifth], y[~fifth], penalty)
            p = np.clip(1 / (1 + np.exp(-(r[fifth] @ w + b))), 1e-6, 1 - 1e-6)
            loss[penalty] = -(y[fifth] * np.log(p) + (1 - y[fifth]) * np.log(1 - p)).mean()
        w, b = lasso(r, y, min(loss, key=loss.get))
        kept = np.flatnonzero(np.abs(w) > 1e-4)
        return cls([rules[k] for k in kept], [float(w[k]) for k in kept], b)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.shift)
        if self.rules:
            out += apply_rules(x, self.rules) @ np.array(self.weights)
        return 1 / (1 + np.exp(-out))

    def column(self) -> Column:
        """The score as an expression over the columns of `with_statistics`."""
        total = F.lit(float(self.shift))
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for f, greater, at in rule:
                c = F.col(f"q_{STATISTICS[f]}")
                holds = holds & (c > F.lit(at) if greater else c <= F.lit(at))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def learn(docs: DataFrame, labelled: DataFrame, label: str = "quality", text_col: str = "text", id_col: str = "doc_id", most: int = LABELLED) -> RuleModel:
    """Fit on at most `most` labelled rows (id, label 0 or 1); rows without a label or an id are left out."""
    chosen = labelled.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__y")).distinct().orderBy(F.xxhash64("__id"), "__id", "__y").limit(most)
    own = bounded(docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "__id"), "__id", most)
    names = [f"q_{s}" for s in STATISTICS]
    got = with_statistics(own).select("__id", "__y", *names).toPandas().sort_values(["__id", "__y", *names])
    return RuleModel.fit(got[names].to_numpy(np.float64), got["__y"].to_numpy(np.float64))


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = learn(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = with_statistics(docs).withColumn("score", model.column())
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
