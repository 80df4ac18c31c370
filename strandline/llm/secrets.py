"""Secret scan: fixed patterns and probabilistic automata inferred from labelled credentials.

Base kinds (assign, access, hex) are fixed patterns. The method adds the kind `format`: every run of 16 or more
credential characters outside base spans is a candidate; it is added if the automaton of some format accepts it with a
likelihood per character that beats the background model of ordinary tokens. Where the whole run does not, all its
sub-runs of 16 or more characters that begin and end at a sign (SPLIT) or at the run's ends are candidates; accepted
ones that overlap are one span.

Inference (ALERGIA): labelled examples of a format form a prefix tree with counts; states are merged in order of depth
if the Hoeffding bound finds their end and transition frequencies compatible, and so are their successors; a merge
folds the subtrees. The result is a deterministic automaton with probabilities.

Nulls and empty texts have no spans. Spans are code points, end exclusive. A text of any length is scanned whole, as
bytes; only the candidates are looked at by Python code. Rows with equal ids are rows of their own, an own column `found`
is replaced, other columns stay.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import as_binary, byte_view, chunks, table, text_column

KINDS = ("assign", "access", "hex", "format")
#: Characters of a candidate, the least length, and literal characters at its start before classes take over.
CANDIDATE, SHORTEST, LITERAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-", 16, 4
#: Signs beside which a sub-run may begin or end.
SPLIT = frozenset("+/_.=-")
#: Least log-likelihood ratio per character against the background.
THRESHOLD = 0.6
ALPHA = 0.05

_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_TABLE = np.zeros(256, np.uint8)
_TABLE[list(CANDIDATE)] = 1


def symbols(token: str) -> list[str]:
    """The first characters as they are, then classes: x hexadecimal letter, l, u, d, or the sign itself."""
    out = list(token[:LITERAL])
    for c in token[LITERAL:]:
        out.append("d" if c.isdigit() else "x" if c in "abcdef" else "l" if c.islower() else "u" if c.isupper() else c)
    return out


class Automaton:
    """A probabilistic deterministic automaton; state 0 is the start."""

    def __init__(self, counts: list[int], ends: list[int], edges: list[dict[str, list[int]]]):
        self.counts, self.ends, self.edges = counts, ends, edges  # edges: symbol -> [state, count]

    @classmethod
    def infer(cls, words: list[list[str]], alpha: float = ALPHA) -> Automaton:
        counts, ends, edges = [0], [0], [{}]
        for w in words:
            at = 0
            counts[0] += 1
            for s in w:
                if s not in edges[at]:
                    edges[at][s] = [len(counts), 0]
                    counts.append(0)
                    ends.append(0)
                    edges.append({})
                edges[at][s][1] += 1
                at = edges[at][s][0]
                counts[at] += 1
            ends[at] += 1
        bound = math.sqrt(0.5 * math.log(2 / alpha))

        def differ(f1, n1, f2, n2):
            return abs(f1 / n1 - f2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

        def compatible(a, b):
            todo = [(a, b)]
            while todo:
                p, q = todo.pop()
                if not counts[p] or not counts[q]:
                    continue
                if differ(ends[p], counts[p], ends[q], counts[q]):
                    return False
                for s in edges[p].keys() | edges[q].keys():
                    x, y = edges[p].get(s), edges[q].get(s)
                    if differ(x[1] if x else 0, counts[p], y[1] if y else 0, counts[q]):
                        return False
                    if x and y and x[0] != y[0]:
                        todo.append((x[0], y[0]))
            return True

        def fold(a, b):
            todo = [(a, b)]
            while todo:
                p, q = todo.pop()
                if p == q:
                    continue
                counts[p] += counts[q]
                ends[p] += ends[q]
                for s, (to, n) in edges[q].items():
                    if s in edges[p]:
                        edges[p][s][1] += n
                        todo.append((edges[p][s][0], to))
                    else:
                        edges[p][s] = [to, n]

        red, blue = [0], [(0, s) for s in sorted(edges[0])]
        while blue:
            p, s = blue.pop(0)
            b = edges[p][s][0]
            if b in red:
                continue
            into = next((r for r in red if compatible(r, b)), None)
            if into is None:
                red.append(b)
            else:
                edges[p][s][0] = into
                fold(into, b)
            blue = [(r, x) for r in red for x in sorted(edges[r]) if edges[r][x][0] not in red]
        number = {r: k for k, r in enumerate(red)}
        return cls([counts[r] for r in red], [ends[r] for r in red], [{s: [number[t], n] for s, (t, n) in edges[r].items()} for r in red])

    def score(self, word: list[str]) -> float:
        """Log-likelihood of the word; -inf if the automaton does not accept it."""
        at, total = 0, 0.0
        for s in word:
            step = self.edges[at].get(s)
            if step is None:
                return -math.inf
            total += math.log(step[1] / self.counts[at])
            at = step[0]
        return total + math.log(self.ends[at] / self.counts[at]) if self.ends[at] else -math.inf


def labelled_credentials(per_format: int = 400, seed: int = 11) -> dict[str, list[str]]:
    """Labelled examples by format, made by the formats' public descriptions; `plain` has ordinary long tokens."""
    r = random.Random(seed)
    lower, upper, digit = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alnum, b64 = lower + upper + digit, lower + upper + digit + "+/"
    pick = lambda chars, n: "".join(r.choices(chars, k=n))
    word = lambda: pick(lower, r.randint(2, 9))
    makers = {
        "access": lambda: r.choice(("AKIA", "ASIA")) + pick(upper + "234567", 16),
        "ghp": lambda: r.choice(("ghp_", "gho_", "ghs_")) + pick(alnum, 36),
        "xox": lambda: f"xox{r.choice('bp')}-{pick(digit, 11)}-{pick(digit, 12)}-{pick(alnum, 24)}",
        "stripe": lambda: r.choice(("sk_live_", "rk_live_", "sk_test_")) + pick(alnum, 24),
        "google": lambda: "AIza" + pick(alnum + "_-", 35),
        "jwt": lambda: f"eyJ{pick(alnum, 33)}.eyJ{pick(alnum, r.randint(50, 90))}.{pick(alnum + '_-', 43)}",
        "sendgrid": lambda: f"SG.{pick(alnum, 22)}.{pick(alnum + '_-', 43)}",
        "base64": lambda: "".join(pick(b64, 40)),
        "hexkey": lambda: pick("0123456789abcdef", r.choice((32, 40, 64))),
        "plain": lambda: r.choice(
            (
                lambda: word() + word() + word() + word(),
                lambda: "-".join(word() for _ in range(r.randint(3, 6))),
                lambda: "/".join(word() for _ in range(r.randint(3, 6))),
                lambda: "_".join(word() for _ in range(r.randint(3, 5))),
                lambda: ".".join(word() for _ in range(r.randint(3, 5))) + "/" + pick(digit, r.randint(1, 6)),
                lambda: pick(digit, r.randint(16, 20)),
                lambda: r.choice("-=_.") * r.randint(16, 60),
                lambda: f"20{pick(digit, 2)}-{pick(digit, 2)}-{pick(digit, 2)}-{word()}-{word()}.{word()}",
                lambda: (word() + word() + word() + word()).upper(),
                lambda: word().title() + word().title() + word().title() + word().title(),
            )
        )(),
    }
    return {name: [make() for _ in range(per_format * (8 if name == "plain" else 1))] for name, make in makers.items()}


class FormatModel:
    """One automaton for each format, and a smoothed bigram background of ordinary tokens."""

    def __init__(self, labelled: dict[str, list[str]]):
        self.automata = {name: Automaton.infer([symbols(t) for t in examples]) for name, examples in labelled.items() if name != "plain"}
        self.pairs, self.ones = Counter(), Counter()
        for t in labelled.get("plain", []):
            w = ["^", *self._coarse(t), "$"]
            self.pairs.update(zip(w, w[1:], strict=False))
            self.ones.update(w[:-1])

    @staticmethod
    def _coarse(token: str) -> list[str]:
        return ["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else c for c in token]

    def background(self, token: str) -> float:
        w = ["^", *self._coarse(token), "$"]
        # a class is spread evenly over its characters
        size = {"d": 10, "l": 26, "u": 26}
        return sum(math.log((self.pairs[a, b] + 0.05) / (self.ones[a] + 0.5)) - math.log(size.get(b, 1)) for a, b in zip(w, w[1:], strict=False))

    def score(self, token: str) -> float:
        """The best format's log-likelihood ratio per character; -inf if none accepts it."""
        w = symbols(token)
        within = {"d": 10, "x": 6, "l": 20, "u": 26}
        spread = sum(math.log(within.get(s, 1)) for s in w[LITERAL:])
        best = max((a.score(w) for a in self.automata.values()), default=-math.inf)
        return (best - spread - self.background(token)) / max(1, len(token)) if best > -math.inf else best


    def find(self, token: str, threshold: float) -> list[tuple[int, int]]:
        """The sub-runs that score at least the threshold, overlapping ones joined.

        All starts are followed at once. Of those that meet in one state of an automaton, what follows is the same, so the
        one with the best likelihood ratio so far and the earliest decide: where another is accepted, the best is too."""
        n, coarse = len(token), self._coarse(token)
        cut = [k in (0, n) or token[k - 1] in SPLIT or token[k] in SPLIT for k in range(n + 1)]
        size, within = {"d": 10, "l": 26, "u": 26}, {"d": 10, "x": 6, "l": 20, "u": 26}
        plain = lambda a, b: math.log((self.pairs[a, b] + 0.05) / (self.ones[a] + 0.5)) - math.log(size.get(b, 1))
        live: dict[tuple[str, int, int], list[tuple[float, int]]] = {}  # (format, state, age) -> the best and the earliest (gain, start)
        out: list[tuple[int, int]] = []
        for k, c in enumerate(token):
            if cut[k]:
                live |= {(name, 0, 0): [(0.0, k)] for name in self.automata}
            kind = symbols(" " * LITERAL + c)[-1]
            moved: dict[tuple[str, int, int], list[tuple[float, int]]] = {}
            for (name, at, age), held in live.items():
                a = self.automata[name]
                step = a.edges[at].get(kind if age == LITERAL else c)
                if step is None:
                    continue
                gain = math.log(step[1] / a.counts[at]) - (math.log(within.get(kind, 1)) if age == LITERAL else 0) - plain(coarse[k - 1] if age else "^", coarse[k]) - threshold
                moved.setdefault((name, step[0], min(age + 1, LITERAL)), []).extend((g + gain, s) for g, s in held)
            live = {key: [max(held), min(held, key=lambda x: x[1])] if len(held) > 1 else held for key, held in moved.items()}
            if cut[k + 1]:
                for (name, at, _), held in live.items():
                    a = self.automata[name]
                    if a.ends[at]:
                        last = math.log(a.ends[at] / a.counts[at]) - plain(coarse[k], "$")
                        out += [(s, k + 1) for g, s in held if k + 1 - s >= SHORTEST and g + last >= 0]
        joined: list[tuple[int, int]] = []
        for s, e in sorted(out):
            if joined and s < joined[-1][1]:
                joined[-1] = (joined[-1][0], max(e, joined[-1][1]))
            else:
                joined.append((s, e))
        return joined


def uncovered(s: int, e: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What the sorted spans leave of s ... e."""
    for a, b in taken:
        if b > s and a < e:
            if a > s:
                yield s, a
            s = b
    if s < e:
        yield s, e


def base_spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """The fixed kinds as byte spans; runs are the text's candidates, which hold all long hexadecimal runs."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    for s, e in runs:
        if e - s >= 32:
            out += [(s + m.start(), s + m.end(), "hex") for m in _HEX.finditer(text[s:e]) if len(m[0]) >= 32]
    return out


def _scan(model: FormatModel, threshold: float):
    def of(col: pa.Array) -> pa.Array:
        data, off = byte_view(as_binary(col))
        rows: list[list[dict]] = []
        for i, j in chunks(off):
            part, cut = data[off[i] : off[j]], off[i : j + 1] - off[i]
            flag = np.zeros(len(part) + 2, np.int8)
            flag[1:-1] = _TABLE[part]
            inner = cut[1:-1]
            edge = np.diff(flag)
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            if len(inner):  # a run ends where a text ends
                split = inner[(flag[inner] == 1) & (flag[np.minimum(inner + 1, len(flag) - 1)] == 1)]
                split = np.unique(split)
                starts, ends = np.sort(np.concatenate([starts, split])), np.sort(np.concatenate([ends, split]))
            long = ends - starts >= SHORTEST
            starts, ends = starts[long], ends[long]
            owner = np.searchsorted(cut, starts, "right") - 1
            by: dict[int, list[tuple[int, int]]] = {}
            for o, s, e in zip(owner.tolist(), starts.tolist(), ends.tolist(), strict=True):
                by.setdefault(o, []).append((s - int(cut[o]), e - int(cut[o])))
            for k in range(j - i):
                text = part[cut[k] : cut[k + 1]].tobytes()
                runs = by.get(k, [])
                spans = base_spans(text, runs)
                taken = sorted((s, e) for s, e, _ in spans)
                for s, e in (part for run in runs for part in uncovered(*run, taken)):
                    if e - s < SHORTEST:
                        continue
                    token = text[s:e].decode("ascii")
                    if model.score(token) >= threshold:
                        spans.append((s, e, "format"))
                    elif not SPLIT.isdisjoint(token):
                        spans += [(s + a, s + b, "format") for a, b in model.find(token, threshold)]
                if spans and not text.isascii():
                    wide = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
                    point = lambda b, wide=wide: int(wide[b - 1]) if b else 0
                    spans = [(point(s), point(e), kind) for s, e, kind in spans]
                spans.sort(key=lambda x: (x[0], KINDS.index(x[2])))
                rows.append([{"kind": kind, "s": s, "e": e} for s, e, kind in spans])
        return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int64()), ("e", pa.int64())])))

    return of


SPANS = "array<struct<kind:string,s:long,e:long>>"


def scan_secrets(docs: DataFrame, text_col: str = "text", labelled: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """docs with a column `found` of spans; an own column of that name is replaced."""
    model = FormatModel(labelled_credentials() if labelled is None else labelled)
    kept = [f"`{c}`" for c in docs.columns if c != "found"]
    return docs.select(*kept, text_column(lambda: _scan(model, threshold), SPANS)(F.col(f"`{text_col}`").cast("string")).alias("found"))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every found span replaced by [kind]; overlapping spans go as one, with the kind of the one that starts earlier (or is longer)."""
    spans = F.array_sort("found", lambda a, b: F.when(a.s != b.s, (a.s - b.s).cast("int")).otherwise((b.e - a.e).cast("int")))
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    text = F.col(f"`{text_col}`")
    cut = F.aggregate(
        spans,
        state,
        lambda acc, x: F.when(x.s < acc.at, F.struct(acc.out.alias("out"), F.greatest(acc.at, x.e).alias("at"))).otherwise(
            F.struct(
                F.concat(acc.out, F.substring(text, (acc.at + 1).cast("int"), (x.s - acc.at).cast("int")), F.lit("["), x.kind, F.lit("]")).alias("out"), x.e.alias("at")
            )
        ),
        lambda acc: F.concat(acc.out, F.substring(text, (acc.at + 1).cast("int"), F.char_length(text))),
    )
    return docs.withColumn(text_col, F.when(F.size("found") > 0, cut).otherwise(text))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, joined = {k: [] for k in KINDS}, [], []
        for spans in batch.column(1).to_pylist():
            of = Counter(x["kind"] for x in spans)
            for k in KINDS:
                counts[k].append(of[k])
            named = [(x["kind"], f"{x['kind']}:{x['s']}:{x['e']}") for x in spans]
            digests.append(hashlib.sha256(",".join(n for k, n in named if k != "format").encode()).hexdigest())
            joined.append(",".join(n for _, n in named))
        cols = [batch.column(0), *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(digests, pa.string()), pa.array(joined, pa.string())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans"])


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return scan_secrets(docs).select("doc_id", "found").mapInArrow(_digest, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string")
