"""Audit of how the sources of a language differ in their words, by chunk factorization.

1. Each whole text is cut at white space, and its chunks are counted. A task takes documents in blocks and gives a row for
   each distinct chunk of a block: the documents' numbers in the block, one for each occurrence; and one row with the
   (lang, source) of the documents.
2. Every chunk that occurs anywhere is cut into terms once, in a table of distinct chunks with their occurrences. Terms
   never hold white space, so a document's terms are those of its chunks. A term that does not occur `least` times cannot be
   in so many documents, and is left out from here on.
3. The terms are joined back to the rows. Where chunks of one block share a term their documents unite, so that a
   document counts once for a term; documents and occurrences are summed for (lang, source, term), first over SPAN blocks.
4. A language keeps the terms of at least `least` of its documents. Shares of a million millionths with a little added to
   every count are whole numbers, and so are all sums.
5. Distances of sources: the terms meet in cells of two tiles of at most TILE sources. A task adds up the matrix of a cell
   over the terms it has, and the matrices are summed. Terms that no source of a cell holds are added as a product.

No text travels, a frequent chunk or term has a row a block of documents, and its sources meet in tiles. The number of pairs of sources is the size of the result.

Null text, lang and source are ''. Texts without terms and empty texts count as documents of their group, which then has
shares like any other. Repeated rows are documents of their own. Other columns are not read, whatever their names. An
empty table gives no rows. Ties rank by the item.
"""

from __future__ import annotations

import itertools
import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.llm.common import partitions, stored, table, texts

#: The most documents (16 bits), occurrences and distinct chunks of a block; blocks whose terms are united together, in so
#: many parts; live terms that are broadcast; sources of a tile.
BLOCK_DOCS, BLOCK_TOKENS, BLOCK_CHUNKS, SPAN, PARTS, LIVE, TILE = 1 << 16, 8_000_000, 800_000, 64, 64, 500_000, 128
#: Documents of a language that keep a term, occurrences added to every term, and the ranks of part `term`.
LEAST_DOCS, ADDED, RANKS = 30, 5, 50
#: Fixed by the definition of a term: what is neither an ASCII letter nor beyond ASCII parts terms.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _blocks(most_docs: int):
    """(lang, source, text) -> (block, chunk, held): held has the numbers of the block's documents, 16 bits each, that hold
    the chunk, repeated as it occurs. Documents are numbered group by group. A row without chunk describes the block: its
    groups (lang, source) and their numbers of documents, as JSON."""
    names = ["block", "chunk", "held"]

    def rows(block: int, known: dict, ids: list[np.ndarray], sizes: list[int], of: list[int], groups: dict) -> Iterator[pa.RecordBatch]:
        about = json.dumps({"groups": list(groups), "docs": np.bincount(of, minlength=len(groups)).tolist()}).encode()
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([None], pa.string()), pa.array([about], pa.binary())], names=names)
        if not known:
            return
        number = np.empty(len(of), np.uint16)
        number[np.argsort(of, kind="stable")] = np.arange(len(of))
        chunk = np.concatenate(ids)
        held = np.repeat(number, sizes)[np.argsort(chunk, kind="stable")]
        ends = np.append(0, np.cumsum(2 * np.bincount(chunk, minlength=len(known)))).astype(np.int32)
        held = pa.BinaryArray.from_buffers(pa.binary(), len(known), [None, pa.py_buffer(ends), pa.py_buffer(held)])
        words = pa.array(list(known), pa.binary())
        order = pc.sort_indices(words)  # neighbours begin alike, which packs well
        for k in range(0, len(known), 1 << 15):
            some = order.slice(k, 1 << 15)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), block)), words.take(some).cast(pa.string()), held.take(some)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = itertools.count(TaskContext.get().partitionId() << 36)

        def fresh() -> tuple:
            return defaultdict(itertools.count().__next__), [], [], [], {}

        known, ids, sizes, of, groups = block = fresh()
        tokens = 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, _, values in texts(batch.column(2)):
                for k, text in enumerate(values, i):
                    words = text.split()  # bytes: only \x20 and \x09-\x0D
                    ids.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                    sizes.append(len(words))
                    of.append(groups.setdefault((langs[k], sources[k]), len(groups)))
                    tokens += len(words)
                    if len(of) >= most_docs or tokens >= BLOCK_TOKENS or len(known) >= BLOCK_CHUNKS:
                        yield from rows(next(count), *block)
                        known, ids, sizes, of, groups = block = fresh()
                        tokens = 0
        if of:
            yield from rows(next(count), *block)

    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (span, part, block, term, held), sorted by span and part -> (lang, source, term, docs, n) for each term of a
    part. A part's rows can go over several batches; its size is bounded by that of SPAN blocks."""

    def counted(rows: pa.Table) -> pa.RecordBatch | None:
        lead = rows.column("term").combine_chunks().is_null().to_numpy(zero_copy_only=False)
        abouts, rows = rows.filter(pa.array(lead)), rows.filter(pa.array(~lead)).combine_chunks()
        if not rows.num_rows:
            return None
        groups: dict[tuple, int] = {}
        base: dict[int, int] = {}
        of: list[np.ndarray] = []
        total = 0
        for block, about in zip(abouts.column("block").to_pylist(), abouts.column("held").to_pylist(), strict=True):
            known = json.loads(about)
            of.append(np.repeat([groups.setdefault(tuple(g), len(groups)) for g in known["groups"]], known["docs"]))
            base[block], total = total, total + len(of[-1])
        held, words = rows.column("held").combine_chunks(), rows.column("term").combine_chunks().dictionary_encode()
        ends = np.frombuffer(held.buffers()[1], np.int32)[held.offset : held.offset + len(held) + 1]
        docs = np.frombuffer(held.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.uint16).astype(np.int64)
        blocks, at = np.unique(rows.column("block").to_numpy(), return_inverse=True)
        first_doc = np.array([base[b] for b in blocks.tolist()])[at]  # a document of the span goes by its place among all
        reps = np.diff(ends) // 2
        each, n = np.unique(np.repeat(words.indices.to_numpy().astype(np.int64), reps) * total + docs + np.repeat(first_doc, reps), return_counts=True)
        key = (each // total) * len(groups) + np.concatenate(of)[each % total]
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
        key, n, d = key[order][first], np.add.reduceat(n[order], first), np.diff(np.append(first, len(order)))
        lang, source = (pa.array([g[k] for g in groups], pa.string()).take(pa.array(key % len(groups))) for k in (0, 1))
        return pa.RecordBatch.from_arrays([lang, source, words.dictionary.take(pa.array(key // len(groups))), pa.array(d.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "source", "term", "docs", "n"])

    rest: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in (0, 1)], axis=1)
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
        for s, e in itertools.pairwise(cuts):
            if s == e:
                continue
            if rest and tuple(key[s]) != now:
                if (out := counted(pa.Table.from_batches(rest))) is not None:
                    yield out
                rest = []
            rest.append(batch.slice(s, e - s))
            now = tuple(key[s])
    if rest and (out := counted(pa.Table.from_batches(rest))) is not None:
        yield out


def term_counts(docs: DataFrame, least: int, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(lang, source, term, docs, n): how many documents of the group hold the term, and how often it occurs there; several
    rows to be added up. Terms that occur less than `least` times in all are left out."""
    spark = docs.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = stored(docs.select(text("lang"), text("source"), text("text")).mapInArrow(_blocks(block_docs), "block long, chunk string, held binary"), "chunks")
    chunks, leads = rows.filter("chunk is not null"), rows.filter("chunk is null")
    terms = F.regexp_extract_all(F.translate("chunk", _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    once = chunks.groupBy("chunk").agg(F.sum(F.octet_length("held") / 2).cast("long").alias("n"))
    known = stored(once.withColumn("terms", terms).filter(F.size("terms") > 0), "distinct")
    live = known.select(F.explode("terms").alias("term"), "n").groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("term")
    live = stored(live, "live")
    few = live.limit(LIVE + 1).count() <= LIVE
    pairs = known.select("chunk", F.explode("terms").alias("term")).join(F.broadcast(live) if few else live, "term")
    span = F.pmod(F.xxhash64("block"), F.lit(leads.count() // SPAN + 1)).cast("int").alias("span")
    # a part of the distinct chunks is small whatever the rows of a frequent one, and hashing it saves the sort of both
    found = chunks.join(pairs.hint("shuffle_hash"), "chunk").select(span, F.pmod(F.xxhash64("term"), F.lit(PARTS)).cast("int").alias("part"), "block", "term", "held")
    about = leads.select(span, F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), "block", F.col("chunk").alias("term"), "held")
    dealt = about.unionByName(found).repartition(partitions(spark), "span", "part").sortWithinPartitions("span", "part")
    return dealt.mapInArrow(_united, "lang string, source string, term string, docs long, n long")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10 ** 9 * (n + ADDED) / (total + ADDED * terms)) in whole numbers."""
    top = F.lit(10**9).cast("decimal(10,0)") * (n + ADDED).cast("decimal(20,0)")
    below = (total + ADDED * terms).cast("decimal(20,0)")
    rest = top % below
    return (F.lit(1) + ((top - rest) / below).cast("decimal(38,0)")).cast("long")


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, a, b, entries, za, zb), sorted by cell -> (lang, i, j, s, terms): for sources i of tile a and j of tile b
    the sum of the distances over this task's terms, and the number of these. An entry is (tile, place, share)."""

    def close(cell: tuple, total: np.ndarray, terms: int, width: tuple) -> pa.RecordBatch:
        (lang, a, b), (x, y) = cell, width
        i, j = np.divmod(np.arange(x * y), y)
        i, j, s = i + a * TILE, j + b * TILE, total.ravel()
        if a == b:
            keep = i < j
            i, j, s = i[keep], j[keep], s[keep]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(s), pa.string()), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(s), pa.array(np.full(len(s), terms, np.int64))], names=["lang", "i", "j", "s", "terms"])

    cell, total, terms, width = None, None, 0, (0, 0)
    for batch in batches:
        keys = list(zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True))
        cuts = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]] + [len(keys)]
        for s, e in itertools.pairwise(cuts):
            if keys[s] != cell:
                if cell is not None:
                    yield close(cell, total, terms, width)
                cell, terms = keys[s], 0
                base = [np.array(batch.column(c)[s].as_py(), np.int64) for c in (4, 5)]
                width = tuple(map(len, base))
                total = np.zeros(width, np.int64)
            for at in range(s, e, 2048):
                part = batch.column(3).slice(at, min(2048, e - at))
                lens = part.value_lengths().to_numpy()
                flat = part.flatten()
                tile, place, share = (flat.field(k).to_numpy() for k in range(3))
                row = np.repeat(np.arange(len(part)), lens)
                dense = [np.repeat(z[None, :], len(part), axis=0) for z in base]
                for side in (0, 1):
                    own = tile == cell[1 + side]
                    dense[side][row[own], place[own]] = share[own]
                for i in range(width[0]):
                    total[i] += np.abs(dense[1] - dense[0][:, i : i + 1]).sum(axis=0)
                terms += len(part)
    if cell is not None:
        yield close(cell, total, terms, width)


def divergence(docs: DataFrame, least: int = LEAST_DOCS, ranks: int = RANKS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` gives the distances of a source to the other sources of its
    language, part `term` the terms that it has more of than its language."""
    counts = stored(term_counts(docs, least, block_docs), "terms")
    kept = stored(counts.groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("n").alias("all_n")).filter(F.col("d") >= least).drop("d"), "kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("lang_n"))
    of = stored(counts.join(kept, ["lang", "term"]).groupBy("lang", "source", "term", "all_n").agg(F.sum("n").alias("n")), "kept-terms")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    sized = docs.select(text("lang"), text("source")).distinct().join(of.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left").join(langs, "lang", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    place = (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).alias("i")  # one row a source
    groups = stored(
        sized.select("lang", "source", place, zero("group_n"), zero("v"), zero("lang_n"))
        .withColumn("z", F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), F.col("group_n"), F.col("v"))).otherwise(0)),
        "sources",
    )
    shares = of.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("group_n"), F.col("v"))).withColumn("q", _share(F.col("all_n"), F.col("lang_n"), F.col("v")))
    best = W.partitionBy("lang", "source")
    item = [F.desc("value"), F.asc("item")]
    terms = (
        shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(best.orderBy(*item))).filter(F.col("rank") <= ranks)
    )
    tile = F.floor(F.col("i") / TILE).cast("int")
    tiles = groups.groupBy("lang", tile.alias("tile")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "z"))), lambda x: x["z"]).alias("base"))
    last = groups.groupBy("lang").agg(F.floor(F.max("i") / TILE).cast("int").alias("last"))
    cells = (
        shares.select("lang", "term", tile.alias("tile"), (F.col("i") % TILE).cast("int").alias("place"), "p").join(last, "lang")
        .withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
        .groupBy("lang", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "term").agg(F.collect_list(F.struct("tile", "place", "p")).alias("entries"))
        .join(tiles.select("lang", F.col("tile").alias("a"), F.col("base").alias("za")), ["lang", "a"]).join(tiles.select("lang", F.col("tile").alias("b"), F.col("base").alias("zb")), ["lang", "b"])
        .select("lang", "a", "b", "entries", "za", "zb").sortWithinPartitions("lang", "a", "b")
    )
    sums = cells.mapInArrow(_distances, "lang string, i int, j int, s long, terms long").groupBy("lang", "i", "j").agg(F.sum("s").alias("s"), F.sum("terms").alias("terms"))
    side = lambda n: groups.select("lang", *[F.col(c).alias(f"{n}_{c}") for c in ("source", "i", "z")], *(["v"] if n == "a" else []))
    both = side("a").join(side("b"), "lang").filter("a_i < b_i")  # what the result consists of
    apart = F.coalesce("s", F.lit(0).cast("long")) + (F.col("v") - F.coalesce("terms", F.lit(0).cast("long"))) * F.abs(F.col("a_z") - F.col("b_z"))
    found = both.join(sums, (both["lang"] == sums["lang"]) & (both["a_i"] == sums["i"]) & (both["b_i"] == sums["j"]), "left").select(both["lang"], "a_source", "b_source", apart.alias("value"))
    ways = F.explode(F.array(*[F.struct(F.col(f"{x}_source").alias("source"), F.col(f"{y}_source").alias("item")) for x, y in ("ab", "ba")]))
    pairs = found.select("lang", ways.alias("w"), "value").select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value").withColumn("rank", F.row_number().over(best.orderBy(*item)))
    return pairs.unionByName(terms).withColumn("rank", F.col("rank").cast("int"))


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
w as (select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
c as (select lang, source, term, count(*) as n, count(distinct r) as docs from w group by all),
k as (select lang, term, sum(n) as all_n from c group by all having sum(docs) >= 30),
v as (select lang, count(*) as v, sum(all_n) as lang_n from k group by lang),
g as (select distinct lang, source from d),
f as (select g.lang, g.source, k.term, k.all_n, coalesce(c.n, 0) as n from g join k on g.lang = k.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
s as (select lang, source, sum(n) as group_n from f group by all),
p as (select f.*, 1 + (1000000000::hugeint * (f.n + 5)::hugeint) // (s.group_n + 5 * v.v)::hugeint as p, 1 + (1000000000::hugeint * (f.all_n + 5)::hugeint) // (v.lang_n + 5 * v.v)::hugeint as q from f join s using (lang, source) join v using (lang)),
x as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pair as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source left join x on x.lang = a.lang and x.source = a.source and x.item = b.source),
term as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value from p where n > 0 and p > q),
u as (select * from pair union all select * from term)
select * from (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from u) where part = 'pair' or rank <= 50
"""
