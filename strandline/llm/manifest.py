"""Merkle manifest of a table of documents, its proofs found by a butterfly exchange.

1. A row's leaf is the SHA-256 of its fields, each `-` if it is null, else the number of its UTF-8 bytes, ':', and the value.
2. Leaves are ordered by (language, id, leaf); a language's leaves are cut at multiples of BLOCK, a power of FANOUT, so
   that a block is a whole subtree. A task reduces each of its blocks to a root.
3. Butterfly: in round r the FANOUT blocks whose numbers differ in the r-th digit only (to the base FANOUT) swap the roots
   of their subtrees so far. Every one of them then hashes the common ancestor itself, and holds its siblings: after the
   last round each block has the proofs of its upper levels and the root, and nothing need be sent down. Where the last
   subtree of a level has fewer blocks, each of these serves several partners. A round is one shuffle of one small row a
   block and partner.
4. The languages' roots are the blocks of a second butterfly, whose result is joined to the blocks of step 3.
5. Each block's task makes the paths inside it again and folds every leaf up to the root.

A language may hold all rows: it only has more blocks. The driver gets the sizes of the partitions of the sort and the
numbers of blocks and languages.

Nulls: a null language is a language of its own, before all others; null ids come first. Rows with equal ids are leaves of
their own, ordered by leaf, and wholly equal rows are equal leaves. Null ids are never tampered with. An empty table gives
no rows; other columns are not read. Texts can be of any length.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import partitions, stored, table

FANOUT = 8
#: Leaves of a block.
BLOCK = FANOUT**4
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_of(values: dict[str, Column]) -> Column:
    """The leaf of the values of FIELDS, as hexadecimal text."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*[one(values[f]) for f in FIELDS]), 256)


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds `at`, the place of a row in its tree from 0 on, and `n`, the rows of the tree. Trees can be of any size: a sorted
    range of rows numbers itself, and only a row for each (range, tree) tells where the tree's part begins."""
    spark = rows.sparkSession
    kept = stored(rows.repartitionByRange(partitions(spark), tree, *order).sortWithinPartitions(tree, *order).withColumn("__m", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__m", 33).alias("__part")
    parts = kept.groupBy(part, tree).agg(F.min("__m").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    earlier = F.aggregate(F.filter("__all", lambda x: x["__part"] < F.col("__one.__part")), F.lit(0).cast("long"), lambda a, x: a + x["__rows"])
    trees = parts.groupBy(tree).agg(F.collect_list(F.struct("__part", "__first", "__rows")).alias("__all"), F.sum("__rows").alias("n"))  # one of each range at most
    starts = trees.select(tree, "n", "__all", F.explode("__all").alias("__one")).select(tree, F.col("__one.__part").alias("__part"), (earlier - F.col("__one.__first")).alias("__shift"), "n")
    return kept.withColumn("__part", part).join(starts, ["__part", tree]).withColumn("at", F.col("__m") + F.col("__shift")).drop("__m", "__part", "__shift")


def _hash(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _levels(leaves: list[str], height: int | None) -> list[list[str]]:
    """The nodes of a subtree, level by level; height None: up to a single node, else so many levels above the leaves."""
    levels = [leaves]
    while len(levels) <= height if height is not None else len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([_hash(now[k : k + FANOUT]) for k in range(0, len(now), FANOUT)])
    return levels


def _height(n: int, block: int) -> int | None:
    """Levels of a block: a tree of one block ends where one node is left."""
    height = 0
    while FANOUT**height < block:
        height += 1
    return None if n <= block else height


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows (tree, block, ...), sorted by these, as one list a block."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, some in itertools.groupby(rows, key=lambda r: (r["tree"], r["block"])):
        yield list(some)


def _roots(block: int):
    """Sorted (tree, block, at, n, leaf) -> (tree, at, n, node): the root of each block, `n` the tree's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            one = rows[0]
            node = _levels([r["leaf"] for r in rows], _height(one["n"], block))[-1][0]
            yield pa.RecordBatch.from_pylist([{"tree": one["tree"], "at": one["block"], "n": -(-one["n"] // block), "node": node}], pa.schema([("tree", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("node", pa.string())]))

    return run


def butterfly(nodes: DataFrame, most: int) -> DataFrame:
    """(tree, at, n, node) -> (tree, at, node, path): node is the tree's root, and path has for each level up to it the place
    among the siblings and the siblings before and after it. `most`: the nodes of the largest tree."""
    now, size = nodes.withColumn("path", F.array().cast("array<struct<before:string,after:string>>")), 1
    while size < most:
        group, full = F.floor(F.col("at") / size), F.lit(size).cast("long")
        held = F.least(full, F.col("n") - group * size)  # blocks of the own subtree; less than `full` in the last one only
        place = F.col("at") % size
        alone = (group % FANOUT == 0) | (held == full)
        # the blocks of a short last subtree also serve the partners that it has no block for
        partners = F.when(alone, F.array(place)).otherwise(F.sequence(place, full - 1, held))
        sent = now.select("tree", "n", F.floor(group / FANOUT).alias("above"), F.explode(partners).alias("with"), place.alias("place"), (group % FANOUT).alias("digit"), "node", "at", "path")
        own = F.when(F.col("with") == F.col("place"), F.struct("digit", "at", "path"))
        met = sent.groupBy("tree", "n", "above", "with").agg(F.array_sort(F.collect_list(F.struct("digit", "node"))).alias("all"), F.collect_list(own).alias("own"))
        join = lambda keep: F.array_join(F.transform(F.filter("all", keep), lambda x: x["node"]), "")
        level = F.struct(join(lambda x: x["digit"] < F.col("one.digit")).alias("before"), join(lambda x: x["digit"] > F.col("one.digit")).alias("after"))
        done = F.col("n") <= size  # this tree ended in an earlier round
        parent = F.sha2(F.array_join(F.transform("all", lambda x: x["node"]), ""), 256)
        now = met.withColumn("one", F.explode("own")).select(
            "tree", "one.at", "n", F.when(done, F.col("all")[0]["node"]).otherwise(parent).alias("node"), F.when(done, F.col("one.path")).otherwise(F.concat("one.path", F.array(level))).alias("path")
        )
        size *= FANOUT
    return now.select("tree", "at", "node", "path")


def _proofs(block: int):
    """Sorted rows of blocks, each led by its header (at -1) with subroot, root and path -> a row for each leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")])
        for header, *rows in _grouped(batches):
            levels = _levels([r["leaf"] for r in rows], _height(rows[0]["n"], block))
            above = [(p["before"], p["after"]) for p in header["path"]]
            tail = "".join(b + a for b, a in above).encode()
            out = []
            for k, row in enumerate(rows):
                proof, fold, at = hashlib.sha256(), row["leaf"] if row["tampered"] is None else row["tampered"], k
                for nodes in levels[:-1]:
                    s = at - at % FANOUT
                    before, after = "".join(nodes[s:at]), "".join(nodes[at + 1 : s + FANOUT])
                    proof.update((before + after).encode())
                    fold, at = _hash([before, fold, after]), at // FANOUT
                proof.update(tail)
                for before, after in above:
                    fold = _hash([before, fold, after])
                out.append({"leaf": row["leaf"], "subroot": header["subroot"], "root": header["root"], "proof_sha256": proof.hexdigest(), "folded_root": fold})
            made = pa.RecordBatch.from_pylist(out, schema)
            yield pa.RecordBatch.from_arrays([pa.array([r["id"] for r in rows], pa.int64() if kind == "long" else pa.string()), *made.columns], names=["id", *schema.names])

    kind = "long"
    return run


def manifest(docs: DataFrame, tampered: dict[str, Column] | None = None, where: Column | None = None, block: int = BLOCK) -> DataFrame:
    """A row for each document: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified. `tampered` replaces
    fields in the rows `where`, whose leaf is then folded with the siblings of the untampered table."""
    spark = docs.sparkSession
    of = {f: F.col(f"`{f}`") for f in FIELDS}
    tree = F.coalesce(F.concat(F.lit("="), of["lang"].cast("string")), F.lit("")).alias("tree")  # null first, then by bytes
    changed = F.when(where, leaf_of(of | tampered)) if tampered else F.lit(None).cast("string")
    leaves = docs.select(tree, of["doc_id"].cast("long").alias("id"), leaf_of(of).alias("leaf"), changed.alias("tampered"))
    placed = stored(ranked(leaves, "tree", ["id", "leaf"]).withColumn("block", F.floor(F.col("at") / block)), "leaves")
    n = partitions(spark)
    dealt = lambda df: df.repartition(n, "tree", "block").sortWithinPartitions("tree", "block", "at")
    blocks = stored(dealt(placed.select("tree", "block", "at", "n", "leaf")).mapInArrow(_roots(block), "tree string, at long, n long, node string"), "blocks")
    upper = stored(butterfly(blocks, blocks.agg(F.max("n").alias("n")).first()["n"] or 0), "paths")
    langs = ranked(upper.filter("at = 0").select(F.lit("").alias("tree"), F.col("tree").alias("lang"), F.col("node").alias("subroot")), "tree", ["lang"])
    langs = stored(langs, "languages")
    count = langs.agg(F.max("n").alias("n")).first()["n"] or 0
    tops = butterfly(langs.select("tree", "at", "n", F.col("subroot").alias("node")), count).select("at", F.col("node").alias("root"), F.col("path").alias("top"))
    known = langs.join(tops, "at").select(F.col("lang").alias("tree"), "subroot", "root", "top")
    none = lambda kind: F.lit(None).cast(kind)
    headers = upper.join(known, "tree").select(
        "tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), none("long").alias("n"), none("long").alias("id"), none("string").alias("leaf"), none("string").alias("tampered"),
        "subroot", "root", F.concat("path", "top").alias("path"),
    )
    kind = headers.schema["path"].dataType
    rows = placed.select("tree", "block", "at", "n", "id", "leaf", "tampered", none("string").alias("subroot"), none("string").alias("root"), none(kind).alias("path"))
    found = dealt(headers.unionByName(rows)).mapInArrow(_proofs(block), "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return found.withColumnRenamed("id", "doc_id").withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_manifest(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(docs, {"text": F.translate(F.col("text"), _UPPER, _LOWER)}, struck)


OP12_SQL = r"""
with recursive d as (select *, '' || doc_id as k from documents),
crc as (select k, xor(4294967295, list_reduce(flatten(list_transform(string_split(k, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]::bigint[])),
  lambda a, x: case when x >= 0 then xor(a, x) when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end, 4294967295::bigint)) % 3 = 0 as struck from (select distinct k from d)),
f as (select doc_id, lang, coalesce(struck, false) as struck, coalesce(strlen(k) || ':' || k, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen('' || n_chars) || ':' || n_chars, '-') as head,
  text as t, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low from d left join crc using (k)),
leaf as (select doc_id, lang, sha256(head || coalesce(strlen(t) || ':' || t, '-')) as h, case when struck then sha256(head || coalesce(strlen(low) || ':' || low, '-')) else h end as x from f),
base as (select *, row_number() over (partition by lang order by doc_id nulls first, h) - 1 as pos, count(*) over (partition by lang) as n from leaf),
up as (select lang, pos, n, 0 as level, h from base union all
  select lang, pos // 8, (any_value(n) + 7) // 8, any_value(level) + 1, sha256(string_agg(h, '' order by pos)) from up where n > 1 group by lang, pos // 8),
sub as (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from up where n = 1),
top as (select pos, n, 0 as level, subroot as h from sub union all select pos // 8, (any_value(n) + 7) // 8, any_value(level) + 1, sha256(string_agg(h, '' order by pos)) from top where n > 1 group by pos // 8),
runs as (select lang, level, pos // 8 as g, list({'j': pos % 8, 'h': h} order by pos) as l from up where n > 1 group by all), tops as (select level, pos // 8 as g, list({'j': pos % 8, 'h': h} order by pos) as l from top where n > 1 group by all),
near as (select doc_id, b.pos, b.lang, r.level, l, (b.pos // (8 ** r.level)::bigint) % 8 as own from base b join runs r on r.lang is not distinct from b.lang and r.g = b.pos // (8 ** (r.level + 1))::bigint
  union all select doc_id, b.pos, b.lang, 100 + r.level, l, (s.pos // (8 ** r.level)::bigint) % 8 from base b join sub s on s.lang is not distinct from b.lang join tops r on r.g = s.pos // (8 ** (r.level + 1))::bigint),
step as (select doc_id, pos, lang, level, coalesce(array_to_string([u.h for u in l if u.j < own], ''), '') || '|' || coalesce(array_to_string([u.h for u in l if u.j > own], ''), '') as s from near),
path as (select pos, lang, replace(string_agg(s, '' order by level), '|', '') as proof, list(s order by level) as steps from step group by pos, lang)
select b.doc_id, b.h as leaf, s.subroot, t.h as root, sha256(coalesce(p.proof, '')) as proof_sha256, list_reduce(coalesce(p.steps, []), lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2)), b.x) as folded_root, folded_root = t.h as verified
from base b join sub s on s.lang is not distinct from b.lang left join path p on p.pos = b.pos and p.lang is not distinct from b.lang, (select h from top where n = 1) t
"""
