"""Near-duplicate groups by MinHash with tensored banding.

1. Sets: A-Z are lower-cased, words are `[^\\x20\\x09-\\x0D]+`, a document's set holds its distinct shingles of SHINGLE words
   (fewer words: the whole sequence as one; no word: none). Documents with equal sets are one class.
2. Two small collections of HALVES keys, each key of ROWS minimum hashes, are computed for a class: 2 * HALVES * ROWS
   minimum hashes. Every pair of a left and a right key is a table key, so that HALVES ** 2 tables of 2 * ROWS minimum
   hashes each cost about the square root of their hashes. Classes at similarity s share a table with a chance of
   (1 - (1 - s ** ROWS) ** HALVES) ** 2: 0.9996 at 0.8.
3. A pair of keys can only be shared where both halves are: halves that one class alone has are dropped before any pair is
   formed, so that a text without near copies has no table key at all.
4. Candidates are compared by their full sets (`set_links.verified`), and components are found by alternating stars.

Null and empty texts have no set and are linked with nothing. Rows with equal ids are rows of their own, and a component
goes by its least id, nulls last. Texts can be of any length. Other columns are not read, whatever their names. An empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import handles, stored, table
from strandline.llm.components import components
from strandline.llm.set_links import SET_TILE, min_keys, sketches, verified

SHINGLE, SIMILARITY = 4, 0.8
#: Keys of one collection, and minimum hashes of a key.
HALVES, ROWS = 12, 3


def _half_keys(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The left keys, then the right keys; a key knows its place by its seed."""
    return min_keys(flat, starts, 2 * HALVES, ROWS)


def tables(classes: DataFrame) -> DataFrame:
    """(bucket, c) for classes (c, bands): a bucket for each pair of a left and a right key."""
    halves = classes.select("c", F.posexplode("bands").alias("place", "key"))
    shared = halves.groupBy("key").agg(F.min("c").alias("a"), F.max("c").alias("b")).filter("a < b").select("key")
    side = lambda own: F.collect_list(F.when(own, F.col("key")))
    live = halves.join(shared, "key").groupBy("c").agg(side(F.col("place") < HALVES).alias("left"), side(F.col("place") >= HALVES).alias("right"))
    pairs = F.flatten(F.transform("left", lambda x: F.transform("right", lambda y: F.xxhash64(x, y))))
    return live.select(F.explode(pairs).alias("bucket"), "c")


def near_sets(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", similarity: float = SIMILARITY, size: int = SHINGLE, tile: int = SET_TILE) -> DataFrame:
    """A row for each row of docs: id, n_shingles and component_id."""
    rows, plain = handles(docs.select(F.col(f"`{id_col}`").alias("own"), F.col(f"`{text_col}`").cast("string").alias("text")), "own")
    base = rows.select(F.col("uid").alias("id"), "text")
    sketch = stored(base.mapInArrow(sketches(size, _half_keys), "id long, f1 long, f2 long, n long, bands array<long>"), "sketches")
    classes = stored(sketch.filter("n > 0").groupBy("f1", "f2").agg(F.min("id").alias("c"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    roots = components(verified(base, classes.select("c", "n"), stored(tables(classes.select("c", "bands")), "tables"), similarity, size, tile), "minhash")
    named = classes.select("f1", "f2", "c").join(roots.withColumnRenamed("node", "c"), "c", "left").select("f1", "f2", F.coalesce("root", "c").alias("root"))
    found = sketch.select("id", "f1", "f2", "n").join(named, ["f1", "f2"], "left").select("id", "n", F.coalesce("root", "id").alias("root"))
    if plain:
        return found.select("id", F.col("n").alias("n_shingles"), F.col("root").alias("component_id"))
    ids = rows.select("uid", "own")
    found = found.join(ids, found["id"] == ids["uid"]).select(F.col("own").alias("id"), F.col("n").alias("n_shingles"), "root")
    return found.join(ids, found["root"] == ids["uid"]).select("id", "n_shingles", F.col("own").alias("component_id"))


def op11_minhash(spark, sf_dir: str) -> DataFrame:
    found = near_sets(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


OP11_SQL = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, x from (select doc_id, unnest(case when len(w) = 0 then [] when len(w) <= 4 then [array_to_string(w, ' ')] else [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] for i in range(1, len(w) - 2)] end) as x from d)),
n as (select doc_id, count(*) as n from s group by doc_id),
b as (select l.doc_id as a, r.doc_id as b, count(*) as c from s l join s r on l.x = r.x and l.doc_id < r.doc_id group by all),
k as (select a, b from b join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
e as (select a, b from k union all select b, a from k),
r as (select doc_id, doc_id as root from d union select e.b, r.root from r join e on e.a = r.doc_id),
m as (select doc_id, min(root) as component_id from r group by doc_id)
select doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept from m left join n using (doc_id)
"""
