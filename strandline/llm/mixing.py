"""Mixing sources to target weights by hierarchical budgets; DataFrame functions only.

The tree is domain, language, source. A node's capacity is what its leaves can give: tokens times MAX_EPOCHS. The
budget goes down level by level: siblings share their parent's budget by weight, and what a node cannot take goes to
its siblings by weight (water filling), so a shortage reaches the next ancestor only once all siblings are full.
A leaf repeats its documents in whole epochs and takes the rest as a prefix of one more epoch: documents in the order
of md5(seed, epoch, id), as long as the tokens before them are less than what is left. (The last one may go beyond.)

A prefix is found without sorting a leaf in one task: tokens are summed by (leaf, first 2 hexadecimal digits of the
order), running sums over at most 256 such buckets give the bucket of the cut; that bucket is split by the next 2
digits in the same way, and only the last bucket, one of 65536, is sorted.

Nulls in lang and source are nodes of their own with the name ''; a null text has no tokens. Rows with equal ids have
equal order and are taken together. Weights are whole numbers; 0 takes nothing; nodes without one have weight 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.llm.common import stored, table

LEVELS = ("domain", "lang", "source")
WORDS = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS, SEED, SHARE = 3, 17, 0.6
#: Hexadecimal digits of the order that make the buckets of each step.
PREFIXES = (2, 4)
#: Leaves up to this number are broadcast.
LEAVES = 100_000
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}


def domain_of(source: Column) -> Column:
    """The domain of a source named src<number>: its number modulo 4; otherwise `other`."""
    n = F.regexp_extract(F.coalesce(source, F.lit("")), "^src([0-9]{1,9})$", 1)
    return F.when(n == "", F.lit("other")).otherwise(F.concat(F.lit("d"), (F.nullif(n, F.lit("")).cast("int") % 4).cast("string")))


def slim(docs: DataFrame) -> DataFrame:
    """id, the tree's three levels and the tokens of every row."""
    return docs.select(
        F.col("doc_id").cast("long").alias("id"), domain_of(F.col("source")).alias("domain"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("n_tokens"),
    )


def weight_of(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1).cast("long")
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(int(w)).cast("long")).otherwise(out)
    return out


def fill(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Share `budget` among siblings (weight, cap): adds `share`.

    Siblings are sorted by cap / weight; a sibling is full if its cap is at most its part of what the earlier ones
    leave. The others get whole-number parts of the rest; less than a token each stays unused."""
    group = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(1))
    before = group.orderBy(F.col("cap") / F.col("weight"), child).rowsBetween(W.unboundedPreceding, -1)
    some = nodes.filter("weight > 0")
    some = some.withColumn("caps", F.coalesce(F.sum("cap").over(before), F.lit(0).cast("long"))).withColumn("weights", F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), F.lit(0).cast("long")))
    some = some.withColumn("full", F.col("cap") * F.col("weights") <= F.col("weight") * (F.col("budget") - F.col("caps")))
    some = some.withColumn("full_caps", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0).cast("long")))
    some = some.withColumn("open_weights", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(group), F.lit(1).cast("long")))
    rest = F.expr("weight * (budget - full_caps) div open_weights")
    return some.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(rest)).drop("caps", "weights", "full", "full_caps", "open_weights", "weight", "cap", "budget")


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], share: float, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens) -> the same with `share`, the tokens that the leaf has to give."""
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = caps.agg(F.floor(F.sum("tokens") * F.lit(share)).cast("long").alias("budget"))
    level = caps.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("weight", weight_of("domain", weights)).join(F.broadcast(total))
    domain = fill(level, [], "domain").withColumnRenamed("share", "budget")
    level = caps.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).withColumn("weight", weight_of("lang", weights)).join(domain, "domain")
    lang = fill(level, ["domain"], "lang").withColumnRenamed("share", "budget")
    level = caps.withColumn("weight", weight_of("source", weights)).join(lang, ["domain", "lang"])
    return fill(level, ["domain", "lang"], "source")


def order_of(epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"))


def plan(rows: DataFrame, weights: dict[str, dict[str, int]], share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per leaf: whole `epochs`, and the last (order, id) of the prefix of the next one (null: none)."""
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, weights, share, max_epochs)
    leaf = stored(
        budgets.withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("share div nullif(tokens, 0)")).otherwise(F.lit(0).cast("long"))).withColumn("rest", F.col("share") - F.col("epochs") * F.col("tokens")), "leaves"
    )
    few = leaf.count() <= LEAVES
    some = leaf.filter("rest > 0").select(*LEVELS, "epochs", "rest")
    inside = rows.join(F.broadcast(some) if few else some, list(LEVELS)).withColumn("o", order_of(F.col("epochs"), seed)).select(*LEVELS, "rest", "o", "id", "n_tokens").withColumn("before", F.lit(0).cast("long"))
    for digits in PREFIXES:
        inside = inside.withColumn("bucket", F.substring("o", 1, digits))
        sums = inside.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"), F.first("before").alias("base"))
        run = F.sum("n").over(W.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
        sums = sums.withColumn("before", F.col("base") + F.coalesce(run, F.lit(0).cast("long")))
        cut = stored(sums.filter("before < rest and rest <= before + n").select(*LEVELS, "bucket", "before"), "cut")  # at most one row a leaf
        inside = inside.drop("before").join(F.broadcast(cut) if few else cut, [*LEVELS, "bucket"])
    inside = inside.withColumn("run", F.col("before") + F.coalesce(F.sum("n_tokens").over(W.partitionBy(*LEVELS).orderBy("o", "id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long")))
    last = inside.filter("run < rest").groupBy(*LEVELS).agg(F.max(F.struct("o", "id")).alias("last"))
    return leaf.select(*LEVELS, "epochs").join(last, list(LEVELS), "left").select(*LEVELS, "epochs", F.col("last.o").alias("last_o"), F.col("last.id").alias("last_id"))


def copies(rows: DataFrame, leaf: DataFrame, seed: int = SEED) -> DataFrame:
    """rows (with id and the levels) with `copies`, how often each is taken; rows that are not taken go."""
    few = leaf.limit(LEAVES + 1).count() <= LEAVES
    found = rows.join(F.broadcast(leaf) if few else leaf, list(LEVELS)).withColumn("__o", order_of(F.col("epochs"), seed))
    more = (F.col("__o") < F.col("last_o")) | ((F.col("__o") == F.col("last_o")) & (F.coalesce("id", F.lit(0)) <= F.coalesce("last_id", F.lit(0))))
    return found.withColumn("copies", F.col("epochs") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)).filter("copies > 0").drop("epochs", "last_o", "last_id", "__o")


WEIGHTS = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS}


def mixed(docs: DataFrame, weights: dict[str, dict[str, int]] | None = None, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The documents (own columns) that the mix takes, with `copies` (led by underscores where the documents have such a column); the text is
    not shuffled."""
    weights = WEIGHTS if weights is None else weights
    leaf = stored(plan(stored(slim(docs), "slim"), weights, share, max_epochs, seed), "plan")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    keys = docs.select(F.col("doc_id").cast("long").alias("id"), domain_of(F.col("source")).alias("domain"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), own)
    name = "copies"
    while name in docs.columns:
        name = f"__{name}"
    return copies(keys, leaf, seed).select("__row.*", F.col("copies").alias(name))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    rows = stored(slim(table(spark, sf_dir, "documents")), "slim")
    leaf = stored(plan(rows, WEIGHTS), "plan")
    return copies(rows, leaf).select(F.col("id").alias("doc_id"), *LEVELS, "n_tokens", "copies")


def _case(level: str, weights: dict[str, int]) -> str:
    return f"case {level} " + " ".join(f"when '{k}' then {w}" for k, w in weights.items()) + " else 1 end"


def _fill_sql(source: str, parent: str, child: str) -> str:
    part = f"partition by {parent}" if parent else ""
    return f"""(select *, case when is_full then cap else weight * (budget - coalesce(sum(case when is_full then cap end) over ({part}), 0))
      // coalesce(sum(case when not is_full then weight end) over ({part}), 1) end as share
    from (select *, cap * (sum(weight) over ({part}) - weights) <= weight * (budget - caps) as is_full
      from (select *, coalesce(sum(cap) over w, 0) as caps, coalesce(sum(weight) over w, 0) as weights from {source} where weight > 0
        window w as ({part} order by cap / weight::double, {child} rows between unbounded preceding and 1 preceding))))"""


OP8_SQL = rf"""
with d as (select doc_id as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    case when regexp_full_match(coalesce(source, ''), 'src[0-9]{{1,9}}') then 'd' || (cast(substr(source, 4) as integer) % 4) else 'other' end as domain,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as n_tokens from documents),
leaves as (select domain, lang, source, sum(n_tokens)::bigint as tokens, sum(n_tokens)::bigint * {MAX_EPOCHS} as cap from d group by all),
l1 as (select domain, sum(cap)::bigint as cap, {_case("domain", DOMAIN_WEIGHTS)} as weight, (select floor(sum(tokens) * {SHARE}::double)::bigint from leaves) as budget from leaves group by domain),
s1 as (select domain, share::bigint as budget from {_fill_sql("l1", "", "domain")}),
l2 as (select domain, lang, sum(cap)::bigint as cap, {_case("lang", LANG_WEIGHTS)} as weight, any_value(budget) as budget from leaves join s1 using (domain) group by domain, lang),
s2 as (select domain, lang, share::bigint as budget from {_fill_sql("l2", "domain", "lang")}),
l3 as (select domain, lang, source, tokens, cap, 1 as weight, budget from leaves join s2 using (domain, lang)),
s3 as (select domain, lang, source, tokens, share::bigint as share from {_fill_sql("l3", "domain, lang", "source")}),
leaf as (select *, case when tokens > 0 then share // tokens else 0 end as epochs, share - case when tokens > 0 then share // tokens else 0 end * tokens as rest from s3),
o as (select *, md5('{SEED}:' || epochs || ':' || coalesce(cast(id as varchar), '')) as o from d join leaf using (domain, lang, source)),
r as (select *, coalesce(sum(n_tokens) over (partition by domain, lang, source order by o, id rows between unbounded preceding and 1 preceding), 0) as run from o)
select id as doc_id, domain, lang, source, n_tokens, (epochs + case when run < rest then 1 else 0 end)::bigint as copies from r where epochs + case when run < rest then 1 else 0 end > 0
"""
