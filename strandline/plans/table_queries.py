"""Queries over the star-schema tables, vectors and documents."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.functions import kernels, scalars
from strandline.operators import candidates, cells, fit, gates, ledger, stats
from strandline.operators.stats import fixed
from strandline.operators.versioned import Ledger
from strandline.plans.registry import fx, query, table
from strandline.session import scratch


def _line(spark, sf_dir, *cols):
    return table(spark, sf_dir, "lineitem").select(*cols)


@query("duplicate_keys", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def duplicate_keys(spark, sf_dir):
    from strandline.sources.scan import repeated_keys

    return repeated_keys(_line(spark, sf_dir, "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("missing_keys", "select doc_id from documents where doc_id not in (select doc_id from labels where doc_id is not null)")
def missing_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("point_lookup", "select case when count(*) = 0 then 'missing' else 'found' end as status, count(*) as n, cast(max(o_totalprice * 100) as bigint) as price_e2 from orders where o_orderkey = 777")
def point_lookup(spark, sf_dir):
    found = table(spark, sf_dir, "orders").filter("o_orderkey = 777")
    return found.agg(F.when(F.count(F.lit(1)) == 0, "missing").otherwise("found").alias("status"), F.count(F.lit(1)).alias("n"), F.round(F.max(F.col("o_totalprice") * 100)).cast("long").alias("price_e2"))


@query("left_lookup", "select o_orderkey, c_name, n_name from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey")
def left_lookup(spark, sf_dir):
    """Sides are left to the optimizer: it broadcasts what its statistics show to be small, and sorts the rest."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o["o_custkey"] == c["c_custkey"], "left").join(n, c["c_nationkey"] == n["n_nationkey"], "left").select("o_orderkey", "c_name", "n_name")


_ALL = "l_shipdate desc, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


def _newest() -> list[Column]:
    return [F.desc("l_shipdate")] + [F.asc(c.strip()) for c in _ALL.split(",")[1:]]


@query("first_wins_dedupe", "select n_regionkey, n_nationkey, n_name from (select *, row_number() over (partition by n_regionkey order by n_name, n_nationkey) as rn from nation) where rn = 1")
def first_wins_dedupe(spark, sf_dir):
    return ledger.latest(table(spark, sf_dir, "nation"), ["n_regionkey"], [F.asc("n_name"), F.asc("n_nationkey")]).select("n_regionkey", "n_nationkey", "n_name")


@query("upsert_latest", f"select l_orderkey, l_linenumber, l_partkey, l_suppkey from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {_ALL}) as rn from lineitem) where rn = 1")
def upsert_latest(spark, sf_dir):
    return ledger.latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _newest()).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("ordered_distinct", "select n_regionkey, string_agg(first_letter, ',' order by first_seen) as letters from (select n_regionkey, right(n_name, 1) as first_letter, min(n_nationkey) as first_seen from nation group by all) group by n_regionkey")
def ordered_distinct(spark, sf_dir):
    """Distinct last letters in the order in which they first come up."""
    rows = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("r"))
    return rows.select("n_regionkey", F.array_join(F.array_distinct(F.transform("r", lambda x: F.right(x["n_name"], F.lit(1)))), ",").alias("letters"))


@query("casefold_sort", "select p_partkey, lower(p_name) as name from part order by lower(p_name), p_partkey")
def casefold_sort(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.lower("p_name").alias("name")).orderBy("name", "p_partkey")


_CHECKS = {"quantity": "l_quantity between 5 and 45", "discount": "l_discount <= 0.08", "tax": "l_tax > 0.01", "price": "l_extendedprice < 80000"}


def _checks() -> dict[str, Column]:
    return {k: F.expr(v) for k, v in _CHECKS.items()}


_KEY = "l_orderkey, l_linenumber, l_partkey"


@query("schema_validation", f"select {_KEY}, " + " || ".join(f"case when coalesce({v}, false) then '' else '{k};' end" for k, v in _CHECKS.items()) + " as violations from lineitem")
def schema_validation(spark, sf_dir):
    joined = gates.all_failures(_checks())
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(joined == "", "").otherwise(F.concat(joined, F.lit(";"))).alias("violations"))


@query("all_fail_reasons", f"select {_KEY}, array_to_string(list_filter([" + ", ".join(f"case when not coalesce({v}, false) then '{k}' end" for k, v in _CHECKS.items()) + "], lambda x: x is not null), ';') as reasons from lineitem")
def all_fail_reasons(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", gates.all_failures(_checks()).alias("reasons"))


@query("first_fail_reason", f"select {_KEY}, case " + " ".join(f"when not coalesce({v}, false) then '{k}'" for k, v in _CHECKS.items()) + " end as reason from lineitem")
def first_fail_reason(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", gates.first_failure(_checks()).alias("reason"))


@query("predicate_vector", "select " + ", ".join(f"count(*) filter ({v}) as n_{k}" for k, v in _CHECKS.items()) + ", count(*) filter (" + " and ".join(f"({v})" for v in _CHECKS.values()) + ") as n_accepted from lineitem")
def predicate_vector(spark, sf_dir):
    held = table(spark, sf_dir, "lineitem").select(gates.predicates(_checks()).alias("p"), gates.accepted(_checks()).alias("ok"))
    return held.agg(*[F.count_if(f"p.{k}").alias(f"n_{k}") for k in _CHECKS], F.count_if("ok").alias("n_accepted"))


@query("isin_notnull", "select o_orderkey from orders where o_orderstatus in ('P', 'F') and o_orderpriority is not null")
def isin_notnull(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("P", "F") & F.col("o_orderpriority").isNotNull()).select("o_orderkey")


@query("classify_bucket", "select doc_id, case when n_chars is null or n_chars = 0 then 'unusable' when n_chars < 500 then 'marginal' when n_chars < 5000 then 'usable' else 'long' end as status from documents")
def classify_bucket(spark, sf_dir):
    n = F.col("n_chars")
    return table(spark, sf_dir, "documents").select("doc_id", F.when(n.isNull() | (n == 0), "unusable").when(n < 500, "marginal").when(n < 5000, "usable").otherwise("long").alias("status"))


@query("array_shape_check", "select vec_id, len(embedding) = 64 and list_bool_and(list_transform(embedding, lambda x: isfinite(x))) as valid from embeddings")
def array_shape_check(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", ((F.size("embedding") == 64) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).alias("valid"))


@query("bounds_check", f"select {_KEY}, l_quantity + 3 between 0 and 50 and l_extendedprice - 1000 >= 0 as inside from lineitem")
def bounds_check(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ((F.col("l_quantity") + 3).between(0, 50) & (F.col("l_extendedprice") - 1000 >= 0)).alias("inside"))


@query("filename_guard", r"select page_id, not regexp_matches(url, '(^|/)\.\.(/|$)') and lower(regexp_extract(url, '\.([A-Za-z]+)/', 1)) in ('net', 'org', 'com') as safe from pages")
def filename_guard(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", (~F.col("url").rlike(r"(^|/)\.\.(/|$)") & F.lower(F.regexp_extract("url", r"\.([A-Za-z]+)/", 1)).isin("net", "org", "com")).alias("safe"))


@query("str_suffix_key", "select c_custkey, cast(split_part(c_name, '#', -1) as bigint) as suffix from customer")
def str_suffix_key(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", scalars.suffix_number(F.col("c_name"), "#").alias("suffix"))


@query("str_zero_pad", "select c_custkey, 'frame_' || lpad(cast(c_custkey as varchar), 6, '0') || '.dng' as name from customer")
def str_zero_pad(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.format_string("frame_%06d.dng", "c_custkey").alias("name"))


@query("sha_gate", "select doc_id, sha256(text) as digest from documents")
def sha_gate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


@query("canonical_hash", """select item_id, sha256('{"item_id":' || item_id || ',"length":' || length(text) || '}') as digest from benchmark""")
def canonical_hash(spark, sf_dir):
    """Hash of the row as compact JSON with keys in order."""
    b = table(spark, sf_dir, "benchmark")
    return b.select("item_id", F.sha2(F.to_json(F.struct("item_id", F.char_length("text").alias("length"))), 256).alias("digest"))


@query("config_hash_guard", """select n_regionkey, sha256('{"limit":45,"radius":' || n_regionkey || '}') as digest, n_regionkey = 2 as may_resume, count(*) as n from nation group by n_regionkey""")
def config_hash_guard(spark, sf_dir):
    """A ledger with a segment for each nation, written under the settings of its region; which segments a run with radius 2
    may resume."""
    digest = F.sha2(F.to_json(F.struct(F.lit(45).alias("limit"), F.col("n_regionkey").cast("long").alias("radius"))), 256)
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("segment"), F.col("n_regionkey").cast("long").alias("n_regionkey"), digest.alias("config_sha256"))
    log = Ledger(spark, f"{scratch(spark)}/ledger-{uuid.uuid4().hex}", rows.schema, ["segment"])
    book = log.read(log.commit(rows))
    config = {"radius": 2, "limit": 45}
    ledger.guard(book.filter("n_regionkey = 2"), config)  # raises if these were written with other settings
    found = book.groupBy("n_regionkey", F.col("config_sha256").alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return found.withColumn("may_resume", F.col("digest") == ledger.config_hash(config))


_VERSION = "select {0} as version, l_orderkey, l_linenumber, q from (select *, row_number() over (partition by l_orderkey order by l_linenumber desc) as rn from s where l_linenumber <= {0}) where rn = 1"


@query("ledger_versions", f"with s as (select l_orderkey, l_linenumber, sum(l_quantity) as q from lineitem where l_linenumber <= 3 group by all) {_VERSION.format(2)} union all {_VERSION.format(3)}")
def ledger_versions(spark, sf_dir):
    """Three commits that replace an order's row by that of its next line, one of them replayed, then versions 2 and 3."""
    line = table(spark, sf_dir, "lineitem").filter("l_linenumber <= 3").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").alias("q"))
    log = Ledger(spark, f"{scratch(spark)}/ledger-{uuid.uuid4().hex}", line.schema, ["l_orderkey"])
    for batch in (1, 2, 2, 1, 3):
        log.commit(line.filter(F.col("l_linenumber") == batch), "lines", batch)
    return log.read(2).withColumn("version", F.lit(2)).unionByName(log.read(3).withColumn("version", F.lit(3)))


@query("bit_unpack", "select l_orderkey, l_linenumber, l_partkey, (l_partkey & 4095)::bigint as low12, ((l_orderkey >> 4) & 4095)::bigint as high12, (((l_partkey & 15) << 8) | (l_suppkey & 255))::bigint as packed from lineitem")
def bit_unpack(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").bitwiseAND(4095).alias("low12"), F.shiftright("l_orderkey", 4).bitwiseAND(4095).alias("high12"),
        F.shiftleft(F.col("l_partkey").bitwiseAND(15), 8).bitwiseOR(F.col("l_suppkey").bitwiseAND(255)).alias("packed"),
    )


@query("packed_round_trip", "select (l_partkey & 4095)::int as value, count(*) as n from lineitem group by 1")
def packed_round_trip(spark, sf_dir):
    """Low 12 bits written as packed files by the data source's writer, and read back in ranges."""
    from strandline.sources import packed

    packed.register(spark)
    path = f"{scratch(spark)}/packed-{uuid.uuid4().hex}"
    _line(spark, sf_dir, "l_partkey").select(F.col("l_partkey").bitwiseAND(4095).cast("int").alias("value")).write.format("packed12").mode("append").save(path)
    return spark.read.format("packed12").option("range", 1 << 16).load(path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("to_json_row", "select n_nationkey, '{\"key\":' || n_nationkey || ',\"name\":\"' || n_name || '\"}' as row from nation")
def to_json_row(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", F.to_json(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))).alias("row"))


@query("nested_replace", "select conv_id, turn, role, replace(text, 'the', 'THE') as text from conversations")
def nested_replace(spark, sf_dir):
    nested = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.create_map(F.lit("role"), "role", F.lit("text"), "text").alias("m"))
    swapped = nested.withColumn("m", F.transform_values("m", lambda k, v: F.when(k == "text", F.replace(v, F.lit("the"), F.lit("THE"))).otherwise(v)))
    return swapped.select("conv_id", "turn", F.col("m")["role"].alias("role"), F.col("m")["text"].alias("text"))


@query("sink_readback", "select count(*) as n, cast(sum(o_orderkey) as bigint) as keys, true as verified from orders")
def sink_readback(spark, sf_dir):
    """Write, read back and compare; the figures are those of what was read back."""
    back = ledger.write_verified(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), f"{scratch(spark)}/sink-{uuid.uuid4().hex}")
    return back.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.lit(True).alias("verified"))


@query("affine_projection", f"select {_KEY}, l_quantity + 159 as x, l_extendedprice - 413 as y, 1133 as w, 900 as h from lineitem")
def affine_projection(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") + 159).alias("x"), (F.col("l_extendedprice") - 413).alias("y"), F.lit(1133).alias("w"), F.lit(900).alias("h"))


_MATH = {
    "hyp": ("sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber)", lambda: F.hypot("l_quantity", "l_linenumber")), "lg": ("ln(1 + l_extendedprice)", lambda: F.log1p("l_extendedprice")),
    "dec": ("log10(l_extendedprice)", lambda: F.log10("l_extendedprice")), "pw": ("power(2.0, -l_discount)", lambda: F.pow(F.lit(2.0), -F.col("l_discount"))),
    "clip": ("greatest(10, least(40, l_quantity))", lambda: F.greatest(F.lit(10.0), F.least(F.lit(40.0), F.col("l_quantity")))), "wave": ("cos(l_quantity) + sin(l_tax)", lambda: F.cos("l_quantity") + F.sin("l_tax")),
}


@query("math_scalars", f"select {_KEY}, " + ", ".join(f"{fx(s)} as {k}_e4" for k, (s, _) in _MATH.items()) + " from lineitem")
def math_scalars(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *[fixed(f()).alias(f"{k}_e4") for k, (_, f) in _MATH.items()])


@query("soft_compress", f"select {_KEY}, {fx('l_quantity / (1 + 0.12 * l_quantity)')} as soft_e4, {fx('greatest(power(2.0, -0.65), least(power(2.0, 0.65), 25.0 / l_quantity))')} as gain_e4 from lineitem")
def soft_compress(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", fixed(scalars.soft_compress(F.col("l_quantity"))).alias("soft_e4"), fixed(scalars.clamp_stops(F.lit(25.0) / F.col("l_quantity"))).alias("gain_e4"))


@query("dot_product", f"select vec_id, {fx('0.2126 * embedding[1]::double + 0.7152 * embedding[2]::double + 0.0722 * embedding[3]::double', 5)} as luma_e5, {fx('list_sum(list_transform(embedding, lambda x: x::double * x::double))', 4)} as norm_e4 from embeddings")
def dot_product(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("x", F.col("embedding").cast("array<double>"))
    return e.select("vec_id", fixed(scalars.luma(F.slice("x", 1, 3)), 5).alias("luma_e5"), fixed(scalars.dot(F.col("x"), F.col("x")), 4).alias("norm_e4"))


@query("poly_features", f"select vec_id, {fx('r + g + b', 5)} as linear_e5, {fx('r * r + g * g + b * b + r * g + r * b + g * b', 5)} as square_e5, {fx('sqrt(r) + sqrt(g) + sqrt(b)', 5)} as root_e5 from (select vec_id, abs(embedding[1]::double) as r, abs(embedding[2]::double) as g, abs(embedding[3]::double) as b from embeddings)")
def poly_features(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", scalars.polynomial(*[F.abs(F.col("embedding")[k].cast("double")) for k in range(3)]).alias("f"))
    part = lambda a, n: F.aggregate(F.slice("f", a, n), F.lit(0.0), lambda s, x: s + x)
    return e.select("vec_id", fixed(part(2, 3), 5).alias("linear_e5"), fixed(part(8, 6), 5).alias("square_e5"), fixed(part(5, 3), 5).alias("root_e5"))


@query("contrast_about_mean", f"with m as (select l_returnflag, avg(l_quantity) as m from lineitem group by l_returnflag) select {_KEY}, {fx('m + (l_quantity - m) * 1.2', 3)} as c_e3 from lineitem join m using (l_returnflag)")
def contrast_about_mean(spark, sf_dir):
    """The group means have one row a flag; joining them back moves no line, where a window would sort them all."""
    line = table(spark, sf_dir, "lineitem")
    mean = line.groupBy("l_returnflag").agg(F.avg("l_quantity").alias("m"))
    return line.join(mean, "l_returnflag").select("l_orderkey", "l_linenumber", "l_partkey", fixed(F.col("m") + (F.col("l_quantity") - F.col("m")) * 1.2, 3).alias("c_e3"))


@query("minmax_percentile", f"with p as (select quantile_cont(p_retailprice, 0.01) as a, quantile_cont(p_retailprice, 0.99) as b from part) select p_partkey, {fx('greatest(0, least(1, (p_retailprice - a) / nullif(b - a, 0)))')} as x_e4 from part, p")
def minmax_percentile(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    p = stats.quantiles(part.withColumn("all", F.lit(0)), "all", "p_retailprice", [0.01, 0.99]).select("q")  # one row
    x = F.try_divide(F.col("p_retailprice") - F.col("q")[0], F.col("q")[1] - F.col("q")[0])
    return part.join(F.broadcast(p)).select("p_partkey", fixed(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))).alias("x_e4"))


@query("percent_of_total", f"with s as (select l_returnflag, sum(l_quantity) as q from lineitem group by l_returnflag) select l_returnflag, q, {fx('100 * q / sum(q) over ()', 3)} as pct_e3 from s order by q desc")
def percent_of_total(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.sum("l_quantity").alias("q"))
    return s.withColumn("pct_e3", fixed(100 * F.col("q") / F.sum("q").over(W.partitionBy(F.lit(1))), 3)).orderBy(F.desc("q"))


@query("array_ops", f"select vec_id, {fx('list_max(embedding)::double', 5)} as top_e5, (list_position(embedding, list_max(embedding)) - 1)::int as arg, len(list_filter(embedding, lambda x: x > 0.1))::int as n_high, {fx('list_sum(list_transform(list_sort(embedding)[63:64], lambda x: x::double))', 5)} as top2_e5 from embeddings")
def array_ops(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    two = F.transform(F.slice(F.sort_array("embedding", False), 1, 2), lambda x: x.cast("double"))
    return e.select("vec_id", fixed(F.array_max("embedding").cast("double"), 5).alias("top_e5"), (F.array_position("embedding", F.array_max("embedding")) - 1).cast("int").alias("arg"), F.size(F.filter("embedding", lambda x: x > 0.1)).alias("n_high"), fixed(two[0] + two[1], 5).alias("top2_e5"))


@query("map_ops", "select o_orderkey, coalesce(case when o_orderstatus = 'P' then 7 when o_orderstatus = 'F' then 2 end, 0) as looked, 3 as n_keys from orders")
def map_ops(spark, sf_dir):
    """Defaults overridden by a second map, then a lookup with a default."""
    m = F.map_concat(F.map_from_arrays(F.array(F.lit("F"), F.lit("X")), F.array(F.lit(2), F.lit(9))), F.map_from_arrays(F.array(F.lit("P")), F.array(F.lit(7))))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(F.try_element_at(m, F.col("o_orderstatus")), F.lit(0)).alias("looked"), F.size(m).alias("n_keys"))


@query("struct_flatten", "select c_custkey, c_name as name, c_acctbal < 0 as in_debt, n_name as nation from customer join nation on c_nationkey = n_nationkey")
def struct_flatten(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    nested = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select("c_custkey", F.struct(F.col("c_name").alias("name"), (F.col("c_acctbal") < 0).alias("in_debt")).alias("who"), F.struct(F.col("n_name").alias("nation")).alias("place"))
    return nested.select("c_custkey", "who.*", "place.*")


@query("explode_nested", "select o_custkey, o_orderkey, l_linenumber, l_partkey from orders join lineitem on o_orderkey = l_orderkey")
def explode_nested(spark, sf_dir):
    """Order records nested as segments with their lines, then flattened again."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey")).alias("lines"))
    nested = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", F.struct("o_orderkey", "lines").alias("segment"))
    return nested.select("o_custkey", "segment.o_orderkey", F.explode("segment.lines").alias("r")).select("o_custkey", "o_orderkey", "r.l_linenumber", "r.l_partkey")


@query("map_rollup", f"select k, {fx('sum(v)', 2)} as total_e2 from (select 'discount' as k, l_discount as v from lineitem union all select 'tax', l_tax from lineitem union all select 'quantity', l_quantity from lineitem) group by k")
def map_rollup(spark, sf_dir):
    maps = table(spark, sf_dir, "lineitem").select(F.create_map(F.lit("discount"), "l_discount", F.lit("tax"), "l_tax", F.lit("quantity"), "l_quantity").alias("m"))
    return maps.select(F.explode("m").alias("k", "v")).groupBy("k").agg(fixed(F.sum("v"), 2).alias("total_e2"))


@query("mad_band_filter", "with c as (select p_brand, median(p_retailprice) as centre from part group by p_brand), m as (select p_brand, median(abs(p_retailprice - centre)) as mad from part join c using (p_brand) group by p_brand) select p_partkey, abs(p_retailprice - centre) <= greatest(6, 1.2 * mad) as in_band from part join c using (p_brand) join m using (p_brand)")
def mad_band_filter(spark, sf_dir):
    return gates.mad_band(table(spark, sf_dir, "part"), "p_brand", "p_retailprice", 6.0, 1.2).select("p_partkey", "in_band")


@query("two_source_agreement", "select l_orderkey, l_linenumber, l_partkey, case when p_partkey is null then 'single' when abs(l_extendedprice / l_quantity - p_retailprice) <= 500 then 'agreed' else 'conflict' end as disposition from lineitem left join part on l_partkey = p_partkey")
def two_source_agreement(spark, sf_dir):
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    verdict = F.when(F.col("p_partkey").isNull(), "single").when(F.abs(unit - F.col("p_retailprice")) <= 500, "agreed").otherwise("conflict")
    return line.join(part, line["l_partkey"] == part["p_partkey"], "left").select("l_orderkey", "l_linenumber", "l_partkey", verdict.alias("disposition"))


@query("filtered_vs_total", f"select l_returnflag, count(*) filter (l_discount < 0.05) as n, {fx('median(l_quantity) filter (l_discount < 0.05)', 3)} as median_e3, {fx('avg(case when l_quantity >= 48 then 1.0 else 0 end)')} as clipped_e4 from lineitem group by l_returnflag")
def filtered_vs_total(spark, sf_dir):
    kept = F.col("l_discount") < 0.05
    line = table(spark, sf_dir, "lineitem")
    middle = stats.quantiles(line.filter(kept), "l_returnflag", "l_quantity", [0.5]).select("l_returnflag", fixed(F.col("q")[0], 3).alias("median_e3"))
    all_rows = line.groupBy("l_returnflag").agg(F.count_if(kept).alias("n"), fixed(F.avg(F.when(F.col("l_quantity") >= 48, 1.0).otherwise(0.0))).alias("clipped_e4"))
    return all_rows.join(middle, "l_returnflag", "left")


@query("stddev_pop", f"select l_returnflag, {fx('stddev_pop(l_quantity)')} as spread_e4 from lineitem group by l_returnflag")
def stddev_pop(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(fixed(F.stddev_pop("l_quantity")).alias("spread_e4"))


@query("geo_mean", f"select l_returnflag, {fx('exp(avg(ln(greatest(l_extendedprice, 0.000001))))', 2)} as g_e2 from lineitem group by l_returnflag")
def geo_mean(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(fixed(F.exp(F.avg(F.ln(F.greatest(F.col("l_extendedprice"), F.lit(1e-6))))), 2).alias("g_e2"))


@query("least_squares_1d", f"select l_returnflag, {fx('regr_slope(l_extendedprice, l_quantity)', 3)} as slope_e3, {fx('regr_intercept(l_extendedprice, l_quantity)', 2)} as shift_e2, {fx('regr_r2(l_extendedprice, l_quantity)', 6)} as r2_e6 from lineitem group by l_returnflag")
def least_squares_1d(spark, sf_dir):
    y, x = "l_extendedprice", "l_quantity"
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(fixed(F.regr_slope(y, x), 3).alias("slope_e3"), fixed(F.regr_intercept(y, x), 2).alias("shift_e2"), fixed(F.regr_r2(y, x), 6).alias("r2_e6"))


_LUT = """s as (select l_extendedprice / 105000.0 as x, l_quantity as y from lineitem), m as (select cast(floor(x * 256) as bigint) as bin, median(y) as m from s where x >= 0 and x < 1 group by 1),
g as (select r.bin, m from (select unnest(range(256)) as bin) r left join m on r.bin = m.bin), n as (select *, last_value(m ignore nulls) over b as v0, first_value(m ignore nulls) over f as v1, last_value(case when m is not null then bin end ignore nulls) over b as b0, first_value(case when m is not null then bin end ignore nulls) over f as b1 from g
 window b as (order by bin rows between unbounded preceding and current row), f as (order by bin rows between current row and unbounded following)),
v as (select bin, m is not null as seen, case when m is not null then m when v0 is null then v1 when v1 is null then v0 else v0 + (v1 - v0) * (bin - b0) / (b1 - b0) end as value from n),
lut as (select bin, seen, value, max(value) over (order by bin) as level from v)"""


def _lut(spark, sf_dir):
    scaled = table(spark, sf_dir, "lineitem").select((F.col("l_extendedprice") / 105000.0).alias("x"), F.col("l_quantity").alias("y"))
    return stats.binned_lut(scaled, "x", "y")


@query("binned_median_lut", f"with {_LUT} select bin, seen, {fx('value')} as value_e4, {fx('level')} as level_e4 from lut")
def binned_median_lut(spark, sf_dir):
    return _lut(spark, sf_dir).select("bin", "seen", fixed(F.col("value")).alias("value_e4"), fixed(F.col("level")).alias("level_e4"))


@query("lut_interpolate", f"with {_LUT}, q as (select p_partkey, greatest(0, least(1, p_retailprice / 2200.0)) * 255 as p from part), i as (select *, cast(floor(p) as bigint) as i from q) select p_partkey, {fx('a.level + (b.level - a.level) * (p - i)', 3)} as y_e3 from i join lut a on a.bin = i join lut b on b.bin = least(i + 1, 255)")
def lut_interpolate(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_retailprice") / 2200.0).alias("x"))
    return stats.lookup(part, _lut(spark, sf_dir).select("bin", "level"), "x", "y").select("p_partkey", fixed(F.col("y"), 3).alias("y_e3"))


@query("hash_sample", "select doc_id, lang from (select doc_id, lang, row_number() over (partition by lang order by (doc_id * 7919 + 17) % 1000003, doc_id) as rn from documents) where rn <= 20")
def hash_sample(spark, sf_dir):
    order = (F.col("doc_id") * 7919 + 17) % 1000003
    return candidates.top_k(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], [order.asc(), F.asc("doc_id")], 20).select("doc_id", "lang")


@query("holdout_split", "select source, count(*) filter ((doc_id * 31 + 7) % 5 = 0) as held_out, count(*) filter ((doc_id * 31 + 7) % 5 <> 0) as train from documents group by source")
def holdout_split(spark, sf_dir):
    out = (F.col("doc_id") * 31 + 7) % 5 == 0
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count_if(out).alias("held_out"), F.count_if(~out).alias("train"))


@query("argmin_tiebreak", "select l_orderkey, l_linenumber, l_partkey from (select *, row_number() over (partition by l_orderkey order by l_discount, l_linenumber, l_partkey) as rn from lineitem) where rn = 1")
def argmin_tiebreak(spark, sf_dir):
    best = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(F.struct("l_discount", "l_linenumber", "l_partkey")).alias("b"))
    return best.select("l_orderkey", "b.l_linenumber", "b.l_partkey")


@query("topk_per_group", "select p_brand, p_partkey, rank from (select *, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey)::int as rank from part) where rank <= 5")
def topk_per_group(spark, sf_dir):
    return candidates.top_k(table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")], 5).select("p_brand", "p_partkey", "rank")


@query("composite_score", f"select p_partkey, {fx('2 * p_size / 50.0 - 0.5 * abs(p_retailprice - 1000) / 1000 - ln(greatest(0.04, 1 - least(p_retailprice / 3000, 1))) + least(p_size, 25) / greatest(p_size, 25.0) + case when p_name like $$%widget$$ then 0.25 else 0 end')} as score_e4 from part")
def composite_score(spark, sf_dir):
    size, price = F.col("p_size"), F.col("p_retailprice")
    score = (
        2 * size / 50.0 - 0.5 * F.abs(price - 1000) / 1000 - F.ln(F.greatest(F.lit(0.04), 1 - F.least(price / 3000, F.lit(1.0)))) + F.least(size, F.lit(25)) / F.greatest(size, F.lit(25.0))
        + F.when(F.col("p_name").endswith("widget"), 0.25).otherwise(0.0)
    )
    return table(spark, sf_dir, "part").select("p_partkey", fixed(score).alias("score_e4"))


@query("l1_rank", "with m as (select p_brand, median(p_size) as ms, median(p_retailprice) as mp from part group by p_brand) select p_brand, p_partkey from (select p.*, row_number() over (partition by p.p_brand order by abs(p_size - coalesce(ms, 25)) + abs(p_retailprice - coalesce(mp, 1000)) / 100, p_partkey) as rn from part p join m on p.p_brand = m.p_brand) where rn = 1")
def l1_rank(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size", "p_retailprice")
    median = lambda value, name: stats.quantiles(part, "p_brand", value, [0.5]).select("p_brand", F.col("q")[0].alias(name))
    model = median("p_size", "ms").join(median("p_retailprice", "mp"), "p_brand", "full")
    cost = F.abs(F.col("p_size") - F.coalesce("ms", F.lit(25.0))) + F.abs(F.col("p_retailprice") - F.coalesce("mp", F.lit(1000.0))) / 100
    return part.join(model, "p_brand").groupBy("p_brand").agg(F.min(F.struct(cost.alias("c"), "p_partkey")).alias("b")).select("p_brand", "b.p_partkey")


@query("cluster_summary", f"with c as (select p_brand, p_type, median(p_size) as m from part group by all), n as (select p.p_brand, p.p_type, p_partkey, p_size, row_number() over (partition by p.p_brand, p.p_type order by abs(p_size - m), p_partkey) as rn from part p join c on p.p_brand = c.p_brand and p.p_type = c.p_type) select p_brand, count(*) as strips, {fx('median(p_size)', 2)} as centre_e2, {fx('stddev_pop(p_size)', 3)} as spread_e3 from n where rn = 1 group by p_brand having count(*) >= 3")
def cluster_summary(spark, sf_dir):
    """Of each strip the row nearest its centre, then medians and spread of clusters with support."""
    part = table(spark, sf_dir, "part").select("p_brand", "p_type", "p_partkey", "p_size")
    centre = stats.quantiles(part, ["p_brand", "p_type"], "p_size", [0.5]).select("p_brand", "p_type", F.col("q")[0].alias("m"))
    near = part.join(centre, ["p_brand", "p_type"]).groupBy("p_brand", "p_type").agg(F.min(F.struct(F.abs(F.col("p_size") - F.col("m")).alias("d"), "p_partkey", "p_size")).alias("b"))
    middle = stats.quantiles(near.select("p_brand", "b.p_size"), "p_brand", "p_size", [0.5]).select("p_brand", fixed(F.col("q")[0], 2).alias("centre_e2"))
    found = near.groupBy("p_brand").agg(F.count(F.lit(1)).alias("strips"), fixed(F.stddev_pop("b.p_size"), 3).alias("spread_e3"))
    return found.filter("strips >= 3").join(middle, "p_brand").select("p_brand", "strips", "centre_e2", "spread_e3")


@query("nearest_prior", f"select p_partkey, {fx('0.02 * least(min(abs(p_retailprice - s_acctbal / 4)), 200) / 200', 6)} as penalty_e6 from part join supplier on true group by p_partkey")
def nearest_prior(spark, sf_dir):
    """Penalty by the distance to the nearest prior."""
    part, prior = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), table(spark, sf_dir, "supplier").select((F.col("s_acctbal") / 4).alias("x"))
    return candidates.nearest(part, prior, "p_retailprice", "x").select("p_partkey", fixed(0.02 * F.least(F.coalesce("distance", F.lit(0.0)), F.lit(200.0)) / 200, 6).alias("penalty_e6"))


_COS = "list_sum(list_transform(range(1, 65), lambda i: a.embedding[i]::double * b.embedding[i]::double)) / sqrt(list_sum(list_transform(a.embedding, lambda x: x::double * x::double)) * list_sum(list_transform(b.embedding, lambda x: x::double * x::double)))"


@query("similarity_topk_margin", f"""with q as (select * from embeddings where vec_id % 50 = 0), s as (select a.vec_id, b.vec_id as other, a.label = b.label as agrees, {_COS} as c from q a join embeddings b on a.vec_id <> b.vec_id),
    r as (select *, row_number() over (partition by vec_id order by c desc, other) as rn from s) select vec_id, max(other) filter (rn = 1) as best, bool_or(agrees) filter (rn = 1) as agrees, {fx('max(c) filter (rn = 1) - max(c) filter (rn = 2)', 5)} as margin_e5 from r where rn <= 3 group by vec_id""")
def similarity_topk_margin(spark, sf_dir):
    """The query set is every vector whose id is divisible by 50; it meets all rows, in blocks."""
    e = table(spark, sf_dir, "embeddings")
    three = candidates.vector_top_k(e.filter("vec_id % 50 = 0"), e, "vec_id", "embedding", 3)
    at = lambda k, c: F.max(F.when(F.col("rank") == k, F.col(c)))
    best = three.groupBy(F.col("q").alias("vec_id")).agg(at(1, "id").alias("best"), (at(1, "c") - at(2, "c")).alias("margin"))
    own, other = e.select("vec_id", F.col("label").alias("__own")), e.select(F.col("vec_id").alias("best"), F.col("label").alias("__other"))
    return best.join(own, "vec_id").join(other, "best").select("vec_id", "best", (F.col("__own") == F.col("__other")).alias("agrees"), fixed(F.col("margin"), 5).alias("margin_e5"))


_TERMS = ("r", "g", "b", "sqrt_r", "sqrt_g", "sqrt_b", "rr", "gg", "bb", "rg", "rb", "gb")


@query("least_squares_multi", f"""with t as (select unnest([{', '.join(repr(t) for t in ('1', *_TERMS))}]) as term), y as (select unnest(['a', 'b', 'c']) as target),
    n as (select label, count(*) as n, sum(abs(embedding[4]::double)) + sum(abs(embedding[5]::double)) + sum(abs(embedding[6]::double)) as size from embeddings group by label)
    select label, target, term, n, 12 as rank, 0::bigint as left_e6, {fx('size', 3)} as size_e3 from n, y, t""")
def least_squares_multi(spark, sf_dir):
    """Three targets on 12 polynomial terms and a constant, by label. Of a fit that is right nothing is left: in every group the
    residuals of a target add up to zero, and so do their products with each term."""
    e = table(spark, sf_dir, "embeddings").withColumn("v", F.transform("embedding", lambda x: x.cast("double")))
    e = e.withColumn("x", scalars.polynomial(*[F.abs(F.col("v")[k]) for k in range(3)])).select("label", "v", "x")
    terms = {t: F.col("x")[k + 1] for k, t in enumerate(_TERMS)}
    targets = {t: F.col("v")[k + 3] for k, t in enumerate("abc")}
    model = fit.fit(e, "label", terms, targets)
    left = fit.residuals(e, "label", terms, targets, model)
    whole = {"1": F.lit(1.0), **terms}
    sums = F.array(*[F.struct(F.lit(t).alias("target"), F.lit(n).alias("term"), F.sum(F.col("residuals")[k] * x).alias("s")) for k, t in enumerate(targets) for n, x in whole.items()])
    size = sum((F.sum(F.abs(y)) for y in targets.values()), F.lit(0.0))
    found = left.groupBy("label").agg(sums.alias("sums"), fixed(size, 3).alias("size_e3")).select("label", "size_e3", F.explode("sums").alias("p"))
    return found.join(model.select("label", "target", "n", "rank"), (found["label"] == model["label"]) & (F.col("p.target") == F.col("target"))).select(
        found["label"], "target", F.col("p.term").alias("term"), "n", "rank", fixed(F.abs(F.col("p.s")), 6).alias("left_e6"), "size_e3"
    )


_LIT = "lit as (select distinct l_suppkey % 3 as grid, (l_partkey // 40) % 60 as y, l_partkey % 40 as x from lineitem where l_partkey < 2400 and (l_partkey * 7919) % 11 < 5)"


@query("cell_components", f"""with recursive {_LIT}, n as (select a.grid, a.y, a.x, b.y as v, b.x as u from lit a join lit b on a.grid = b.grid and abs(a.y - b.y) <= 1 and abs(a.x - b.x) <= 1),
    r as (select grid, y, x, y as ry, x as rx from lit union select n.grid, n.v, n.u, r.ry, r.rx from r join n on n.grid = r.grid and n.y = r.y and n.x = r.x where (r.ry, r.rx) < (n.v, n.u)),
    m as (select grid, y, x, min((ry, rx)) as root from (select grid, y, x, ry, rx from r) group by all) select grid, root[1] as first_line, root[2] as first_at, count(*) as area, min(y) as top, max(y) as bottom, min(x) as left_x, max(x) as right_x, {fx('avg(y)', 3)} as y_e3, {fx('avg(x)', 3)} as x_e3 from m group by grid, root""")
def cell_components(spark, sf_dir):
    """Connected components, corners included, of the lit cells of three grids."""
    p = F.col("l_partkey")
    lit = table(spark, sf_dir, "lineitem").filter((p < 2400) & ((p * 7919) % 11 < 5)).select((F.col("l_suppkey") % 3).alias("grid"), F.expr("(l_partkey div 40) % 60").alias("y"), (p % 40).alias("x")).distinct()
    found = cells.components(lit, "grid", "y", "x")
    return found.select("grid", "first_line", "first_at", "area", "top", "bottom", F.col("left").alias("left_x"), F.col("right").alias("right_x"), fixed(F.col("y"), 3).alias("y_e3"), fixed(F.col("x"), 3).alias("x_e3"))


@query("set_except", "select distinct c_nationkey as k from customer except select s_nationkey from supplier where s_acctbal > 5000")
def set_except(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).distinct().subtract(table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select("s_nationkey"))


@query("set_intersect", "select c_nationkey as k from customer where c_acctbal > 9000 intersect select s_nationkey from supplier")
def set_intersect(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("set_union", "select c_nationkey as k from customer where c_acctbal > 9900 union select s_nationkey from supplier where s_acctbal > 9000")
def set_union(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("k")).union(table(spark, sf_dir, "supplier").filter("s_acctbal > 9000").select("s_nationkey")).distinct()


@query("grid_union", "select distinct cast(l_quantity as bigint) // 4 as gx, cast(floor(l_extendedprice / 500) as bigint) as gy from lineitem where l_discount < 0.03 union select distinct cast(l_quantity as bigint) // 4, cast(floor(l_extendedprice / 500) as bigint) from lineitem where l_tax > 0.06")
def grid_union(spark, sf_dir):
    cell = lambda d: d.select(F.floor(F.col("l_quantity") / 4).cast("long").alias("gx"), F.floor(F.col("l_extendedprice") / 500).cast("long").alias("gy"))
    line = table(spark, sf_dir, "lineitem")
    return cell(line.filter("l_discount < 0.03")).unionByName(cell(line.filter("l_tax > 0.06"))).dropDuplicates(["gx", "gy"])


@query("coarse_to_fine", """with c as (select p_partkey, p_size, p_retailprice, x * 8 as x, y * 8 as y from part, (select unnest(range(0, 8)) as x), (select unnest(range(0, 8)) as y)),
    r as (select *, row_number() over (partition by p_partkey order by (x - p_size) * (x - p_size) + (y - p_retailprice / 100) * (y - p_retailprice / 100), x, y) as rn from c),
    f as (select p_partkey, p_size, p_retailprice, x + dx as x, y + dy as y from r, (select unnest(range(-4, 5)) as dx), (select unnest(range(-4, 5)) as dy) where rn <= 2),
    b as (select *, row_number() over (partition by p_partkey order by (x - p_size) * (x - p_size) + (y - p_retailprice / 100) * (y - p_retailprice / 100), x, y) as rn from f) select p_partkey, x::bigint as x, y::bigint as y from b where rn = 1""")
def coarse_to_fine(spark, sf_dir):
    """A coarse grid, its best two nodes, a fine grid around those, the best: array code over batches, no shuffle."""
    part = table(spark, sf_dir, "part").select("p_partkey", kernels.nearest_node(F.col("p_size"), F.col("p_retailprice") / 100).alias("b"))
    return part.select("p_partkey", "b.x", "b.y")


@query("refine_1d", f"""with g as (select p_partkey, (k - 12) * 0.25 as shift, -abs((k - 12) * 0.25 - (p_size - 25) / 10.0) as score from part, (select unnest(range(0, 25)) as k)), b as (select *, row_number() over (partition by p_partkey order by score desc, abs(shift), shift) as rn from g),
    w as (select * from b where rn = 1), r as (select b.p_partkey, max(b.score) as rival from b join w on b.p_partkey = w.p_partkey and abs(b.shift - w.shift) >= 1.0 group by b.p_partkey) select w.p_partkey, {fx('shift', 2)} as shift_e2, {fx('w.score - rival', 3)} as margin_e3, abs(shift) = 3 as at_boundary from w join r on w.p_partkey = r.p_partkey""")
def refine_1d(spark, sf_dir):
    """25 points at +-3 by 0.25; the best (ties: least shift), the rival at least 1 away, and whether the end was hit."""
    steps = F.array(*[F.lit((k - 12) * 0.25) for k in range(25)])
    score = lambda s: -F.abs(s - (F.col("p_size") - 25) / 10.0)
    part = table(spark, sf_dir, "part").withColumn("b", F.array_min(F.transform(steps, lambda s: F.struct((-score(s)).alias("c"), F.abs(s).alias("a"), s.alias("s")))))
    part = part.withColumn("rival", F.array_max(F.transform(F.filter(steps, lambda s: F.abs(s - F.col("b.s")) >= 1.0), score)))
    return part.select("p_partkey", fixed(F.col("b.s"), 2).alias("shift_e2"), fixed(-F.col("b.c") - F.col("rival"), 3).alias("margin_e3"), (F.abs("b.s") == 3).alias("at_boundary"))


@query("ambiguity_ratio", "with r as (select p_brand, p_retailprice / 1000 as s, row_number() over (partition by p_brand order by p_retailprice, p_partkey) as rn from part) select p_brand, coalesce(max(s) filter (rn = 2) <= 1.15 * max(s) filter (rn = 1) + 0.03, false) as ambiguous from r group by p_brand")
def ambiguity_ratio(spark, sf_dir):
    two = candidates.top_k(table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], [F.asc("p_retailprice"), F.asc("p_partkey")], 2)
    s = lambda k: F.max(F.when(F.col("rank") == k, F.col("p_retailprice") / 1000))
    return two.groupBy("p_brand").agg(F.coalesce(s(2) <= 1.15 * s(1) + 0.03, F.lit(False)).alias("ambiguous"))


@query("event_sequence_check", "select conv_id, count(*) as n, min(turn) = 0 and max(turn) = count(*) - 1 and count(distinct turn) = count(*) as monotone from conversations group by conv_id")
def event_sequence_check(spark, sf_dir):
    n = F.count(F.lit(1))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(n.alias("n"), ((F.min("turn") == 0) & (F.max("turn") == n - 1) & (F.count_distinct("turn") == n)).alias("monotone"))
