"""Queries of the sequence family over `events`."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.operators import candidates, cascade, intervals, ledger, match, sequence, stats
from strandline.operators.stats import fixed
from strandline.plans.registry import EV, SQL, events, fx, query
from strandline.session import kept, scratch

_FIVE = """f as (select *, coalesce(v, median(v) over (partition by series)) as fv from e),
g as (select *, first_value(fv) over (partition by series order by seq rows between unbounded preceding and unbounded following) as a,
  last_value(fv) over (partition by series order by seq rows between unbounded preceding and unbounded following) as z from f),
h as (select *, list_sort([coalesce(lag(fv, 2) over w, a), coalesce(lag(fv, 1) over w, a), fv, coalesce(lead(fv, 1) over w, z), coalesce(lead(fv, 2) over w, z)])[3] as local
  from g window w as (partition by series order by seq)),
acc as (select *, coalesce(v is not null and abs(v - local) < 45, false) as accepted from h)"""
_LERP = """p as (select *, row_number() over (partition by series order by seq) as p, case when {knot} then {value} end as k from {src}),
p1 as (select *, case when k is not null then p end as kp from p),
p2 as (select *, last_value(k ignore nulls) over b as v0, last_value(kp ignore nulls) over b as p0, first_value(k ignore nulls) over f as v1, first_value(kp ignore nulls) over f as p1 from p1
  window b as (partition by series order by seq rows between unbounded preceding and current row), f as (partition by series order by seq rows between current row and unbounded following)),
filled as (select *, case when k is not null then k when v0 is null then v1 when v1 is null then v0 else v0 + (v1 - v0) * (p - p0) / (p1 - p0) end as filled,
  case when k is not null then 'measured' when v0 is null and v1 is null then 'none' when v0 is null or v1 is null then 'fallback' else 'interpolated' end as source from p2)"""


@query(
    "sequence_quality",
    f"""with {EV}, {_FIVE}, {_LERP.format(knot="accepted", value="v", src="acc")},
    s as (select *, quantile_cont(filled, 0.5) over (partition by series order by seq rows between 4 preceding and 4 following) as smooth from filled)
    select series, count(*) as n, count(*) filter (source = 'measured') as n_measured, count(*) filter (source = 'interpolated') as n_interpolated,
      count(*) filter (source = 'fallback') as n_fallback, min(seq) as first_seq, max(seq) as last_seq, {fx("avg(smooth)", 3)} as mean_smooth_e3, {fx("max(smooth)", 3)} as max_smooth_e3
    from s group by series""",
)
def sequence_quality(spark, sf_dir):
    """Reject, gate by the local median, interpolate, smooth, and summarise every series: one shuffle."""
    e = events(spark, sf_dir).select("seq", "series", "v")
    cuts = sequence.measure(e, "series", "seq")
    gated = sequence.local_median_gate(e, "series", "seq", "v", 45.0, cuts=cuts)
    filled = sequence.interpolate(gated, "series", "seq", "v", F.col("accepted"), cuts=cuts)
    smooth = sequence.rolling_median(filled, "series", "seq", "filled", "smooth", cuts=cuts)
    return smooth.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("source") == "measured").alias("n_measured"), F.count_if(F.col("source") == "interpolated").alias("n_interpolated"),
        F.count_if(F.col("source") == "fallback").alias("n_fallback"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
        fixed(F.avg("smooth"), 3).alias("mean_smooth_e3"), fixed(F.max("smooth"), 3).alias("max_smooth_e3"),
    )


@query("rolling_median_9", f"with {EV} select seq, series, {fx('quantile_cont(value, 0.5) over (partition by series order by seq rows between 4 preceding and 4 following)', 3)} as m_e3 from e")
def rolling_median_9(spark, sf_dir):
    return sequence.rolling_median(events(spark, sf_dir), "series", "seq", "value", "m").select("seq", "series", fixed(F.col("m"), 3).alias("m_e3"))


@query("trailing_median_25", f"with {EV} select seq, series, {fx('quantile_cont(value, 0.5) over (partition by series order by seq rows between 25 preceding and 1 preceding)', 3)} as m_e3 from e")
def trailing_median_25(spark, sf_dir):
    return sequence.trailing_median(events(spark, sf_dir), "series", "seq", "value", "m").select("seq", "series", fixed(F.col("m"), 3).alias("m_e3"))


@query("local_median_outlier", f"with {EV}, {_FIVE} select seq, series, {fx('local', 3)} as local_e3, accepted from acc")
def local_median_outlier(spark, sf_dir):
    found = sequence.local_median_gate(events(spark, sf_dir), "series", "seq", "v", 45.0)
    return found.select("seq", "series", fixed(F.col("local"), 3).alias("local_e3"), "accepted")


@query("linear_interpolate", f"with {EV}, {_LERP.format(knot='v is not null', value='v', src='e')} select seq, series, {fx('filled')} as filled_e4, source from filled")
def linear_interpolate(spark, sf_dir):
    found = sequence.interpolate(events(spark, sf_dir), "series", "seq", "v", F.col("v").isNotNull())
    return found.select("seq", "series", fixed(F.col("filled")).alias("filled_e4"), "source")


_ORD = f"{EV}, o as (select *, row_number() over (partition by series order by seq) as i from e)"


def _ordinal(spark, sf_dir):
    return sequence.numbered(events(spark, sf_dir), "series", "seq")


@query(
    "bracket_interpolate",
    f"""with {_ORD}, b as (select *, v is not null as d, coalesce(lag(v is not null) over w and lead(v is not null) over w, false) as both_direct, (lag(v) over w + lead(v) over w) / 2 as mean from o window w as (partition by series order by i))
    select seq, series, {fx("case when d then v when both_direct then mean end")} as y_e4, case when d then 'direct' when both_direct then 'interpolated' else 'untrusted' end as source from b""",
)
def bracket_interpolate(spark, sf_dir):
    found = sequence.bracket(_ordinal(spark, sf_dir), "series", "i", "v", F.col("v").isNotNull())
    return found.select("seq", "series", fixed(F.col("bracketed")).alias("y_e4"), "source")


@query(
    "islands",
    f"""with {_ORD}, r as (select *, i - row_number() over (partition by series order by i) as g from o where rejected)
    select series, min(i) as first_i, max(i) as last_i, count(*) as length from r group by series, g""",
)
def islands(spark, sf_dir):
    return sequence.islands(_ordinal(spark, sf_dir), "series", "i", F.col("rejected")).withColumnsRenamed({"first_seq": "first_i", "last_seq": "last_i"})


@query(
    "chunk_batches",
    f"""with {_ORD}, k as (select * from o where not rejected), g as (select *, i - row_number() over (partition by series order by i) as g from k),
    c as (select *, (row_number() over (partition by series, g order by i) - 1) // 3 as c from g) select series, min(i) as first_i, max(i) as last_i, count(*) as rows from c group by series, g, c""",
)
def chunk_batches(spark, sf_dir):
    return sequence.chunks(_ordinal(spark, sf_dir).filter(~F.col("rejected")), "series", "i", 3).withColumnsRenamed({"first_seq": "first_i", "last_seq": "last_i"})


#: Rows of a chunk in the queries that take all events as one series.
LONG_CHUNK = 150


def _one_series(spark, sf_dir):
    """The events that a long series needs, with their chunks, and the cuts."""
    e = events(spark, sf_dir).select("seq", "value", "v", "rejected", F.lit(0).alias("all"))
    cuts = sequence.measure(e, "all", "seq", LONG_CHUNK)
    return cuts.apply(e)[0], cuts


@query("long_series_windows", f"""with {EV}, a as (select *, quantile_cont(value, 0.5) over (order by seq rows between 4 preceding and 4 following) as m, quantile_cont(value, 0.5) over (order by seq rows between 25 preceding and 1 preceding) as t, max(value) over (order by seq) as top,
    case when not rejected then sum(case when rejected then 0 else 1 end) over (order by seq)::bigint end as output_no, lag(seq) over (order by seq) as p, lag(value) over (order by seq) as pv from e)
    select seq, {fx('m', 3)} as m_e3, {fx('t', 3)} as t_e3, {fx('top', 2)} as top_e2, output_no, {fx('case when p = seq - 1 then value - pv end', 3)} as delta_e3 from a""")
def long_series_windows(spark, sf_dir):
    """All events as one series, cut into chunks: bounded windows by halos, running ones by scanned summaries."""
    e, cuts = _one_series(spark, sf_dir)
    e = sequence.cumulative_max(e, "all", "seq", "value", "top", cuts=cuts)
    e = sequence.output_numbers(e, "all", "seq", ~F.col("rejected"), cuts=cuts)
    e = sequence.rolling_median(e, "all", "seq", "value", "m", cuts=cuts)
    e = sequence.trailing_median(e, "all", "seq", "value", "t", cuts=cuts)
    e = sequence.adjacent_delta(e, "all", "seq", "value", cuts=cuts)
    return e.select("seq", *[fixed(F.col(c), d).alias(f"{c}_e{d}") for c, d in (("m", 3), ("t", 3), ("top", 2), ("delta", 3))], "output_no")


@query("long_series_fill", f"""with {EV}, e0 as (select seq, 0 as series, v from e), md as (select median(v) as md from e), g as (select *, coalesce(v, md) as f from e0, md), h as (select *, list_sort([coalesce(lag(f, 2) over w, first_value(f) over w), coalesce(lag(f) over w, first_value(f) over w), f,
    coalesce(lead(f) over w, last_value(f) over a), coalesce(lead(f, 2) over w, last_value(f) over a)])[3] as local from g window w as (order by seq), a as (order by seq rows between unbounded preceding and unbounded following)), acc as (select *, v is not null and abs(v - local) < 45 as accepted from h),
    {_LERP.format(knot='accepted', value='v', src='acc')} select seq, {fx('local', 3)} as local_e3, accepted, {fx('filled')} as filled_e4, source from filled""")
def long_series_fill(spark, sf_dir):
    """The gate and the interpolation over one cut series; gaps may go over any number of chunks."""
    e, cuts = _one_series(spark, sf_dir)
    gated = sequence.local_median_gate(e, "all", "seq", "v", 45.0, cuts=cuts)
    found = sequence.interpolate(gated, "all", "seq", "v", F.col("accepted"), cuts=cuts)
    return found.select("seq", fixed(F.col("local"), 3).alias("local_e3"), "accepted", fixed(F.col("filled")).alias("filled_e4"), "source")


@query("long_series_runs", f"""with {EV}, o as (select *, row_number() over (order by seq) as i from e), r as (select *, i - row_number() over (order by i) as g from o where value > 20), k as (select *, seq - row_number() over (order by seq) as g from e where value > 20),
    c as (select *, (row_number() over (partition by g order by seq) - 1) // 3 as c from k), n as (select seq, max(seq) filter (value <= 20) over (order by seq rows between unbounded preceding and 1 preceding) as p, min(seq) filter (value <= 20) over (order by seq rows between 1 following and unbounded following) as q, value from e)
    select 'island' as kind, min(seq) as first_seq, max(seq) as last_seq, count(*) as n from r group by g union all select 'batch', min(seq), max(seq), count(*) from c group by g, c union all select 'neighbours', p, q, seq from n where not value <= 20""")
def long_series_runs(spark, sf_dir):
    """Islands, batches and nearest neighbours over one cut series."""
    e, cuts = _one_series(spark, sf_dir)
    high = F.col("value") > 20
    runs = sequence.islands(e, "all", "seq", high, cuts).select(F.lit("island").alias("kind"), "first_seq", "last_seq", F.col("length").alias("n"))
    rest = e.filter(high).drop("__c")  # a series of its own, cut elsewhere
    batches = sequence.chunks(rest, "all", "seq", 3, sequence.measure(rest, "all", "seq", LONG_CHUNK)).select(F.lit("batch").alias("kind"), "first_seq", "last_seq", F.col("rows").alias("n"))
    near = sequence.neighbours_of_islands(e, "all", "seq", F.col("value") <= 20, cuts).select(F.lit("neighbours").alias("kind"), F.col("prev_seq").alias("first_seq"), F.col("next_seq").alias("last_seq"), F.col("seq").alias("n"))
    return runs.unionByName(batches).unionByName(near)


@query("output_numbering", f"with {EV} select seq, series, case when not rejected then sum(case when rejected then 0 else 1 end) over (partition by series order by seq)::bigint end as output_no from e")
def output_numbering(spark, sf_dir):
    return sequence.output_numbers(events(spark, sf_dir), "series", "seq", ~F.col("rejected")).select("seq", "series", "output_no")


@query("trailing_unresolved", f"with {EV} select seq, series from (select *, max(case when rejected then 0 else 1 end) over (partition by series order by seq rows between current row and unbounded following) as m from e) where m = 0")
def trailing_unresolved(spark, sf_dir):
    return sequence.trailing_unresolved(events(spark, sf_dir), "series", "seq", ~F.col("rejected")).select("seq", "series")


@query("adjacent_delta", f"with {_ORD}, k as (select * from o where not rejected) select seq, series, {fx('case when lag(i) over w = i - 1 then v - lag(v) over w end')} as delta_e4 from k window w as (partition by series order by i)")
def adjacent_delta(spark, sf_dir):
    kept = _ordinal(spark, sf_dir).filter(~F.col("rejected"))
    return sequence.adjacent_delta(kept, "series", "i", "v").select("seq", "series", fixed(F.col("delta")).alias("delta_e4"))


@query("discontinuity", f"with {_ORD}, k as (select * from o where not rejected), d as (select seq, series, case when lag(i) over w = i - 1 then v - lag(v) over w end as d from k window w as (partition by series order by i)) select seq, series, {fx('d')} as delta_e4 from d where abs(d) > 100")
def discontinuity(spark, sf_dir):
    kept = _ordinal(spark, sf_dir).filter(~F.col("rejected"))
    return sequence.adjacent_delta(kept, "series", "i", "v").filter(F.abs("delta") > 100).select("seq", "series", fixed(F.col("delta")).alias("delta_e4"))


@query("adjacent_pairs", f"with {EV} select series, seq as a, lead(seq) over w as b from e window w as (partition by series order by seq) qualify lead(value) over w - value between 5 and 20")
def adjacent_pairs(spark, sf_dir):
    w = sequence.by("series", "seq")
    held = events(spark, sf_dir).select("series", F.col("seq").alias("a"), F.lead("seq").over(w).alias("b"), (F.lead("value").over(w) - F.col("value")).alias("d"))
    return held.filter("d between 5 and 20").select("series", "a", "b")


@query("convolve5", f"with {EV} select seq, series, {fx('(coalesce(lag(value,2) over w,0)*1 + coalesce(lag(value,1) over w,0)*2 + value*3 + coalesce(lead(value,1) over w,0)*2 + coalesce(lead(value,2) over w,0)*1)/9')} as c_e4 from e window w as (partition by series order by seq)")
def convolve5(spark, sf_dir):
    return sequence.convolve(events(spark, sf_dir), "series", "seq", "value", [1, 2, 3, 2, 1], "c").select("seq", "series", fixed(F.col("c")).alias("c_e4"))


@query("gradient", f"""with {EV} select seq, series, {fx("case when lag(value) over w is null and lead(value) over w is null then 0 when lag(value) over w is null then lead(value) over w - value when lead(value) over w is null then value - lag(value) over w else (lead(value) over w - lag(value) over w) / 2 end")} as g_e4 from e window w as (partition by series order by seq)""")
def gradient(spark, sf_dir):
    return sequence.gradient(events(spark, sf_dir), "series", "seq", "value", "g").select("seq", "series", fixed(F.col("g")).alias("g_e4"))


@query("local_extrema", f"""with {EV}, n as (select *, lag(value) over w as b, lead(value) over w as a from e window w as (partition by series order by seq))
    select seq, series, case when value >= b and value >= a and value <= b and value <= a then 'flat' when value >= b and value >= a then 'peak' else 'valley' end as kind from n
    where b is not null and a is not null and ((value >= b and value >= a) or (value <= b and value <= a))""")
def local_extrema(spark, sf_dir):
    return sequence.local_extrema(events(spark, sf_dir), "series", "seq", "value").select("seq", "series", "kind")


_BOX = " + ".join([f"coalesce(lag(value, {k}) over w, first_value(value) over x)" for k in range(5, 0, -1)] + ["value"] + [f"coalesce(lead(value, {k}) over w, last_value(value) over x)" for k in range(1, 6)])
_SMOOTH = f"sm as (select *, ({_BOX}) / 11 as smooth from e window w as (partition by series order by seq), x as (partition by series order by seq rows between unbounded preceding and unbounded following))"


@query("box_smooth_peaks", f"""with {EV}, {_SMOOTH}, sl as (select *, smooth - lag(smooth, 10) over (partition by series order by seq) as slope from sm),
    nb as (select *, lag(slope) over w as b, lead(slope) over w as a from sl window w as (partition by series order by seq)) select seq, series, {fx('slope', 3)} as slope_e3 from nb where slope >= 25 and slope >= b and slope > a""")
def box_smooth_peaks(spark, sf_dir):
    return sequence.slope_peaks(events(spark, sf_dir), "series", "seq", "value").select("seq", "series", fixed(F.col("slope"), 3).alias("slope_e3"))


@query("edge_contrast", f"""with {EV}, m as (select *, quantile_cont(value, 0.5) over (partition by series order by seq rows between 24 preceding and 7 preceding) as b,
    quantile_cont(value, 0.5) over (partition by series order by seq rows between 6 following and 23 following) as a from e) select seq, series, {fx('a - b', 3)} as contrast_e3 from m""")
def edge_contrast(spark, sf_dir):
    return sequence.edge_contrast(events(spark, sf_dir), "series", "seq", "value").select("seq", "series", fixed(F.col("contrast"), 3).alias("contrast_e3"))


@query("quadratic_peak", f"""with {EV}, n as (select *, lag(value) over w as b, lead(value) over w as a from e window w as (partition by series order by seq))
    select seq, series, {fx("greatest(-0.5, least(0.5, coalesce(0.5 * (b - a) / nullif(b - 2 * value + a, 0), 0)))")} as offset_e4 from n where value > b and value > a""")
def quadratic_peak(spark, sf_dir):
    return sequence.quadratic_peak(events(spark, sf_dir), "series", "seq", "value").select("seq", "series", fixed(F.col("offset")).alias("offset_e4"))


_C5 = "(coalesce(lag(t,2) over w,0)*1 + coalesce(lag(t,1) over w,0)*2 + t*3 + coalesce(lead(t,1) over w,0)*2 + coalesce(lead(t,2) over w,0)*1)/9"


@query("edge_pipeline", f"""with {EV}, th as (select *, greatest(20, 0.88 * quantile_cont(value, 0.9) over (partition by series)) as lim from e), t as (select *, case when value > lim then 1.0 else 0.0 end as t from th),
    c as (select *, {_C5} as c from t window w as (partition by series order by seq)), g as (select *, (lead(c) over w - lag(c) over w) / 2 as g from c window w as (partition by series order by seq)),
    r as (select *, row_number() over (partition by series order by g desc, seq) as rn from g where g is not null) select series, seq as edge_seq, {fx('g')} as strength_e4 from r where rn = 1""")
def edge_pipeline(spark, sf_dir):
    """Threshold by an adaptive level, smooth, differentiate, and take the steepest rise of each series."""
    e = stats.with_quantile(events(spark, sf_dir), "series", "value", 0.9, "p90")
    cuts = sequence.measure(e, "series", "seq")
    t = e.withColumn("t", F.when(F.col("value") > F.greatest(F.lit(20.0), 0.88 * F.col("p90")), 1.0).otherwise(0.0))
    c = sequence.convolve(t, "series", "seq", "t", [1, 2, 3, 2, 1], "c", cuts)

    def rise(rows, keys):
        w = sequence.by(keys, "seq")
        return rows.withColumn("g", (F.lead("c").over(w) - F.lag("c").over(w)) / 2)

    g = sequence.halo(c, "series", "seq", 1, 1, rise, cuts).filter("g is not null")
    best = g.groupBy("series").agg(F.min(F.struct((-F.col("g")).alias("x"), "seq")).alias("b"))
    return best.select("series", F.col("b.seq").alias("edge_seq"), fixed(-F.col("b.x")).alias("strength_e4"))


@query("windowed_argmax", f"with {_ORD}, r as (select *, row_number() over (partition by series order by value desc, seq) as rn from o where i between 10 and 40) select series, seq as best_seq, {fx('value', 2)} as best_e2 from r where rn = 1")
def windowed_argmax(spark, sf_dir):
    inside = _ordinal(spark, sf_dir).filter("i between 10 and 40")
    return inside.groupBy("series").agg(F.max_by(F.struct("seq", "value"), F.struct("value", -F.col("seq"))).alias("b")).select("series", F.col("b.seq").alias("best_seq"), fixed(F.col("b.value"), 2).alias("best_e2"))


@query("asof_neighbors", f"""with {EV} select seq, series, prev_seq, next_seq from (select *, max(case when not rejected then seq end) over (partition by series order by seq rows between unbounded preceding and 1 preceding) as prev_seq,
    min(case when not rejected then seq end) over (partition by series order by seq rows between 1 following and unbounded following) as next_seq from e) where rejected""")
def asof_neighbors(spark, sf_dir):
    return sequence.neighbours_of_islands(events(spark, sf_dir), "series", "seq", ~F.col("rejected")).select("seq", "series", "prev_seq", "next_seq")


@query("asof_checkpoint", f"""with {EV}, l as (select seq, series from e where event_type = 'purchase'), r as (select seq, series, value from e where event_type = 'signup')
    select l.series, l.seq, r.seq as asof_seq, {fx('r.value', 2)} as asof_e2 from l asof left join r on l.series = r.series and l.seq > r.seq""")
def asof_checkpoint(spark, sf_dir):
    """The last signup strictly before each purchase of the series."""
    e = events(spark, sf_dir)
    left, right = e.filter("event_type = 'purchase'").select("series", "seq"), e.filter("event_type = 'signup'").select("series", "seq", "value")
    return intervals.asof(left, right, "series", "seq", "value").select("series", "seq", "asof_seq", fixed(F.col("asof_value"), 2).alias("asof_e2"))


@query("positional_zip", f"with {_ORD}, a as (select series, row_number() over (partition by series order by seq) as i, seq from e where event_type = 'view'), b as (select series, row_number() over (partition by series order by seq) as i, seq from e where event_type = 'click') select a.series, a.i, a.seq as view_seq, b.seq as click_seq from a join b on a.series = b.series and a.i = b.i")
def positional_zip(spark, sf_dir):
    """The k-th view of a series with its k-th click."""
    e = events(spark, sf_dir)
    part = lambda kind, name: e.filter(F.col("event_type") == kind).select("series", F.row_number().over(W.partitionBy("series").orderBy("seq")).cast("long").alias("i"), F.col("seq").alias(name))
    return part("view", "view_seq").join(part("click", "click_seq"), ["series", "i"])


_IV = f"{EV}, iv as (select series, epoch_us(ts) // 1000000 as s, epoch_us(ts) // 1000000 + cast(floor(value * 600) as bigint) as t, event_type from e)"


def _spans(spark, sf_dir):
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    return events(spark, sf_dir).select("series", start.alias("s"), (start + F.floor(F.col("value") * 600)).alias("t"), "event_type")


_MERGE = """n as (select *, case when s > max(t) over (partition by series order by s, t rows between unbounded preceding and 1 preceding) or row_number() over (partition by series order by s, t) = 1 then 1 else 0 end as nw from {0}),
g as (select *, sum(nw) over (partition by series order by s, t rows between unbounded preceding and current row) as g from n), merged as (select series, min(s) as s, max(t) as t from g group by series, g)"""


@query("merge_intervals", f"with {_IV}, {_MERGE.format('iv')} select series, s, t from merged")
def merge_intervals(spark, sf_dir):
    return intervals.merge(_spans(spark, sf_dir), "series", "s", "t").select("series", "s", "t")


@query("interval_union", f"with {_IV}, {_MERGE.format('iv')} select series, sum(t - s)::bigint as covered, count(*) as parts from merged group by series")
def interval_union(spark, sf_dir):
    return intervals.merge(_spans(spark, sf_dir), "series", "s", "t").groupBy("series").agg(F.sum(F.col("t") - F.col("s")).alias("covered"), F.count(F.lit(1)).alias("parts"))


@query("interval_overlap", f"with {_IV}, a as (select * from iv where event_type = 'view'), b as (select * from iv where event_type = 'click') select a.series, sum(least(a.t, b.t) - greatest(a.s, b.s))::bigint as overlap from a join b on a.series = b.series and a.s < b.t and b.s < a.t group by a.series")
def interval_overlap(spark, sf_dir):
    s = _spans(spark, sf_dir)
    return intervals.overlap(s.filter("event_type = 'view'"), s.filter("event_type = 'click'"), "series", "s", "t", 86400.0)


@query("incremental_anti_range", f"with {EV} select seq, series from e where not (seq between 0 and 199 or seq between 300 and 349 or seq between 700 and 5000)")
def incremental_anti_range(spark, sf_dir):
    return intervals.outside_ranges(events(spark, sf_dir), "seq", [(0, 199), (300, 349), (700, 5000)]).select("seq", "series")


@query("normalize_sequence", f"""with {EV}, t as (select *, median(value) over (partition by series) as target from e), g as (select *, greatest(power(2.0, -0.65), least(power(2.0, 0.65), target / value)) as gain from t),
    m as (select *, quantile_cont(gain, 0.5) over (partition by series order by seq rows between 4 preceding and 4 following) as sg from g) select seq, series, {fx('value * sg / (1 + 0.12 * (value * sg))')} as n_e4 from m""")
def normalize_sequence(spark, sf_dir):
    e = stats.with_quantile(events(spark, sf_dir), "series", "value", 0.5, "target")
    return sequence.normalize(e, "series", "seq", "value", F.col("target")).select("seq", "series", fixed(F.col("normal")).alias("n_e4"))


@query("cumulative_max", f"with {EV} select seq, series, {fx('max(value) over (partition by series order by seq)', 2)} as m_e2 from e")
def cumulative_max(spark, sf_dir):
    return sequence.cumulative_max(events(spark, sf_dir), "series", "seq", "value", "m").select("seq", "series", fixed(F.col("m"), 2).alias("m_e2"))


@query("golden_diff", f"""with {EV}, n as (select seq, case when seq % 17 = 0 then value + 0.5 when seq % 23 = 0 then null else value end as value from e where seq % 29 <> 0)
    select coalesce(e.seq, n.seq) as seq, case when n.seq is null then 'missing' when e.seq is null then 'added' when e.value is not distinct from n.value then 'same' else 'changed' end as verdict from e full join n on e.seq = n.seq""")
def golden_diff(spark, sf_dir):
    e = events(spark, sf_dir).select("seq", "value")
    other = e.filter("seq % 29 <> 0").withColumn("value", F.when(F.col("seq") % 17 == 0, F.col("value") + 0.5).when(F.col("seq") % 23 == 0, None).otherwise(F.col("value")))
    return ledger.diff(e, other, "seq", "value").select("seq", "verdict")


@query("cascade_coalesce", f"""with {EV}, t as (select *, quantile_cont(v, 0.5) over (partition by series order by seq rows between 25 preceding and 1 preceding) as tm, coalesce(lag(v is not null) over w and lead(v is not null) over w, false) as both_direct, (lag(v) over w + lead(v) over w) / 2 as mean from e window w as (partition by series order by seq))
    select seq, series, {fx("coalesce(v, case when both_direct then mean end, tm)", 3)} as y_e3, case when v is not null then 'direct' when both_direct then 'bracket' when tm is not null then 'trailing' else 'excluded' end as source from t""")
def cascade_coalesce(spark, sf_dir):
    w = sequence.by("series", "seq")
    e = sequence.trailing_median(events(spark, sf_dir), "series", "seq", "v", "tm")
    mean = (F.lag("v").over(w) + F.lead("v").over(w)) / 2
    value, source = cascade.cascade([("direct", F.col("v")), ("bracket", F.col("mean")), ("trailing", F.col("tm"))])
    return e.withColumn("mean", mean).select("seq", "series", fixed(value, 3).alias("y_e3"), source.alias("source"))


_STAGES = f"""with {EV}, {_FIVE}, t as (select *, quantile_cont(value, 0.5) over (partition by series order by seq rows between 25 preceding and 1 preceding) as tm,
    lag(case when accepted then v end) over w as before, lead(case when accepted then v end) over w as after from acc window w as (partition by series order by seq)),
    k as (select seq, series, case when accepted then v end as v1, case when before is not null and after is not null then (after + before) / 2 end as v2, case when abs(value - tm) <= 30 then tm end as v3, v is null as missing from t)"""


def _stages() -> list[cascade.Stage]:
    reason = lambda c, why: F.when(c.isNull(), F.array(F.lit(why)))
    direct = F.when(F.col("accepted"), F.col("v"))
    between = F.when(F.col("before").isNotNull() & F.col("after").isNotNull(), (F.col("after") + F.col("before")) / 2)
    trailing = F.when(F.abs(F.col("value") - F.col("tm")) <= 30, F.col("tm"))
    step = lambda c, why: lambda d: d.select("seq", c.alias("value"), reason(c, why).alias("reasons"))
    return [
        cascade.Stage("direct", lambda d: d.select("seq", direct.alias("value"), F.when(direct.isNull(), F.array(F.when(F.col("v").isNull(), "no measurement").otherwise("outlier"))).alias("reasons"))),
        cascade.Stage("bracket", step(between, "a neighbour is not direct")),
        cascade.Stage("trailing", step(trailing, "far from the model"), F.col("tm").isNotNull()),
    ]


def _observed(spark, sf_dir):
    w = sequence.by("series", "seq")
    gated = sequence.local_median_gate(events(spark, sf_dir), "series", "seq", "v", 45.0)
    direct = F.when(F.col("accepted"), F.col("v"))
    return sequence.trailing_median(gated, "series", "seq", "value", "tm").withColumn("before", F.lag(direct).over(w)).withColumn("after", F.lead(direct).over(w))


@query("cascade_attempts", f"""{_STAGES} select seq, {fx('coalesce(v1, v2, v3)', 3)} as y_e3, case when v1 is not null then 'direct' when v2 is not null then 'bracket' when v3 is not null then 'trailing' else 'excluded' end as source,
    array_to_string(list_filter([case when v1 is null then case when missing then 'direct: no measurement' else 'direct: outlier' end end, case when v1 is null and v2 is null then 'bracket: a neighbour is not direct' end,
      case when v1 is null and v2 is null and v3 is null and seq in (select seq from t where tm is not null) then 'trailing: far from the model' end], lambda x: x is not null), '; ') as failed from k""")
def cascade_attempts(spark, sf_dir):
    """Lazy stages with provenance: what resolved each key, and why the stages before it did not."""
    found, _ = cascade.resolve(_observed(spark, sf_dir), ["seq"], _stages())
    failed = F.array_join(F.transform(F.filter("attempts", lambda a: F.size(a["reasons"]) > 0), lambda a: F.concat_ws(": ", a["stage"], F.array_join(a["reasons"], ","))), "; ")
    return found.select("seq", fixed(F.col("value"), 3).alias("y_e3"), "source", failed.alias("failed"))


@query("cascade_counts", f"""{_STAGES}, n as (select 'direct' as stage, count(*) as attempts, count(v1) as successes from k union all select 'bracket', count(*), count(v2) from k where v1 is null
    union all select 'trailing', count(*), count(v3) from k where v1 is null and v2 is null and seq in (select seq from t where tm is not null)) select *, attempts - successes as failures from n""")
def cascade_counts(spark, sf_dir):
    return cascade.resolve(_observed(spark, sf_dir), ["seq"], _stages())[1]


@query("registration_audit", f"""with {EV}, {_FIVE}, b as (select *, lag(accepted) over w and lead(accepted) over w as bracketed, (lag(v) over w + lead(v) over w) / 2 as mean from acc window w as (partition by series order by seq)),
    r as (select series, seq, case when accepted then v when coalesce(bracketed, false) then mean end as y, case when accepted then 'measured' when coalesce(bracketed, false) then 'bracketed' else 'excluded' end as source from b),
    d as (select *, abs(y - lag(y) over (partition by series order by seq)) as jump from r) select series, count(*) as n, count(*) filter (source = 'measured') as measured, count(*) filter (source = 'bracketed') as bracketed,
    count(*) filter (source = 'excluded') as excluded, {fx('100.0 * count(y) / count(*)', 3)} as included_pct_e3, count(*) filter (jump > 100) as jumps, {fx('max(jump)', 2)} as largest_e2, max(seq) filter (source = 'excluded') as last_excluded from d group by series""")
def registration_audit(spark, sf_dir):
    from strandline.plans import runner

    dense = events(spark, sf_dir).withColumn("i", F.row_number().over(W.partitionBy("series").orderBy("seq")).cast("long")).select("series", F.col("i").alias("seq"), "v", F.col("seq").alias("own"))
    resolved = runner.resolve(dense, runner.RunConfig()).join(dense.select("series", "seq", "own"), ["series", "seq"])
    a = runner.audit(resolved, "own")
    return a.select("series", "n", "measured", "bracketed", "excluded", fixed(F.col("included_pct"), 3).alias("included_pct_e3"), "jumps", fixed(F.col("largest"), 2).alias("largest_e2"), "last_excluded")


@query("duration_seconds", f"with {EV} select seq, series, {fx('(epoch_us(ts) - epoch_us(lag(ts) over (partition by series order by seq))) / 1000000.0', 3)} as d_e3 from e")
def duration_seconds(spark, sf_dir):
    w = sequence.by("series", "seq")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return events(spark, sf_dir).select("seq", "series", fixed((micros - F.lag(micros).over(w)) / 1_000_000.0, 3).alias("d_e3"))


@query("every_kth", f"with {EV}, r as (select *, row_number() over (partition by series order by seq) as rn, count(*) over (partition by series) as n from e) select seq, series from r where rn = 1 or rn % 25 = 0 or rn = n")
def every_kth(spark, sf_dir):
    w, a = sequence.by("series", "seq"), sequence.everything("series")
    held = events(spark, sf_dir).select("seq", "series", F.row_number().over(w).alias("rn"), F.count(F.lit(1)).over(a).alias("n"))
    return held.filter("rn = 1 or rn % 25 = 0 or rn = n").select("seq", "series")


@query("boundary_sample", f"""with {EV}, r as (select *, row_number() over (partition by series order by seq) as rn, row_number() over (partition by series order by abs(value - 50), seq) as near from e),
    s as (select seq, series, 'every10' as reason from r where rn % 10 = 1 union all select seq, series, 'near50' from r where near <= 3) select seq, series, string_agg(reason, ';' order by reason) as reasons from s group by seq, series""")
def boundary_sample(spark, sf_dir):
    w = W.partitionBy("series")
    r = events(spark, sf_dir).select("seq", "series", F.row_number().over(w.orderBy("seq")).alias("rn"), F.row_number().over(w.orderBy(F.abs(F.col("value") - 50), "seq")).alias("near"))
    reasons = F.array_compact(F.array(F.when(F.col("rn") % 10 == 1, "every10"), F.when(F.col("near") <= 3, "near50")))
    return r.select("seq", "series", F.array_join(reasons, ";").alias("reasons")).filter("reasons <> ''")


@query("even_sample", f"""with {_ORD}, n as (select series, count(*) as n from o group by series), w as (select series, unnest([0, 1, 2, 3, 4]) as k, n from n), p as (select distinct series, 1 + cast(round_even(k * (n - 1) / 4.0, 0) as bigint) as i from w union select series, 2 from n where n >= 2)
    select o.seq, o.series from o join p on o.series = p.series and o.i = p.i""")
def even_sample(spark, sf_dir):
    """Five evenly spaced rows of each series, and always the second."""
    o = _ordinal(spark, sf_dir).withColumn("n", F.count(F.lit(1)).over(sequence.everything("series")))
    spots = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: 1 + F.bround(k * (F.col("n") - 1) / 4.0).cast("long"))
    return o.filter(F.array_contains(spots, F.col("i").cast("long")) | (F.col("i") == 2)).select("seq", "series")


@query("theta_pairs", f"with {EV}, a as (select * from e where event_type = 'view'), b as (select * from e where event_type = 'click') select a.series, a.seq as a_seq, b.seq as b_seq from a join b on a.series = b.series and b.value - a.value between 2 and 6")
def theta_pairs(spark, sf_dir):
    e = events(spark, sf_dir)
    left, right = e.filter("event_type = 'view'").select("series", F.col("seq").alias("a_seq"), F.col("value").alias("a")), e.filter("event_type = 'click'").select("series", F.col("seq").alias("b_seq"), F.col("value").alias("b"))
    return candidates.band_pairs(left, right, "series", "a", "b", 2.0, 6.0).select("series", "a_seq", "b_seq")


@query("theta_self_join", f"with {EV}, p as (select a.series, a.seq as a_seq, b.seq as b_seq, abs(b.value - a.value - 10) as cost from e a join e b on a.series = b.series and b.value - a.value between 8 and 12) select series, a_seq, b_seq from (select *, row_number() over (partition by series order by cost, a_seq, b_seq) as rn from p) where rn = 1")
def theta_self_join(spark, sf_dir):
    e = events(spark, sf_dir)
    pairs = candidates.band_pairs(e.select("series", F.col("seq").alias("a_seq"), F.col("value").alias("a")), e.select("series", F.col("seq").alias("b_seq"), F.col("value").alias("b")), "series", "a", "b", 8.0, 12.0)
    best = pairs.groupBy("series").agg(F.min(F.struct(F.abs(F.col("b") - F.col("a") - 10).alias("cost"), "a_seq", "b_seq")).alias("m"))
    return best.select("series", "m.a_seq", "m.b_seq")


@query("topk_then_range_join", f"with {EV}, a as (select * from (select *, row_number() over (partition by series order by value desc, seq) as rn from e where event_type = 'view') where rn <= 5), b as (select * from (select *, row_number() over (partition by series order by value desc, seq) as rn from e where event_type = 'click') where rn <= 5) select a.series, a.seq as a_seq, b.seq as b_seq from a join b on a.series = b.series and abs(a.value - b.value) <= 10")
def topk_then_range_join(spark, sf_dir):
    e = events(spark, sf_dir)
    part = lambda kind, p: candidates.top_k(e.filter(F.col("event_type") == kind).select("series", "seq", "value"), ["series"], [F.desc("value"), F.asc("seq")], 5).select("series", F.col("seq").alias(f"{p}_seq"), F.col("value").alias(p))
    return part("view", "a").join(part("click", "b"), "series").filter("abs(a - b) <= 10").select("series", "a_seq", "b_seq")


@query("semi_agreement", f"with {EV} select seq, series from e a where event_type = 'view' and exists (select 1 from e b where b.series = a.series and b.event_type = 'click' and b.value - a.value between -1 and 1)")
def semi_agreement(spark, sf_dir):
    e = events(spark, sf_dir)
    left, right = e.filter("event_type = 'view'").select("seq", "series", F.col("value").alias("a")), e.filter("event_type = 'click'").select("series", F.col("value").alias("b"))
    return candidates.band_pairs(left, right, "series", "a", "b", -1.0, 1.0).select("seq", "series").distinct()


@query("competitor_margin", f"""with {EV}, b as (select * from (select *, row_number() over (partition by series order by value desc, seq) as rn from e) where rn = 1), r as (select e.series, max(e.value) as rival from e join b on e.series = b.series and abs(e.seq - b.seq) >= 500 group by e.series)
    select b.series, b.seq as best_id, {fx('b.value', 2)} as best_e2, {fx('b.value - r.rival', 2)} as margin_e2 from b left join r on b.series = r.series""")
def competitor_margin(spark, sf_dir):
    e = events(spark, sf_dir).select("series", "seq", F.col("seq").cast("double").alias("place"), "value")
    return candidates.margin(e, "series", "value", "seq", "place", 500.0).select("series", "best_id", fixed(F.col("best_score"), 2).alias("best_e2"), fixed(F.col("margin"), 2).alias("margin_e2"))


@query("greedy_nms", f"""with recursive {EV}, c as (select *, row_number() over (partition by series order by value desc, seq) as rn from e), s as (select series, 0::bigint as done, []::bigint[] as kept from c group by series
    union all select s.series, s.done + 1, case when len(s.kept) < 8 and len(list_filter(s.kept, lambda k: abs(k - c.seq) < 300)) = 0 then list_append(s.kept, c.seq) else s.kept end from s join c on c.series = s.series and c.rn = s.done + 1)
    select series, seq, row_number() over (partition by series order by pos)::int as rank from (select series, unnest(kept) as seq, generate_subscripts(kept, 1) as pos from s where (series, done) in (select series, max(done) from s group by series))""")
def greedy_nms(spark, sf_dir):
    e = events(spark, sf_dir).select("series", "seq", F.col("seq").cast("double").alias("place"), "value")
    return candidates.suppress(e, "series", "seq", "place", "value", 300.0, 8).select("series", "seq", "rank")


_JOINS = "len(s.held) > 0 and abs(c.value - (s.held[(len(s.held) + 1) // 2] + s.held[len(s.held) // 2 + 1]) / 2) <= 6"


@query("greedy_cluster_1d", f"""with recursive {EV}, c as (select series, seq, value, row_number() over (partition by series order by value, seq) as rn from e), s as (select series, 0::bigint as done, null::bigint as seq, -1 as cluster, []::double[] as held from c group by series
    union all select s.series, s.done + 1, c.seq, case when {_JOINS} then s.cluster else s.cluster + 1 end, case when {_JOINS} then list_append(s.held, c.value) else [c.value] end from s join c on c.series = s.series and c.rn = s.done + 1)
    select series, seq, cluster from s where done > 0""")
def greedy_cluster_1d(spark, sf_dir):
    return candidates.cluster(events(spark, sf_dir), "series", "seq", "value", 6.0).select("series", "seq", "cluster")


_TEMPLATE = [0.0, 1.0, 3.0, 1.0, 0.0, -2.0]


@query("template_scores", f"""with {_ORD}, t as (select unnest(range({len(_TEMPLATE)})) as k, unnest({_TEMPLATE}) as y), p as (select a.seq, a.series, b.value as x, t.y from o a join t on true left join o b on b.series = a.series and b.i = a.i + t.k)
    select seq, series, {fx("case when count(x) = 6 and max(x) > min(x) then corr(x, y) end", 5)} as score_e5 from p group by seq, series""")
def template_scores(spark, sf_dir):
    """Correlation of a template of six values with every window of every series."""
    scored = match.correlate(events(spark, sf_dir), "series", "seq", "value", _TEMPLATE)
    return scored.select("seq", "series", fixed(F.col("score"), 5).alias("score_e5"))


_FEATURES = (("near", 4.0, "click", 1.0), ("far", 11.0, "purchase", 2.0), ("below", -6.0, "signup", 1.0))


@query("feature_evidence", f"""with {EV}, f as (select * from (values {', '.join(f"({k}, '{n}', {o}, '{d}', {w})" for k, (n, o, d, w) in enumerate(_FEATURES))}) t(k, name, off, kind, weight)),
    c as (select series, seq, value from e where event_type = 'view'), m as (select c.series, c.seq, f.k, min((round(abs(o.value - (c.value + f.off)), 9), o.event_type <> f.kind)) as b from c join f on true join e o on o.series = c.series and o.event_type <> 'view' and abs(o.value - (c.value + f.off)) <= 1.5 group by all),
    s as (select c.series, c.seq, f.*, b is null as absent, coalesce(b[2], false) as wrong from c join f on true left join m on m.seq = c.seq and m.series = c.series and m.k = f.k),
    j as (select series, seq, count(*) filter (not wrong and not absent) as supported, count(*) filter (wrong) as contradicted, count(*) filter (absent) as missing, sum(case when not wrong and not absent then weight else 0 end) - sum(case when wrong then weight else 0 end) as score, min((k, name)) filter (wrong) as w, min((k, name)) filter (absent) as m from s group by series, seq)
    select series, seq, supported, contradicted, missing, {fx('score', 2)} as score_e2, case when score >= 1 then null when w is not null then 'contradicted: ' || w[2] when m is not null then 'missing: ' || m[2] else 'weak' end as reason from j""")
def feature_evidence(spark, sf_dir):
    """Views as candidates, judged by what lies at three offsets from them: supported, contradicted or missing."""
    e = events(spark, sf_dir).select("series", "seq", "value", "event_type")
    features = [match.Feature(*f) for f in _FEATURES]
    judged = match.evidence(e.filter("event_type = 'view'"), e.filter("event_type <> 'view'"), "series", "seq", "value", "event_type", features, 1.5, 1.0, 1.0)
    return judged.select("series", "seq", "supported", "contradicted", "missing", fixed(F.col("score"), 2).alias("score_e2"), "reason")


@query("scan_contiguity", f"with {EV} select min(seq) as first_seq, max(seq) as last_seq, count(*) as n, count(distinct seq) as n_distinct, count(*) = max(seq) - min(seq) + 1 and count(distinct seq) = count(*) as contiguous from e")
def scan_contiguity(spark, sf_dir):
    from strandline.sources.scan import contiguity

    return contiguity(events(spark, sf_dir).select("seq"), "seq")


@query("coverage_check", f"with {EV}, seg as (select * from (values (0, 399), (400, 599), (590, 700), (999000, 999001)) t(a, b)), c as (select seq, count(*) as n from (select unnest(range(a, b + 1)) as seq from seg) group by seq) select count(*) filter (e.seq is not null) as requested, count(*) filter (e.seq is not null and n = 1) as covered, count(*) filter (e.seq is not null and n is null) as missing, count(*) filter (n > 1) as repeated, count(*) filter (e.seq is null) as extra from e full join c on e.seq = c.seq")
def coverage_check(spark, sf_dir):
    seg = spark.createDataFrame([(0, 399), (400, 599), (590, 700), (999000, 999001)], "first long, last long")
    return ledger.coverage(seg, events(spark, sf_dir), "seq", "first", "last")


@query("dead_letter_split", f"with {EV} select case when rejected then 'dead' else 'kept' end as part, count(*) as n, {fx('sum(value)', 2)} as total_e2 from e group by 1")
def dead_letter_split(spark, sf_dir):
    e = events(spark, sf_dir)
    side = lambda d, name: d.select(F.lit(name).alias("part"), "value")
    return side(e.filter("rejected"), "dead").unionByName(side(e.filter("not rejected"), "kept")).groupBy("part").agg(F.count(F.lit(1)).alias("n"), fixed(F.sum("value"), 2).alias("total_e2"))


@query("union_ordered", f"with {EV} select seq, event_type from e where event_type in ('view', 'click') order by seq")
def union_ordered(spark, sf_dir):
    e = events(spark, sf_dir).select("seq", "event_type")
    return e.filter("event_type = 'view'").unionByName(e.filter("event_type = 'click'")).orderBy("seq")


@query("iso_timestamp", f"with {EV} select seq, strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' as iso from e")
def iso_timestamp(spark, sf_dir):
    return events(spark, sf_dir).select("seq", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))


@query("json_props_scan", f"with {EV} select seq, cast(json_extract(props, '$.k') as bigint) as k from e where json_extract(props, '$.k') is not null")
def json_props_scan(spark, sf_dir):
    return events(spark, sf_dir).select("seq", F.get_json_object("props", "$.k").cast("long").alias("k")).filter("k is not null")


@query("coalesce_recovery", f"with {EV} select seq, coalesce(case when seq % 3 = 0 then cast(json_extract(props, '$.missing') as bigint) end, case when seq % 2 = 0 then nullif(cast(json_extract(props, '$.k') as bigint), 0) end, series, -1) as x from e")
def coalesce_recovery(spark, sf_dir):
    e = events(spark, sf_dir)
    first = F.when(F.col("seq") % 3 == 0, F.get_json_object("props", "$.missing").cast("long"))
    second = F.when(F.col("seq") % 2 == 0, F.nullif(F.get_json_object("props", "$.k").cast("long"), F.lit(0)))
    return e.select("seq", F.coalesce(first, second, "series", F.lit(-1)).alias("x"))


@query("try_parse", f"with {EV} select seq, try_cast(case when seq % 5 = 0 then 'x' || seq else cast(seq as varchar) end as bigint) as value, case when seq % 5 = 0 then 'not a number: x' || seq end as error from e")
def try_parse(spark, sf_dir):
    raw = F.when(F.col("seq") % 5 == 0, F.concat(F.lit("x"), F.col("seq").cast("string"))).otherwise(F.col("seq").cast("string"))
    e = events(spark, sf_dir).withColumn("raw", raw).withColumn("value", F.col("raw").try_cast("long"))
    return e.select("seq", "value", F.when(F.col("value").isNull(), F.concat(F.lit("not a number: "), "raw")).alias("error"))


@query("filter_with_fallback", f"with {EV} select seq, series from (select *, sum(case when value between 40 and 60 then 1 else 0 end) over (partition by series) as n from e) where n < 10 or value between 40 and 60")
def filter_with_fallback(spark, sf_dir):
    from strandline.operators import gates

    return gates.with_fallback(events(spark, sf_dir), "series", F.col("value").between(40, 60), 10).select("seq", "series")


@query("conditional_summary", f"with {EV} select series, count(*) as n, count(*) filter (not rejected) as n_ok, {fx('100.0 * count(*) filter (not rejected) / count(*)', 3)} as ok_pct_e3, {fx('avg(v)', 3)} as mean_e3, max(seq) filter (rejected) as last_rejected from e group by series")
def conditional_summary(spark, sf_dir):
    ok, mean = F.count_if(~F.col("rejected")), F.try_divide(F.max_by("total", "seq"), F.count("v"))
    held = sequence.summed(events(spark, sf_dir).select("seq", "series", "rejected", "v"), "series", "seq", {"total": F.col("v")})
    return held.groupBy("series").agg(F.count(F.lit(1)).alias("n"), ok.alias("n_ok"), fixed(100.0 * ok / F.count(F.lit(1)), 3).alias("ok_pct_e3"), fixed(mean, 3).alias("mean_e3"), F.max(F.when(F.col("rejected"), F.col("seq"))).alias("last_rejected"))


@query("count_if", f"with {EV} select event_type, count(*) filter (value > 50) as n_high, count(*) filter (value <= 50) as n_low from e group by event_type")
def count_if(spark, sf_dir):
    return events(spark, sf_dir).groupBy("event_type").agg(F.count_if(F.col("value") > 50).alias("n_high"), F.count_if(F.col("value") <= 50).alias("n_low"))


KINDS = ["click", "error", "purchase", "refund", "signup", "view"]


@query("pivot_counts_zero_fill", f"with {EV} select series, " + ", ".join(f"count(*) filter (event_type = '{k}') as n_{k}" for k in KINDS) + " from e group by series")
def pivot_counts_zero_fill(spark, sf_dir):
    """Counts of a fixed list of kinds, one of which never occurs: always the same columns, zero filled."""
    return events(spark, sf_dir).groupBy("series").agg(*[F.count_if(F.col("event_type") == k).alias(f"n_{k}") for k in KINDS])


@query("guarded_mean", f"with {EV} select series, {fx('''coalesce(sum(case when event_type = 'purchase' and value > 150 then value end) / nullif(count(*) filter (event_type = 'purchase' and value > 150), 0), 0)''', 3)} as mean_e3 from e group by series")
def guarded_mean(spark, sf_dir):
    big = (F.col("event_type") == "purchase") & (F.col("value") > 150)
    held = events(spark, sf_dir).select("seq", "series", F.when(big, F.col("value")).alias("high"), big.alias("big"))
    held = sequence.summed(held, "series", "seq", {"total": F.col("high")})
    return held.groupBy("series").agg(fixed(F.coalesce(F.try_divide(F.max_by("total", "seq"), F.count_if("big")), F.lit(0.0)), 3).alias("mean_e3"))


@query("group_median", f"with {EV} select event_type, {fx('median(value)', 3)} as m_e3 from e group by event_type")
def group_median(spark, sf_dir):
    return stats.quantiles(events(spark, sf_dir), "event_type", "value", [0.5]).select("event_type", fixed(F.col("q")[0], 3).alias("m_e3"))


@query("percentile_exact", f"with {EV} select event_type, {fx('quantile_cont(value, 0.05)', 3)} as p05_e3, {fx('quantile_cont(value, 0.9)', 3)} as p90_e3, {fx('quantile_cont(value, 0.995)', 3)} as p995_e3 from e group by event_type")
def percentile_exact(spark, sf_dir):
    q = stats.quantiles(events(spark, sf_dir), "event_type", "value", [0.05, 0.9, 0.995])
    return q.select("event_type", *[fixed(F.col("q")[k], 3).alias(n) for k, n in enumerate(("p05_e3", "p90_e3", "p995_e3"))])


@query("selected_quantiles", f"""with {EV} select event_type, count(value) as n, {fx('quantile_cont(value, 0.01)', 3)} as p01_e3, {fx('quantile_cont(value, 0.5)', 3)} as p50_e3, {fx('quantile_cont(value, 0.999)', 3)} as p999_e3 from e group by event_type
    union all select 'all', count(value), {fx('quantile_cont(value, 0.01)', 3)}, {fx('quantile_cont(value, 0.5)', 3)}, {fx('quantile_cont(value, 0.999)', 3)} from e""")
def selected_quantiles(spark, sf_dir):
    """Quantiles by repeated narrowing, with a bound of 100 values a task and sketches of 20 marks, so that every group takes rounds."""
    e = events(spark, sf_dir).select("event_type", "value")
    both = e.unionByName(e.withColumn("event_type", F.lit("all")))
    q = stats.quantiles(both, "event_type", "value", [0.01, 0.5, 0.999], bound=100, marks=20)
    return q.select("event_type", "n", *[fixed(F.col("q")[k], 3).alias(n) for k, n in enumerate(("p01_e3", "p50_e3", "p999_e3"))])


@query("robust_stats", f"""with {EV}, c as (select event_type, median(value) as med from e group by event_type) select e.event_type, count(value) as n, {fx('min(value)', 2)} as low_e2, {fx('max(value)', 2)} as high_e2, {fx('avg(value)', 3)} as mean_e3, {fx('median(value)', 3)} as median_e3,
    {fx('median(abs(value - med))', 3)} as mad_e3, {fx('quantile_cont(value, 0.05)', 3)} as p05_e3, {fx('quantile_cont(value, 0.95)', 3)} as p95_e3 from e join c on e.event_type = c.event_type group by e.event_type""")
def robust_stats(spark, sf_dir):
    r = stats.robust(events(spark, sf_dir), "event_type", "value")
    return r.select("event_type", "n", fixed(F.col("low"), 2).alias("low_e2"), fixed(F.col("high"), 2).alias("high_e2"), *[fixed(F.col(c), 3).alias(f"{c}_e3") for c in ("mean", "median", "mad", "p05", "p95")])


@query("mad_outlier", f"""with {EV}, c as (select series, count(value) as n, median(value) as med from e group by series), m as (select e.series, any_value(n) as n, any_value(med) as med, median(abs(value - med)) as mad from e join c on e.series = c.series group by e.series),
    k as (select e.series, count(value) as inliers, median(value) as m, any_value(n) as n from e join m on e.series = m.series where abs(value - med) <= greatest(1, 3 * mad) group by e.series) select series, n, inliers, {fx('case when inliers >= 24 and inliers >= 0.2 * n then m end', 3)} as consensus_e3 from k""")
def mad_outlier(spark, sf_dir):
    found = stats.trimmed_median(events(spark, sf_dir), "series", "value", 1.0, 24, 0.2)
    return found.select("series", "n", "inliers", fixed(F.col("consensus"), 3).alias("consensus_e3"))


@query("error_metrics", f"""with {EV}, s as (select *, quantile_cont(value, 0.5) over (partition by series order by seq rows between 4 preceding and 4 following) as sm from e), m as (select series, avg(abs(value - sm)) as mae, avg((value - sm) * (value - sm)) as mse, max(abs(value - sm)) as worst from s group by series)
    select series, {fx('mae', 3)} as mae_e3, {fx('mse', 3)} as mse_e3, {fx('worst', 3)} as worst_e3, {fx('case when mse > 0 then 10 * log10(250000.0 / mse) end', 3)} as psnr_e3 from m""")
def error_metrics(spark, sf_dir):
    smooth = sequence.rolling_median(events(spark, sf_dir), "series", "seq", "value", "sm")
    return stats.errors(smooth, "series", "value", "sm", 500.0).select("series", *[fixed(F.col(c), 3).alias(f"{c}_e3") for c in ("mae", "mse", "worst", "psnr")])


@query("threshold_fractions", f"with {EV} select event_type, {fx('median(value)', 3)} as median_e3, {fx('avg(case when value > 90 then 1.0 else 0 end)')} as high_e4, {fx('avg(case when value < 10 then 1.0 else 0 end)')} as low_e4 from e group by event_type")
def threshold_fractions(spark, sf_dir):
    share = lambda c: fixed(F.avg(F.when(c, 1.0).otherwise(0.0)))
    e = events(spark, sf_dir)
    middle = stats.quantiles(e, "event_type", "value", [0.5]).select("event_type", fixed(F.col("q")[0], 3).alias("median_e3"))
    return e.groupBy("event_type").agg(share(F.col("value") > 90).alias("high_e4"), share(F.col("value") < 10).alias("low_e4")).join(middle, "event_type")


@query("adaptive_threshold", f"with {EV}, t as (select series, quantile_cont(value, 0.4) as p40, quantile_cont(value, 0.995) as p995 from e group by series) select series, {fx('least(250, greatest(80, p40 + 0.58 * (p995 - p40)))', 3)} as level_e3 from t")
def adaptive_threshold(spark, sf_dir):
    t = stats.quantiles(events(spark, sf_dir), "series", "value", [0.4, 0.995])
    level = F.least(F.lit(250.0), F.greatest(F.lit(80.0), F.col("q")[0] + 0.58 * (F.col("q")[1] - F.col("q")[0])))
    return t.select("series", fixed(level, 3).alias("level_e3"))


@query("relative_gate", f"""with {EV}, t as (select *, quantile_cont(value, 0.5) over (partition by series order by seq rows between 25 preceding and 1 preceding) as m from e)
    select seq, series, case when value < 1 or value > 400 then 'broad' when m is null then null when abs(value - m) > 75 then 'relative' end as reason from t""")
def relative_gate(spark, sf_dir):
    t = sequence.trailing_median(events(spark, sf_dir), "series", "seq", "value", "m")
    reason = F.when((F.col("value") < 1) | (F.col("value") > 400), "broad").when(F.col("m").isNull(), None).when(F.abs(F.col("value") - F.col("m")) > 75, "relative")
    return t.select("seq", "series", reason.alias("reason"))


@query("argmax_consensus", f"""with {EV}, d as (select *, epoch_us(ts) // 86400000000 as day from e), b as (select * from (select *, row_number() over (partition by series, day order by value desc, seq) as rn from d) where rn = 1 and value >= 20),
    c as (select series, count(*) as n, median(value) as med from b group by series) select series, n, {fx('med', 3)} as consensus_e3 from c where n >= 5""")
def argmax_consensus(spark, sf_dir):
    """The largest value of each day above a noise gate, and the median over days with support."""
    d = events(spark, sf_dir).withColumn("day", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000))
    best = d.groupBy("series", "day").agg(F.max("value").alias("value")).filter("value >= 20")
    return best.groupBy("series").agg(F.count(F.lit(1)).alias("n"), fixed(F.median("value"), 3).alias("consensus_e3")).filter("n >= 5")


_T1 = """with recursive {0}, c as (select series, value, seq, row_number() over (partition by series order by seq) as rn from e),
s as (select series, 0::bigint as done, null::bigint as seq, null::boolean as accepted, []::double[] as hist from c group by series
 union all select s.series, s.done + 1, c.seq, len(s.hist) < 5 or abs(c.value - list_sort(s.hist)[len(s.hist) // 2 + 1]) <= 40,
 case when len(s.hist) < 5 or abs(c.value - list_sort(s.hist)[len(s.hist) // 2 + 1]) <= 40 then list_append(s.hist, c.value)[-25:] else s.hist end from s join c on c.series = s.series and c.rn = s.done + 1)
select series, seq, accepted from s where done > 0"""


@query("rolling_model_stateful", _T1.format(EV))
def rolling_model_stateful(spark, sf_dir):
    from strandline.streaming.stateful import rolling_model

    return rolling_model(events(spark, sf_dir).select("series", "seq", "value"), "series", "seq", "value").select("series", "seq", "accepted")


@query("rolling_model_resumed", _T1.format(EV) + " and seq >= 6000")
def rolling_model_resumed(spark, sf_dir):
    """The second part of every series from its last stored state before it; equal to a run over the whole."""
    from strandline.streaming import stateful

    e = events(spark, sf_dir).select("series", "seq", "value")
    book = stateful.checkpoints(e.filter("seq < 6000"), "series", "seq", "value", every=10)
    return stateful.resumed(e, book, "series", "seq", "value", 6000).select("series", "seq", "accepted")


#: Rows of a part of a stream's state and files.
_PART = 500_000


def _arriving(df, slices: int = 4):
    """The rows as they would come in: slices by order of seq, each of as many files as the state has parts, with all of a
    series' rows of a slice in one file, so that the order of files within a slice does not matter. The stream takes a slice's
    number of files at a time: a micro-batch costs the same for each part of the state, however little it brings."""
    spark, folder = df.sparkSession, f"{scratch(df.sparkSession)}/arriving-{uuid.uuid4().hex}"
    ends = df.agg(F.min("seq").alias("a"), F.max("seq").alias("z"), F.count(F.lit(1)).alias("n")).first()
    step = ((ends["z"] or 0) - (ends["a"] or 0)) // slices + 1
    parts = max(spark.sparkContext.defaultParallelism, -(-ends["n"] // _PART))
    for k in range(slices):
        part = df.filter((F.col("seq") >= (ends["a"] or 0) + k * step) & (F.col("seq") < (ends["a"] or 0) + (k + 1) * step))
        part.repartition(parts, F.xxhash64("series")).write.parquet(f"{folder}/in/{k}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", parts).parquet(f"{folder}/in/*"), f"{folder}/out", f"{folder}/state", parts


@query("stream_bracket", SQL["bracket_interpolate"])
def stream_bracket(spark, sf_dir):
    """`bracket_interpolate` as a stream that holds unresolved rows back, and what it holds at the end."""
    from strandline.streaming import processors

    o = kept(_ordinal(spark, sf_dir).select("series", F.col("i").cast("long").alias("i"), "seq", "v"), "ordinal")
    stream, out, state, parts = _arriving(o)
    processors.run_available(processors.bracket_stream(stream, "series", "i", "v", F.col("v").isNotNull()), out, state, parts)
    given = spark.read.schema("series long, i long, bracketed double, source string").parquet(out)
    found = given.unionByName(processors.held_rows(spark, state, "series", "i").withColumn("series", F.col("series").cast("long")))
    return found.join(o.select("series", "i", "seq"), ["series", "i"]).select("seq", "series", fixed(F.col("bracketed")).alias("y_e4"), "source")


@query("stream_rolling_model", _T1.format(EV))
def stream_rolling_model(spark, sf_dir):
    """`rolling_model_stateful` as a stream with list and value state: the first half starts anew, the second half goes on from
    the state that is read back from the first stream's checkpoint."""
    from strandline.streaming import processors

    e = events(spark, sf_dir).select("series", "seq", "value")
    middle = e.agg(F.floor(F.avg("seq"))).first()[0] or 0
    parts, book = [], None
    for half in (e.filter(F.col("seq") < middle), e.filter(F.col("seq") >= middle)):
        stream, out, state, n = _arriving(half, 2)
        processors.run_available(processors.rolling_stream(stream, "series", "seq", "value", book), out, state, n)
        parts.append(spark.read.schema("series long, seq long, value double, accepted boolean").parquet(out))
        book = processors.stored_states(spark, state, "series", "seq")
    return parts[0].unionByName(parts[1]).select("series", "seq", "accepted")
