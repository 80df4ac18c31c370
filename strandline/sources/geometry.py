"""Capture geometry: a closed table of fields, checked by one expression that names every violation; and the pair gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators import gates

# The numeric fields and the bounds of a capture geometry document, version 1.
NUMBERS = (
    "sprocket_pitch_px", "sprocket_pitch_mad_px", "sprocket_width_px", "sprocket_width_mad_px", "sprocket_height_px", "sprocket_height_mad_px", "sprocket_x_px", "sprocket_x_mad_px",
    "lower_x_minus_midpoint_px", "lower_top_minus_midpoint_px", "lower_top_residual_mad_px", "p24_capture_pitch_px", "p24_capture_pitch_mad_px", "p24_capture_width_px", "p24_capture_width_mad_px",
    "p24_capture_height_px", "p24_capture_height_mad_px", "p24_capture_x_displacement_px", "p24_capture_x_displacement_mad_px",
)
BOUNDS = {
    "sprocket_pitch_px": (500.0, 1000.0),
    "sprocket_width_px": (100.0, 500.0),
    "sprocket_height_px": (100.0, 400.0),
    "sprocket_x_px": (100.0, 700.0),
    "p24_capture_pitch_px": (500.0, 1000.0),
    "p24_capture_width_px": (200.0, 500.0),
    "p24_capture_height_px": (150.0, 400.0),
    "p24_capture_x_displacement_px": (-100.0, 100.0),
}
SUPPORT = {"p15_image_support_width_px": "sprocket_width_px", "p15_image_support_height_px": "sprocket_height_px"}
MEDIANS = ("capture_lower_top_minus_midpoint", "capture_lower_x_minus_midpoint")
SCHEMA = (
    "schema_version int, film_format string, source string, frozen boolean, calibration_frames array<long>, "
    + ", ".join(f"{f} double" for f in (*NUMBERS, *SUPPORT))
    + ", quality map<string, struct<median: double>>"
)


def parsed(df: DataFrame, raw: str = "raw") -> DataFrame:
    """df with `g`, the document in column `raw`; fields of a wrong type are null. Quality medians also go by the
    name with the prefix p24_, and support sizes that are missing are the sprocket's."""
    g = df.withColumn("g", F.from_json(raw, SCHEMA))
    quality = F.coalesce(F.col("g.quality"), F.create_map().cast("map<string, struct<median: double>>"))
    fill = {m: F.coalesce(F.try_element_at(quality, F.lit(m)), F.try_element_at(quality, F.lit(f"p24_{m}"))) for m in MEDIANS}
    out = F.col("g")
    for name, other in SUPPORT.items():
        out = out.withField(name, F.coalesce(F.col(f"g.{name}"), F.col(f"g.{other}")))
    for m, c in fill.items():
        out = out.withField(m, c["median"])
    return g.withColumn("g", out)


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def rules() -> dict[str, Column]:
    g = lambda f: F.col(f"g.{f}")
    named = {
        "schema_version": g("schema_version") == 1,
        "film_format": g("film_format") == "regular8",
        "source": g("source").isNotNull(),
        "frozen": F.coalesce(g("frozen"), F.lit(True)),
        "calibration_frames": (F.size("g.calibration_frames") > 0) & F.forall("g.calibration_frames", lambda x: x.isNotNull() & (x >= 1)),
    }
    for f in NUMBERS:
        named[f] = _finite(g(f))
        if f.endswith("_mad_px"):
            named[f] = named[f] & (g(f) >= 0)
        if f in BOUNDS:
            named[f] = named[f] & g(f).between(*BOUNDS[f])
    for f, other in SUPPORT.items():
        named[f] = _finite(g(f)) & g(f).between(*BOUNDS[other])
    for m in MEDIANS:
        named[m] = _finite(g(m))
    return named


def violations(df: DataFrame, raw: str = "raw") -> DataFrame:
    """df with `g` and `violations`, the fields that break a rule, joined by ';' ('' for a valid document)."""
    return parsed(df, raw).withColumn("violations", gates.all_failures(rules()))


# The pair gate without a geometry, and the least widths of its bands with one.
PITCH, WIDTH_MIN, HEIGHT, HEIGHT_DIFFERENCE, X_MOST = (740.0, 835.0), 350.0, (250.0, 340.0), 20.0, 30.0
FLOORS = {"pitch": 6.0, "width": 12.0, "height": 12.0, "x": 6.0}


def pair_gate(df: DataFrame, boxes: str = "boxes", geometry: bool = False) -> DataFrame:
    """df with `checks` (a struct of named booleans), `passed` and `reason`, for boxes array<array<double>> (x, y, w, h).

    The two boxes are sorted by y. With `geometry`, a column g of `parsed` gives bands centre +- max(floor, 4 * MAD)."""
    pair = F.array_sort(boxes, lambda a, b: F.when(a[1] < b[1], -1).when(a[1] > b[1], 1).otherwise(0))
    held = df.withColumn("__b", F.when(F.size(boxes) == 2, pair)).withColumn("__u", F.col("__b")[0]).withColumn("__l", F.col("__b")[1])
    u, low = F.col("__u"), F.col("__l")
    pitch, dx, dh = low[1] - u[1], low[0] - u[0], F.abs(low[3] - u[3])
    both = lambda test: test(u) & test(low)
    if geometry:

        def band(x: Column, name: str, floor: float) -> Column:
            reach = F.greatest(F.lit(floor), 4 * F.col(f"g.p24_capture_{name}_mad_px"))
            return F.abs(x - F.col(f"g.p24_capture_{name}_px")) <= reach

        checks = {
            "pitch": band(pitch, "pitch", FLOORS["pitch"]), "widths": both(lambda b: band(b[2], "width", FLOORS["width"])), "heights": both(lambda b: band(b[3], "height", FLOORS["height"])),
            "height_difference": F.lit(True), "x_displacement": band(dx, "x_displacement", FLOORS["x"]),
        }
    else:
        checks = {
            "pitch": pitch.between(*PITCH), "widths": both(lambda b: b[2] >= WIDTH_MIN), "heights": both(lambda b: b[3].between(*HEIGHT)), "height_difference": dh >= HEIGHT_DIFFERENCE,
            "x_displacement": F.abs(dx) <= X_MOST,
        }
    named = {"pair_present": F.col("__b").isNotNull(), **checks}
    return held.withColumn("checks", gates.predicates(named)).withColumn("passed", gates.accepted(named)).withColumn("reason", gates.first_failure(named)).drop("__b", "__u", "__l")
