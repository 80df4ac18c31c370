"""Array kernels over rasters, as plain numpy functions and as Arrow-batched column functions.

A raster is a binary column of height * width * 3 bytes in rows of pixels. Decoding camera RAW, encoding video and
drawing are out of scope: their codecs are not part of the engine.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class BandParameters:
    """Fixed values of the bright-band pair detector."""

    x0: int = 100
    x1: int = 570
    percentile: float = 99.0
    scale: float = 0.90
    row_pixels: int = 130
    height_min: int = 180
    height_max: int = 330
    pitch: float = 785.0
    pitch_tolerance: float = 100.0
    columns: int = 200
    fill: float = 0.55
    width: float = 365.0


def mask_runs(mask: np.ndarray) -> np.ndarray:
    """Half-open runs of true values, one row (start, end) each."""
    edge = np.diff(np.concatenate([[0], np.asarray(mask, np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def band_pair(rgb: np.ndarray, p: BandParameters = BandParameters()) -> tuple[float, float, float] | None:
    """(score, centre x, centre y) of the best pair of neighbouring bright bands, least tuple first; None if there is none.

    All bands are measured at once: running column sums give each band's share of lit pixels in every column."""
    level = rgb[:, p.x0 : p.x1].astype(np.float32).mean(axis=2)
    lit = level > np.float32(np.percentile(level, p.percentile) * p.scale)
    runs = mask_runs(lit.sum(axis=1) > p.row_pixels)
    height = runs[:, 1] - runs[:, 0]
    runs, height = (x[(height >= p.height_min) & (height <= p.height_max)] for x in (runs, height))
    if len(runs) < 2:
        return None
    sums = np.concatenate([np.zeros((1, lit.shape[1]), np.int64), np.cumsum(lit, axis=0)])
    full = (sums[runs[:, 1]] - sums[runs[:, 0]]) / height[:, None] > p.fill
    left, right = full.argmax(axis=1), full.shape[1] - full[:, ::-1].argmax(axis=1)
    wide = full.sum(axis=1) >= p.columns
    x, y, width = (left + right - 1) / 2 + p.x0, runs.sum(axis=1) / 2, right - left
    off = np.abs(np.diff(y) - p.pitch)
    score = off + 2 * np.abs(np.diff(x)) + 0.2 * np.abs((width[1:] + width[:-1]) / 2 - p.width)
    table = np.stack([score, (x[1:] + x[:-1]) / 2, (y[1:] + y[:-1]) / 2], axis=1)[(off <= p.pitch_tolerance) & wide[1:] & wide[:-1]]
    return tuple(map(float, table[np.lexsort(table.T[::-1])[0]])) if len(table) else None


def picture_medians(rgb: np.ndarray, low: float = 0.03, high: float = 0.96, least: int = 100) -> tuple[float, float, float, float]:
    """Median luma and channel medians of the usable pixels of the inner aperture, of all its pixels if too few are usable."""
    h, w = rgb.shape[:2]
    part = rgb[int(h * 0.12) : int(h * 0.88), int(w * 0.15) : int(w * 0.92)].reshape(-1, 3).astype(np.float32) / 255
    luma = part @ np.array([0.2126, 0.7152, 0.0722], np.float32)
    keep = (luma > low) & (luma < high)
    if keep.sum() < least:
        keep[:] = True
    if not keep.any():
        return (float("nan"),) * 4
    return (float(np.median(luma[keep])), *map(float, np.median(part[keep], axis=0)))


def colour_terms(x: np.ndarray) -> np.ndarray:
    """The 13 polynomial features of `scalars.polynomial` for rows of three channels."""
    r, g, b = x.T
    return np.column_stack([np.ones(len(x)), x, np.sqrt(np.maximum(x, 0)), x * x, r * g, r * b, g * b])


def match_colours(rgb: np.ndarray, coefficients: np.ndarray, luts: np.ndarray) -> np.ndarray:
    """13 polynomial features times coefficients (13 x 3), then one table of 256 values for each channel; floats in [0, 1]."""
    mixed = np.clip(colour_terms(rgb.reshape(-1, 3).astype(np.float64)) @ coefficients, 0, 1) * 255
    out = [np.interp(mixed[:, k], np.arange(256), luts[k]) for k in range(3)]
    return np.clip(np.stack(out, axis=1), 0, 1).reshape(rgb.shape)


def fit_match(source: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients by least squares (singular values below 1e-6 of the largest are dropped) and monotone median tables."""
    terms, goal = colour_terms(source.reshape(-1, 3).astype(np.float64)), target.reshape(-1, 3)
    coefficients = np.linalg.lstsq(terms, goal, rcond=1e-6)[0]
    mixed = np.clip(terms @ coefficients, 0, 1)
    luts = []
    for k in range(3):
        at = np.floor(mixed[:, k] * 256).astype(int)
        inside = at < 256  # the value 1.0 falls in no bin
        frame = pd.Series(goal[inside, k]).groupby(at[inside]).median()
        luts.append(np.maximum.accumulate(np.interp(np.arange(256), frame.index, frame.to_numpy())))
    return coefficients, np.array(luts)


def bilinear(image: np.ndarray, left: float, top: float, width: int, height: int) -> np.ndarray:
    """A crop at a fractional place; beyond the edges the edge repeats."""
    xs, ys = np.clip(left + np.arange(width), 0, image.shape[1] - 1), np.clip(top + np.arange(height), 0, image.shape[0] - 1)
    x0, y0 = np.floor(xs).astype(int), np.floor(ys).astype(int)
    fx, fy = (xs - x0)[None, :, None], (ys - y0)[:, None, None]
    rows = lambda y: image[y][:, x0] * (1 - fx) + image[y][:, np.minimum(x0 + 1, image.shape[1] - 1)] * fx
    return rows(y0) * (1 - fy) + rows(np.minimum(y0 + 1, image.shape[0] - 1)) * fy


def compare(a: np.ndarray, b: np.ndarray) -> dict[str, float | bool | None]:
    """Mean and largest absolute error, MSE and PSNR (None: infinite)."""
    if a.shape != b.shape:
        return {"same_shape": False, "mae": None, "worst": None, "mse": None, "psnr": None}
    d = a.astype(np.float64) - b.astype(np.float64)
    mse = float((d * d).mean())
    return {"same_shape": True, "mae": float(np.abs(d).mean()), "worst": float(np.abs(d).max()), "mse": mse, "psnr": 10 * float(np.log10(255.0**2 / mse)) if mse else None}


def unpack12(data: bytes) -> np.ndarray:
    """12-bit samples, two in three bytes: high bits first, the third byte holds both low nibbles."""
    b = np.frombuffer(data, np.uint8)[: len(data) // 3 * 3].reshape(-1, 3).astype(np.uint16)
    return np.stack([b[:, 0] << 4 | b[:, 2] & 15, b[:, 1] << 4 | b[:, 2] >> 4], axis=1).ravel()


@dataclass(frozen=True)
class EdgeParameters:
    """Fixed values of the column consensus of an edge."""

    step: int = 2
    peak: float = 20.0
    prominence: float = 8.0
    noise_floor: float = 2.0
    snr: float = 2.5
    curvature: float = 1.0
    fraction: float = 0.75
    support: int = 24
    share: float = 0.2


def edge_consensus(gradient: np.ndarray, rows: np.ndarray, p: EdgeParameters = EdgeParameters()) -> tuple[float | None, int]:
    """(row of an edge, inlier columns): where the steepest rows of the columns that stand out agree.

    One matrix holds all columns. The three cells around each column's maximum are blanked for its noise level, and one
    validity mask decides which columns take part."""
    cells = gradient[rows][:, :: p.step].astype(np.float64)
    n, m = cells.shape
    if n < 3 or not m:
        return None, 0
    top, column = cells.argmax(axis=0), np.arange(m)
    quiet = np.where(np.abs(np.arange(n)[:, None] - top) <= 1, np.nan, cells)
    with np.errstate(all="ignore"), warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)  # columns of three cells have no quiet part
        level = np.nan_to_num(np.nanmedian(quiet, axis=0))
        noise = np.fmax(1.4826 * np.nanmedian(np.abs(quiet - level), axis=0), p.noise_floor)
    at = np.clip(top, 1, n - 2)
    before, best, after = cells[at - 1, column], cells[at, column], cells[at + 1, column]
    curve = before - 2 * best + after
    sharp = curve < -p.curvature
    shift = np.where(sharp, (before - after) / (2 * np.where(sharp, curve, 1)), 0.0)
    place = rows[at] + np.where(np.abs(shift) <= p.fraction, shift, 0.0)
    valid = (top == at) & (best >= p.peak) & (best - level >= np.maximum(p.prominence, p.snr * noise))
    if not valid.any():
        return None, 0
    distance = np.abs(place - np.median(place[valid]))
    near = valid & (distance <= max(1.0, 3 * float(np.median(distance[valid]))))
    inliers = int(near.sum())
    return (float(np.median(place[near])) if inliers >= max(p.support, p.share * m) else None), inliers


def rise(rgb: np.ndarray) -> np.ndarray:
    """The vertical gradient of the smoothed brightness; borders are mirrored. The Rec. 601 weights and the
    binomial and Sobel masks."""
    gray = np.rint(rgb.astype(np.float64) @ np.array([0.299, 0.587, 0.114]))
    down, across = np.pad(gray, ((2, 2), (0, 0)), "reflect"), len(gray)
    smooth = sum(k * down[i : i + across] for i, k in enumerate((1, 4, 6, 4, 1))) / 16
    p = np.pad(smooth, 1, "reflect")
    wide = p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return wide[2:] - wide[:-2]


def lower_edge(rgb: np.ndarray, x: float, expected: float, width: float, radius: int = 8, half: float = 0.3, p: EdgeParameters = EdgeParameters()) -> tuple[float | None, int]:
    """(row, inlier columns) of a rising edge near row `expected`, in columns within half * width of x."""
    left, right = max(0, int(x - width * half)), min(rgb.shape[1], int(x + width * half))
    top, bottom = max(0, int(expected - radius - 5)), min(rgb.shape[0], int(expected + radius + 6))
    if right - left < 3 or bottom - top < 3:
        return None, 0
    rows = np.arange(np.floor(expected - top - radius), np.ceil(expected - top + radius) + 1).astype(int)
    at, n = edge_consensus(rise(rgb[top:bottom, left:right]), rows[(rows >= 0) & (rows < bottom - top)], p)
    return (None if at is None else at + top), n


def coarse_to_fine(cost, n: int, top: int = 2, size: int = 64, step: int = 8, reach: int = 4) -> np.ndarray:
    """(x, y) of the least cost for each of n rows: all nodes of a coarse grid, then all within `reach` of the best `top`.

    cost takes two arrays of nodes, a row of nodes for each row; ties go to the least x, then the least y."""
    axis = np.arange(0, size, step)
    x, y = (np.broadcast_to(g.ravel(), (n, len(axis) ** 2)) for g in np.meshgrid(axis, axis, indexing="ij"))
    best = np.argsort(cost(x, y), axis=1, kind="stable")[:, :top]
    near = np.arange(-reach, reach + 1)
    dx, dy = (g.ravel() for g in np.meshgrid(near, near, indexing="ij"))
    x, y = ((np.take_along_axis(g, best, axis=1)[:, :, None] + d).reshape(n, -1) for g, d in ((x, dx), (y, dy)))
    c = cost(x, y)
    place = np.where(c == c.min(axis=1, keepdims=True), (x + size) * 4 * size + y + size, np.iinfo(np.int64).max).min(axis=1)
    return np.stack([place // (4 * size) - size, place % (4 * size) - size], axis=1)


def nearest_node(x: Column, y: Column) -> Column:
    """`coarse_to_fine` for the squared distance to (x, y), batch by batch: a struct of x and y."""
    return _nearest_node(x.cast("double"), y.cast("double"))


@F.pandas_udf(T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.LongType())]))
def _nearest_node(x: pd.Series, y: pd.Series) -> pd.DataFrame:
    a, b = x.to_numpy()[:, None], y.to_numpy()[:, None]
    return pd.DataFrame(coarse_to_fine(lambda u, v: (u - a) * (u - a) + (v - b) * (v - b), len(x)), columns=["x", "y"])


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def _rasters(data: pd.Series, height: pd.Series, width: pd.Series):
    for raw, h, w in zip(data, height, width, strict=True):
        yield np.frombuffer(raw, np.uint8).reshape(h, w, 3) if raw is not None and len(raw) == 3 * h * w else None


@F.pandas_udf(_doubles("cx", "cy", "score"))
def band_pair_column(data: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    found = [None if r is None else band_pair(r) for r in _rasters(data, height, width)]
    return pd.DataFrame([(f[1], f[2], f[0]) if f else (None, None, None) for f in found], columns=["cx", "cy", "score"], dtype=float)


@F.pandas_udf(_doubles("luma", "r", "g", "b"))
def picture_medians_column(data: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None,) * 4 if r is None else picture_medians(r) for r in _rasters(data, height, width)], columns=["luma", "r", "g", "b"], dtype=float)


@F.pandas_udf(_doubles("y", "inliers"))
def lower_edge_column(data: pd.Series, height: pd.Series, width: pd.Series, x: pd.Series, expected: pd.Series, wide: pd.Series) -> pd.DataFrame:
    found = [(None, 0) if r is None or not np.isfinite([a, e, w]).all() else lower_edge(r, a, e, w) for r, a, e, w in zip(_rasters(data, height, width), x, expected, wide, strict=True)]
    return pd.DataFrame(found, columns=["y", "inliers"], dtype=float)


def detected(data: Column, height: Column, width: Column) -> Column:
    """The band pair of a raster; null fields if the raster is missing, damaged or has no pair."""
    return band_pair_column(data, height, width)
