"""Pixel kernels on frames, in numpy, as functions of arrays and as Arrow functions over frame tables.

A frame table has video, frame, height, width and pixels (BINARY, 8-bit gray, row by
row). Kernels on one frame are pandas UDFs; those on a whole video run once per
video over a bounded number of its frames.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Frames of a video that a background is estimated from.
BACKGROUND_FRAMES = 101


def frame_of(pixels: bytes, height: int, width: int) -> np.ndarray:
    return np.frombuffer(pixels, np.uint8).reshape(height, width).astype(np.float64)


def laplacian_variance(gray: np.ndarray) -> float:
    """Sharpness: the variance of the four-neighbour Laplacian, edges mirrored without repeating them."""
    p = np.pad(gray, 1, mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * gray).var())


def histogram(gray: np.ndarray, bins: int = 16) -> np.ndarray:
    """The share of pixels in equal ranges of brightness."""
    return np.bincount((gray.astype(int) * bins // 256).ravel(), minlength=bins) / gray.size


def savitzky_golay(values: np.ndarray, window: int = 31, order: int = 2) -> np.ndarray:
    """Each value of the polynomial that fits its window best; the ends use the first and last window's."""
    n = len(values)
    window = min(window, n if n % 2 else n - 1)
    if window <= order:
        return np.asarray(values, float)
    half = window // 2
    powers = np.vander(np.arange(-half, half + 1), order + 1, increasing=True)
    fit = np.linalg.pinv(powers)
    out = np.convolve(values, fit[0][::-1], mode="same").astype(float)
    out[:half] = powers[:half] @ (fit @ values[:window])
    out[-half:] = powers[-half:] @ (fit @ values[-window:])
    return out


def controls_cutoff(brightness: np.ndarray) -> float:
    """The share of rows above a player's controls, 1 if there are none, by mean row brightness.

    Controls lie under a dark band in the lower two fifths with something brighter
    below it, or are a bright stripe on a dark lowest part.
    """
    h = len(brightness)
    dark = np.concatenate([[False], brightness < 5.0, [False]])
    edges = np.flatnonzero(dark[1:] != dark[:-1]).reshape(-1, 2)
    for begin, end in edges:
        begin = max(begin, int(h * 0.6))
        below = brightness[end:]
        if end - begin >= max(5, h * 0.01) and len(below) > 5 and below.max() > 15:
            return begin / h
    low = brightness[int(h * 0.85) :]
    if len(low) and low.mean() < 20 and low.max() > 40:
        means = np.convolve(brightness, np.ones(10) / 10, mode="valid")
        quiet = np.flatnonzero(means[int(h * 0.7) :] < 10)
        if len(quiet):
            return (int(h * 0.7) + quiet[0]) / h
    return 1.0


def phase_shift(reference: np.ndarray, moved: np.ndarray) -> tuple[float, float]:
    """(dy, dx) by which ``moved`` is shifted against ``reference``, to a fraction of a pixel."""
    cross = np.fft.fft2(moved) * np.conj(np.fft.fft2(reference))
    peak = np.fft.ifft2(cross / np.maximum(np.abs(cross), 1e-12)).real
    at = np.unravel_index(np.argmax(peak), peak.shape)

    def refined(axis: int) -> float:
        n, i = peak.shape[axis], at[axis]
        before, top, after = (np.take(np.take(peak, [(i + d) % n], axis), [at[1 - axis]], 1 - axis).item() for d in (-1, 0, 1))
        curve = before - 2 * top + after
        i = i - n if i > n // 2 else i
        return i + (0.5 * (before - after) / curve if curve else 0.0)

    return refined(0), refined(1)


def shifted(gray: np.ndarray, dy: float, dx: float) -> np.ndarray:
    """``gray`` moved by a fraction of a pixel, periodically."""
    fy, fx = np.fft.fftfreq(gray.shape[0])[:, None], np.fft.fftfreq(gray.shape[1])[None, :]
    return np.fft.ifft2(np.fft.fft2(gray) * np.exp(-2j * np.pi * (fy * dy + fx * dx))).real


def drizzle(frames: list[np.ndarray], shifts: list[tuple[float, float]], weights: list[float], scale: int = 2) -> np.ndarray:
    """Frames put back by their shifts on a finer grid, weighted by sharpness."""
    fine = [shifted(np.kron(f, np.ones((scale, scale))), -dy * scale, -dx * scale) for f, (dy, dx) in zip(frames, shifts, strict=True)]
    return np.tensordot(np.asarray(weights) / sum(weights), np.array(fine), 1)


def back_projection(frames: list[np.ndarray], shifts: list[tuple[float, float]], weights: list[float], scale: int = 2, turns: int = 20, step: float = 0.5) -> np.ndarray:
    """Super-resolution: the fine image that, shifted and averaged down, gives the frames; stops when the error grows."""
    image = drizzle(frames, shifts, weights, scale)
    share = np.asarray(weights) / sum(weights)
    last = np.inf
    for turn in range(turns):
        update, error = np.zeros_like(image), 0.0
        for frame, (dy, dx), w in zip(frames, shifts, share, strict=True):
            seen = shifted(image, dy * scale, dx * scale)
            coarse = seen.reshape(frame.shape[0], scale, frame.shape[1], scale).mean(axis=(1, 3))
            error += w * np.mean((frame - coarse) ** 2)
            update += w * shifted(np.kron(frame - coarse, np.ones((scale, scale))), -dy * scale, -dx * scale)
        if turn > 5 and error > last * 1.05:
            break
        image, last = image + step * update, error
    return np.clip(image, 0, 255)


def regions(mask: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """x, y, w, h and fill of the connected (eight neighbours) parts of a mask, by runs and union-find."""
    parent: list[int] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    runs, above = [], []
    for y, row in enumerate(mask):
        padded = np.concatenate([[False], row, [False]])
        own = []
        for begin, end in np.flatnonzero(padded[1:] != padded[:-1]).reshape(-1, 2).tolist():
            parent.append(len(parent))
            own.append((begin, end, len(parent) - 1))
            runs.append((y, begin, end))
            for a, b, i in above:
                if a <= end and b >= begin:
                    parent[root(len(parent) - 1)] = root(i)
        above = own
    boxes: dict[int, list[int]] = {}
    for i, (y, begin, end) in enumerate(runs):
        box = boxes.setdefault(root(i), [begin, y, end, y + 1, 0])
        box[:4] = [min(box[0], begin), min(box[1], y), max(box[2], end), max(box[3], y + 1)]
        box[4] += end - begin
    return [(x, y, x2 - x, y2 - y, n / ((x2 - x) * (y2 - y))) for x, y, x2, y2, n in boxes.values()]


@F.pandas_udf(T.DoubleType())
def sharpness(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    return pd.Series([laplacian_variance(frame_of(*x)) for x in zip(pixels, height, width, strict=True)])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def histograms(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    return pd.Series([histogram(frame_of(*x)).tolist() for x in zip(pixels, height, width, strict=True)])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def row_brightness(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    return pd.Series([frame_of(*x).mean(axis=1).tolist() for x in zip(pixels, height, width, strict=True)])


def backgrounds(frames: DataFrame) -> DataFrame:
    """video, background: the median of up to ``BACKGROUND_FRAMES`` frames of each video, evenly picked."""
    last = frames.groupBy("video").agg(F.max("frame").alias("last"))
    step = F.greatest(F.ceil((F.col("last") + 1) / BACKGROUND_FRAMES), F.lit(1))
    picked = frames.join(last, "video").filter(F.col("frame") % step == 0).select("video", "height", "width", "pixels")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h, w = int(pdf["height"].iloc[0]), int(pdf["width"].iloc[0])
        middle = np.median([np.frombuffer(p, np.uint8) for p in pdf["pixels"]], axis=0).astype(np.uint8)
        return pd.DataFrame([(pdf["video"].iloc[0], h, w, middle.tobytes())], columns=["video", "height", "width", "background"])

    return picked.groupBy("video").applyInPandas(run, "video string, height int, width int, background binary")


def detect(frames: DataFrame, threshold: float = 25, min_area: int = 4) -> DataFrame:
    """Detections: the parts of each frame that differ from the background by more than ``threshold``."""
    rows = frames.join(backgrounds(frames).select("video", "background"), "video")

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in ("x", "y", "w", "h", "fill_ratio")])))
    def found(pixels: pd.Series, background: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
        out = []
        for p, b, h, w in zip(pixels, background, height, width, strict=True):
            boxes = regions(np.abs(frame_of(p, h, w) - frame_of(b, h, w)) > threshold)
            out.append([dict(zip(("x", "y", "w", "h", "fill_ratio"), map(float, box), strict=True)) for box in boxes if box[2] * box[3] >= min_area])
        return pd.Series(out)

    boxes = rows.select("video", F.col("frame").cast("long").alias("frame"), F.explode(found("pixels", "background", "height", "width")).alias("b"))
    return boxes.select("video", "frame", "b.x", "b.y", "b.w", "b.h", "b.fill_ratio")


def crops(frames: DataFrame, detections: DataFrame, size: DataFrame) -> DataFrame:
    """video, frame, left, top, height, width, pixels around each detection (one a frame), inside the frame; ``size``: video, crop_w, crop_h."""
    rows = frames.join(detections.select("video", "frame", (F.col("x") + F.col("w") / 2).alias("cx"), (F.col("y") + F.col("h") / 2).alias("cy")), ["video", "frame"]).join(size, "video")
    rows = rows.withColumns({"cw": F.least("crop_w", "width").cast("int"), "ch": F.least("crop_h", "height").cast("int")})
    clamp = lambda middle, own, whole: F.greatest(F.lit(0), F.least(F.floor(middle - own / 2), whole - own)).cast("int")
    rows = rows.withColumns({"left": clamp(F.col("cx"), F.col("cw"), F.col("width")), "top": clamp(F.col("cy"), F.col("ch"), F.col("height"))})

    @F.pandas_udf(T.BinaryType())
    def cut(pixels: pd.Series, height: pd.Series, width: pd.Series, left: pd.Series, top: pd.Series, cw: pd.Series, ch: pd.Series) -> pd.Series:
        out = []
        for p, h, w, x, y, a, b in zip(pixels, height, width, left, top, cw, ch, strict=True):
            out.append(np.frombuffer(p, np.uint8).reshape(h, w)[y : y + b, x : x + a].tobytes())
        return pd.Series(out)

    return rows.select("video", "frame", "left", "top", F.col("ch").alias("height"), F.col("cw").alias("width"), cut("pixels", "height", "width", "left", "top", "cw", "ch").alias("pixels"))


def stack(cropped: DataFrame, scale: int = 2) -> DataFrame:
    """video, height, width, pixels: the crops of each video, aligned to the sharpest and resolved on a finer grid."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        images = [frame_of(*x) for x in pdf[["pixels", "height", "width"]].itertuples(index=False, name=None)]
        weights = [laplacian_variance(i) + 1e-9 for i in images]
        reference = images[int(np.argmax(weights))]
        result = back_projection(images, [phase_shift(reference, i) for i in images], weights, scale)
        h, w = result.shape
        return pd.DataFrame([(pdf["video"].iloc[0], h, w, result.round().astype(np.uint8).tobytes())], columns=["video", "height", "width", "pixels"])

    return cropped.groupBy("video").applyInPandas(run, "video string, height int, width int, pixels binary")
