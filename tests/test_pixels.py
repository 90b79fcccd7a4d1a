"""Pixel kernels on drawn frames."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgraph.operators import detections, pixels


def drawn(height=60, width=80, at=None):
    y, x = np.mgrid[:height, :width]
    image = 60 + 20 * np.sin(x / 7) + 15 * np.cos(y / 5)
    if at:
        image[at[1] : at[1] + 6, at[0] : at[0] + 6] = 250
    return image.astype(np.uint8)


def table(spark, images):
    rows = [("v", i, *image.shape, bytearray(image.tobytes())) for i, image in enumerate(images)]
    return spark.createDataFrame(rows, "video string, frame long, height int, width int, pixels binary")


def test_sharpness_and_histogram(spark):
    flat, edge = np.full((20, 20), 100, np.uint8), np.zeros((20, 20), np.uint8)
    edge[:, 10:] = 200
    df = table(spark, [flat, edge]).select("frame", pixels.sharpness("pixels", "height", "width").alias("s"), pixels.histograms("pixels", "height", "width").alias("h"))
    a, b = sorted(df.collect())
    assert a["s"] == 0 < b["s"] and a["h"][6] == 1.0 and b["h"][0] == b["h"][12] == 0.5


def test_smoothing_keeps_parabolas():
    x = np.arange(60.0)
    parabola = 3 + 2 * x - 0.1 * x**2
    assert np.allclose(pixels.savitzky_golay(parabola, 15), parabola)
    noisy = parabola + np.random.default_rng(1).normal(0, 1, 60)
    assert np.abs(pixels.savitzky_golay(noisy, 15) - parabola).mean() < np.abs(noisy - parabola).mean()
    assert np.allclose(pixels.savitzky_golay(np.array([1.0, 5.0]), 31), [1, 5])


@pytest.mark.parametrize(
    ("parts", "cutoff"),
    [([(100, 80)], 1.0), ([(70, 80), (10, 0), (20, 50)], 0.7), ([(70, 80), (3, 0), (27, 50)], 1.0), ([(74, 80), (20, 1), (6, 60)], 0.74), ([(76, 30), (17, 8), (1, 100), (6, 8)], 0.76)],
)
def test_controls(parts, cutoff):
    rows = np.concatenate([np.full(n, float(b)) for n, b in parts])
    assert pixels.controls_cutoff(rows) == cutoff


def test_shifts_are_found_and_undone():
    image = drawn(64, 64, (30, 20)).astype(float)
    assert pixels.phase_shift(image, np.roll(image, (3, -5), (0, 1))) == pytest.approx((3, -5), abs=0.05)
    assert np.allclose(pixels.shifted(image, 2, 1), np.roll(image, (2, 1), (0, 1)))


def test_super_resolution_beats_enlarging():
    rng = np.random.default_rng(3)
    spectrum = np.fft.fft2(rng.normal(size=(64, 64)))
    f = np.hypot(np.fft.fftfreq(64)[:, None], np.fft.fftfreq(64)[None, :])
    fine = np.fft.ifft2(spectrum * (f < 0.2)).real
    fine = 128 + 60 * fine / np.abs(fine).max()
    shifts = [(a / 2, b / 2) for a in (0, 1) for b in (0, 1)]
    coarse = [pixels.shifted(fine, 2 * dy, 2 * dx).reshape(32, 2, 32, 2).mean(axis=(1, 3)) for dy, dx in shifts]
    result = pixels.back_projection(coarse, shifts, [1.0] * 4)
    plain = np.kron(coarse[0], np.ones((2, 2)))
    assert np.abs(result - fine).mean() < 0.7 * np.abs(plain - fine).mean()


def test_regions_equal_flood_fill():
    rng = np.random.default_rng(5)
    for _ in range(20):
        mask = rng.random((15, 18)) < 0.35
        left = {(int(y), int(x)) for y, x in np.argwhere(mask)}
        want = []
        while left:
            todo, own = [left.pop()], []
            while todo:
                y, x = todo.pop()
                own.append((y, x))
                near = {(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & left
                left -= near
                todo += near
            ys, xs = zip(*own, strict=True)
            w, h = max(xs) - min(xs) + 1, max(ys) - min(ys) + 1
            want.append((min(xs), min(ys), w, h, len(own) / (w * h)))
        assert sorted(pixels.regions(mask)) == sorted(want)


def test_from_frames_to_a_stack(spark):
    frames = table(spark, [drawn(at=(5 + 2 * i, 20)) for i in range(30)])
    found = pixels.detect(frames)
    linked = detections.link_tracks(found, 20.0)
    assert [r["n"] for r in linked.groupBy("track").agg(F.count("*").alias("n")).collect()] == [30]
    size = detections.crop_geometry(found, 2.0)
    cropped = pixels.crops(frames, found, size)
    assert {(r["height"], r["width"]) for r in cropped.collect()} == {(12, 12)}
    (result,) = pixels.stack(cropped).collect()
    assert (result["height"], result["width"]) == (24, 24) and max(result["pixels"]) > 200
