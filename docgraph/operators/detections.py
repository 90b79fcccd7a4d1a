"""Object detections per video frame: merging, tracks, filters and scenes.

Detections: video, frame, x, y, w, h, fill_ratio. What is a fold over frames runs in
grouped Arrow functions; a video is cut wherever no track can outlive a gap. What has
no such gap is one task: tracking is sequential, and its state is the active tracks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_GAP = 15
#: Areas under this are specks, whose size and shape flicker.
SPECK = 150
DETECTION_DDL = "video string, frame long, x double, y double, w double, h double, fill_ratio double"


def gap(a: dict | tuple, b: dict | tuple) -> float:
    """Distance between two boxes (x, y, w, h), 0 if they touch."""
    dx = max(0.0, max(a[0], b[0]) - min(a[0] + a[2], b[0] + b[2]))
    dy = max(0.0, max(a[1], b[1]) - min(a[1] + a[3], b[1] + b[3]))
    return float(np.hypot(dx, dy))


def gap_column(a: Column, b: Column) -> Column:
    """As :func:`gap` on structs with x, y, w, h."""

    def axis(at: str, size: str) -> Column:
        return F.greatest(F.lit(0.0), F.greatest(a[at], b[at]) - F.least(a[at] + a[size], b[at] + b[size]))

    return F.hypot(axis("x", "w"), axis("y", "h"))


def union_boxes(boxes: list[tuple], distance: float) -> list[tuple]:
    """Boxes (x, y, w, h, fill) joined until no two are within ``distance``, by x and y; fill follows the areas.

    Joining only grows boxes, so the end is the same in whatever order they are taken:
    each takes in at once all settled boxes that it reaches, and queues up again.
    """
    settled = np.empty((0, 5))  # left, top, right, bottom, filled area
    queue = [np.array([x, y, x + w, y + h, fill * w * h]) for x, y, w, h, fill in boxes]
    while queue:
        own = queue.pop()
        apart = np.maximum(0.0, np.maximum(settled[:, :2], own[:2]) - np.minimum(settled[:, 2:4], own[2:4]))
        reached = np.hypot(apart[:, 0], apart[:, 1]) <= distance
        if reached.any():
            every = np.vstack([settled[reached], own])
            queue.append(np.concatenate([every[:, :2].min(axis=0), every[:, 2:4].max(axis=0), [every[:, 4].sum()]]))
            settled = settled[~reached]
        else:
            settled = np.vstack([settled, own])
    sizes = settled[:, 2:4] - settled[:, :2]
    out = np.column_stack([settled[:, :2], sizes, settled[:, 4] / sizes.prod(axis=1)])
    return sorted(map(tuple, out.tolist()))


def merge_candidates(detections: DataFrame, distance: float) -> DataFrame:
    """Detections with those of a frame joined that come within ``distance`` of each other."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for frame, own in pdf.groupby("frame"):
            boxes = list(own[["x", "y", "w", "h", "fill_ratio"]].itertuples(index=False, name=None))
            rows += [(pdf["video"].iloc[0], frame, *b) for b in union_boxes(boxes, distance)]
        return pd.DataFrame(rows, columns=["video", "frame", "x", "y", "w", "h", "fill_ratio"])

    # A block of frames at a time: frames don't depend on each other.
    blocks = detections.withColumn("__block", (F.col("frame") / 1000).cast("long"))
    return blocks.groupBy("video", "__block").applyInPandas(run, DETECTION_DDL)


def nearest_first(distance: np.ndarray, limit: float) -> np.ndarray:
    """For each row the column that it is matched with, or -1: the smallest distances first, one to one."""
    columns = distance.shape[1]
    out = np.full(len(distance), -1)
    taken = np.zeros(columns, bool)
    order = np.argsort(distance, axis=None, kind="stable")
    for place in order[: np.count_nonzero(distance <= limit)]:
        row, column = divmod(int(place), columns)
        if out[row] < 0 and not taken[column]:
            out[row], taken[column] = column, True
    return out


def link(frames: np.ndarray, boxes: np.ndarray, max_jump: float, max_gap: int = MAX_GAP) -> np.ndarray:
    """The track number of each box (x, y, w, h) of ``frames``, which rise.

    In each frame the distances of its boxes to where tracks were last seen make a
    matrix; pairs of too different sizes are struck out unless both are specks. What
    stays unmatched begins tracks.
    """
    out = np.empty(len(frames), np.int64)
    last, seen = np.empty((0, 4)), np.empty(0, np.int64)
    starts = np.flatnonzero(np.diff(frames, prepend=frames[:1] - 1)) if len(frames) else np.empty(0, np.int64)
    for begin, end in zip(starts, np.append(starts, len(frames))[1:], strict=True):
        own, frame = boxes[begin:end], frames[begin]
        active = np.flatnonzero(frame - seen <= max_gap)
        there = last[active]
        apart = (own[:, None, :2] + own[:, None, 2:] / 2) - (there[None, :, :2] + there[None, :, 2:] / 2)
        area, before = own[:, 2:].prod(axis=1)[:, None], there[:, 2:].prod(axis=1)[None, :]
        alike = (area >= before / 4) & (area <= before * 4) | (area < SPECK) & (before < SPECK)
        matched = nearest_first(np.where(alike, np.hypot(apart[..., 0], apart[..., 1]), np.inf), max_jump) if len(active) else np.full(len(own), -1)
        fresh = matched < 0
        numbers = np.where(fresh, len(seen) + np.cumsum(fresh) - 1, active[matched] if len(active) else 0)
        last, seen = np.vstack([last, own[fresh]]), np.append(seen, np.full(fresh.sum(), frame))
        last[numbers], seen[numbers] = own, frame
        out[begin:end] = numbers
    return out


def segments(detections: DataFrame, max_gap: int = MAX_GAP) -> DataFrame:
    """With ``segment``: counts up where a video has no detection for over ``max_gap`` frames."""
    frames = detections.select("video", "frame").distinct()
    w = Window.partitionBy("video").orderBy("frame")
    cut = (F.col("frame") - F.lag("frame").over(w) > max_gap).cast("int")
    numbered = frames.withColumn("segment", F.sum(F.coalesce(cut, F.lit(0))).over(w))
    return detections.join(numbered, ["video", "frame"])


def link_tracks(detections: DataFrame, max_jump: float, max_gap: int = MAX_GAP) -> DataFrame:
    """Detections with ``track``: video, segment and number of the object they belong to."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["frame", "x", "y", "w", "h"]).reset_index(drop=True)
        numbers = link(pdf["frame"].to_numpy(), pdf[["x", "y", "w", "h"]].to_numpy(float), max_jump, max_gap)
        pdf["track"] = pdf["video"] + "/" + pdf["segment"].astype(str) + "/" + pd.Series(numbers).astype(str)
        return pdf[["video", "frame", "x", "y", "w", "h", "fill_ratio", "track"]]

    return segments(detections, max_gap).groupBy("video", "segment").applyInPandas(run, DETECTION_DDL + ", track string")


def track_scores(tracked: DataFrame, frames: DataFrame, min_length: int = 10) -> DataFrame:
    """video, track, detections, score: coverage of the video's frames (video, n_frames) times mean fill."""
    per = tracked.groupBy("video", "track").agg(F.count("*").alias("detections"), F.avg("fill_ratio").alias("fill"))
    return per.filter(F.col("detections") >= min_length).join(frames, "video").select("video", "track", "detections", (F.col("detections") / F.col("n_frames") * F.col("fill")).alias("score"))


def select_tracks(tracked: DataFrame, frames: DataFrame, dedup_distance: float, most: int = 3, min_length: int = 10, min_share: float = 0.2, min_overlap: int = 10) -> DataFrame:
    """video, track, score, place: the best distinct objects of each video.

    Tracks under a share of the best score are noise; one that runs along with a
    better chosen one (median distance of centres over common frames) is a fragment.
    Fragments are found for all pairs of scored tracks of a video with an equi-join
    on frames; the choice itself goes over scores only.
    """
    scores = track_scores(tracked, frames, min_length)
    best = F.max("score").over(Window.partitionBy("video"))
    scores = scores.withColumn("best", best).filter(F.col("score") >= F.col("best") * min_share).drop("best")
    centres = tracked.join(scores.select("track"), "track", "left_semi").select("video", "frame", "track", (F.col("x") + F.col("w") / 2).alias("cx"), (F.col("y") + F.col("h") / 2).alias("cy"))
    other = centres.select("video", "frame", F.col("track").alias("other"), F.col("cx").alias("ox"), F.col("cy").alias("oy"))
    apart = F.hypot(F.col("cx") - F.col("ox"), F.col("cy") - F.col("oy"))
    pairs = centres.join(other, ["video", "frame"]).filter("track <> other").groupBy("track", "other").agg(F.count("*").alias("n"), F.median(apart).alias("middle"))
    along = pairs.filter((F.col("n") >= min_overlap) & (F.col("middle") < dedup_distance)).groupBy("track").agg(F.collect_set("other").alias("along"))
    listed = scores.join(along, "track", "left")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        chosen: list[tuple] = []
        for row in pdf.sort_values(["score", "track"], ascending=[False, True]).itertuples():
            if len(chosen) == most:
                break
            near = set(row.along) if row.along is not None else set()
            if near.isdisjoint(c[1] for c in chosen):
                chosen.append((row.video, row.track, row.score, len(chosen) + 1))
        return pd.DataFrame(chosen, columns=["video", "track", "score", "place"])

    return listed.groupBy("video").applyInPandas(run, "video string, track string, score double, place int")


def filter_outliers(detections: DataFrame, width: float, height: float, edge_share: float = 0.05, tolerance: float = 2.0, padding: float = 2.0) -> DataFrame:
    """Detections (one a frame) with ``kept``: not near the border, of about median size and shape.

    Size and shape don't count for specks; fewer than five detections all stay.
    """
    area, shape = F.col("w") * F.col("h"), F.col("w") / F.greatest(F.col("h"), F.lit(1))
    figures = detections.groupBy("video").agg(F.count("*").alias("n"), F.median(area).alias("mid_area"), F.median(shape).alias("mid_shape"))
    cx, cy = F.col("x") + F.col("w") / 2, F.col("y") + F.col("h") / 2
    clear = F.greatest(F.lit(8.0), padding * F.sqrt("mid_area"))
    mx, my = F.least(F.lit(width * edge_share), clear), F.least(F.lit(height * edge_share), clear)
    inside = (cx >= mx) & (cx <= width - mx) & (cy >= my) & (cy <= height - my)
    sized = (area <= F.col("mid_area") * tolerance) & (area >= F.col("mid_area") / tolerance)
    flipped = (F.col("mid_shape") > 1) & (shape < 0.7) | (F.col("mid_shape") < 1) & (shape > 1.4)
    good = inside & ((F.col("mid_area") < SPECK) | sized & ~flipped)
    return detections.join(figures, "video").withColumn("kept", (F.col("n") < 5) | good).drop("n", "mid_area", "mid_shape")


def filter_trajectory(detections: DataFrame, max_jump: float = 0.0, window: int = 7) -> DataFrame:
    """Detections (one a frame) with ``kept``: near the running median of centres, and of its size.

    Without ``max_jump`` it is three times the median step, five at least; fewer
    detections than ``window`` all stay. Sizes don't count for specks.
    """
    half = window // 2
    w = Window.partitionBy("video").orderBy("frame")
    around = w.rowsBetween(-half, half)
    d = detections.withColumns({"cx": F.col("x") + F.col("w") / 2, "cy": F.col("y") + F.col("h") / 2, "area": F.col("w") * F.col("h")})
    step = F.hypot(F.col("cx") - F.lag("cx").over(w), F.col("cy") - F.lag("cy").over(w))
    d = d.withColumn("step", step)
    mid = F.lit(0.5)
    d = d.withColumns({"px": F.percentile("cx", mid).over(around), "py": F.percentile("cy", mid).over(around), "pa": F.percentile("area", mid).over(around)})
    figures = d.groupBy("video").agg(F.count("*").alias("n"), F.median("step").alias("mid_step"), F.median("area").alias("mid_area"))
    limit = F.lit(max_jump) if max_jump > 0 else F.greatest(F.col("mid_step") * 3, F.lit(5.0))
    near = F.hypot(F.col("cx") - F.col("px"), F.col("cy") - F.col("py")) <= limit
    ratio = F.col("area") / F.greatest(F.col("pa"), F.lit(1.0))
    sized = (F.col("mid_area") < SPECK) | ratio.between(0.667, 1.5)
    return d.join(figures, "video").withColumn("kept", (F.col("n") < window) | near & sized).select(*detections.columns, "kept")


def candidate_gate(width: float, height: float, min_area: float, max_share: float = 0.05, border: float = 2, region: tuple[float, float, float, float] | None = None) -> Column:
    """Whether a detection has a plausible size, doesn't touch the border, and has its centre in ``region`` (x, y, w, h) if given."""
    area = F.col("w") * F.col("h")
    if region is not None:
        x, y, w, h = region
        cx, cy = F.col("x") + F.col("w") / 2, F.col("y") + F.col("h") / 2
        return candidate_gate(width, height, min_area, max_share, border) & (cx >= x) & (cx < x + w) & (cy >= y) & (cy < y + h)
    inside = (F.col("x") >= border) & (F.col("y") >= border) & (F.col("x") + F.col("w") <= width - border) & (F.col("y") + F.col("h") <= height - border)
    return (area >= min_area) & (area <= width * height * max_share) & inside


def bhattacharyya(p: Column, q: Column) -> Column:
    """Distance of two histograms given as arrays."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    mixed = total(F.zip_with(p, q, lambda x, y: F.sqrt(x * y)))
    scale = F.sqrt(total(p) * total(q))
    return F.sqrt(F.greatest(F.lit(0.0), 1 - mixed / scale))


def scenes(frames: DataFrame, distance: Column, threshold: float = 0.4, min_frames: int = 10) -> DataFrame:
    """video, scene, start, end (exclusive), n: cut where ``distance`` to the previous frame is over the threshold.

    A scene under ``min_frames`` joins the one before it; the first never does. ``frames``
    has video and idx from 0.
    """
    w = Window.partitionBy("video").orderBy("idx")
    cut = F.coalesce(distance > threshold, F.lit(False)) & (F.col("idx") > 0)
    raw = frames.withColumn("raw", F.sum(cut.cast("int")).over(w)).groupBy("video", "raw").agg(F.min("idx").alias("start"), F.max("idx").alias("last"), F.count("*").alias("n"))
    own = (F.col("n") >= min_frames) | (F.col("raw") == 0)
    merged = raw.withColumn("scene", F.sum(own.cast("int")).over(Window.partitionBy("video").orderBy("raw")))
    return merged.groupBy("video", "scene").agg(F.min("start").alias("start"), (F.max("last") + 1).alias("end"), F.sum("n").alias("n"))


def footage_range(classified: DataFrame, totals: DataFrame) -> DataFrame:
    """video, start, end of the longest footage scene, the first of equals, else of everything (video, total)."""
    best = classified.filter(F.col("classification") == "footage").groupBy("video").agg(F.min(F.struct((-F.col("n")).alias("minus"), "start", "end")).alias("best"))
    return totals.join(best, "video", "left").select("video", F.coalesce("best.start", F.lit(0)).alias("start"), F.coalesce("best.end", "total").alias("end"))


def classify(scene_rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Scenes with ``classification``: the verdict (video, scene, verdict) if it is a known class, else footage."""
    known = F.when(F.col("verdict").isin("footage", "title_card", "credits", "other"), F.col("verdict"))
    return scene_rows.join(verdicts, ["video", "scene"], "left").withColumn("classification", F.coalesce(known, F.lit("footage"))).drop("verdict")


def crop_geometry(detections: DataFrame, padding: float) -> DataFrame:
    """video, crop_w, crop_h: median box sizes, padded, made even."""
    even = lambda c: (F.floor(F.median(c) * padding / 2) * 2).cast("long")
    return detections.groupBy("video").agg(even("w").alias("crop_w"), even("h").alias("crop_h"))


def strongest(detections: DataFrame, most: int) -> DataFrame:
    """The ``most`` detections of each frame with the largest filled area; ties by place."""
    filled = F.col("w") * F.col("h") * F.col("fill_ratio")
    rank = F.row_number().over(Window.partitionBy("video", "frame").orderBy(filled.desc(), "x", "y", "w", "h"))
    return detections.withColumn("__rank", rank).filter(F.col("__rank") <= most).drop("__rank")


def frame_candidates(detections: DataFrame, distance: float, max_area: float, before: int = 200, after: int = 30) -> DataFrame:
    """The candidates of frames: the strongest ``before`` are merged, and of what is no larger than ``max_area`` the strongest ``after`` stay."""
    return strongest(merge_candidates(strongest(detections, before), distance).filter(F.col("w") * F.col("h") <= max_area), after)


def crop_offsets(crops: DataFrame) -> DataFrame:
    """crops (track, x, y, ...) with ``dx`` and ``dy``: how far each lies from the track's least corner."""
    low = Window.partitionBy("track")
    return crops.withColumn("dx", F.col("x") - F.min("x").over(low)).withColumn("dy", F.col("y") - F.min("y").over(low))


def best_aligned(frames: DataFrame, most: int = 15, around: int = 5) -> tuple[DataFrame, DataFrame]:
    """Of frames (track, frame, ncc): the ``most`` that agree best, and the ``around`` consecutive ones about the best.

    Both come by frame number; ties go to the earlier frame. Where the best frame is near an end the run shifts inwards.
    """
    by_track = Window.partitionBy("track")
    placed = frames.withColumn("place", F.row_number().over(by_track.orderBy("frame")))
    top = placed.withColumn("rank", F.row_number().over(by_track.orderBy(F.desc("ncc"), "frame")))
    best = F.max(F.when(F.col("rank") == 1, F.col("place"))).over(by_track)
    begin = F.greatest(F.lit(1), F.least(best - around // 2, F.max("place").over(by_track) - around + 1))
    placed_best = top.withColumn("begin", begin)
    return top.filter(F.col("rank") <= most).select("track", "frame", "ncc"), placed_best.filter(F.col("place").between(F.col("begin"), F.col("begin") + around - 1)).select("track", "frame", "ncc")


def sharpness_weights(frames: DataFrame) -> DataFrame:
    """frames (track, frame, sharpness) with ``weight``: shares of the track's sum, or as they are where it is 0."""
    total = F.sum("sharpness").over(Window.partitionBy("track"))
    return frames.withColumn("weight", F.when(total > 0, F.col("sharpness") / total).otherwise(F.col("sharpness")))
