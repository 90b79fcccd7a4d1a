"""Queries on detections: events seen as boxes in videos."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docgraph.operators import detections as d
from docgraph.plans import projections as p
from docgraph.plans.registering import Query, filing

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
query = filing(QUERIES, ORACLES)


@query(f"""WITH {p.DETECTIONS_SQL}, g AS (SELECT *, coalesce(frame - lag(frame) OVER (PARTITION BY video ORDER BY frame) > 15, false) AS cut FROM det)
SELECT video, frame, CAST(sum(cut::INT) OVER (PARTITION BY video ORDER BY frame) AS BIGINT) AS segment FROM g""")
def track_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.segments(p.detections(spark, sf_dir)).select("video", "frame", "segment")


@query(f"""WITH {p.DETECTIONS_SQL}, f AS (SELECT video, count(*) AS n, median(w * h) AS ma, median(w / greatest(h, 1)) AS ms FROM det GROUP BY video),
j AS (SELECT *, x + w / 2 AS cx, y + h / 2 AS cy, least(500 * 0.05, greatest(8, 2 * sqrt(ma))) AS mx, least(300 * 0.05, greatest(8, 2 * sqrt(ma))) AS my FROM det JOIN f USING (video))
SELECT video, frame, n < 5 OR (cx BETWEEN mx AND 500 - mx AND cy BETWEEN my AND 300 - my AND (ma < 150 OR (w * h BETWEEN ma / 2 AND ma * 2 AND NOT (ms > 1 AND w / h < 0.7 OR ms < 1 AND w / h > 1.4)))) AS kept FROM j""")
def outlier_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.filter_outliers(p.detections(spark, sf_dir), 500, 300).select("video", "frame", "kept")


@query(f"""WITH {p.DETECTIONS_SQL}, a AS (SELECT *, x + w / 2 AS cx, y + h / 2 AS cy, w * h AS area FROM det),
b AS (SELECT *, sqrt((cx - lag(cx) OVER o) ** 2 + (cy - lag(cy) OVER o) ** 2) AS step, median(cx) OVER r AS px, median(cy) OVER r AS py, median(area) OVER r AS pa FROM a
      WINDOW o AS (PARTITION BY video ORDER BY frame), r AS (PARTITION BY video ORDER BY frame ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
f AS (SELECT video, count(*) AS n, median(step) AS ms, median(area) AS ma FROM b GROUP BY video)
SELECT video, frame, n < 7 OR (sqrt((cx - px) ** 2 + (cy - py) ** 2) <= greatest(ms * 3, 5) AND (ma < 150 OR area / greatest(pa, 1) BETWEEN 0.667 AND 1.5)) AS kept FROM b JOIN f USING (video)""")
def trajectory_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.filter_trajectory(p.detections(spark, sf_dir)).select("video", "frame", "kept")


@query(f"WITH {p.DETECTIONS_SQL} SELECT video, frame FROM det WHERE w * h >= 200 AND w * h <= 500 * 300 * 0.0025 AND x >= 2 AND y >= 2 AND x + w <= 498 AND y + h <= 298")
def candidate_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.detections(spark, sf_dir).filter(d.candidate_gate(500, 300, 200, 0.0025)).select("video", "frame")


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every detection as a frame, with a histogram of four bins and its distance to the one before."""
    own = p.detections(spark, sf_dir)
    w = Window.partitionBy("video").orderBy("frame")
    bins = F.array(F.col("x") % 50 + 1, F.col("y") % 30 + 1, "w", "h")
    frames = own.select("video", (F.row_number().over(w) - 1).cast("long").alias("idx"), bins.alias("bins"), F.lag(bins).over(w).alias("before"))
    return frames.select("video", "idx", d.bhattacharyya(F.col("bins"), F.col("before")).alias("distance"))


_SCENES_SQL = f"""{p.DETECTIONS_SQL}, hs AS (SELECT video, frame, x % 50 + 1 AS a, y % 30 + 1 AS b, w AS c, h AS d FROM det),
pr AS (SELECT video, row_number() OVER o - 1 AS idx, a, b, c, d, lag(a) OVER o AS pa, lag(b) OVER o AS pb, lag(c) OVER o AS pc, lag(d) OVER o AS pd FROM hs WINDOW o AS (PARTITION BY video ORDER BY frame)),
fr AS (SELECT video, idx, sqrt(greatest(0, 1 - (sqrt(a * pa) + sqrt(b * pb) + sqrt(c * pc) + sqrt(d * pd)) / sqrt((a + b + c + d) * (pa + pb + pc + pd)))) AS distance FROM pr),
rw AS (SELECT *, sum((idx > 0 AND coalesce(distance > 0.25, false))::INT) OVER (PARTITION BY video ORDER BY idx) AS raw FROM fr),
rs AS (SELECT video, raw, min(idx) AS start, max(idx) AS last, count(*) AS n FROM rw GROUP BY ALL),
sc AS (SELECT *, sum((n >= 4 OR raw = 0)::INT) OVER (PARTITION BY video ORDER BY raw) AS scene FROM rs),
scn AS (SELECT video, CAST(scene AS BIGINT) AS scene, min(start) AS start, max(last) + 1 AS "end", CAST(sum(n) AS BIGINT) AS n FROM sc GROUP BY ALL)"""


@query(f"WITH {_SCENES_SQL} SELECT * FROM scn")
def scene_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.scenes(_frames(spark, sf_dir), F.col("distance"), 0.25, 4)


@query(f"""WITH {_SCENES_SQL}, cl AS (SELECT *, CASE WHEN scene % 3 = 0 THEN 'credits' ELSE 'footage' END AS c FROM scn),
be AS (SELECT video, start, "end" FROM cl WHERE c = 'footage' QUALIFY row_number() OVER (PARTITION BY video ORDER BY n DESC, start) = 1)
SELECT t.video, coalesce(start, 0) AS start, coalesce("end", total) AS "end" FROM (SELECT video, count(*) AS total FROM fr GROUP BY video) t LEFT JOIN be USING (video)""")
def footage_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _frames(spark, sf_dir)
    found = d.scenes(frames, F.col("distance"), 0.25, 4)
    verdicts = found.select("video", "scene", F.when(F.col("scene") % 3 == 0, "credits").otherwise("unheard of").alias("verdict"))
    return d.footage_range(d.classify(found, verdicts), frames.groupBy("video").agg(F.count("*").alias("total")))


@query(f"WITH {p.DETECTIONS_SQL} SELECT video, CAST(floor(median(w) * 1.5 / 2) * 2 AS BIGINT) AS crop_w, CAST(floor(median(h) * 1.5 / 2) * 2 AS BIGINT) AS crop_h FROM det GROUP BY video")
def crop_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.crop_geometry(p.detections(spark, sf_dir), 1.5)


@query("""SELECT user_id AS track, event_id AS frame, round(CASE WHEN sum(abs(value)) OVER w > 0 THEN abs(value) / sum(abs(value)) OVER w ELSE abs(value) END, 9) AS weight FROM events WINDOW w AS (PARTITION BY user_id)""")
def sharpness_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = p.table(spark, sf_dir, "events").select(F.col("user_id").alias("track"), F.col("event_id").alias("frame"), F.abs("value").alias("sharpness"))
    return d.sharpness_weights(frames).select("track", "frame", F.round("weight", 9).alias("weight"))


@query(f"""WITH {p.CROWDED_SQL} SELECT video, frame, x, y FROM (SELECT *, row_number() OVER (PARTITION BY video, frame ORDER BY w * h * fill_ratio DESC, x, y, w, h) AS rank FROM cr) WHERE rank <= 3""")
def strongest_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.strongest(p.crowded(spark, sf_dir), 3).select("video", "frame", "x", "y")


@query(f"WITH {p.CROWDED_SQL} SELECT video, frame, x, y FROM cr WHERE w * h >= 100 AND w * h <= 500 * 300 * 0.05 AND x >= 2 AND y >= 2 AND x + w <= 498 AND y + h <= 298 AND x + w / 2 >= 20 AND x + w / 2 < 120 AND y + h / 2 >= 10 AND y + h / 2 < 90")
def region_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.crowded(spark, sf_dir).filter(d.candidate_gate(500, 300, 100, region=(20, 10, 100, 80))).select("video", "frame", "x", "y")


@query("""SELECT user_id AS track, event_id AS frame, value - min(value) OVER w AS dx, event_id % 50 - min(event_id % 50) OVER w AS dy FROM events WINDOW w AS (PARTITION BY user_id)""")
def crop_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = p.table(spark, sf_dir, "events")
    return d.crop_offsets(e.select(F.col("user_id").alias("track"), F.col("event_id").alias("frame"), F.col("value").alias("x"), (F.col("event_id") % 50).alias("y"))).drop("x", "y")


_ALIGNED_SQL = """al AS (SELECT user_id AS track, event_id AS frame, event_id * 7919 % 1000 / 1000 AS ncc FROM events),
pl AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY frame) AS place, row_number() OVER (PARTITION BY track ORDER BY ncc DESC, frame) AS rank, count(*) OVER (PARTITION BY track) AS n FROM al)"""


def _aligned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = p.table(spark, sf_dir, "events")
    return d.best_aligned(e.select(F.col("user_id").alias("track"), F.col("event_id").alias("frame"), (F.col("event_id") * 7919 % 1000 / 1000).alias("ncc")))


@query(f"WITH {_ALIGNED_SQL} SELECT track, frame, ncc FROM pl WHERE rank <= 15")
def similar_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aligned(spark, sf_dir)[0]


@query(f"""WITH {_ALIGNED_SQL}, b AS (SELECT track, greatest(1, least(place - 2, n - 4)) AS low FROM pl WHERE rank = 1)
SELECT track, frame, ncc FROM pl JOIN b USING (track) WHERE place BETWEEN low AND low + 4""")
def frames_around_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aligned(spark, sf_dir)[1]


# What follows is sequential; tests compare it with searches without any order of their own.
@query()
def merge_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of crowded frames, joined within 30 pixels."""
    return d.merge_candidates(p.crowded(spark, sf_dir), 30.0)


@query()
def frame_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.frame_candidates(p.crowded(spark, sf_dir), 20.0, 1500.0, before=6, after=3)


@query()
def link_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.link_tracks(p.crowded(spark, sf_dir), 60.0)


@query()
def select_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = p.crowded(spark, sf_dir)
    frames = boxes.groupBy("video").agg(F.countDistinct("frame").alias("n_frames"))
    return d.select_tracks(d.link_tracks(boxes, 60.0), frames, 20.0, min_length=3, min_overlap=2)
