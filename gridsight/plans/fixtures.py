"""Views over the driver's tables in the shapes of the engine, as text that runs in Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.operators.spatial import with_polygon
from gridsight.staging import staged

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_detection": (
        ("events",),
        """WITH b AS (SELECT event_id, CAST((event_id - event_id % 4) / 4 AS BIGINT) AS g, event_id % 4 AS d FROM {events}),
u AS (SELECT event_id, g, CAST(d AS DOUBLE) * CASE WHEN g % 2 = 0 THEN CAST(2.125 AS DOUBLE) ELSE CAST(25 AS DOUBLE) END AS shift,
  CASE g % 4 WHEN 0 THEN CAST(1 AS DOUBLE) WHEN 1 THEN CAST(0 AS DOUBLE) WHEN 2 THEN CAST(0.6 AS DOUBLE) ELSE CAST(0.8 AS DOUBLE) END AS ux,
  CASE g % 4 WHEN 0 THEN CAST(0 AS DOUBLE) WHEN 1 THEN CAST(1 AS DOUBLE) WHEN 2 THEN CAST(0.8 AS DOUBLE) ELSE CAST(-0.6 AS DOUBLE) END AS uy FROM b),
c AS (SELECT event_id AS det_id, ux, uy, CAST(25490000 + (g * 7919) % 8000 AS DOUBLE) + shift * ux AS cx, CAST(6670000 + (g * 104729) % 6000 AS DOUBLE) + shift * uy AS cy,
  CASE WHEN (event_id * 13) % 10 < 2 THEN 'truck' WHEN (event_id * 13) % 10 < 3 THEN 'bus' WHEN (event_id * 13) % 10 < 5 THEN 'van' ELSE 'car' END AS label,
  CAST((event_id * 37) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS confidence, CAST(300 + (event_id * 53) % 1500 AS DOUBLE) / CAST(200 AS DOUBLE) AS hl, CAST(200 + (event_id * 17) % 120 AS DOUBLE) / CAST(200 AS DOUBLE) AS hw FROM u)
SELECT det_id, label, confidence, cx, cy, cx - ux*hl + uy*hw AS x0, cy - uy*hl - ux*hw AS y0, cx + ux*hl + uy*hw AS x1, cy + uy*hl - ux*hw AS y1,
  cx + ux*hl - uy*hw AS x2, cy + uy*hl + ux*hw AS y2, cx - ux*hl - uy*hw AS x3, cy - uy*hl + ux*hw AS y3 FROM c""",
    ),
    "fx_region_part": (
        ("nation",),
        """SELECT n_nationkey AS part_id, CAST(25490000 + (n_nationkey % 5) * 1600 + 100 AS DOUBLE) AS min_e, CAST(6670000 + ((n_nationkey - n_nationkey % 5) / 5) * 1200 + 150 AS DOUBLE) AS min_n,
  CAST(25490000 + (n_nationkey % 5) * 1600 + 1500 AS DOUBLE) AS max_e, CAST(6670000 + ((n_nationkey - n_nationkey % 5) / 5) * 1200 + 1050 AS DOUBLE) AS max_n, CAST(200 AS DOUBLE) AS chamfer, n_name AS district FROM {nation}""",
    ),
    "fx_district": (
        ("nation",),
        "SELECT n_nationkey AS district_id, n_name AS name, CAST(25490000 + (n_nationkey % 5) * 1500 AS DOUBLE) AS e0, CAST(6670000 + ((n_nationkey - n_nationkey % 5) / 5) * 1100 AS DOUBLE) AS n0 FROM {nation}",
    ),
    "fx_street": (
        ("supplier",),
        """SELECT s_suppkey AS street_id, concat('KATU_', CAST(s_suppkey AS VARCHAR(20))) AS kadun_nimi,
  CASE s_suppkey % 4 WHEN 0 THEN 'Asuntokatu' WHEN 1 THEN 'Katuaukio' WHEN 2 THEN 'Pysäköintialue' ELSE 'Tori' END AS kayttotarkoitus,
  CAST(25490000 + (s_suppkey * 79) % 8000 AS DOUBLE) AS min_e, CAST(6670000 + (s_suppkey * 613) % 6000 AS DOUBLE) AS min_n,
  CAST(25490000 + (s_suppkey * 79) % 8000 + 400 AS DOUBLE) AS max_e, CAST(6670000 + (s_suppkey * 613) % 6000 + 60 AS DOUBLE) AS max_n FROM {supplier}""",
    ),
    "fx_parking": (
        ("customer",),
        """SELECT c_custkey AS parking_id, CAST(25490000 + (c_custkey * 5471) % 8000 AS DOUBLE) AS min_e, CAST(6670000 + (c_custkey * 2909) % 6000 AS DOUBLE) AS min_n,
  CAST(25490000 + (c_custkey * 5471) % 8000 + 40 AS DOUBLE) AS max_e, CAST(6670000 + (c_custkey * 2909) % 6000 + 40 AS DOUBLE) AS max_n FROM {customer}""",
    ),
    "fx_label": (
        ("fx_detection",),
        """SELECT det_id, cx, cy, concat('aoi_', CAST(det_id % 25 AS VARCHAR(20))) AS aoi,
  CASE WHEN (det_id * 7) % 20 < 1 THEN 'candidate' WHEN (det_id * 7) % 20 < 15 THEN 'confirmed' WHEN (det_id * 7) % 20 < 18 THEN 'rejected' ELSE 'added' END AS status,
  CASE WHEN (det_id * 7) % 20 < 1 THEN '' WHEN (det_id * 7) % 20 >= 15 AND (det_id * 7) % 20 < 18 THEN '' ELSE label END AS class, x0, y0, x1, y1, x2, y2, x3, y3 FROM {fx_detection}""",
    ),
    "fx_manifest": (
        ("events",),
        """SELECT event_id AS seq, concat('e', CAST(25490 + user_id % 8 AS VARCHAR(20)), 'n', CAST(6670 + (user_id % 6) AS VARCHAR(20))) AS cell,
  CASE event_type WHEN 'signup' THEN 'running' WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'running' ELSE 'done' END AS status, ts FROM {events}""",
    ),
    "fx_pr_curve": (
        ("events",),
        """SELECT CAST(floor(value / CAST(10 AS DOUBLE)) AS BIGINT) AS i, CAST(1 AS DOUBLE) - CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + CAST(count(*) AS DOUBLE)) AS p0, count(*) AS n FROM {events} GROUP BY CAST(floor(value / CAST(10 AS DOUBLE)) AS BIGINT)""",
    ),
    "fx_action": (
        ("events",),
        """SELECT event_id AS seq, event_id * 350 AS at_ms, user_id % 5 AS session, user_id AS box, CASE event_id % 7 WHEN 0 THEN 'draw' WHEN 1 THEN 'classify' WHEN 4 THEN 'reject' WHEN 5 THEN 'classify' ELSE 'move' END AS kind,
  CASE event_id % 3 WHEN 0 THEN 'truck' WHEN 1 THEN 'bus' ELSE 'car' END AS class, event_id AS ring FROM {events}""",
    ),
    "fx_edit": (
        ("events",),
        "SELECT event_id AS seq, user_id AS box, user_id % 5 AS session, event_id * 350 - (event_id % 3) * 100 AS at_ms FROM (SELECT event_id, CAST((event_id - event_id % 10) / 10 AS BIGINT) % 50 AS user_id FROM {events})",
    ),
}


class Tables:
    """``t("fx_detection")``, or a table of the driver by its name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        needs, text = VIEWS[name]
        return self.spark.sql(text, **{n: self(n) for n in needs})

    def parts(self) -> DataFrame:
        """Region parts as polygons: rectangles without their lower left corner."""
        e0, n0, e1, n1, cut = (F.col(c) for c in ("min_e", "min_n", "max_e", "max_n", "chamfer"))
        return with_polygon(self("fx_region_part"), G.edges_of(G.ring((e0 + cut, n0), (e1, n0), (e1, n1), (e0, n1), (e0, n0 + cut))))

    def districts(self) -> DataFrame:
        """Overlapping multipolygons: an angle with a hole, and an island in its corner; all on a lattice of 50 m."""

        def ring(*corners: tuple[int, int]):
            return G.ring(*[(F.col("e0") + x, F.col("n0") + y) for x, y in corners])

        angle = ring((0, 0), (1800, 0), (1800, 800), (1200, 800), (1200, 1300), (0, 1300))
        hole, island = ring((400, 300), (700, 300), (700, 500), (400, 500)), ring((1400, 950), (1400, 1250), (1700, 1250), (1700, 950))
        return self("fx_district").withColumn("shape", F.array(F.array(angle, hole), F.array(island)))

    def rectangles(self, name: str) -> DataFrame:
        e0, n0, e1, n1 = (F.col(c) for c in ("min_e", "min_n", "max_e", "max_n"))
        return with_polygon(self(name), G.edges_of(G.ring((e0, n0), (e1, n0), (e1, n1), (e0, n1))))

    def boxes(self) -> DataFrame:
        """Detections with ``cx`` and ``cy`` as the means of their corners."""
        cx, cy = G.centre()
        return self("fx_detection").withColumns({"cx": cx, "cy": cy})

    def stored_boxes(self) -> DataFrame:
        """``boxes`` as a table, as detections are in use; joins would work out the view's arithmetic for every condition."""
        return staged(self.boxes(), "boxes")


def ctes(*names: str) -> list[str]:
    """DuckDB definitions of views and of what they need, in order."""
    found: dict[str, str] = {}

    def add(name: str) -> None:
        if name in VIEWS and name not in found:
            needs, text = VIEWS[name]
            for n in needs:
                add(n)
            found[name] = f"{name} AS ({text.format(**{n: n for n in needs})})"

    for name in names:
        add(name)
    return list(found.values())
