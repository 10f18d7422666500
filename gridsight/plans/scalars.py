"""Queries over names, texts and edited boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridsight.functions import editing
from gridsight.functions import geometry as G
from gridsight.functions import grid
from gridsight.plans.registry import nearest, query
from gridsight.sources import imagery, landuse


@query("SELECT event_id, CASE WHEN s >= 3600 THEN concat(s // 3600, 'h ', s % 3600 // 60, 'm') WHEN s >= 60 THEN concat(s // 60, 'm ', lpad(CAST(s % 60 AS VARCHAR), 2, '0'), 's') ELSE concat(s, 's') END AS elapsed FROM (SELECT event_id, event_id * 13 % 9000 AS s FROM events)")
def elapsed_text(t):
    return t("events").select("event_id", editing.elapsed(F.col("event_id") * 13 % 9000).alias("elapsed"))


@query("SELECT year, layer FROM (VALUES " + ", ".join(f"({y}, '{n}')" for y, n in imagery.LAYERS.items()) + ") AS v(year, layer)")
def layer_catalog(t):
    return t.spark.createDataFrame(sorted(imagery.LAYERS.items()), "year int, layer string")


_TEXTS = {p: landuse.query_text("Helsinki", p) for p in landuse.PROFILES}


@query(" UNION ALL ".join(f"SELECT '{p}' AS profile, substr(sha256('{text}'), 1, 16) AS key" for p, text in _TEXTS.items()))
def landuse_query_keys(t):
    """Cache keys of the service's queries."""
    return t.spark.createDataFrame(list(_TEXTS.items()), "profile string, q string").select("profile", F.substring(F.sha2("q", 256), 1, 16).alias("key"))


@query("SELECT det_id, CASE WHEN status = 'rejected' THEN 'rejected' WHEN class <> '' THEN class ELSE 'candidate' END AS colour FROM fx_label", "fx_label")
def box_colours(t):
    return t("fx_label").select("det_id", editing.colour(F.col("status"), F.col("class")).alias("colour"))


@query("SELECT c_custkey, regexp_full_match(name, '[A-Za-z0-9_-]+') AS safe FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN concat(c_name, '/..') ELSE '' END AS name FROM customer)")
def safe_names(t):
    name = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).when(F.col("c_custkey") % 3 == 1, F.concat("c_name", F.lit("/.."))).otherwise("")
    return t("customer").select("c_custkey", editing.safe_name(name).alias("safe"))


_SHORT = "sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) <= sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"


@query(f"""WITH m AS (SELECT det_id, CASE WHEN {_SHORT} THEN (x0 + x1) / 2 ELSE (x1 + x2) / 2 END AS e1, CASE WHEN {_SHORT} THEN (y0 + y1) / 2 ELSE (y1 + y2) / 2 END AS n1, CASE WHEN {_SHORT} THEN (x2 + x3) / 2 ELSE (x3 + x0) / 2 END AS e2, CASE WHEN {_SHORT} THEN (y2 + y3) / 2 ELSE (y3 + y0) / 2 END AS n2 FROM fx_detection),
o AS (SELECT *, CASE WHEN abs((e1 + n1) - (e2 + n2)) > 1e-6 THEN (e1 + n1) - (e2 + n2) > 0 ELSE e1 - n1 > e2 - n2 END AS ahead FROM m)
SELECT det_id, {nearest("CASE WHEN ahead THEN e1 ELSE e2 END")} AS nose_e, {nearest("CASE WHEN ahead THEN n1 ELSE n2 END")} AS nose_n, {nearest("CASE WHEN ahead THEN e2 ELSE e1 END")} AS tail_e FROM o""", "fx_detection")
def centrelines(t):
    """Boxes as centrelines."""
    line = editing.centreline_of(G.box_ring())
    return t.stored_boxes().select("det_id", line.alias("c")).select("det_id", G.scaled(F.col("c.nose.x")).alias("nose_e"), G.scaled(F.col("c.nose.y")).alias("nose_n"), G.scaled(F.col("c.tail.x")).alias("tail_e"))


@query("""WITH c AS (SELECT s_suppkey AS id, CAST(s_suppkey % 40 AS DOUBLE) AS dx, CAST(s_suppkey % 7 AS DOUBLE) AS dy FROM supplier), l AS (SELECT *, sqrt(dx * dx + dy * dy) AS len FROM c)
SELECT id, """ + nearest("CASE WHEN len < 1e-6 THEN 0 ELSE greatest(least(30, greatest(2, len + 1.5)), 3) END") + " AS length_mm FROM l")
def lengthened_boxes(t):
    """Centrelines grown by a metre and a half."""
    k = F.col("s_suppkey")
    nose, tail = editing.point(F.lit(0.0), F.lit(0.0)), editing.point(k % 40, k % 7)
    grown = t("supplier").select(k.alias("id"), editing.lengthened(nose, tail, F.lit(1.5), F.lit(3.0)).alias("c"))
    dx, dy = F.col("c.tail.x") - F.col("c.nose.x"), F.col("c.tail.y") - F.col("c.nose.y")
    return grown.select("id", G.scaled(F.sqrt(dx * dx + dy * dy)).alias("length_mm"))


@query("SELECT DISTINCT concat('e', CAST(floor(((x0 + x1 + x2 + x3) / 4) / 1000) AS BIGINT), 'n', CAST(floor(((y0 + y1 + y2 + y3) / 4) / 1000) AS BIGINT)) AS name FROM fx_detection", "fx_detection")
def cell_names(t):
    col, row = grid.cell_of(F.col("cx"), F.col("cy"), 1000.0)
    return t.stored_boxes().select(grid.cell_name(col, row).alias("name")).distinct()
