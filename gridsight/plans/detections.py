"""Queries over detections: measures, grids, suppression and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridsight.functions import crs
from gridsight.functions import geometry as G
from gridsight.functions import grid
from gridsight.operators import enrich as enrichment
from gridsight.operators import density, evaluate, labels, nms, polygons, spatial
from gridsight.plans.registry import CX, CY, LENGTH, SIDE0, SIDE1, WIDTH, WINDOWS_SQL, nearest, query

CENSUS = density.CENSUS_CONFIDENCE


@query(f"SELECT CAST(floor({CX} / 250) AS BIGINT) AS cell_col, CAST(floor({CY} / 250) AS BIGINT) AS cell_row, count(*) AS trucks FROM fx_detection WHERE label = 'truck' AND confidence >= {CENSUS} AND {CX} / 250 <> floor({CX} / 250) AND {CY} / 250 <> floor({CY} / 250) GROUP BY ALL", "fx_detection")
def truck_grid(t):
    """Trucks by 250 m cell; a centre on a cell's edge is in none."""
    return density.by_cell(density.counted(t.boxes())).withColumnRenamed("n", "trucks")


@query(f"SELECT det_id, {nearest(CX)} AS e_mm, {nearest(CY)} AS n_mm, confidence, CAST({CENSUS} AS DOUBLE) AS min_confidence FROM fx_detection WHERE label = 'truck' AND confidence >= {CENSUS}", "fx_detection")
def truck_points(t):
    """Centres of trucks with the threshold they passed."""
    return density.counted(t.boxes()).select("det_id", G.scaled(F.col("cx")).alias("e_mm"), G.scaled(F.col("cy")).alias("n_mm"), "confidence", "min_confidence")


@query(f"SELECT label, count(*) AS n FROM fx_detection WHERE {LENGTH} >= 4 GROUP BY label", "fx_detection")
def class_counts(t):
    return t.boxes().filter(G.length_m() >= 4).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT " + ", ".join(f"count(*) FILTER (WHERE label = '{c}') AS {c}" for c in ("truck", "bus", "van", "car")) + " FROM fx_detection", "fx_detection")
def class_summary_pivot(t):
    return t.boxes().agg(*[F.count_if(F.col("label") == c).alias(c) for c in ("truck", "bus", "van", "car")])


@query(f"""SELECT det_id, {nearest(LENGTH, 100)} AS length_cm, {nearest(WIDTH, 100)} AS width_cm,
CAST(floor((CASE WHEN h < 0 THEN h + 180 WHEN h >= 180 THEN h - 180 ELSE h END) * 10 + 0.5) AS BIGINT) AS heading_dd
FROM (SELECT *, degrees(CASE WHEN {SIDE0} >= {SIDE1} THEN atan2(x1 - x0, y1 - y0) ELSE atan2(x2 - x1, y2 - y1) END) AS h FROM fx_detection)""", "fx_detection")
def measurements(t):
    """Length, width and heading from the corners."""
    return t.boxes().select("det_id", G.scaled(G.length_m(), 100).alias("length_cm"), G.scaled(G.width_m(), 100).alias("width_cm"), G.scaled(G.heading_deg(), 10).alias("heading_dd"))


@query(f"SELECT det_id FROM fx_detection WHERE {LENGTH} >= 4", "fx_detection")
def length_gate(t):
    return t.boxes().filter(G.length_m() >= 4).select("det_id")


@query("SELECT det_id, label FROM fx_detection WHERE label IN ('truck', 'bus')", "fx_detection")
def class_filter(t):
    return t.boxes().filter(F.col("label").isin("truck", "bus")).select("det_id", "label")


@query(f"SELECT det_id, CAST(floor(({CX} - 24451424) / 32) AS BIGINT) AS tile_col, CAST(floor((8388608 - {CY}) / 32) AS BIGINT) AS tile_row FROM fx_detection", "fx_detection")
def tile_of_centre(t):
    col, row = grid.tile_at(F.col("cx"), F.col("cy"), 16)
    return t.boxes().select("det_id", col.alias("tile_col"), row.alias("tile_row"))


_RANGE = "SELECT part_id, CAST(floor((min_e - 24451424) / {s}) AS BIGINT) AS c0, CAST(ceil((max_e - 24451424) / {s}) AS BIGINT) - 1 AS c1, CAST(floor((8388608 - max_n) / {s}) AS BIGINT) AS r0, CAST(ceil((8388608 - min_n) / {s}) AS BIGINT) - 1 AS r1 FROM fx_region_part"


@query(f"SELECT part_id, (greatest(c0, c1) - c0 + 1) * (greatest(r0, r1) - r0 + 1) AS n_tiles FROM ({_RANGE.format(s=32)})", "fx_region_part")
def tile_range_counts(t):
    """Tiles of each part, without listing them."""
    return t("fx_region_part").select("part_id", grid.tile_count(*[F.col(c) for c in ("min_e", "min_n", "max_e", "max_n")], 16).alias("n_tiles"))


@query(f"SELECT CAST(sum((greatest(c0, c1) - c0 + 1) * (greatest(r0, r1) - r0 + 1)) AS BIGINT) AS n_tiles FROM ({_RANGE.format(s=32)})", "fx_region_part")
def tile_estimate(t):
    return t("fx_region_part").agg(F.sum(grid.tile_count(*[F.col(c) for c in ("min_e", "min_n", "max_e", "max_n")], 16)).alias("n_tiles"))


@query(f"WITH r AS ({_RANGE.format(s=128)}) SELECT part_id, unnest(range(c0, c1 + 1)) AS tile_col, tile_row FROM (SELECT *, unnest(range(r0, r1 + 1)) AS tile_row FROM r)", "fx_region_part")
def tiles_covering_aoi(t):
    return grid.tiles(t("fx_region_part"), 14).select("part_id", "tile_col", "tile_row")


@query(f"WITH {WINDOWS_SQL} SELECT part_id, x, y FROM xs JOIN ys USING (part_id)", "fx_region_part")
def windows_covering_aoi(t):
    """Overlapping windows, the last of each axis flush with the end."""
    return grid.windows(t("fx_region_part"), 16).select("part_id", "x", "y")


@query(f"SELECT CAST(floor(CAST(trunc(({CX} - 24451424) / 0.125) AS BIGINT) / 1024) AS BIGINT) AS slot_x, CAST(floor(CAST(trunc((8388608 - {CY}) / 0.125) AS BIGINT) / 1024) AS BIGINT) AS slot_y, count(*) AS n, min(det_id) AS first_id FROM fx_detection GROUP BY ALL", "fx_detection")
def window_slots(t):
    x, y = grid.window_slot(F.col("cx"), F.col("cy"), 16)
    return t.boxes().groupBy(x.alias("slot_x"), y.alias("slot_y")).agg(F.count(F.lit(1)).alias("n"), F.min("det_id").alias("first_id"))


_IN_PART = f"{CX} > min_e AND {CX} < max_e AND {CY} > min_n AND {CY} < max_n AND ({CX} - min_e) + ({CY} - min_n) > chamfer"


@query(f"SELECT DISTINCT det_id FROM fx_detection JOIN fx_region_part ON {_IN_PART}", "fx_detection", "fx_region_part")
def region_clip(t):
    """Detections whose centre is strictly inside some part of the region."""
    return spatial.held_by_any(t.stored_boxes(), t.parts(), "det_id")


@query(f"SELECT det_id, part_id FROM fx_detection JOIN fx_region_part ON {CX} BETWEEN min_e AND max_e AND {CY} BETWEEN min_n AND max_n", "fx_detection", "fx_region_part")
def cell_envelope_filter(t):
    """Centres in closed envelopes."""
    pairs = spatial.point_candidates(t.stored_boxes().select("det_id", "cx", "cy"), t.rectangles("fx_region_part"), size=500.0)
    return pairs.select("det_id", "part_id")


@query("""WITH c AS (SELECT *, unnest(range(CAST(floor(min_n / 1000) AS BIGINT), CAST(ceil(max_n / 1000) AS BIGINT))) AS cell_row FROM (SELECT *, unnest(range(CAST(floor(min_e / 1000) AS BIGINT), CAST(ceil(max_e / 1000) AS BIGINT))) AS cell_col FROM fx_region_part))
SELECT DISTINCT cell_col, cell_row, concat('e', cell_col, 'n', cell_row) AS name FROM c WHERE (least(max_e, (cell_col + 1) * 1000) - min_e) + (least(max_n, (cell_row + 1) * 1000) - min_n) > chamfer""", "fx_region_part")
def grid_cells_over_region(t):
    """Cells of 1 km that share positive area with a part."""
    return polygons.cells_over(t.parts().select("part_id", "edges", *spatial.ENVELOPE), 1000.0)


@query(f"SELECT det_id, district FROM fx_detection LEFT JOIN (SELECT det_id, arg_min(district, part_id) AS district FROM fx_detection JOIN fx_region_part ON {_IN_PART} GROUP BY det_id) USING (det_id)", "fx_detection", "fx_region_part")
def district_join(t):
    return spatial.attach_area(t.stored_boxes(), t.parts(), "det_id", "part_id", "district").select("det_id", "district")


_GAP = f"sqrt(pow(greatest(0, min_e - {CX}, {CX} - max_e), 2) + pow(greatest(0, min_n - {CY}, {CY} - max_n), 2))"
_NEAREST = f"SELECT det_id, arg_min(kadun_nimi, (d, street_id)) AS kadun_nimi, arg_min(kayttotarkoitus, (d, street_id)) AS kayttotarkoitus FROM (SELECT det_id, street_id, kadun_nimi, kayttotarkoitus, {_GAP} AS d FROM fx_detection JOIN fx_street ON {CX} BETWEEN min_e - 2 AND max_e + 2 AND {CY} BETWEEN min_n - 2 AND max_n + 2) WHERE d <= 2 GROUP BY det_id"


@query(f"SELECT det_id, kadun_nimi, kayttotarkoitus FROM fx_detection LEFT JOIN ({_NEAREST}) USING (det_id)", "fx_detection", "fx_street")
def nearest_street(t):
    found = spatial.attach_nearest(t.stored_boxes(), t.rectangles("fx_street"), "det_id", "street_id", "kadun_nimi", "kayttotarkoitus", within=2.0)
    return found.select("det_id", "kadun_nimi", "kayttotarkoitus")


def _axis(ux: str, uy: str) -> str:
    """Whether box and rectangle overlap along one axis."""
    own = [f"({ux}) * x{k} + ({uy}) * y{k}" for k in range(4)]
    other = [f"({ux}) * {e} + ({uy}) * {n}" for e in ("min_e", "max_e") for n in ("min_n", "max_n")]
    return f"least({', '.join(own)}) <= greatest({', '.join(other)}) AND least({', '.join(other)}) <= greatest({', '.join(own)})"


_TOUCHES = " AND ".join(_axis(*a) for a in (("1", "0"), ("0", "1"), ("x1 - x0", "y1 - y0"), ("x2 - x1", "y2 - y1")))


@query(f"SELECT DISTINCT det_id FROM fx_detection JOIN fx_parking ON {_TOUCHES}", "fx_detection", "fx_parking")
def parking_overlap(t):
    """Boxes that share a point with a parking area."""
    return spatial.touched_by_any(t.stored_boxes(), t.rectangles("fx_parking"), "det_id")


_IN_BOX = f"{CX} > min_e AND {CX} < max_e AND {CY} > min_n AND {CY} < max_n"
_CONTEXT = f"""SELECT d.det_id, CASE WHEN d.det_id IN (SELECT det_id FROM fx_detection JOIN fx_parking ON {_TOUCHES}) OR d.det_id IN (SELECT det_id FROM fx_detection JOIN fx_street ON {_IN_BOX} WHERE kayttotarkoitus = 'Pysäköintialue') THEN 'parking'
WHEN d.det_id IN (SELECT det_id FROM fx_detection JOIN fx_street ON {_IN_BOX}) THEN 'street' ELSE 'other' END AS context, street_part
FROM fx_detection d LEFT JOIN (SELECT det_id, arg_min(district, part_id) AS street_part FROM fx_detection JOIN fx_region_part ON {_IN_PART} GROUP BY det_id) USING (det_id)"""


def _layers(t):
    parts = t.parts()
    return parts, t.rectangles("fx_street"), t.rectangles("fx_parking"), parts.withColumnRenamed("district", "part_name")


@query(_CONTEXT, "fx_detection", "fx_region_part", "fx_street", "fx_parking")
def context_classifier(t):
    _, streets, parking, named = _layers(t)
    return enrichment.attach_context(t.boxes(), parking, streets, named).select("det_id", "context", "street_part")


@query(f"SELECT det_id, district, kadun_nimi, kayttotarkoitus, context, street_part FROM ({_CONTEXT}) LEFT JOIN (SELECT det_id, arg_min(district, part_id) AS district FROM fx_detection JOIN fx_region_part ON {_IN_PART} GROUP BY det_id) USING (det_id) LEFT JOIN ({_NEAREST}) USING (det_id)", "fx_detection", "fx_region_part", "fx_street", "fx_parking")
def enrich(t):
    """Detections with all of their area attributes."""
    districts, streets, parking, named = _layers(t)
    return enrichment.enrich(t.boxes(), districts, streets, parking, named).select("det_id", "district", "kadun_nimi", "kayttotarkoitus", "context", "street_part")


def overlap_sql(a: str, b: str, where: str) -> str:
    """CTEs ending in ``ious (a_id, b_id, iou)`` for boxes of two relations whose envelopes overlap."""
    corners = ", ".join(f"{s}.x{k} - a.x0 AS {s}x{k}, {s}.y{k} - a.y0 AS {s}y{k}" for s in "ab" for k in range(4))
    env = " AND ".join(f"least({', '.join(f'a.{c}{k}' for k in range(4))}) <= greatest({', '.join(f'b.{c}{k}' for k in range(4))}) AND least({', '.join(f'b.{c}{k}' for k in range(4))}) <= greatest({', '.join(f'a.{c}{k}' for k in range(4))})" for c in "xy")

    def point(side: str, k: int) -> str:
        return f"{{'x': {side}x{k}, 'y': {side}y{k}}}"

    def pick(side: str, k: str) -> str:
        return f"[{', '.join(point(side, i) for i in range(4))}][{k}]"

    def area(s: str) -> str:
        return "abs(" + " + ".join(f"({s}x{k} * {s}y{(k + 1) % 4} - {s}y{k} * {s}x{(k + 1) % 4})" for k in range(4)) + ") / 2"

    return f"""pairs AS (SELECT a.det_id AS a_id, b.det_id AS b_id, {corners} FROM (SELECT *, floor({CX} / 64) AS gx FROM {a}) a JOIN (SELECT *, unnest([floor({CX} / 64) - 1, floor({CX} / 64), floor({CX} / 64) + 1]) AS gx FROM {b}) b ON a.gx = b.gx AND {where} AND {env}),
planes AS (SELECT a_id, b_id, s, k, CASE s WHEN 0 THEN {pick("a", "k")} ELSE {pick("b", "k")} END AS p, CASE s WHEN 0 THEN {pick("a", "k % 4 + 1")} ELSE {pick("b", "k % 4 + 1")} END AS p2, CASE s WHEN 0 THEN {pick("b", "j")} ELSE {pick("a", "j")} END AS q, CASE s WHEN 0 THEN {pick("b", "j % 4 + 1")} ELSE {pick("a", "j % 4 + 1")} END AS q2
  FROM pairs, (VALUES (0), (1)) AS v(s), range(1, 5) AS r(k), range(1, 5) AS o(j)),
cuts AS (SELECT a_id, b_id, s, k, p, p2, (q2.x - q.x) * (p.y - q.y) - (q2.y - q.y) * (p.x - q.x) AS c0, (q2.x - q.x) * (p2.y - p.y) - (q2.y - q.y) * (p2.x - p.x) AS c1, (q2.x - q.x) * (p2.x - p.x) + (q2.y - q.y) * (p2.y - p.y) AS along FROM planes),
shares AS (SELECT a_id, b_id, greatest(0, min(CASE WHEN c1 < 0 THEN least(1, -c0 / c1) WHEN c1 = 0 AND (c0 < 0 OR (c0 = 0 AND (s = 1 OR along <= 0))) THEN -1 ELSE 1 END) - max(CASE WHEN c1 > 0 THEN greatest(0, -c0 / c1) ELSE 0 END)) * (max(p.x) * (max(p2.y) - max(p.y)) - max(p.y) * (max(p2.x) - max(p.x))) / 2 AS part FROM cuts GROUP BY a_id, b_id, s, k),
shared AS (SELECT a_id, b_id, greatest(0, sum(part)) AS area FROM shares GROUP BY ALL),
ious AS (SELECT a_id, b_id, area / ({area("a")} + {area("b")} - area) AS iou FROM shared JOIN pairs USING (a_id, b_id))"""


_EDGES = f"""{overlap_sql("fx_detection", "fx_detection", "a.det_id < b.det_id")},
edges AS (SELECT CASE WHEN a.confidence >= b.confidence THEN a_id ELSE b_id END AS high, CASE WHEN a.confidence >= b.confidence THEN b_id ELSE a_id END AS low FROM ious JOIN fx_detection a ON a_id = a.det_id JOIN fx_detection b ON b_id = b.det_id WHERE iou > 0.4)"""


def _suppressed_sql(rounds: int = 8) -> str:
    """Rounds of the fixpoint, unrolled; the fixtures settle in far fewer."""
    out, left = [], "edges"
    for k in range(rounds):
        out.append(f"kept{k} AS (SELECT DISTINCT high AS id FROM {left} WHERE high NOT IN (SELECT low FROM {left}))")
        out.append(f"lost{k} AS (SELECT DISTINCT low AS id FROM {left} WHERE high IN (SELECT id FROM kept{k}))")
        out.append(f"left{k} AS (SELECT * FROM {left} WHERE high NOT IN (SELECT id FROM lost{k}) AND low NOT IN (SELECT id FROM lost{k}) AND high NOT IN (SELECT id FROM kept{k}))")
        left = f"left{k}"
    return ", ".join(out) + ", lost AS (" + " UNION ALL ".join(f"SELECT id FROM lost{k}" for k in range(rounds)) + ")"


def _ids(frame):
    return frame.withColumnRenamed("det_id", "id")


@query(f"WITH {_EDGES} SELECT high, low FROM edges", "fx_detection")
def nms_pairs(t):
    """Overlapping boxes, the one of higher priority first."""
    return nms.overlaps(_ids(t.stored_boxes()))


@query(f"WITH {_EDGES}, {_suppressed_sql()} SELECT det_id, label FROM fx_detection WHERE det_id NOT IN (SELECT id FROM lost)", "fx_detection")
def nms_merged(t):
    """Greedy suppression over the whole table."""
    return nms.merge(_ids(t.stored_boxes())).select(F.col("id").alias("det_id"), "label")


_CLASS_EDGES = _EDGES.replace("a.det_id < b.det_id AND", "a.det_id < b.det_id AND a.label = b.label AND")


@query(f"WITH {_CLASS_EDGES}, {_suppressed_sql()} SELECT det_id, label FROM fx_detection WHERE det_id NOT IN (SELECT id FROM lost)", "fx_detection")
def merged_within_class(t):
    """Suppression within groups, here classes; boxes of two groups never remove each other."""
    return nms.merge(_ids(t.stored_boxes()), within="label").select(F.col("id").alias("det_id"), "label")


@query(f"WITH {_EDGES}, {_suppressed_sql()} SELECT count(*) AS removed FROM fx_detection WHERE det_id IN (SELECT id FROM lost)", "fx_detection")
def nms_removed_count(t):
    return nms.suppressed(nms.overlaps(_ids(t.stored_boxes()))).agg(F.count(F.lit(1)).alias("removed"))


@query(f"WITH {_EDGES}, {_suppressed_sql()} SELECT det_id FROM fx_detection WHERE det_id NOT IN (SELECT id FROM lost) AND {LENGTH} >= 4", "fx_detection")
def sweep_merged(t):
    """Suppression before the length gate: a short confident box may remove a longer one."""
    return nms.merge(_ids(t.stored_boxes())).filter(G.length_m() >= 4).select(F.col("id").alias("det_id"))


@query(f"""WITH truth AS (SELECT * FROM fx_label WHERE status IN ('confirmed', 'added')),
{overlap_sql("fx_detection", "truth", "true")} SELECT det_id FROM fx_detection WHERE det_id NOT IN (SELECT a_id FROM ious WHERE iou > 0.3)""", "fx_label")
def unexplained_detections(t):
    """Found boxes that no verified label explains."""
    return evaluate.unexplained(_ids(t.stored_boxes()), _ids(t("fx_label"))).select(F.col("id").alias("det_id"))


@query(f"""WITH truth AS (SELECT * FROM fx_label WHERE status IN ('confirmed', 'added')), {overlap_sql("fx_detection", "truth", "true")},
best AS (SELECT a_id, arg_min(b_id, (-iou, b_id)) AS t FROM ious WHERE iou > 0.45 GROUP BY a_id), hit AS (SELECT t, arg_min(a_id, (-confidence, a_id)) AS det_id FROM best JOIN fx_detection ON a_id = det_id GROUP BY t),
steps AS (SELECT CAST(floor(confidence * 1000) AS BIGINT) AS i, count(*) AS n, count(h.det_id) AS hits FROM fx_detection d LEFT JOIN hit h USING (det_id) GROUP BY 1)
SELECT i, {nearest('sum(hits) OVER w / sum(n) OVER w', 10000)} AS p, {nearest('sum(hits) OVER w / (SELECT count(*) FROM truth)', 10000)} AS r FROM steps WINDOW w AS (ORDER BY i DESC)""", "fx_label")
def precision_recall(t):
    """Precision and recall by confidence, against verified labels."""
    truth = labels.verified(t("fx_label")).withColumnRenamed("det_id", "id")
    found = evaluate.curve(_ids(t.stored_boxes()), truth)
    return found.select("i", G.scaled(F.col("p"), 10000).alias("p"), G.scaled(F.col("r"), 10000).alias("r"))


def _series(name: str, terms: tuple[float, ...], f: str, g: str, xi: str, eta: str) -> str:
    return " + ".join(f"{a!r} * {f}({2 * j} * {xi}) * {g}({2 * j} * {eta})" for j, a in enumerate(terms, 1))


def _forward_sql(lon: str, lat: str, srid: int) -> str:
    meridian, scale, east = crs.GRIDS[srid]
    e = repr(crs.ECCENTRICITY)
    return f"""g1 AS (SELECT *, sinh(atanh(sin(radians({lat}))) - {e} * atanh({e} * sin(radians({lat})))) AS tt, radians({lon} - {meridian}) AS turn FROM g0),
g2 AS (SELECT *, atan2(tt, cos(turn)) AS xi, atanh(sin(turn) / sqrt(1 + tt * tt)) AS eta FROM g1),
g3 AS (SELECT *, {east} + {scale!r} * {crs.RADIUS!r} * (eta + {_series("e", crs.ALPHA, "cos", "sinh", "xi", "eta")}) AS east, {scale!r} * {crs.RADIUS!r} * (xi + {_series("n", crs.ALPHA, "sin", "cosh", "xi", "eta")}) AS north FROM g2)"""


@query(f"WITH g0 AS (SELECT n_nationkey AS id, 24.5 + n_nationkey * 0.05 AS lon, 60.0 + n_nationkey * 0.02 AS lat FROM nation), {_forward_sql('lon', 'lat', 3879)} SELECT id, {nearest('east', 100)} AS e_cm, {nearest('north', 100)} AS n_cm FROM g3")
def crs_forward(t):
    """WGS84 to the storage grid."""
    points = t("nation").select(F.col("n_nationkey").alias("id"), (24.5 + F.col("n_nationkey") * 0.05).alias("lon"), (60.0 + F.col("n_nationkey") * 0.02).alias("lat"))
    e, n = crs.from_wgs84(F.col("lon"), F.col("lat"), 3879)
    return points.select("id", G.scaled(e, 100).alias("e_cm"), G.scaled(n, 100).alias("n_cm"))


def _inverse_sql(srid: int) -> str:
    meridian, scale, east = crs.GRIDS[srid]
    k = repr(scale * crs.RADIUS)
    x = " - ".join(["xi", *(f"{b!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(crs.BETA, 1))])
    y = " - ".join(["eta", *(f"{b!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(crs.BETA, 1))])
    lat = " + ".join(["chi", *(f"{d!r} * sin({2 * j} * chi)" for j, d in enumerate(crs.DELTA, 1))])
    return f"""h1 AS (SELECT *, n / {k} AS xi, (e - {east}) / {k} AS eta FROM h0), h2 AS (SELECT *, {x} AS x, {y} AS y FROM h1), h3 AS (SELECT *, asin(sin(x) / cosh(y)) AS chi FROM h2),
h4 AS (SELECT *, {meridian} + degrees(atan2(sinh(y), cos(x))) AS lon, degrees({lat}) AS lat FROM h3)"""


@query(f"WITH h0 AS (SELECT det_id AS id, {CX} AS e, {CY} AS n FROM fx_detection), {_inverse_sql(3879)} SELECT id, {nearest('lon', 1000000)} AS lon_u, {nearest('lat', 1000000)} AS lat_u FROM h4", "fx_detection")
def crs_inverse(t):
    """The storage grid to WGS84."""
    lon, lat = crs.to_wgs84(F.col("cx"), F.col("cy"), 3879)
    return t.boxes().select(F.col("det_id").alias("id"), G.scaled(lon, 1000000).alias("lon_u"), G.scaled(lat, 1000000).alias("lat_u"))


@query(f"""SELECT p.part_id, count(DISTINCT street_id) AS roads FROM fx_region_part p JOIN fx_street s ON s.min_n <= p.max_n AND s.min_n >= p.min_n AND s.min_e <= p.max_e AND s.max_e >= p.min_e AND (s.max_e - p.min_e) + (s.min_n - p.min_n) >= p.chamfer GROUP BY p.part_id HAVING count(DISTINCT street_id) >= 1""", "fx_region_part", "fx_street")
def road_count_region(t):
    """Road centrelines (southern edges of streets) that meet each part; parts without any are left out."""
    roads = t("fx_street").select("street_id", *[F.col(c).alias(f"s_{c}") for c in ("min_e", "min_n", "max_e")])
    line = G.edges_of(G.ring((F.col("s_min_e"), F.col("s_min_n")), (F.col("s_max_e"), F.col("s_min_n"))))
    dealt = spatial.by_bucket(roads.withColumn("line", line), (F.col("s_min_e"), F.col("s_min_n"), F.col("s_max_e"), F.col("s_min_n")), 500.0)
    near = dealt.join(spatial.by_bucket(t.parts(), spatial.area_envelope(), 500.0), ["bx", "by"]).filter(G.crosses_line(F.col("line"), F.col("edges")))
    return near.select("part_id", "street_id").distinct().groupBy("part_id").agg(F.count(F.lit(1)).alias("roads"))


@query("""SELECT a.part_id AS a_id, b.part_id AS b_id, CAST(floor((least(a.max_e, b.max_e + 1000) - greatest(a.min_e, b.min_e - 1000)) * (least(a.max_n, b.max_n + 1000) - greatest(a.min_n, b.min_n - 1000)) + 0.5) AS BIGINT) AS area_m2
FROM fx_region_part a JOIN fx_region_part b ON a.part_id < b.part_id WHERE least(a.max_e, b.max_e + 1000) > greatest(a.min_e, b.min_e - 1000) AND least(a.max_n, b.max_n + 1000) > greatest(a.min_n, b.min_n - 1000)""", "fx_region_part")
def aoi_overlaps(t):
    """Areas whose envelopes, one of them widened by a kilometre, share positive area."""
    return polygons.overlaps(t("fx_region_part"), "part_id", margin=1000.0).withColumn("area_m2", G.scaled(F.col("area_m2"), 1))


#: Squares of 50 m that the districts are made of, and the cells of 300 m they lie in.
_SQUARES = """sq AS (SELECT district_id, part, CAST(e0 / 50 AS BIGINT) + x AS gx, CAST(n0 / 50 AS BIGINT) + y AS gy FROM fx_district, (SELECT 0 AS part, x, y FROM range(36) AS a(x), range(26) AS b(y) WHERE NOT (x >= 24 AND y >= 16) AND NOT (x BETWEEN 8 AND 13 AND y BETWEEN 6 AND 9)
UNION ALL SELECT 1, x, y FROM range(28, 34) AS a(x), range(19, 25) AS b(y)))"""


def _district_parts(t):
    return polygons.explode_parts(t.districts())


@query(f"WITH {_SQUARES} SELECT district_id, part, count(*) * 2500 AS area_m2 FROM sq GROUP BY ALL", "fx_district")
def district_parts(t):
    """Polygons of the districts' multipolygons with their areas, holes taken off."""
    return _district_parts(t).select("district_id", "part", G.scaled(F.col("area_m2"), 1).alias("area_m2"))


@query(f"WITH {_SQUARES} SELECT district_id, part, gx // 6 AS cell_col, gy // 6 AS cell_row, count(*) * 2500 AS shared_m2 FROM sq GROUP BY ALL", "fx_district")
def district_cell_area(t):
    """What each part shares with cells of 300 m."""
    return polygons.by_cell(_district_parts(t), 300.0).select("district_id", "part", "cell_col", "cell_row", G.scaled(F.col("shared_m2"), 1).alias("shared_m2"))


@query(f"WITH {_SQUARES} SELECT DISTINCT gx // 6 AS cell_col, gy // 6 AS cell_row, concat('e', gx // 6, 'n', gy // 6) AS name FROM sq", "fx_district")
def district_cells(t):
    return polygons.cells_over(_district_parts(t), 300.0)


@query(f"WITH {_SQUARES} SELECT gx // 6 AS cell_col, gy // 6 AS cell_row, {nearest('count(DISTINCT (gx, gy)) / 36', 10000)} AS coverage FROM sq GROUP BY ALL", "fx_district")
def district_coverage(t):
    """The share of each cell that the union of the overlapping districts covers."""
    return polygons.coverage(_district_parts(t), 300.0).select("cell_col", "cell_row", G.scaled(F.col("coverage"), 10000).alias("coverage"))


@query(f"WITH {_SQUARES} SELECT count(DISTINCT (gx, gy)) * 2500 AS area_m2 FROM sq", "fx_district")
def district_union_area(t):
    return polygons.union_area(_district_parts(t)).select(G.scaled(F.col("area_m2"), 1).alias("area_m2"))


_ROAD_PARTS = """met AS (SELECT district_id, 0 AS part, street_id FROM fx_district JOIN fx_street ON min_n BETWEEN n0 AND n0 + 1300 AND max_e >= e0 AND min_e <= e0 + CASE WHEN min_n <= n0 + 800 THEN 1800 ELSE 1200 END
UNION ALL SELECT district_id, 1, street_id FROM fx_district JOIN fx_street ON min_n BETWEEN n0 + 950 AND n0 + 1250 AND max_e >= e0 + 1400 AND min_e <= e0 + 1700),
held AS (SELECT district_id, part, count(DISTINCT street_id) AS roads FROM met GROUP BY ALL)"""


def _road_parts(t):
    line = G.edges_of(G.ring((F.col("min_e"), F.col("min_n")), (F.col("max_e"), F.col("min_n"))))
    roads = t("fx_street").select(F.col("street_id").alias("road_id"), line.alias("line"))
    parts = _district_parts(t).withColumn("key", F.struct("district_id", "part"))
    return parts, polygons.with_roads(parts, roads, "key")


@query(f"WITH {_ROAD_PARTS} SELECT district_id, part, roads FROM held", "fx_district", "fx_street")
def district_roads(t):
    """Parts of districts that a road meets, with how many do."""
    return _road_parts(t)[1].select("district_id", "part", "roads")


@query(f"WITH {_ROAD_PARTS}, {_SQUARES}, sizes AS (SELECT district_id, part, count(*) * 2500 AS m2 FROM sq GROUP BY ALL) SELECT count(roads) AS kept, count(*) - count(roads) AS dropped, CAST(sum(CASE WHEN roads > 0 THEN m2 ELSE 0 END) * 1000 // sum(m2) AS BIGINT) AS permille FROM sizes LEFT JOIN held USING (district_id, part)", "fx_district", "fx_street")
def district_kept_share(t):
    """How much of the districts' area the parts with a road make."""
    parts, kept = _road_parts(t)
    return polygons.kept_share(kept, parts).select("kept", "dropped", "permille")


@query(f"WITH {_SQUARES}, held AS (SELECT DISTINCT gx // 5 AS cell_col, gy // 5 AS cell_row FROM sq), b AS (SELECT {CX} AS x, {CY} AS y FROM fx_detection WHERE label = 'truck' AND confidence >= {CENSUS}) "
       "SELECT CAST(floor(x / 250) AS BIGINT) AS cell_col, CAST(floor(y / 250) AS BIGINT) AS cell_row, count(*) AS n FROM b JOIN held ON floor(x / 250) = cell_col AND floor(y / 250) = cell_row WHERE x / 250 <> floor(x / 250) AND y / 250 <> floor(y / 250) GROUP BY ALL", "fx_detection", "fx_district")  # fmt: skip
def district_truck_grid(t):
    """Trucks by cell of 250 m of those over the districts."""
    return density.by_cell(density.counted(t.boxes()), cells=polygons.cells_over(_district_parts(t), 250.0))


@query("SELECT year, count(*) AS n FROM (SELECT det_id, 2019 + det_id % 5 AS year FROM fx_detection) WHERE year <> 2022 GROUP BY year", "fx_detection")
def package_year_counts(t):
    """Rows by year of the layers that exist."""
    return t.boxes().withColumn("year", 2019 + F.col("det_id") % 5).filter(F.col("year") != 2022).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
