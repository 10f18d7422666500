"""Queries over labels, evaluation, mining and the work log."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.functions import grid
from gridsight.operators import detect, edits, evaluate, labels, manifest, mining, polygons
from gridsight.operators.spatial import ENVELOPE
from gridsight.plans.registry import CX, CY, LENGTH, WINDOWS_SQL, nearest, query

_OPERATING = 0.77


@query("SELECT class, count(*) AS n FROM fx_label WHERE status IN ('confirmed', 'added') GROUP BY class", "fx_label")
def ground_truth_counts(t):
    return labels.truth_counts(t("fx_label"))


@query("SELECT 'status' AS kind, status AS name, count(*) AS n FROM fx_label GROUP BY status UNION ALL SELECT 'class', class, count(*) FROM fx_label WHERE class <> '' GROUP BY class", "fx_label")
def label_summary(t):
    return labels.summary(t("fx_label"))


@query("SELECT aoi, count(*) AS total, count(*) FILTER (WHERE status IS DISTINCT FROM 'candidate') AS reviewed FROM fx_label GROUP BY aoi", "fx_label")
def reviewed(t):
    return labels.reviewed(t("fx_label"), "aoi")


@query("SELECT aoi, count(*) AS total, count(*) FILTER (WHERE status <> 'candidate') AS reviewed, count(*) FILTER (WHERE status = 'rejected') AS rejected, count(*) FILTER (WHERE status = 'added') AS added, " + ", ".join(f"count(*) FILTER (WHERE class = '{c}' AND status <> 'rejected') AS n_{c}" for c in labels.CLASSES) + " FROM fx_label GROUP BY aoi", "fx_label")
def editor_recount(t):
    return labels.recount(t("fx_label"), "aoi")


@query("SELECT *, CASE WHEN confirmed + rejected = 0 THEN -1 ELSE rejected * 1000 // (confirmed + rejected) END AS rate FROM (SELECT aoi, count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in labels.STATUSES) + " FROM fx_label GROUP BY aoi)", "fx_label")
def progress_report(t):
    return labels.progress(t("fx_label"))


@query("""WITH l AS (SELECT det_id, CASE WHEN det_id % 50 = 0 THEN 'odd' WHEN det_id % 51 = 0 THEN NULL ELSE status END AS status, CASE WHEN det_id % 53 = 0 THEN 'tram' WHEN det_id % 59 = 0 THEN '' ELSE class END AS class, det_id % 61 = 0 AS skewed, det_id % 67 = 0 AS missing, det_id % 71 = 0 AS short FROM fx_label)
SELECT det_id, concat('status ', coalesce(status, 'none')) AS problem FROM l WHERE status IS NULL OR status NOT IN ('candidate', 'confirmed', 'rejected', 'added')
UNION ALL SELECT det_id, concat('class ', class) FROM l WHERE class <> '' AND class NOT IN ('truck', 'bus', 'van', 'car')
UNION ALL SELECT det_id, concat(status, ' without class') FROM l WHERE status IN ('confirmed', 'added') AND class = ''
UNION ALL SELECT det_id, CASE WHEN missing THEN 'no ring' WHEN short THEN 'positions 4' ELSE 'not a rectangle' END FROM l WHERE missing OR short OR skewed""", "fx_label")
def label_problems(t):
    """Defects of labels, some put in: odd or missing status, odd or empty class, bad rings."""
    i = F.col("det_id")
    c = [F.col(n) for n in G.CORNERS]
    moved = F.when(i % 61 == 0, c[0] + 5).otherwise(c[0])
    closed = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((moved, c[1]), (c[2], c[3]), (c[4], c[5]), (c[6], c[7]), (moved, c[1]))])
    ring = F.when(i % 67 == 0, F.lit(None)).when(i % 71 == 0, F.slice(closed, 1, 4)).otherwise(closed)
    status = F.when(i % 50 == 0, "odd").when(i % 51 == 0, F.lit(None)).otherwise(F.col("status"))
    name = F.when(i % 53 == 0, "tram").when(i % 59 == 0, "").otherwise(F.col("class"))
    return labels.problems(t("fx_label").select("det_id", status.alias("status"), name.alias("class"), ring.alias("ring")), "det_id")


@query(f"SELECT det_id, {nearest('greatest(min_e - cx, cx - max_e, min_n - cy, cy - max_n)', 1)} AS distance_m FROM fx_label JOIN fx_region_part ON part_id = det_id % 25 WHERE NOT (cx BETWEEN min_e AND max_e AND cy BETWEEN min_n AND max_n)", "fx_label", "fx_region_part")
def displaced_labels(t):
    pairs = t("fx_label").join(t("fx_region_part"), F.col("part_id") == F.col("det_id") % 25)
    return labels.displaced(pairs).select("det_id", "distance_m")


@query("SELECT aoi, status, class, count(*) AS n FROM (SELECT CASE WHEN det_id % 30 < 25 THEN concat('aoi_', det_id % 30) ELSE 'unknown' END AS aoi, 'candidate' AS status, '' AS class FROM fx_detection) GROUP BY ALL", "fx_detection")
def staged_partitions(t):
    area = F.when(F.col("det_id") % 30 < 25, F.concat(F.lit("aoi_"), (F.col("det_id") % 30).cast("string")))
    return labels.stage(t.boxes().withColumn("aoi", area)).groupBy("aoi", "status", "class").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {WINDOWS_SQL}, w AS (SELECT part_id, x, y FROM xs JOIN ys USING (part_id)),
placed AS (SELECT det_id, x, y, class, {', '.join(f'((x{k} - 24451424) / 0.125 - x) / 1024 AS u{k}, ((8388608 - y{k}) / 0.125 - y) / 1024 AS v{k}' for k in range(4))} FROM fx_label JOIN w ON part_id = det_id % 25 WHERE status IN ('confirmed', 'added') AND class <> '')
SELECT det_id, x, y, CASE class WHEN 'truck' THEN 0 WHEN 'bus' THEN 1 WHEN 'van' THEN 2 ELSE 3 END AS class_index, {nearest('u0', 1000000)} AS u0, {nearest('v2', 1000000)} AS v2 FROM placed WHERE {' AND '.join(f'{a}{k} BETWEEN 0 AND 1' for a in 'uv' for k in range(4))}""", "fx_label", "fx_region_part")
def yolo_lines(t):
    """Verified labels in the windows that cover their area."""
    windows = grid.windows(t("fx_region_part"), 16).select(F.col("part_id").alias("aoi"), "x", "y")
    boxes = labels.verified(t("fx_label")).withColumn("aoi", F.col("det_id") % 25)
    held = labels.yolo_boxes(windows, boxes, size_px=1024, metres_px=0.125, origin_e=24451424.0, origin_n=8388608.0)
    return held.select("det_id", "x", "y", labels.class_index(F.col("class")).alias("class_index"), G.scaled(F.col("u0"), 1000000).alias("u0"), G.scaled(F.col("v2"), 1000000).alias("v2"))


_AREA_COUNTS = """areas AS (SELECT concat('aoi_', i) AS aoi FROM range(30) AS r(i)), truths AS (SELECT aoi, count(*) AS n FROM fx_label WHERE status IN ('confirmed', 'added') GROUP BY aoi),
finds AS (SELECT concat('aoi_', det_id % 25) AS aoi, count(*) AS n FROM fx_detection WHERE confidence >= 0.25 GROUP BY 1),
counted AS (SELECT aoi, coalesce(t.n, 0) AS truth, coalesce(f.n, 0) AS found FROM areas LEFT JOIN truths t USING (aoi) LEFT JOIN finds f USING (aoi)),
gated AS (SELECT *, CASE WHEN truth >= 60 THEN abs(found - truth) / truth <= 0.1 END AS passed FROM counted)"""


def _area_counts(t):
    areas = t.spark.range(30).select(F.concat(F.lit("aoi_"), F.col("id").cast("string")).alias("aoi"))
    truth = labels.verified(t("fx_label")).groupBy("aoi").agg(F.count(F.lit(1)).alias("n"))
    found = t("fx_detection").filter(F.col("confidence") >= 0.25).groupBy(F.concat(F.lit("aoi_"), (F.col("det_id") % 25).cast("string")).alias("aoi")).agg(F.count(F.lit(1)).alias("n"))
    return evaluate.area_counts(areas, truth, found)


@query(f"WITH {_AREA_COUNTS} SELECT aoi, truth, found, passed FROM gated", "fx_label")
def count_gates(t):
    """What was found in each area against its truth; null where there is too little truth, or none."""
    return _area_counts(t)


@query("""WITH c AS (SELECT i, i / 40.0::DOUBLE AS px, p0 AS p, 1 - i / 50.0::DOUBLE AS r FROM fx_pr_curve), u AS (SELECT * FROM c WHERE px >= 0.05)
SELECT i FROM u ORDER BY CASE WHEN r >= 0.9 THEN 0 ELSE 1 END, CASE WHEN r >= 0.9 THEN -p WHEN p + r = 0 THEN 0 ELSE -2 * p * r / (p + r) END, i LIMIT 1""", "fx_pr_curve")
def operating_point(t):
    return evaluate.operating_point(_curve(t)).select("i")


def _curve(t):
    return t("fx_pr_curve").select("i", (F.col("i") / F.lit(40.0)).alias("px"), F.col("p0").alias("p"), (1 - F.col("i") / F.lit(50.0)).alias("r"))


_GATES = f"""{_AREA_COUNTS}, curve AS (SELECT i, i / 40.0::DOUBLE AS px, p0 AS p, 1 - i / 50.0::DOUBLE AS r FROM fx_pr_curve),
chosen AS (SELECT p, r FROM curve WHERE px >= 0.05 ORDER BY CASE WHEN r >= 0.9 THEN 0 ELSE 1 END, CASE WHEN r >= 0.9 THEN -p WHEN p + r = 0 THEN 0 ELSE -2 * p * r / (p + r) END, i LIMIT 1),
gates AS (SELECT 'recall' AS gate, r >= 0.9 AS passed FROM chosen UNION ALL SELECT 'precision', p >= 0.85 FROM chosen UNION ALL SELECT concat('count ', aoi), passed FROM gated)"""


@query(f"WITH {_GATES} SELECT gate, passed FROM gates", "fx_label", "fx_pr_curve")
def gates(t):
    """Everything a model has to pass, and what is only reported."""
    return evaluate.gates(evaluate.operating_point(_curve(t)), _area_counts(t)).select("gate", "passed")


@query(f"WITH {_GATES} SELECT count(*) FILTER (WHERE NOT passed) = 0 AND count(passed) > 0 AS passed, count(*) FILTER (WHERE NOT passed) AS failed, count(*) FILTER (WHERE passed IS NULL) AS reported FROM gates", "fx_label", "fx_pr_curve")
def verdict(t):
    return evaluate.verdict(evaluate.gates(evaluate.operating_point(_curve(t)), _area_counts(t)))


_SHARE = "sum((least(max_e, (col + 1) * 300) - greatest(min_e, col * 300)) * (least(max_n, (row + 1) * 300) - greatest(min_n, row * 300))) / 90000"
_COVER = f"""cover AS (SELECT col, row, {_SHARE} AS share FROM (SELECT *, unnest(range(CAST(floor(min_n / 300) AS BIGINT), CAST(ceil(max_n / 300) AS BIGINT))) AS row FROM (SELECT *, unnest(range(CAST(floor(min_e / 300) AS BIGINT), CAST(ceil(max_e / 300) AS BIGINT))) AS col FROM fx_region_part)) GROUP BY col, row)"""
_CELLS = f"""{_COVER}, boxed AS (SELECT CAST(floor({CX} / 300) AS BIGINT) AS col, CAST(floor({CY} / 300) AS BIGINT) AS row, confidence AS c, {LENGTH} AS l FROM fx_detection),
mine AS (SELECT col, row, concat('mine-', col, '-', row) AS name, coalesce({nearest('share', 10000)}, 0) AS coverage FROM (SELECT col, row FROM boxed UNION SELECT col, row FROM cover) LEFT JOIN cover USING (col, row)),
found AS (SELECT col, row, count(*) AS n, count(*) FILTER (WHERE c BETWEEN {_OPERATING - 0.1!r} AND {_OPERATING + 0.1!r}) AS n_near, count(*) FILTER (WHERE l BETWEEN 4 AND 8) AS n_size, avg(c) AS mean_c, max(c) AS top_c FROM boxed GROUP BY col, row),
sig AS (SELECT col, row, name, coverage, coalesce(n, 0) AS n, coalesce(n_near, 0) AS n_near, coalesce(n_size, 0) AS n_size, coalesce(mean_c, 0) AS mean_c, coalesce(top_c, 0) AS top_c FROM mine LEFT JOIN found USING (col, row)),
strat AS (SELECT *, CASE WHEN n = 0 THEN 'quiet' WHEN n_near > 0 THEN 'near_threshold' WHEN n_size > 0 THEN 'size_boundary' WHEN n >= 5 THEN 'dense' ELSE 'quiet' END AS stratum FROM sig),
grade AS (SELECT *, CASE stratum WHEN 'near_threshold' THEN n_near WHEN 'size_boundary' THEN n_size WHEN 'dense' THEN n ELSE coverage END AS signal, {nearest('mean_c', 10000)} AS mean_s, col * 300 + 150.0 AS e, row * 300 + 150.0 AS nn FROM strat WHERE n <= 80)"""


def _covered(t):
    return polygons.coverage(t.rectangles("fx_region_part"), mining.CELL_M)


def _mining_cells(t):
    """Signals of all detections in their cells and in those of the parts, where quiet cells are; with the share that parts cover."""
    boxes = t.boxes().withColumn("length_m", G.length_m()).withColumn("col", F.floor(F.col("cx") / 300).cast("long")).withColumn("row", F.floor(F.col("cy") / 300).cast("long"))
    covered = _covered(t).select(F.col("cell_col").alias("col"), F.col("cell_row").alias("row"), G.scaled(F.col("coverage"), 10000).alias("coverage"))
    cells = boxes.select("col", "row").union(covered.select("col", "row")).distinct().join(covered, ["col", "row"], "left").fillna(0, ["coverage"])
    name = F.concat(F.lit("mine-"), F.col("col").cast("string"), F.lit("-"), F.col("row").cast("string"))
    cells, boxes = (x.withColumn("name", name) for x in (cells, boxes))
    return mining.signals(cells, boxes, "name", operating=_OPERATING)


@query(f"WITH {_CELLS} SELECT name, n, n_near, n_size, {nearest('mean_c', 10000)} AS mean_c, {nearest('top_c', 10000)} AS top_c FROM sig", "fx_detection", "fx_region_part")
def cell_signals(t):
    return _mining_cells(t).select("name", "n", "n_near", "n_size", G.scaled(F.col("mean_confidence"), 10000).alias("mean_c"), G.scaled(F.col("top_confidence"), 10000).alias("top_c"))


@query(f"WITH {_CELLS} SELECT stratum, count(*) AS cells FROM strat GROUP BY stratum", "fx_detection", "fx_region_part")
def strata(t):
    return _mining_cells(t).withColumn("stratum", mining.stratum()).groupBy("stratum").agg(F.count(F.lit(1)).alias("cells"))


def _gradable(t):
    # Means are rounded, so that places do not hang on the order in which doubles are summed.
    centres = {"e": F.col("col") * 300 + 150.0, "n_": F.col("row") * 300 + 150.0}
    return _mining_cells(t).withColumns({"mean_confidence": G.scaled(F.col("mean_confidence"), 10000)} | centres)


@query(f"WITH {_CELLS} SELECT name, stratum, row_number() OVER (PARTITION BY stratum ORDER BY signal DESC, mean_s DESC, name DESC) AS place FROM grade", "fx_detection", "fx_region_part")
def ranked_strata(t):
    return mining.ranked(_gradable(t)).select("name", "stratum", "place")


@query("""WITH s(stratum, share, ord) AS (VALUES ('near_threshold', 40, 0), ('size_boundary', 25, 1), ('dense', 20, 2), ('quiet', 15, 3)), c AS (SELECT unnest([4, 7, 12, 13]) AS wanted),
f AS (SELECT wanted, stratum, ord, wanted * share // 100 AS base, wanted * share % 100 AS rest FROM s, c), g AS (SELECT *, row_number() OVER (PARTITION BY wanted ORDER BY rest DESC, ord) AS k, wanted - sum(base) OVER (PARTITION BY wanted) AS left_over FROM f)
SELECT wanted, stratum, CAST(base + CASE WHEN k <= left_over THEN 1 ELSE 0 END AS BIGINT) AS slots FROM g""")
def quota_slots(t):
    counts = t.spark.range(1).select(F.explode(F.array(*map(F.lit, (4, 7, 12, 13)))).alias("wanted"))
    return mining.quota_table(counts)


@query(f"""WITH {_CELLS} SELECT name, CASE stratum WHEN 'near_threshold' THEN concat(n_near, ' detections about the operating confidence: look for missed vehicles in the whole cell.') WHEN 'size_boundary' THEN concat(n_size, ' detections of 4 to 8 m: truck or van is to be told with care.')
WHEN 'dense' THEN concat(n, ' detections close together: look for missed vehicles between them.') ELSE 'Few detections on land of the right use: look for misses, or keep it as a hard negative if it is empty.' END AS notes FROM grade""", "fx_detection", "fx_region_part")
def proposal_notes(t):
    return mining.graded(_gradable(t)).select("name", mining.notes().alias("notes"))


@query(f"""WITH RECURSIVE {_CELLS}, places AS (SELECT name, stratum, e, nn, row_number() OVER (ORDER BY signal DESC, mean_s DESC, name DESC) AS place FROM grade),
turns(stratum, turn, upto) AS (VALUES ('near_threshold', 0, 5), ('size_boundary', 1, 8), ('dense', 2, 10), ('quiet', 3, 12)),
entries AS (SELECT p.*, turn, upto FROM places p JOIN turns USING (stratum) UNION ALL SELECT *, 4, 12 FROM places),
picks AS (SELECT 0 AS pick, 0 AS turn, NULL::VARCHAR AS name, NULL::VARCHAR AS stratum, CAST([] AS STRUCT(e DOUBLE, nn DOUBLE)[]) AS held
UNION ALL SELECT pick + 1, next.turn, next.name, next.stratum, list_append(held, {{'e': next.e, 'nn': next.nn}}) FROM (
  SELECT pick, held, arg_min({{'turn': c.turn, 'name': c.name, 'stratum': c.stratum, 'e': c.e, 'nn': c.nn}}, (c.turn, place)) AS next FROM picks k JOIN entries c ON c.turn >= k.turn AND k.pick < c.upto
  WHERE len(list_filter(held, lambda h: (h.e - c.e) * (h.e - c.e) + (h.nn - c.nn) * (h.nn - c.nn) < 360000)) = 0 GROUP BY pick, held))
SELECT CAST(pick AS BIGINT) AS pick, name, stratum FROM picks WHERE pick > 0""", "fx_detection", "fx_region_part")
def proposals(t):
    """Twelve spaced cells by quota."""
    return mining.proposals(mining.graded(_gradable(t)), 12)


@query(f"""WITH RECURSIVE {_CELLS}, spots AS (SELECT name, col, row, coverage, col * 300 + 150.0 AS e, row * 300 + 150.0 AS nn, row_number() OVER (ORDER BY col, row) AS place FROM sig),
picks AS (SELECT 1 AS pick, name, [{{'e': e, 'nn': nn, 'place': place}}] AS held FROM spots WHERE place = 1
UNION ALL SELECT pick + 1, next.name, list_append(held, {{'e': next.e, 'nn': next.nn, 'place': next.place}}) FROM (
  SELECT pick, held, arg_min({{'name': c.name, 'e': c.e, 'nn': c.nn, 'place': c.place}}, (-list_min(list_transform(held, lambda h: sqrt((c.e - h.e) * (c.e - h.e) + (c.nn - h.nn) * (c.nn - h.nn)))), -coverage, c.place)) AS next
  FROM picks JOIN spots c ON pick < 8 WHERE len(list_filter(held, lambda h: h.place = c.place)) = 0 GROUP BY pick, held))
SELECT CAST(pick AS BIGINT) AS pick, name FROM picks""", "fx_detection", "fx_region_part")
def dispersed_pool(t):
    """Eight cells, each as far as can be from those before."""
    return mining.dispersed(_gradable(t), 8)


@query(f"WITH {_COVER} SELECT col AS cell_col, row AS cell_row, {nearest('share', 10000)} AS coverage FROM cover WHERE share >= 0.15", "fx_region_part")
def coverage_cells(t):
    """Cells of 300 m of which parts cover enough."""
    return _covered(t).filter(F.col("coverage") >= mining.MIN_COVERAGE).select("cell_col", "cell_row", G.scaled(F.col("coverage"), 10000).alias("coverage"))


@query(f"""WITH {_COVER} SELECT col AS cell_col, row AS cell_row FROM cover WHERE share >= 0.15 AND NOT EXISTS (SELECT 1 FROM fx_street p WHERE sqrt(pow(greatest(0, col * 300 - p.max_e, p.min_e - (col + 1) * 300), 2) + pow(greatest(0, row * 300 - p.max_n, p.min_n - (row + 1) * 300), 2)) <= 50)""", "fx_region_part", "fx_street")
def exclusion(t):
    """Covered cells away from all streets, which stand for the areas labelled already."""
    cells = _covered(t).filter(F.col("coverage") >= mining.MIN_COVERAGE)
    existing = t.rectangles("fx_street").select(*ENVELOPE)
    return mining.exclude_near(cells, existing).select("cell_col", "cell_row")


@query("SELECT cell, arg_max(status, seq) AS status, max(seq) AS seq FROM fx_manifest GROUP BY cell", "fx_manifest")
def manifest_latest(t):
    return manifest.latest(t("fx_manifest"))


@query("WITH s AS (SELECT cell, arg_max(status, seq) AS status FROM fx_manifest GROUP BY cell) SELECT cell FROM (SELECT concat('e', a, 'n', b) AS cell FROM range(25488, 25500) AS x(a), range(6668, 6678) AS y(b)) WHERE cell NOT IN (SELECT cell FROM s WHERE status IN ('done', 'failed'))", "fx_manifest")
def resume_todo(t):
    every = t.spark.range(25488, 25500).select(F.col("id").alias("a"), F.explode(F.sequence(F.lit(6668), F.lit(6677))).alias("b"))
    cells = every.select(F.concat(F.lit("e"), F.col("a").cast("string"), F.lit("n"), F.col("b").cast("string")).alias("cell"))
    return manifest.to_do(cells, manifest.latest(t("fx_manifest")))


_SWEEP = "SELECT *, row_number() OVER (PARTITION BY aoi ORDER BY floor(cy / 100 + 0.5) DESC, cx, det_id) AS place FROM fx_label"


@query(f"SELECT det_id, aoi, place, count(*) OVER (PARTITION BY aoi) AS total FROM ({_SWEEP})", "fx_label")
def review_order(t):
    """Place and number of boxes of an area: what an editor shows as one of so many."""
    return labels.review_order(t("fx_label")).select("det_id", "aoi", "place", "total")


@query(f"""SELECT det_id, coalesce(lead(det_id) OVER w, first(det_id) OVER w) AS next_id, coalesce(lag(det_id) OVER w, first(det_id) OVER (PARTITION BY aoi ORDER BY place DESC)) AS previous_id FROM ({_SWEEP}) WHERE status = 'candidate' WINDOW w AS (PARTITION BY aoi ORDER BY place)""", "fx_label")
def next_candidate(t):
    return labels.next_candidate(t("fx_label")).select("det_id", "next_id", "previous_id")


@query("""WITH f AS (SELECT *, CASE WHEN lag(box) OVER w IS NULL OR lag(box) OVER w <> box OR at_ms - lag(at_ms) OVER w >= 700 THEN 1 ELSE 0 END AS fresh FROM fx_edit WINDOW w AS (PARTITION BY session ORDER BY seq)), r AS (SELECT *, sum(fresh) OVER (PARTITION BY session ORDER BY seq) AS run FROM f)
SELECT session, min(seq) AS seq, max(box) AS box, count(*) AS edits, max(at_ms) AS at_ms FROM r GROUP BY session, run""", "fx_edit")
def undo_entries(t):
    return labels.coalesced_edits(t("fx_edit")).drop("run")


_ROLES = "SELECT n_name AS name, CASE n_nationkey % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'hard-negative' ELSE 'background' END AS role, CASE WHEN n_nationkey % 4 = 0 AND n_nationkey % 3 <> 2 THEN 'validation' ELSE 'train' END AS split FROM nation"


def _areas(t):
    k = F.col("n_nationkey")
    role = F.when(k % 3 == 0, "positive").when(k % 3 == 1, "hard-negative").otherwise("background")
    return t("nation").select(F.col("n_name").alias("name"), role.alias("role"), F.when((k % 4 == 0) & (k % 3 != 2), "validation").otherwise("train").alias("split"))


@query(f"SELECT coalesce(split, '*') AS split, coalesce(role, '*') AS role, count(*) AS n FROM ({_ROLES}) GROUP BY ROLLUP (split, role)")
def role_split_report(t):
    return labels.role_report(_areas(t))


@query(f"SELECT DISTINCT role FROM ({_ROLES}) WHERE role NOT IN (SELECT role FROM ({_ROLES}) WHERE split = 'validation')")
def roles_without_validation(t):
    return labels.unvalidated_roles(_areas(t))


@query("SELECT area, coalesce(total, 0) AS total, total IS NOT NULL AS staged FROM (SELECT concat('aoi_', i) AS area FROM range(30) AS r(i)) LEFT JOIN (SELECT aoi, count(*) AS total FROM fx_label GROUP BY aoi) ON aoi = area", "fx_label")
def area_listing(t):
    """Areas with their counts; those without labels are not staged."""
    areas = t.spark.range(30).select(F.concat(F.lit("aoi_"), F.col("id").cast("string")).alias("aoi"))
    return labels.listing(areas, t("fx_label")).select(F.col("aoi").alias("area"), "total", "staged")


@query("""WITH areas AS (SELECT concat('aoi_', i) AS aoi, CASE WHEN i % 4 = 0 THEN 'validation' ELSE 'train' END AS split FROM range(30) AS r(i)),
counts AS (SELECT aoi, count(*) AS total, count(*) FILTER (WHERE status <> 'candidate') AS reviewed FROM fx_label GROUP BY aoi), held AS (SELECT CASE WHEN total IS NULL THEN 'not staged' ELSE split END AS bucket, total, reviewed FROM areas LEFT JOIN counts USING (aoi))
SELECT coalesce(bucket, 'all') AS bucket, count(*) AS areas, coalesce(sum(total), 0)::BIGINT AS total, coalesce(sum(reviewed), 0)::BIGINT AS reviewed FROM held GROUP BY ROLLUP (bucket)""", "fx_label")
def folder_tallies(t):
    """Areas and their boxes by split, those not staged apart, and all together."""
    areas = t.spark.range(30).select(F.concat(F.lit("aoi_"), F.col("id").cast("string")).alias("aoi"), F.when(F.col("id") % 4 == 0, "validation").otherwise("train").alias("split"))
    return labels.folder_tallies(areas.join(labels.reviewed(t("fx_label"), "aoi"), "aoi", "left"))


@query(f"""WITH {WINDOWS_SQL}, w AS (SELECT part_id, x, y, CASE WHEN part_id % 4 = 0 THEN 'validation' ELSE 'train' END AS split FROM xs JOIN ys USING (part_id)),
placed AS (SELECT part_id, x, y, {', '.join(f'((x{k} - 24451424) / 0.125 - x) / 1024 AS u{k}, ((8388608 - y{k}) / 0.125 - y) / 1024 AS v{k}' for k in range(4))} FROM fx_label JOIN w ON part_id = det_id % 25 WHERE status IN ('confirmed', 'added') AND class <> ''),
held AS (SELECT part_id, x, y, count(*) AS n FROM placed WHERE {' AND '.join(f'{a}{k} BETWEEN 0 AND 1' for a in 'uv' for k in range(4))} GROUP BY ALL)
SELECT split, count(*) AS windows, coalesce(sum(n), 0)::BIGINT AS boxes FROM w LEFT JOIN held USING (part_id, x, y) GROUP BY split""", "fx_label", "fx_region_part")
def export_totals(t):
    """Windows and boxes of an export by split."""
    split = F.when(F.col("part_id") % 4 == 0, "validation").otherwise("train")
    windows = grid.windows(t("fx_region_part"), 16).select(F.col("part_id").alias("aoi"), "x", "y", split.alias("split"))
    boxes = labels.verified(t("fx_label")).withColumn("aoi", F.col("det_id") % 25)
    return labels.export_totals(windows, labels.yolo_boxes(windows.drop("split"), boxes, size_px=1024, metres_px=0.125, origin_e=24451424.0, origin_n=8388608.0))


@query("""WITH m AS (SELECT *, CASE WHEN lead(at_ms) OVER (PARTITION BY session ORDER BY at_ms, seq) - at_ms < 800 THEN 0 ELSE 1 END AS rested FROM fx_edit),
r AS (SELECT *, coalesce(sum(rested) OVER (PARTITION BY session ORDER BY at_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM m)
SELECT session, max(at_ms) + 800 AS saved_ms, count(*) AS edits FROM r GROUP BY session, run""", "fx_edit")
def edit_saves(t):
    """When an editor saves: after a rest of 800 ms."""
    return edits.saves(t("fx_edit"))


@query("""WITH a AS (SELECT session, box, max(seq) FILTER (WHERE kind = 'draw') AS drawn, max(seq) FILTER (WHERE kind = 'reject') AS rejected, arg_max(kind, seq) FILTER (WHERE kind <> 'move') AS told, arg_max(class, seq) FILTER (WHERE kind IN ('draw', 'classify')) AS name, arg_max(ring, seq) FILTER (WHERE kind IN ('draw', 'move')) AS ring FROM fx_action GROUP BY session, box)
SELECT session, box, CASE WHEN told = 'reject' THEN 'rejected' WHEN drawn IS NOT NULL AND (rejected IS NULL OR rejected < drawn) THEN 'added' WHEN told = 'classify' THEN 'confirmed' ELSE 'candidate' END AS status, CASE WHEN told = 'reject' THEN '' ELSE coalesce(name, '') END AS class, ring FROM a""", "fx_action")
def edited_boxes(t):
    """What boxes are after everything an editor did to them."""
    return edits.boxes(edits.effective(t("fx_action")))


@query(f"WITH {WINDOWS_SQL}, w AS (SELECT part_id, x, y FROM xs JOIN ys USING (part_id)), c AS (SELECT *, unnest(range(CAST(floor(x / 256) AS BIGINT), CAST(floor((x + 1023) / 256) AS BIGINT) + 1)) AS tile_col FROM w) SELECT part_id, tile_col, tile_row, count(*) AS windows FROM (SELECT *, unnest(range(CAST(floor(y / 256) AS BIGINT), CAST(floor((y + 1023) / 256) AS BIGINT) + 1)) AS tile_row FROM c) GROUP BY ALL", "fx_region_part")
def window_tiles(t):
    """In how many windows of its part a tile is shown."""
    return detect.window_tiles(grid.windows(t("fx_region_part"), 16)).groupBy("part_id", "tile_col", "tile_row").agg(F.count(F.lit(1)).alias("windows"))
