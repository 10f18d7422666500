"""Editor events, saves, tallies and the evaluation's verdict."""

from __future__ import annotations

import random

import pytest

from gridsight.operators import edits, evaluate, labels

EVENTS = "session long, seq long, at_ms long, kind string, box long, class string, ring string"


def _events(seed, count):
    draw = random.Random(seed)
    at, rows = 0, []
    for k in range(count):
        at += draw.choice([50, 300, 699, 700, 2000])
        kind = draw.choice(["draw", "move", "move", "classify", "reject", "delete", "undo", "undo", "look"])
        box = None if kind == "undo" else draw.randrange(4)
        rows.append((k % 2, k, at, kind, box, draw.choice(["truck", "car"]) if kind in ("draw", "classify") else None, f"r{k}" if kind in ("draw", "move") else None))
    return rows


def _by_hand(rows, depth):
    """Boxes after all events of each session, undoing by remembered states."""
    out = {}
    for session in {r[0] for r in rows}:
        state, stack = {}, []
        for _, seq, at, kind, box, name, ring in (r for r in rows if r[0] == session):
            if kind == "undo":
                if stack:
                    state = stack.pop()["before"]
                continue
            edit = kind in edits.EDITS
            if kind not in (*edits.EDITS, "draw", "delete"):
                continue
            if edit and stack and stack[-1]["edit"] and stack[-1]["box"] == box and at - stack[-1]["at"] < 700:
                stack[-1]["at"] = at
            else:
                stack.append({"edit": edit, "box": box, "at": at, "before": state})
                stack = stack[-depth:]
            old = state.get(box, {"status": "candidate", "class": "", "ring": None})
            new = {
                "draw": lambda: {"status": "added", "class": name, "ring": ring},
                "move": lambda: {**old, "ring": ring},
                "classify": lambda: {**old, "class": name, "status": "added" if old["status"] == "added" else "confirmed"},
                "reject": lambda: {**old, "class": "", "status": "rejected"},
                "delete": lambda: None,
            }[kind]()
            state = {k: v for k, v in {**state, box: new}.items() if v is not None}
        out |= {(session, box): tuple(v.values()) for box, v in state.items()}
    return out


@pytest.mark.parametrize("depth", [3, 100])
def test_undo_goes_back_to_what_was(spark, depth):
    for seed in range(3):
        rows = [r for r in _events(seed, 120) if r[3] != "delete"]  # a box that is edited after it is deleted has no one meaning
        got = edits.boxes(edits.effective(spark.createDataFrame(rows, EVENTS), depth=depth)).collect()
        assert {(r["session"], r["box"]): (r["status"], r["class"], r["ring"]) for r in got} == _by_hand(rows, depth)


def test_deleted_and_drawn_again(spark):
    rows = [(1, 1, 0, "draw", 7, "car", "a"), (1, 2, 5000, "delete", 7, None, None), (1, 3, 9000, "draw", 8, "bus", "b"), (1, 4, 20000, "delete", 8, None, None), (1, 5, 30000, "undo", None, None, None), (1, 6, 40000, "undo", None, None, None), (1, 7, 50000, "undo", None, None, None)]
    frame = spark.createDataFrame(rows, EVENTS)
    assert [(r["box"], r["status"]) for r in edits.boxes(edits.effective(frame)).collect()] == [(7, "added")]
    assert edits.boxes(edits.effective(frame.limit(0))).count() == 0


def test_saves_wait_for_a_rest(spark):
    rows = [(1, k, t) for k, t in enumerate([0, 700, 1400, 2200, 2300])] + [(2, 9, 100)]
    got = {tuple(r) for r in edits.saves(spark.createDataFrame(rows, "session long, seq long, at_ms long")).collect()}
    assert got == {(1, 2200, 3), (1, 3100, 2), (2, 900, 1)}


def test_file_order(spark):
    frame = spark.createDataFrame([(1, None), (2, 5), (3, 0), (4, None)], "det_id long, position long")
    assert [r["det_id"] for r in edits.file_order(frame).collect()] == [3, 2, 1, 4]


def test_tallies(spark):
    areas = spark.createDataFrame([("train", 5, 2), ("train", 1, 1), ("validation", 7, 0), ("train", None, None)], "split string, total long, reviewed long")
    got = {tuple(r) for r in labels.folder_tallies(areas).collect()}
    assert got == {("train", 2, 6, 3), ("validation", 1, 7, 0), ("not staged", 1, 0, 0), ("all", 4, 13, 3)}
    windows = spark.createDataFrame([("train", "a", 0, 0), ("train", "a", 784, 0), ("validation", "b", 0, 0)], "split string, aoi string, x long, y long")
    held = spark.createDataFrame([("a", 0, 0, k) for k in range(3)], "aoi string, x long, y long, det_id long")
    assert {tuple(r) for r in labels.export_totals(windows, held).collect()} == {("train", 2, 3), ("validation", 1, 0)}
    found = spark.createDataFrame([(k, "no ring") for k in range(25)], "det_id long, problem string")
    lines, more = labels.shown_problems(found, "det_id")
    assert lines[0] == "0: no ring" and len(lines) == 20 and more == 5


def test_verdict(spark):
    areas = spark.createDataFrame([("a",), ("b",), ("c",)], "aoi string")
    truth = spark.createDataFrame([("a", 100), ("b", 5)], "aoi string, n long")
    found = spark.createDataFrame([("a", 104), ("b", 50), ("x", 1)], "aoi string, n long")
    counts = evaluate.area_counts(areas, truth, found)
    assert {tuple(r) for r in counts.collect()} == {("a", 100, 104, True), ("b", 5, 50, None), ("c", 0, 0, None)}

    def outcome(p, r, counts=counts):
        return tuple(evaluate.verdict(evaluate.gates(spark.createDataFrame([(p, r)], "p double, r double"), counts)).first())

    assert outcome(0.9, 0.95) == (True, 0, 2) and outcome(0.5, 0.95) == (False, 1, 2)
    assert outcome(0.9, 0.5, evaluate.area_counts(areas, truth, truth.limit(0))) == (False, 2, 2)
    assert tuple(evaluate.verdict(evaluate.gates(spark.createDataFrame([], "p double, r double"), counts.limit(0))).first()) == (False, 0, 0)
