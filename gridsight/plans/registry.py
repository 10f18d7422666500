"""Registration of queries with their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridsight.plans.fixtures import Tables, ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A detection's centre and sides in SQL.
CX, CY = "((x0 + x1 + x2 + x3) / 4)", "((y0 + y1 + y2 + y3) / 4)"
SIDE0, SIDE1 = "sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))", "sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"
LENGTH, WIDTH = f"greatest({SIDE0}, {SIDE1})", f"least({SIDE0}, {SIDE1})"


#: Definitions ending in ``xs (part_id, x)`` and ``ys (part_id, y)``: origins of the windows over every part.
WINDOWS_SQL = """p AS (SELECT part_id, CAST(floor((min_e - 24451424) / 0.125) AS BIGINT) AS x0, CAST(ceil((max_e - 24451424) / 0.125) AS BIGINT) AS x1, CAST(floor((8388608 - max_n) / 0.125) AS BIGINT) AS y0, CAST(ceil((8388608 - min_n) / 0.125) AS BIGINT) AS y1 FROM fx_region_part),
xs AS (SELECT part_id, unnest(CASE WHEN x1 - x0 <= 1024 THEN [x0] ELSE list_distinct(list_append(range(x0, x1 - 1024 + 1, 784), x1 - 1024)) END) AS x FROM p),
ys AS (SELECT part_id, unnest(CASE WHEN y1 - y0 <= 1024 THEN [y0] ELSE list_distinct(list_append(range(y0, y1 - 1024 + 1, 784), y1 - 1024)) END) AS y FROM p)"""


def nearest(expression: str, by: int = 1000) -> str:
    """SQL of ``geometry.scaled``."""
    return f"CAST(floor(({expression}) * {by} + 0.5) AS BIGINT)"


def query(sql: str | None = None, *views: str, name: str | None = None):
    """Register a function of ``Tables``; ``sql`` is its oracle over ``views``, and may begin with its own WITH."""

    def register(build: Callable[[Tables], DataFrame]):
        title = name or build.__name__
        QUERIES[title] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            own = sql.strip()
            before = ctes(*views)
            for start in ("WITH RECURSIVE ", "WITH "):
                if own.startswith(start):
                    ORACLES[title] = start + ", ".join([*before, own.removeprefix(start)])
                    break
            else:
                ORACLES[title] = ("WITH " + ", ".join(before) + " " if before else "") + own
        return build

    return register
