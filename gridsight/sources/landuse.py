"""Land use from a map service: queries, cache keys and elements as polygons."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Municipalities by reference number, those that can be used, and the tag filters of each profile.
MUNICIPALITIES = {"Helsinki": "091", "Espoo": "049", "Vantaa": "092"}
SUPPORTED = ("Helsinki",)
PROFILES = {
    "industrial": ('["landuse"="industrial"]',),
    "commercial": ('["landuse"="commercial"]',),
    "construction": ('["landuse"="construction"]',),
    "camping": ('["tourism"="camp_site"]', '["tourism"="caravan_site"]', '["shop"="caravan"]'),
}
TIMEOUT_S = 180
ELEMENTS = "elements array<struct<type: string, id: long, tags: map<string, string>, geometry: array<struct<lat: double, lon: double>>, members: array<struct<role: string, geometry: array<struct<lat: double, lon: double>>>>>>"


def reference(municipality: str) -> str:
    """The number of a municipality that can be used."""
    usable = {name: MUNICIPALITIES[name] for name in SUPPORTED}
    try:
        return usable[municipality]
    except KeyError:
        planned = ", ".join(sorted(set(MUNICIPALITIES) - set(usable)))
        raise ValueError(f"no land use for {municipality!r}: there is {', '.join(usable)}; without imagery so far: {planned}") from None


def query_text(municipality: str, profile: str = "industrial") -> str:
    """One union over the filters of a profile, within the municipality's area."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile}; known: {', '.join(PROFILES)}")
    union = [f"  {kind}{tags}(area.a);" for tags in PROFILES[profile] for kind in ("way", "relation")]
    head = [f"[out:json][timeout:{TIMEOUT_S}];", f'area["ref"="{reference(municipality)}"]["admin_level"="8"]->.a;', "("]
    return "\n".join([*head, *union, ");", "out geom;", ""])


def query_key(query: str) -> str:
    """Sixteen hexadecimal digits that tell queries apart."""
    return hashlib.sha256(query.encode()).hexdigest()[:16]


def _ring(nodes: Column) -> Column:
    """A closed ring of longitude and latitude; null for fewer than four nodes."""
    points = F.transform(nodes, lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y")))
    first = F.get(points, F.lit(0))
    closed = F.when(first == F.element_at(points, -1), points).otherwise(F.concat(points, F.array(first)))
    return F.when(F.size(nodes) >= 4, closed)


def polygons(spark: SparkSession, path: str) -> DataFrame:
    """``element_id, tags, ring`` of ways, and of the outer members of relations; what makes no ring is left out."""
    elements = spark.read.schema(ELEMENTS).json(path, multiLine=True).select(F.explode("elements").alias("e"))
    outer = F.filter(F.coalesce(F.col("e.members"), F.array()), lambda m: F.coalesce(m["role"], F.lit("")).isin("outer", ""))
    rings = F.when(F.col("e.type") == "way", F.array(_ring(F.col("e.geometry")))).when(F.col("e.type") == "relation", F.transform(outer, lambda m: _ring(m["geometry"])))
    return elements.select(F.col("e.id").alias("element_id"), F.col("e.tags").alias("tags"), F.explode(rings).alias("ring")).filter(F.col("ring").isNotNull())
