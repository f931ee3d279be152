"""Nearest catalogue station, exact at any distance, without pairing everything with everything.

Catalogue positions are sorted into a tree of cubes around the unit sphere, each with the extent
of its points and one of them as its sample. A query walks down the tree: at each level it joins
the occupied cubes inside those it still holds, and keeps only those that reach as near as the
nearest sample met so far. Every join is an equi-join on a cube, a cube has a bounded number of
children, and the leaves are small enough that even a place with a large share of all stations is
met by few of its points at a time.

Which stations a query may match depends on country and region, where either side may be blank.
Each catalogue row therefore stands under four facets (country or any, region or any), and each
query names the facets it accepts, so that this condition is part of the join key as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.geo import cube_cell, haversine_km, unit_vector

QUERY = ("query_latitude", "query_longitude", "country", "state")

# Cube sides are two to the minus these: from 6400 km down to 0.1 km.
DEPTHS = (0, 2, 4, 7, 11, 16)

# Straight-line distance squared under which two distances count as equal while pruning (some
# metres); the final choice compares great-circle distances.
SLACK = 1e-12

ANY = "*"
AXES = ("x", "y", "z")


def _facet(country: Column, region: Column) -> Column:
    return F.concat_ws("\x1f", country, region)


def _facets_of_station(country: Column, region: Column) -> Column:
    anything = F.lit(ANY)
    return F.array(
        _facet(country, region), _facet(country, anything), _facet(anything, region), _facet(anything, anything)
    )


def _facets_of_query(country: Column, region: Column) -> Column:
    """Facets that together hold exactly the stations a query accepts; blank matches all."""
    blank, anything = F.lit(""), F.lit(ANY)
    countries = F.when(country == "", F.array(anything)).otherwise(F.array(country, blank))
    regions = F.when(region == "", F.array(anything)).otherwise(F.array(region, blank))
    return F.flatten(F.transform(countries, lambda c: F.transform(regions, lambda r: _facet(c, r))))


def _points(catalog: DataFrame) -> DataFrame:
    """Catalogue positions on the unit sphere, by facet."""
    x, y, z = unit_vector(F.col("latitude"), F.col("longitude"))
    facets = _facets_of_station(F.coalesce("country", F.lit("")), F.coalesce("region", F.lit("")))
    return catalog.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        F.explode(facets).alias("facet"), "latitude", "longitude", "position",
        x.alias("x"), y.alias("y"), z.alias("z"),
    )


def _cells(points: DataFrame, depth: int, parent_depth: int | None) -> DataFrame:
    """Occupied cubes of one level, with their parent and the extent of their points."""
    keys = [F.col("facet"), cube_cell(depth).alias("cell")]
    if parent_depth is not None:
        keys.append(cube_cell(parent_depth).alias("parent"))
    extent = [F.expr(f"{bound}({axis}) AS {name}_{axis}") for axis in AXES for name, bound in (("lo", "min"), ("hi", "max"))]
    sample = [F.expr(f"min_by({axis}, position) AS s_{axis}") for axis in AXES]
    return points.groupBy(*keys).agg(*extent, *sample)


def _keep_promising(held: DataFrame) -> DataFrame:
    """Drops cubes that are farther, at their nearest, than a sample the query has met.

    Samples of the levels above are known before the shuffle, those of this level after it. A
    query's first tier that holds any cube at all also drops its later tiers.
    """
    nearest = " + ".join(f"pow(greatest(lo_{a} - q_{a}, q_{a} - hi_{a}, 0D), 2)" for a in AXES)
    sample = " + ".join(f"pow(s_{a} - q_{a}, 2)" for a in AXES)
    carried = (*QUERY, *[f"q_{a}" for a in AXES], "tier", "facet", "cell")
    best = f"min(struct(tier, sample)) OVER (PARTITION BY {', '.join(QUERY)}) AS best"
    return (
        held.selectExpr(*carried, "reach", f"{nearest} AS nearest", f"{sample} AS sample")
        .filter(f"nearest <= reach + {SLACK}D")
        .selectExpr(*carried, "reach", "nearest", best)
        .filter(f"tier = best.tier AND nearest <= best.sample + {SLACK}D")
        .selectExpr(*carried, "least(reach, best.sample) AS reach")
    )


def nearest_station(queries: DataFrame, catalog: DataFrame) -> DataFrame:
    """The nearest acceptable catalogue station of each distinct query, with its distance.

    ``queries`` hold the columns of ``QUERY``, places never null, country and state blank where
    unknown. ``catalog`` holds ``position`` (its order), ``latitude``, ``longitude``, ``country``
    and ``region``. A station is acceptable if its country and region equal the query's wherever
    both are known. Queries without one in their country are answered from all countries. Ties go
    to the first in the catalogue. Queries without an acceptable station are left out.
    """
    points = _points(catalog)
    x, y, z = unit_vector(F.col("query_latitude"), F.col("query_longitude"))

    def tier(number: int, country: Column) -> Column:
        return F.transform(
            _facets_of_query(country, F.col("state")),
            lambda facet: F.struct(F.lit(number).alias("tier"), facet.alias("facet")),
        )

    first, second = tier(1, F.col("country")), tier(2, F.lit(""))
    accepts = F.when(F.col("country") == "", first).otherwise(F.concat(first, second))
    held = (
        queries.select(*QUERY).distinct()
        .select(*QUERY, x.alias("q_x"), y.alias("q_y"), z.alias("q_z"), F.lit(4.0).alias("reach"), F.inline(accepts))
    )
    parent_depth = None
    for depth in DEPTHS:
        cells = _cells(points, depth, parent_depth)
        if parent_depth is not None:
            held = held.withColumnRenamed("cell", "parent")
        held = _keep_promising(held.join(cells, ["facet"] if parent_depth is None else ["facet", "parent"]))
        parent_depth = depth

    # Of stations at one position only the first can be the answer.
    leaves = points.groupBy("facet", "latitude", "longitude", cube_cell(parent_depth).alias("cell")).agg(
        F.min("position").alias("position")
    )
    km = haversine_km(F.col("query_latitude"), F.col("query_longitude"), F.col("latitude"), F.col("longitude"))
    return (
        held.join(leaves, ["facet", "cell"])
        .groupBy(*QUERY)
        .agg(F.min(F.struct(km.alias("km"), "position")).alias("found"))
        .select(*QUERY, "found.position", "found.km")
    )
