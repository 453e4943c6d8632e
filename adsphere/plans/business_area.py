"""Business areas: coordinates → geohash → area names.

The reference calls a web geocoder once per distinct coordinate inside a map
task.  Here the geocoder answers are a table (``geocode_responses``) and the
lookup is a join, so the job is an ordinary shuffle/join plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import area_names, areas_text, geohash8, location_text
from ..operators.joins import checked_broadcast


def has_coordinates(df: DataFrame) -> DataFrame:
    """P4."""
    return df.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())


def distinct_coordinates(ods: DataFrame, by: tuple = ()) -> DataFrame:
    """A9 + G22: one row per (latitude, longitude), and per columns ``by``, with its request text."""
    return (has_coordinates(ods).select(*by, "latitude", "longitude").distinct()
            .withColumn("location", location_text(F.col("longitude"), F.col("latitude"))))


def coordinate_areas(coords: DataFrame, responses: DataFrame, by: tuple = ()) -> DataFrame:
    """G19 per coordinate: (latitude, longitude, geohash, areas); no answer → ''."""
    joined = coords.join(responses, ["longitude", "latitude"], "left")
    return joined.select(*by, "latitude", "longitude",
                         geohash8(F.col("latitude"), F.col("longitude")).alias("geohash"),
                         areas_text(F.col("response")).alias("areas"),
                         area_names(F.col("response")).alias("_names"))


def area_library(coords_with_areas: DataFrame, by: tuple = ()) -> DataFrame:
    """P5 + dedup: one row per geohash (and per columns ``by``), names distinct and sorted, joined by ','.

    ``collect_set`` aggregates partially on the map side, so however many
    coordinates fall in one cell, each task ships and the reducer holds only
    that cell's distinct names.
    """
    names = (coords_with_areas.where(F.col("areas") != "")
             .select(*by, "geohash", F.explode("_names").alias("name"))
             .where(F.col("name").isNotNull()))
    return (names.groupBy(*by, "geohash")
            .agg(F.array_join(F.sort_array(F.collect_set("name")), ",").alias("areas")))


def with_areas(ods: DataFrame, library: DataFrame, by: tuple = ()) -> DataFrame:
    """Every ODS row gets its cell's ``areas`` (NULL when the cell has none).

    The library is broadcast only after a row-count check (pass a stored one: the check
    runs its plan); beyond it the join shuffles on geohash and AQE splits a hot cell's
    partition.
    """
    keyed = ods.withColumn("geohash", geohash8(F.col("latitude"), F.col("longitude")))
    return keyed.join(checked_broadcast(library), [*by, "geohash"], "left")


def lookup_areas(geohashes: DataFrame, library: DataFrame) -> DataFrame:
    """S8 as a join: ``areas`` per geohash, '' when absent."""
    return (geohashes.join(checked_broadcast(library), "geohash", "left")
            .select("geohash", F.coalesce(F.col("areas"), F.lit("")).alias("areas")))
