"""Work lists for weather enrichment; the lookups themselves happen outside Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pavilion.operators.reshape import first_item


def first_coordinates(results: Column) -> Column:
    """struct<latitude, longitude> of the first lookup result, or null if either is missing."""
    first = first_item(results)
    both = first["latitude"].isNotNull() & first["longitude"].isNotNull()
    return F.when(both, F.struct(first["latitude"], first["longitude"]))


def matches_to_enrich(matches: DataFrame) -> DataFrame:
    """Matches that have a city and a date."""
    return matches.where((F.col("city") != "") & F.col("match_date").isNotNull())


def cities_to_locate(matches: DataFrame) -> DataFrame:
    """Each city once."""
    return matches_to_enrich(matches).select("city").distinct()


def located(lookups: DataFrame) -> DataFrame:
    """(city, latitude, longitude) of the lookups that found a place."""
    place = lookups.select("city", first_coordinates(F.col("results")).alias("place"))
    return place.where(F.col("place").isNotNull()).select("city", "place.*")


def weather_requests(matches: DataFrame, places: DataFrame) -> DataFrame:
    """One request per match whose city was found; ``places`` has one row per city."""
    return (
        matches_to_enrich(matches)
        .join(places, "city")
        .select(
            "match_id",
            "city",
            "latitude",
            "longitude",
            F.col("match_date").alias("start_date"),
            F.col("match_date").alias("end_date"),
        )
    )


def keyed_payload(payloads: DataFrame, key: str = "match_id") -> DataFrame:
    """Payload documents with their match key as the first field."""
    return payloads.select(key, *[c for c in payloads.columns if c != key])
