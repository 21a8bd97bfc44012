"""Localities and coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.texts import strip
from rollcall.schema import GEO

# Fixed value: closing letters cut before two place names are compared.
ENDINGS = "аеоуияью"


def is_local(locality: Column, city: Column) -> Column:
    """Whether a listing's locality is the city: empty, a prefix either way, or equal without its ending."""
    place = F.lower(strip(F.coalesce(locality, F.lit(""))))
    target = F.lower(strip(city))
    stem = F.rtrim(place, F.lit(ENDINGS))
    return (
        (F.coalesce(locality, F.lit("")) == "")
        | F.startswith(target, place)
        | F.startswith(place, target)
        | ((F.length(place) > 4) & (stem != "") & (stem == F.rtrim(target, F.lit(ENDINGS))))
    )


def geo_point(lat: Column, lon: Column) -> Column:
    """Point when both coordinates are numbers other than zero."""
    y, x = lat.try_cast("double"), lon.try_cast("double")
    return F.when((y != 0) & (x != 0), F.struct(y.alias("lat"), x.alias("lon"))).otherwise(F.lit(None).cast(GEO))


def name_rank(candidate: Column, position: Column, wanted: Column) -> Column:
    """0 for the exact name, 1 for a first candidate with the same six letters or, if short, a common start."""
    a, b = F.lower(wanted), F.lower(F.coalesce(candidate, F.lit("")))
    both_long = (F.length(a) >= 6) & (F.length(b) >= 6)
    similar = F.when(both_long, F.substring(a, 1, 6) == F.substring(b, 1, 6)).otherwise(
        F.startswith(a, b) | F.startswith(b, a)
    )
    return F.when(strip(candidate) == wanted, 0).when((position == 0) & similar, 1)
