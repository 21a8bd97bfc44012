"""Candidate profile names of a company."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.binding import let
from rollcall.functions.texts import transliterate
from rollcall.schema import no_strings

# Industry part of a profile name, long and short.
LONG_PART, SHORT_PART = "ritualnyeuslugi", "ritual"


def candidate_handles(name: Column, phone: Column) -> Column:
    """Up to six names in order of preference, distinct, five characters or longer."""
    base = F.regexp_replace(transliterate(F.coalesce(name, F.lit(""))), "[^a-z0-9]", "")
    dialled = F.length(phone) >= 11

    def handles(word: Column) -> Column:
        start = F.substring(word, 1, 20)
        options = F.array(
            F.substring(word, 1, 30),
            F.substring(F.replace(word, F.lit(LONG_PART), F.lit(SHORT_PART)), 1, 30),
            F.concat(start, F.lit("_" + SHORT_PART)),
            F.concat(F.lit(SHORT_PART + "_"), start),
            F.when(dialled, F.concat(F.substring(word, 1, 15), F.right(phone, F.lit(4)))),
            F.when(dialled, phone),
        )
        fit = F.array_distinct(F.filter(options, lambda o: F.length(o) >= 5))
        return F.when(word != "", fit).otherwise(no_strings())

    return let(base, handles)
