"""Mergeable sketches of distinct tracks (the opt-in approximate form of AG-5).

One HyperLogLog sketch per (country, chart week); sketches are united over any
weeks and countries, so unique tracks of arbitrary periods need a few kilobytes
a week instead of the fact table.  The exact count stays ``count_distinct``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^14 registers: a standard error of 0.8 percent.
LOG_REGISTERS = 14


def week_sketches(fact: DataFrame, *by: str) -> DataFrame:
    """(country, date_id, *by, entries, sketch): partial sketches are united map side."""
    return fact.groupBy("country", "date_id", *by).agg(
        F.count(F.lit(1)).alias("entries"), F.hll_sketch_agg("track_id", F.lit(LOG_REGISTERS)).alias("sketch"))


def unique_tracks(sketches: DataFrame, *by: Column) -> DataFrame:
    """(*by, entries, unique_tracks): the sketches of each group united."""
    return sketches.groupBy(*by).agg(
        F.sum("entries").alias("entries"), F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False))).alias("unique_tracks"))
