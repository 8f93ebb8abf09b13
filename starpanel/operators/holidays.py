"""US federal holidays with observed days, as Column functions over a range of years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values. (month, day, first year); then (month, weekday from 1 = Sunday, which), 0 for the last.
FIXED = ((1, 1, 0), (7, 4, 0), (11, 11, 0), (12, 25, 0), (6, 19, 2021))
FLOATING = ((1, 2, 3), (2, 2, 3), (5, 2, 0), (9, 2, 1), (10, 2, 2), (11, 5, 4))


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(first, F.pmod(weekday - F.dayofweek(first), F.lit(7)) + 7 * (n - 1))


def last_weekday(year: Column, month: int, weekday: int) -> Column:
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(last, F.pmod(F.dayofweek(last) - weekday, F.lit(7)))


def observed(day: Column) -> Column:
    w = F.dayofweek(day)
    return F.when(w == 7, F.date_sub(day, 1)).when(w == 1, F.date_add(day, 1)).otherwise(day)


def holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """(day): distinct holidays of the years, with the days on which those of a fixed date are observed."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("y"))
    y = F.col("y")
    fixed = [F.when(y >= since, F.make_date(y, F.lit(m), F.lit(d))) for m, d, since in FIXED]
    floating = [nth_weekday(y, m, w, n) if n else last_weekday(y, m, w) for m, w, n in FLOATING]
    days = F.array_compact(F.array(*fixed, *(observed(d) for d in fixed), *floating))
    return years.select(F.explode(days).alias("day")).distinct()
