"""Dimensions: generated calendars, unknown members and merges of new members anchored to the stored state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starpanel.schema import TABLES, conform

UNKNOWN_DATE, UNKNOWN = 19000101, -1


def calendar(spark: SparkSession, first: str = "2010-01-01", last: str = "2035-12-31") -> DataFrame:
    d = F.col("d")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("d"))
    fmt = lambda p: F.date_format(d, p)
    return conform(days.select(
        fmt("yyyyMMdd").cast("long").alias("date_key"), d.alias("full_date"), F.dayofweek(d).alias("day_of_week"), fmt("EEEE").alias("day_of_week_name"), F.upper(fmt("E")).alias("day_of_week_abbr"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"), F.dayofmonth(d).alias("day_of_month"), F.weekofyear(d).alias("week_of_year"), F.month(d).alias("month_number"),
        fmt("MMMM").alias("month_name"), fmt("yyyy-MM").alias("year_month"), F.quarter(d).alias("quarter"), F.year(d).alias("year"),
    ), "dim_date")


#: First hour of each band of the day.
BANDS = ((0, "Overnight"), (5, "Early Morning"), (7, "Morning Rush"), (9, "Midday"), (12, "Afternoon"), (15, "Evening Rush"), (18, "Evening"), (22, "Night"))
RUSH = (7, 8, 15, 16, 17)


def time_band(hour: Column) -> Column:
    out = F.when(hour >= BANDS[-1][0], BANDS[-1][1])
    for least, name in reversed(BANDS[1:-1]):
        out = out.when(hour >= least, name)
    return out.otherwise(BANDS[0][1])


def times_of_day(spark: SparkSession) -> DataFrame:
    h, m = F.floor(F.col("id") / 60), F.col("id") % 60
    twelve = F.when(h % 12 == 0, 12).otherwise(h % 12)
    return conform(spark.range(24 * 60).select(
        (h * 100 + m).alias("time_key"), F.format_string("%02d:%02d:00", h, m).alias("time_of_day"), h.alias("hour_24"), twelve.alias("hour_12"), F.when(h < 12, "AM").otherwise("PM").alias("am_pm"),
        m.alias("minute_of_hour"), F.format_string("%02d:00-%02d:59", h, h).alias("hour_label"), time_band(h).alias("time_of_day_band"), h.isin(*RUSH).alias("is_rush_hour"),
        ((h < BANDS[1][0]) | (h >= BANDS[-1][0])).alias("is_overnight"),
    ), "dim_time")


#: What a dimension's unknown member holds; what isn't named is NULL.
UNKNOWN_MEMBERS = {
    "dim_date": {"date_key": UNKNOWN_DATE, "full_date": "1900-01-01", "day_of_week": 2, "day_of_week_name": "Unknown", "day_of_week_abbr": "UNK", "is_weekend": False, "day_of_month": 1, "week_of_year": 1, "month_number": 1, "month_name": "Unknown", "year_month": "Unknown", "quarter": 1, "year": 1900},
    "dim_time": {"time_key": UNKNOWN, "time_of_day": "00:00:00", "hour_24": -1, "hour_12": -1, "am_pm": "NA", "minute_of_hour": -1, "hour_label": "Unknown", "time_of_day_band": "Unknown", "is_rush_hour": False, "is_overnight": False},
    "dim_location": {"location_key": UNKNOWN, "location_nk": "~UNKNOWN~"},
    "dim_conditions": {"conditions_key": UNKNOWN, "conditions_nk": "~UNKNOWN~", "light_conditions": "Unknown", "road_conditions": "Unknown", "road_contour": "Unknown", "road_surface": "Unknown", "weather": "Unknown"},
    "dim_crash_type": {"crash_type_key": UNKNOWN, "crash_type_nk": "~UNKNOWN~", "manner_of_crash": "Unknown", "crash_severity": "Unknown", "crash_severity_rank": 0, "coding_era": "Unknown"},
    "dim_person_profile": {"person_profile_key": UNKNOWN, "person_profile_nk": "~UNKNOWN~", "type_of_person": "Unknown", "unit_category": "Unknown", "gender": "Unknown", "age_band": "Unknown", "age_band_sort": 99, "injury_severity": "Unknown", "injury_severity_code": "U", "injury_severity_rank": 0},
}


def with_unknown(dim: DataFrame, name: str) -> DataFrame:
    """The dimension with its unknown member, which is added only where it isn't there."""
    key = TABLES[name].key[0]
    member = UNKNOWN_MEMBERS[name]
    row = dim.sparkSession.range(1).select(*(F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in TABLES[name].schema))
    return dim.unionByName(row.join(dim.select(key), key, "left_anti").select(*dim.columns))


def date_role(calendar: DataFrame, role: str) -> DataFrame:
    """The calendar under the names that it has as the date of ``role``; the fact has names like crash_date itself."""
    names = {"date_key": "date_key", "full_date": "full_date", "day_of_week_name": "day_name", "is_weekend": "is_weekend", "month_name": "month_name", "year_month": "year_month", "quarter": "quarter", "year": "year"}
    return calendar.select(*(F.col(a).alias(f"{role}_{b}") for a, b in names.items()))


def numbered(members: DataFrame, key: str, order: Sequence[str], start: int) -> DataFrame:
    """Keys start + 1, start + 2, ... in the order of the natural key, without one task for all members.

    Members are range-partitioned; the sizes of the partitions (a row each) give the offset of each partition. The
    partitioned members are persisted: sizes and positions must come from one partitioning, and its bounds are sampled.
    """
    members = members.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).persist()
    within = Window.partitionBy("__p").orderBy(*order)
    sizes = members.groupBy("__p").agg(F.count("*").alias("__n"))
    offsets = sizes.select("__p", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__o"))
    out = members.withColumn("__i", F.row_number().over(within)).join(F.broadcast(offsets), "__p")
    return out.withColumn(key, (F.col("__o") + F.col("__i") + start).cast("long")).drop("__p", "__i", "__o")


def merge(dim: DataFrame, source: DataFrame, name: str, nk: str, reprocess: bool = False) -> DataFrame:
    """The dimension after new members of ``source`` (all columns but the key) got keys past the largest stored one.

    With ``reprocess`` known members take the source's attributes and keep their keys; otherwise they stay as they are.
    """
    key, columns = TABLES[name].key[0], TABLES[name].columns
    source = source.distinct()
    top = dim.agg(F.greatest(F.coalesce(F.max(key), F.lit(0)), F.lit(0))).first()[0]
    new = numbered(source.join(dim.select(nk), nk, "left_anti"), key, [nk], top).select(*columns)
    if reprocess:
        fresh = source.select(F.col(nk).alias("__nk"), *(F.col(c).alias(f"__{c}") for c in columns if c not in (key, nk)), F.lit(True).alias("__hit"))
        dim = dim.join(fresh, dim[nk] == fresh["__nk"], "left").select(*(F.col(c) if c in (key, nk) else F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in columns))
    return conform(dim.unionByName(new), name)


def _known(c: str, test: Column) -> Column:
    return F.when(F.col(c) != "Unknown", test)


def members(cleaned: DataFrame) -> dict[str, tuple[str, DataFrame]]:
    """Natural key and members of the four merged dimensions, from cleaned rows."""
    c = F.col
    where = c("crashloc_lbl")
    crossing = F.when(where.isNull() | where.like("UNKNOWN%"), None).when(where.like("NOT AN INTERSECTION%"), False).otherwise(where.rlike("INTERSECTION|FIVE-POINT|TRAFFIC CIRCLE"))
    rank = c("crash_severity_rank")
    return {
        "dim_location": ("location_nk", cleaned.select("location_nk", "address", "zip", "community_council_neighborhood", "cpd_neighborhood", "sna_neighborhood", "road_class_code", "road_class_desc", c("crashlocation").alias("crash_location_raw"), "crash_location", crossing.alias("is_intersection"))),
        "dim_conditions": ("conditions_nk", cleaned.select(
            "conditions_nk", c("lightconditionsprimary").alias("light_conditions_raw"), "light_conditions", c("light_conditions").startswith("Dark").alias("is_dark"),
            c("roadconditionsprimary").alias("road_conditions_raw"), "road_conditions", c("road_conditions").isin("Wet", "Snow", "Ice", "Slush", "Standing/Moving Water").alias("is_slick"),
            c("roadcontour").alias("road_contour_raw"), "road_contour", c("road_contour").startswith("Curve").alias("is_curve"), c("road_contour").endswith("Grade").alias("is_grade"),
            c("roadsurface").alias("road_surface_raw"), "road_surface", c("weather").alias("weather_raw"), c("weather_norm").alias("weather"),
            (~c("weather_norm").isin("Clear", "Cloudy", "Other/Unknown", "Unknown")).alias("is_adverse_weather"))),
        "dim_crash_type": ("crash_type_nk", cleaned.select(
            "crash_type_nk", c("mannerofcrash").alias("manner_of_crash_raw"), "manner_of_crash", _known("manner_of_crash", c("manner_of_crash") != "Not Collision Between Two Motor Vehicles").alias("is_collision"),
            c("crashseverity").alias("crash_severity_raw"), c("crashseverityid").alias("crash_severity_id_raw"), "crash_severity", "crash_severity_rank",
            F.when(rank != 0, rank >= 2).alias("is_injury_crash"), F.when(rank != 0, rank == 5).alias("is_fatal_crash"), "coding_era")),
        "dim_person_profile": ("person_profile_nk", cleaned.select(
            "person_profile_nk", c("typeofperson").alias("type_of_person_raw"), "type_of_person", _known("type_of_person", c("type_of_person").isin("Driver", "Occupant")).alias("is_motorist"),
            c("unittype").alias("unit_type_raw"), c("unit_lbl").alias("unit_type"), "unit_category", c("gender").alias("gender_raw"), c("gender_norm").alias("gender"), "age_band", "age_band_sort",
            c("injuries").alias("injury_severity_raw"), "injury_severity", "injury_severity_code", "injury_severity_rank")),
    }
