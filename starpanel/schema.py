"""Table registry: columns, keys, references; empty tables, migrations and a diagram come from it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    key: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)
    partition: tuple[str, ...] = ()
    cluster: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


STAGING_COLUMNS = (
    "socrata_id", "socrata_version", "socrata_created_at", "socrata_updated_at", "reportnumber", "unitno", "eventdate", "reportdate", "address",
    "latitude", "longitude", "snaneighborhood", "crashlocation", "lightconditionsprimary", "roadconditionsprimary", "roadcontour", "roadsurface",
    "weather", "mannerofcrash", "crashseverity", "typeofperson", "gender", "agerange", "injuries",
)
STAGING = StructType([StructField(c, StringType()) for c in STAGING_COLUMNS])

TABLES = {
    t.name: t
    for t in (
        Table("stg_crash_person", ", ".join(f"{c} string" for c in STAGING_COLUMNS)),
        Table("dim_date", "date_key bigint, full_date date, day_of_week bigint, day_of_week_name string, day_of_week_abbr string, is_weekend boolean, day_of_month bigint, week_of_year bigint, month_number bigint, month_name string, year_month string, quarter bigint, year bigint", ("date_key",)),
        Table("dim_time", "time_key bigint, time_of_day string, hour_24 bigint, hour_12 bigint, am_pm string, minute_of_hour bigint, hour_label string, time_of_day_band string, is_rush_hour boolean, is_overnight boolean", ("time_key",)),
        Table("dim_location", "location_key bigint, location_nk string, address string, zip string, community_council_neighborhood string, cpd_neighborhood string, sna_neighborhood string, road_class_code string, road_class_desc string, crash_location_raw string, crash_location string, is_intersection boolean", ("location_key",)),
        Table("dim_conditions", "conditions_key bigint, conditions_nk string, light_conditions_raw string, light_conditions string, is_dark boolean, road_conditions_raw string, road_conditions string, is_slick boolean, road_contour_raw string, road_contour string, is_curve boolean, is_grade boolean, road_surface_raw string, road_surface string, weather_raw string, weather string, is_adverse_weather boolean", ("conditions_key",)),
        Table("dim_crash_type", "crash_type_key bigint, crash_type_nk string, manner_of_crash_raw string, manner_of_crash string, is_collision boolean, crash_severity_raw string, crash_severity_id_raw string, crash_severity string, crash_severity_rank bigint, is_injury_crash boolean, is_fatal_crash boolean, coding_era string", ("crash_type_key",)),
        Table("dim_person_profile", "person_profile_key bigint, person_profile_nk string, type_of_person_raw string, type_of_person string, is_motorist boolean, unit_type_raw string, unit_type string, unit_category string, gender_raw string, gender string, age_band string, age_band_sort bigint, injury_severity_raw string, injury_severity string, injury_severity_code string, injury_severity_rank bigint", ("person_profile_key",)),
        Table(
            "fact_crash_person",
            "crash_date_key bigint, reported_date_key bigint, crash_time_key bigint, location_key bigint, conditions_key bigint, crash_type_key bigint, person_profile_key bigint, instanceid string, localreportno string, source_dataset string, socrata_id string, crash_date date, crash_datetime timestamp_ntz, reporting_lag_hours double, latitude double, longitude double, distance_to_cbd_m double, person_count bigint, is_injured bigint, is_fatal bigint, age bigint, age_range string, neighborhood string, socrata_version string, socrata_updated_at timestamp, loaded_at timestamp, crash_hash string",
            (),
            {"crash_date_key": "dim_date", "reported_date_key": "dim_date", "crash_time_key": "dim_time", "location_key": "dim_location", "conditions_key": "dim_conditions", "crash_type_key": "dim_crash_type", "person_profile_key": "dim_person_profile"},
            ("crash_month",), ("crash_type_key", "person_profile_key", "location_key"),
        ),
        Table("etl_load_log", "load_id string, load_mode string, window_start date, started_at timestamp, finished_at timestamp, rows_staged bigint, fact_inserted bigint, fact_updated bigint, fact_deleted bigint, socrata_updated_at string, crashes_new bigint, crashes_changed bigint, crashes_removed bigint, crashes_deferred bigint, status string, error_message string, fact_committed_at timestamp", ("load_id",)),
        Table("ml_weather_daily", "day date, station_id string, tmax_f double, tmin_f double, prcp_in double, snow_in double, snwd_in double, awnd_mph double", ("day",)),
        Table("ml_cell_attributes", "cell_scheme string, cell_id string, road_miles double, intersection_count bigint, aadt double, population bigint", ("cell_scheme", "cell_id")),
    )
}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name].schema)


def conform(df: DataFrame, name: str, backfill: dict[str, Column] | None = None) -> DataFrame:
    """A guarded migration: columns that are missing are added (from ``backfill``, else NULL), all are typed and in order."""
    fill = backfill or {}
    return df.select(*(
        F.coalesce(df[f.name], fill[f.name]).cast(f.dataType).alias(f.name) if f.name in df.columns and f.name in fill
        else df[f.name].cast(f.dataType).alias(f.name) if f.name in df.columns
        else fill.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in TABLES[name].schema
    ))


def mermaid() -> str:
    """An entity-relationship diagram of the registry."""
    lines = ["erDiagram"]
    for t in TABLES.values():
        lines += [f"    {t.name} {{"]
        for f in t.schema:
            mark = " PK" if f.name in t.key else " FK" if f.name in t.references else ""
            lines += [f"        {f.dataType.simpleString()} {f.name}{mark}"]
        lines += ["    }"]
    for t in TABLES.values():
        lines += [f"    {other} ||--o{{ {t.name} : {column}" for column, other in t.references.items()]
    return "\n".join(lines)
