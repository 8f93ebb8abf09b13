"""The cleaning layer: staging and the frozen history's report numbers in, typed and keyed rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starpanel.functions import ladders as L
from starpanel.functions.semantics import bounded_pair, mask_block, natural_key, null_if_blank, row_json, safe_datetime, safe_double, strip_code, word_initcap

#: How the two sources are told apart: rows of the first are this pipeline's own, rows of the second never change.
OWNED, FROZEN = "owned", "frozen"

#: Inputs of the content hash, in an order that is part of the contract; system fields and fuzzed coordinates stay out.
HASHED = (
    "reportnumber", "unitno", "eventdate", "reportdate", "address", "snaneighborhood", "crashlocation", "lightconditionsprimary", "roadconditionsprimary",
    "roadcontour", "roadsurface", "weather", "mannerofcrash", "crashseverity", "typeofperson", "gender", "agerange", "injuries",
)
#: Raw columns that natural keys are made of.
KEYED = ("lightconditionsprimary", "roadconditionsprimary", "roadcontour", "roadsurface", "weather", "mannerofcrash", "crashseverity", "typeofperson", "gender", "injuries", "address", "crashlocation")
#: Bounds of the county: low and high latitude, low and high longitude.
BOX = (38.9, 39.4, -84.9, -84.2)

_DIGITS, _LETTER = r"\d+", "[A-Z]"
LABELS = {
    "light_lbl": ("lightconditionsprimary", _DIGITS), "roadcond_lbl": ("roadconditionsprimary", _DIGITS), "contour_lbl": ("roadcontour", _DIGITS),
    "surface_lbl": ("roadsurface", _DIGITS), "weather_lbl": ("weather", _DIGITS), "manner_lbl": ("mannerofcrash", _DIGITS),
    "severity_lbl": ("crashseverity", _DIGITS), "crashloc_lbl": ("crashlocation", _DIGITS), "injury_lbl": ("injuries", _DIGITS),
    "person_lbl": ("typeofperson", _LETTER), "gender_lbl": ("gender", _LETTER),
}
CANONICAL = {
    "light_conditions": (L.LIGHT, "light_lbl"), "road_conditions": (L.ROAD_CONDITION, "roadcond_lbl"), "road_contour": (L.CONTOUR, "contour_lbl"),
    "road_surface": (L.SURFACE, "surface_lbl"), "weather_norm": (L.WEATHER, "weather_lbl"), "manner_of_crash": (L.MANNER, "manner_lbl"),
    "crash_severity": (L.SEVERITY, "severity_lbl"), "injury_severity": (L.INJURY, "injury_lbl"), "type_of_person": (L.PERSON, "person_lbl"), "gender_norm": (L.GENDER, "gender_lbl"),
}
_ABSENT = ("zip", "community_council_neighborhood", "cpd_neighborhood", "sna_neighborhood", "road_class_code", "road_class_desc", "crashseverityid", "unittype", "unit_lbl")


def owned_rows(staging: DataFrame, history_reports: DataFrame | None) -> DataFrame:
    """Staged rows whose report isn't in the frozen history (a table of localreportno)."""
    if history_reports is None:
        return staging
    return staging.join(history_reports.select(F.col("localreportno").alias("reportnumber")).distinct(), "reportnumber", "left_anti")


def clean(staging: DataFrame, history_reports: DataFrame | None = None) -> DataFrame:
    """Typed, canonical and keyed rows; one chain of projections."""
    c = F.col
    lat, lon = bounded_pair(safe_double(c("latitude")), safe_double(c("longitude")), BOX)
    typed = owned_rows(staging, history_reports).select(
        row_json(*HASHED).alias("row_json"), "socrata_id", "socrata_version", c("socrata_updated_at").try_cast("timestamp").alias("socrata_updated_at"),
        F.lit(OWNED).alias("source_dataset"), c("reportnumber").alias("instanceid"), c("reportnumber").alias("localreportno"),
        safe_datetime(c("eventdate")).alias("crash_datetime"), safe_datetime(c("reportdate")).alias("reported_datetime"),
        *(n for n in KEYED if n != "address"),
        *(F.replace(strip_code(c(n), p), F.lit("LIGHTIED"), F.lit("LIGHTED")).alias(k) if k == "light_lbl" else strip_code(c(n), p).alias(k) for k, (n, p) in LABELS.items()),
        mask_block(c("address")).alias("address"), lat.alias("latitude"), lon.alias("longitude"),
        *(F.lit(None).cast("string").alias(n) for n in _ABSENT),
        null_if_blank(c("snaneighborhood")).alias("neighborhood"), F.lit(None).cast("long").alias("age"), "agerange",
    )
    canonical = typed.select(
        "*", *(ladder.column(c(n)).alias(k) for k, (ladder, n) in CANONICAL.items()),
        F.when(c("crashloc_lbl") != "", word_initcap(c("crashloc_lbl"))).alias("crash_location"),
        F.lit("Unknown").alias("unit_category"), L.age_range(c("agerange")).alias("age_range"), L.coding_era(c("crash_datetime")).alias("coding_era"),
    )
    return canonical.select(
        "*", L.ranked(c("injury_severity"), L.INJURY_RANK).cast("long").alias("injury_severity_rank"), L.injury_code(c("injury_severity")).alias("injury_severity_code"),
        L.ranked(c("crash_severity"), L.SEVERITY_RANK).cast("long").alias("crash_severity_rank"), c("age_range").alias("age_band"), L.age_sort(c("age_range")).cast("long").alias("age_band_sort"),
        natural_key(c("lightconditionsprimary"), c("roadconditionsprimary"), c("roadcontour"), c("roadsurface"), c("weather")).alias("conditions_nk"),
        natural_key(c("mannerofcrash"), c("coding_era"), c("crashseverity")).alias("crash_type_nk"),
        natural_key(c("typeofperson"), c("unittype"), c("gender"), c("age_range"), c("injuries")).alias("person_profile_nk"),
        F.md5(natural_key(*(c(n) for n in ("address", "zip", "community_council_neighborhood", "cpd_neighborhood", "sna_neighborhood", "road_class_code", "road_class_desc", "crashlocation")))).alias("location_nk"),
    )
