"""Assertions: a load or a build stops at the first that isn't true; NULL counts as false."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class LoadAborted(RuntimeError):
    pass


def require(condition: object, message: str) -> None:
    if condition is not True:
        raise LoadAborted(message)


def require_all(df: DataFrame, checks: dict[str, Column]) -> None:
    """Checks that are aggregates over one table, in one pass. Keys are the messages."""
    got = df.agg(*(c.alias(f"c{i}") for i, c in enumerate(checks.values()))).first()
    for i, message in enumerate(checks):
        require(got[i], message)


def require_none(df: DataFrame, message: str) -> None:
    require(df.isEmpty(), message)


def repeated(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def staging_checks(staging: DataFrame, fact: DataFrame, manifest, keyed: tuple[str, ...]) -> None:
    c = F.col
    joined = F.concat(*(F.coalesce(c(n), F.lit("")) for n in keyed))
    require_all(staging, {
        "Staging is empty.": F.count("*") > 0,
        "Staging has rows without an id, a report number or a publish stamp.": F.count_if(c("socrata_id").isNull() | c("reportnumber").isNull() | c("socrata_updated_at").isNull()) == 0,
        "Staging spans more than one publish.": F.count_distinct("socrata_updated_at") == 1,
        "Staging does not hold the rows that were verified for this run.": F.count("*") == manifest.expected_rows,
        "Staging is not the publish that was verified for this run.": F.bool_and(c("socrata_updated_at") == manifest.publish_stamp),
        "A natural-key value contains | or ~.": F.count_if(joined.rlike("[|~]")) == 0,
    })
    require_all(fact, {"The fact has rows without a source.": F.count_if(c("source_dataset").isNull()) == 0})
    require_none(repeated(staging.distinct(), "socrata_id"), "Staging holds one id with two contents.")


def completeness_check(cleaned: DataFrame, fact_owned: DataFrame, window_start, least: float = 0.9) -> None:
    """At least this share of the window's crashes and people is staged; people are counted before drivers are deduplicated."""
    staged = cleaned.agg(F.count_distinct("instanceid"), F.count_distinct("socrata_id")).first()
    window = fact_owned if window_start is None else fact_owned.where(F.col("crash_date") >= F.lit(window_start))
    known = window.agg(F.count_distinct("instanceid"), F.count("*")).first()
    require(staged[0] >= least * known[0] and staged[1] >= least * known[1], f"Staging holds {staged[0]} crashes and {staged[1]} people, but the fact has {known[0]} and {known[1]} in the load window.")


def not_in(left: DataFrame, right: DataFrame, column: str, other: str) -> DataFrame:
    """Rows of ``left`` for which SQL's ``column NOT IN (SELECT other FROM right)`` is true.

    An anti join by key, which may shuffle, and one row about ``right``: a null in it lets nothing through, and a
    null ``column`` passes only if it is empty.
    """
    keys = right.select(F.col(other).alias("__k"))
    about = keys.agg(F.count("*").alias("__n"), F.count_if(F.col("__k").isNull()).alias("__nulls"))
    kept = left.join(keys.where(F.col("__k").isNotNull()).distinct(), F.col(column) == F.col("__k"), "left_anti")
    return kept.join(about).where((F.col("__nulls") == 0) & (F.col(column).isNotNull() | (F.col("__n") == 0))).select(*left.columns)
