"""A verified, paged extract of a feed into all-string staging.

A feed is anything with ``metadata()`` (columns, publish stamp) and ``page(where, offset, limit)`` (rows ordered by
id). Pages are written as JSON Lines and read with a fixed schema, so a field that the feed leaves out is NULL.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpanel.schema import STAGING_COLUMNS

SYSTEM = {":id": "socrata_id", ":version": "socrata_version", ":created_at": "socrata_created_at", ":updated_at": "socrata_updated_at"}
SOURCE_COLUMNS = tuple({v: k for k, v in SYSTEM.items()}.get(c, c) for c in STAGING_COLUMNS)
ATTEMPTS = 3


class InvalidSnapshot(RuntimeError):
    """The extract isn't one whole publish of the feed."""


@dataclass(frozen=True)
class Manifest:
    expected_rows: int
    publish_stamp: str
    since: str | None
    rows_updated_at: int | None = None


class RetryingSession:
    """POSTs with a bounded number of repeats on 429 and 5xx. ``post``: (url, body) -> (status, value)."""

    def __init__(self, post: Callable, attempts: int = 5, wait: Callable[[float], None] = time.sleep):
        self.post, self.attempts, self.wait = post, attempts, wait

    def __call__(self, url: str, body: dict):
        for k in range(self.attempts):
            status, value = self.post(url, body)
            if status < 400:
                return value
            if status != 429 and status < 500:
                raise InvalidSnapshot(f"the feed answered {status}")
            if k + 1 < self.attempts:
                self.wait(0.5 * 2**k)
        raise InvalidSnapshot(f"the feed answered {status}, {self.attempts} times")


class FileFeed:
    """A feed kept as JSON Lines files, for tests and replays."""

    def __init__(self, rows: Iterable[dict], stamp: int = 1, columns: Iterable[str] = SOURCE_COLUMNS):
        self.rows, self.stamp, self.columns, self.calls = sorted(rows, key=lambda r: str(r.get(":id"))), stamp, list(columns), 0

    def metadata(self) -> dict:
        self.calls += 1
        return {"columns": self.columns, "rows_updated_at": self.stamp}

    def _where(self, since: str | None) -> list[dict]:
        return [r for r in self.rows if since is None or (r.get("eventdate") or "") >= since]

    def probe(self, since: str | None) -> dict:
        self.calls += 1
        rows = self._where(since)
        stamps = [r[":updated_at"] for r in rows if r.get(":updated_at")]
        return {"count": len(rows), "stamped": len(stamps), "low": min(stamps, default=None), "high": max(stamps, default=None)}

    def page(self, since: str | None, offset: int, limit: int) -> list[dict]:
        self.calls += 1
        return self._where(since)[offset : offset + limit]


def check_columns(meta: dict) -> list[str]:
    """Columns that the feed has beyond the known ones; a missing one or no valid stamp is an error."""
    missing = [c for c in SOURCE_COLUMNS if not c.startswith(":") and c not in meta["columns"]]
    if missing:
        raise InvalidSnapshot(f"The feed lacks {missing}")
    if not isinstance(meta.get("rows_updated_at"), int):
        raise InvalidSnapshot("The feed has no update stamp")
    return [c for c in meta["columns"] if c not in SOURCE_COLUMNS]


def check_since(since: str | None) -> str | None:
    if since is None:
        return None
    if not isinstance(since, str) or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", since):
        raise ValueError(f"since must be an ISO date, not {since!r}")
    return dt.date.fromisoformat(since).isoformat()


def check_frame(df: DataFrame, expected_rows: int, stamp: str) -> None:
    """Rows, required values, unique ids and one stamp, in one pass."""
    blank = lambda c: F.count_if(F.col(c).isNull() | (F.regexp_replace(c, r"\s", "") == "")).alias(c)
    got = df.agg(
        F.count("*").alias("n"), F.count_distinct("socrata_id").alias("ids"), blank("socrata_id"), blank("reportnumber"), blank("socrata_updated_at"),
        F.min("socrata_updated_at").alias("low"), F.max("socrata_updated_at").alias("high"),
    ).first()
    if got.n != expected_rows:
        raise InvalidSnapshot(f"Expected {expected_rows} rows, not {got.n}")
    if got.n == 0:
        raise InvalidSnapshot("The feed is empty")
    for c in ("socrata_id", "reportnumber", "socrata_updated_at"):
        if got[c]:
            raise InvalidSnapshot(f"{got[c]} rows without {c}")
    if got.ids != got.n:
        raise InvalidSnapshot("Repeated source IDs")
    if not got.low == got.high == stamp:
        raise InvalidSnapshot("Rows of more than one publish")


def staging_frame(df: DataFrame) -> DataFrame:
    """Source columns under their staging names, in order, all strings; NULL stays NULL, a missing column is NULL."""
    return df.select(*((F.col(f"`{s}`") if s in df.columns else F.lit(None)).cast("string").alias(c) for s, c in zip(SOURCE_COLUMNS, STAGING_COLUMNS)))


def fetch(spark: SparkSession, feed, folder: str, since: str | None = None, page_size: int = 50_000) -> tuple[DataFrame, Manifest]:
    """The whole feed (or its rows from a date on) as one verified publish, with its manifest.

    The extract starts again, up to three times, if the feed is republished meanwhile.
    """
    if not isinstance(page_size, int) or isinstance(page_size, bool) or page_size < 1:
        raise ValueError("page_size must be a positive integer")
    since = check_since(since)
    for attempt in range(ATTEMPTS):
        before = feed.metadata()
        check_columns(before)
        probe = feed.probe(since)
        if not probe["count"]:
            raise InvalidSnapshot("The feed is empty")
        if probe["stamped"] != probe["count"] or probe["low"] != probe["high"]:
            raise InvalidSnapshot("Rows without a stamp, or of more than one publish")
        pages = os.path.join(folder, f"pages-{attempt}")
        os.makedirs(pages, exist_ok=True)
        for k, offset in enumerate(range(0, probe["count"], page_size)):
            with open(os.path.join(pages, f"{k:06d}.json"), "w") as out:
                out.writelines(json.dumps(r) + "\n" for r in feed.page(since, offset, page_size))
        if feed.probe(since) != probe or feed.metadata() != before:
            continue
        raw = spark.read.schema(", ".join(f"`{c}` string" for c in SOURCE_COLUMNS)).json(pages)
        staged = staging_frame(raw)
        check_frame(staged, probe["count"], probe["low"])
        return staged, Manifest(probe["count"], probe["low"], since, before["rows_updated_at"])
    raise InvalidSnapshot(f"The feed changed during extraction, {ATTEMPTS} times")
