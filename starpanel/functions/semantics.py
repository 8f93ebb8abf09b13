"""Column functions where the warehouse dialect and Spark differ. No Python UDFs: each is one expression tree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean earth radius in metres.
EARTH_M = 6_371_008.8


def ws_trim(c: Column) -> Column:
    """TRIM of all white space; Spark's own strips spaces only."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def null_if_blank(c: Column) -> Column:
    return F.nullif(ws_trim(c), F.lit(""))


def strip_code(c: Column, prefix: str = r"\d+") -> Column:
    """A coded label without its leading code, in upper case: '3 - DUSK' gives 'DUSK'."""
    return F.upper(ws_trim(F.regexp_replace(c, rf"^\s*{prefix}\s*-\s*", "")))


def word_initcap(c: Column) -> Column:
    """INITCAP that starts a word after any character that isn't a letter or digit, '-' and '/' included."""
    chars = F.split(F.lower(c), r"(?<=[^\p{L}\p{N}])")
    return F.array_join(F.transform(chars, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1_000_000))), "")


def safe_datetime(c: Column) -> Column:
    """A zone-less timestamp, or NULL: text needs year, month and day."""
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"), F.try_to_timestamp(c).cast("timestamp_ntz"))


def safe_double(c: Column) -> Column:
    return c.try_cast("double")


def minute_boundaries(start: Column, end: Column) -> Column:
    """Minute boundaries between two zone-less timestamps, not elapsed minutes."""
    at = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / 60_000_000)
    return at(end) - at(start)


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def null_greatest(*cols: Column) -> Column:
    """GREATEST that is NULL if any argument is."""
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.greatest(*cols))


def row_json(*names: str) -> Column:
    """A struct's JSON text in field order, nulls kept."""
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def natural_key(*cols: Column) -> Column:
    """Parts joined by '|', NULL written '~'; loads reject values that hold either."""
    return F.concat_ws("|", *(F.coalesce(c, F.lit("~")) for c in cols))


def distance_m(lon: Column, lat: Column, lon0: float, lat0: float, digits: int = 1) -> Column:
    """Great-circle metres to a fixed point; NULL in, NULL out."""
    dlat, dlon = F.radians(lat - lat0), F.radians(lon - lon0)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat)) * F.cos(F.radians(F.lit(lat0))) * F.pow(F.sin(dlon / 2), 2)
    return F.round(2 * EARTH_M * F.asin(F.sqrt(h)), digits)


def bounded_pair(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> tuple[Column, Column]:
    """Both coordinates, or neither: (low lat, high lat, low lon, high lon), inclusive."""
    ok = lat.between(box[0], box[1]) & lon.between(box[2], box[3])
    return F.when(ok, lat), F.when(ok, lon)


def mask_block(c: Column, missing: str = "NOT APPLICABLE OR UNKNOWN") -> Column:
    """A street address at block level. Of a first word that is a number, the last two digits are masked (the only
    one, if it has one); of another first word, its last digit."""
    address = F.nullif(F.regexp_replace(F.upper(ws_trim(c)), r"\s+", " "), F.lit(""))
    word = F.substring_index(address, " ", 1)
    size = F.length(word)
    # Digits become one mark that no address holds; what follows the last mark has no digit.
    marked = F.translate(word, "0123456789", "\x01" * 10)
    tail = F.length(F.substring_index(marked, "\x01", -1))
    masked = (
        F.when(F.translate(word, "0123456789", "") == "", F.rpad(F.left(word, F.greatest(size - 2, F.lit(0))), size, "X"))
        .when(tail == size, word)
        .otherwise(F.concat(F.left(word, size - tail - 1), F.lit("X"), F.right(word, tail)))
    )
    return F.when(address != missing, F.concat(masked, F.substring(address, size + 1, F.length(address))))


def content_hash(json: Column) -> Column:
    """An aggregate: order-insensitive, multiplicity-sensitive hash of a group's rows."""
    return F.md5(F.array_join(F.array_sort(F.collect_list(json)), "\n"))


def unanimous(c: Column) -> Column:
    """An aggregate: the group's value if all rows share one that isn't NULL."""
    return F.when((F.min(c) == F.max(c)) & (F.count_if(c.isNull()) == 0), F.max(c))


def cell_name(c: Column) -> Column:
    return F.when(~F.upper(c).isin("N/A", "UNKNOWN OR OUTSIDE OF CITY LIMITS"), F.upper(c))


def matches_prior(a: Column, b: Column) -> Column:
    return F.coalesce((a.isNull() & b.isNull()) | (F.abs(a - b) < 1e-9), F.lit(False))
