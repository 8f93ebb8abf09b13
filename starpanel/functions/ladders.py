"""Declarative label ladders: ordered rules that fold into one CASE expression.

A rule is (kind, pattern, label); the first that holds wins. Kinds: ``like`` and ``eq``. The rules serve Spark and
the SQL of the checks alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ladder:
    rules: tuple[tuple[str, str, str], ...]
    fallback: str
    #: What NULL and empty labels become; None: they go through the rules.
    blank: str | None = "Unknown"

    def column(self, c: Column) -> Column:
        out = F.when(c.isNull() | (c == ""), self.blank) if self.blank is not None else None
        for kind, pattern, label in self.rules:
            test = c.like(pattern) if kind == "like" else c == pattern
            out = F.when(test, label) if out is None else out.when(test, label)
        return out.otherwise(self.fallback)

    def sql(self, c: str) -> str:
        q = lambda s: "'" + s.replace("'", "''") + "'"
        whens = [f"WHEN {c} IS NULL OR {c} = '' THEN {q(self.blank)}"] if self.blank is not None else []
        whens += [f"WHEN {c} {'LIKE' if k == 'like' else '='} {q(p)} THEN {q(v)}" for k, p, v in self.rules]
        return f"CASE {' '.join(whens)} ELSE {q(self.fallback)} END"


def _starts(*pairs: tuple[str, str]) -> tuple[tuple[str, str, str], ...]:
    return tuple(("like", f"{p}%", v) for p, v in pairs)


# Labels of both coding eras and what they are called here.
LIGHT = Ladder((
    *_starts(("DAYLIGHT", "Daylight"), ("DAWN", "Dawn"), ("DUSK", "Dusk")),
    *_starts(("DARK%NOT LIGHTED", "Dark - Not Lighted"), ("DARK%UNKNOWN", "Dark - Unknown Lighting"), ("DARK%LIGHTED", "Dark - Lighted"), ("DARK", "Dark - Unknown Lighting")),
    *_starts(("UNKNOWN", "Unknown")),
), "Other")
ROAD_CONDITION = Ladder(_starts(
    ("DRY", "Dry"), ("WET", "Wet"), ("SNOW", "Snow"), ("ICE", "Ice"), ("SLUSH", "Slush"),
    ("WATER", "Standing/Moving Water"), ("SAND", "Sand/Mud/Dirt/Oil/Gravel"), ("UNKNOWN", "Unknown"),
), "Other")
CONTOUR = Ladder(tuple(("eq", v.upper(), v) for v in ("Straight Level", "Straight Grade", "Curve Level", "Curve Grade")), "Unknown")
SURFACE = Ladder(_starts(
    ("BLACKTOP", "Blacktop/Asphalt"), ("CONCRETE", "Concrete"), ("BRICK", "Brick/Block"),
    ("SLAG", "Slag/Gravel/Stone"), ("DIRT", "Dirt"), ("UNKNOWN", "Unknown"),
), "Other")
WEATHER = Ladder(_starts(
    ("CLEAR", "Clear"), ("CLOUDY", "Cloudy"), ("RAIN", "Rain"), ("SNOW", "Snow"), ("FREEZING", "Freezing Rain/Drizzle"),
    ("SLEET", "Sleet/Hail"), ("FOG", "Fog/Smog/Smoke"), ("SEVERE CROSSWINDS", "Severe Crosswinds"), ("BLOWING", "Blowing Sand/Soil/Dirt/Snow"),
), "Other/Unknown")
MANNER = Ladder(_starts(
    ("ANGLE", "Angle"), ("REAR-END", "Rear-End"), ("REAR-TO-REAR", "Rear-to-Rear"), ("HEAD-ON", "Head-On"), ("BACKING", "Backing"),
    ("SIDESWIPE, SAME", "Sideswipe - Same Direction"), ("SIDESWIPE, OPPOSITE", "Sideswipe - Opposite Direction"),
    ("NOT COLLISION", "Not Collision Between Two Motor Vehicles"),
), "Unknown")
SEVERITY = Ladder((
    *_starts(("FATAL", "Fatal"), ("SERIOUS INJURY", "Serious Injury Suspected"), ("MINOR INJURY", "Minor Injury Suspected"), ("INJURY POSSIBLE", "Possible Injury")),
    ("eq", "INJURY", "Injury (Severity Unspecified)"), ("eq", "NONFATAL INJURY", "Injury (Severity Unspecified)"),
    *_starts(("PROPERTY DAMAGE ONLY", "Property Damage Only")),
), "Unknown")
INJURY = Ladder(_starts(
    ("FATAL", "K - Fatal"), ("INCAPACITATING", "A - Suspected Serious"), ("SUSPECTED SERIOUS", "A - Suspected Serious"),
    ("NON-INCAPACITATING", "B - Suspected Minor"), ("SUSPECTED MINOR", "B - Suspected Minor"), ("POSSIBLE", "C - Possible"), ("NO ", "O - No Apparent Injury"),
), "Unknown")
PERSON = Ladder(_starts(("DRIVER", "Driver"), ("OCCUPANT", "Occupant"), ("PEDESTRIAN", "Pedestrian")), "Unknown")
GENDER = Ladder(_starts(("M", "Male"), ("F", "Female")), "Unknown")

SEVERITY_RANK = {"Fatal": 5, "Serious Injury Suspected": 4, "Minor Injury Suspected": 3, "Injury (Severity Unspecified)": 3, "Possible Injury": 2, "Property Damage Only": 1}
INJURY_RANK = {"K - Fatal": 5, "A - Suspected Serious": 4, "B - Suspected Minor": 3, "C - Possible": 2, "O - No Apparent Injury": 1}
AGE_RANGES = ("00-15", "16-19", "20-24", "25-34", "35-44", "45-54", "55-64", "65-74", "75+")
#: Least exact age of each range.
AGE_CUTS = (0, 16, 20, 25, 35, 45, 55, 65, 75)
ERA_CUT = "2019-01-01"


def ranked(c: Column, ranks: dict[str, int], default: int = 0) -> Column:
    out = None
    for label, rank in ranks.items():
        out = F.when(c == label, rank) if out is None else out.when(c == label, rank)
    return out.otherwise(default)


def injury_code(severity: Column) -> Column:
    return F.when(severity == "Unknown", "U").otherwise(F.substring(severity, 1, 1))


def age_range(c: Column) -> Column:
    trimmed = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.when(F.upper(trimmed) == "15 OR UNDER", AGE_RANGES[0]).when(trimmed.isin(*AGE_RANGES[1:]), trimmed).otherwise("Unknown")


def age_band(age: Column) -> Column:
    """The range of an exact age."""
    out = F.when(age.isNull(), "Unknown")
    for label, least in reversed(list(zip(AGE_RANGES, AGE_CUTS))[1:]):
        out = out.when(age >= least, label)
    return out.otherwise(AGE_RANGES[0])


def age_sort(c: Column) -> Column:
    return ranked(c, {a: i for i, a in enumerate(AGE_RANGES, 1)}, 99)


def coding_era(at: Column) -> Column:
    return F.when(at.isNull(), "Unknown").when(at < F.lit(ERA_CUT).cast("timestamp_ntz"), "Pre-2019").otherwise("2019+")
