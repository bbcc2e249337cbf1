"""Subject codes: lists of them in text, defaults by area, evidence that a code needs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FULL = "[0-9]{2}[A-Z][0-9]{2}"

# The domain of each two-digit area; any other is algebra.
DOMAINS = {
    "number_theory": ("11", "12", "20"),
    "combinatorics": ("05", "60", "62", "68"),
    "calculus": ("26", "30", "34", "35"),
    "geometry": ("51", "52", "53", "54", "55", "57", "58"),
}


def default_domain(area: Column) -> Column:
    a = F.substring(F.lpad(F.coalesce(area, F.lit("00")), 2, "0"), 1, 2)
    out = F.lit("algebra")
    for name, areas in DOMAINS.items():
        out = F.when(a.isin(*areas), name).otherwise(out)
    return out


def default_code(area: Column) -> Column:
    """The area's two digits and A05."""
    return F.concat(F.substring(F.lpad(F.coalesce(area, F.lit("00")), 2, "0"), 1, 2), F.lit("A05"))


def code_list(value: Column, fallback: Column) -> Column:
    """Distinct codes of a text in order; a valid fallback that is not among them comes first."""
    found = F.regexp_extract_all(F.upper(F.coalesce(value, F.lit(""))), F.lit(f"({FULL})"), F.lit(1))
    own = F.upper(F.trim(F.coalesce(fallback, F.lit(""))))
    first = F.when(own.rlike(f"^{FULL}$") & ~F.array_contains(found, own), F.array(own)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(first, found))
