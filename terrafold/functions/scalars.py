"""Scalar rules as column expressions; each takes columns (or names) and returns a column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_name(name: Column | str) -> Column:
    """Hybrid markers out and ends trimmed; null for what isn't a binomial. The marker pattern also takes
    an `x` inside a word, which is part of the rule."""
    s = F.trim(F.regexp_replace(_c(name), r"\s*[×x]\s*", " "))
    return F.when((s == "NA") | (s == "") | s.startswith("(") | s.startswith("[") | ~s.contains(" "), None).otherwise(s)


def mark_offset(mark: Column | str) -> Column:
    """Metres from the middle of a 10 m rope; `C` is the middle; what isn't a number gives null."""
    tag = F.trim(F.regexp_replace(_c(mark), "[LR]+$", ""))
    return F.when(F.upper(tag) == "C", F.lit(0e0)).otherwise(tag.try_cast("double") - 5)


def density_to_cover(density: Column | str) -> Column:
    """Positive densities; zero, negative and NaN say nothing."""
    v = _c(density).cast("double")
    return F.when((v > 0) & ~F.isnan(v), v)


def clean_date(value: Column | str, since: int = 1990) -> Column:
    """ISO date of a timestamp text; null if it can't be read or is before `since`."""
    ts = F.try_to_timestamp(_c(value).cast("string"))
    return F.when(F.year(ts) >= since, F.date_format(ts, "yyyy-MM-dd"))


def year_or(value: Column | str, default: int = 2023) -> Column:
    return F.coalesce(F.year(F.try_to_timestamp(_c(value).cast("string"))), F.lit(default))


def coordinate_id(prefix: str, lon: Column | str, lat: Column | str, *rest: Column) -> Column:
    return F.concat_ws(":", F.lit(prefix), F.format_string("%.6f", _c(lon)), F.format_string("%.6f", _c(lat)), *rest)


def at_least(value: Column | str, low, keep_null: bool) -> Column:
    """value >= low, with an explicit rule for nulls."""
    v = _c(value)
    return (v.isNull() | (v >= low)) if keep_null else F.coalesce(v >= low, F.lit(False))


def at_most(value: Column | str, high, keep_null: bool) -> Column:
    v = _c(value)
    return (v.isNull() | (v <= high)) if keep_null else F.coalesce(v <= high, F.lit(False))


def contains_any(value: Column | str, fragments: list[str]) -> Column:
    """Any literal fragment, case-sensitive; null holds none."""
    return F.coalesce(reduce(lambda a, b: a | b, [_c(value).contains(f) for f in fragments], F.lit(False)), F.lit(False))


def lookup(key: Column | str, table: dict) -> Column:
    """Null where the table lacks the key."""
    if not table:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), _c(key))


def require(value: Column, message: str, detail: Column | str) -> Column:
    """The value; a null stops the query with the message."""
    return F.coalesce(value, F.raise_error(F.concat(F.lit(message), F.coalesce(_c(detail).cast("string"), F.lit("null")))).cast("string"))


def valid_or_null(value: Column | str) -> Column:
    """NaN and infinities become null, so that aggregates skip them."""
    v = _c(value)
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)
