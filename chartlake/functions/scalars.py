"""Scalar Column expressions of the loaders and marts (SC-3 ... SC-30).

Every function returns a built-in Spark expression, so it stays inside
whole-stage codegen; no Python UDF anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartlake import config as C
from chartlake.functions.calendar import as_col
from chartlake.schemas import GENRES_DDL


# --- unit conversions --------------------------------------------------------

def seconds_to_hours(s) -> Column:
    """Sunshine seconds -> hours; 0 and NULL both give NULL (SC-3)."""
    return F.nullif(as_col(s), F.lit(0.0)) / 3600.0


def seconds_to_ms(s) -> Column:
    """Seconds -> integer milliseconds, truncated toward zero, NULL-safe (SC-4)."""
    return (as_col(s) * 1000).cast("int")


def nullable_int(x) -> Column:
    """Lenient integer cast: NULL stays NULL, unparsable text becomes NULL (SC-5)."""
    return as_col(x).try_cast("int")


def with_default(x, default: str) -> Column:
    """NULL or missing -> default (SC-6)."""
    return F.coalesce(as_col(x), F.lit(default))


def zero_if_null(x) -> Column:
    """``or 0`` on an aggregate (SC-7)."""
    return F.coalesce(as_col(x), F.lit(0))


# --- JSON ------------------------------------------------------------------

def genre_root(genres_text) -> Column:
    """First genre's ``root`` from JSON text (SC-10).

    Invalid JSON, NULL and ``[]`` give NULL; a non-empty list whose first
    element has no ``root`` gives ``''``.
    """
    parsed = F.from_json(as_col(genres_text), GENRES_DDL)
    first = F.try_element_at(parsed, F.lit(1))
    return F.when(F.size(parsed) > 0, F.coalesce(first.getField("root"), F.lit("")))


def genre_list_non_empty(genres_text) -> Column:
    """True when the text parses to a non-empty JSON list (SC-10 guard)."""
    return F.coalesce(F.size(F.from_json(as_col(genres_text), GENRES_DDL)) > 0, F.lit(False))


def any_not_null(*cols) -> Column:
    """True when at least one of the columns is not NULL (SC-12)."""
    checks = [as_col(c).isNotNull() for c in cols]
    out = checks[0]
    for c in checks[1:]:
        out = out | c
    return out


# --- labels and buckets ----------------------------------------------------------

def note_name(key, mode) -> Column:
    """Key code 0..11 plus mode -> ``C``, ``C#m`` ... (SC-13, SC-14).

    Keys outside 0..11 give NULL; an unknown mode gives no suffix.
    """
    names = F.array(*[F.lit(n) for n in C.NOTE_NAMES])
    k = as_col(key)
    name = F.when(k.between(0, len(C.NOTE_NAMES) - 1), F.element_at(names, (k + 1).cast("int")))
    m = as_col(mode)
    suffix = F.when(m == 0, F.lit(C.MINOR_SUFFIX)).when(m == 1, F.lit(""))
    return F.concat(name, F.coalesce(suffix, F.lit("")))


def sunshine_bucket(hours, labels: C.Labels = C.Labels(), null_bucket: str | None = None) -> Column:
    """Sunshine hours -> bucket (SC-15).

    SQL three-valued logic: a NULL matches no WHEN, so by default it lands in
    the last bucket exactly as a CASE ... ELSE does.
    """
    h = as_col(hours)
    e1, e2, e3 = C.SUNSHINE_EDGES
    expr = F.when(h.isNull(), F.lit(null_bucket)) if null_bucket is not None else None

    def _w(cond, val):
        nonlocal expr
        expr = F.when(cond, F.lit(val)) if expr is None else expr.when(cond, F.lit(val))

    _w(h == 0, labels.sun_dark)
    _w(h < e1, labels.sun_1_4)
    _w(h < e2, labels.sun_4_8)
    _w(h < e3, labels.sun_8_12)
    return expr.otherwise(F.lit(labels.sun_12))


def acoustic_type(acousticness, labels: C.Labels = C.Labels()) -> Column:
    """> 0.7 acoustic, < 0.3 electronic, else hybrid (SC-16)."""
    a = as_col(acousticness)
    return (
        F.when(a > C.ACOUSTIC_HIGH, F.lit(labels.acoustic))
        .when(a < C.ACOUSTIC_LOW, F.lit(labels.electronic))
        .otherwise(F.lit(labels.hybrid))
    )


def day_weather(precipitation_mm, sunshine_hours, labels: C.Labels = C.Labels()) -> Column:
    """Rain if > 5 mm, else sun if > 8 h, else NULL (no ELSE branch) (SC-17)."""
    return F.when(as_col(precipitation_mm) > C.RAIN_MM, F.lit(labels.rain)).when(
        as_col(sunshine_hours) > C.SUN_HOURS, F.lit(labels.sun)
    )


def week_weather(avg_precipitation, avg_sunshine, labels: C.Labels = C.Labels()) -> Column:
    """Weekly category: rain > 5 mm first, then sunshine > 12 h, then > 8 h,
    else NULL (the week is dropped) (SC-18)."""
    p, s = as_col(avg_precipitation), as_col(avg_sunshine)
    return (
        F.when(p > C.RAIN_MM, F.lit(labels.week_rain))
        .when(s > C.VERY_SUNNY_HOURS, F.lit(labels.week_very_sunny))
        .when(s > C.SUN_HOURS, F.lit(labels.week_sunny))
    )


def label_rank(label, order: tuple[str, ...]) -> Column:
    """Custom category order as a sort key (SC-29); unknown labels last."""
    c = as_col(label)
    expr = None
    for i, name in enumerate(order):
        expr = F.when(c == name, F.lit(i)) if expr is None else expr.when(c == name, F.lit(i))
    return expr.otherwise(F.lit(len(order)))


# --- numbers ----------------------------------------------------------------------

def compact_count(x) -> Column:
    """``12.0M`` when strictly above one million, else ``345.0K``; the integer
    part is truncated before formatting (SC-19)."""
    v = as_col(x)
    millions = (v.cast("double") / 1e6).cast("long")
    thousands = (v.cast("double") / 1e3).cast("long")
    return F.when(v > 1_000_000, F.concat(millions.cast("string"), F.lit(".0M"))).otherwise(
        F.concat(thousands.cast("string"), F.lit(".0K"))
    )


def thousands_label(x) -> Column:
    """Per-track ``123K`` label (integer part of x / 1000)."""
    return F.concat((as_col(x).cast("double") / 1e3).cast("long").cast("string"), F.lit("K"))


def number_label(x, digits: int = 0) -> Column:
    """``1,234.5``: thousands separators and a fixed number of decimals (SC-24),
    halves by the exact binary value to the even digit (0.25 is 0.2), NULL for NULL."""
    return F.format_number(as_col(x).cast("double"), digits)


def ratio(part, whole) -> Column:
    """part / whole as double, NULL when whole is 0 or NULL."""
    return F.try_divide(as_col(part).cast("double"), as_col(whole).cast("double"))


def percent_of(part, whole) -> Column:
    """part / whole * 100, NULL when whole is 0 or NULL (SC-20)."""
    return ratio(part, whole) * 100.0


def change_pct(current, previous) -> Column:
    """(cur - prev) / prev * 100; 0 when prev is 0 or NULL (SC-21)."""
    cur, prev = as_col(current), as_col(previous)
    return F.when(F.coalesce(prev, F.lit(0.0)) == 0, F.lit(0.0)).otherwise((cur - prev) / prev * 100.0)


def trend_label(change, threshold, labels: C.Labels = C.Labels()) -> Column:
    """|d| < threshold -> flat, d > 0 -> up, else down (SC-22); the threshold
    may be a number or a Column (per-row thresholds)."""
    d = as_col(change)
    return F.when(F.abs(d) < threshold, F.lit(labels.flat)).when(d > 0, F.lit(labels.up)).when(
        d.isNotNull(), F.lit(labels.down)
    )
