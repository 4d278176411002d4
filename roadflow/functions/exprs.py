"""Column expressions shared by all reports.

Two rounding families exist: SQL reports round half away from zero on
exact values (``F.round``); pandas-style analyses round half to even
(``F.bround``).  Ratios never raise on zero denominators: they are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MONTH_NAMES, ROAD_LABELS


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c) -> Column:
    return col_(c).cast("double")


def sum_d(c) -> Column:
    """Exact sum of a decimal/integer measure, exposed as double."""
    return F.sum(col_(c)).cast("double")


def avg_d(c, digits: int = 6) -> Column:
    """Mean over rows as double, rounded so engines agree on the last bits."""
    return F.round(F.avg(dbl(c)), digits)


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (SQL ``NULLIF`` guard)."""
    return F.try_divide(dbl(num), F.nullif(dbl(den), F.lit(0.0)))


def pct(num, den, digits: int | None = 2, half_even: bool = False) -> Column:
    """``num * 100 / den`` rounded; NULL on a zero denominator."""
    value = safe_div(dbl(num) * F.lit(100.0), den)
    if digits is None:
        return value
    return F.bround(value, digits) if half_even else F.round(value, digits)


def growth_pct(cur, prev, digits: int = 2) -> Column:
    """``(cur - prev) * 100 / prev`` rounded; NULL when prev is 0 or NULL."""
    return F.round(safe_div((dbl(cur) - dbl(prev)) * F.lit(100.0), prev), digits)


def divide_or_zero(num, den) -> Column:
    """Safe division with a default of 0 (the BI-tool DIVIDE)."""
    return F.coalesce(safe_div(num, den), F.lit(0.0))


def parse_double(c) -> Column:
    """Text -> double, NULL unless it is a plain decimal number.

    The cast itself also takes ``1d``, ``nan``, ``Infinity`` and hexadecimal
    numbers; a plain number ends in a digit or a point and holds no x."""
    s = F.trim(col_(c))
    odd = F.contains(s, F.lit("x")) | F.contains(s, F.lit("X"))
    return F.when(F.right(s, F.lit(1)).between(".", "9") & ~odd, s.try_cast("double"))


def parse_exact(c, dtype: str, target: str) -> Column:
    """Text or number -> ``target`` (a decimal type), exactly as written; NULL if it is no number, or one
    too large for the type: :func:`over_range` finds the rows that hold such a number."""
    return (F.trim(col_(c)) if dtype == "string" else col_(c)).try_cast(target)


def over_range(c: str, dtype: str, target: str) -> Column:
    """Whether a positive measure is too large for the decimal type ``target`` (and so parses to NULL)."""
    if dtype != "string":
        # NaN is greater than any number, but is none.
        return F.col(c).try_cast(target).isNull() & F.coalesce((dbl(c) > 0) & ~F.isnan(dbl(c)), F.lit(False))
    return F.coalesce(_may_be_large(F.col(c)), F.lit(False)) & _too_large(F.col(c), target)


def _may_be_large(text: Column) -> Column:
    """Only long texts and those with an exponent can be too large; the rest need not be parsed."""
    return (F.length(text) > 15) | F.contains(F.lower(text), F.lit("e"))


def _too_large(text: Column, target: str) -> Column:
    return F.trim(text).try_cast(target).isNull() & F.coalesce(parse_double(text) > 0, F.lit(False))


def any_text_over_range(cols: list[str], target: str) -> Column:
    """:func:`over_range` of any of several text measures, which are parsed only in rows where one may be.

    One test of the whole row and one parse, written once: spelled out for each measure they make a method that the
    JVM does not compile, and cost several times the load."""
    longest = F.greatest(F.lit(0), *[F.length(c) for c in cols])
    may = (longest > 15) | F.contains(F.lower(F.concat_ws("", *cols)), F.lit("e"))
    large = F.exists(F.array(*cols), lambda t: F.coalesce(_may_be_large(t), F.lit(False)) & _too_large(t, target))
    return F.when(may, large).otherwise(F.lit(False))


def coerce_measure(c: str, dtype, target: str = "double") -> Column:
    """Text or number -> non-negative number of type ``target``; unparsable
    values become 0.  Text is parsed straight into the target type (no double
    round trip for decimals).  Decimals out of range also become 0: callers
    set such rows apart first (:func:`over_range`)."""
    if dtype != "string":
        parsed = F.col(c).try_cast(target)
    elif target == "double":
        parsed = parse_double(c)
    else:
        parsed = F.trim(F.col(c)).try_cast(target)
    zero = F.lit(0).cast(target)
    if target == "double":
        parsed = F.nanvl(parsed, zero)
    value = F.coalesce(parsed, zero)
    return F.greatest(value, zero)


def literal_map(mapping: dict) -> Column:
    """A literal map column; lookups of unknown keys give NULL."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def road_label(c) -> Column:
    return F.try_element_at(literal_map(ROAD_LABELS), col_(c))


def month_name(c) -> Column:
    return F.try_element_at(literal_map(MONTH_NAMES), col_(c))


def hour_label(c) -> Column:
    h = col_(c).cast("int")
    return F.format_string("%02d:00-%02d:00", h, h + 1)


def year_filter(c, year=None, since=None, between=None, years=None) -> Column:
    """Predicate on a year column (partition column in the fact)."""
    cond = F.lit(True)
    c = col_(c)
    if year is not None:
        cond = cond & (c == F.lit(year))
    if since is not None:
        cond = cond & (c >= F.lit(since))
    if between is not None:
        cond = cond & c.between(between[0], between[1])
    if years is not None:
        cond = cond & c.isin(list(years))
    return cond


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Output projection: decimal columns exposed as double."""
    return df.select(*[F.col(f"`{c}`").cast("double").alias(c) if t.startswith("decimal") else F.col(f"`{c}`")
                       for c, t in df.dtypes])
