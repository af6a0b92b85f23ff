"""Column expressions: money, dates, buckets, lenient casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- money -----------------------------------------------------------------


def line_revenue(gross: Column | str, discount: Column | str) -> Column:
    """gross * (1 - discount) with the discount as a fraction.

    decimal(12,2) * decimal(5,2) is decimal(18,4): exact, and still small
    enough for Spark to keep each value in one 64-bit word.
    """
    return (_c(gross).cast(MONEY) * (F.lit(1) - _c(discount).cast(RATE))).cast("decimal(18,4)")


def cents(col: Column | str) -> Column:
    """A two-decimal amount held as double, in whole cents."""
    return F.rint(_c(col) * F.lit(100.0)).cast("long")


def money_sum(units: Column | str, scale: int) -> Column:
    """Exact sum of amounts held as whole 10^-scale units, as a decimal.

    Adding decimals allocates an object per row.  Here the high and the low 20 bits are
    added as two plain integers: the high part cannot overflow before the total passes
    10^24 units, the low part not before 8 * 10^12 rows.
    """
    u = _c(units)
    high, low = F.sum(F.shiftright(u, 20)), F.sum(u.bitwiseAND(F.lit((1 << 20) - 1)))
    total = high.cast("decimal(19,0)") * F.lit(1 << 20) + low.cast("decimal(19,0)")
    return (total * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(34,{scale})")


def rounded(col: Column | str, digits: int = 2) -> Column:
    """Round half away from zero and hand the value out as a double."""
    return F.round(_c(col), digits).cast("double")


def mean_of(total: Column | str, count: Column | str, digits: int | None = 2) -> Column:
    """total / count in double arithmetic; NULL when there is nothing to count."""
    value = F.try_divide(_c(total).cast("double"), _c(count).cast("double"))
    return value if digits is None else F.round(value, digits)


def pct(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    return F.round(
        F.try_divide(_c(part).cast("double") * F.lit(100.0), _c(whole).cast("double")), digits
    )


def growth_pct(current: Column | str, previous: Column | str, digits: int = 2) -> Column:
    """Change against the previous value in percent; NULL if that is NULL or 0."""
    cur, prev = _c(current).cast("double"), _c(previous).cast("double")
    return F.when(prev != 0, F.round((cur - prev) * F.lit(100.0) / prev, digits))


# --- dates -----------------------------------------------------------------


def month_start(date: Column | str) -> Column:
    """First day of the month: a cheap integer-like grouping key."""
    return F.trunc(_c(date), "MM")


def year_month(date: Column | str) -> Column:
    return F.date_format(_c(date), "yyyy-MM")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_c(later), _c(earlier))


def month_offset(days: Column | str) -> Column:
    """Whole 30-day periods in a number of days."""
    return F.floor(_c(days) / F.lit(30)).cast("long")


def in_year(date: Column | str, year: int) -> Column:
    """A year test as a half-open range, so the scan can use file statistics."""
    return (_c(date) >= F.lit(f"{year:04d}-01-01").cast("date")) & (
        _c(date) < F.lit(f"{year + 1:04d}-01-01").cast("date")
    )


# --- buckets ---------------------------------------------------------------


def bucketize(
    col: Column | str,
    bounds: Sequence,
    labels: Sequence,
    closed: str = "right",
    null_label=None,
) -> Column:
    """Ordered thresholds to labels; `labels` has one entry more than `bounds`.

    closed="right" puts a value equal to a bound below it, "left" above it.
    NULL falls into the last label unless `null_label` names another one.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one label more than bounds")
    value = _c(col)
    out = None
    if null_label is not None:
        out = F.when(value.isNull(), F.lit(null_label))
    for bound, label in zip(bounds, labels):
        cond = value <= F.lit(bound) if closed == "right" else value < F.lit(bound)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(labels[-1]) if out is None else out.otherwise(F.lit(labels[-1]))


def price_tier(price: Column | str, low=1000, high=3000) -> Column:
    """Below `low`, `low`..`high` closed, above `high`; NULL stays NULL."""
    p = _c(price)
    return (
        F.when(p < F.lit(low), "Budget")
        .when(p.between(F.lit(low), F.lit(high)), "Mid-Range")
        .when(p > F.lit(high), "Premium")
    )


def label_of(col: Column | str, labels: Mapping) -> Column:
    """Simple CASE: value to label, NULL on a miss."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])[_c(col)]


def canonical(col: Column | str, synonyms: Mapping[str, str]) -> Column:
    """Map lower/trimmed text through `synonyms`; unknown text is kept as it is."""
    return F.coalesce(label_of(F.lower(F.trim(_c(col))), synonyms), _c(col))


def flag(col: Column | str) -> Column:
    """1 where the source says 1, else 0 (NULL included)."""
    return F.when(_c(col) == 1, 1).otherwise(0)


# --- lenient conversions (the session is ANSI, plain casts raise) ------------


def to_number(col: Column | str, kind: str = "double") -> Column:
    """Trimmed text to a number, NULL where it is none."""
    return F.trim(_c(col)).try_cast(kind)


def to_day(col: Column | str) -> Column:
    """Text with a date, or a timestamp, at the front to a date; NULL if malformed."""
    text = F.trim(_c(col))
    return F.to_date(text.try_cast("timestamp"))


def parse_day(col: Column | str, pattern: str = "M/d/yyyy") -> Column:
    return F.to_date(F.try_to_timestamp(_c(col), F.lit(pattern)))


def parse_currency(col: Column | str, symbol: str = "₹", kind: str = MONEY) -> Column:
    """Strip the symbol, thousands commas, quotes and blanks, then to a number."""
    text = F.translate(_c(col), f'{symbol},"', "")
    return F.trim(text).try_cast(kind)


def clip(col: Column | str, low, high, null_value) -> Column:
    """Force into [low, high]; NULL becomes `null_value`."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(null_value)).otherwise(
        F.least(F.greatest(c, F.lit(low)), F.lit(high))
    )


def null_or(col: Column | str, cond: Column) -> Column:
    """Range checks let NULL through."""
    return _c(col).isNull() | cond


def is_blank(col: Column | str) -> Column:
    c = _c(col)
    return c.isNull() | (F.trim(c.cast("string")) == "")
