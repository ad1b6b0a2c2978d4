"""Column helpers shared by every layer.

Numeric conventions (applied identically in the SQL oracle):

* money stays ``decimal(18,2)`` per row and is summed exactly into
  ``decimal(38,2)``; it is cast to double only before a division;
* ratios and means are doubles; an average of money is ``sum / count``;
* doubles are summed exactly (``exact_sum``), so no partitioning changes a bit of a sum or a mean;
* rounding of doubles is half away from zero with a 1e-9 nudge so that values
  such as 1.005 round the same way in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"
ROUND_NUDGE = 1e-9


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_up(col, scale: int) -> Column:
    """Round a double half away from zero (nudged, see module docstring)."""
    c = _c(col).cast("double")
    return F.round(c + F.signum(c) * F.lit(ROUND_NUDGE), scale)


def money_sum(col) -> Column:
    return F.sum(_c(col)).cast(MONEY_SUM)


#: Fixed-point parts of a double: whole, then twice so many bits of its fraction.
FRACTION_BITS = 30


def exact_sum(col) -> Column:
    """Sum of doubles that doesn't depend on the order of the rows (null on no rows).

    A value is cut into its whole part and two runs of 30 bits of its fraction (bits below 2^-60 are cut
    off per value); each is summed as a long. Values of 2^40 and more, infinite ones and NaN are summed as
    doubles beside. Longs bound a group to some 2^33 rows; beyond, the sum raises instead of wrapping.
    """
    x, unit = _c(col).cast("double"), float(1 << FRACTION_BITS)
    fits = F.abs(x) < float(1 << 40)
    small = F.when(fits, x)
    upper = (small - F.floor(small)) * unit
    lower = (upper - F.floor(upper)) * unit
    whole, high, low = (F.sum(F.floor(part)).cast("double") for part in (small, upper, lower))
    exact = whole + (high / unit + low / unit / unit)
    large = F.sum(F.when(~fits, x))
    return F.when(large.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + large)


def exact_avg(col) -> Column:
    return exact_sum(col) / F.nullif(F.count(_c(col)), F.lit(0))


def avg_money(col) -> Column:
    """Exact decimal sum divided by the count, as a double (null on no rows)."""
    c = _c(col)
    return F.sum(c).cast("double") / F.count(c)


def safe_div(num, den) -> Column:
    """num / den as double, null when den is 0 (reference: ``/ nullif(den, 0)``)."""
    return _c(num).cast("double") / F.nullif(_c(den), F.lit(0)).cast("double")


def rate_pct(pred, denominator=None, scale: int = 2) -> Column:
    """``round(countif(pred) * 100.0 / count(*), 2)`` — share of rows, in percent."""
    den = F.count(F.lit(1)) if denominator is None else denominator
    return round_half_up(F.count_if(_c(pred)) * F.lit(100.0) / den, scale)


def weighted_mean(x, w, scale: int, guard_zero: bool = False) -> Column:
    """``sum(x * w) / sum(w)``; rows with null x still count in the denominator."""
    num = exact_sum(_c(x) * _c(w))
    den = F.sum(_c(w))
    if guard_zero:
        den = F.nullif(den, F.lit(0))
    return round_half_up(num / den, scale)


# The delimiters after which the warehouse's INITCAP starts a new word, besides white space.
INITCAP_DELIMITERS = "[](){}/|<>!?@\"^#$&~_,.:;*%+-"


def trim_space(col) -> Column:
    """Trim all Unicode white space (tabs, line ends, no-break spaces), not spaces alone."""
    return F.regexp_replace(_c(col), r"^\p{IsWhite_Space}+|\p{IsWhite_Space}+$", "")


def norm_lower(col) -> Column:
    return F.lower(trim_space(col))


def norm_upper(col) -> Column:
    return F.upper(trim_space(col))


def norm_title(col) -> Column:
    """Upper-case the first letter of each word and lower-case the rest; hyphens and the like end words."""
    ends = "(?<=[\\s" + "".join("\\" + c for c in INITCAP_DELIMITERS) + "])"
    words = F.split(trim_space(col), ends)
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))), "")


def zip_text(col, dtype) -> Column:
    """Zip prefix as text. Numeric input gets its leading zeros back (5 digits); longer values stay whole."""
    c = _c(col)
    if isinstance(dtype, StringType):
        return c
    if isinstance(dtype, NumericType):
        text = c.cast("string")
        return F.lpad(text, F.greatest(F.length(text), F.lit(5)), F.lit("0"))
    return c.cast("string")


def to_ts(col) -> Column:
    return _c(col).cast("timestamp_ntz")


def day_diff(end, start) -> Column:
    """Whole calendar days between the dates of two timestamps."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("bigint")
