"""Column cleaners (X2, X11-X23). All are built-in Spark expressions, so they
stay inside whole-stage codegen; none needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Python's ``\w`` and ``\s`` are Unicode; Java's (and RE2's) are ASCII. Spell
# both classes out so letters and digits of any script survive and Unicode
# spaces count as spaces, as they do in the reference. The same text works in
# Java regex and in RE2.
WHITESPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
NON_WORD = r"[^\p{L}\p{N}_" + WHITESPACE + "]"
SPACE_RUN = "[" + WHITESPACE + "]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_name(c) -> Column:
    """NULL -> '', lower case, drop non-word characters, whitespace runs -> '-'."""
    c = F.lower(F.coalesce(_c(c).cast("string"), F.lit("")))
    c = F.regexp_replace(c, NON_WORD, "")
    return F.regexp_replace(c, SPACE_RUN, "-")


def strip_marks(c) -> Column:
    """Remove thousands separators and sign/percent marks."""
    return F.translate(_c(c), "+%,", "")


def clean_number(c) -> Column:
    """X11: '-' -> NULL; strip '+ % ,'; parse as a number (DOUBLE), else NULL."""
    c = _c(c)
    return F.when(c == "-", F.lit(None).cast("double")).otherwise(
        strip_marks(c).try_cast("double"))


def suffix_number(c) -> Column:
    """X12: '1.2M' / '3.4K' -> integer, truncated toward zero like Python ``int``."""
    c = F.trim(_c(c))
    head = c.substr(F.lit(1), F.length(c) - 1)
    mult = (F.when(c.endswith("M"), F.lit(1_000_000.0))
            .when(c.endswith("K"), F.lit(1_000.0)))
    return (head.try_cast("double") * mult).try_cast("bigint")


def cell_value(c) -> Column:
    """A scraped table cell as a number: X12 for values ending in M/K (which can
    never parse as plain numbers), X11 otherwise. Routing by the suffix avoids
    a failed cast per suffixed cell."""
    stripped = F.trim(strip_marks(_c(c)))
    suffixed = stripped.endswith("M") | stripped.endswith("K")
    return (F.when(_c(c) == "-", F.lit(None).cast("double"))
             .when(suffixed, suffix_number(stripped).cast("double"))
             .otherwise(stripped.try_cast("double")))


def gain(c) -> Column:
    """Strip ',', '+' and '%' (the reference's '-' -> '-' replace is a no-op)."""
    return F.translate(_c(c), ",+%", "")


def decimal_comma(c) -> Column:
    """X14: '19,99' -> 19.99; blank -> NULL; unparsable -> NULL."""
    c = _c(c)
    return F.replace(F.nullif(c, F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def int_trunc(c) -> Column:
    """Python ``int(float(x.replace(',', '')))`` -- truncation toward zero.

    Text that is no number, not finite, or beyond the integer column gives NULL,
    which the loads take as a reason to reject the row."""
    c = _c(c)
    return F.replace(c.cast("string"), F.lit(","), F.lit("")).try_cast("double").try_cast("int")


def int_half_even(c) -> Column:
    """X16 for DOUBLE input: the reference's ``::INT`` rounds half to even."""
    return F.rint(_c(c)).cast("int")


def int_half_up(c) -> Column:
    """X16 for text/decimal input: ``::INT`` rounds half away from zero."""
    return F.round(_c(c).cast("decimal(38,9)"), 0).cast("int")


def to_int(c, dtype: T.DataType) -> Column:
    """``::INT`` with the reference's rounding, chosen by the input type."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return int_half_even(c)
    if isinstance(dtype, (T.StringType, T.DecimalType)):
        return int_half_up(c)
    return _c(c).cast("int")


def to_decimal_1(c) -> Column:
    """``::DECIMAL(10,1)``."""
    return _c(c).cast("decimal(10,1)")


def blank_to_null(c) -> Column:
    """Blank text or NaN -> NULL."""
    c = _c(c)
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def finite(c) -> Column:
    """A DOUBLE that a number column can hold; NaN and infinities become NULL."""
    c = _c(c)
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def percent(part, whole, digits: int = 2) -> Column:
    """Share of a target in percent, rounded."""
    return F.round(_c(part).cast("double") / _c(whole).cast("double") * 100.0, digits)


def link_id(c, pattern: str = r"/games/(\d+)") -> Column:
    """Numeric id captured from a link; NULL when absent or beyond BIGINT."""
    return F.nullif(F.regexp_extract(_c(c), pattern, 1), F.lit("")).try_cast("bigint")


def name_part(c, sep: str, pos: int) -> Column:
    """Piece ``pos`` (1-based, negative from the end) of ``c`` split on ``sep``."""
    return F.element_at(F.split(_c(c), sep), pos)
