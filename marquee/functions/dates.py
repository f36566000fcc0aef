"""Date and time helpers (X3-X10). Built-in expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The day/month/year text format written by the collectors.
DAY_FORMAT = "d/M/yyyy"

# Formats tried, in order, for free-form dates (X5), each with the
# text shape it can parse. A format is only attempted on text of its shape, so a
# value costs one or two parse attempts instead of failing through the list.
ANY_DATE_FORMATS = (
    ("d/M/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("yyyy-MM-dd", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("yyyy-MM-dd HH:mm:ss", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}$"),
    ("d MMM, yyyy", r"^\d{1,2} \p{L}+\.?, \d{4}$"),
    ("d MMMM yyyy", r"^\d{1,2} \p{L}+ \d{4}$"),
    ("d MMM yyyy", r"^\d{1,2} \p{L}+ \d{4}$"),
    ("MMM d, yyyy", r"^\p{L}+\.? \d{1,2}, \d{4}$"),
    ("MMMM d, yyyy", r"^\p{L}+\.? \d{1,2}, \d{4}$"),
    ("MMMM yyyy", r"^\p{L}+ \d{4}$"),
    ("MMM yyyy", r"^\p{L}+ \d{4}$"),
)

# French month names (store pages are fetched in French) and the
# English name each is rewritten to before parsing.
FRENCH_MONTHS = (
    ("janvier", "January"), ("février", "February"), ("mars", "March"),
    ("avril", "April"), ("mai", "May"), ("juin", "June"),
    ("juillet", "July"), ("août", "August"), ("septembre", "September"),
    ("octobre", "October"), ("novembre", "November"), ("décembre", "December"),
    ("janv.", "Jan"), ("févr.", "Feb"), ("avr.", "Apr"), ("juil.", "Jul"),
    ("sept.", "Sep"), ("oct.", "Oct"), ("nov.", "Nov"), ("déc.", "Dec"),
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, fmt: str = DAY_FORMAT) -> Column:
    """Text -> TIMESTAMP_NTZ; raises on malformed text under ANSI."""
    return F.to_timestamp_ntz(_c(c), F.lit(fmt))


def parse_day(c, fmt: str = DAY_FORMAT) -> Column:
    """Text -> DATE with the collectors' day/month/year format."""
    return F.to_date(_c(c), fmt)


def try_parse_day(c, fmt: str = DAY_FORMAT) -> Column:
    return F.try_to_date(_c(c), fmt)


_FRENCH_HINT = "|".join(re.escape(fr) for fr, _ in FRENCH_MONTHS)


def english_months(c) -> Column:
    """French month names rewritten in English; other text is only trimmed.
    The rewrite runs only on text that contains a French name."""
    t = F.trim(_c(c))
    low = F.lower(t)
    out = low
    for fr, en in FRENCH_MONTHS:
        out = F.replace(out, F.lit(fr), F.lit(en.lower()))
    return F.when(low.rlike(_FRENCH_HINT), out).otherwise(t)


def parse_any_date(c, formats=ANY_DATE_FORMATS) -> Column:
    """First format that parses wins (parsing ignores case); French month
    names are understood. Text of another shape goes by the grammar of
    ``parse_free_date``; what that does not take either is NULL (callers route it to a
    reject table)."""
    text = english_months(c)
    shapes: dict[str, list[str]] = {}
    for fmt, shape in formats:
        shapes.setdefault(shape, []).append(fmt)
    attempts = [F.when(text.rlike(shape),
                       F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in fmts]))
                for shape, fmts in shapes.items()]
    return F.coalesce(*[a.cast("date") for a in attempts], parse_free_date(c))


# Words that stand in a date without saying anything of it.
FILLERS = ("of", "the", "on", "at", "à", "de", "du", "le", "la", "au", "en", "er", "st", "nd", "rd", "th",
           "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
           "mon", "tue", "tues", "wed", "thu", "thur", "thurs", "fri", "sat", "sun",
           "lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche")
# Months as they are written, by number.
MONTH_WORDS = (
    ("january", "jan", "janvier", "janv"), ("february", "feb", "février", "fevrier", "févr", "fevr"),
    ("march", "mar", "mars"), ("april", "apr", "avril", "avr"), ("may", "mai"), ("june", "jun", "juin"),
    ("july", "jul", "juillet", "juil"), ("august", "aug", "août", "aout"),
    ("september", "sep", "sept", "septembre"), ("october", "oct", "octobre"),
    ("november", "nov", "novembre"), ("december", "dec", "décembre", "decembre", "déc"),
)
# A time of day and its zone at the end of a text, after a space or ISO's T.
_CLOCK = (r"(?:^|(?<=\d)t|[\s,]\s*)\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?\s*(?:[ap]\.?m\.?)?"
          r"\s*(?:z|utc|gmt|[+-]\d{2}:?\d{2})?\s*$")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def parse_free_date(c) -> Column:
    """A date in free form by a grammar of tokens, in built-in expressions.

    A time of day at the end goes. Of what remains, runs of letters are words and runs
    of digits numbers. Fillers (weekdays, ``of``, ``1st``) are left out; any other word
    must be a month, English or French, and there may be one. Then the numbers decide:

    - with a month: a number of four digits is the year, or the last of two; the other
      is the day, the first of the month if there is none;
    - three numbers: year, month, day if the first has four digits; else day, month,
      year, unless only month, day, year is possible. ``03/04/2024`` is ambiguous and
      read day first, as the collectors write dates;
    - two numbers: a month and a year of four digits; eight digits: ``yyyyMMdd``;
    - years of two digits are 1969 to 2068.

    All else is NULL: a lone year, a day that does not exist, an unknown word."""
    text = F.lower(F.trim(_c(c)))
    text = F.regexp_replace(text, _CLOCK, "")
    months = F.create_map(*[F.lit(x) for i, names in enumerate(MONTH_WORDS) for n in names for x in (n, i + 1)])

    def dated(y, m, d):
        # the century of a year of two digits
        year = F.when(F.length(y) == 4, y.cast("int")).when(
            F.length(y) == 2, y.cast("int") + F.when(y.cast("int") < 69, F.lit(2000)).otherwise(F.lit(1900)))
        return F.try_to_date(F.format_string("%04d-%02d-%02d", year, m, d), "yyyy-MM-dd")

    def whole(t):
        """A number of at most four digits as an int."""
        return F.when(F.length(t) <= 2, t.cast("int"))

    def resolved(p):
        word, n = p["word"], p["numbers"]
        a, b, z = F.get(n, 0), F.get(n, 1), F.get(n, 2)
        count, four = F.size(n), lambda t: F.length(t) == 4
        named = (F.when((count == 1) & four(a), dated(a, word, F.lit(1)))
                 .when((count == 2) & four(a), dated(a, word, whole(b)))
                 .when(count == 2, dated(b, word, whole(a))))
        day_first = dated(z, whole(b), whole(a))
        numeric = (F.when((count == 3) & four(a), dated(a, whole(b), whole(z)))
                   .when(count == 3, F.coalesce(day_first, dated(z, whole(a), whole(b))))
                   .when((count == 2) & four(a), dated(a, whole(b), F.lit(1)))
                   .when((count == 2) & four(b), dated(b, whole(a), F.lit(1)))
                   .when((count == 1) & (F.length(a) == 8), F.try_to_date(a, "yyyyMMdd")))
        return F.when(p["n_words"] == 0, numeric).when(p["n_words"] == 1, named)

    def classified(tokens):
        words = F.filter(tokens, lambda t: t.rlike(r"^\p{L}") & ~t.isin(*FILLERS))
        return F.struct(F.size(words).alias("n_words"), F.try_element_at(months, F.get(words, 0)).alias("word"),
                        F.filter(tokens, lambda t: t.rlike(r"^\d")).alias("numbers"))

    tokens = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\d+)"), F.lit(1))
    return _let(tokens, lambda t: _let(classified(t), resolved))


def month_floor(c) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(_c(c).cast("date"), "MM")


def relative_month(c, as_of: str, label: str = "Last 30 days") -> Column:
    """A relative label resolved to a fixed, caller-given month text."""
    return F.when(F.trim(_c(c)) == label, F.lit(as_of)).otherwise(_c(c))


def date_key(c) -> Column:
    """``year * 100 + month`` as INT."""
    c = _c(c)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def year(c) -> Column:
    return F.year(_c(c)).cast("bigint")


def month(c) -> Column:
    return F.month(_c(c)).cast("bigint")


def quarter(c) -> Column:
    return F.quarter(_c(c)).cast("bigint")


def month_name(c) -> Column:
    """Full English month name (Spark's ``monthname`` gives 'Mar')."""
    return F.date_format(_c(c), "MMMM")
