"""Pure text functions over columns; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed: what a line may end with, besides line feed.
LINE_ENDS = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085  ]"
ISO_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
PLAIN_INT = "^[+-]?[0-9]+$"


def split_lines(text: Column) -> Column:
    """Lines at any line end; one end at the very end opens no further line, and an empty text has none."""
    cut = F.regexp_replace(text, f"(?:{LINE_ENDS})\\z", "")
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(cut, LINE_ENDS, -1))


def casefold(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, "\\s+", " "))


def slug(text: Column) -> Column:
    """Lower-case letters and digits joined by hyphens, at most 160 characters."""
    return F.substring(F.regexp_replace(F.regexp_replace(casefold(text), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, 160)


def label_of(line: Column) -> Column:
    """What stands before a line's first colon, trimmed and folded; null without a colon."""
    return F.when(F.instr(line, ":") > 0, casefold(F.trim(F.substring_index(line, ":", 1))))


def value_of(line: Column) -> Column:
    """What follows a line's first colon, trimmed; the line without one."""
    return F.trim(F.substring(line, F.instr(line, ":") + 1, F.length(line)))


def iso_date(text: Column) -> Column:
    """A date only in strict ISO form."""
    return F.when(text.rlike(ISO_DATE), F.try_to_date(text, "yyyy-MM-dd"))


def number(text: Column) -> Column:
    """A double; what is no number, or NaN, is null."""
    x = text.try_cast("double")
    return F.when(~F.isnan(x), x)


def whole(text: Column) -> Column:
    return F.when(text.rlike(PLAIN_INT), text.try_cast("long"))


def suffix(path: Column) -> Column:
    """The field's name: what follows the last dot."""
    return F.substring_index(path, ".", -1)


def prefix(path: Column) -> Column:
    """The schema's name: what precedes the first bracket or dot."""
    return F.regexp_extract(path, "^([^\\[.]*)", 1)


def group_index(path: Column, group: str) -> Column:
    """i of ``group[i].field``; null for other paths."""
    # Most paths are of other groups or none, which needs no pattern.
    return F.when(path.startswith(f"{group}["), F.regexp_extract(path, f"^{group}\\[(\\d+)\\]\\.(.+)$", 1).try_cast("int"))


def long_date(text: Column) -> Column:
    """'August 3, 2026' as an ISO date's text."""
    return F.date_format(F.try_to_date(collapse(text), "MMMM d, yyyy"), "yyyy-MM-dd")


def required(text: Column, pattern: str) -> Column:
    """The first group of a pattern's first match, collapsed; a text without one is an error."""
    hit = F.regexp_extract(text, f"(?i){pattern}", 1)
    return F.when(hit != "", collapse(hit)).otherwise(F.raise_error(F.lit(f"required pattern not found: {pattern}")))


def plain_decimal(x: Column) -> Column:
    """A number with at most four decimals and no zeros at its end."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.4f", x), "0+$", ""), "\\.$", "")


def html_escape(text: Column) -> Column:
    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def add_business_days(start: Column, n: Column) -> Column:
    """``start`` plus ``n`` days, Saturdays and Sundays not counted; 0 gives the day itself, a negative n null."""
    days = F.filter(F.sequence(F.date_add(start, 1), F.date_add(start, n * 2 + 4)), lambda d: F.weekday(d) < 5)
    return F.when(n == 0, start).when(n > 0, F.get(days, n - 1))
