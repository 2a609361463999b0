"""Lenient timestamp parsing without exceptions per row.

Each accepted shape is recognised by a pattern and rewritten to ISO form, then a single
``try_cast`` parses it. The session time zone must be UTC, so that naive values mean UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.functions.text import strip

_TIME = r"(?:[T ]+\d{1,2}(?::\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?(?: ?(?:Z|UTC|[+-]\d{2}(?::?\d{2})?))?)?"

# Date part of a shape -> ISO order; the time part ($4) stays as written.
_REORDER = [
    (rf"^(\d{{4}})[/.](\d{{1,2}})[/.](\d{{1,2}})({_TIME})$", "$1-$2-$3$4"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})({_TIME})$", "$1-$2-$3$4"),
    (rf"^(1[0-2]|0?[1-9])[/.-](\d{{1,2}})[/.-](\d{{4}})({_TIME})$", "$3-$1-$2$4"),
    (rf"^(1[3-9]|2\d|3[01])[/.-](1[0-2]|0?[1-9])[/.-](\d{{4}})({_TIME})$", "$3-$2-$1$4"),
]
_ISO = rf"^(\d{{4}}-\d{{1,2}}-\d{{1,2}}{_TIME})$"

# Further shapes, rewritten to the ones above before and after their date part is put in order.
_BEFORE = [
    (r"(?i)^(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?,? +", ""),
    (r" GMT$", "Z"),
    (r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"),
]
_AFTER = [
    (r"(\d) +(?=Z|UTC|[+-])", "$1"),
    (r"^(\d{4}-\d{1,2}-\d{1,2}[T ]+\d{1,2})$", "$1:00"),
    (r"(:\d{2}(?:\.\d+)?[+-]\d{2})$", "$1:00"),
]
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = r"(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)(?:uary|ruary|ch|il|e|y|ust|t|tember|ober|ember)?\.?"
_NAMED = [rf"^{_MONTH} +(\d{{1,2}}),? +(\d{{4}})({_TIME})$", rf"^(\d{{1,2}}) +{_MONTH},? +(\d{{4}})({_TIME})$"]
_HALVES = r"(?i)^(.*?)(\d{1,2})(:\d{2}(?::\d{2})?) ?([ap])\.?m\.?$"


def _rewritten(text: Column, rules: list[tuple[str, str]]) -> Column:
    for shape, rewrite in rules:
        text = F.regexp_replace(text, shape, rewrite)
    return text


def _twenty_four_hours(text: Column) -> Column:
    """Times of half days as times of whole days; hours beyond 12 are left for the parse to refuse."""
    part = [F.regexp_extract(text, _HALVES, i) for i in range(5)]
    hour = part[2].try_cast("int")
    shifted = F.pmod(hour, F.lit(12)) + F.when(F.lower(part[4]) == "p", 12).otherwise(0)
    clock = F.when(hour.between(1, 12), F.lpad(shifted.cast("string"), 2, "0")).otherwise("99")
    return F.when(part[0] != "", F.concat(part[1], clock, part[3])).otherwise(text)


def _months_numbered(text: Column) -> Column:
    for shape, (month, day) in zip(_NAMED, ((1, 2), (2, 1))):
        name = F.lower(F.regexp_extract(text, shape, month))
        number = ((F.instr(F.lit(_MONTHS), name) + 2) / 3).cast("int").cast("string")
        day_of = F.regexp_extract(text, shape, day)
        iso = F.concat(F.regexp_extract(text, shape, 3), F.lit("-"), number, F.lit("-"), day_of, F.regexp_extract(text, shape, 4))
        text = F.when(name != "", iso).otherwise(text)
    return text


def posted_at_iso(raw: Column) -> Column:
    """Timestamp of a free-form date text; NULL when blank or not one of the accepted shapes."""
    text = _months_numbered(_twenty_four_hours(_rewritten(strip(raw), _BEFORE)))
    iso = _rewritten(text, [*_REORDER, *_AFTER])
    return F.regexp_extract(iso, _ISO, 1).try_cast("timestamp")
