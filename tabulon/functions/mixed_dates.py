"""Dates written in any common way, read by the kinds of their parts instead of by a list of patterns.

A text is cut into numbers and words. Each part has a kind: Y, a number of four
digits; N, one or two digits; C, eight digits; M, a month's name; nothing, a word
without meaning for the date (a weekday, "of", "th"). The row of kinds says which
part is year, month and day, whatever stands between them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: English month names, and the words that may stand in a date without changing it.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
FILLERS = ("st", "nd", "rd", "th", "of", "on", "at", "and")

#: Kinds in order -> places of (year, month, day); of two readings the first possible one counts.
FORMS = {
    "YNN": ((0, 1, 2),),
    "NNY": ((2, 0, 1), (2, 1, 0)),
    "NNN": ((2, 0, 1), (2, 1, 0)),
    "YMN": ((0, 1, 2),),
    "YNM": ((0, 2, 1),),
    "MNY": ((2, 0, 1),),
    "NMY": ((2, 1, 0),),
    "MNN": ((2, 0, 1),),
    "NMN": ((2, 1, 0),),
    "YN": ((0, 1, None),),
    "YM": ((0, 1, None),),
    "MY": ((1, 0, None),),
}
COMPACT = "C"
#: Two-digit years below this are 20xx, the others 19xx.
PIVOT = 69

_TIME = (r"^(.*[0-9a-z])[t\s,]\s*(?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]+)?)?"
         r"\s*(?:[ap]\.?m\.?)?\s*(?:z|utc|gmt|[+-][0-9]{2}:?[0-9]{2})?$")
_PART = r"[0-9]+|[a-z]+|[^0-9a-z\s.,/-]+"

PARSED, MISSING, NO_DATE, UNKNOWN_FORM, NO_SUCH_DAY = "parsed", "missing", "no date", "unknown form", "no such day"


def _literal_map(values: dict, type_: str) -> Column:
    """A constant map; as one text it is two calls to the JVM, not two an entry."""
    return F.from_json(F.lit(json.dumps(values)), f"map<string,{type_}>")


def _months() -> dict[str, int]:
    return {name: n for n, m in enumerate(MONTHS, 1) for name in (m, m[:3])} | {"sept": 9}


def _kind(part: Column, words: Column) -> Column:
    size = F.length(part)
    number = F.when(size <= 2, "N").when(size == 4, "Y").when(size == 8, COMPACT).otherwise("X")
    return F.when(F.rlike(part, F.lit("^[0-9]")), number).otherwise(F.coalesce(F.try_element_at(words, part), F.lit("X")))


def _day(parts: Column, places: Column, months: Column) -> Column:
    """The date whose year, month and day are at ``places`` of the parts; without a place for it, the day is 1."""
    year, month = F.get(parts, places[0]), F.get(parts, places[1])
    day = F.coalesce(F.get(parts, places[2]).try_cast("int"), F.when(places[2] < 0, 1))
    short = F.when(F.length(year) <= 2, F.when(year.try_cast("int") < PIVOT, 2000).otherwise(1900)).otherwise(0)
    return F.try_make_timestamp(year.try_cast("int") + short, F.coalesce(F.try_element_at(months, month), month.try_cast("int")), day,
                                F.lit(0), F.lit(0), F.lit(0)).cast("date")


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def read_date(text: Column, day_first: bool = False) -> Column:
    """Struct of ``date`` and ``status`` of a text.

    A time of day and a zone behind the date are checked and left out: the date is the one that is written. Where
    month and day could be swapped, the month comes first (``day_first``: the day), unless only the other reading is
    a day of the calendar. Years of two digits are 1969 to 2068; a date without a day is its month's first.

    ``status``: ``parsed``; ``missing`` (null or blank); ``no date`` (no digit in it); ``unknown form`` (parts that
    make no date); ``no such day`` (a date's parts, but not in the calendar). All but the first have a null date.
    """
    lowered = F.lower(F.trim(text.cast("string")))
    silent = [*FILLERS, *WEEKDAYS, *[w[:3] for w in WEEKDAYS], "tues", "thur", "thurs"]
    words = _literal_map({w: "M" for w in _months()} | {w: "" for w in silent}, "string")
    months = _literal_map(_months(), "int")
    swapped = {k: tuple(reversed(r)) if day_first and k in ("NNY", "NNN") else r for k, r in FORMS.items()}
    forms = _literal_map({k: [[-1 if p is None else p for p in places] for places in r] for k, r in swapped.items()}, "array<array<int>>")
    dated = F.when(F.rlike(lowered, F.lit(_TIME)), F.regexp_extract(lowered, _TIME, 1)).otherwise(lowered)

    def judged(said: Column) -> Column:
        return _bind(F.struct(F.transform(said, lambda x: x["text"]).alias("parts"),
                              F.array_join(F.transform(said, lambda x: x["kind"]), "").alias("kinds")), found)

    def found(x: Column) -> Column:
        whole = F.get(x["parts"], F.lit(0))
        compact = x["kinds"] == COMPACT
        parts = F.when(compact, F.array(F.substring(whole, 1, 4), F.substring(whole, 5, 2), F.substring(whole, 7, 2))).otherwise(x["parts"])
        readings = F.try_element_at(forms, F.when(compact, "YNN").otherwise(x["kinds"]))
        days = F.filter(F.transform(readings, lambda r: _day(parts, r, months)), lambda d: d.isNotNull())
        return _bind(F.get(days, F.lit(0)), lambda date: F.struct(date.alias("date"), (
            F.when(date.isNotNull(), PARSED).when(readings.isNotNull(), NO_SUCH_DAY)
            .when(F.rlike(lowered, F.lit("[0-9]")), UNKNOWN_FORM).otherwise(NO_DATE)).alias("status")))

    parts = F.transform(F.regexp_extract_all(dated, F.lit(_PART), F.lit(0)), lambda p: F.struct(p.alias("text"), _kind(p, words).alias("kind")))
    spoken = F.filter(parts, lambda x: x["kind"] != "")
    iso = F.rlike(lowered, F.lit(r"^\d{4}-\d\d-\d\d$"))  # the usual case needs no look at its parts
    plain = _bind(lowered.try_cast("date"), lambda d: F.struct(d.alias("date"), F.when(d.isNull(), NO_SUCH_DAY).otherwise(PARSED).alias("status")))
    none = F.struct(F.lit(None).cast("date").alias("date"), F.lit(MISSING).alias("status"))
    return F.when(F.coalesce(lowered, F.lit("")) == "", none).when(iso, plain).otherwise(_bind(spoken, judged))


def to_date_any(text: Column, day_first: bool = False) -> Column:
    """Date of a text in any common form; null where :func:`read_date` finds none."""
    return read_date(text, day_first)["date"]


def date_rejects(df: DataFrame, column: str, day_first: bool = False) -> DataFrame:
    """What did not become a date: (``text``, ``reason``, ``rows``), a line for every distinct text."""
    read = df.select(F.col(column).cast("string").alias("text"), read_date(F.col(column), day_first)["status"].alias("reason"))
    return read.filter(F.col("reason") != PARSED).groupBy("text", "reason").agg(F.count(F.lit(1)).alias("rows"))
