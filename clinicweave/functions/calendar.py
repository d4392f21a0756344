"""Opening hours read as rules and evaluated day by day against a calendar, as column functions."""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.functions.hours import DAY, DAYS, MONTH_STARTS, MONTHS, let, union_intervals

# The first day of the probe (a Monday), its weeks, and the public holidays it meets.
PROBE_FROM, PROBE_WEEKS = date(2026, 1, 5), 13
HOLIDAYS = (date(2026, 1, 12), date(2026, 2, 11), date(2026, 2, 23), date(2026, 3, 20))

_DAY = "(?:" + "|".join(DAYS) + ")"
_MONTH = "(?:" + "|".join(MONTHS) + ")"
_WEEKS = r"\[[1-5](?:,[1-5])*\]"
_DAYS = rf"{_DAY}(?:-{_DAY})?(?:{_WEEKS})?"
_DATE = rf"{_MONTH} [0-3][0-9]"
SPAN = "[0-4][0-9]:[0-5][0-9]-[0-4][0-9]:[0-5][0-9]"
WHEN = rf"(?:{_DAYS}(?:,{_DAYS})*|{_DATE}(?:-{_DATE})?(?:,{_DATE}(?:-{_DATE})?)*)"
_STATE = rf"(?:24/7|{SPAN}(?:,{SPAN})*|off|unknown)"
_RULE = rf"(?:(?:{WHEN} )?{_STATE}(?: \"[^\"]*\")?|{WHEN}|\"[^\"]*\")"
#: The subset of the opening-hours grammar that the output uses.
HOURS = rf"^{_RULE}(?:(?:; | \|\| ){_RULE})*$"


def _place(names: tuple[str, ...], text: Column) -> Column:
    """Place of a name among others, from 0; null if it is none of them."""
    return F.nullif(F.array_position(F.array(*map(F.lit, names)), text), F.lit(0)).cast("int") - 1


def parse_rules(value: Column) -> Column:
    """The rules of opening hours in order: ``when`` (array of a, b, weeks, dated), ``state``, ``spans`` (s, e), ``fallback``.

    ``a`` to ``b`` are days of the week, 7 for public holidays, or days of a leap year where ``dated``; a range may run
    over the end of its week or year. No ``when`` means every day, no ``spans`` the whole day. A span that does not end
    later than it starts ends on the next day. A rule whose times or days carry a comment is ``unknown``, and so is a
    comment alone. A null or empty value has no rules; a value outside of the grammar gives whatever can be read of it.
    """
    words = F.split(F.regexp_replace(F.coalesce(value, F.lit("")), r" \|\| ", "; || "), r"; (?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)")

    def one(text: Column) -> Column:
        plain = F.regexp_replace(text, r"^\|\| ", "")
        when = F.regexp_extract(plain, f"^({WHEN})(?: |$)", 1)
        comment = plain.contains('"')
        closed = F.regexp_replace(plain, r'"[^"]*"', "").rlike(r"\boff\b")
        unsure = comment | F.regexp_replace(plain, r'"[^"]*"', "").rlike(r"\bunknown\b")
        return F.struct(
            F.when(when == "", F.array().cast("array<struct<a:int,b:int,weeks:array<int>,dated:boolean>>")).otherwise(F.transform(F.split(when, ",(?=[A-Z])"), selector)).alias("when"),
            F.when(closed, "off").when(unsure, "unknown").otherwise("open").alias("state"),
            F.transform(F.regexp_extract_all(F.regexp_replace(plain, r'"[^"]*"', ""), F.lit(SPAN), F.lit(0)), span).alias("spans"),
            text.startswith("|| ").alias("fallback"),
        )

    def selector(text: Column) -> Column:
        dated = text.contains(" ")
        first, last = (F.regexp_extract(text, rf"^({_DATE}|{_DAY})(?:-({_DATE}|{_DAY}))?", k) for k in (1, 2))
        last = F.when(last == "", first).otherwise(last)
        day = lambda x: F.array(*map(F.lit, MONTH_STARTS))[_place(MONTHS, F.substring(x, 1, 3))] + F.substring(x, 5, 2).try_cast("int") - 1
        at = lambda x: F.when(dated, day(x)).otherwise(_place(DAYS, x))
        return F.struct(at(first).alias("a"), at(last).alias("b"), F.transform(F.regexp_extract_all(F.regexp_extract(text, _WEEKS, 0), F.lit("[1-5]"), F.lit(0)), lambda x: x.cast("int")).alias("weeks"), dated.alias("dated"))

    def span(text: Column) -> Column:
        minutes = lambda at: F.substring(text, at, 2).cast("int") * 60 + F.substring(text, at + 3, 2).cast("int")
        return F.struct(minutes(1).alias("s"), F.when(minutes(7) <= minutes(1), minutes(7) + DAY).otherwise(minutes(7)).alias("e"))

    return F.transform(F.filter(words, lambda x: x != ""), one)


def calendar(first: date = PROBE_FROM, weeks: int = PROBE_WEEKS, holidays: tuple[date, ...] = HOLIDAYS) -> Column:
    """The days of a probe: ``i`` from 0, ``dow``, ``week`` of the month, ``md`` (day of a leap year), ``ph``."""
    days = [first + timedelta(i) for i in range(7 * weeks)]
    rows = [{"i": i, "dow": d.weekday(), "week": (d.day + 6) // 7, "md": MONTH_STARTS[d.month - 1] + d.day - 1, "ph": d in holidays} for i, d in enumerate(days)]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<i:int,dow:int,week:int,md:int,ph:boolean>>")  # folded to a constant


def _on(rule: Column, day: Column) -> Column:
    """Whether a rule holds on a day. A weekday's rule holds on a holiday too, unless a later rule overrides it."""

    def fits(x: Column) -> Column:
        within = lambda v: F.when(x["a"] <= x["b"], v.between(x["a"], x["b"])).otherwise((v >= x["a"]) | (v <= x["b"]))
        weekday = within(day["dow"]) & ((F.size(x["weeks"]) == 0) | F.array_contains(x["weeks"], day["week"]))
        return F.when(x["dated"], within(day["md"])).when(x["a"] == 7, day["ph"]).otherwise(weekday)

    return (F.size(rule["when"]) == 0) | F.exists(rule["when"], lambda x: F.coalesce(fits(x), F.lit(False)))


def deciding_rule(rules: Column, day: Column, fallback: bool = False) -> Column:
    """The last rule that holds on a day, null without one: later rules override earlier ones."""
    held = F.filter(rules, lambda r: (r["fallback"] == F.lit(fallback)) & _on(r, day))
    return F.try_element_at(held, F.lit(-1))


def certain_spans(rules: Column, day: Column) -> Column:
    """When it is certainly open on a day, as spans from its midnight: what the deciding rule opens.

    A fallback opens where nothing else does; it stays out where the state of the day is unknown.
    """
    whole = F.array(F.struct(F.lit(0).alias("s"), F.lit(DAY).alias("e")))
    none = F.array().cast("array<struct<s:int,e:int>>")
    opens = lambda r: F.when(r.isNull() | (r["state"] != "open"), none).otherwise(F.when(F.size(r["spans"]) == 0, whole).otherwise(r["spans"]))

    def of(both: Column) -> Column:
        unsure = F.coalesce(both["main"]["state"] == "unknown", F.lit(False))
        return F.concat(opens(both["main"]), F.when(unsure, none).otherwise(opens(both["rest"])))

    return let(F.struct(deciding_rule(rules, day).alias("main"), deciding_rule(rules, day, True).alias("rest")), of)


def ever_open(rules: Column, days: Column) -> Column:
    """Whether some day of a calendar has a certain opening; the first one ends the search."""
    return F.exists(days, lambda d: F.size(certain_spans(rules, d)) > 0)


def ever_unknown(rules: Column, days: Column) -> Column:
    """Whether some day's state is unknown."""
    return F.exists(days, lambda d: F.coalesce(deciding_rule(rules, d)["state"] == "unknown", F.lit(False)))


def open_intervals(rules: Column, days: Column) -> Column:
    """Sorted disjoint intervals of certain opening, in minutes from a calendar's first midnight to its end.

    Spans that run over midnight join the next day's; what runs beyond the last day is cut.
    """
    end = F.size(days) * DAY
    spans = F.flatten(F.transform(days, lambda d: F.transform(certain_spans(rules, d), lambda x: F.struct((d["i"] * DAY + x["s"]).alias("s"), F.least(d["i"] * DAY + x["e"], end).alias("e")))))
    return union_intervals(F.filter(spans, lambda x: x["s"] < x["e"]))


def minutes_within(intervals: Column, days: int) -> Column:
    """Minutes of intervals that lie before the end of the first ``days`` days."""
    return F.aggregate(intervals, F.lit(0), lambda a, x: a + F.greatest(F.lit(0), F.least(x["e"], F.lit(days * DAY)) - x["s"]))


def with_open_minutes(df: DataFrame, value: str, windows: dict[str, int], days: Column | None = None) -> DataFrame:
    """Beside opening hours the minutes of certain opening in the first days of a calendar, by name of the window.

    Each different value is evaluated once. Null values, and values outside of the grammar, have null minutes.
    """
    days = calendar() if days is None else days
    values = df.select(value).filter(F.col(value).rlike(HOURS)).distinct()
    read = values.withColumn("_open", let(parse_rules(F.col(value)), lambda r: open_intervals(r, days)))
    return df.join(read.select(value, *[minutes_within(F.col("_open"), n).alias(k) for k, n in windows.items()]), value, "left")
