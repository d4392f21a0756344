"""Opening hours: minutes, interval classes, unions and the expression grammar, as column functions.

Days are 0 (Monday) to 6, and 7 for public holidays. Intervals are structs (s, e) of minutes since midnight; an end on
the next day has 1440 added.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 1440
# Bounds of outpatient hours, the longest overnight span, names of the days.
EARLIEST, LATEST, LONGEST_OVERNIGHT = 360, 1380, 1080
DAYS = ("Mo", "Tu", "We", "Th", "Fr", "Sa", "Su", "PH")
INTERVALS = "array<struct<s:int,e:int>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def to_minutes(hhmm: Column) -> Column:
    """``HH:MM`` as minutes; null if it isn't one."""
    ok = hhmm.rlike(r"^[0-9]{1,2}:[0-9]{2}$")
    parts = F.split(hhmm, ":")
    return F.when(ok, parts[0].cast("int") * 60 + parts[1].cast("int"))


def to_hhmm(minutes: Column) -> Column:
    """Minutes as ``HH:MM``; a positive multiple of a day is 24:00."""
    clock = F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int") % 24, minutes % 60)
    return F.when((minutes > 0) & (minutes % DAY == 0), "24:00").otherwise(clock)


def classify(start: Column, end: Column) -> Column:
    """Why an interval is left out, null if it counts; the first class that fits, in this order."""
    overnight = end < start
    return (
        F.when((start == 0) & (end == 0), "null_placeholder")
        .when((start == 0) & (end == DAY - 1), "sentinel_24h")
        .when(overnight & (end + DAY - start >= LONGEST_OVERNIGHT), "overnight_implausible")
        .when(~overnight & (start < EARLIEST), "too_early")
        .when(~overnight & (end > LATEST), "too_late")
    )


def shift_overnight(start: Column, end: Column) -> Column:
    """The end, a day later where it lies before the start."""
    return F.when(end < start, end + DAY).otherwise(end)


def union_intervals(intervals: Column) -> Column:
    """Sorted disjoint intervals that cover the same minutes; touching ones become one."""
    empty = F.array().cast(INTERVALS)

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
        return F.when((F.size(done) > 0) & (x["s"] <= F.get(done, F.size(done) - 1)["e"]), joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(intervals), empty, add)


def format_spans(intervals: Column) -> Column:
    """``09:00-12:00,13:00-17:00``; a span of a day or more makes the day ``00:00-24:00``."""
    texts = F.transform(intervals, lambda x: F.concat(to_hhmm(x["s"]), F.lit("-"), to_hhmm(x["e"])))
    return F.when(F.exists(intervals, lambda x: x["e"] - x["s"] >= DAY), "00:00-24:00").otherwise(F.array_join(texts, ","))


def fold_days(days: Column) -> Column:
    """Names of sorted distinct days; runs of three or more weekdays become a range, holidays never join one."""
    names = F.array(*map(F.lit, DAYS))

    def run(x: Column) -> Column:
        length = F.filter(F.sequence(F.lit(1), F.lit(8)), lambda k: (x + k > 6) | ~F.array_contains(days, x + k))[0]
        listed = F.array_join(F.transform(F.sequence(x, x + length - 1), lambda i: names[i]), ",")
        return let(length, lambda _: F.when((x < 7) & (length >= 3), F.concat(names[x], F.lit("-"), names[x + length - 1])).otherwise(F.when(x == 7, "PH").otherwise(listed)))

    starts = F.filter(days, lambda x: (x == 7) | ~F.array_contains(days, x - 1))
    return F.array_join(F.transform(starts, run), ",")


def week_rules(slots: Column) -> Column:
    """The weekly rules of a facility from its slots (array of day, s, e): days with equal times share a rule.

    Rules stand in order of their first day, joined by ``; ``; no slots give an empty text.
    """

    def day(d: Column) -> Column:
        own = F.transform(F.filter(slots, lambda x: x["day"] == d), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
        return F.struct(d.alias("day"), format_spans(union_intervals(own)).alias("times"))

    week = F.filter(F.transform(F.sequence(F.lit(0), F.lit(7)), day), lambda x: x["times"] != "")

    def rules(w: Column) -> Column:
        times = F.array_distinct(F.transform(w, lambda x: x["times"]))
        rule = lambda t: F.concat(fold_days(F.transform(F.filter(w, lambda x: x["times"] == t), lambda x: x["day"])), F.lit(" "), t)
        return F.array_join(F.transform(times, rule), "; ")

    return let(week, rules)


def nth_week_rule(day: Column, weeks: Column, has_hours: Column) -> Column:
    """``Sa[1,3] off`` for sorted weeks of a month in which a weekday is closed; null for none, all five, or a day
    without hours."""
    text = F.concat(F.array(*map(F.lit, DAYS))[day], F.lit("["), F.array_join(F.transform(weeks, lambda x: x.cast("string")), ","), F.lit("] off"))
    return F.when(has_hours & F.size(weeks).between(1, 4), text)


# First ordinal of each month in a leap year, and the names of months.
MONTH_STARTS = (0, 31, 60, 91, 121, 152, 182, 213, 244, 274, 305, 335)
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def day_of_leap_year(month: Column, day: Column) -> Column:
    """0 to 365."""
    return F.array(*map(F.lit, MONTH_STARTS))[month - 1] + day - 1


def month_day(ordinal: Column) -> Column:
    """``Dec 30`` of a day of the leap year."""
    month = F.aggregate(F.array(*map(F.lit, MONTH_STARTS)), F.lit(0), lambda n, s: n + (s <= ordinal).cast("int"))
    name = F.array(*map(F.lit, MONTHS))
    return F.concat(name[month - 1], F.lit(" "), F.lpad((ordinal - F.array(*map(F.lit, MONTH_STARTS))[month - 1] + 1).cast("string"), 2, "0"))


def fold_dates(ordinals: Column) -> Column:
    """Sorted distinct days of the year as ``Jan 01-Jan 03,May 05``; with several runs, one at the end of December and
    one at the start of January are one run over the new year, which stands last."""

    def runs(d: Column) -> Column:
        starts = F.filter(d, lambda x: ~F.array_contains(d, x - 1))
        ends = F.filter(d, lambda x: ~F.array_contains(d, x + 1))
        return F.arrays_zip(starts.alias("a"), ends.alias("b"))

    def wrap(r: Column) -> Column:
        over = (F.size(r) > 1) & (r[0]["a"] == 0) & (F.element_at(r, -1)["b"] == 365)
        joined = F.concat(F.slice(r, 2, F.size(r) - 2), F.array(F.struct(F.element_at(r, -1)["a"].alias("a"), r[0]["b"].alias("b"))))
        return F.when(over, joined).otherwise(r)

    text = lambda x: F.when(x["a"] == x["b"], month_day(x["a"])).otherwise(F.concat(month_day(x["a"]), F.lit("-"), month_day(x["b"])))
    folded = let(runs(ordinals), lambda r: F.array_join(F.transform(wrap(r), text), ","))
    return F.when(F.size(ordinals) > 0, folded).otherwise("")


def fit_rules(text: Column, most: int = 255) -> Column:
    """Struct (kept, dropped): trailing ``; `` rules go until the text has ``most`` characters; dropped ones are joined."""
    def of(rules: Column) -> Column:
        sizes = F.filter(F.sequence(F.size(rules), F.lit(0), F.lit(-1)), lambda n: F.length(F.array_join(F.slice(rules, F.lit(1), n), "; ")) <= most)
        return let(sizes[0], lambda n: F.struct(F.array_join(F.slice(rules, F.lit(1), n), "; ").alias("kept"), F.array_join(F.slice(rules, n + 1, F.size(rules)), "; ").alias("dropped")))

    return let(F.split(text, "; "), of)


def fit_hours(value: Column, most: int = 255) -> Column:
    """Struct (value, note): hours cut to ``most`` characters by whole rules from the end, and what is said of it.

    The note quotes the first 80 characters of what went; where not even the first rule fits nothing is left.
    """

    def of(x: Column) -> Column:
        n = F.size(F.split(x["dropped"], "; ")).cast("string")
        cut = F.concat(F.lit(f"{most}文字を超えたため末尾の規則"), n, F.lit("件を落とした: "), F.substring(x["dropped"], 1, 80))
        note = F.when(x["dropped"] == "", "").when(x["kept"] == "", f"{most}文字を超え、残せる規則が無いため出力しない").otherwise(cut)
        return F.struct(x["kept"].alias("value"), note.alias("note"))

    return let(fit_rules(F.trim(F.coalesce(value, F.lit(""))), most), of)


def hours_expression(week: Column, unknown_days: Column, nth_weeks: Column, holiday_off: Column, dates: Column, comment: Column) -> Column:
    """The whole expression; later rules override earlier ones.

    Weekly rules, ``unknown`` for open days without times, weeks of the month, holidays, closed dates, then the
    fallback comment. Without weekly rules the result is empty.
    """
    part = lambda cond, text: F.when(cond, F.array(text)).otherwise(F.array().cast("array<string>"))
    rules = F.concat(
        part(week != "", week),
        part(F.size(unknown_days) > 0, F.concat(fold_days(unknown_days), F.lit(" unknown"))),
        F.coalesce(nth_weeks, F.array().cast("array<string>")),
        part(F.coalesce(holiday_off, F.lit(False)), F.lit("PH off")),
        part(F.coalesce(dates, F.lit("")) != "", F.concat(dates, F.lit(" off"))),
    )
    body = F.array_join(rules, "; ")
    tail = F.when(F.coalesce(comment, F.lit("")) != "", F.concat(F.lit(' || off "'), comment, F.lit('"'))).otherwise("")
    return F.when(week == "", "").otherwise(F.concat(body, tail))
