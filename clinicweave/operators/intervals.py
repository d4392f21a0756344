"""Operators on weekly intervals: long form, unions, conflicts with day flags, expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinicweave.functions import hours as H


def unpivot_slots(df: DataFrame, ids: list[str], slots: list[tuple[int, str, str]]) -> DataFrame:
    """(ids, day, start, end) from a wide table: one row for each (day, start column, end column) with both ends."""
    items = F.array(*[F.struct(F.lit(d).alias("day"), F.col(f"`{a}`").alias("start"), F.col(f"`{b}`").alias("end")) for d, a, b in slots])
    filled = F.filter(items, lambda x: (F.coalesce(F.trim(x["start"]), F.lit("")) != "") & (F.coalesce(F.trim(x["end"]), F.lit("")) != ""))
    return df.select(*ids, F.inline(filled))


def interval_union(df: DataFrame, keys: list[str], start: str = "s", end: str = "e") -> DataFrame:
    """(keys, start, end) of the disjoint unions within each key: gaps and islands over one window order."""
    order = Window.partitionBy(*keys).orderBy(start, end)
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col(start) <= reached, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def split_intervals(df: DataFrame, start: str = "s", end: str = "e", department: str | None = None, emergency: str = "09010") -> DataFrame:
    """With ``kind`` (null where the interval counts) and the shifted end.

    Placeholders come first, then intervals of the emergency department, then the other reasons.
    """
    kind = H.classify(F.col(start), F.col(end))
    if department:
        kind = F.when(kind == "null_placeholder", kind).when(F.col(department) == emergency, "emergency").otherwise(kind)
    return df.withColumn("kind", kind).withColumn(end, H.shift_overnight(F.col(start), F.col(end)))


def week_expression(df: DataFrame, key: str = "id") -> DataFrame:
    """(key, expression) of slots (key, day, s, e).

    The slots of a day are reduced to their disjoint unions first, so that a key's list holds at most the islands of a
    week, however many slots it has.
    """
    df = interval_union(df.select(key, "day", "s", "e"), [key, "day"])
    slots = F.collect_list(F.struct(F.col("day").cast("int").alias("day"), F.col("s").cast("int").alias("s"), F.col("e").cast("int").alias("e")))
    return df.groupBy(key).agg(slots.alias("_slots")).select(key, H.week_rules(F.col("_slots")).alias("expression"))


def facility_counts(split: DataFrame, conflicts: DataFrame, key: str = "id") -> DataFrame:
    """(key, excluded, overnight, conflicts): intervals left out, intervals over midnight that count, days in conflict.

    ``split`` comes from ``split_intervals``, ``conflicts`` from ``day_conflicts``; a facility of either has a row.
    """
    slots = split.groupBy(key).agg(F.count_if(F.col("kind").isNotNull()).alias("excluded"), F.count_if(F.col("kind").isNull() & (F.col("e") >= H.DAY)).alias("overnight"))
    days = conflicts.groupBy(key).agg(F.count(F.lit(1)).alias("conflicts"))
    return slots.join(days, key, "full").select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("excluded", "overnight", "conflicts")])


def day_conflicts(flags: DataFrame, slots: DataFrame, key: str = "id") -> DataFrame:
    """(key, day, conflict) where a day's flag and its intervals disagree: ``closed_with_times``, ``open_without_times``."""
    present = slots.select(key, "day").distinct().withColumn("_has", F.lit(True))
    joined = flags.join(present, [key, "day"], "left")
    conflict = F.when((F.col("flag") == "0") & F.col("_has"), "closed_with_times").when((F.col("flag") == "1") & F.col("_has").isNull(), "open_without_times")
    return joined.select(key, "day", conflict.alias("conflict")).filter("conflict is not null")


def resolve_conflicts(flags: DataFrame, slots: DataFrame, key: str = "id") -> DataFrame:
    """(key, kept_days, dropped_days, unknown_days, withheld) after weighing flags against intervals.

    The baseline is the set of intervals on weekdays flagged open. A day flagged closed loses its intervals where all
    of them are in a baseline that isn't empty; else its times win. Then weekdays flagged open without intervals are
    unknown days, or the facility is withheld if no weekday has any. One shuffle by the key.
    """
    f = flags.groupBy(key).agg(F.collect_list(F.struct("day", "flag")).alias("_f"))
    s = slots.groupBy(key).agg(F.collect_set(F.struct(F.col("day"), F.col("s"), F.col("e"))).alias("_s"))
    both = f.join(s, key, "left").withColumn("_s", F.coalesce("_s", F.array().cast("array<struct<day:int,s:int,e:int>>")))
    flagged = lambda v: F.transform(F.filter("_f", lambda x: x["flag"] == v), lambda x: x["day"])
    pair = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))
    both = both.withColumn("_open", F.filter(flagged("1"), lambda d: d < 7)).withColumn("_closed", flagged("0"))
    both = both.withColumn("_base", F.array_distinct(F.transform(F.filter("_s", lambda x: F.array_contains("_open", x["day"])), pair)))
    of_day = lambda d: F.transform(F.filter("_s", lambda x: x["day"] == d), pair)
    dropped = F.filter("_closed", lambda d: (F.size("_base") > 0) & (F.size(of_day(d)) > 0) & (F.size(F.array_except(of_day(d), "_base")) == 0))
    both = both.withColumn("dropped_days", F.array_sort(dropped))
    days = F.array_distinct(F.transform("_s", lambda x: x["day"]))
    both = both.withColumn("kept_days", F.array_sort(F.array_except(days, "dropped_days")))
    missing = F.array_sort(F.filter("_open", lambda d: ~F.array_contains("kept_days", d)))
    some = F.exists("kept_days", lambda d: d < 7)
    return both.select(key, "kept_days", "dropped_days", F.when(some, missing).otherwise(F.array().cast("array<int>")).alias("unknown_days"), (~some & (F.size(missing) > 0)).alias("withheld"))
