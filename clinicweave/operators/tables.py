"""Joins, aggregates and set operations on keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key with the values of its last row: a partial aggregate, no sort."""
    values = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_v")).select(*keys, "_v.*")


def lookup_with_override(df: DataFrame, table: DataFrame, scope: str, code: str, value: str) -> DataFrame:
    """``value`` of the row (scope, code) of a mapping table, else of the general row (no scope, code).

    A mapping table is written by hand; it is broadcast if Spark's own estimate is below its threshold.
    """
    own = table.filter(F.coalesce(F.col(scope), F.lit("")) != "").select(F.col(scope), F.col(code), F.col(value).alias("_own"))
    general = table.filter(F.coalesce(F.col(scope), F.lit("")) == "").select(F.col(code), F.col(value).alias("_general"))
    return df.join(own, [scope, code], "left").join(general, code, "left").withColumn(value, F.coalesce("_own", "_general")).drop("_own", "_general")


def ordered_values(df: DataFrame, key: str, order: str, values: str, separator: str = ";") -> DataFrame:
    """(key, values): the separated values of a key's rows in order, each once, at its first place."""
    lists = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(values).alias("v")))).alias("_x"))
    flat = F.flatten(F.transform("_x", lambda x: F.split(x["v"], separator)))
    return lists.select(key, F.array_distinct(F.filter(flat, lambda v: v != "")).alias("values"))


def fit_values(values: Column, rollup: dict[str, str], most: int = 255, catch_all: str = "general") -> Column:
    """Struct (text, stage): values joined by ``;`` if short enough, else rolled up to broader ones, else the catch-all."""
    pairs = [F.lit(x) for kv in rollup.items() for x in kv]
    table = F.create_map(*pairs) if pairs else F.expr("map('', '')")
    rolled = F.array_join(F.array_distinct(F.transform(values, lambda v: F.coalesce(table[v], v))), ";")
    plain = F.array_join(values, ";")
    out = lambda text, stage: F.struct(text.alias("text"), F.lit(stage).alias("stage"))
    return F.when(F.length(plain) <= most, out(plain, 0)).when(F.length(rolled) <= most, out(rolled, 1)).otherwise(out(F.lit(catch_all), 2))


def shared_points(df: DataFrame, lat: str, lon: str, place: str, least: int = 2) -> DataFrame:
    """Rows with ``n_places``, the distinct places on their point, and ``shared`` if they are ``least`` or more.

    Distinct (point, place) pairs are reduced first, so a point with very many rows is one row a task.
    """
    n = df.select(lat, lon, place).filter(F.coalesce(F.col(place), F.lit("")) != "").distinct().groupBy(lat, lon).agg(F.count(F.lit(1)).alias("n_places"))
    out = df.join(n, [lat, lon], "left").withColumn("n_places", F.coalesce("n_places", F.lit(0)))
    return out.withColumn("shared", F.col("n_places") >= least)


def unique_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on a key that is unique on both sides; rows with repeated or null keys match nothing."""

    def once(df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c != key]
        return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_v")).filter("_n = 1").select(key, "_v.*")

    return once(left).join(once(right), key)


def percentile_by_index(df: DataFrame, keys: list[str], value: str, percents: list[int]) -> DataFrame:
    """Percentiles by the rule ``sorted[min(n * p div 100, n - 1)]``, and the maximum, of each key.

    Rows are first counted by (key, value), partially before the shuffle; running counts of the distinct values say
    where an index falls, so that a key is as large as its distinct values.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_k"))
    upto = F.sum("_k").over(Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("_upto", upto).withColumn("_n", F.sum("_k").over(Window.partitionBy(*keys)))
    at = lambda p: F.least(F.floor(F.col("_n") * p / 100), F.col("_n") - 1)
    return ranked.groupBy(*keys).agg(*[F.min(F.when(F.col("_upto") > at(p), F.col(value))).alias(f"p{p}") for p in percents], F.max(value).alias("max"))


def filled_measures(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, name, value): a row for each of the columns that is not null."""
    return df.unpivot(keys, columns, "name", "value").filter(F.col("value").isNotNull())


def fill_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, filled, total): one pass for all columns; empty texts count as missing."""
    filled = [F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "").alias(f"_{i}") for i, c in enumerate(columns)]
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *filled)
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("filled"), F.col("_all").alias("total")) for i, c in enumerate(columns)])))


def most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(k)


def reverse_index(df: DataFrame, value: str, code: str, separator: str = ";") -> DataFrame:
    """(value, n, codes) of a mapping: which codes lead to each value, codes sorted and joined by commas."""
    one = df.select(F.explode(F.split(value, separator)).alias(value), code).distinct()
    return one.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(F.col(code).cast("string"))), ",").alias("codes"))


def reverse_index_by(df: DataFrame, value: str, code: str, grade: str, grades: list[str], separator: str = ";") -> DataFrame:
    """(value, n, a column of codes a grade): which codes lead to each value, split by how exact the mapping is.

    Codes are reduced to distinct (value, code, grade) before they are gathered; a grade outside of the list is an error.
    """
    known = F.when(F.col(grade).isin(*grades), F.col(grade)).otherwise(F.raise_error(F.concat(F.lit("unknown grade: "), F.coalesce(grade, F.lit("")))))
    one = df.select(F.explode(F.split(value, separator)).alias(value), F.col(code).cast("string").alias("_code"), known.alias("_grade")).filter(F.col(value) != "").distinct()
    lists = [F.array_join(F.array_sort(F.collect_set(F.when(F.col("_grade") == g, F.col("_code")))), ",").alias(g) for g in grades]
    return one.groupBy(value).agg(F.count_distinct("_code").alias("n"), *lists)


def review_list(df: DataFrame, total: str, columns: list[str]) -> DataFrame:
    """Rows with the largest totals first, ties by the other columns, all descending."""
    return df.select(total, *columns).orderBy(*[F.desc(c) for c in (total, *columns)])


def first_rows(df: DataFrame, order: str, key: str, n: int) -> DataFrame:
    """The first ``n`` rows with a key, by their place in the source."""
    return df.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").orderBy(order).limit(n)


def set_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(side, key): keys of one side that the other lacks."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    only = lambda x, y, side: x.join(y, key, "left_anti").select(F.lit(side).alias("side"), key)
    return only(a, b, "left_only").unionByName(only(b, a, "right_only"))


def bounding_boxes(df: DataFrame, key: str, lat: str, lon: str, groups: int | None = None) -> DataFrame:
    """(key, lat_min, lat_max, lon_min, lon_max). With ``groups`` another number of keys is an error: a box a prefecture."""
    boxes = df.groupBy(key).agg(F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"), F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"))
    if groups is None:
        return boxes
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))  # one row a prefecture
    wrong = F.raise_error(F.concat(F.lit(f"{groups} boxes are expected, there are "), F.col("_n").cast("string")))
    return boxes.withColumn("_n", n).withColumn(key, F.when(F.col("_n") == groups, F.col(key)).otherwise(wrong)).drop("_n")


def facility_types(df: DataFrame, table: DataFrame, sector: str, condition: str, value: str) -> DataFrame:
    """``df`` with the value of (sector, condition), else of the sector without a condition; none is an error.

    ``table`` is the mapping of some dozen rows. A null condition is the empty one.
    """
    cond = F.coalesce(F.col(condition), F.lit(""))
    pairs = table.select(F.col(sector).alias("_s"), F.coalesce(F.col(condition), F.lit("")).alias("_c"), F.col(value).alias("_v"))
    own = df.join(pairs, (F.col(sector) == F.col("_s")) & (cond == F.col("_c")), "left").drop("_s", "_c").withColumnRenamed("_v", "_own")
    plain = pairs.filter("_c = ''").select("_s", F.col("_v").alias("_plain"))
    out = own.join(plain, F.col(sector) == F.col("_s"), "left").drop("_s")
    miss = F.raise_error(F.concat(F.lit("no facility type for "), F.coalesce(sector, F.lit("")), F.lit(" / "), cond))
    return out.withColumn(value, F.coalesce("_own", "_plain", miss)).drop("_own", "_plain")


def beds_condition(sector: Column, beds: Column, few: str = "病床0または空欄", some: str = "病床1以上") -> Column:
    """The condition that splits clinics by their beds; other sectors have none."""
    return F.when(sector == "clinic", F.when(beds.rlike("^[0-9]+$") & (beds.try_cast("long") > 0), some).otherwise(few)).otherwise("")


def issues(df: DataFrame, key: str, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(kind, id, detail) of every rule (condition, detail) that a row breaks; one pass, no join."""
    found = F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), detail.cast("string").alias("detail"))) for kind, (cond, detail) in rules.items()])
    return df.select(F.inline(F.array_compact(found)))


def assert_none(df: DataFrame, message: str) -> None:
    """Stop before anything is written if a guard's rows exist."""
    rows = df.limit(3).collect()
    if rows:
        raise ValueError(f"{message}: {rows}")
