"""Assembly of facilities from their parts, audits against other sources, and summaries for notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.functions.geo import distance_m
from clinicweave.operators.tables import unique_match


def _stop(message: str, key: str) -> Column:
    return F.raise_error(F.concat(F.lit(message), F.coalesce(F.col(key).cast("string"), F.lit("null"))))


def unique_rows(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, n, row) with the other columns as a struct; a repeated key stops the job that reads it.

    The check is the aggregate by key that a join by the key needs anyway: no job and no shuffle of its own.
    """
    rest = [c for c in df.columns if c != key]
    one = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_row"))
    return one.select(key, F.when(F.col("_n") == 1, F.col("_row")).otherwise(_stop(f"{name}: repeated {key}: ", key)).alias(name))


def assemble(base: DataFrame, parts: dict[str, DataFrame], key: str = "ID") -> DataFrame:
    """``base`` with each part joined by the key, its columns as a struct under the part's name (null where it has none).

    A key that a table repeats stops the job, so that no row of the base multiplies; each table is read once.
    """
    out = unique_rows(base, key, "_base").select(key, *[F.col(f"_base.`{c}`").alias(c) for c in base.columns if c != key]).select(*[F.col(f"`{c}`") for c in base.columns])
    for name, part in parts.items():
        out = out.join(unique_rows(part, key, name), key, "left")
    return out


def union_sectors(tables: dict[str, DataFrame], column: str = "sector") -> DataFrame:
    """All tables with the sector's name in a column; columns that one lacks are null there."""
    out = None
    for name, df in tables.items():
        named = df.withColumn(column, F.lit(name))
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out


def matched_by_id(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Join of two tables that must have the same keys; a key of one side only stops the job, and is never skipped."""
    a, b = left.withColumn("_a", F.lit(True)), right.withColumn("_b", F.lit(True))
    both = a.join(b, key, "full")
    checked = F.when(F.col("_b").isNull(), _stop("not in the second table: ", key)).when(F.col("_a").isNull(), _stop("not in the first table: ", key)).otherwise(F.col(key))
    return both.withColumn(key, checked).drop("_a", "_b")


def with_required(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Join of the left side with its rows of the right one; a key that the right side lacks stops the job."""
    both = left.join(right.withColumn("_b", F.lit(True)), key, "left")
    return both.withColumn(key, F.when(F.col("_b").isNull(), _stop("missing: ", key)).otherwise(F.col(key))).drop("_b")


# The origin of points that the source gave, and the distance in metres that each level of an address allows.
SOURCE, ALLOWED = "原データ", {"8": 100.0, "3": 2000.0, "2": 10000.0}


def address_suspects(df: DataFrame, distance: str, level: str, origin: str, allowed: dict[str, float] = ALLOWED) -> DataFrame:
    """Rows of the source's own points that lie farther from their address than its level allows, the farthest first.

    Rows without a distance, of another origin or another level are none.
    """
    limit = F.create_map(*[F.lit(x) for kv in allowed.items() for x in kv])[F.col(level).cast("string")]
    return df.filter((F.col(origin) == SOURCE) & (F.col(distance) > limit)).orderBy(F.desc(distance), *[c for c in df.columns if c != distance])


def stop_over(df: DataFrame, distance: str, level: str, origin: str, most_m: float, at: str = "8") -> None:
    """Raises if one of the source's points at the most exact level is farther than ``most_m`` from its address."""
    over = df.filter((F.col(origin) == SOURCE) & (F.col(level).cast("string") == at) & (F.col(distance) > most_m)).count()
    if over:
        raise ValueError(f"level {at} over {most_m} m: {over}")


def with_decisions(conflicts: DataFrame, decisions: DataFrame, facilities: DataFrame, key: str = "id", day: str = "day") -> DataFrame:
    """Conflicts with their decision (empty if none) and what is known of the facility."""
    out = conflicts.join(decisions.select(key, day, "decision"), [key, day], "left").withColumn("decision", F.coalesce("decision", F.lit("")))
    return out.join(facilities, key, "left")


def with_coordinates(df: DataFrame, lat: str, lon: str, observation=None) -> DataFrame:
    """Rows with both coordinates. ``observation``, a Spark Observation, counts the others as the rows pass."""
    has = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    if observation is not None:
        df = df.observe(observation, F.count_if(~has).alias("dropped"))
    return df.filter(has)


def name_matches(ours: DataFrame, theirs: DataFrame, key: str, *, least_chars: int = 3, most_m: float = 2000.0) -> DataFrame:
    """Rows of both sides with one name that is unique on both, and the distance; farther pairs are not the same place.

    Both sides have lat and lon; the other side's columns get the prefix ``other_``.
    """
    named = ours.filter(F.length(key) >= least_chars)
    other = theirs.select(F.col(key), *[F.col(c).alias(f"other_{c}") for c in theirs.columns if c != key])
    met = unique_match(named, other, key)
    return met.withColumn("m", distance_m(F.col("lat"), F.col("lon"), F.col("other_lat"), F.col("other_lon"))).filter(F.col("m") <= most_m)


def centroid(rings: Column) -> Column:
    """Struct (lon, lat) of the mean of all vertices of an array of arrays of [lon, lat]; one vertex is its own mean."""
    points = F.flatten(rings)
    mean = lambda i: F.aggregate(points, F.lit(0.0), lambda a, p: a + p[i]) / F.size(points)
    return F.when(F.size(points) > 0, F.struct(mean(0).alias("lon"), mean(1).alias("lat")))


def share_over(df: DataFrame, key: str, value: str, bound: float) -> DataFrame:
    """(key, over, n, percent): rows above a bound."""
    out = df.groupBy(key).agg(F.count_if(F.col(value) > bound).alias("over"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("percent", F.round(F.col("over") * 100.0 / F.col("n"), 2))


def drift_rule_applies(level: Column, evidence: Column, distance: Column, adopt: int = 8) -> Column:
    """Whether a row was subject to the rule on points far from their address."""
    return F.coalesce(level.rlike(r"^\d+$") & (level.try_cast("int") >= adopt) & (evidence == "照合済み") & distance.isNotNull(), F.lit(False))


def reason_summaries(df: DataFrame, key: str, reason: str, example: str, order: str, examples: int = 2) -> DataFrame:
    """(key, reason, n, text) of the rows of each reason: the first examples, and how many more there are.

    A facility's rows are its intervals of a week, so that the list of a (key, reason) is short.
    """
    lists = df.groupBy(key, reason).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(example).alias("x")))).alias("l"))
    first = F.array_join(F.transform(F.slice("l", 1, examples), lambda x: x["x"]), "、")
    more = F.when(F.col("n") > examples, F.concat(F.lit(" 他"), (F.col("n") - examples).cast("string"), F.lit("件"))).otherwise("")
    return lists.select(key, reason, "n", F.concat(first, more).alias("text"))


def decision_counts(df: DataFrame, key: str, decision: str, order: str) -> DataFrame:
    """(key, text): a key's decisions in the order in which they first occur, with ``×n`` where one occurs more than once."""
    one = df.groupBy(key, decision).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("o"))
    label = F.when(F.col("n") > 1, F.concat(F.col(decision), F.lit("×"), F.col("n").cast("string"))).otherwise(F.col(decision))
    lists = one.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("o", label.alias("t")))).alias("l"))
    return lists.select(key, F.array_join(F.transform("l", lambda x: x["t"]), "、").alias("text"))


def departments(df: DataFrame, key: str, code: str, name: str, order: str) -> DataFrame:
    """(key, departments): array of (code, name) sorted by code, the name being the last that a code has."""
    last = df.groupBy(key, code).agg(F.max_by(name, order).alias("name"))
    return last.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(code).alias("code"), "name"))).alias("departments"))
