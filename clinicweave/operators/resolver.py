"""An address parser outside of Spark, as a step of a job, and the second look at what it only inferred."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicweave.functions.geo import address_with_numbers, adopt_recheck

#: Gets a batch of rows (key, address) and returns a row for each of them, in the same order, with the key first.
Resolver = Callable[[pd.DataFrame], pd.DataFrame]
#: What a resolver says of an address, besides the key.
RESOLVED = "evidence string, block string, house string, lat string, lng string, level string, note string"


def resolve(df: DataFrame, resolver: Resolver, key: str, address: str, columns: str = RESOLVED) -> DataFrame:
    """(key, columns) of every row, from a resolver that works batch by batch where the rows are.

    The resolver's answer is checked row for row: another number of rows, or another key at a place, stops the job, so
    that an answer is never taken for another row's. A lost task asks again. Null addresses are empty texts.
    """
    kind = dict(df.dtypes)[key]

    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for asked in batches:
            asked["address"] = asked["address"].fillna("")
            got = resolver(asked)
            if len(got) != len(asked):
                raise ValueError(f"{len(asked)} addresses were asked for, {len(got)} came back")
            if not (got.iloc[:, 0].to_numpy() == asked.iloc[:, 0].to_numpy()).all():
                raise ValueError("the answers are not in the order of the questions")
            yield got

    return df.select(F.col(key).alias("key"), F.col(address).alias("address")).mapInPandas(answers, f"key {kind}, {columns}").withColumnRenamed("key", key)


def recheck_inferred(first: DataFrame, resolver: Resolver, key: str, base: str) -> DataFrame:
    """``first`` (key, base address, and the columns of ``RESOLVED``) after a second look at inferred numbers.

    Only rows whose number is inferred are asked again, by an address of base and number alone. Where that number turns
    out as checked and is the same, its evidence, numbers, point, level and note replace the first ones, so that a
    checked number never keeps the point of its town; else the row stays as it is. ``recheck`` says which: adopted,
    rejected (checked, but another number), or null. Keys are unique.
    """
    again = address_with_numbers(F.col(base), F.col("block"), F.col("house"))
    asked = first.filter("evidence = '推定'").select(key, again.alias("_address")).filter("_address IS NOT NULL")
    names = [part.split()[0] for part in RESOLVED.split(", ")]
    second = resolve(asked, resolver, key, "_address").select(key, *[F.col(c).alias(f"_{c}") for c in names])
    same = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == F.trim(F.coalesce(F.col(f"_{c}"), F.lit("")))
    same_numbers = F.lit(True)
    for c in ("block", "house"):
        same_numbers = same_numbers & same(c)
    adopted = adopt_recheck(F.col("evidence"), F.col("_evidence"), same_numbers)
    rest = [c for c in first.columns if c not in names]
    outcome = F.when(adopted, "adopted").when(F.col("_evidence") == "照合済み", "rejected")
    joined = first.join(second, key, "left").withColumn("recheck", outcome)
    return joined.select(*rest, *[F.when(F.col("recheck") == "adopted", F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in names], "recheck")
