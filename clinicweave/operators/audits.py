"""Audits of coordinates against objects of another map, matched by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.functions.kana import nfkc
from clinicweave.functions.text import decode_object_id
from clinicweave.operators.assembly import name_matches, share_over
from clinicweave.operators.tables import percentile_by_index

# Legal forms that are no part of a name, in this order, and characters that names are compared without.
ENTITIES = (
    "医療法人社団", "医療法人財団", "社会医療法人", "特定医療法人", "医療法人", "公益財団法人", "公益社団法人", "一般財団法人", "一般社団法人",
    "社会福祉法人", "独立行政法人", "地方独立行政法人", "国家公務員共済組合連合会", "公立学校共済組合", "学校法人", "株式会社", "有限会社", "合同会社",
)
PUNCTUATION = r"(?U)[\s　・･,，.．\-ー－‐−—()（）\[\]「」『』/／|｜]"
# Distances in metres from which a pair is reported, up to which it is one place, and the percentiles.
REPORT_FROM, SAME_PLACE, PERCENTS = 50.0, 2000.0, (50, 75, 90, 95, 99)
OBJECT_URL = "https://www.openstreetmap.org/"


def normal_name(name: Column) -> Column:
    """A name made comparable: plain forms of characters, no legal forms, no punctuation, lower case; null is empty."""
    out = nfkc(F.coalesce(name, F.lit("")))
    for word in ENTITIES:
        out = F.replace(out, F.lit(word), F.lit(""))
    return F.lower(F.regexp_replace(out, PUNCTUATION, ""))


def match_names(ours: DataFrame, theirs: DataFrame, name: str = "name", most_m: float = SAME_PLACE) -> DataFrame:
    """Pairs of one normalised name that is unique on both sides, with the distance ``m``; the other side has the prefix
    ``other_``. Names under three characters match nothing, and neither does a pair farther apart than ``most_m``."""
    keyed = [df.withColumn("_key", normal_name(F.col(name))).withColumn("_key", F.nullif(F.col("_key"), F.lit(""))) for df in (ours, theirs)]
    return name_matches(*keyed, "_key", most_m=most_m).drop("_key")


def object_url(raw: Column) -> Column:
    """The address of a map object by its prefixed id; an id of another form stands as it is."""
    o = decode_object_id(raw)
    return F.concat(F.lit(OBJECT_URL), F.when(o["type"].isNotNull(), F.concat(o["type"], F.lit("/"), o["number"].cast("string"))).otherwise(raw))


def distance_report(matched: DataFrame, columns: list[str], other_id: str = "other_id", floor: float = REPORT_FROM) -> DataFrame:
    """Matched pairs farther apart than ``floor``, the farthest first: 距離m with one decimal, the given columns, the URL."""
    far = matched.filter(F.col("m") > floor).orderBy(F.desc("m"), *columns)
    return far.select(F.format_string("%.1f", "m").alias("距離m"), *columns, object_url(F.col(other_id)).alias("URL"))


def distance_summary(matched: DataFrame, group: str, floor: float = REPORT_FROM) -> DataFrame:
    """(group, over, n, percent, p50 ... p99, max): pairs over the floor and percentiles of the distance, a group a row."""
    return share_over(matched, group, "m", floor).join(percentile_by_index(matched, [group], "m", list(PERCENTS)), group)
