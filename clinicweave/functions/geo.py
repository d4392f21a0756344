"""Coordinates as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean radius of the earth in metres; bounds that hold all islands of the country.
EARTH_M = 6_371_000.0
LAT_BOUNDS, LON_BOUNDS = (20.0, 46.0), (122.0, 154.0)


def number(text: Column) -> Column:
    """A text as a finite double, else null."""
    v = text.try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def usable(text: Column) -> Column:
    """A finite coordinate that isn't 0."""
    return F.coalesce(number(text) != 0, F.lit(False))


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres (haversine)."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def on_coarse_grid(lat: Column, lon: Column) -> Column:
    """Both axes are multiples of 0.1 degrees."""
    tenth = lambda v: F.abs(v * 10 - F.round(v * 10)) < 1e-9
    return tenth(lat) & tenth(lon)


def in_country(lat: Column, lon: Column) -> Column:
    return (lat > LAT_BOUNDS[0]) & (lat < LAT_BOUNDS[1]) & (lon > LON_BOUNDS[0]) & (lon < LON_BOUNDS[1])


def in_box(box: Column, lat: Column, lon: Column, margin: float = 0.0) -> Column:
    """Inside a struct (lat_min, lat_max, lon_min, lon_max), borders included."""
    return lat.between(box["lat_min"] - margin, box["lat_max"] + margin) & lon.between(box["lon_min"] - margin, box["lon_max"] + margin)


def other_boxes(boxes: list[dict], own: Column, lat: Column, lon: Column, margin: float = 0.05) -> Column:
    """Names of the boxes that hold a point which its own box, widened by ``margin``, doesn't; null if its own does,
    if no own box is known, or if no other holds it. ``boxes``: dicts of name and bounds, a table of some dozens."""
    table = F.array(*[F.struct(*[F.lit(b[k]).alias(k) for k in ("name", "lat_min", "lat_max", "lon_min", "lon_max")]) for b in boxes])
    home = F.filter(table, lambda b: b["name"] == own)
    others = F.transform(F.filter(table, lambda b: (b["name"] != own) & in_box(b, lat, lon)), lambda b: b["name"])
    outside = (F.size(home) > 0) & ~F.exists(home, lambda b: in_box(b, lat, lon, margin))
    return F.when(outside & (F.size(others) > 0), others)


def provenance(src_lat: Column, src_lon: Column, adr_lat: Column, adr_lon: Column, level: Column, note: Column, evidence: Column, elsewhere: Column, adopt: int = 8, drift_m: float = 1000.0) -> Column:
    """Struct (lat, lon, origin, gap, review, reason_kind): which coordinate to trust, first rule that fits.

    An address point of the adopted level with checked numbers more than ``drift_m`` away, or of level 3 with the
    source point in another prefecture, replaces the source; else a source with both axes usable stays; else the
    address decides: lot-number addresses, unresolved ones and low levels leave a gap.
    """
    both = usable(src_lat) & usable(src_lon)
    point = usable(adr_lat) & usable(adr_lon)
    far = distance_m(number(src_lat), number(src_lon), number(adr_lat), number(adr_lon)) > drift_m
    drifted = both & (level >= adopt) & (evidence == "照合済み") & point & far
    misplaced = both & (level >= 3) & point & F.coalesce(elsewhere, F.lit(False))

    def result(lat, lon, origin, gap, review, kind) -> Column:
        return F.struct(lat.alias("lat"), lon.alias("lon"), F.lit(origin).alias("origin"), F.lit(gap).alias("gap"), F.lit(review).alias("review"), F.lit(kind).alias("reason_kind"))

    none = F.lit(None).cast("string")
    return (
        F.when(drifted, result(adr_lat, adr_lon, "ジオコーディング", "", "yes", "drift"))
        .when(misplaced, result(adr_lat, adr_lon, "ジオコーディング", "", "yes", "prefecture"))
        .when(both, result(F.trim(src_lat), F.trim(src_lon), "原データ", "", "", "source"))
        .when(note == "地番方式のため対象外", result(none, none, "なし", "地番方式", "yes", "address"))
        .when(~point, result(none, none, "なし", "解決できず", "yes", "address"))
        .when(level >= adopt, result(adr_lat, adr_lon, "ジオコーディング", "", "", "address"))
        .otherwise(result(none, none, "なし", "位置レベル不足", "yes", "address"))
    )


def number_verdict(has_block: Column, known: Column, in_residence: Column, in_lots: Column, has_residence_list: Column) -> Column:
    """Judgement of an inferred house number against the ledgers of its town."""
    return F.when(~has_block, "").when(~known, "判定不能").when(in_residence, "").when(in_lots, "地番").when(~has_residence_list, "判定不能").otherwise("不一致")


def address_with_numbers(base: Column, block: Column, house: Column) -> Column:
    """The address rebuilt with block and house number for a second lookup; null without a block number."""
    tail = F.when(F.coalesce(house, F.lit("")) != "", F.concat(house, F.lit("号"))).otherwise("")
    return F.when(F.coalesce(block, F.lit("")) != "", F.concat(base, block, F.lit("番"), tail))


def adopt_recheck(before_evidence: Column, after_evidence: Column, same_numbers: Column) -> Column:
    """A second lookup counts only if it turns an inferred number into a checked one with the same numbers."""
    return F.coalesce((before_evidence == "推定") & (after_evidence == "照合済み") & same_numbers, F.lit(False))
