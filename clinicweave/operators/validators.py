"""Validators: every finding is a row (kind, id, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicweave.functions.calendar import HOURS, SPAN, calendar, ever_open, ever_unknown, parse_rules
from clinicweave.functions.geo import LAT_BOUNDS, LON_BOUNDS, in_country, number
from clinicweave.functions.hours import let
from clinicweave.operators.tables import issues
from clinicweave.sources.files import read_csv, with_rows
from clinicweave.sources.geojson import ANY_GEOMETRY, read_features

# The longest tag, the values of facility tags, the format of keys and addresses.
MOST_CHARS = 255
AMENITIES = ("hospital", "clinic", "doctors", "dentist", "pharmacy")
HEALTHCARE = ("hospital", "clinic", "doctor", "dentist", "pharmacy", "midwife")
KEY = "^[A-Za-z][A-Za-z0-9_:-]*$"
ADDRESS = r"(?U)^https?://\S+$"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
VALUE = "^[a-z][a-z0-9_]*$"
#: Kinds that inform and do not fail a run.
INFORMATIONAL = ("addr_note_chiban", "coord_cross_city")

_SCHEMA = "kind string, id string, detail string"


def _filled(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def value_list_issues(df: DataFrame, key: str, value: str, vocabulary: DataFrame) -> DataFrame:
    """Findings in lists of values joined by ``;``: too_long, bad_format, unknown_value, duplicated.

    ``vocabulary`` has one column of known values. Values are exploded once and meet it as distinct values, so that a
    frequent one is one row of the join.
    """
    rows = df.filter(_filled(F.col(value))).select(F.col(key).cast("string").alias("id"), F.col(value).alias("v"))
    parts = F.split("v", ";", -1)
    again = F.filter(F.array_distinct(F.filter(parts, lambda p: F.size(F.filter(parts, lambda q: q == p)) > 1)), lambda p: p.isNotNull())
    whole = issues(rows, "id", {
        "too_long": (F.length("v") > MOST_CHARS, F.length("v")),
        "bad_format": (F.exists(parts, lambda p: p == ""), F.lit("")),
        "duplicated": (F.size(again) > 0, F.array_join(again, ",")),
    })
    each = rows.select("id", F.explode(parts).alias("detail")).filter("detail != ''")
    bad = each.filter(~F.col("detail").rlike(VALUE)).select(F.lit("bad_format").alias("kind"), "id", "detail")
    good = each.filter(F.col("detail").rlike(VALUE))
    known = vocabulary.toDF("detail").distinct()
    unknown = good.select("detail").distinct().join(known, "detail", "left_anti")
    return whole.unionByName(bad).unionByName(good.join(unknown, "detail").select(F.lit("unknown_value").alias("kind"), "id", "detail"))


def name_issues(df: DataFrame, key: str, original: str, prefixes: list[str], *, name: str = "name", official: str = "official_name", reading: str = "name:ja-Hira", english: str = "name:en", latin: str = "name:ja-Latn") -> DataFrame:
    """Findings in names: empty, too long, a legal form left in front, an official name that is not the original, katakana in
    a reading, other than ASCII in English or Latin, Latin without a reading or beside English."""
    n, o, h, e, x, source = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (name, official, reading, english, latin, original))
    left = F.filter(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.startswith(n, p)) if prefixes else F.array().cast("array<string>")
    ascii_only = lambda c: c.rlike(r"^[\x20-\x7E]*$")
    katakana = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(h, F.lit("[ァ-ヴ]"), F.lit(0)))), "")
    return issues(df, key, {
        "name_empty": (n == "", F.lit("")),
        "name_too_long": (F.length(n) > MOST_CHARS, F.length(n)),
        "entity_left": (F.size(left) > 0, F.get(left, 0)),
        "official_missing": (o == "", F.lit("")),
        "official_altered": ((o != "") & (o != source), o),
        "hira_katakana_left": (katakana != "", katakana),
        "en_not_ascii": (~ascii_only(e), e),
        "latn_not_ascii": (~ascii_only(x), x),
        "latn_without_hira": ((x != "") & ascii_only(x) & (h == ""), x),
        "latn_and_en": ((x != "") & (e != ""), F.concat_ws("/", e, x)),
    })


def tag_issues(df: DataFrame, tags: list[str], prefectures: dict[str, str], *, key: str = "ID", code: str = "都道府県コード", residue: str = "未解釈の文字列") -> DataFrame:
    """Findings in rows of the output table: coordinates, missing name and type, unknown values, address levels,
    prefecture, web address, and for each of ``tags`` its key, length, control characters and blanks around it.

    A row whose coordinates are not numbers has that finding only. Without the residue column ``missing_column`` says
    that one rule could not run.
    """
    get = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in df.columns else F.lit("")
    lat, lon = number(get("lat")), number(get("lon"))
    numeric = lat.isNotNull() & lon.isNotNull()
    names = F.create_map(*[F.lit(x) for kv in prefectures.items() for x in kv]) if prefectures else F.expr("map('', '')")
    rules = {
        "coord_range": (~numeric | ~in_country(lat, lon), F.concat_ws(", ", get("lat"), get("lon"))),
        "name_missing": (numeric & (get("name") == ""), F.lit("")),
        "type_missing": (numeric & (get("amenity") == "") & (get("healthcare") == ""), F.lit("")),
        "unknown_value:amenity": (numeric & (get("amenity") != "") & ~get("amenity").isin(*AMENITIES), get("amenity")),
        "unknown_value:healthcare": (numeric & (get("healthcare") != "") & ~get("healthcare").isin(*HEALTHCARE), get("healthcare")),
        "addr_hierarchy": (numeric & (get("addr:housenumber") != "") & (get("addr:neighbourhood") == ""), get("addr:housenumber")),
        "addr_note_chiban": (numeric & get(residue).rlike(r"^\p{Nd}"), get(residue)),
        "addr_province_mismatch": (numeric & (get("addr:province") != "") & (names[get(code)] != get("addr:province")), get("addr:province")),
        "bad_website": (numeric & (get("website") != "") & ~get("website").rlike(ADDRESS), F.substring(get("website"), 1, 60)),
    }
    for tag in tags:
        v = get(tag)
        rules |= {
            f"bad_key:{tag}": (numeric & (v != "") & ~F.lit(tag).rlike(KEY), F.lit(tag)),
            f"tag_too_long:{tag}": (numeric & (F.length(v) > MOST_CHARS), F.lit(tag)),
            f"control_char:{tag}": (numeric & v.rlike(CONTROL), F.lit(tag)),
            f"untrimmed:{tag}": (numeric & v.rlike(r"(?U)^\s|\s$"), F.lit(tag)),
        }
    out = issues(df, key, rules).withColumn("kind", F.split_part("kind", F.lit(":"), F.lit(1)))
    if residue not in df.columns:
        out = out.unionByName(df.limit(1).select(F.lit("missing_column").alias("kind"), F.lit("-").alias("id"), F.lit(residue).alias("detail")))
    return out


def cross_city_issues(df: DataFrame, *, key: str = "ID", code: str = "都道府県コード", city: str = "addr:city") -> DataFrame:
    """coord_cross_city of the rows whose point also belongs to a row of another city; the detail is the number of rows."""
    place = F.struct(F.coalesce(F.col(code), F.lit("")).alias("p"), F.coalesce(F.col(f"`{city}`"), F.lit("")).alias("c"))
    rows = df.select(F.col(key).cast("string").alias("id"), "lat", "lon", place.alias("place"))
    points = rows.groupBy("lat", "lon", "place").agg(F.count(F.lit(1)).alias("n")).groupBy("lat", "lon").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("places")).filter("places > 1")
    return rows.join(points, ["lat", "lon"]).select(F.lit("coord_cross_city").alias("kind"), "id", F.col("n").cast("string").alias("detail"))


def feature_issues(table: DataFrame, features: DataFrame, order: str = "_row", key: str = "ID") -> DataFrame:
    """Findings in features (_row, id, type, x, y) against the table (_row, ID): swapped or far coordinates, other
    geometries, a different number, and the first row whose id differs where the numbers agree."""
    x, y = F.col("x"), F.col("y")
    swapped = x.between(*LAT_BOUNDS) & y.between(*LON_BOUNDS)
    point = F.col("type") == "Point"
    found = issues(features, "id", {
        "geojson_structure": (~point | x.isNull() | y.isNull(), F.col("type")),
        "coord_order": (point & swapped, F.concat_ws(", ", x, y)),
        "coord_range": (point & ~swapped & ~in_country(y, x), F.concat_ws(", ", x, y)),
    })
    counts = table.agg(F.count(F.lit(1)).alias("rows")).crossJoin(features.agg(F.count(F.lit(1)).alias("features")))  # one row each
    differ = counts.filter("rows != features").select(F.lit("count_mismatch").alias("kind"), F.lit("-").alias("id"), F.concat_ws("/", "rows", "features").alias("detail"))
    both = table.select(order, F.col(key).cast("string").alias("a")).join(features.select(order, F.col("id").cast("string").alias("b")), order).filter("a != b")
    first = both.agg(F.min_by(F.struct("a", "b"), order).alias("m")).filter("m is not null").select(F.lit("id_mismatch").alias("kind"), F.col("m.a").alias("id"), F.col("m.b").alias("detail"))
    return found.unionByName(differ).unionByName(first.join(differ.select(F.lit(1).alias("one")), F.lit(True), "left_anti"))


def split_issues(whole: DataFrame, parts: DataFrame, code: str = "code") -> DataFrame:
    """Findings in parts by prefecture against the whole table: rows, missing and extra codes; both have one row a record."""
    a = whole.groupBy(code).agg(F.count(F.lit(1)).alias("a"))
    b = parts.groupBy(code).agg(F.count(F.lit(1)).alias("b"))
    both = a.join(b, code, "full")
    text = lambda c: F.array_join(F.array_sort(F.collect_list(F.when(c, F.col(code).cast("string")))), ",")
    sums = both.agg(F.sum(F.coalesce("a", F.lit(0))).alias("a"), F.sum(F.coalesce("b", F.lit(0))).alias("b"), text(F.col("b").isNull()).alias("missing"), text(F.col("a").isNull()).alias("extra"))
    return issues(sums.withColumn("id", F.lit("-")), "id", {
        "pref_split_row_mismatch": (F.col("a") != F.col("b"), F.concat_ws("/", "b", "a")),
        "pref_split_missing": (F.col("missing") != "", F.col("missing")),
        "pref_split_extra": (F.col("extra") != "", F.col("extra")),
    })


def written_issues(spark: SparkSession, base: str, prefectures: dict[str, str], *, tags: list[str], parts: str | None = None, corrected: str | None = None, key: str = "ID", code: str = "都道府県コード") -> DataFrame:
    """All findings in ``<base>.csv`` and ``<base>.geojson`` as they were written.

    Both files are read back: the collection's type, every feature, numbers and order of ids against the table's rows, and
    every rule on rows and tags. ``parts`` is a folder of CSV parts, one folder ``<code>=...`` a prefecture, that must hold
    the same rows; ``corrected`` is the table that the notes come from. What is missing of the two is not checked.
    """
    raw = read_csv(spark, f"{base}.csv", [key, code])
    table = with_rows(raw)
    kinds = spark.read.text(f"{base}.geojson", lineSep='"features"').limit(1)
    root = issues(kinds.withColumn("id", F.lit("-")), "id", {"geojson_structure": (~F.coalesce(F.get_json_object(F.concat(F.regexp_replace("value", r",\s*$", ""), F.lit("}")), "$.type"), F.lit("")).eqNullSafe("FeatureCollection"), F.substring("value", 1, 60))})
    features = with_rows(read_features(spark, f"{base}.geojson", schema=ANY_GEOMETRY)).withColumn("_c", F.from_json("geometry.coordinates", "array<double>"))
    pair = (F.col("geometry.type") == "Point") & (F.size("_c") == 2)
    at = lambda i: F.when(pair, F.get("_c", F.lit(i)))
    flat = features.select("_row", F.coalesce(F.element_at("properties", "_id"), F.concat(F.lit("#"), F.col("_row").cast("string"))).alias("id"), F.coalesce("geometry.type", F.lit("")).alias("type"), at(0).alias("x"), at(1).alias("y"))
    found = root.unionByName(feature_issues(table, flat, key=key)).unionByName(tag_issues(raw, tags, prefectures, key=key, code=code)).unionByName(cross_city_issues(raw, key=key, code=code))
    if parts:
        pieces = spark.read.options(header=True, multiLine=True, escape='"').csv(parts)
        found = found.unionByName(split_issues(raw.filter(_filled(F.col(code))).select(F.col(code).alias("code")), pieces.select(F.col(code).alias("code"))))
    if corrected:
        found = found.unionByName(reason_issues(read_csv(spark, corrected, [key]), key=key))
    return found


def reason_issues(df: DataFrame, *, key: str = "ID", reason: str = "座標の理由", note: str = "備考") -> DataFrame:
    """coord_reason_mismatch where a row has a reason and its note does not begin with it."""
    why = F.trim(F.coalesce(F.col(reason), F.lit("")))
    head = F.split_part(F.coalesce(F.col(note), F.lit("")), F.lit(" / "), F.lit(1))
    return issues(df, key, {"coord_reason_mismatch": ((why != "") & (head != why), F.substring(head, 1, 60))})


# What is said of hours that never open, without and with days of unknown state.
NEVER_OPEN, ONLY_UNKNOWN = "連続13週間で一度も開かない", "連続13週間で確実に開く時間が無い（状態が unknown のみ）"


def hours_issues(df: DataFrame, key: str, value: str = "opening_hours", days: Column | None = None) -> DataFrame:
    """Findings in opening hours: error (outside of the grammar), never_open, zero_span, too_long, warning.

    Each different value is read once and evaluated against a calendar (13 weeks unless given): one without a certain
    opening on any day is never_open, whichever of its rules override each other. A span with equal ends is a zero_span,
    one that runs over midnight for 12 hours or more a warning. Null and empty values have no findings.
    """
    given = df.filter(F.coalesce(F.col(value), F.lit("")) != "").select(F.col(key).alias("_key"), F.col(value).alias("_v"))
    v, days = F.col("_v"), calendar() if days is None else days
    spans = F.regexp_extract_all(F.regexp_replace(v, '"[^"]*"', ""), F.lit(SPAN), F.lit(0))
    minutes = lambda s, at: F.substring(s, at, 2).cast("int") * 60 + F.substring(s, at + 3, 2).cast("int")
    zero = F.filter(spans, lambda s: minutes(s, 1) == minutes(s, 7))
    long_night = F.filter(spans, lambda s: (minutes(s, 7) < minutes(s, 1)) & (minutes(s, 7) + 1440 - minutes(s, 1) >= 720))
    read = let(parse_rules(v), lambda r: F.struct(ever_open(r, days).alias("open"), ever_unknown(r, F.slice(days, 1, 35)).alias("unsure")))
    values = given.select("_v").distinct().withColumn("_valid", v.rlike(HOURS)).withColumn("_state", F.when(F.col("_valid"), read))
    values = values.select("_v", "_valid", "_state", F.array_join(zero, ",").alias("_zero"), F.array_join(long_night, ",").alias("_night"))
    valid = F.col("_valid")
    return issues(given.join(values, "_v").withColumnRenamed("_key", key), key, {
        "error": (~valid, F.substring(v, 1, 60)),
        "never_open": (valid & ~F.col("_state.open"), F.when(F.col("_state.unsure"), ONLY_UNKNOWN).otherwise(NEVER_OPEN)),
        "zero_span": (F.col("_zero") != "", F.col("_zero")),
        "too_long": (F.length(v) > MOST_CHARS, F.length(v)),
        "warning": (valid & (F.col("_night") != ""), F.col("_night")),
    })


#: Kinds of findings in hours that fail a run; a long value is cut later, a warning is a hint.
HOURS_FATAL = ("error", "never_open", "zero_span")


def fatal_hours(found: DataFrame) -> DataFrame:
    """The findings in hours that fail a run."""
    return found.filter(F.col("kind").isin(*HOURS_FATAL))


def fatal(found: DataFrame) -> DataFrame:
    """The findings in tags that fail a run."""
    return found.filter(~F.col("kind").isin(*INFORMATIONAL))
