"""The operators as queries over the synthetic tables, each with the SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicweave.functions import geo as G
from clinicweave.functions import hours as H
from clinicweave.functions import text as X
from clinicweave.operators import assembly as A
from clinicweave.operators import intervals as I
from clinicweave.operators import tables as T

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (tables -> DataFrame) under its name, with its SQL."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))

        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- opening hours on events: a user is a facility, an event a slot -------------------------------------------------

MINUTE = "(hour(ts) * 60 + minute(ts))"
#: Slots with ends as a clock shows them, so that some run over midnight.
SLOTS_SQL = f"SELECT event_id, user_id AS id, CAST(isodow(ts) - 1 AS INTEGER) AS day, CAST({MINUTE} AS INTEGER) AS s, CAST(({MINUTE} + 15 + 9 * CAST(floor(abs(value)) AS BIGINT)) % 1440 AS INTEGER) AS e FROM events"
KIND_SQL = """CASE WHEN s = 0 AND e = 0 THEN 'null_placeholder' WHEN s = 0 AND e = 1439 THEN 'sentinel_24h'
 WHEN e < s AND e + 1440 - s >= 1080 THEN 'overnight_implausible' WHEN e >= s AND s < 360 THEN 'too_early' WHEN e >= s AND e > 1380 THEN 'too_late' END"""
GOOD_SQL = f"SELECT id, day, s, CASE WHEN e < s THEN e + 1440 ELSE e END AS e FROM ({SLOTS_SQL}) WHERE ({KIND_SQL}) IS NULL"
ISLANDS_SQL = """SELECT id, day, min(s) AS s, max(e) AS e FROM (SELECT *, sum(CASE WHEN s <= reached THEN 0 ELSE 1 END) OVER (PARTITION BY id, day ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island
 FROM (SELECT *, max(e) OVER (PARTITION BY id, day ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM good)) GROUP BY id, day, island"""
HHMM = lambda m: f"CASE WHEN {m} > 0 AND {m} % 1440 = 0 THEN '24:00' ELSE printf('%02d:%02d', ({m} // 60) % 24, {m} % 60) END"
DAY_NAMES = "['Mo','Tu','We','Th','Fr','Sa','Su','PH']"


def slots(t) -> DataFrame:
    minute = F.hour("ts") * 60 + F.minute("ts")
    end = ((minute + 15 + 9 * F.floor(F.abs("value"))) % 1440).cast("int")
    return t("events").select("event_id", F.col("user_id").alias("id"), F.weekday("ts").alias("day"), minute.alias("s"), end.alias("e"))


def good_slots(t) -> DataFrame:
    return I.split_intervals(slots(t)).filter("kind is null").select("id", "day", "s", "e")


@query(f"SELECT event_id, {KIND_SQL} AS kind FROM ({SLOTS_SQL})")
def interval_classify(t):
    return I.split_intervals(slots(t)).select("event_id", "kind")


@query(f"SELECT coalesce({KIND_SQL}, 'ok') AS kind, count(*) AS n, count(*) FILTER (e < s) AS overnight, CAST(sum(CASE WHEN e < s THEN e + 1440 ELSE e END) AS BIGINT) AS ends FROM ({SLOTS_SQL}) GROUP BY ALL")
def overnight_shift(t):
    rows = I.split_intervals(slots(t))
    return rows.groupBy(F.coalesce("kind", F.lit("ok")).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("e") >= H.DAY).alias("overnight"), F.sum("e").alias("ends"))


@query(f"WITH good AS ({GOOD_SQL}) {ISLANDS_SQL}")
def interval_union(t):
    return I.interval_union(good_slots(t), ["id", "day"])


@query(
    f"""WITH good AS ({GOOD_SQL}), merged AS ({ISLANDS_SQL}),
 spans AS (SELECT id, day, CASE WHEN max(e - s) >= 1440 THEN '00:00-24:00' ELSE string_agg({HHMM('s')} || '-' || {HHMM('e')}, ',' ORDER BY s) END AS times FROM merged GROUP BY id, day),
 runs AS (SELECT *, day - row_number() OVER (PARTITION BY id, times ORDER BY day) AS run, min(day) OVER (PARTITION BY id, times) AS first_day FROM spans),
 named AS (SELECT id, times, first_day, min(day) AS a, CASE WHEN count(*) >= 3 THEN {DAY_NAMES}[min(day) + 1] || '-' || {DAY_NAMES}[max(day) + 1] ELSE string_agg({DAY_NAMES}[day + 1], ',' ORDER BY day) END AS days FROM runs GROUP BY id, times, first_day, run),
 rules AS (SELECT id, first_day, string_agg(days, ',' ORDER BY a) || ' ' || times AS rule FROM named GROUP BY id, times, first_day)
 SELECT id, string_agg(rule, '; ' ORDER BY first_day) AS expression FROM rules GROUP BY id"""
)
def hours_expression(t):
    """Flagship: slots to one expression a facility."""
    return I.week_expression(good_slots(t))


@query(
    f"""WITH d AS (SELECT DISTINCT user_id AS id, isodow(ts) - 1 AS day FROM events WHERE value < 3), r AS (SELECT *, day - row_number() OVER (PARTITION BY id ORDER BY day) AS run FROM d),
 n AS (SELECT id, min(day) AS a, CASE WHEN count(*) >= 3 THEN {DAY_NAMES}[min(day) + 1] || '-' || {DAY_NAMES}[max(day) + 1] ELSE string_agg({DAY_NAMES}[day + 1], ',' ORDER BY day) END AS days FROM r GROUP BY id, run)
 SELECT id, string_agg(days, ',' ORDER BY a) AS days FROM n GROUP BY id"""
)
def day_runs(t):
    days = t("events").filter("value < 3").groupBy(F.col("user_id").alias("id")).agg(F.array_sort(F.collect_set(F.weekday("ts"))).alias("d"))
    return days.select("id", H.fold_days(F.col("d")).alias("days"))


ORDINAL_SQL = "CAST([0,31,60,91,121,152,182,213,244,274,305,335][month(o_orderdate)] + day(o_orderdate) - 1 AS INTEGER)"
MD = lambda x: f"strftime(DATE '2024-01-01' + CAST({x} AS INTEGER), '%b %d')"


@query(
    f"""WITH d AS (SELECT DISTINCT o_custkey AS id, {ORDINAL_SQL} AS o FROM orders), r AS (SELECT id, o, o - row_number() OVER (PARTITION BY id ORDER BY o) AS run FROM d),
 s AS (SELECT id, min(o) AS a, max(o) AS b, count(*) OVER (PARTITION BY id) AS n FROM r GROUP BY id, run),
 w AS (SELECT *, n > 1 AND min(a) OVER (PARTITION BY id) = 0 AND max(b) OVER (PARTITION BY id) = 365 AS wraps, min(b) FILTER (a = 0) OVER (PARTITION BY id) AS head_end FROM s),
 j AS (SELECT id, a, CASE WHEN wraps AND b = 365 THEN head_end ELSE b END AS b FROM w WHERE NOT (wraps AND a = 0))
 SELECT id, string_agg(CASE WHEN a = b THEN {MD('a')} ELSE {MD('a')} || '-' || {MD('b')} END, ',' ORDER BY a) AS dates FROM j GROUP BY id"""
)
def date_runs(t):
    o = H.day_of_leap_year(F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    days = t("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.array_sort(F.collect_set(o)).alias("d"))
    return days.select("id", H.fold_dates(F.col("d")).alias("dates"))


GRID_SQL = "SELECT u.id, CAST(d.day AS INTEGER) AS day, CASE WHEN (u.id * 7 + d.day) % 3 = 0 THEN '0' ELSE '1' END AS flag FROM (SELECT DISTINCT user_id AS id FROM events) u, range(7) d(day)"
COARSE_SQL = "SELECT DISTINCT user_id AS id, CAST(isodow(ts) - 1 AS INTEGER) AS day, CAST(hour(ts) // 6 * 360 AS INTEGER) AS s, CAST(hour(ts) // 6 * 360 + 360 AS INTEGER) AS e FROM events WHERE value < 3"


def day_grid(t) -> tuple[DataFrame, DataFrame]:
    users = t("events").select(F.col("user_id").alias("id")).distinct()
    flags = users.select("id", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("day")).withColumn("flag", F.when((F.col("id") * 7 + F.col("day")) % 3 == 0, "0").otherwise("1"))
    s = (F.floor(F.hour("ts") / 6) * 360).cast("int")
    coarse = t("events").filter("value < 3").select(F.col("user_id").alias("id"), F.weekday("ts").alias("day"), s.alias("s"), (s + 360).alias("e")).distinct()
    return flags, coarse


@query(f"WITH g AS ({GRID_SQL}), c AS (SELECT DISTINCT id, day, 1 AS has FROM ({COARSE_SQL})) SELECT * FROM (SELECT id, day, CASE WHEN flag = '0' AND has = 1 THEN 'closed_with_times' WHEN flag = '1' AND has IS NULL THEN 'open_without_times' END AS conflict FROM g LEFT JOIN c USING (id, day)) WHERE conflict IS NOT NULL")
def conflict_detect(t):
    return I.day_conflicts(*day_grid(t))


@query(
    f"""WITH g AS ({GRID_SQL}), c AS ({COARSE_SQL}), base AS (SELECT DISTINCT id, s, e FROM c JOIN g USING (id, day) WHERE flag = '1'),
 dropped AS (SELECT DISTINCT c.id, c.day FROM c JOIN g USING (id, day) WHERE flag = '0' AND EXISTS (SELECT 1 FROM base b WHERE b.id = c.id)
  AND NOT EXISTS (SELECT 1 FROM c x WHERE x.id = c.id AND x.day = c.day AND NOT EXISTS (SELECT 1 FROM base b WHERE b.id = x.id AND b.s = x.s AND b.e = x.e))),
 kept AS (SELECT DISTINCT id, day FROM c ANTI JOIN dropped USING (id, day)), missing AS (SELECT id, day FROM g ANTI JOIN kept USING (id, day) WHERE flag = '1'),
 txt AS (SELECT u.id, (SELECT string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) FROM kept WHERE kept.id = u.id) AS k, (SELECT string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) FROM dropped WHERE dropped.id = u.id) AS d, (SELECT string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) FROM missing WHERE missing.id = u.id) AS m FROM (SELECT DISTINCT id FROM g) u)
 SELECT id, coalesce(k, '') AS kept_days, coalesce(d, '') AS dropped_days, CASE WHEN k IS NOT NULL THEN coalesce(m, '') ELSE '' END AS unknown_days, k IS NULL AND m IS NOT NULL AS withheld FROM txt"""
)
def conflict_resolve(t):
    out = I.resolve_conflicts(*day_grid(t))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return out.select("id", text("kept_days"), text("dropped_days"), text("unknown_days"), "withheld")


@query(
    f"""WITH w AS (SELECT DISTINCT o_custkey AS id, isodow(o_orderdate) - 1 AS d, (day(o_orderdate) - 1) // 7 + 1 AS wk FROM orders),
 r AS (SELECT id, d, {DAY_NAMES}[d + 1] || '[' || string_agg(CAST(wk AS VARCHAR), ',' ORDER BY wk) || '] off' AS rule, count(*) AS n FROM w GROUP BY id, d) SELECT id, string_agg(rule, '; ' ORDER BY d) AS rules FROM r WHERE n < 5 GROUP BY id"""
)
def nth_week_rules(t):
    week = (F.floor((F.dayofmonth("o_orderdate") - 1) / 7) + 1).cast("int")
    weeks = t("orders").groupBy(F.col("o_custkey").alias("id"), F.weekday("o_orderdate").alias("d")).agg(F.array_sort(F.collect_set(week)).alias("w"))
    rules = weeks.withColumn("rule", H.nth_week_rule(F.col("d"), F.col("w"), F.lit(True))).filter("rule is not null")
    return rules.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("d", "rule"))), lambda x: x["rule"]), "; ").alias("rules"))


@query("SELECT l_orderkey, l_linenumber, name, value FROM (SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_discount AS discount, l_tax AS tax FROM lineitem) UNPIVOT (value FOR name IN (quantity, discount, tax)) WHERE value > 0.01")
def unpivot_measures(t):
    wide = t("lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    return T.filled_measures(wide, ["l_orderkey", "l_linenumber"], ["quantity", "discount", "tax"]).filter("value > 0.01")


# --- mappings, values, assembly -------------------------------------------------------------------------------------

OVERRIDE_SQL = "(VALUES ('', 1, 'small'), ('', 2, 'medium'), ('', 3, 'large'), ('Brand#11', 1, 'tiny'), ('Brand#22', 3, 'huge')) m(p_brand, code, label)"
PART_SQL = "SELECT p_partkey, p_brand, p_size % 5 AS code FROM part"


@query(f"SELECT p.p_partkey, p.p_brand, p.code, coalesce(o.label, g.label) AS label FROM ({PART_SQL}) p LEFT JOIN (SELECT * FROM {OVERRIDE_SQL}) o ON o.p_brand = p.p_brand AND o.code = p.code LEFT JOIN (SELECT * FROM {OVERRIDE_SQL}) g ON g.p_brand = '' AND g.code = p.code")
def mapping_override(t):
    part = t("part").select("p_partkey", "p_brand", (F.col("p_size") % 5).alias("code"))
    table = part.sparkSession.createDataFrame([("", 1, "small"), ("", 2, "medium"), ("", 3, "large"), ("Brand#11", 1, "tiny"), ("Brand#22", 3, "huge")], "p_brand string, code int, label string")
    return T.lookup_with_override(part, table, "p_brand", "code", "label").select("p_partkey", "p_brand", "code", "label")


def status_values(t) -> DataFrame:
    return t("orders").select(F.col("o_custkey").alias("id"), "o_orderkey", F.concat_ws(";", F.col("o_orderpriority"), F.col("o_orderstatus")).alias("v"))


VALUES_SQL = "SELECT id, v, min(o * 2 + i) AS pos FROM (SELECT o_custkey AS id, o_orderkey AS o, unnest([o_orderpriority, o_orderstatus]) AS v, unnest([0, 1]) AS i FROM orders) GROUP BY id, v"


@query(f"SELECT id, string_agg(v, ';' ORDER BY pos) AS vals FROM ({VALUES_SQL}) GROUP BY id")
def ordered_distinct(t):
    return T.ordered_values(status_values(t), "id", "o_orderkey", "v").select("id", F.array_join("values", ";").alias("vals"))


ROLL = {"1-URGENT": "HIGH", "2-HIGH": "HIGH", "4-NOT SPECIFIED": "LOW", "5-LOW": "LOW"}


@query(
    f"""WITH v AS ({VALUES_SQL}), p AS (SELECT id, string_agg(v, ';' ORDER BY pos) AS txt FROM v GROUP BY id),
 r AS (SELECT id, string_agg(v, ';' ORDER BY pos) AS txt FROM (SELECT id, CASE v WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'HIGH' WHEN '4-NOT SPECIFIED' THEN 'LOW' WHEN '5-LOW' THEN 'LOW' ELSE v END AS v, min(pos) AS pos FROM v GROUP BY 1, 2) GROUP BY id)
 SELECT p.id, CASE WHEN length(p.txt) <= 36 THEN p.txt WHEN length(r.txt) <= 36 THEN r.txt ELSE 'general' END AS vals, CAST(CASE WHEN length(p.txt) <= 36 THEN 0 WHEN length(r.txt) <= 36 THEN 1 ELSE 2 END AS INTEGER) AS stage FROM p JOIN r USING (id)"""
)
def length_cap(t):
    values = T.ordered_values(status_values(t), "id", "o_orderkey", "v")
    return values.withColumn("f", T.fit_values(F.col("values"), ROLL, 36)).select("id", F.col("f.text").alias("vals"), F.col("f.stage").alias("stage"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal > 0 THEN 'clinic' WHEN c_mktsegment = 'BUILDING' THEN 'doctors' ELSE coalesce(CASE c_mktsegment WHEN 'MACHINERY' THEN 'hospital' WHEN 'AUTOMOBILE' THEN 'pharmacy' END, 'other') END AS amenity FROM customer")
def facility_type(t):
    c = t("customer").withColumn("cond", F.when(F.col("c_mktsegment") == "BUILDING", F.when(F.col("c_acctbal") > 0, "beds").otherwise("none")).otherwise(""))
    table = c.sparkSession.createDataFrame([("beds", "BUILDING", "clinic"), ("none", "BUILDING", "doctors"), ("", "MACHINERY", "hospital"), ("", "AUTOMOBILE", "pharmacy")], "cond string, c_mktsegment string, amenity string")
    return T.lookup_with_override(c, table, "cond", "c_mktsegment", "amenity").select("c_custkey", F.coalesce("amenity", F.lit("other")).alias("amenity"))


@query("SELECT c.c_custkey, c.c_name, n.n_name, r.r_name, coalesce(o.n, 0) AS n_orders, o.total FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey")
def assembly_join(t):
    o = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("total"))
    n = t("nation").withColumnRenamed("n_nationkey", "c_nationkey")
    r = t("region").withColumnRenamed("r_regionkey", "n_regionkey")
    out = t("customer").join(o, "c_custkey", "left").join(F.broadcast(n.join(F.broadcast(r), "n_regionkey", "left")), "c_nationkey", "left")
    return out.select("c_custkey", "c_name", "n_name", "r_name", F.coalesce("n", F.lit(0)).alias("n_orders"), "total")


@query("SELECT l_orderkey, arg_max(l_partkey, p) AS l_partkey, arg_max(l_quantity, p) AS l_quantity, max(p) AS p FROM (SELECT *, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 1000 + CAST(l_quantity AS BIGINT) AS p FROM lineitem) GROUP BY l_orderkey")
def last_wins(t):
    place = F.col("l_linenumber").cast("long") * 1_000_000_000 + F.col("l_partkey") * 1000 + F.col("l_quantity").cast("long")
    return T.last_wins(t("lineitem").select("l_orderkey", "l_partkey", "l_quantity", place.alias("p")), ["l_orderkey"], "p")


# --- coordinates ----------------------------------------------------------------------------------------------------

POINTS_SQL = """SELECT 'c' AS sector, c_custkey AS id, c_nationkey AS city, CAST(24 + (c_custkey * 7 % 2200) / 100.0 AS DOUBLE) AS lat, CAST(123 + (c_custkey % 310) / 10.0 AS DOUBLE) AS lon FROM customer
 UNION ALL SELECT 's', s_suppkey, s_nationkey, CAST(24 + (s_suppkey * 7 % 2200) / 100.0 AS DOUBLE), CAST(123 + (s_suppkey % 310) / 10.0 AS DOUBLE) FROM supplier"""


def points(t) -> DataFrame:
    at = lambda k: ((24 + (F.col(k) * 7 % 2200) / 100.0).cast("double").alias("lat"), (123 + (F.col(k) % 310) / 10.0).cast("double").alias("lon"))
    c = t("customer").select(F.lit("c").alias("sector"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("city"), *at("c_custkey"))
    return c.unionByName(t("supplier").select(F.lit("s").alias("sector"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("city"), *at("s_suppkey")))


@query(f"WITH p AS ({POINTS_SQL}), n AS (SELECT lat, lon, count(DISTINCT city) AS n_places FROM p GROUP BY 1, 2) SELECT sector, id, n_places, n_places >= 2 AS shared FROM p JOIN n USING (lat, lon)")
def shared_coord(t):
    return T.shared_points(points(t).withColumn("city", F.col("city").cast("string")), "lat", "lon", "city").select("sector", "id", "n_places", "shared")


@query(f"SELECT CAST(lat AS VARCHAR) || '/' || CAST(lon AS VARCHAR) AS point, count(*) AS n, count(DISTINCT city) AS cities FROM ({POINTS_SQL}) GROUP BY lat, lon HAVING count(DISTINCT city) >= 2".replace("CAST(lat AS VARCHAR) || '/' || CAST(lon AS VARCHAR)", "printf('%.2f/%.1f', lat, lon)"))
def cross_city(t):
    g = points(t).groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("city").alias("cities")).filter("cities >= 2")
    return g.select(F.format_string("%.2f/%.1f", "lat", "lon").alias("point"), "n", "cities")


@query(f"SELECT sector, id FROM ({POINTS_SQL}) WHERE abs(lat * 10 - round(lat * 10)) < 1e-9 AND abs(lon * 10 - round(lon * 10)) < 1e-9")
def coarse_grid(t):
    return points(t).filter(G.on_coarse_grid(F.col("lat"), F.col("lon"))).select("sector", "id")


HAVERSINE_SQL = "2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"


@query(f"SELECT a.sector, a.id, round({HAVERSINE_SQL}, 1) AS m FROM (SELECT *, lat + id % 7 * 0.01 AS lat2, lon - id % 5 * 0.01 AS lon2 FROM ({POINTS_SQL})) a, LATERAL (SELECT a.lat2 AS lat, a.lon2 AS lon) b")
def haversine_pairs(t):
    """The distance of each facility's two points."""
    p = points(t).withColumn("lat2", F.col("lat") + F.col("id") % 7 * F.lit(0.01)).withColumn("lon2", F.col("lon") - F.col("id") % 5 * F.lit(0.01))
    return p.select("sector", "id", F.round(G.distance_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")), 1).alias("m"))


#: Boxes of the regions of the synthetic points: name, bounds.
BOXES = [{"name": str(i), "lat_min": 24.0 + 4 * i, "lat_max": 29.0 + 4 * i, "lon_min": 123.0 + 5 * i, "lon_max": 131.0 + 5 * i} for i in range(5)]
BOX_SQL = "(VALUES " + ", ".join(f"('{b['name']}', {b['lat_min']}, {b['lat_max']}, {b['lon_min']}, {b['lon_max']})" for b in BOXES) + ") b(name, lat_min, lat_max, lon_min, lon_max)"


@query(
    f"""WITH p AS ({POINTS_SQL}), o AS (SELECT p.sector, p.id, b.name FROM p JOIN {BOX_SQL} ON b.name <> CAST(p.city % 5 AS VARCHAR) AND p.lat BETWEEN b.lat_min AND b.lat_max AND p.lon BETWEEN b.lon_min AND b.lon_max),
 home AS (SELECT p.sector, p.id FROM p JOIN {BOX_SQL} ON b.name = CAST(p.city % 5 AS VARCHAR) AND p.lat BETWEEN b.lat_min - 0.05 AND b.lat_max + 0.05 AND p.lon BETWEEN b.lon_min - 0.05 AND b.lon_max + 0.05)
 SELECT sector, id, string_agg(name, ',' ORDER BY name) AS others FROM o ANTI JOIN home USING (sector, id) GROUP BY sector, id"""
)
def out_of_box(t):
    found = points(t).withColumn("o", G.other_boxes(BOXES, (F.col("city") % 5).cast("string"), F.col("lat"), F.col("lon")))
    return found.filter("o is not null").select("sector", "id", F.array_join("o", ",").alias("others"))


ADDRESS_SQL = f"""SELECT id, CASE WHEN id % 11 = 0 THEN NULL ELSE lat END AS slat, CASE WHEN id % 13 = 0 THEN 0.0 ELSE lon END AS slon, CASE WHEN id % 7 = 0 THEN NULL ELSE lat + (id % 5) * 0.004 END AS alat, lon AS alon,
 CAST([1, 2, 3, 8][id % 4 + 1] AS INTEGER) AS level, CASE WHEN id % 17 = 0 THEN '地番方式のため対象外' ELSE '' END AS note, CASE WHEN id % 3 = 0 THEN '照合済み' ELSE '推定' END AS evidence, id % 19 = 0 AS elsewhere FROM ({POINTS_SQL})"""


@query(
    f"""WITH a AS ({ADDRESS_SQL}), b AS (SELECT *, coalesce(slat <> 0, false) AND coalesce(slon <> 0, false) AS src, coalesce(alat <> 0, false) AND coalesce(alon <> 0, false) AS pt FROM a),
 d AS (SELECT *, 2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin((radians(alat) - radians(slat)) / 2), 2) + cos(radians(slat)) * cos(radians(alat)) * pow(sin(radians(alon - slon) / 2), 2)))) AS m FROM b)
 SELECT id, CASE WHEN src AND level >= 8 AND evidence = '照合済み' AND pt AND m > 1000 THEN 'ジオコーディング' WHEN src AND level >= 3 AND pt AND elsewhere THEN 'ジオコーディング' WHEN src THEN '原データ' WHEN note = '地番方式のため対象外' THEN 'なし' WHEN NOT pt THEN 'なし' WHEN level >= 8 THEN 'ジオコーディング' ELSE 'なし' END AS origin,
 CASE WHEN src THEN '' WHEN note = '地番方式のため対象外' THEN '地番方式' WHEN NOT pt THEN '解決できず' WHEN level >= 8 THEN '' ELSE '位置レベル不足' END AS gap,
 CASE WHEN src AND level >= 8 AND evidence = '照合済み' AND pt AND m > 1000 THEN 'yes' WHEN src AND level >= 3 AND pt AND elsewhere THEN 'yes' WHEN src THEN '' WHEN note <> '' OR NOT pt OR level < 8 THEN 'yes' ELSE '' END AS review FROM d"""
)
def provenance_fold(t):
    k = F.col("id")
    p = points(t)
    text = lambda v: v.cast("string")
    p = p.select(
        "id", F.when(k % 11 != 0, text(F.col("lat"))).alias("slat"), F.when(k % 13 == 0, "0.0").otherwise(text(F.col("lon"))).alias("slon"), F.when(k % 7 != 0, text(F.col("lat") + (k % 5) * 0.004)).alias("alat"), text(F.col("lon")).alias("alon"),
        F.array(*map(F.lit, (1, 2, 3, 8)))[(k % 4).cast("int")].alias("level"), F.when(k % 17 == 0, "地番方式のため対象外").otherwise("").alias("note"), F.when(k % 3 == 0, "照合済み").otherwise("推定").alias("evidence"), (k % 19 == 0).alias("elsewhere"),
    )
    r = G.provenance(*[F.col(c) for c in ("slat", "slon", "alat", "alon", "level", "note", "evidence", "elsewhere")])
    return p.withColumn("r", r).select("id", "r.origin", "r.gap", "r.review")


@query(f"SELECT city, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max FROM ({POINTS_SQL}) GROUP BY city")
def bounding_box(t):
    return T.bounding_boxes(points(t), "city", "lat", "lon")


@query("WITH c AS (SELECT c_custkey % 1100 AS k, min(c_custkey) AS c_custkey FROM customer GROUP BY 1 HAVING count(*) = 1), s AS (SELECT s_suppkey * 9 % 1100 AS k, min(s_suppkey) AS s_suppkey FROM supplier GROUP BY 1 HAVING count(*) = 1) SELECT * FROM c JOIN s USING (k)")
def unique_match(t):
    c = t("customer").select((F.col("c_custkey") % 1100).alias("k"), "c_custkey")
    s = t("supplier").select((F.col("s_suppkey") * 9 % 1100).alias("k"), "s_suppkey")
    return T.unique_match(c, s, "k")


@query("WITH x AS (SELECT p_type, p_retailprice AS v, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice) - 1 AS i, count(*) OVER (PARTITION BY p_type) AS n FROM part) SELECT p_type, max(v) FILTER (i = least(n * 50 // 100, n - 1)) AS p50, max(v) FILTER (i = least(n * 99 // 100, n - 1)) AS p99, max(v) AS max FROM x GROUP BY p_type")
def percentile_rule(t):
    return T.percentile_by_index(t("part"), ["p_type"], "p_retailprice", [50, 99])


SUSPECT_SQL = f"SELECT sector, id, [2, 3, 8][id % 3 + 1] AS level, (id * 37 % 12000) * 1.0 AS m, id % 5 > 0 AS own FROM ({POINTS_SQL})"


@query(f"SELECT sector, id, CAST(level AS INTEGER) AS level, CAST(m AS DOUBLE) AS m FROM ({SUSPECT_SQL}) WHERE own AND m > CASE level WHEN 8 THEN 100 WHEN 3 THEN 2000 ELSE 10000 END")
def distance_suspects(t):
    """Points of the source that are farther from their address than their level allows; geocoded points are the address itself."""
    k = F.col("id")
    p = points(t).select("sector", "id", F.array(*map(F.lit, (2, 3, 8)))[(k % 3).cast("int")].alias("level"), (k * 37 % 12000).cast("double").alias("m"), F.when(k % 5 > 0, A.SOURCE).otherwise("ジオコーディング").alias("origin"))
    return A.address_suspects(p, "m", "level", "origin").select("sector", "id", "level", "m")


@query(f"WITH a AS ({ADDRESS_SQL}) SELECT CASE WHEN slat IS NULL THEN 'no source' WHEN alat IS NULL THEN 'no address point' WHEN level < 3 THEN 'low level' ELSE 'checked' END AS reason, count(*) AS n FROM a GROUP BY 1")
def reason_breakdown(t):
    k = F.col("id")
    reason = F.when(k % 11 == 0, "no source").when(k % 7 == 0, "no address point").when(k % 4 < 2, "low level").otherwise("checked")
    return points(t).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


# --- texts ----------------------------------------------------------------------------------------------------------

URL_SQL = "SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^https?://', '') WHEN 2 THEN regexp_replace(url, '^(https?)://', '\\1//') WHEN 3 THEN url || ' x' ELSE '' END AS u FROM pages"


@query(
    f"""SELECT page_id, CASE WHEN u = '' THEN '' WHEN length(u) > 255 THEN '' WHEN regexp_matches(u, '^https?://[^ ]+$') THEN u WHEN regexp_matches(u, '^https?//[^ ]+$') THEN regexp_replace(u, '^(https?)//', '\\1://') WHEN regexp_matches(u, '^[A-Za-z0-9][A-Za-z0-9.-]*[.][A-Za-z][A-Za-z]+(/[^ ]*)?$') THEN 'https://' || u ELSE '' END AS url,
 CASE WHEN u = '' THEN '' WHEN length(u) > 255 THEN 'too_long' WHEN regexp_matches(u, '^https?://[^ ]+$') THEN '' WHEN regexp_matches(u, '^https?//[^ ]+$') THEN 'colon_added' WHEN regexp_matches(u, '^[A-Za-z0-9][A-Za-z0-9.-]*[.][A-Za-z][A-Za-z]+(/[^ ]*)?$') THEN 'scheme_added' ELSE 'unusable' END AS note FROM ({URL_SQL})"""
)
def clean_url(t):
    k, u = F.col("page_id") % 5, F.col("url")
    u = F.when(k == 0, u).when(k == 1, F.regexp_replace(u, "^https?://", "")).when(k == 2, F.regexp_replace(u, "^(https?)://", "$1//")).when(k == 3, F.concat(u, F.lit(" x"))).otherwise("")
    return t("pages").select("page_id", X.clean_url(u).alias("r")).select("page_id", "r.url", "r.note")


NOTES_SQL = "SELECT o_custkey AS id, list('order ' || o_orderkey ORDER BY o_orderkey) AS notes FROM orders GROUP BY 1"


@query(f"SELECT id, CASE WHEN length(array_to_string(notes, ' / ')) <= 100 THEN array_to_string(notes, ' / ') ELSE (SELECT max_by(x, length(x)) FROM (SELECT unnest(list_transform(range(1, len(notes) + 1), lambda n: array_to_string(notes[:n], ' / '))) AS x) WHERE length(x) <= 100) END AS note FROM ({NOTES_SQL})")
def note_clip(t):
    notes = t("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("k"))
    text = F.array_join(F.transform("k", lambda k: F.concat(F.lit("order "), k.cast("string"))), " / ")
    return notes.select("id", X.clip_notes(text, 100).alias("note"))


@query("SELECT c_custkey, concat_ws(' / ', CASE WHEN c_acctbal < 0 THEN 'negative balance' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'building' END, CASE WHEN c_custkey % 3 = 0 THEN 'third' END) AS note FROM customer")
def note_join(t):
    return t("customer").select("c_custkey", X.join_notes([F.when(F.col("c_acctbal") < 0, "negative balance"), F.when(F.col("c_mktsegment") == "BUILDING", "building"), F.when(F.col("c_custkey") % 3 == 0, "third").otherwise("")]).alias("note"))


NUMBERS_SQL = "SELECT l_orderkey, l_linenumber, l_linenumber < 5 AS has_block, l_orderkey % 4 <> 0 AS known FROM lineitem"
RESIDENCE_SQL = "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey % 3 = 0"
LOTS_SQL = "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey % 3 = 1 AND l_quantity < 30"


@query(
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN NOT has_block THEN '' WHEN NOT known THEN '判定不能' WHEN EXISTS (SELECT 1 FROM ({RESIDENCE_SQL}) r WHERE r.l_orderkey = x.l_orderkey AND r.l_linenumber = x.l_linenumber) THEN '' WHEN EXISTS (SELECT 1 FROM ({LOTS_SQL}) r WHERE r.l_orderkey = x.l_orderkey AND r.l_linenumber = x.l_linenumber) THEN '地番'
 WHEN NOT EXISTS (SELECT 1 FROM ({RESIDENCE_SQL}) r WHERE r.l_orderkey = x.l_orderkey) THEN '判定不能' ELSE '不一致' END AS verdict FROM ({NUMBERS_SQL}) x"""
)
def number_judge(t):
    line, keys = t("lineitem"), ["l_orderkey", "l_linenumber"]
    rows = line.select(*keys, (F.col("l_linenumber") < 5).alias("has_block"), (F.col("l_orderkey") % 4 != 0).alias("known"))
    residence = line.filter("l_partkey % 3 = 0").select(*keys).distinct()
    lots = line.filter("l_partkey % 3 = 1 and l_quantity < 30").select(*keys).distinct()
    out = rows.join(residence.withColumn("r", F.lit(True)), keys, "left").join(lots.withColumn("l", F.lit(True)), keys, "left").join(residence.select("l_orderkey").distinct().withColumn("any", F.lit(True)), "l_orderkey", "left")
    return out.select(*keys, G.number_verdict(F.col("has_block"), F.col("known"), F.col("r").isNotNull(), F.col("l").isNotNull(), F.col("any").isNotNull()).alias("verdict"))


@query("SELECT a.o_orderkey, CASE WHEN a.o_orderstatus = 'O' AND b.k IS NOT NULL AND b.p = a.o_orderpriority THEN 'adopted' ELSE 'kept' END AS outcome FROM orders a LEFT JOIN (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 6 = 0 THEN 'other' ELSE o_orderpriority END AS p FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 0) b ON b.k = a.o_orderkey")
def recheck_adopt(t):
    orders = t("orders")
    second = orders.filter("o_orderstatus = 'O' and o_orderkey % 2 = 0").select("o_orderkey", F.lit("照合済み").alias("after"), F.when(F.col("o_orderkey") % 6 == 0, "other").otherwise(F.col("o_orderpriority")).alias("p"))
    before = F.when(F.col("o_orderstatus") == "O", "推定").otherwise("照合済み")
    adopted = G.adopt_recheck(before, F.col("after"), F.col("p") == F.col("o_orderpriority"))
    return orders.join(second, "o_orderkey", "left").select("o_orderkey", F.when(adopted, "adopted").otherwise("kept").alias("outcome"))


@query("SELECT p_type, count(*) AS n, string_agg(p_brand, ',' ORDER BY p_brand) AS codes FROM (SELECT DISTINCT p_type, p_brand FROM part) GROUP BY p_type")
def reverse_index(t):
    return T.reverse_index(t("part").select("p_type", "p_brand"), "p_type", "p_brand")


@query("SELECT 'c_name' AS \"column\", count(c_name) AS filled, count(*) AS total FROM customer UNION ALL SELECT 'segment', count(*) FILTER (c_mktsegment <> 'BUILDING'), count(*) FROM customer UNION ALL SELECT 'balance', count(*) FILTER (c_acctbal > 0), count(*) FROM customer")
def fill_rate(t):
    c = t("customer").select("c_name", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise("").alias("segment"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"))
    return T.fill_rates(c, ["c_name", "segment", "balance"])


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10")
def topk_usage(t):
    return T.most_common(t("lineitem"), "l_partkey", 10)


@query("SELECT c_nationkey, count(*) AS tasks, count(*) FILTER (c_acctbal < 0) AS inferred FROM customer GROUP BY 1")
def split_counts(t):
    return t("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("tasks"), F.count_if(F.col("c_acctbal") < 0).alias("inferred"))


@query("SELECT 'left_only' AS side, k FROM (SELECT c_custkey % 500 AS k FROM customer EXCEPT SELECT s_suppkey * 3 FROM supplier) UNION ALL SELECT 'right_only', k FROM (SELECT s_suppkey * 3 AS k FROM supplier EXCEPT SELECT c_custkey % 500 FROM customer)")
def split_diff(t):
    return T.set_differences(t("customer").select((F.col("c_custkey") % 500).alias("k")), t("supplier").select((F.col("s_suppkey") * 3).alias("k")), "k")


@query("SELECT p_type, count(DISTINCT l_suppkey) AS facilities FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def code_facility_counts(t):
    return t("lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey").join(t("part").select("p_partkey", "p_type"), "p_partkey").groupBy("p_type").agg(F.count_distinct("l_suppkey").alias("facilities"))


@query(
    """SELECT 'negative' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS detail FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'name_pattern', CAST(c_custkey AS VARCHAR), c_name FROM customer WHERE NOT regexp_matches(c_name, '^Customer#[0-9]*[02468]$')
 UNION ALL SELECT 'segment', CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')"""
)
def quality_issues(t):
    rules = {
        "negative": (F.col("c_acctbal") < 0, F.col("c_mktsegment")),
        "name_pattern": (~F.col("c_name").rlike("^Customer#[0-9]*[02468]$"), F.col("c_name")),
        "segment": (~F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE", "MACHINERY"), F.col("c_mktsegment")),
    }
    return T.issues(t("customer"), "c_custkey", rules)


@query("SELECT c_custkey, trim(regexp_replace(translate('（' || c_name || '）　Ａ１ ' || c_mktsegment, '（）Ａ１＃　', '()A1# '), ' +', ' ', 'g')) AS name FROM customer")
def char_normalize(t):
    return t("customer").select("c_custkey", X.normalize_chars(F.concat(F.lit("（"), F.col("c_name"), F.lit("）　Ａ１ "), F.col("c_mktsegment"))).alias("name"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '(BUILDING)' WHEN c_mktsegment = 'BUILDING' THEN c_name WHEN c_mktsegment = 'MACHINERY' THEN c_name ELSE c_name || ' (' || c_mktsegment || ')' END AS name FROM customer")
def bracket_strip(t):
    name = F.when(F.col("c_custkey") % 4 == 0, F.lit("(BUILDING)")).otherwise(F.concat(F.col("c_name"), F.lit(" ("), F.col("c_mktsegment"), F.lit(")")))
    return t("customer").select("c_custkey", X.strip_bracket_notes(name, ["BUILDING", "MACHINERY"]).alias("name"))


@query(f"""SELECT sector, id, '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || printf('%.1f', lon) || ',' || printf('%.2f', lat) || ']}},"properties":{{"city":"' || city || '","_id":"' || id || '"}}}}' AS feature FROM ({POINTS_SQL})""")
def geojson_feature(t):
    from clinicweave.sources.geojson import feature_text

    p = points(t)
    return p.select("sector", "id", feature_text(F.format_string("%.2f", "lat"), F.format_string("%.1f", "lon"), {"city": F.col("city").cast("string"), "_id": F.col("id").cast("string")}).alias("feature"))
