"""Audits, second looks at addresses, mapping tables and counts as queries over the tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from clinicweave.functions import hours as H
from clinicweave.operators import audits as U
from clinicweave.operators import intervals as I
from clinicweave.operators import tables as T
from clinicweave.operators.document import document_lines
from clinicweave.operators.resolver import recheck_inferred
from clinicweave.plans.calendars import RULES_SQL, rules_of_orders
from clinicweave.plans.queries import GRID_SQL, HAVERSINE_SQL, KIND_SQL, POINTS_SQL, SLOTS_SQL, day_grid, points, query, slots

#: Customers and suppliers under names that are spelled differently: legal forms, widths, signs and case. Some names occur twice.
MATCH_SQL = f"""WITH p AS ({POINTS_SQL}), a AS (SELECT *, CASE id % 3 WHEN 0 THEN '医療法人社団 Ｐｌａｃｅ・' || (id % 1400) || '号' WHEN 1 THEN 'place(' || (id % 1400) || ')号株式会社' ELSE 'ＰＬＡＣＥ－' || (id % 1400) || '号' END AS name, 'place' || (id % 1400) || '号' AS k FROM p WHERE sector = 'c'),
 b AS (SELECT *, 'Place ' || (id % 60 + 200) || '号' AS name, 'place' || (id % 60 + 200) || '号' AS k, CASE id % 3 WHEN 0 THEN 'n' || id WHEN 1 THEN 'a' || id ELSE 'x' || id END AS raw FROM p WHERE sector = 's'),
 ua AS (SELECT k, any_value(id) AS id, any_value(city) AS city, any_value(name) AS name, any_value(lat) AS lat, any_value(lon) AS lon FROM a GROUP BY k HAVING count(*) = 1), ub AS (SELECT k, any_value(id) AS id, any_value(raw) AS raw, any_value(lat) AS lat, any_value(lon) AS lon FROM b GROUP BY k HAVING count(*) = 1),
 m AS (SELECT a.id, a.city, a.name, b.id AS other_id, b.raw, {HAVERSINE_SQL} AS m FROM ua a JOIN ub b USING (k) WHERE {HAVERSINE_SQL} <= 3000000)"""


def matched(t):
    p, k = points(t), F.col("id")
    n = (k % 1400).cast("string")
    name = F.when(k % 3 == 0, F.concat(F.lit("医療法人社団 Ｐｌａｃｅ・"), n, F.lit("号"))).when(k % 3 == 1, F.concat(F.lit("place("), n, F.lit(")号株式会社"))).otherwise(F.concat(F.lit("ＰＬＡＣＥ－"), n, F.lit("号")))
    ours = p.filter("sector = 'c'").select("id", "city", "lat", "lon", name.alias("name"))
    raw = F.concat(F.when(k % 3 == 0, "n").when(k % 3 == 1, "a").otherwise("x"), k.cast("string"))
    theirs = p.filter("sector = 's'").select("id", "lat", "lon", raw.alias("raw"), F.concat(F.lit("Place "), (k % 60 + 200).cast("string"), F.lit("号")).alias("name"))
    return U.match_names(ours, theirs, most_m=3_000_000.0)


@query(f"{MATCH_SQL} SELECT id, other_id, round(m, 1) AS m FROM m")
def name_audit(t):
    """Customers and suppliers of one normalised name that is unique on both sides."""
    return matched(t).select("id", "other_id", F.round("m", 1).alias("m"))


@query(
    f"""{MATCH_SQL} SELECT printf('%.1f', m) AS "距離m", id, name, 'https://www.openstreetmap.org/' || CASE WHEN raw LIKE 'n%' THEN 'node/' || other_id WHEN raw LIKE 'a%' AND other_id % 2 = 0 THEN 'way/' || other_id // 2 WHEN raw LIKE 'a%' THEN 'relation/' || other_id // 2 ELSE raw END AS "URL" FROM m WHERE m > 50"""
)
def name_audit_report(t):
    """The matched pairs over 50 m, the farthest first, with the other object's address."""
    return U.distance_report(matched(t), ["id", "name"], "other_raw")


@query(
    f"""{MATCH_SQL}, r AS (SELECT city, m, row_number() OVER (PARTITION BY city ORDER BY m) - 1 AS i, count(*) OVER (PARTITION BY city) AS n FROM m)
 SELECT city, count(*) FILTER (m > 50) AS over, count(*) AS n, round(count(*) FILTER (m > 50) * 100.0 / count(*), 2) AS percent, {", ".join(f"max(round(m, 3)) FILTER (i = least(n * {p} // 100, n - 1)) AS p{p}" for p in U.PERCENTS)}, max(round(m, 3)) AS max FROM r GROUP BY city"""
)
def name_audit_summary(t):
    """Shares over 50 m and percentiles of the distance by city."""
    return U.distance_summary(matched(t).withColumn("m", F.round("m", 3)), "city")


ADDRESSES_SQL = """SELECT o_orderkey AS id, '町' || o_custkey || 'に' AS base, CASE WHEN o_orderstatus = 'O' THEN '推定' ELSE '照合済み' END AS evidence, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_custkey % 30 + 1 AS VARCHAR) END AS block, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_orderkey % 9 + 1 AS VARCHAR) END AS house FROM orders"""


def ledger(asked: pd.DataFrame) -> pd.DataFrame:
    """A resolver over made-up ledgers: blocks up to 20 are known with a point made of the numbers, some under another house."""
    parts = asked["address"].str.extract(r"町(?P<town>\d+?)に(?P<block>\d+)番(?:(?P<house>\d+)号)?")
    block, house, town = (parts[c].fillna("0").astype(int) for c in ("block", "house", "town"))
    known = (block > 0) & (block <= 20)
    moved = house + (town % 5 == 0) * (house > 0)
    text = lambda v, keep: v.astype(str).where(keep, "")
    return pd.DataFrame({
        "key": asked.iloc[:, 0], "evidence": known.map({True: "照合済み", False: "推定"}), "block": text(block, block > 0), "house": text(moved, house > 0),
        "lat": text(block, known).radd("35.").where(known, ""), "lng": text(moved, known).radd("139.").where(known, ""), "level": known.map({True: "8", False: "3"}), "note": known.map({True: "", False: "rest"}),
    })


@query(
    f"""WITH a AS ({ADDRESSES_SQL}), b AS (SELECT *, CAST(replace(substr(base, 2), 'に', '') AS BIGINT) AS town, TRY_CAST(block AS BIGINT) AS bn, TRY_CAST(house AS BIGINT) AS hn FROM a),
 c AS (SELECT *, evidence = '推定' AND bn <= 20 AS known, town % 5 = 0 AND hn IS NOT NULL AS moved FROM b)
 SELECT id, CASE WHEN known AND NOT moved THEN '照合済み' ELSE evidence END AS evidence, block, house, CASE WHEN known AND NOT moved THEN '35.' || bn ELSE '34.5' END AS lat, CASE WHEN known AND NOT moved THEN '139.' || coalesce(hn, 0) ELSE '135.5' END AS lng,
 CASE WHEN known AND NOT moved THEN '8' ELSE '3' END AS level, CASE WHEN known AND NOT moved THEN '' ELSE 'town' END AS note, CASE WHEN known AND NOT moved THEN 'adopted' WHEN known THEN 'rejected' END AS recheck FROM c"""
)
def recheck_replaced(t):
    """Inferred numbers of all orders' addresses looked up again: point, level and note are replaced where they are confirmed."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    first = t("orders").select(
        k.alias("id"), F.concat(F.lit("町"), c.cast("string"), F.lit("に")).alias("base"), F.when(F.col("o_orderstatus") == "O", "推定").otherwise("照合済み").alias("evidence"),
        F.when(k % 7 == 0, "").otherwise((c % 30 + 1).cast("string")).alias("block"), F.when(k % 3 == 0, "").otherwise((k % 9 + 1).cast("string")).alias("house"),
        F.lit("34.5").alias("lat"), F.lit("135.5").alias("lng"), F.lit("3").alias("level"), F.lit("town").alias("note"),
    )
    return recheck_inferred(first, ledger, "id", "base").drop("base")


@query(
    f"""WITH s AS (SELECT id, count(*) FILTER (k IS NOT NULL) AS excluded, count(*) FILTER (k IS NULL AND e < s) AS overnight FROM (SELECT id, s, e, {KIND_SQL} AS k FROM ({SLOTS_SQL})) GROUP BY id),
 h AS (SELECT DISTINCT id, day FROM (SELECT id, day, {KIND_SQL} AS k FROM ({SLOTS_SQL})) WHERE k IS NULL),
 c AS (SELECT g.id, count(*) AS n FROM ({GRID_SQL}) g LEFT JOIN h ON h.id = g.id AND h.day = g.day WHERE (g.flag = '0') = (h.id IS NOT NULL) GROUP BY g.id)
 SELECT id, coalesce(excluded, 0) AS excluded, coalesce(overnight, 0) AS overnight, coalesce(n, 0) AS conflicts FROM s FULL JOIN c USING (id)"""
)
def facility_counts(t):
    """Excluded and overnight intervals and days in conflict, a user a row."""
    split = I.split_intervals(slots(t))
    return I.facility_counts(split, I.day_conflicts(day_grid(t)[0], split.filter("kind IS NULL")))


GRADED_SQL = "SELECT p_partkey AS code, p_type || CASE WHEN p_size % 3 = 0 THEN ';' || p_brand ELSE '' END AS v, CASE WHEN p_size % 2 = 0 THEN 'exact' ELSE 'broader' END AS grade FROM part"


@query(
    f"WITH d AS (SELECT DISTINCT unnest(string_split(v, ';')) AS v, CAST(code AS VARCHAR) AS code, grade FROM ({GRADED_SQL})) SELECT v, count(DISTINCT code) AS n, coalesce(string_agg(code, ',' ORDER BY code) FILTER (grade = 'exact'), '') AS exact, coalesce(string_agg(code, ',' ORDER BY code) FILTER (grade = 'broader'), '') AS broader FROM d GROUP BY v"
)
def graded_index(t):
    """Which parts lead to each type or brand, split by how exact they are."""
    size = F.col("p_size")
    rows = t("part").select(F.col("p_partkey").alias("code"), F.concat("p_type", F.when(size % 3 == 0, F.concat(F.lit(";"), "p_brand")).otherwise("")).alias("v"), F.when(size % 2 == 0, "exact").otherwise("broader").alias("grade"))
    return T.reverse_index_by(rows, "v", "code", "grade", ["exact", "broader"])


@query(
    "SELECT c_custkey AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN CASE c_mktsegment WHEN 'MACHINERY' THEN 'hospital' ELSE 'pharmacy' END WHEN c_custkey % 4 > 0 AND c_custkey % 5 > 0 THEN 'clinic' ELSE 'doctors' END AS amenity FROM customer"
)
def facility_types(t):
    """The type of each customer: clinics by their beds, other sectors without a condition; a sector without a type would be an error."""
    k = F.col("c_custkey")
    beds = F.when(k % 5 == 0, "").otherwise((k % 4).cast("string"))
    sector = F.when(F.col("c_mktsegment") == "BUILDING", "clinic").when(F.col("c_mktsegment") == "MACHINERY", "hospital").otherwise("pharmacy")
    rows = t("customer").select(k.alias("id"), sector.alias("sector"), T.beds_condition(sector, beds).alias("condition"))
    table = rows.sparkSession.createDataFrame([("clinic", "病床1以上", "clinic"), ("clinic", "病床0または空欄", "doctors"), ("hospital", "", "hospital"), ("pharmacy", None, "pharmacy")], "sector string, condition string, amenity string")
    return T.facility_types(rows, table, "sector", "condition", "amenity").select("id", "amenity")


@query(
    "SELECT c_custkey AS id, CAST(d AS INTEGER) AS day, CASE d WHEN 0 THEN c_mktsegment WHEN 1 THEN c_name ELSE 'x' END AS start, CAST(c_custkey % 3 AS VARCHAR) AS end FROM customer, range(3) r(d) WHERE NOT (d = 2 AND c_custkey % 2 = 0) AND NOT (d = 1 AND c_custkey % 5 = 0)"
)
def unpivot_slots(t):
    """Columns of days and slots to rows, where both ends stand."""
    k = F.col("c_custkey")
    wide = t("customer").select(k.alias("id"), F.col("c_mktsegment").alias("a:0"), F.col("c_name").alias("a:1"), F.when(k % 2 == 0, "  ").otherwise("x").alias("a:2"), (k % 3).cast("string").alias("b"), F.when(k % 5 > 0, (k % 3).cast("string")).alias("c"))
    return I.unpivot_slots(wide, ["id"], [(0, "a:0", "b"), (1, "a:1", "c"), (2, "a:2", "b")])


@query(
    f"""WITH r AS ({RULES_SQL}), p AS (SELECT id, v, string_split(v, '; ') AS rs FROM r), c AS (SELECT id, v, rs, CASE WHEN length(v) <= 120 THEN len(rs) ELSE list_max([0] || list_filter(range(1, len(rs)), lambda n: length(array_to_string(rs[1:n], '; ')) <= 120)) END AS n FROM p)
 SELECT id, array_to_string(rs[1:n], '; ') AS value, CASE WHEN n = len(rs) THEN '' WHEN n = 0 THEN '120文字を超え、残せる規則が無いため出力しない' ELSE '120文字を超えたため末尾の規則' || (len(rs) - n) || '件を落とした: ' || substr(array_to_string(rs[n + 1:], '; '), 1, 80) END AS note FROM c"""
)
def fitted_hours(t):
    """Hours of all orders cut to 120 characters by whole rules, with what is said of it."""
    return rules_of_orders(t).withColumn("f", H.fit_hours(F.col("opening_hours"), 120)).select("id", "f.value", "f.note")


#: A part is a code of a family, with a value and a grade; some override it for a flag, which stands for a sector.
MAPPING_SQL = """SELECT sector, lpad(CAST(p_size % 9 + 1 AS VARCHAR), 2, '0') || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code, p_name AS name, CASE WHEN p_size % 7 = 0 THEN p_type || ';' || p_brand ELSE p_type END AS value, ['exact', 'broader', 'none'][p_size % 3 + 1] AS grade, CASE p_size % 5 WHEN 0 THEN '要検討|' || p_brand WHEN 1 THEN 'x' ELSE '' END AS note
 FROM part, (SELECT unnest(['', 'R']) AS sector) WHERE sector = '' OR p_partkey % 50 = 0"""
FAMILIES = {f"{i:02d}": f"family {i}" for i in range(1, 9)}


@query(
    f"""WITH m AS ({MAPPING_SQL}), d AS (SELECT * FROM m WHERE sector = ''), n AS (SELECT l_returnflag AS sector, lpad(CAST(p_size % 9 + 1 AS VARCHAR), 2, '0') || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code, count(DISTINCT l_suppkey) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
 w AS (SELECT d.*, coalesce(a.n, 0) AS a, coalesce(b.n, 0) AS b FROM d LEFT JOIN n a ON a.code = d.code AND a.sector = 'A' LEFT JOIN n b ON b.code = d.code AND b.sector = 'R'),
 i AS (SELECT code, name, grade, unnest(string_split(value, ';')) AS v FROM d), num AS (SELECT *, CASE WHEN a > 0 THEN format('{{:,}}', a) ELSE '' END AS ta, CASE WHEN b > 0 THEN format('{{:,}}', b) ELSE '' END AS tb FROM w)
 SELECT 0 AS section, CAST(0 AS BIGINT) AS n, grade AS key, '| `' || grade || '` | ' || count(*) || ' |' AS line FROM d GROUP BY grade
 UNION ALL SELECT 1, -count(*), v, '| `' || v || '` | ' || coalesce(string_agg(name, '、' ORDER BY code, name) FILTER (grade <> 'broader'), '') || ' | ' || coalesce(string_agg(name, '、' ORDER BY code, name) FILTER (grade = 'broader'), '') || ' |' FROM i GROUP BY v
 UNION ALL SELECT DISTINCT 2, 0, substr(code, 1, 2), '### ' || substr(code, 1, 2) || ' family ' || CAST(substr(code, 1, 2) AS INTEGER) FROM d WHERE substr(code, 1, 2) < '09'
 UNION ALL SELECT 2, 0, substr(code, 1, 2) || ' ' || code, '| `' || code || '` | ' || name || ' | `' || value || '` | ' || grade || ' | ' || ta || ' | ' || tb || ' | ' || replace(note, '|', chr(92) || '|') || ' |' FROM num WHERE substr(code, 1, 2) < '09'
 UNION ALL SELECT 3, 0, sector || ' ' || code, '| returned | `' || code || '` | ' || name || ' | `' || value || '` | ' || grade || ' | ' || replace(note, '|', chr(92) || '|') || ' |' FROM m WHERE sector <> ''
 UNION ALL SELECT 4, 0, r_name, '| `' || r_name || '` | `WORLD` | ' || r_regionkey || ' |' FROM region
 UNION ALL SELECT 5, -(a + b), name || ' ' || value || ' ' || note, '| ' || name || ' | `' || value || '` | ' || format('{{:,}}', a + b) || ' | ' || note || ' |' FROM w WHERE grade = 'broader' AND note LIKE '%要検討%'"""
)
def mapping_document(t):
    """The lines of a document of all parts as codes, with the suppliers of two flags as facilities of two sectors."""
    k, size = F.col("p_partkey"), F.col("p_size")
    code = F.concat(F.lpad((size % 9 + 1).cast("string"), 2, "0"), F.lpad(k.cast("string"), 6, "0")).alias("code")
    part = t("part")
    value = F.when(size % 7 == 0, F.concat("p_type", F.lit(";"), "p_brand")).otherwise(F.col("p_type"))
    note = F.when(size % 5 == 0, F.concat(F.lit("要検討|"), "p_brand")).when(size % 5 == 1, "x").otherwise("")
    default = part.select(F.lit("").alias("sector"), code, F.col("p_name").alias("name"), value.alias("value"), F.get(F.array(*map(F.lit, ("exact", "broader", "none"))), (size % 3).cast("int")).alias("grade"), note.alias("note"), k.alias("k"))
    mapping = default.unionByName(default.filter("k % 50 = 0").withColumn("sector", F.lit("R"))).drop("k")
    counts = t("lineitem").join(part.select("p_partkey", code), F.col("l_partkey") == k).groupBy(F.col("l_returnflag").alias("sector"), "code").agg(F.count_distinct("l_suppkey").alias("n"))
    rollup = t("region").select(F.col("r_name").alias("value"), F.lit("WORLD").alias("broader"), F.col("r_regionkey").cast("string").alias("note"))
    return document_lines(mapping, counts, rollup, {"A": "asked", "R": "returned"}, FAMILIES)
