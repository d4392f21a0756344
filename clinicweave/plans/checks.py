"""Validators, assembly, notes and name routing as queries over the synthetic tables, each with the SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinicweave.functions import notes as N
from clinicweave.functions import text as X
from clinicweave.operators import assembly as A
from clinicweave.operators import validators as V
from clinicweave.plans.queries import POINTS_SQL, points, query

# --- V2: lists of values ---------------------------------------------------------------------------------------------

VALUES_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE lower(substr(o_orderpriority, 3)) || ';' || lower(o_orderstatus)
 || CASE WHEN o_custkey % 3 = 0 THEN ';' || lower(substr(o_orderpriority, 3)) ELSE '' END || CASE WHEN o_custkey % 7 = 0 THEN ';' ELSE '' END || CASE WHEN o_custkey % 97 = 0 THEN ';' || repeat('x', 260) ELSE '' END END AS v FROM orders"""


@query(
    f"""WITH r AS (SELECT * FROM ({VALUES_SQL}) WHERE v <> ''), p AS (SELECT id, unnest(string_split(v, ';')) AS p FROM r),
 d AS (SELECT id, string_agg(p, ',' ORDER BY pos) AS detail FROM (SELECT id, p, count(*) AS n, min(pos) AS pos FROM (SELECT id, unnest(string_split(v, ';')) AS p, unnest(range(len(string_split(v, ';')))) AS pos FROM r) GROUP BY id, p) WHERE n > 1 GROUP BY id)
 SELECT 'too_long' AS kind, id, CAST(length(v) AS VARCHAR) AS detail FROM r WHERE length(v) > 255 UNION ALL SELECT 'bad_format', id, '' FROM r WHERE list_contains(string_split(v, ';'), '') UNION ALL SELECT 'duplicated', id, detail FROM d
 UNION ALL SELECT 'bad_format', id, p FROM p WHERE p <> '' AND NOT regexp_matches(p, '^[a-z][a-z0-9_]*$') UNION ALL SELECT 'unknown_value', id, p FROM p WHERE regexp_matches(p, '^[a-z][a-z0-9_]*$') AND p NOT IN ('urgent', 'high', 'medium', 'o', 'f')"""
)
def validate_value_lists(t):
    o = t("orders")
    p = F.lower(F.substring("o_orderpriority", 3, 100))
    extra = lambda n, text: F.when(F.col("o_custkey") % n == 0, text).otherwise("")
    v = F.concat(p, F.lit(";"), F.lower("o_orderstatus"), extra(3, F.concat(F.lit(";"), p)), extra(7, F.lit(";")), extra(97, F.lit(";" + "x" * 260)))
    rows = o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(v).alias("v"))
    vocabulary = o.sparkSession.createDataFrame([(x,) for x in ("urgent", "high", "medium", "o", "f")], "value string")
    return V.value_list_issues(rows, "id", "v", vocabulary)


# --- V3: names ---------------------------------------------------------------------------------------------------------

NAMES_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS source, CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 5 = 0 THEN 'Corp ' || c_name WHEN c_custkey % 101 = 0 THEN repeat(c_name, 20) ELSE c_name END AS n,
 CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 6 = 0 THEN c_mktsegment ELSE c_name END AS o, CASE c_custkey % 3 WHEN 0 THEN 'さクラク' WHEN 1 THEN 'さくら' ELSE '' END AS h,
 CASE WHEN c_custkey % 8 = 0 THEN 'Ａ clinic' WHEN c_custkey % 2 = 0 THEN 'clinic' ELSE '' END AS e, CASE WHEN c_custkey % 10 = 0 THEN 'Sakura' WHEN c_custkey % 15 = 0 THEN 'Ōsaka' ELSE '' END AS x FROM customer"""
ASCII_SQL = "regexp_matches({0}, '^[\\x20-\\x7E]*$')"


@query(
    f"""WITH r AS ({NAMES_SQL}) SELECT 'name_empty' AS kind, id, '' AS detail FROM r WHERE n = '' UNION ALL SELECT 'name_too_long', id, CAST(length(n) AS VARCHAR) FROM r WHERE length(n) > 255 UNION ALL SELECT 'entity_left', id, 'Corp' FROM r WHERE n LIKE 'Corp%'
 UNION ALL SELECT 'official_missing', id, '' FROM r WHERE o = '' UNION ALL SELECT 'official_altered', id, o FROM r WHERE o <> '' AND o <> source UNION ALL SELECT 'hira_katakana_left', id, 'クラ' FROM r WHERE h = 'さクラク'
 UNION ALL SELECT 'en_not_ascii', id, e FROM r WHERE NOT {ASCII_SQL.format('e')} UNION ALL SELECT 'latn_not_ascii', id, x FROM r WHERE NOT {ASCII_SQL.format('x')}
 UNION ALL SELECT 'latn_without_hira', id, x FROM r WHERE x <> '' AND {ASCII_SQL.format('x')} AND h = '' UNION ALL SELECT 'latn_and_en', id, e || '/' || x FROM r WHERE x <> '' AND e <> ''"""
)
def validate_names(t):
    k = F.col("c_custkey")
    pick = lambda *cases: F.coalesce(*[F.when(k % n == r, v) for n, r, v in cases], F.lit(""))
    rows = t("customer").select(
        k.alias("id"), F.col("c_name").alias("source"),
        F.when(k % 9 == 0, "").when(k % 5 == 0, F.concat(F.lit("Corp "), "c_name")).when(k % 101 == 0, F.repeat("c_name", 20)).otherwise(F.col("c_name")).alias("name"),
        F.when(k % 4 == 0, "").when(k % 6 == 0, F.col("c_mktsegment")).otherwise(F.col("c_name")).alias("official_name"),
        pick((3, 0, "さクラク"), (3, 1, "さくら")).alias("name:ja-Hira"), pick((8, 0, "Ａ clinic"), (2, 0, "clinic")).alias("name:en"), pick((10, 0, "Sakura"), (15, 0, "Ōsaka")).alias("name:ja-Latn"),
    )
    return V.name_issues(rows, "id", "source", ["Corp"])


# --- V4: tags, shared points, features, parts ---------------------------------------------------------------------------

TAGS_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 17 = 0 THEN 'n/a' ELSE printf('%.2f', 18 + (c_custkey * 7 % 3000) / 100.0) END AS lat, '135.5' AS lon, CASE WHEN c_custkey % 13 = 0 THEN '' ELSE c_name || CASE WHEN c_custkey % 19 = 0 THEN ' ' ELSE '' END END AS name,
 CASE c_mktsegment WHEN 'BUILDING' THEN 'clinic' WHEN 'MACHINERY' THEN 'shop' ELSE '' END AS amenity, CASE WHEN c_custkey % 4 = 0 THEN 'doctor' ELSE '' END AS healthcare, CASE WHEN c_custkey % 3 = 0 THEN '5' ELSE '' END AS house, CASE WHEN c_custkey % 2 = 0 THEN '本町' ELSE '' END AS town,
 CASE WHEN c_custkey % 7 = 0 THEN '10-36' ELSE '' END AS residue, printf('%02d', 13 + c_custkey % 3) AS code, CASE WHEN c_custkey % 5 = 0 THEN '神奈川県' ELSE '' END AS province, CASE WHEN c_custkey % 6 = 0 THEN 'http://a.jp/x' WHEN c_custkey % 6 = 1 THEN 'a b' ELSE '' END AS web,
 CASE WHEN c_custkey % 23 = 0 THEN repeat('y', 256) WHEN c_custkey % 29 = 0 THEN 'a' || chr(1) ELSE '' END AS note FROM customer"""


@query(
    f"""WITH r AS ({TAGS_SQL}), g AS (SELECT * FROM r WHERE lat <> 'n/a') SELECT 'coord_range' AS kind, id, lat || ', ' || lon AS detail FROM r WHERE lat = 'n/a' OR NOT (CAST(lat AS DOUBLE) > 20 AND CAST(lat AS DOUBLE) < 46) UNION ALL SELECT 'name_missing', id, '' FROM g WHERE name = ''
 UNION ALL SELECT 'type_missing', id, '' FROM g WHERE amenity = '' AND healthcare = '' UNION ALL SELECT 'unknown_value', id, amenity FROM g WHERE amenity = 'shop' UNION ALL SELECT 'addr_hierarchy', id, house FROM g WHERE house <> '' AND town = ''
 UNION ALL SELECT 'addr_note_chiban', id, residue FROM g WHERE residue <> '' UNION ALL SELECT 'addr_province_mismatch', id, province FROM g WHERE province <> '' AND code IN ('13', '15') UNION ALL SELECT 'bad_website', id, web FROM g WHERE web = 'a b'
 UNION ALL SELECT 'tag_too_long', id, 'note' FROM g WHERE length(note) > 255 UNION ALL SELECT 'control_char', id, 'note' FROM g WHERE contains(note, chr(1)) UNION ALL SELECT 'untrimmed', id, 'name' FROM g WHERE name LIKE '% ' UNION ALL SELECT 'bad_key', id, '番地' FROM g WHERE house <> ''"""
)
def validate_tags(t):
    k = F.col("c_custkey")
    when = lambda n, v, r=0: F.when(k % n == r, v)
    rows = t("customer").select(
        k.alias("ID"), when(17, F.lit("n/a")).otherwise(F.format_string("%.2f", (18 + (k * 7 % 3000) / 100.0).cast("double"))).alias("lat"), F.lit("135.5").alias("lon"),
        when(13, F.lit("")).otherwise(F.concat("c_name", when(19, F.lit(" ")).otherwise(""))).alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "clinic").when(F.col("c_mktsegment") == "MACHINERY", "shop").otherwise("").alias("amenity"),
        when(4, "doctor").otherwise("").alias("healthcare"), when(3, "5").otherwise("").alias("addr:housenumber"), when(3, "5").otherwise("").alias("番地"), when(2, "本町").otherwise("").alias("addr:neighbourhood"),
        when(7, "10-36").otherwise("").alias("未解釈の文字列"), F.format_string("%02d", 13 + k % 3).alias("都道府県コード"), when(5, "神奈川県").otherwise("").alias("addr:province"),
        when(6, "http://a.jp/x").when(k % 6 == 1, "a b").otherwise("").alias("website"), when(23, F.lit("y" * 256)).when(k % 29 == 0, "a\x01").otherwise("").alias("note"),
    )
    return V.tag_issues(rows, ["name", "note", "番地"], {"13": "東京都", "14": "神奈川県", "15": "新潟県"})


@query(f"WITH p AS ({POINTS_SQL}), n AS (SELECT lat, lon, count(*) AS n FROM p GROUP BY 1, 2 HAVING count(DISTINCT city) > 1) SELECT 'coord_cross_city' AS kind, sector || id AS id, CAST(n AS VARCHAR) AS detail FROM p JOIN n USING (lat, lon)")
def validate_shared_points(t):
    p = points(t).select(F.concat("sector", F.col("id").cast("string")).alias("ID"), "lat", "lon", F.lit("").alias("都道府県コード"), F.col("city").cast("string").alias("addr:city"))
    return V.cross_city_issues(p)


FEATURES_SQL = "SELECT s_suppkey AS r, CASE WHEN s_suppkey = 40 THEN 'x' ELSE CAST(s_suppkey AS VARCHAR) END AS id, CASE WHEN s_suppkey % 7 = 0 THEN 'LineString' ELSE 'Point' END AS type, CAST(CASE WHEN s_suppkey % 5 = 0 THEN 35.5 WHEN s_suppkey % 11 = 0 THEN 5.25 ELSE 135.5 END AS DOUBLE) AS x, CAST(CASE WHEN s_suppkey % 5 = 0 THEN 135.5 ELSE 35.5 END AS DOUBLE) AS y FROM supplier"


@query(
    f"""WITH f AS ({FEATURES_SQL}), p AS (SELECT *, x > 20 AND x < 46 AND y > 122 AND y < 154 AS swapped, x > 122 AND x < 154 AND y > 20 AND y < 46 AS inside FROM f) SELECT 'geojson_structure' AS kind, id, type AS detail FROM p WHERE type <> 'Point'
 UNION ALL SELECT 'coord_order', id, x || ', ' || y FROM p WHERE type = 'Point' AND swapped UNION ALL SELECT 'coord_range', id, x || ', ' || y FROM p WHERE type = 'Point' AND NOT swapped AND NOT inside
 UNION ALL SELECT 'id_mismatch', CAST(r AS VARCHAR), id FROM f WHERE r = (SELECT min(r) FROM f WHERE CAST(r AS VARCHAR) <> id)"""
)
def validate_features(t):
    k = F.col("s_suppkey")
    f = t("supplier").select(k.alias("_row"), F.when(k == 40, "x").otherwise(k.cast("string")).alias("id"), F.when(k % 7 == 0, "LineString").otherwise("Point").alias("type"), F.when(k % 5 == 0, 35.5).when(k % 11 == 0, 5.25).otherwise(135.5).alias("x"), F.when(k % 5 == 0, 135.5).otherwise(35.5).alias("y"))
    return V.feature_issues(t("supplier").select(k.alias("_row"), k.alias("ID")), f)


@query(
    """WITH w AS (SELECT c_nationkey AS code FROM customer), p AS (SELECT CASE WHEN c_nationkey = 3 THEN 99 ELSE c_nationkey END AS code FROM customer WHERE c_nationkey <> 5) SELECT 'pref_split_row_mismatch' AS kind, '-' AS id, (SELECT count(*) FROM p) || '/' || (SELECT count(*) FROM w) AS detail
 UNION ALL SELECT 'pref_split_missing', '-', (SELECT string_agg(code, ',' ORDER BY code) FROM (SELECT DISTINCT CAST(code AS VARCHAR) AS code FROM w WHERE code NOT IN (SELECT code FROM p))) UNION ALL SELECT 'pref_split_extra', '-', '99'"""
)
def validate_split(t):
    c = t("customer").select(F.col("c_nationkey").alias("code"))
    return V.split_issues(c, c.filter("code != 5").select(F.when(F.col("code") == 3, 99).otherwise(F.col("code")).alias("code")))


@query("SELECT 'coord_reason_mismatch' AS kind, CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 4 = 1 THEN 'other' ELSE '' END AS detail FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 8 <> 7")
def validate_reasons(t):
    k = F.col("c_custkey")
    rows = t("customer").select(k.alias("ID"), F.when(k % 2 == 1, "moved").otherwise("").alias("座標の理由"), F.when(k % 8 == 7, "moved / more").when(k % 4 == 1, "other").when(k % 2 == 0, "any").alias("備考"))
    return V.reason_issues(rows)


# --- V1: opening hours ----------------------------------------------------------------------------------------------------

# --- assembly, audits, summaries --------------------------------------------------------------------------------------------


@query(
    """SELECT c_custkey AS id, c_name AS name, coalesce(n, 0) AS n_orders, CASE WHEN c_mktsegment = 'BUILDING' AND c_custkey % 2 = 0 THEN 'yes' ELSE '' END AS emergency, CASE WHEN c_custkey % 7 > 0 THEN CAST(c_custkey % 7 AS VARCHAR) ELSE '' END AS beds,
 CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '本町' END AS town, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '12' END AS block, CASE WHEN c_custkey % 11 = 0 OR c_custkey % 5 = 0 OR c_custkey % 3 = 0 OR coalesce(n, 0) = 0 THEN 'yes' ELSE '' END AS review,
 concat_ws(' / ', CASE WHEN c_custkey % 5 = 0 THEN '町字が入力と別のものになったため addr:neighbourhood をタグ出力していない。修正候補: 東町' END, CASE WHEN c_custkey % 3 <> 0 THEN NULL WHEN c_custkey % 2 = 0 THEN '地番のため addr:block_number と addr:housenumber をタグ出力していない' ELSE '番地が推定のため addr:block_number と addr:housenumber をタグ出力していない' END, CASE WHEN c_custkey % 11 = 0 THEN 'look' END) AS note
 FROM customer LEFT JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) ON k = c_custkey"""
)
def assemble_facilities(t):
    """Five tables joined by id, with the tags, notes and review marks of each facility."""
    k = F.col("c_custkey")
    c = t("customer")
    address = c.select(k.alias("ID"), F.lit("本町").alias("town"), F.when(k % 5 == 0, "東町").alias("fix"), F.lit("12").alias("block"), F.when(k % 3 == 0, "推定").otherwise("照合済み").alias("evidence"), F.when(k % 6 == 0, "地番").alias("verdict"))
    names = c.select(k.alias("ID"), F.col("c_name").alias("name"), F.when(k % 11 == 0, "yes").alias("review"), F.lit("look").alias("why"))
    hours = t("orders").groupBy(F.col("o_custkey").alias("ID")).agg(F.count(F.lit(1)).alias("n"))
    special = c.select(k.alias("ID"), F.when(k % 2 == 0, F.array(F.lit("01001"), F.lit("09010"))).otherwise(F.array(F.lit("01001"))).alias("codes"))
    raw = c.select(k.alias("ID"), F.when(F.col("c_mktsegment") == "BUILDING", "hospital").otherwise("clinic").alias("amenity"), (k % 7).cast("string").alias("beds"))
    out = A.assemble(address, {"names": names, "hours": hours, "special": special, "raw": raw})
    out = out.withColumn("t", N.checked_town(F.col("town"), F.col("fix"))).withColumn("n", N.checked_numbers(F.col("evidence"), F.col("block"), F.lit("")))
    hours_review = N.needs_review_hours(F.lit(0), F.lit(0), F.col("hours.n").cast("string"), F.lit(""), F.lit(""))
    number = F.when(F.col("n.dropped"), N.number_note(F.col("verdict"))).otherwise("")
    return out.select(
        F.col("ID").alias("id"), F.col("names.name").alias("name"), F.coalesce("hours.n", F.lit(0)).alias("n_orders"), N.emergency_tag(F.col("raw.amenity"), F.col("special.codes")).alias("emergency"), N.beds_tag(F.col("raw.beds")).alias("beds"),
        F.col("t.town").alias("town"), F.col("n.block").alias("block"), N.needs_review(F.col("names.review"), hours_review, town_note=F.col("t.note"), number_dropped=F.col("n.dropped")).alias("review"),
        X.join_notes([F.col("t.note"), number, N.asked_note(F.col("names.review"), F.col("names.why"))]).alias("note"),
    )


@query("SELECT c_mktsegment AS sector, count(*) FILTER (c_acctbal > 5000) AS over, count(*) AS n, round(count(*) FILTER (c_acctbal > 5000) * 100.0 / count(*), 2) AS percent FROM customer GROUP BY 1")
def share_over_bound(t):
    return A.share_over(t("customer").select(F.col("c_mktsegment").alias("sector"), "c_acctbal"), "sector", "c_acctbal", 5000.0)


@query(
    """WITH r AS (SELECT o_custkey AS id, o_orderpriority AS reason, CAST(o_orderkey AS VARCHAR) AS x, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS n FROM orders)
 SELECT id, reason, n, string_agg(x, '、' ORDER BY i) FILTER (i <= 2) || CASE WHEN n > 2 THEN ' 他' || (n - 2) || '件' ELSE '' END AS text FROM r GROUP BY id, reason, n"""
)
def reason_summary(t):
    rows = t("orders").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("reason"), F.col("o_orderkey").cast("string").alias("x"), "o_orderkey")
    return A.reason_summaries(rows, "id", "reason", "x", "o_orderkey")


@query("WITH d AS (SELECT o_custkey AS id, o_orderpriority AS d, count(*) AS n, min(o_orderkey) AS o FROM orders GROUP BY 1, 2) SELECT id, string_agg(CASE WHEN n > 1 THEN d || '×' || n ELSE d END, '、' ORDER BY o) AS text FROM d GROUP BY id")
def decision_summary(t):
    return A.decision_counts(t("orders").select(F.col("o_custkey").alias("id"), "o_orderpriority", "o_orderkey"), "id", "o_orderpriority", "o_orderkey")


@query(
    """WITH d AS (SELECT o_custkey AS id, o_orderstatus AS code, arg_max(o_orderpriority, o_orderkey) AS name FROM orders GROUP BY 1, 2) SELECT id, string_agg(code || '=' || name, ',' ORDER BY code) AS departments FROM d GROUP BY id"""
)
def department_lists(t):
    out = A.departments(t("orders"), "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderkey")
    return out.select(F.col("o_custkey").alias("id"), F.array_join(F.transform("departments", lambda x: F.concat(x["code"], F.lit("="), x["name"])), ",").alias("departments"))


@query("SELECT 'customer' AS sector, c_custkey AS id, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, NULL FROM supplier")
def sector_union(t):
    return A.union_sectors({"customer": t("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")), "supplier": t("supplier").select(F.col("s_suppkey").alias("id"))}).select("sector", "id", "segment")


@query("SELECT o_orderkey AS id, o_totalprice AS price, c_name AS name, coalesce(CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'done' END, '') AS decision FROM orders JOIN customer ON c_custkey = o_custkey")
def conflict_decisions(t):
    o = t("orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("day"), "o_totalprice")
    decisions = t("orders").filter("o_orderstatus in ('O', 'F')").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("day"), F.when(F.col("o_orderstatus") == "O", "open").otherwise("done").alias("decision"))
    facilities = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return A.with_decisions(o, decisions, facilities).filter("name is not null").select(F.col("day").alias("id"), F.col("o_totalprice").alias("price"), "name", "decision")


@query("SELECT vec_id, count(*) AS n, round(avg(x), 6) AS lon, round(avg(y), 6) AS lat FROM (SELECT vec_id, unnest(embedding[1:32])::DOUBLE AS x, unnest(embedding[33:64])::DOUBLE AS y FROM embeddings) GROUP BY 1")
def vertex_mean(t):
    e = F.col("embedding")
    ring = F.arrays_zip(F.slice(e, 1, 32).alias("x"), F.slice(e, 33, 32).alias("y"))
    points_ = F.transform(ring, lambda p: F.array(p["x"].cast("double"), p["y"].cast("double")))
    c = A.centroid(F.array(points_)).alias("c")
    return t("embeddings").select("vec_id", F.size(ring).cast("long").alias("n"), c).select("vec_id", "n", F.round("c.lon", 6).alias("lon"), F.round("c.lat", 6).alias("lat"))


@query(
    """SELECT c_custkey AS id, CASE WHEN r THEN 'moved / 住所の未解釈部分: rest' ELSE 'moved' END AS note, '元データの座標 1.5, ' || c_custkey AS discarded, level, CASE level WHEN '3' THEN '大字と丁目の代表点' WHEN '8' THEN '住居表示の位置' ELSE '' END AS meaning,
 CASE WHEN level = '8' AND c_custkey % 2 = 0 THEN true ELSE false END AS covered FROM (SELECT c_custkey, c_custkey % 3 = 0 AS r, CASE c_custkey % 4 WHEN 0 THEN '8' WHEN 1 THEN '3' ELSE '7' END AS level FROM customer)"""
)
def adopted_points(t):
    k = F.col("c_custkey")
    level = F.when(k % 4 == 0, 8).when(k % 4 == 1, 3).otherwise(7)
    p = N.adopted_point(F.lit("35.1"), F.lit("135.2"), level, F.lit("moved"), F.lit("drift"), F.lit(""), F.when(k % 3 == 0, "rest").otherwise(""))
    rows = t("customer").select(k.alias("id"), p.alias("p"), N.discarded_point(F.lit(" 1.5"), k.cast("string")).alias("discarded"), A.drift_rule_applies(level.cast("string"), F.when(k % 2 == 0, "照合済み").otherwise("推定"), F.lit(1.0)).alias("covered"))
    return rows.select("id", "p.note", "discarded", "p.level", F.col("p.level_meaning").alias("meaning"), "covered")


@query(
    """SELECT c_custkey AS id, concat_ws(' / ', CASE WHEN a = 1 THEN '日跨ぎとして採用 2件' END, CASE WHEN a = 2 THEN 'x' END, CASE WHEN b = 1 THEN 'opening_hours をタグ出力していない。営業日のMo曜に時刻の記載が無い' WHEN b = 2 THEN '営業日のTu曜に時刻の記載が無いため opening_hours に unknown と書いた' END,
  CASE WHEN c = 1 THEN '営業曜日と時刻が食い違う曜日が3件。採用×2' END, CASE WHEN a = 3 THEN '定期週の休診を反映: Sa' END, CASE WHEN b = 3 THEN 'その他の休診日から4日を反映' END, CASE WHEN c = 2 THEN '日付不明の休診期間をコメントに退避: お盆' END, CASE WHEN c = 2 THEN '未変換の休診日記述: お盆休み' WHEN c = 3 THEN '休診日の記述「お盆休み」を opening_hours に変換できていない' WHEN c = 4 THEN '未変換の休診日記述: なし' END) AS note,
 concat_ws(' / ', CASE WHEN a = 2 THEN 'x' END, CASE WHEN b = 1 THEN 'opening_hours をタグ出力していない。営業日のMo曜に時刻の記載が無い' WHEN b = 2 THEN '営業日のTu曜に時刻の記載が無いため opening_hours に unknown と書いた' END, CASE WHEN c = 1 THEN '営業曜日と時刻が食い違う曜日が3件。採用×2' END, CASE WHEN c = 3 THEN '休診日の記述「お盆休み」を opening_hours に変換できていない' END) AS why
 FROM (SELECT c_custkey, c_custkey % 4 AS a, c_custkey // 4 % 4 AS b, c_custkey // 16 % 5 AS c FROM customer)"""
)
def hours_notes(t):
    k = F.col("c_custkey")
    a, b, c = k % 4, F.floor(k / 4) % 4, F.floor(k / 16) % 5
    text = lambda cond, v: F.when(cond, v).otherwise("")
    note = N.hours_notes(F.when(a == 1, 2).otherwise(0), F.when(a == 2, F.array(F.lit("x"))), text(b == 1, "Mo"), text(b == 2, "Tu"), F.when(c == 1, 3).otherwise(0), text(c == 1, "採用×2"), text(a == 3, "Sa"), F.when(b == 3, 4).otherwise(0), text(c == 2, "お盆"), F.when(c.isin(2, 3), "お盆休み").when(c == 4, "なし").otherwise(""))
    return t("customer").select(k.alias("id"), note.alias("n")).select("id", "n.note", "n.why")


# --- names ------------------------------------------------------------------------------------------------------------------


@query(
    """SELECT c_custkey AS id, CASE c_custkey % 6 WHEN 0 THEN 'Sakura Clinic' WHEN 4 THEN '' ELSE '' END AS english, CASE c_custkey % 6 WHEN 1 THEN 'Ouchi' ELSE '' END AS latin, CASE c_custkey % 6 WHEN 2 THEN 'disagrees' WHEN 3 THEN 'unverified' WHEN 5 THEN 'not_ascii' ELSE '' END AS note,
 CASE c_custkey % 6 WHEN 3 THEN '' ELSE 'おおうち' END AS reading, c_custkey % 6 = 2 AS short_used, CASE c_custkey % 6 WHEN 0 THEN '桜' ELSE '桜病院' END AS name, CASE c_custkey % 6 WHEN 0 THEN '花' ELSE '' END AS alt_name, CASE c_custkey % 6 WHEN 1 THEN '梅' ELSE '' END AS old_name FROM customer"""
)
def name_routing(t):
    from clinicweave.functions.kana import with_similarity

    k = F.col("c_custkey") % 6
    english = F.when(k == 0, "Sakura Clinic").when(k == 1, "ouchi").when(k == 2, "Yamada").when(k == 3, "Ouchi").when(k == 5, "Ōuchi Clinic").otherwise("")
    reading = X.kept_reading(F.lit("オオウチ"), F.when(k == 3, 1).otherwise(0), F.lit(False))
    short = X.use_short_name(F.when(k == 2, "明雪会").otherwise("桜病院"), F.lit("環状通東 整形外科"), ["病院", "クリニック"], ["整形外科"])
    alt = X.bracket_alternatives(F.when(k == 0, "桜（花）").when(k == 1, "桜病院(梅 )").otherwise("桜病院"), {"花": ("alt", "花"), "梅": ("old", "梅")})
    rows = t("customer").select(F.col("c_custkey").alias("id"), X.clean_english(english).alias("e"), reading.alias("reading"), short.alias("short_used"), alt.alias("alt"))
    routed = with_similarity(rows, "e", "reading").withColumn("r", X.route_english(F.col("e"), F.col("reading"), F.col("similarity")))
    return routed.select("id", "r.english", "r.latin", "r.note", "reading", "short_used", "alt.name", "alt.alt_name", "alt.old_name")
