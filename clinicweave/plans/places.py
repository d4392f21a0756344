"""Towns and closed dates as queries whose texts are made from the rows of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinicweave.functions.closures import closure_comment, with_closed_dates
from clinicweave.functions.towns import with_longer_towns
from clinicweave.plans.queries import ORDINAL_SQL, query

# Signs that stand for the digits of a key in a town's name, none of them a numeral, and numerals for its house.
SIGNS, NUMERALS = "甲乙丙丁戊己庚辛壬癸", "〇一二三四五六七八九"

#: A customer is a town of its nation: a name made from its key, a number of blocks, a larger part for some. An order is an
#: address there of which the parser read a beginning of the name.
TOWNS_SQL = f"""SELECT c_nationkey AS city, c_custkey AS at, translate(CAST(c_custkey AS VARCHAR), '0123456789', '{SIGNS}') AS name, c_custkey % 9 + 11 AS block, CASE WHEN c_custkey % 4 = 0 THEN '大字' ELSE '' END AS head, CASE WHEN c_custkey % 3 = 0 THEN '東' ELSE '' END AS part FROM customer"""
FOLDED = "name || CAST(block AS VARCHAR) || '番ケ丘'"


@query(
    f"""WITH t AS (SELECT *, {FOLDED} AS folded FROM ({TOWNS_SQL})),
 a AS (SELECT o_orderkey AS id, t.city, substr(t.name, 1, 1 + CAST(o_orderkey % 2 AS INTEGER)) AS town, substr(t.name, 2 + CAST(o_orderkey % 2 AS INTEGER)) AS rest, t.block, o_orderkey % 5 = 0 AS known FROM orders JOIN t ON t.at = o_custkey),
 r AS (SELECT *, rest || CAST(block AS VARCHAR) || '番ケ丘' AS run, '市' || town || rest || CAST(block AS VARCHAR) || '番ケ丘' AS across FROM a WHERE NOT known AND rest <> ''),
 m AS (SELECT r.id, t.at, t.part, t.head, t.name, t.block, k, row_number() OVER (PARTITION BY r.id ORDER BY k DESC, t.at) AS place FROM r JOIN t ON t.city = r.city, (SELECT unnest(range(2, 20)) AS k) WHERE k > length(r.run) AND k <= length(t.folded) AND ends_with(r.across, substr(t.folded, 1, k)))
 SELECT a.id, coalesce(CASE WHEN m.part <> '' THEN m.part ELSE m.head || m.name || CASE WHEN m.block = 20 THEN '二十' ELSE '十' || substr('{NUMERALS}', CAST(m.block AS INTEGER) - 9, 1) END || '番ヶ丘' END, '') AS longer_town FROM a LEFT JOIN m ON m.id = a.id AND place = 1"""
)
def longer_towns(t):
    """Addresses of all orders whose parsed town is too short, against the towns of all customers."""
    block = F.col("c_custkey") % 9 + 11
    number = F.when(block == 20, "二十").otherwise(F.concat(F.lit("十"), F.substring(F.lit(NUMERALS), (block - 9).cast("int"), F.lit(1))))
    name = F.translate(F.col("c_custkey").cast("string"), "0123456789", SIGNS)
    c = t("customer").select(
        F.lit("p").alias("pref"), F.col("c_nationkey").alias("city"), F.col("c_custkey").alias("at"), name.alias("n"), F.concat(number, F.lit("番ヶ丘")).alias("tail"), F.when(F.col("c_custkey") % 4 == 0, "大字").otherwise("").alias("head"),
        F.when(F.col("c_custkey") % 3 == 0, "東").otherwise("").alias("part"),
    )
    towns = c.select("pref", "city", "part", F.concat("head", "n", "tail").alias("name"), "at")
    size = (1 + F.col("o_orderkey") % 2).cast("int")
    o = t("orders").join(c, F.col("o_custkey") == F.col("at"))
    rest = F.concat(F.substring("n", size + 1, F.length("n")), "tail")
    rows = o.select(F.col("o_orderkey").alias("id"), "pref", "city", F.concat(F.lit("市"), "n", "tail").alias("address"), F.substring("n", F.lit(1), size).alias("town"), F.when(F.length("n") > size, rest).otherwise("").alias("rest"), F.when(F.col("o_orderkey") % 5 == 0, "照合済み").otherwise("なし").alias("evidence"))
    return with_longer_towns(rows, towns).select("id", "longer_town")


#: What an order's customer says of closed dates: its day in one of two notations, a range from it that may be too long or run
#: over the new year, a range with an impossible end, words of periods, with signs and widths that vary.
SAYS_SQL = f"""SELECT *, CASE p WHEN '1' THEN m || '月' || d || '日、' || m2 || '／' || d2 || '（休診日）' WHEN '2' THEN '休み ' || m || '/' || d || CASE WHEN k % 2 = 0 THEN '～' ELSE ' - ' END || m2 || '月' || d2 || '日まで' WHEN '3' THEN '2024年' || m || '月 40日〜' || m2 || '/' || d2 || chr(10) || '年末・年始'
 WHEN '4' THEN '夏' || CASE WHEN k % 2 = 0 THEN '季' ELSE '期' END || '・盆 休み' || CASE WHEN k % 3 = 0 THEN '，ＧＷ' ELSE '' END ELSE '年末年始（12/29-1/3）創 立記念日：' || m || ' 月 ' || d || ' 日' END AS says
 FROM (SELECT *, strftime(DATE '2024-01-01' + o, '%-m') AS m, strftime(DATE '2024-01-01' + o, '%-d') AS d, strftime(DATE '2024-01-01' + (o + k) % 366, '%-m') AS m2, strftime(DATE '2024-01-01' + (o + k) % 366, '%-d') AS d2
 FROM (SELECT o_orderkey AS id, substr(o_orderpriority, 1, 1) AS p, {ORDINAL_SQL} AS o, CAST(o_orderkey % 40 AS INTEGER) AS k FROM orders))"""


@query(
    f"""WITH s AS ({SAYS_SQL}), y AS (SELECT *, CASE p WHEN '1' THEN [o, (o + k) % 366] WHEN '2' THEN CASE WHEN k < 31 THEN list_transform(range(k + 1), lambda i: CAST((o + i) % 366 AS INTEGER)) ELSE [] END WHEN '3' THEN [(o + k) % 366] WHEN '4' THEN [] ELSE [363, 364, 365, 0, 1, 2, o] END AS ds,
 CASE p WHEN '1' THEN '' WHEN '2' THEN CASE WHEN k < 31 THEN '' ELSE '休みまで[31日超の範囲:' || m || '/' || d || CASE WHEN k % 2 = 0 THEN '~' ELSE ' - ' END || m2 || '月' || d2 || '日]' END WHEN '3' THEN m || '月40日〜' WHEN '4' THEN '夏' || CASE WHEN k % 2 = 0 THEN '季' ELSE '期' END || '・盆休み' || CASE WHEN k % 3 = 0 THEN 'GW' ELSE '' END ELSE '創立記念日' END AS rest FROM s)
 SELECT id, says, list_aggregate(list_sort(list_distinct(ds)), 'string_agg', ',') AS dates, rest, CASE p WHEN '4' THEN CASE WHEN k % 3 = 0 THEN 'GW・' ELSE '' END || 'お盆・夏季は休診' WHEN '5' THEN '創立記念日は休診' ELSE '' END AS comment FROM y"""
)
def closed_dates(t):
    """Closed dates, what is left of the text, and the comment for undated periods, of what the customers of all orders say."""
    k, o = (F.col("o_orderkey") % 40).cast("int"), F.date_diff(F.make_date(F.lit(2024), F.month("o_orderdate"), F.dayofmonth("o_orderdate")), F.lit("2024-01-01").cast("date"))
    at = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    m, d, m2, d2 = (f(at(n)).cast("string") for n in (o, F.pmod(o + k, F.lit(366))) for f in (F.month, F.dayofmonth))
    say = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    p = F.substring("o_orderpriority", 1, 1)
    says = (
        F.when(p == "1", say(m, "月", d, "日、", m2, "／", d2, "（休診日）"))
        .when(p == "2", say("休み ", m, "/", d, F.when(k % 2 == 0, "～").otherwise(" - "), m2, "月", d2, "日まで"))
        .when(p == "3", say("2024年", m, "月 40日〜", m2, "/", d2, "\n年末・年始"))
        .when(p == "4", say("夏", F.when(k % 2 == 0, "季").otherwise("期"), "・盆 休み", F.when(k % 3 == 0, "，ＧＷ").otherwise("")))
        .otherwise(say("年末年始（12/29-1/3）創 立記念日：", m, " 月 ", d, " 日"))
    )
    read = with_closed_dates(t("orders").select(F.col("o_orderkey").alias("id"), says.alias("says")), "says")
    texts = F.nullif(F.array_join(F.transform("closed.dates", lambda x: x.cast("string")), ","), F.lit(""))
    return read.select("id", "says", texts.alias("dates"), F.col("closed.rest").alias("rest"), closure_comment(F.col("closed.rest")).alias("comment"))
