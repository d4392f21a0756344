"""Opening hours evaluated against a calendar, as queries whose rules are made from the rows of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinicweave.functions import calendar as C
from clinicweave.functions import hours as H
from clinicweave.operators import intervals as I
from clinicweave.operators import validators as V
from clinicweave.plans.queries import DAY_NAMES, GOOD_SQL, ORACLES, date_runs, good_slots, query

#: An order is a facility: a weekday's hours from its keys, and later rules from its priority, which override them. Some run
#: over midnight, some end where they start, some are no hours at all.
RULES_SQL = f"""SELECT o_orderkey AS id, o_orderpriority AS p, d, s, e, odd, CASE WHEN broken THEN {DAY_NAMES}[d + 1] || ' 9:00~17:00' ELSE {DAY_NAMES}[d + 1] || ' ' || printf('%02d:%02d-%02d:%02d', s // 60, s % 60, e // 60, e % 60) ||
 CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '; ' || {DAY_NAMES}[d + 1] || ' off' WHEN '2' THEN '; Jan 05-Apr 05 off' WHEN '3' THEN '; Jan 05-Feb 08 off; PH off' WHEN '4' THEN '; ' || {DAY_NAMES}[d + 1] || '[2,4] off; PH off || off "' || o_orderstatus || '"'
 ELSE CASE WHEN odd THEN '; "' || o_orderstatus || '"' ELSE '; Dec 29-Jan 12 off' END END || CASE WHEN o_custkey % 19 = 0 THEN repeat('; We off', 30) ELSE '' END END AS v, broken, o_custkey % 19 = 0 AND d = 2 AS shut
 FROM (SELECT *, o_orderkey % 2 = 1 AS odd, o_custkey % 17 = 0 AS broken, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS d, CASE WHEN o_custkey % 11 = 0 THEN 1200 ELSE 480 + o_orderkey % 7 * 15 END AS s,
 CASE WHEN o_custkey % 11 = 0 THEN 120 + o_custkey % 9 * 60 WHEN o_custkey % 13 = 0 THEN 480 + o_orderkey % 7 * 15 ELSE 540 + o_orderkey % 7 * 15 + o_custkey % 9 * 60 END AS e FROM orders)"""
#: The days on which each order's first rule decides, and the minutes from the first midnight to which it is open.
DAYS_SQL = f"""WITH r AS ({RULES_SQL}), c AS (SELECT CAST(i AS INTEGER) AS i, DATE '2026-01-05' + CAST(i AS INTEGER) AS t FROM range(91) x(i)),
 c2 AS (SELECT i, CAST(isodow(t) - 1 AS INTEGER) AS dow, (day(t) + 6) // 7 AS week, strftime(t, '%m%d') AS md, t IN (DATE '2026-01-12', DATE '2026-02-11', DATE '2026-02-23', DATE '2026-03-20') AS ph FROM c),
 o AS (SELECT id, p, i, i * 1440 + s AS a, i * 1440 + CASE WHEN e <= s THEN e + 1440 ELSE e END AS b FROM r JOIN c2 ON dow = d WHERE NOT broken AND NOT shut AND CASE substr(p, 1, 1) WHEN '1' THEN false WHEN '2' THEN false
 WHEN '3' THEN NOT (ph OR md BETWEEN '0105' AND '0208') WHEN '4' THEN NOT (ph OR week IN (2, 4)) ELSE NOT odd AND md > '0112' END)"""


def rules_of_orders(t):
    k, c, d = F.col("o_orderkey"), F.col("o_custkey"), F.weekday("o_orderdate")
    night = c % 11 == 0
    start = F.when(night, 1200).otherwise(480 + k % 7 * 15)
    end = F.when(night, 120 + c % 9 * 60).when(c % 13 == 0, start).otherwise(540 + k % 7 * 15 + c % 9 * 60)
    day = F.get(F.array(*map(F.lit, C.DAYS)), d)
    clock = lambda m: F.format_string("%02d:%02d", F.floor(m / 60), m % 60)
    p = F.substring("o_orderpriority", 1, 1)
    later = (
        F.when(p == "1", F.concat(F.lit("; "), day, F.lit(" off"))).when(p == "2", "; Jan 05-Apr 05 off").when(p == "3", "; Jan 05-Feb 08 off; PH off")
        .when(p == "4", F.concat(F.lit("; "), day, F.lit('[2,4] off; PH off || off "'), "o_orderstatus", F.lit('"'))).otherwise(F.when(k % 2 == 1, F.concat(F.lit('; "'), "o_orderstatus", F.lit('"'))).otherwise("; Dec 29-Jan 12 off"))
    )
    text = F.concat(day, F.lit(" "), clock(start), F.lit("-"), clock(end), later, F.when(c % 19 == 0, "; We off" * 30).otherwise(""))
    return t("orders").select(k.alias("id"), F.when(c % 17 == 0, F.concat(day, F.lit(" 9:00~17:00"))).otherwise(text).alias("opening_hours"))


@query(
    f"{DAYS_SQL} SELECT id, v AS opening_hours, CAST(coalesce((SELECT sum(least(b, 50400) - a) FROM o WHERE o.id = r.id AND i < 35), 0) AS INTEGER) AS five_weeks, CAST(coalesce((SELECT sum(least(b, 131040) - a) FROM o WHERE o.id = r.id), 0) AS INTEGER) AS thirteen_weeks FROM r WHERE NOT broken"
)
def open_minutes(t):
    """Minutes of certain opening within 5 and 13 weeks: rules are parsed from text and decide day by day."""
    rows = rules_of_orders(t).filter(F.col("opening_hours").rlike(C.HOURS))
    return C.with_open_minutes(rows, "opening_hours", {"five_weeks": 35, "thirteen_weeks": 91})


HOURS_TEXT = "printf('%02d:%02d-%02d:%02d', s // 60, s % 60, e // 60, e % 60)"


@query(
    f"""{DAYS_SQL}, f AS (SELECT 'error' AS kind, id, substr(v, 1, 60) AS detail FROM r WHERE broken
 UNION ALL SELECT 'never_open', id, CASE WHEN p LIKE '5%' AND odd THEN '{V.ONLY_UNKNOWN}' ELSE '{V.NEVER_OPEN}' END FROM r WHERE NOT broken AND id NOT IN (SELECT id FROM o)
 UNION ALL SELECT 'zero_span', id, {HOURS_TEXT} FROM r WHERE NOT broken AND s = e UNION ALL SELECT 'too_long', id, CAST(length(v) AS VARCHAR) FROM r WHERE length(v) > 255
 UNION ALL SELECT 'warning', id, {HOURS_TEXT} FROM r WHERE NOT broken AND e < s AND e + 1440 - s >= 720) SELECT kind, CAST(id AS VARCHAR) AS id, detail FROM f"""
)
def validate_hours(t):
    """Findings in the hours of all orders, among them those that later rules close for good."""
    return V.hours_issues(rules_of_orders(t), "id")


@query(
    f"""WITH w AS ({ORACLES['hours_expression']}), ds AS ({ORACLES['date_runs']}), g AS (SELECT DISTINCT id FROM ({GOOD_SQL}) WHERE day = 5)
 SELECT w.id, expression || CASE WHEN id % 7 = 3 THEN '; PH unknown' ELSE '' END || CASE WHEN id IN (FROM g) AND id % 4 > 0 THEN '; Sa[' || CASE id % 4 WHEN 1 THEN '1,3' WHEN 2 THEN '5' ELSE '2,3,4' END || '] off' ELSE '' END || CASE WHEN id % 3 = 0 THEN '; PH off' ELSE '' END
 || coalesce('; ' || dates || ' off', '') || CASE WHEN id % 5 = 0 THEN ' || off "GWは休診"' ELSE '' END AS opening_hours FROM w LEFT JOIN ds USING (id)"""
)
def facility_hours(t):
    """The whole expression of a user's slots, weeks of the month, holidays, closed dates (of the customer with its key) and comment."""
    slots = good_slots(t)
    saturdays = slots.filter("day = 5").select("id").distinct().withColumn("sa", F.lit(True))
    rows = I.week_expression(slots).join(saturdays, "id", "left").join(date_runs(t), "id", "left")
    k = F.col("id")
    weeks = F.when(k % 4 == 1, F.array(F.lit(1), F.lit(3))).when(k % 4 == 2, F.array(F.lit(5))).when(k % 4 == 3, F.array(F.lit(2), F.lit(3), F.lit(4))).otherwise(F.array().cast("array<int>"))
    nth = F.array_compact(F.array(H.nth_week_rule(F.lit(5), weeks, F.coalesce("sa", F.lit(False)))))
    unknown = F.when(k % 7 == 3, F.array(F.lit(7))).otherwise(F.array().cast("array<int>"))
    text = H.hours_expression(F.col("expression"), unknown, nth, k % 3 == 0, F.col("dates"), F.when(k % 5 == 0, "GWは休診").otherwise(""))
    return rows.select("id", text.alias("opening_hours"))
