"""Opening hours day by day, against a plain reading of the same rules."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from clinicweave.functions import calendar as C
from clinicweave.operators import validators as V

DAYS = ["Mo", "Tu", "We", "Th", "Fr", "Sa", "Su", "PH"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def plain_minutes(rules, weeks=13):
    """Rules as (selectors, state, spans, fallback): open minutes by marking each minute."""
    n = 7 * weeks
    marks = bytearray((n + 3) * 1440)
    for i in range(n):
        d = C.PROBE_FROM + timedelta(i)

        def on(sel, d=d):
            kind, a, b, nth = sel
            if kind == "date":
                x = (d.month, d.day)
                return a <= x <= b if a <= b else x >= a or x <= b
            if a == 7:
                return d in C.HOLIDAYS
            x = d.weekday()
            return (a <= x <= b if a <= b else x >= a or x <= b) and (not nth or (d.day - 1) // 7 + 1 in nth)

        held = lambda fallback: [r for r in rules if r[3] == fallback and (not r[0] or any(map(on, r[0])))][-1:]  # noqa: E731, B023
        main, rest = held(False), held(True)
        spans = []
        for r in main + (rest if not main or main[0][1] != "unknown" else []):
            if r[1] == "open":
                spans += r[2] or [(0, 1440)]
        for s, e in spans:
            e = e + 1440 if e <= s else e
            marks[i * 1440 + s : i * 1440 + e] = b"\1" * (e - s)
    return sum(marks[: n * 1440])


def random_value(rng):
    rules, texts = [], []
    for k in range(rng.randint(1, 5)):
        sel, words = [], []
        kind = rng.choice(["days", "days", "date", ""])
        for _ in range(rng.randint(1, 2) if kind else 0):
            if kind == "days":
                a, b = rng.randrange(8), rng.randrange(7)
                nth = sorted(rng.sample(range(1, 6), 2)) if rng.random() < 0.3 and a < 7 else []
                if a == 7 or rng.random() < 0.5:
                    b = a
                words.append(DAYS[a] + (f"-{DAYS[b]}" if b != a else "") + (f"[{','.join(map(str, nth))}]" if nth else ""))
                sel.append(("day", a, b, nth))
            else:
                a, b = (date(2024, 1, 1) + timedelta(rng.choice([rng.randrange(366), rng.randrange(100)])) for _ in range(2))
                b = b if rng.random() < 0.7 else a
                words.append(f"{MONTHS[a.month - 1]} {a.day:02d}" + (f"-{MONTHS[b.month - 1]} {b.day:02d}" if b != a else ""))
                sel.append(("date", (a.month, a.day), (b.month, b.day), []))
        state = rng.choice(["spans", "spans", "spans", "off", "unknown", "24/7", "comment", "remark"] + ([""] if sel else []))
        spans = [(rng.randrange(48) * 30, rng.randrange(48) * 30 + rng.choice([0, 0, 1440])) for _ in range(rng.randint(1, 2))]
        clock = ",".join(f"{s // 60:02d}:{s % 60:02d}-{e // 60:02d}:{e % 60:02d}" for s, e in spans)
        text = {"spans": clock, "remark": clock + ' "off; by appointment"', "comment": '"Mo off"'}.get(state, state)
        if state == "comment":
            sel, words = [], []
        fallback = k > 0 and rng.random() < 0.2
        texts.append((" || " if fallback else "; " if k else "") + " ".join(x for x in (",".join(words), text) if x))
        known = {"off": "off", "unknown": "unknown", "comment": "unknown", "remark": "unknown"}.get(state, "open")
        rules.append((sel, known, spans if state in ("spans", "remark") else [], fallback))
    return "".join(texts), rules


def test_minutes_against_marked_minutes(spark):
    rng = random.Random(1)
    values = dict(random_value(rng) for _ in range(250))
    df = spark.createDataFrame([(v,) for v in values] + [(None,), ("",), ("Mo 9-5",)], "v string")
    got = {r["v"]: (r["a"], r["b"]) for r in C.with_open_minutes(df, "v", {"a": 35, "b": 91}).collect()}
    assert got[None] == got[""] == got["Mo 9-5"] == (None, None)
    for v, rules in values.items():
        assert got[v] == (plain_minutes(rules, 5), plain_minutes(rules)) or not spark.range(1).select(F.lit(v).rlike(C.HOURS)).first()[0], v
    never = {r["id"] for r in V.hours_issues(df.filter("v <> ''"), "v", "v").filter("kind = 'never_open'").select("id").collect()}
    valid = {v for v in values if got[v][1] is not None}
    assert never == {v for v in valid if got[v][1] == 0} and len(never) > 10 and len(valid) == len(values)


NEVER = [
    ("Mo-Fr 09:00-17:00; Jan 01-Apr 30 off", {"never_open"}),
    ("Mo-Fr 09:00-17:00; Mo-Fr off", {"never_open"}),
    ("Mo-Fr 09:00-17:00; Mo-We off; Th,Fr unknown", {"never_open"}),
    ("PH 09:00-12:00", set()),
    ("Mo[5] 09:00-12:00; Mar 01-Mar 31 off", {"never_open"}),
    ("Mo[5] 09:00-12:00; Mar 01-Mar 29 off", set()),
    ("Apr 05 09:00-12:00", set()),
    ("Apr 06 09:00-12:00", {"never_open"}),
    ("Dec 30-Jan 05 10:00-11:00", set()),
    ("off || Mo 09:00-10:00", set()),
    ("unknown || Mo 09:00-10:00", {"never_open"}),
    ('Mo 09:00-10:00 "by appointment"', {"never_open"}),
    ("24/7", set()),
    ("", set()),
    (None, set()),
]


def test_never_open(spark):
    df = spark.createDataFrame([(str(i), v) for i, (v, _) in enumerate(NEVER)], "id string, opening_hours string")
    found = V.hours_issues(df, "id")
    assert {(r["id"], r["kind"]) for r in found.collect()} == {(r["id"], r["kind"]) for r in V.fatal_hours(found).collect()} == {(str(i), k) for i, (_, kinds) in enumerate(NEVER) for k in kinds}


def test_details_name_unknown_states(spark):
    df = spark.createDataFrame([("a", "Mo 09:00-10:00; unknown"), ("b", "Mo 09:00-10:00; off")], "id string, opening_hours string")
    assert {r["id"]: r["detail"] for r in V.hours_issues(df, "id").collect()} == {"a": V.ONLY_UNKNOWN, "b": V.NEVER_OPEN}
    assert V.hours_issues(df.limit(0), "id").count() == 0
