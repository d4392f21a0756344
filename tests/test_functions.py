"""Column functions and readers on small tables, with the cases that go wrong easily."""

import random

import pytest
from pyspark.sql import functions as F

from clinicweave.functions import geo, hours, text
from clinicweave.functions.kana import syllables, to_romaji
from clinicweave.operators import intervals, tables


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("days,want", [([0, 1, 2], "Mo-We"), ([0, 1], "Mo,Tu"), ([0, 2, 3, 4], "Mo,We-Fr"), ([5, 6, 7], "Sa,Su,PH"), ([0, 1, 2, 3, 4, 5, 6, 7], "Mo-Su,PH"), ([7], "PH"), ([], "")])
def test_fold_days(spark, days, want):
    assert one(spark, hours.fold_days(F.lit(days).cast("array<int>"))) == want


@pytest.mark.parametrize("start,end,want", [(0, 0, "null_placeholder"), (0, 1439, "sentinel_24h"), (300, 600, "too_early"), (540, 1400, "too_late"), (1080, 60, None), (600, 540, "overnight_implausible"), (540, 750, None), (360, 1380, None)])
def test_classify(spark, start, end, want):
    assert one(spark, hours.classify(F.lit(start), F.lit(end))) == want


def test_union_of_intervals_covers_the_same_minutes_and_is_stable(spark):
    rng = random.Random(4)
    cases = [(i, [(s, s + rng.randint(1, 200)) for s in (rng.randint(0, 1200) for _ in range(rng.randint(0, 8)))]) for i in range(200)]
    df = spark.createDataFrame(cases, f"id int, x {hours.INTERVALS}").select("id", hours.union_intervals(F.col("x")).alias("u")).select("id", "u", hours.union_intervals(F.col("u")).alias("again"))
    long = spark.createDataFrame([(i, s, e) for i, x in cases for s, e in x], "id int, s int, e int")
    by_window = {}
    for r in intervals.interval_union(long, ["id"]).collect():
        by_window.setdefault(r["id"], []).append((r["s"], r["e"]))
    for row in df.collect():
        merged = [(x["s"], x["e"]) for x in row["u"]]
        minutes = {m for s, e in dict(cases)[row["id"]] for m in range(s, e)}
        assert {m for s, e in merged for m in range(s, e)} == minutes and row["u"] == row["again"]
        assert all(a[1] < b[0] for a, b in zip(merged, merged[1:], strict=False))
        assert sorted(by_window.get(row["id"], [])) == merged


def test_dates_fold_over_the_new_year(spark):
    text_of = lambda d: one(spark, hours.fold_dates(F.lit(d).cast("array<int>")))
    assert text_of([0, 1, 2, 364, 365]) == "Dec 30-Jan 03"
    assert text_of([0, 1]) == "Jan 01-Jan 02"
    assert text_of(list(range(366))) == "Jan 01-Dec 31"
    assert text_of([]) == ""


@pytest.mark.parametrize("most", [5, 20, 30, 255])
def test_rules_fit(spark, most):
    whole = "Mo-Fr 09:00-12:00; Sa off; PH off"
    kept, dropped = one(spark, hours.fit_rules(F.lit(whole), most))
    assert len(kept) <= most and "; ".join(x for x in (kept, dropped) if x) == whole


def plain_romaji(reading):
    table, parts, rest = syllables(), [], reading.replace("ー", "")
    while rest:
        size = 2 if rest[:2] in table else 1
        kana, rest = rest[:size], rest[size:]
        following = table.get(rest[:2]) or table.get(rest[:1]) or ""
        if kana == "っ":
            parts.append("" if following[:1] in ("a", "i", "u", "e", "o") else following[:1])
        elif kana == "ん" and following[:1] and following[0] in "aiueoy":
            parts.append("n'")
        else:
            parts.append(table.get(kana, kana))
    return "".join(parts)


def test_readings(spark):
    known = {"がっこう": "gakkou", "しんや": "shin'ya", "ファー": "ファ", "ちゃ": "cha", "ふぁ": "fa", "んん": "nn", "っ": "", "あっあ": "aa", "てぃっちぇ": "ticche"}
    rng = random.Random(6)
    texts = [*known, "", *["".join(rng.choice("かきゃしょんっーつぁいうゐを漢a 　ふゔじゅ\n") for _ in range(rng.randint(0, 12))) for _ in range(500)]]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", to_romaji(F.col("x")).alias("y")).orderBy("i").collect()
    assert [r["y"] for r in rows] == [plain_romaji(t) for t in texts]
    assert [r["y"] for r in rows[: len(known)]] == list(known.values())
    assert one(spark, to_romaji(F.lit(None).cast("string"))) is None


def test_distance_and_grid(spark):
    assert abs(one(spark, geo.distance_m(F.lit(35.0), F.lit(139.0), F.lit(36.0), F.lit(139.0))) - 111194.9) < 0.1
    assert one(spark, geo.on_coarse_grid(F.lit(38.0), F.lit(140.1))) and not one(spark, geo.on_coarse_grid(F.lit(38.01), F.lit(140.1)))
    for bad in ("", "nan", "0.0", "35.6abc", "Infinity", None):
        assert not one(spark, geo.usable(F.lit(bad).cast("string")))


def test_romaji_folding_and_widths(spark):
    assert one(spark, text.fold_romaji(F.lit("Toukyou Syouzya"))) == "tokyoshoja"
    assert one(spark, text.normalize_chars(F.lit("Ａ　（１）  病院"))) == "A (1) 病院"
    assert one(spark, text.clip_notes(F.lit("a" * 50 + " / " + "b" * 50), 60)) == "a" * 50
    assert one(spark, text.clip_notes(F.lit("a" * 70), 60)) == "a" * 60


def test_percentiles_and_uniqueness(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4)], "k string, v double")
    assert tables.percentile_by_index(df, ["k"], "v", [50, 99]).first()[1:] == (3.0, 4.0, 4.0)
    left, right = spark.createDataFrame([("x", 1), ("y", 2), ("y", 3), (None, 4)], "k string, a int"), spark.createDataFrame([("x", 5), ("y", 6), (None, 7)], "k string, b int")
    assert [tuple(r) for r in tables.unique_match(left, right, "k").collect()] == [("x", 1, 5)]


def test_csv_round_trip(spark, tmp_path):
    from clinicweave.sources import files

    df = spark.createDataFrame([("1", 'a "quoted", text', None), ("2", "two\nlines", "東京")], "ID string, name string, city string")
    at = str(tmp_path / "x_2.csv")
    files.write_csv(df, at, order=["ID"])
    with open(at, encoding="utf-8") as f:
        assert f.read(1) == files.BOM
    assert files.latest(spark, str(tmp_path / "x_*.csv")).endswith("x_2.csv")
    back = files.read_csv(spark, at, ["ID"], ["beds"])
    assert [tuple(r) for r in back.orderBy("ID").collect()] == [("1", 'a "quoted", text', None, None), ("2", "two\nlines", "東京", None)]
    with pytest.raises(ValueError):
        files.read_csv(spark, at, ["missing"])
    assert files.read_keyed(spark, str(tmp_path / "none.csv"), "ID", ["a"]).count() == 0


def test_geojson_round_trip(spark, tmp_path):
    from clinicweave.sources import geojson

    df = spark.createDataFrame([("1", "35.1", "139.2", 'a "b"\n'), ("2", "36.0", "140.0", None)], "id string, lat string, lon string, name string")
    out = df.select("id", geojson.feature_text(F.col("lat"), F.col("lon"), {"name": F.col("name"), "_id": F.col("id")}).alias("feature"))
    geojson.write_collection(out, str(tmp_path / "f.geojson"))
    back = {r["properties"]["_id"]: r for r in geojson.read_features(spark, str(tmp_path / "f.geojson")).collect()}
    assert back["1"]["geometry"]["coordinates"] == [139.2, 35.1] and back["1"]["properties"]["name"] == 'a "b"\n' and "name" not in back["2"]["properties"]
    geojson.write_tasks(out.withColumn("pref", F.lit("01")), str(tmp_path / "tasks"), "pref")
    assert spark.read.text(str(tmp_path / "tasks")).count() == 2
