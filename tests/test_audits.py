"""Second looks at addresses, audits by name, mapping tables and counts."""

import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clinicweave.functions import notes, text
from clinicweave.operators import audits, intervals, resolver, tables

FIRST = "id string, base string, evidence string, block string, house string, lat string, lng string, level string, note string"


def ledger():
    """A resolver; a function inside of another is sent to workers by value."""

    def answer(asked):
        known = asked["address"].str.contains("番")
        text = lambda a: known.map({True: a, False: ""})
        block = asked["address"].str.extract(r"(\d+)番")[0].fillna("")
        house = asked["address"].str.extract(r"(\d+)号")[0].fillna("").replace("9", "8")
        return pd.DataFrame({"key": asked.iloc[:, 0], "evidence": text("照合済み"), "block": block, "house": house, "lat": text("1.5"), "lng": text("2.5"), "level": text("8"), "note": text("new")})

    return answer


def test_second_look_replaces_point_level_and_note(spark):
    rows = [
        ("a", "町", "推定", "3", "", "1", "2", "3", "old"),
        ("b", "町", "推定", "3", "9", "1", "2", "3", "old"),
        ("c", "町", "照合済み", "3", "1", "1", "2", "8", "old"),
        ("d", "町", "推定", "", "", "1", "2", "3", "old"),
        ("e", None, "推定", "3", "", "1", "2", "3", "old"),
        ("f", "町", None, "3", "", None, None, None, None),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], FIRST + ", extra string")
    got = {r["id"]: r for r in resolver.recheck_inferred(df, ledger(), "id", "base").collect()}
    assert len(got) == 6 and got["a"]["extra"] == "x"
    new = lambda i: tuple(got[i][c] for c in ("evidence", "lat", "lng", "level", "note", "recheck"))
    assert new("a") == ("照合済み", "1.5", "2.5", "8", "new", "adopted")
    assert new("b") == ("推定", "1", "2", "3", "old", "rejected") and new("c") == ("照合済み", "1", "2", "8", "old", None)
    assert new("d") == ("推定", "1", "2", "3", "old", None) == new("e") and new("f") == (None,) * 6
    assert resolver.recheck_inferred(df.limit(0), ledger(), "id", "base").count() == 0


@pytest.mark.parametrize("wrong,says", [(slice(1, None), "came back"), (slice(None, None, -1), "order of the questions")])
def test_answers_are_held_against_the_questions(spark, wrong, says):
    df = spark.createDataFrame([(str(i), "町1番") for i in range(4)], "id string, address string").coalesce(1)
    answer = ledger()
    assert resolver.resolve(df, answer, "id", "address").count() == 4
    with pytest.raises(Exception, match=says):
        resolver.resolve(df, lambda a: answer(a).iloc[wrong], "id", "address").count()


def plain_name(name):
    out = unicodedata.normalize("NFKC", name or "")
    for p in audits.ENTITIES:
        out = out.replace(p, "")
    return "".join(c for c in out if not c.isspace() and c not in "・･,，.．-ー－‐−—()（）[]「」『』/／|｜").strip().lower()


def test_names_are_compared_in_normal_form(spark):
    names = ["医療法人社団 桜会　さくら・クリニック", "ＡＢＣ（株式会社）", "社会医療法人医療法人甲", "ｶﾞﾝ・センター", "①−２｜", "", None, "医療株式会社法人乙", "独立行政法人"]
    rows = spark.createDataFrame(list(enumerate(names)), "i int, name string").select("i", audits.normal_name(F.col("name")).alias("k")).orderBy("i").collect()
    assert [r["k"] for r in rows] == [plain_name(n) for n in names]


def test_matches_are_unique_on_both_sides_and_reported_from_a_floor(spark):
    ours = spark.createDataFrame([("1", "x", "医療法人 甲乙病院", 35.0, 135.0), ("2", "x", "丙丁医院", 35.0, 135.0), ("3", "x", "丙丁・医院", 35.0, 135.0), ("4", "y", "甲乙", 35.0, 135.0), ("5", "y", "戊己庚", 35.0, 135.0), ("6", "y", "辛壬癸", 35.0, 135.0), ("7", "y", None, 35.0, 135.0)], "id string, city string, name string, lat double, lon double")
    theirs = spark.createDataFrame([("a7", "甲乙病院", 35.001, 135.0), ("n1", "丙丁医院", 35.0, 135.0), ("w3", "甲乙", 35.0, 135.0), ("r9", "戊己庚", 35.0001, 135.0), ("n8", "辛壬癸", 36.0, 135.0), ("n9", None, 35.0, 135.0)], "id string, name string, lat double, lon double")
    met = audits.match_names(ours, theirs)
    assert {(r["id"], r["other_id"]) for r in met.collect()} == {("1", "a7"), ("5", "r9")}
    assert [tuple(r) for r in audits.distance_report(met, ["id"]).collect()] == [("111.2", "1", audits.OBJECT_URL + "relation/3")]
    got = {r["city"]: (r["over"], r["n"], r["percent"], round(r["max"])) for r in audits.distance_summary(met, "city").collect()}
    assert got == {"x": (1, 1, 100.0, 111), "y": (0, 1, 0.0, 11)}


@pytest.mark.parametrize("raw,want", [("n12", "node/12"), ("w5", "way/5"), ("r6", "relation/6"), ("a8", "way/4"), ("a9", "relation/4"), ("z1", "z1"), ("", ""), ("n1x", "n1x"), ("a0", "way/0")])
def test_object_ids(spark, raw, want):
    assert spark.range(1).select(audits.object_url(F.lit(raw)).alias("x")).first()["x"] == audits.OBJECT_URL + want
    assert text.decode_object_id(F.lit(raw)) is not None


def test_facility_types_fall_back_and_stop_without_one(spark):
    table = spark.createDataFrame([("clinic", "some", "clinic"), ("clinic", "", "doctors"), ("dental", None, "dentist")], "sector string, condition string, amenity string")
    rows = spark.createDataFrame([("clinic", "some"), ("clinic", "other"), ("clinic", None), ("dental", "x"), ("dental", "x")], "sector string, condition string")
    assert sorted(r["amenity"] for r in tables.facility_types(rows, table, "sector", "condition", "amenity").collect()) == ["clinic", "dentist", "dentist", "doctors", "doctors"]
    with pytest.raises(Exception, match="no facility type for vet"):
        tables.facility_types(spark.createDataFrame([("vet", "")], rows.schema), table, "sector", "condition", "amenity").collect()
    beds = [("clinic", "1", "病床1以上"), ("clinic", "0", "病床0または空欄"), ("clinic", "x", "病床0または空欄"), ("clinic", None, "病床0または空欄"), ("hospital", "5", "")]
    got = spark.createDataFrame(beds, "s string, b string, w string").select(tables.beds_condition(F.col("s"), F.col("b")).alias("x"), "w").collect()
    assert all(r["x"] == r["w"] for r in got)


def test_boxes_indexes_lists_and_first_rows(spark):
    df = spark.createDataFrame([("01", 1.0, 2.0), ("02", 3.0, 4.0), ("02", 5.0, 0.0)], "p string, lat double, lon double")
    assert {tuple(r) for r in tables.bounding_boxes(df, "p", "lat", "lon", groups=2).collect()} == {("01", 1.0, 1.0, 2.0, 2.0), ("02", 3.0, 5.0, 0.0, 4.0)}
    with pytest.raises(Exception, match="47 boxes are expected, there are 2"):
        tables.bounding_boxes(df, "p", "lat", "lon", groups=47).collect()
    graded = spark.createDataFrame([("a;b", "1", "exact"), ("a", "2", "broader"), ("a", "2", "broader"), ("a", "1", "broader")], "v string, c string, g string")
    assert {tuple(r) for r in tables.reverse_index_by(graded, "v", "c", "g", ["exact", "broader"]).collect()} == {("a", 2, "1", "1,2"), ("b", 1, "1", "")}
    with pytest.raises(Exception, match="unknown grade"):
        tables.reverse_index_by(graded, "v", "c", "g", ["exact"]).collect()
    assert [tuple(r) for r in tables.review_list(spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (2, "b", "x")], "n int, k string, v string"), "n", ["k", "v"]).collect()] == [(2, "b", "x"), (2, "a", "y"), (1, "a", "x")]
    rows = spark.createDataFrame([(3, "c"), (1, ""), (2, "b"), (0, None)], "at int, id string")
    assert [r["id"] for r in tables.first_rows(rows, "at", "id", 2).collect()] == ["b", "c"]


def test_counts_of_a_facility(spark):
    split = intervals.split_intervals(spark.createDataFrame([("a", 0, 540, 720), ("a", 1, 1200, 60), ("a", 2, 0, 0), ("b", 0, 0, 1439)], "id string, day int, s int, e int"))
    conflicts = spark.createDataFrame([("a", 0, "x"), ("c", 1, "x"), ("c", 2, "x")], "id string, day int, conflict string")
    assert {tuple(r) for r in intervals.facility_counts(split, conflicts).collect()} == {("a", 1, 1, 1), ("b", 1, 0, 0), ("c", 0, 0, 2)}


def test_notes_of_points_and_names(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(notes.coord_note(F.lit("moved"), F.lit(8))) == "moved" and one(notes.coord_note(F.lit(""), F.lit(8))) == "座標は住所から付与（位置レベル8）"
    assert [one(notes.needs_review_name(F.lit(n), F.lit(w))) for n, w in (("a", ""), ("", ""), ("a", "x"))] == ["", "yes", "yes"]
