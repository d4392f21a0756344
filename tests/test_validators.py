"""Validators and assembly on the known bad rows of the fixtures."""

import pytest
from pyspark.sql import functions as F

from clinicweave.functions import text as X
from clinicweave.operators import assembly as A
from clinicweave.operators import validators as V
from clinicweave.sources import files

PREFECTURES = {"13": "東京都", "14": "神奈川県"}


def kinds(df):
    return {(r["id"], r["kind"]) for r in df.collect()}


def test_known_bad_rows(spark):
    columns = ["ID", "都道府県コード", "lat", "lon", "name", "amenity", "healthcare", "addr:province", "addr:city", "addr:neighbourhood", "addr:housenumber", "website", "未解釈の文字列"]
    good = dict(zip(columns, ["", "13", "35.6", "139.7", "桜病院", "hospital", "hospital", "東京都", "港区", "芝", "", "https://a.jp", ""], strict=True))
    change = {"T01": {}, "T02": {"name": ""}, "T03": {"addr:housenumber": "5", "addr:neighbourhood": ""}, "T04": {"未解釈の文字列": "10-36"}, "T05": {"addr:province": "神奈川県"}, "T06": {"lat": "35.1", "addr:city": "a"}, "T07": {"lat": "35.1", "addr:city": "b"}, "T08": {"lat": "35.2"}, "T09": {"lat": "35.2"}, "T10": {}, "T11": {"都道府県コード": "14"}}
    rows = [{**good, "lat": str(35.6 + i / 100), "ID": k, **c} for i, (k, c) in enumerate(change.items())]
    df = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], ", ".join(f"`{c}` string" for c in columns))
    found = V.tag_issues(df, ["name", "website"], PREFECTURES).unionByName(V.cross_city_issues(df))
    assert kinds(found) == {("T02", "name_missing"), ("T03", "addr_hierarchy"), ("T04", "addr_note_chiban"), ("T05", "addr_province_mismatch"), ("T06", "coord_cross_city"), ("T07", "coord_cross_city"), ("T11", "addr_province_mismatch")}
    assert {k for _, k in kinds(V.fatal(found))} == {"name_missing", "addr_hierarchy", "addr_province_mismatch"}
    assert ("-", "missing_column") in kinds(V.tag_issues(df.drop("未解釈の文字列"), [], PREFECTURES))
    assert V.tag_issues(df.limit(0), ["name"], PREFECTURES).count() == 0


def test_known_bad_hours(spark):
    rows = [("T01", "Mo,Tu,We,Th,Fr 09:00-17:00; PH off; Dec 29-Jan 03 off"), ("T02", 'Mo,Tu 09:00-17:00; "GWは休診"'), ("T03", "Mo 09:00-12:00,PH 08:30-08:30"), ("T04", "Mo-Fr 9:00~17:00 xyz"), ("T05", "Sa 09:00-12:00; Sa[2,3,4,5] off; PH off"), ("T06", 'Mo 09:00-12:00; PH off || off "GWは休診"'), ("T07", "Mo,Tu,We,Th,Fr 09:00-12:30,18:00-08:30; PH off"), ("T08", "Mo 09:00-12:00; " + ",".join(f"Jan {d:02d}" for d in range(1, 32)) + "," + ",".join(f"Mar {d:02d}" for d in range(1, 20)) + " off")]
    found = kinds(V.hours_issues(spark.createDataFrame(rows, "id string, opening_hours string"), "id"))
    assert {k for k in found if k[0] != "T03"} == {("T02", "never_open"), ("T04", "error"), ("T07", "warning"), ("T08", "too_long")}
    assert ("T03", "zero_span") in found


def test_texts(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(X.fold_romaji(F.lit("Oouchi"))) == "ochi" == one(X.fold_romaji(F.lit("ōouchi")))
    assert one(X.titlecase_latin(F.lit("KOJIMA  2nd o'NEIL (ABC)"))) == "Kojima 2nd O'neil (ABC)"
    urls = {"病院.日本": "https://病院.日本", "a_b.jp/x": "https://a_b.jp/x", "http//a.jp": "http://a.jp", "https://www.bing.com/ck/a?x": "", "https://www.bing.com/": "https://www.bing.com/", "http://a.jp/x\ty": ""}
    assert {u: one(X.clean_url(F.lit(u)))["url"] for u in urls} == urls
    assert one(X.url_note(F.lit("a.jp"), F.lit("scheme_added"))) == "website に https を補った: a.jp"


def test_assembly_guards(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "ID int, v string")
    assert A.assemble(a, {"p": a}).orderBy("ID").first()["p"]["v"] == "x"
    for wrong, says in (
        (lambda: A.assemble(a, {"p": a.union(a)}), "p: repeated ID"),
        (lambda: A.assemble(a.union(a), {"p": a}), "repeated ID"),
        (lambda: A.matched_by_id(a, a.filter("ID = 1").withColumnRenamed("v", "w"), "ID"), "not in the second table: 2"),
        (lambda: A.matched_by_id(a.filter("ID = 1"), a.withColumnRenamed("v", "w"), "ID"), "not in the first table: 2"),
        (lambda: A.with_required(a, a.filter("ID = 1").withColumnRenamed("v", "w"), "ID"), "missing: 2"),
    ):
        with pytest.raises(Exception, match=says):
            wrong().collect()
    w = a.withColumnRenamed("v", "w")
    assert {tuple(r) for r in A.matched_by_id(a, w, "ID").collect()} == {(1, "x", "x"), (2, "y", "y")}
    assert A.with_required(a.filter("ID = 1"), w, "ID").columns == ["ID", "v", "w"] and A.with_required(a.filter("ID = 1"), w, "ID").count() == 1
    assert A.assemble(a, {"p": a.filter("ID = 1")}).filter("p IS NULL").count() == 1
    assert A.with_coordinates(spark.createDataFrame([(1.0, None), (1.0, 2.0)], "lat double, lon double"), "lat", "lon").count() == 1


def test_suspects_by_level(spark):
    rows = [("a", "8", 101.0, A.SOURCE), ("b", "8", 100.0, A.SOURCE), ("c", "3", 1999.0, A.SOURCE), ("d", "2", 10001.0, A.SOURCE), ("e", "8", 500.0, "x"), ("f", "1", 1e9, A.SOURCE), ("g", "8", None, A.SOURCE), ("h", None, 1e9, A.SOURCE)]
    df = spark.createDataFrame(rows, "id string, level string, m double, origin string")
    assert [r["id"] for r in A.address_suspects(df, "m", "level", "origin").collect()] == ["d", "a"]
    A.stop_over(df, "m", "level", "origin", 101.0)
    with pytest.raises(ValueError, match="over 100.5 m: 1"):
        A.stop_over(df, "m", "level", "origin", 100.5)


def written(spark, tmp_path, rows, features, parts=None):
    from clinicweave.sources import geojson

    at = str(tmp_path / "x")
    columns = ["ID", "都道府県コード", "lat", "lon", "name", "amenity", "addr:city", "未解釈の文字列"]
    df = spark.createDataFrame([tuple(r.get(c, "") for c in columns) for r in rows], ", ".join(f"`{c}` string" for c in columns))
    files.write_csv(df.coalesce(1), f"{at}.csv")
    fs = spark.createDataFrame([(f,) for f in features], "feature string").coalesce(1)
    geojson.write_collection(fs, f"{at}.geojson")
    if parts is not None:
        spark.createDataFrame(parts, "`ID` string, `都道府県コード` string").write.mode("overwrite").partitionBy("都道府県コード").option("header", True).csv(f"{at}/csv")
    return {(r["kind"], r["id"]) for r in V.written_issues(spark, at, PREFECTURES, tags=["name"], parts=f"{at}/csv" if parts is not None else None).collect()}


def test_files_as_they_were_written(spark, tmp_path):
    row = lambda i, **c: {"ID": str(i), "都道府県コード": "13", "lat": f"35.{i}", "lon": "139.5", "name": "桜", "amenity": "clinic", "addr:city": "港区"} | c
    feature = lambda i, x="139.5", y="35.1": f'{{"type":"Feature","geometry":{{"type":"Point","coordinates":[{x},{y}]}},"properties":{{"_id":"{i}"}}}}'
    rows = [row(i) for i in range(1, 6)]
    (a, b, c, d, e) = (tmp_path / n for n in "abcde")
    for p in (a, b, c, d, e):
        p.mkdir()
    assert written(spark, a, rows, [feature(i) for i in range(1, 6)], [(str(i), "13") for i in range(1, 6)]) == set()
    assert written(spark, b, rows, [feature(i) for i in (1, 2, 4, 3, 5)], [(str(i), "14") for i in range(1, 5)]) == {("id_mismatch", "3"), ("pref_split_row_mismatch", "-"), ("pref_split_missing", "-"), ("pref_split_extra", "-")}
    assert written(spark, c, [*rows[:4], row(5, name="")], [feature(1, "35.1", "139.5"), feature(2, "1", "2"), feature(3)]) == {("coord_order", "1"), ("coord_range", "2"), ("count_mismatch", "-"), ("name_missing", "5")}
    line = '{"type":"Feature","geometry":{"type":"LineString","coordinates":[[1,2],[3,4]]},"properties":{"_id":"5"}}'
    assert written(spark, d, rows, [*[feature(i) for i in range(1, 4)], '{"type":"Feature","geometry":{"type":"Point","coordinates":[1.0]},"properties":{}}', line]) >= {("geojson_structure", "#3"), ("geojson_structure", "5")}
    written(spark, e, rows, [feature(i) for i in range(1, 6)])
    text = (e / "x.geojson").read_text().replace("FeatureCollection", "Features")
    (e / "x.geojson").write_text(text)
    (e / ".x.geojson.crc").unlink(missing_ok=True)
    assert {(r["kind"], r["id"]) for r in V.written_issues(spark, str(e / "x"), PREFECTURES, tags=[]).collect()} == {("geojson_structure", "-")}


def test_rows_keep_their_place_in_the_file(spark, tmp_path):
    (tmp_path / "n.txt").write_text("\n".join(map(str, range(5000))))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = spark.read.text(str(tmp_path / "n.txt"))
        assert read.rdd.getNumPartitions() > 4
        assert files.with_rows(read).filter("_row <> CAST(value AS BIGINT)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_mapping_tables(spark, tmp_path):
    (tmp_path / "m.csv").write_text("\ufeffkind,word\na,bb\nb,c\na,dddd\n", encoding="utf-8")
    assert [r["word"] for r in files.read_mapping(spark, str(tmp_path / "m.csv"), kind="kind", kinds=("a",), longest="word").collect()] == ["dddd", "bb"]
    (tmp_path / "b.csv").write_text("name,lat_min,lat_max,lon_min,lon_max\nx,1,2,3,4\n", encoding="utf-8")
    assert files.read_boxes(spark, str(tmp_path / "b.csv")).first()["lat_max"] == 2.0
    (tmp_path / "c.csv").write_text("name,lat_min,lat_max,lon_min,lon_max\nx,3,2,3,4\ny,a,2,3,4\n", encoding="utf-8")
    with pytest.raises(ValueError):
        files.read_boxes(spark, str(tmp_path / "c.csv"))
    df = spark.createDataFrame([("13", "yes"), ("13", ""), ("14", None)], "pref string, review string")
    df.write.partitionBy("pref").csv(str(tmp_path / "out"))
    got = {r["pref"]: (r["rows"], r["to_review"], r["bytes"] > 0) for r in files.file_index(df, "pref", "review", str(tmp_path / "out")).collect()}
    assert got == {"13": (2, 1, True), "14": (1, 0, False)}
