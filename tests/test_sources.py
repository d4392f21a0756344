"""Readers that cut large files, and writers of folders."""

import json
import random

import pytest
from pyspark.sql import functions as F

from clinicweave.sources import files, geojson, registers


@pytest.fixture
def small_pieces(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set(name, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def features(n, seed=1):
    rng = random.Random(seed)
    odd = ['a "Feature" b', '{"type": "Feature"}', 'x},{"type":"Feature"', "\n\\", "東京🙂", "},\n{", '"', "]}", "", " Feature"]
    return [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [rng.random(), rng.random()]}, "properties": {"_id": str(i), "name": rng.choice(odd) + "x" * rng.randint(0, 300), "z": rng.choice(odd)}} for i in range(n)]


def plain(rows):
    return sorted((f["properties"]["_id"], f["properties"]["name"], f["properties"]["z"], *f["geometry"]["coordinates"]) for f in rows)


def collected(df):
    return sorted((r["properties"]["_id"], r["properties"]["name"], r["properties"]["z"], *r["geometry"]["coordinates"]) for r in df.collect())


@pytest.mark.parametrize("style", [{}, {"separators": (",", ":")}, {"indent": 1}, {"ensure_ascii": False}])
def test_one_collection_is_read_in_many_tasks(spark, tmp_path, small_pieces, style):
    rows = features(200)
    at = tmp_path / "c.geojson"
    at.write_text(json.dumps({"type": "FeatureCollection", "name": "n", "features": rows, "crs": {"a": [1]}}, **style), encoding="utf-8")
    df = geojson.read_features(spark, str(at))
    assert df.rdd.getNumPartitions() > 10
    assert collected(df) == plain(rows) == collected(geojson.read_features(spark, str(at), whole=True))


@pytest.mark.parametrize("change", [lambda f: {"geometry": f["geometry"], "properties": f["properties"], "type": "Feature"}, lambda f: {**f, "properties": {**f["properties"], "kind": "Feature"}}, lambda f: {**f, "properties": {"in": [f]}}])
def test_other_layouts_are_an_error_and_are_read_whole(spark, tmp_path, small_pieces, change):
    at = tmp_path / "c.geojson"
    at.write_text(json.dumps({"type": "FeatureCollection", "features": [change(f) for f in features(20)]}), encoding="utf-8")
    with pytest.raises(Exception, match="read them whole|MALFORMED|Malformed"):
        geojson.read_features(spark, str(at)).collect()
    assert geojson.read_features(spark, str(at), whole=True).count() == 20


def test_empty_and_broken_collections(spark, tmp_path):
    (tmp_path / "e.geojson").write_text('{"type": "FeatureCollection", "features": []}', encoding="utf-8")
    assert geojson.read_features(spark, str(tmp_path / "e.geojson")).count() == 0
    text = json.dumps({"type": "FeatureCollection", "features": features(3)})
    (tmp_path / "b.geojson").write_text(text[: len(text) * 2 // 3], encoding="utf-8")
    with pytest.raises(Exception, match="read them whole|MALFORMED|Malformed"):
        geojson.read_features(spark, str(tmp_path / "b.geojson")).collect()


def test_sequences_round_trip_over_many_tasks(spark, tmp_path, small_pieces):
    rows = features(150)
    df = spark.createDataFrame([(json.dumps(f, indent=2, ensure_ascii=False), "01" if i % 3 else "02") for i, f in enumerate(rows)], "feature string, pref string")
    geojson.write_sequence(df, str(tmp_path / "seq"))
    back = geojson.read_sequence(spark, str(tmp_path / "seq"))
    assert back.rdd.getNumPartitions() > 10 and collected(back) == plain(rows)
    geojson.write_tasks(df, str(tmp_path / "tasks"), "pref")
    assert collected(geojson.read_sequence(spark, str(tmp_path / "tasks" / "pref=*"))) == plain(rows)
    (tmp_path / "lines.txt").write_text("\n".join(["", *(json.dumps(f) for f in rows[:5]), "\x1e" + json.dumps(rows[5])]), encoding="utf-8")
    assert collected(geojson.read_sequence(spark, str(tmp_path / "lines.txt"), "\n")) == plain(rows[:6])


def test_ledgers_are_read_in_many_tasks(spark, tmp_path, small_pieces):
    folder = tmp_path / "ja" / "県"
    folder.mkdir(parents=True)
    rng = random.Random(2)
    want = set()
    for kind in (registers.RESIDENCE, registers.LOTS):
        for city in ("甲市", "乙市"):
            parts = []
            for t in range(60):
                body = []
                for _ in range(rng.randint(0, 30)):
                    cells = [str(rng.randint(1, 99)), rng.choice(["", str(rng.randint(1, 9))]), rng.choice(["", "3"]), "139.1"]
                    body.append(",".join(cells))
                    want.add((city, kind, f"町{t}", "-".join(c for c in cells[:3] if c)))
                parts.append("\r\n".join([f"{kind},町{t}", "prc_num1,prc_num2,prc_num3,lng", *body]) + "\r\n")
            index = "".join(f"町{t},{rng.randint(1, 9999)},{len(p)}\r\n" for t, p in enumerate(parts))
            (folder / f"{city}-{kind}.txt").write_bytes((index + "".join(parts)).encode())
    df = registers.read_numbers(spark, str(tmp_path / "ja"))
    assert {tuple(r)[1:] for r in df.collect()} == want
    pieces = registers._numbers_of(spark, str(tmp_path / "ja"), registers.LOTS)
    assert pieces.rdd.getNumPartitions() > 5
    (tmp_path / "none" / "x").mkdir(parents=True)
    (tmp_path / "none" / "x" / "other.txt").write_text("a")
    assert registers.read_numbers(spark, str(tmp_path / "none")).count() == 0


def test_folders_by_prefecture(spark, tmp_path):
    rows = [(str(i), "13" if i % 3 else "14", f'a "{i}",\nb', json.dumps({"type": "Feature", "properties": {"_id": str(i)}})) for i in range(60)]
    df = spark.createDataFrame(rows, "ID string, pref string, name string, feature string")
    names = {"13": "東京都", "14": "神奈川県", "15": "新潟県"}
    at = str(tmp_path / "osm")
    (tmp_path / "osm" / "csv" / "pref=15").mkdir(parents=True)
    (tmp_path / "osm" / "csv" / "pref=15" / "part-0.csv").write_text("ID,name\n9,stale\n")
    got = {tuple(r) for r in files.write_by_prefecture(df, at, "pref", names, ["ID", "name", "pref"], "feature").collect()}
    assert got == {("13", "東京都", 40, 40), ("14", "神奈川県", 20, 20)}
    assert not (tmp_path / "osm" / "csv" / "pref=15").exists()
    back = spark.read.options(header=True, multiLine=True, escape='"').csv(f"{at}/csv")
    assert {(r["ID"], r["name"]) for r in back.collect()} == {(r[0], r[2]) for r in rows}
    assert {r["properties"]["_id"] for r in geojson.read_sequence(spark, f"{at}/geojson/pref=*").collect()} == {r[0] for r in rows}
    for bad in (F.lit("99"), F.lit(None).cast("string")):
        with pytest.raises(Exception, match="unknown prefecture code"):
            files.write_by_prefecture(df.withColumn("pref", F.when(F.col("ID") == "7", bad).otherwise(F.col("pref"))), at, "pref", names, ["ID", "name"], "feature")
    with pytest.raises(Exception, match="without a feature"):
        files.write_by_prefecture(df.withColumn("feature", F.when(F.col("ID") != "7", F.col("feature"))), at, "pref", names, ["ID", "name"], "feature")
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{at}/csv").count() == 60  # the old files stand
    assert {r["rows"] for r in files.write_by_prefecture(df, at, "pref", names, ["ID"]).collect()} == {40, 20}
