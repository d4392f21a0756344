"""Registers of towns and writers of files on small folders."""

import json

import pytest
from pyspark.sql import functions as F

from clinicweave.sources import files, geojson, registers


def test_towns_and_numbers(spark, tmp_path):
    folder = tmp_path / "ja" / "高知県"
    folder.mkdir(parents=True)
    towns = [{"oaza_cho": "大膳町"}, {"oaza_cho": "本町", "chome": "一丁目"}, {"oaza_cho": "別", "koaza": ""}, {"chome": "別"}, {"koaza": None}, {"oaza_cho": "本町", "chome": "一丁目", "x": 1}]
    (folder / "高知市.json").write_text(json.dumps({"meta": 1, "data": towns}, ensure_ascii=False), encoding="utf-8")
    got = {tuple(r) for r in registers.read_towns(spark, str(tmp_path / "ja")).collect()}
    assert got == {("高知県", "高知市", "大膳町", "大膳町", 0), ("高知県", "高知市", "本町", "本町一丁目", 1), ("高知県", "高知市", "別", "別", 2)}

    (folder / "高知市-地番.txt").write_text("大膳町,40,60\n本町,100,9\n地番,大膳町\nprc_num1,prc_num2,prc_num3,lng\n37,,,1\n37,2,,1\n37,2,,1\n,5,,1\n地番,本町\nprc_num1,prc_num2,prc_num3\n1,2,3\n", encoding="utf-8")
    (folder / "高知市-住居表示.txt").write_text("住居表示,大膳町\r\nblk_num,rsdt_num,rsdt_num2\r\n1,,2\r\n", encoding="utf-8")
    (folder / "other.txt").write_text("地番,a\nb\n1\n", encoding="utf-8")
    got = {tuple(r)[2:] for r in registers.read_numbers(spark, str(tmp_path / "ja")).collect()}
    assert got == {("地番", "大膳町", "37"), ("地番", "大膳町", "37-2"), ("地番", "本町", "1-2-3"), ("住居表示", "大膳町", "1-2")}


def test_pairs_samples_and_corrected_tables(spark, tmp_path):
    df = spark.createDataFrame([("2", "36.0", "140.0"), ("1", "35.0", "139.0")], "ID string, lat string, lon string")
    rows = df.withColumn("feature", geojson.feature_text(F.col("lat"), F.col("lon"), {"_id": F.col("ID")}))
    base = str(tmp_path / "out" / "39_x")
    registers.write_pair(rows, base, ["ID", "lat"], order=["ID"])
    assert [tuple(r) for r in files.read_csv(spark, f"{base}.csv").collect()] == [("1", "35.0"), ("2", "36.0")]
    assert [r["properties"]["_id"] for r in geojson.read_features(spark, f"{base}.geojson").collect()] == ["1", "2"]
    with pytest.raises(ValueError):
        registers.write_pair(rows.withColumn("feature", F.when(F.col("ID") == "1", F.col("feature"))), str(tmp_path / "no"), ["ID"])
    assert not (tmp_path / "no.csv").exists()

    sample = tmp_path / "samples"
    sample.mkdir()
    (sample / "old.csv").write_text("x", encoding="utf-8")
    with pytest.raises(FileNotFoundError):
        registers.copy_sample(spark, [f"{base}.csv", f"{base}.none"], str(sample))
    assert (sample / "old.csv").exists()
    registers.copy_sample(spark, [f"{base}.csv", f"{base}.geojson"], str(sample))
    assert {p.name for p in sample.iterdir() if not p.name.startswith(".")} == {"39_x.csv", "39_x.geojson"}
    with pytest.raises(ValueError):
        registers.copy_sample(spark, [f"{base}.csv"], str(tmp_path / "out"))

    with pytest.raises(ValueError):
        registers.write_corrected(df, f"{base}.csv", f"{base}.csv")
    registers.write_corrected(df, f"{base}.csv", f"{base}_new.csv", order=["ID"])
    assert files.read_csv(spark, f"{base}_new.csv").count() == 2
