"""Mirrors of town registers, pairs of CSV and GeoJSON files, and samples of an output folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicweave.operators.tables import assert_none
from clinicweave.sources.files import _fs, exists, write_csv
from clinicweave.sources.geojson import write_collection

# The kinds of lists of numbers, which also begin the first line of a town's part of a file.
RESIDENCE, LOTS = "住居表示", "地番"


def _path_part(pattern: str, group: int) -> Column:
    return F.regexp_extract(F.url_decode(F.input_file_name()), pattern, group)


def read_towns(spark: SparkSession, base: str) -> DataFrame:
    """(pref, city, oaza, name, at) of a mirror with one file a city, ``<pref>/<city>.json``, whose ``data`` lists towns.

    A name joins oaza_cho, chome and koaza; towns without one are left out, and of equal names of a city the first of
    the file counts, at its place ``at``. A city's file is one row of some thousand towns at most.
    """
    town = "struct<oaza_cho:string,chome:string,koaza:string>"
    files = spark.read.schema(f"data array<{town}>").json(f"{base}/*/*.json", multiLine=True)
    place = r"([^/]+)/([^/]+)\.json$"
    towns = files.select(_path_part(place, 1).alias("pref"), _path_part(place, 2).alias("city"), F.posexplode("data").alias("at", "t"))
    name = F.concat(*[F.coalesce(F.col(f"t.{c}"), F.lit("")) for c in ("oaza_cho", "chome", "koaza")])
    named = towns.select("pref", "city", "at", F.coalesce("t.oaza_cho", F.lit("")).alias("oaza"), name.alias("name")).filter("name <> ''")
    return named.groupBy("pref", "city", "name").agg(F.min_by("oaza", "at").alias("oaza"), F.min("at").alias("at")).select("pref", "city", "oaza", "name", "at")


def read_numbers(spark: SparkSession, base: str) -> DataFrame:
    """(pref, city, kind, town, number), each once, of files ``<pref>/<city>-<kind>.txt``.

    A file holds a part for each town: a line ``<kind>,<town>``, a line of column names, then rows whose first three
    columns are the parts of a number; empty ones are left out, the others joined by ``-``. What stands before the
    first part is an index of offsets and is not needed: the reader cuts files wherever a part begins, so that a large
    file is many tasks and a task holds one part at once. A part is known by its line of column names.
    """
    both = [_numbers_of(spark, base, kind) for kind in (RESIDENCE, LOTS)]
    return both[0].unionByName(both[1]).distinct()


def _numbers_of(spark: SparkSession, base: str, kind: str) -> DataFrame:
    place = rf"([^/]+)/([^/]+)-{kind}\.txt$"
    parts = spark.read.text(f"{base}/*/*.txt", pathGlobFilter=f"*-{kind}.txt", lineSep=f"\n{kind},")
    lines = F.split(F.regexp_replace("value", f"^\ufeff?{kind},", ""), r"\r?\n")
    named = parts.select(_path_part(place, 1).alias("pref"), _path_part(place, 2).alias("city"), F.lit(kind).alias("kind"), lines.alias("l")).filter((F.size("l") > 1) & F.get("l", F.lit(1)).rlike("^[A-Za-z_]"))
    rows = named.select("pref", "city", "kind", F.trim(F.get("l", F.lit(0))).alias("town"), F.explode(F.slice("l", 3, 2**31 - 1)).alias("row"))
    cells = rows.withColumn("c", F.split("row", ",")).filter(F.col("c")[0] != "")
    return cells.select("pref", "city", "kind", "town", F.array_join(F.filter(F.slice("c", 1, 3), lambda x: x != ""), "-").alias("number"))


def write_pair(df: DataFrame, base: str, columns: list[str], feature: str = "feature", order: list[str] = ()) -> None:
    """``<base>.csv`` with the columns and ``<base>.geojson`` with the feature texts of the same rows.

    A row without a feature stops before anything is written, so that both files have the same rows.
    """
    assert_none(df.filter(F.col(feature).isNull()).select(*columns[:1]), "rows without a feature")
    write_csv(df, f"{base}.csv", columns, order)
    write_collection(df.orderBy(*order) if order else df, f"{base}.geojson", feature)


def copy_sample(spark: SparkSession, sources: list[str], folder: str) -> None:
    """Copy finished files, some dozens of one prefecture, to a folder made anew; if one is missing nothing is touched."""
    missing = [s for s in sources if not exists(spark, s)]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    fs, target = _fs(spark, folder)
    if any(_fs(spark, s)[1].getParent().equals(target) for s in sources):
        raise ValueError(f"a sample cannot replace the folder of its own sources: {folder}")
    fs.delete(target, True)
    fs.mkdirs(target)
    for s in sources:
        source_fs, source = _fs(spark, s)
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(source_fs, source, fs, target, False, spark._jsc.hadoopConfiguration())


def write_corrected(df: DataFrame, source: str, path: str, columns: list[str] | None = None, order: list[str] = ()) -> None:
    """A corrected table to a path of its own: the file that it was read from stays as it is."""
    spark = df.sparkSession
    fs, read = _fs(spark, source)
    if fs.makeQualified(read).equals(fs.makeQualified(_fs(spark, path)[1])):
        raise ValueError(f"the corrected table needs another path than {source}")
    write_csv(df, path, columns, order)
