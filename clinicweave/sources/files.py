"""CSV readers and writers, latest files, and single-file outputs through Hadoop's file systems."""

from __future__ import annotations

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinicweave.operators.tables import assert_none

BOM = "\ufeff"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def latest(spark: SparkSession, pattern: str) -> str:
    """The last file of a glob by name."""
    fs, p = _fs(spark, pattern)
    found = sorted(s.getPath().toString() for s in fs.globStatus(p) or [])
    if not found:
        raise FileNotFoundError(pattern)
    return found[-1]


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_csv(spark: SparkSession, path: str, required: list[str] = (), optional: list[str] = ()) -> DataFrame:
    """A CSV file with a header, all strings, quoted line ends and doubled quotes; a byte order mark is dropped.

    Missing required columns stop; missing optional ones are added as null.
    """
    df = spark.read.options(header=True, multiLine=True, escape='"', enforceSchema=False).csv(path)
    df = df.toDF(*[c.removeprefix(BOM) for c in df.columns])
    return ensure_columns(df, required, optional)


def with_rows(df: DataFrame, row: str = "_row") -> DataFrame:
    """A file's rows with their place, 0 for the first: places within a task, and the rows of the tasks before it.

    ``df`` is the read itself, whose tasks follow the file. The driver is not involved: a task's offset is a running sum
    over one row a task.
    """
    placed = df.withColumn("_task", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    tasks = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(tasks.select("_task", before.alias("_before")), "_task").withColumn(row, F.col("_before") + F.col("_at")).drop("_task", "_at", "_before")


def ensure_columns(df: DataFrame, required: list[str] = (), optional: list[str] = ()) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    return df.withColumns({c: F.lit(None).cast("string") for c in optional if c not in df.columns})


def read_keyed(spark: SparkSession, path: str, key: str, columns: list[str]) -> DataFrame:
    """A keyed CSV file with the last row of each key; an absent file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in [key, *columns]]))
    from clinicweave.operators.tables import last_wins

    rows = read_csv(spark, path, [key]).withColumn("_row", F.monotonically_increasing_id())
    return last_wins(rows, [key], "_row").drop("_row")


def _write_text(fs, p, text: str) -> None:
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def concatenate(spark: SparkSession, parts: str, path: str, head: str = "", tail: str = "", trim_last: str = "") -> None:
    """Join the part files of a folder, in order, to one file, and remove the folder.

    A file system that can join files by their blocks (HDFS) does so, and no byte of the parts is read. Elsewhere the
    parts are streamed, a block of 64 KB at a time; that suits files of a prefecture, and large tables stay folders.
    ``trim_last`` is cut off the last part, which takes the stream.
    """
    fs, folder = _fs(spark, parts)
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path
    target = hadoop_path(path)
    names = sorted(s.getPath().toString() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-") and s.getLen() > 0)
    if not (names and not trim_last and _joined_by_blocks(spark, fs, target, folder, names, head, tail)):
        out = fs.create(target, True)
        out.write(bytearray(head.encode()))
        for i, name in enumerate(names):
            p = hadoop_path(name)
            source = fs.open(p)
            last = trim_last if i == len(names) - 1 else ""
            size = fs.getFileStatus(p).getLen() - len(last.encode())
            bounded = jvm.org.apache.commons.io.input.BoundedInputStream(source, size)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(bounded, out, 1 << 16, False)
            source.close()
        out.write(bytearray(("\n" if trim_last and names else "").encode() + tail.encode()))
        out.close()
    fs.delete(folder, True)


def _joined_by_blocks(spark: SparkSession, fs, target, folder, names: list[str], head: str, tail: str) -> bool:
    """Whether the file system has joined head, parts and tail itself."""
    jvm = spark._jvm
    rest = [jvm.org.apache.hadoop.fs.Path(n) for n in names]
    if tail:
        rest.append(jvm.org.apache.hadoop.fs.Path(folder, "tail"))
        _write_text(fs, rest[-1], tail)
    _write_text(fs, target, head)
    array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(rest))
    for i, p in enumerate(rest):
        array[i] = p
    try:
        fs.concat(target, array)
    except UnsupportedOperationException:
        return False
    return True


def csv_line(columns: list[str]) -> Column:
    """A CSV line with quotes only where they are needed; null is empty."""

    def cell(c: str) -> Column:
        v = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        return F.when(v.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)

    return F.concat_ws(",", *[cell(c) for c in columns])


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, order: list[str] = ()) -> None:
    """One CSV file with a byte order mark and a header. Parts are written in parallel, in ``order`` by ranges."""
    columns = columns or df.columns
    rows = df.orderBy(*order) if order else df
    rows.select(csv_line(columns).alias("value")).write.mode("overwrite").text(f"{path}.parts")
    concatenate(df.sparkSession, f"{path}.parts", path, BOM + ",".join(columns) + "\n")


def check_codes(df: DataFrame, by: str, known: list[str]) -> DataFrame:
    """``df``, whose job stops at a row with a code that is not known: the guard is part of the plan and costs no job."""
    code = F.trim(F.coalesce(F.col(by).cast("string"), F.lit("")))
    return df.withColumn(by, F.when(code.isin(*known), code).otherwise(F.raise_error(F.concat(F.lit("unknown prefecture code: "), code))))


def write_by_prefecture(df: DataFrame, path: str, by: str, known: dict[str, str], columns: list[str], feature: str | None = None) -> DataFrame:
    """``<path>/csv`` and ``<path>/geojson``, with one folder ``<by>=<code>`` a value of ``by``; returns (code, name, rows, features).

    ``known``: names of the codes; an unknown or missing code stops the job before the old folders are touched, because
    Spark replaces them only when all rows are written, stale folders included. Rows without a feature stop it as well, so
    that both hold the same rows: what was written is counted again from the files and compared. Parts of a code are as
    many as its rows need: a third of all rows in one prefecture is dealt to several tasks.
    """
    spark = df.sparkSession
    has = F.lit(True) if feature is None else F.col(feature).isNotNull()
    rows = check_codes(df, by, list(known)).withColumn(by, F.when(has, F.col(by)).otherwise(F.raise_error(F.lit("a row without a feature"))))
    dealt = rows.hint("rebalance", by)
    dealt.select(*[F.col(f"`{c}`") for c in columns if c != by], by).write.mode("overwrite").partitionBy(by).options(header=True, escape='"', emptyValue="").csv(f"{path}/csv")
    count = lambda d, n: d.groupBy(by).agg(F.count(F.lit(1)).alias(n))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*(c for c in columns if c != by), by]])
    written = count(spark.read.schema(schema).options(header=True, multiLine=True, escape='"').csv(f"{path}/csv"), "rows")
    if feature is None:
        found = written.withColumn("features", F.col("rows"))
    else:
        dealt.select(F.concat(F.lit("\x1e"), F.col(feature)).alias("value"), by).write.mode("overwrite").partitionBy(by).text(f"{path}/geojson")
        lines = spark.read.schema(f"value string, `{by}` string").text(f"{path}/geojson", lineSep="\x1e").filter(F.col("value") != "")
        found = written.join(count(lines, "features"), by, "full")
    name = F.element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]), F.col(by))
    same = F.when(F.col("rows").eqNullSafe(F.col("features")), F.col("rows")).otherwise(F.raise_error(F.concat(F.lit("rows and features differ in "), F.col(by))))
    return found.select(F.col(by).alias("code"), name.alias("name"), same.alias("rows"), "features")


def read_mapping(spark: SparkSession, path: str, *, kind: str | None = None, kinds: tuple[str, ...] = (), longest: str | None = None) -> DataFrame:
    """A mapping table as text columns: rows of the wanted kinds, longest words first (ties by the word)."""
    table = read_csv(spark, path)
    if kind:
        table = table.filter(F.col(f"`{kind}`").isin(*kinds))
    return table.orderBy(F.length(longest).desc(), longest) if longest else table


def read_boxes(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    """(name, lat_min, lat_max, lon_min, lon_max) of a table of boxes; a bound that is no number, or a box inside out, is an error."""
    bounds = ("lat_min", "lat_max", "lon_min", "lon_max")
    boxes = read_csv(spark, path).select(F.col(f"`{name}`").alias("name"), *[F.col(c).try_cast("double").alias(c) for c in bounds])
    sound = (F.col("lat_min") <= F.col("lat_max")) & (F.col("lon_min") <= F.col("lon_max"))
    assert_none(boxes.filter(~F.coalesce(sound, F.lit(False))), "unsound boxes")
    return boxes


def file_index(df: DataFrame, key: str, review: str, path: str) -> DataFrame:
    """(key, rows, to_review, bytes) of a table written in one folder a key: counts of the rows, sizes of the files."""
    spark = df.sparkSession
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.col(review), F.lit("")) != "").alias("to_review"))
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    folder = F.url_decode(F.regexp_extract("path", rf"/{key}=([^/]*)/", 1))
    return counts.join(sizes.groupBy(folder.alias(key)).agg(F.sum("length").alias("bytes")), key, "left").withColumn("bytes", F.coalesce("bytes", F.lit(0)))
