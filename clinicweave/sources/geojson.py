"""GeoJSON features, collections and text sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE = "struct<type:string,geometry:struct<type:string,coordinates:array<double>>,properties:map<string,string>>"
#: The same with coordinates of any shape as their text.
ANY_GEOMETRY = FEATURE.replace("array<double>", "string")
RECORD_SEPARATOR = "\x1e"


def _quoted(text: Column) -> Column:
    """A JSON string."""
    out = F.regexp_replace(text, r'(["\\])', r"\\$1")
    for raw, to in (("\n", "\\\\n"), ("\r", "\\\\r"), ("\t", "\\\\t")):
        out = F.regexp_replace(out, raw, to)
    return F.concat(F.lit('"'), out, F.lit('"'))


def feature_text(lat: Column, lon: Column, properties: dict[str, Column]) -> Column:
    """A Point feature as text: coordinates verbatim, longitude first; empty properties are left out."""
    pairs = [F.when(F.coalesce(v, F.lit("")) != "", F.concat(_quoted(F.lit(k)), F.lit(":"), _quoted(v))) for k, v in properties.items()]
    body = F.array_join(F.array_compact(F.array(*pairs)), ",")
    return F.concat(F.lit('{"type":"Feature","geometry":{"type":"Point","coordinates":['), lon, F.lit(","), lat, F.lit(']},"properties":{'), body, F.lit("}}"))


#: Ends a piece of a collection: the value of each feature's first key.
_CUT = '"Feature"'


def read_features(spark: SparkSession, path: str, whole: bool = False, schema: str = FEATURE) -> DataFrame:
    """(type, geometry, properties) of FeatureCollection files, a large file in many tasks.

    A file is read in pieces that end at the value of a feature's ``type``. Inside of a string that value cannot stand,
    because its quotes would be escaped there, so that a piece is one feature without its beginning, with the beginning
    of the next one behind it, which a parser of the first value ignores. This holds where ``type`` is the first key of
    every feature and no property has the value "Feature"; pieces of any other layout are an error, never a wrong row,
    and such files are read with ``whole``, a file in one task.
    """
    if whole:
        parsed = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<features:array<{schema}>>", {"mode": "FAILFAST"}).alias("c"))
        return parsed.select(F.inline("c.features"))
    v = F.col("value")
    head = v.rlike(r"^[\uFEFF\s]*\{")
    begun = r"\{\s*\"type\"\s*:\s*$"
    sound = F.when(head, v.rlike(rf"\[\s*{begun}") | v.rlike(r"\[\s*\]\s*[,}][^\[]*$")).otherwise(v.rlike(rf"\}}\s*,\s*{begun}") | v.rlike(r"\}\s*$"))
    checked = F.when(sound, F.concat(F.lit('{"type":"Feature"'), v)).otherwise(F.raise_error(F.lit("features of another layout than type first: read them whole")))
    pieces = spark.read.text(path, lineSep=_CUT).filter(v.rlike(r"\S")).select(F.when(head & sound, F.lit(None)).otherwise(checked).alias("v"))
    return pieces.filter("v IS NOT NULL").select(F.from_json("v", schema, {"mode": "FAILFAST"}).alias("f")).select("f.*")


def read_sequence(spark: SparkSession, path: str, separator: str = RECORD_SEPARATOR) -> DataFrame:
    """(type, geometry, properties) of text sequences of features or of collections, a large file in many tasks.

    Records begin with a record separator and may hold line ends; files without separators have one record a line
    (``separator="\\n"``). A record that is no JSON is an error.
    """
    records = spark.read.text(path, lineSep=separator).filter(F.col("value").rlike(r"\S")).select(F.translate("value", RECORD_SEPARATOR, "").alias("v"))
    either = FEATURE[:-1] + f",features:array<{FEATURE}>>"
    f = F.from_json("v", either, {"mode": "FAILFAST"})
    parsed = records.select(f.alias("f"))
    own = F.array(F.struct("f.type", "f.geometry", "f.properties"))
    return parsed.select(F.inline(F.when(F.col("f.features").isNotNull(), F.col("f.features")).otherwise(own)))


def write_sequence(features: DataFrame, path: str, column: str = "feature") -> None:
    """Feature texts as a folder of text sequences: written in parallel, read back in parallel by ``read_sequence``."""
    features.select(F.concat(F.lit(RECORD_SEPARATOR), F.col(column)).alias("value")).write.mode("overwrite").text(path)


def write_collection(features: DataFrame, path: str, column: str = "feature") -> None:
    """Feature texts as a FeatureCollection: lines are written in parallel, the last step joins the parts."""
    from clinicweave.sources.files import concatenate

    parts = f"{path}.parts"
    features.select(F.concat(F.col(column), F.lit(",")).alias("value")).write.mode("overwrite").text(parts)
    concatenate(features.sparkSession, parts, path, '{"type":"FeatureCollection","features":[\n', "]}\n", trim_last=",\n")


def write_tasks(features: DataFrame, path: str, by: str | None = None, column: str = "feature") -> None:
    """One FeatureCollection a line after a record separator, in one folder or one a value of ``by``."""
    text = F.concat(F.lit(RECORD_SEPARATOR + '{"type":"FeatureCollection","features":['), F.col(column), F.lit("]}"))
    out = features.select(*([by] if by else []), text.alias("value"))
    (out.repartition(by).write.partitionBy(by) if by else out.write).mode("overwrite").text(path)
