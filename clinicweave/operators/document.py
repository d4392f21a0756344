"""A document of a mapping table: its tables as lines of Markdown, made from aggregates of the mapping and of counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.sources.files import concatenate

#: The order of the sections, with the heads of their tables.
SECTIONS = ("grades", "values", "codes", "overrides", "rollups", "review")
#: What marks a note as a question that is open, and the grade of values that only come near.
OPEN, NEAR = "要検討", "broader"


def _row(*cells: Column | str) -> Column:
    return F.concat(F.lit("| "), *[x for i, c in enumerate(cells) for x in ([F.lit(" | ")] if i else []) + [F.coalesce(c, F.lit("")) if isinstance(c, Column) else F.lit(c)]], F.lit(" |"))


def _code(text: Column) -> Column:
    return F.concat(F.lit("`"), F.coalesce(text, F.lit("")), F.lit("`"))


def _number(n: Column) -> Column:
    return F.when(n > 0, F.format_number(n, 0)).otherwise("")


def _note(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("|"), F.lit("\\|"))


def _section(name: str, df: DataFrame, n: Column, key: Column, line: Column) -> DataFrame:
    return df.select(F.lit(SECTIONS.index(name)).alias("section"), n.cast("long").alias("n"), key.alias("key"), line.alias("line"))


def document_lines(mapping: DataFrame, counts: DataFrame, rollup: DataFrame, sectors: dict[str, str], families: dict[str, str]) -> DataFrame:
    """(section, n, key, line): the rows of all tables, in order of the first three.

    ``mapping``: sector (empty for the default), code, name, value (``;`` between several), grade, note; ``counts``:
    sector, code, n; ``rollup``: value, broader, note. Sections: how many default codes each grade has; which codes lead to
    a value, and which only come near it, values with many codes first; the codes of each family with the facilities of
    each sector; rows that override the default in a sector; what long lists fold to; and open questions by the
    facilities that they concern, the largest first. Lists hold the codes of one value, some dozen.
    """
    blank = F.coalesce(F.col("sector"), F.lit("")) == ""
    default, own = mapping.filter(blank), mapping.filter(~blank)
    code, name, value, grade, note = (F.col(c) for c in ("code", "name", "value", "grade", "note"))
    label = F.create_map(*[F.lit(x) for pair in sectors.items() for x in pair])
    family = F.create_map(*[F.lit(x) for pair in families.items() for x in pair])
    zero = F.lit(0)

    grades = default.groupBy("grade").agg(F.count(F.lit(1)).alias("k"))
    items = default.select("code", "name", "grade", F.explode(F.split("value", ";")).alias("value")).filter("value <> ''")
    names = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("code", "name")))), lambda x: x["name"]), "、")
    by_value = items.groupBy("value").agg(F.count(F.lit(1)).alias("k"), names(grade != NEAR).alias("exact"), names(grade == NEAR).alias("near"))
    by_sector = counts.groupBy("code").pivot("sector", list(sectors)).agg(F.sum("n"))
    known = default.join(by_sector, "code", "left")
    total = sum((F.coalesce(F.col(f"`{s}`"), zero) for s in sectors), zero)
    place = F.substring("code", 1, 2)
    heads = default.select(place.alias("f")).distinct().filter(family[F.col("f")].isNotNull())
    review = known.filter((grade == NEAR) & F.coalesce(note, F.lit("")).contains(OPEN)).withColumn("k", total)
    parts = [
        _section("grades", grades, zero, grade, _row(_code(grade), F.col("k").cast("string"))),
        _section("values", by_value, -F.col("k"), value, _row(_code(value), F.col("exact"), F.col("near"))),
        _section("codes", heads, zero, F.col("f"), F.concat(F.lit("### "), F.col("f"), F.lit(" "), family[F.col("f")])),
        _section("codes", known.filter(family[place].isNotNull()), zero, F.concat(place, F.lit(" "), code), _row(_code(code), name, _code(value), grade, *[_number(F.col(f"`{s}`")) for s in sectors], _note(note))),
        _section("overrides", own, zero, F.concat(F.col("sector"), F.lit(" "), code), _row(F.coalesce(label[F.col("sector")], F.col("sector")), _code(code), name, _code(value), grade, _note(note))),
        _section("rollups", rollup, zero, value, _row(_code(value), _code(F.col("broader")), F.coalesce(note, F.lit("")))),
        _section("review", review, -F.col("k"), F.concat_ws(" ", name, value, note), _row(name, _code(value), F.format_number("k", 0), note)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_document(lines: DataFrame, path: str, heads: dict[str, str]) -> None:
    """One Markdown file of some hundred lines: a head and its table a section, sections in order."""
    titles = lines.sparkSession.createDataFrame([(SECTIONS.index(s), t) for s, t in heads.items()], "section int, title string")
    first = titles.select("section", F.lit(None).cast("long").alias("n"), F.lit("").alias("key"), F.concat(F.lit("\n"), "title", F.lit("\n")).alias("line"))
    rows = first.unionByName(lines.join(titles.select("section"), "section"))
    rows.orderBy("section", F.asc_nulls_first("n"), "key").select("line").write.mode("overwrite").text(f"{path}.parts")
    concatenate(lines.sparkSession, f"{path}.parts", path)
