"""The document of a mapping table, and hours cut to the length of a tag."""

import pytest
from pyspark.sql import functions as F

from clinicweave.functions import hours
from clinicweave.operators import document


def test_document(spark, tmp_path):
    mapping = spark.createDataFrame(
        [(None, "01001", "内科", "internal", "exact", ""), ("", "01002", "胃腸内科", "gastro;internal", "broader", "要検討|a"), ("", "09009", "他", "", "none", None), ("dental", "01001", "歯内", "dental", "exact", "x"), ("", "01003", "心内科", "internal", "broader", "要検討")],
        "sector string, code string, name string, value string, grade string, note string",
    )
    counts = spark.createDataFrame([("hospital", "01001", 1234), ("hospital", "01002", 5), ("clinic", "01002", 7), ("clinic", "01003", 99), ("other", "01003", 1000)], "sector string, code string, n long")
    rollup = spark.createDataFrame([("gastro", "internal", None)], "value string, broader string, note string")
    lines = document.document_lines(mapping, counts, rollup, {"hospital": "病院", "clinic": "診療所"}, {"01": "内科系"})
    got = [(r["section"], r["line"]) for r in lines.orderBy("section", "n", "key").collect()]
    assert got == [
        (0, "| `broader` | 2 |"), (0, "| `exact` | 1 |"), (0, "| `none` | 1 |"),
        (1, "| `internal` | 内科 | 胃腸内科、心内科 |"), (1, "| `gastro` |  | 胃腸内科 |"),
        (2, "### 01 内科系"), (2, "| `01001` | 内科 | `internal` | exact | 1,234 |  |  |"), (2, "| `01002` | 胃腸内科 | `gastro;internal` | broader | 5 | 7 | 要検討\\|a |"), (2, "| `01003` | 心内科 | `internal` | broader |  | 99 | 要検討 |"),
        (3, "| dental | `01001` | 歯内 | `dental` | exact | x |"), (4, "| `gastro` | `internal` |  |"),
        (5, "| 心内科 | `internal` | 99 | 要検討 |"), (5, "| 胃腸内科 | `gastro;internal` | 12 | 要検討|a |"),
    ]
    document.write_document(lines, str(tmp_path / "doc.md"), {"grades": "# Grades", "review": "# Review"})
    text = (tmp_path / "doc.md").read_text(encoding="utf-8").split("\n")
    assert [x for x in text if x] == ["# Grades", *[x for s, x in got if s == 0], "# Review", *[x for s, x in got if s == 5]]


@pytest.mark.parametrize(
    "value,most,want",
    [
        (" Mo 09:00-10:00; PH off ", 40, ("Mo 09:00-10:00; PH off", "")),
        ("Mo 09:00-10:00; PH off; Jan 01 off", 30, ("Mo 09:00-10:00; PH off", "30文字を超えたため末尾の規則1件を落とした: Jan 01 off")),
        ("Mo 09:00-10:00; PH off; Jan 01 off", 20, ("Mo 09:00-10:00", "20文字を超えたため末尾の規則2件を落とした: PH off; Jan 01 off")),
        ("Mo 09:00-10:00; PH off", 5, ("", "5文字を超え、残せる規則が無いため出力しない")),
        ("Mo off; " + "x" * 90, 10, ("Mo off", "10文字を超えたため末尾の規則1件を落とした: " + "x" * 80)),
        ("", 5, ("", "")),
        (None, 5, ("", "")),
    ],
)
def test_hours_that_fit(spark, value, most, want):
    assert tuple(spark.range(1).select(hours.fit_hours(F.lit(value).cast("string"), most).alias("x")).first()["x"]) == want
