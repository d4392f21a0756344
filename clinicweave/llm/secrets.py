"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.llm.common import join_bounded, let, materialize

# The patterns of the base kinds.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"

#: Long unbroken tokens that hold a digit: candidates for owner-specific credentials without a keyword.
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"

KINDS = ("assign", "access", "hex", "token")
SPAN = "array<struct<start:int,end:int,kind:int,value:string>>"

#: A value in documents of more owners, or in more documents, counts as a widely copied example.
MAX_OWNERS, MAX_REPOSITORIES = 1, 5
#: Words of placeholders.
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|1234567|abcdef"

#: The occurrences of a value are dealt to a task for each so many of them.
ROWS_OF_A_KEY = 50_000


def _spans(text: Column, pattern: str, kind: int, keep, value_group: int = 0) -> Column:
    """Spans of leftmost non-overlapping matches, in code points: lengths of the pieces between matches, summed."""

    def of(pieces: Column, matches: Column, values: Column) -> Column:
        empty = F.array().cast(SPAN)
        step = F.aggregate(
            F.sequence(F.lit(0), F.size(matches) - 1),
            F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda acc, i: let(
                acc["at"] + F.length(pieces[i]),
                lambda start: F.struct(
                    (start + F.length(matches[i])).alias("at"),
                    F.concat(acc["out"], F.array(F.struct(start.alias("start"), (start + F.length(matches[i])).alias("end"), F.lit(kind).alias("kind"), values[i].alias("value"))).cast(SPAN)).alias("out"),
                ),
            ),
            lambda acc: acc["out"],
        )
        return F.filter(step, keep)

    found = let(
        F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("v")),
        lambda s: of(s["p"], s["m"], s["v"]),
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds of a text without nulls."""
    return F.concat(
        _spans(text, ASSIGN, 0, lambda s: F.length(s["value"]) >= 8, 2),
        _spans(text, ACCESS, 1, lambda s: F.length(s["value"]) >= 16),
        _spans(text, HEX, 2, lambda s: F.length(s["value"]) >= 32),
    )


def looks_live(value: Column) -> Column:
    """Mixed letters and digits, at least 10 different characters, no placeholder word."""
    return value.rlike("[A-Za-z]") & value.rlike("[0-9]") & ~value.rlike(PLACEHOLDER) & (F.size(F.array_distinct(F.split(value, ""))) >= 10)


def _joined(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", repository_col: str = "doc_id", owner_col: str = "source", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Per document: base spans, spans the ownership frequency adds, and how many values it holds live or copied.

    Every value of a base span, and every long token with a digit that no base span overlaps, is a candidate. Over
    the corpus, candidates are grouped by a hash of the value, with the distinct repositories and owners that hold
    it. A live-looking value within ``max_owners`` owners and ``max_repositories`` repositories is owner-specific:
    its tokens become spans of kind ``token``, and its base spans count in ``n_live``. A value beyond the bounds
    counts in ``n_copied``. Base spans stay whatever their frequency. Null texts are empty, null owners and
    repositories are one value each; texts of any length are scanned whole; every input row is a row of the result,
    repeated rows and equal ids included; extra columns are ignored, whatever their names; an empty table gives an
    empty result. Of overlapping matches of one kind the leftmost counts.

    The text is read once; what follows works on a written table of spans. Distinct owners are reduced per value
    before the shuffle, and the verdicts of frequent values are joined salted, a salt for each ``ROWS_OF_A_KEY`` of their
    occurrences, so that a value in a third of all rows is no hot key.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(repository_col).cast("string").alias("_repo"), F.col(owner_col).cast("string").alias("_owner"), text.alias("_t"))
    scanned = rows.select("doc_id", "_repo", "_owner", F.monotonically_increasing_id().alias("_row"), base_spans(F.col("_t")).alias("base"), _spans(F.col("_t"), TOKEN, 3, lambda s: s["value"].rlike("[A-Za-z]")).alias("_more"))
    more = F.filter("_more", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])))
    table = materialize(scanned.select("doc_id", "_repo", "_owner", "_row", "base", more.alias("more")), "secret-spans")

    candidates = table.filter((F.size("base") > 0) | (F.size("more") > 0)).select("_row", "_repo", "_owner", F.explode(F.concat("base", "more")).alias("s"))
    key = F.sha2(F.col("s.value"), 256)
    hashed = candidates.select("_row", "_repo", "_owner", "s", key.alias("key"))
    by_owner = hashed.groupBy("key", "_owner", "_repo").agg(F.first("s.value").alias("value"), F.count(F.lit(1)).alias("n"))
    by_owner = by_owner.groupBy("key", "_owner").agg(F.count(F.lit(1)).alias("r"), F.sum("n").alias("n"), F.first("value").alias("value"))
    by_value = by_owner.groupBy("key").agg(F.count(F.lit(1)).alias("owners"), F.sum("r").alias("repositories"), F.sum("n").alias("n"), F.first("value").alias("value"))
    rare = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    salts = F.ceil(F.col("n") / ROWS_OF_A_KEY).cast("int").alias("_salts")
    verdicts = materialize(by_value.select("key", (rare & looks_live(F.col("value"))).alias("live"), (~rare).alias("copied"), salts), "secret-values")
    heavy = materialize(verdicts.filter("_salts > 1").select("key", "_salts"), "frequent-secrets")
    dealt = join_bounded(hashed, heavy, "key", "left", 96).withColumn("_salt", F.pmod(F.col("_row"), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    verdicts = verdicts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    judged = dealt.join(verdicts, ["key", "_salt"])
    per_row = judged.groupBy("_row").agg(
        F.collect_list(F.when((F.col("s.kind") == 3) & F.col("live"), F.col("s"))).alias("added"),
        F.count_if((F.col("s.kind") != 3) & F.col("live")).alias("n_live"),
        F.count_if((F.col("s.kind") != 3) & F.col("copied")).alias("n_copied"),
    )
    out = table.select("doc_id", "_row", "base").join(per_row, "_row", "left")
    added = F.coalesce("added", F.array().cast(SPAN))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", added)).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )
