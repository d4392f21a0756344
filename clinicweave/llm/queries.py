"""Queries of this subpackage over the synthetic tables, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinicweave.llm.common import documents


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.tokens import token_output

    out = token_output(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end_id=2)
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.tokens import token_counts

    return token_counts(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), limit=512)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.toxicity import toxicity

    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.substrings import substring_dedup

    return substring_dedup(documents(spark, sf_dir))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.secrets import secret_scan

    return secret_scan(documents(spark, sf_dir))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.lines import line_dedup

    return line_dedup(documents(spark, sf_dir))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.neardup import near_duplicates

    return near_duplicates(documents(spark, sf_dir), shingle_words=2, percent=80)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.mixing import mix_digest

    return mix_digest(documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.quality import quality

    return quality(documents(spark, sf_dir)).drop("rejected_by")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.decontamination import find_leaks

    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: Rules on hosts and paths; the longest that fits decides.
URL_RULES = ("block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/")


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.urls import parse_rules, url_verdicts

    return url_verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet"), parse_rules(URL_RULES))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.audit import filter_audit

    return filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clinicweave.llm.codes import vector_codes

    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("label")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_ids": op1_token_ids,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_substrings": op4_substrings,
    "op5_secrets": op5_secrets,
    "op6_lines": op6_lines,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_mixing": op8_mixing,
    "op9_quality": op9_quality,
    "op10_decontamination": op10_decontamination,
    "op11_url_filters": op11_url_filters,
    "op12_filter_audit": op12_filter_audit,
    "op13_vector_codes": op13_vector_codes,
}

#: Words of a text.
WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP8_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS_SQL}) AS BIGINT) AS size, md5('mix-1:' || doc_id) AS h, CASE WHEN source IS NULL THEN 'true:' ELSE 'false:' || source END AS s FROM documents),
rows_ AS (SELECT *, CAST('0x' || substr(h, 1, 2) AS INTEGER) AS b, CAST('0x' || substr(h, 3, 2) AS INTEGER) AS c FROM d),
sums AS (SELECT source, s, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY ALL),
ranked AS (SELECT *, ([5.0, 2.0, 1.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w, (3 * source_size)::DOUBLE AS cap FROM sums),
levels AS (SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
shares AS (SELECT *, (SELECT arg_min(level, cap / w) FROM levels x WHERE NOT x.cap < x.level * x.w) AS share FROM levels),
targets AS (SELECT s, source_size, least(cap, coalesce(w * share, cap)) AS target FROM shares),
passes AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size + 1e-9), 3) ELSE 0 END AS full_ FROM targets),
rests AS (SELECT *, greatest(0.0, target - full_ * source_size) AS rest FROM passes),
sizes AS (SELECT s, b, sum(size) AS z FROM rows_ GROUP BY ALL),
blocks AS (SELECT s, b, z, rest, coalesce(sum(z) OVER (PARTITION BY s ORDER BY md5('mix-1:' || s || ':' || b), b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_ FROM sizes JOIN rests USING (s)),
edge AS (SELECT s, b, rest - at_ AS rest FROM blocks WHERE at_ + z > rest AND at_ < rest),
parts AS (SELECT s, b, c, z, rest, coalesce(sum(z) OVER (PARTITION BY s ORDER BY md5('mix-1:' || s || ':' || b || ':' || c), b, c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_ FROM (SELECT s, b, c, sum(size) AS z, rest FROM rows_ JOIN edge USING (s, b) GROUP BY s, b, c, rest)),
inner_ AS (SELECT s, b, c, rest - at_ AS rest FROM parts WHERE at_ + z > rest AND at_ < rest),
single AS (SELECT doc_id, s, size FROM (SELECT doc_id, s, size, rest, coalesce(sum(size) OVER (PARTITION BY s ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_ FROM rows_ JOIN inner_ USING (s, b, c)) WHERE at_ + size <= rest),
part_ AS (SELECT doc_id, s, size FROM rows_ JOIN parts USING (s, b, c) WHERE at_ + z <= rest UNION ALL SELECT * FROM single),
gaps AS (SELECT s, any_value(rest) - sum(CASE WHEN at_ + z <= rest THEN z ELSE 0 END) - coalesce((SELECT sum(size) FROM part_ WHERE part_.s = blocks.s), 0) AS gap FROM blocks GROUP BY s),
nearest AS (SELECT s, arg_min(doc_id, (abs(gap - size), h, size)) AS doc_id, min(abs(gap - size)) AS off, any_value(gap) AS gap FROM rows_ JOIN (SELECT s, b FROM blocks WHERE at_ + z > rest) USING (s, b) JOIN gaps USING (s) WHERE doc_id NOT IN (SELECT doc_id FROM part_) GROUP BY s),
extra AS (SELECT doc_id FROM part_ UNION ALL SELECT doc_id FROM nearest WHERE off < gap UNION ALL SELECT doc_id FROM rows_ JOIN (SELECT s, b FROM blocks WHERE at_ + z <= rest) USING (s, b))
SELECT r.doc_id, r.size, t.source_size, t.target, CAST(r.size * (t.full_ + CASE WHEN e.doc_id IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken FROM rows_ r JOIN rests t USING (s) LEFT JOIN extra e ON e.doc_id = r.doc_id"""

OP9_SQL = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS_SQL} AS ws FROM documents),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri) WHERE c > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w),
dups AS (SELECT doc_id, count(l) - count(DISTINCT l) AS n FROM lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
chars AS (SELECT doc_id, i, substr(text, i, 1) AS c FROM (SELECT doc_id, text, unnest(range(1, length(text) + 1)) AS i FROM w)),
runs AS (SELECT doc_id FROM (SELECT doc_id, c, i - row_number() OVER (PARTITION BY doc_id, c ORDER BY i) AS r FROM chars WHERE NOT regexp_matches(c, '\s')) GROUP BY doc_id, c, r HAVING count(*) >= 200),
m AS (SELECT doc_id, text, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(list_aggregate(ws, 'string_agg', '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
 coalesce(dups.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words FROM w LEFT JOIN dups USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT doc_id, text, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT (word_chars < n_words OR word_chars > 30 * n_words OR 2 * n_symbols > n_words OR 10 * n_dup_lines > 6 * (length(text) - length(replace(text, chr(10), '')) + 1)
 OR 10 * length(regexp_replace(text, '\P{{L}}+', '', 'g')) < word_chars OR doc_id IN (SELECT doc_id FROM runs)) AS kept FROM b"""

OP12_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {WORDS_SQL} AS ws FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
lab AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS bad FROM labels GROUP BY doc_id),
marks AS (SELECT d.part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, CAST(len(ws) < 200 AS INTEGER) + 2 * CAST(100 * list_unique(ws) < 50 * len(ws) AS INTEGER)
 + 4 * CAST(100 * length(regexp_replace(d.text, '[^A-Z]+', '', 'g')) > 2 * length(d.text) AS INTEGER) + 8 * CAST(regexp_matches(d.text, '[#$%&*|]') AS INTEGER)
 + 16 * CAST(coalesce(d.doc_id > first, false) AS INTEGER) AS mask FROM d JOIN firsts ON firsts.text = d.text LEFT JOIN lab ON lab.doc_id = d.doc_id),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM marks GROUP BY ALL),
sets AS (SELECT part, s.s, coalesce(sum(n) FILTER ((mask & s.s) <> 0), 0) AS n, coalesce(sum(good) FILTER ((mask & s.s) <> 0), 0) AS good, coalesce(sum(bad) FILTER ((mask & s.s) <> 0), 0) AS bad FROM counts, range(32) s(s) GROUP BY ALL),
wholes AS (SELECT part, sum(n) AS whole FROM counts GROUP BY part),
orders AS (SELECT '' AS o, 0 AS used UNION ALL SELECT o || substr('ABCDE', f + 1, 1), used + (1 << f) FROM orders, (SELECT CAST(unnest(range(5)) AS INTEGER) AS f) WHERE used & (1 << f) = 0),
steps AS (SELECT o, CAST(k AS INTEGER) AS step, instr('ABCDE', substr(o, k, 1)) - 1 AS f, CAST(coalesce(list_sum(list_transform(range(1, k), lambda j: 1 << (instr('ABCDE', substr(o, j, 1)) - 1))), 0) AS INTEGER) AS before FROM orders, range(1, 6) r(k) WHERE length(o) = 5),
out_ AS (SELECT w.part, o, step, f, whole, t.n AS then_n, b.n AS before_n, t.good - b.good AS good_lost, t.bad - b.bad AS toxic_lost, own.n AS own_n, every.n - rest.n AS unique_fails
 FROM steps JOIN sets t ON t.s = before + (1 << f) JOIN sets b ON b.part = t.part AND b.s = before JOIN sets own ON own.part = t.part AND own.s = 1 << f
 JOIN sets every ON every.part = t.part AND every.s = 31 JOIN sets rest ON rest.part = t.part AND rest.s = 31 - (1 << f) JOIN wholes w ON w.part = t.part)
SELECT part, o AS filter_order, step, CAST(whole - then_n AS BIGINT) AS kept, CAST(then_n - before_n AS BIGINT) AS removed, CAST(own_n - (then_n - before_n) AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
 CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(then_n - before_n) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM out_"""


def _op13_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds are unrolled: books{k} after k rounds, near{k} the assignment to them."""
    near = lambda k: (
        f"near{k} AS MATERIALIZED (SELECT r, p, arg_min(e, (far, e)) AS e, min(far) AS far FROM (SELECT x.r, x.p, b.e, CAST(list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS far FROM pieces x JOIN books{k} b ON b.p = x.p) GROUP BY r, p)"
    )
    means = lambda k: (
        f"means{k} AS (SELECT p, e, list(m ORDER BY i) AS v FROM (SELECT n.p, n.e, i, CAST((sum(x.v[i]) - ((sum(x.v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM near{k} n JOIN pieces x ON x.r = n.r AND x.p = n.p, (SELECT unnest(range(1, (SELECT max(len(v)) FROM pieces) + 1)) AS i) GROUP BY n.p, n.e, i) GROUP BY p, e), "
        f"books{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM books{k} b LEFT JOIN means{k} m ON m.p = b.p AND m.e = b.e)"
    )
    chain = ", ".join(x for k in range(rounds) for x in (near(k), means(k)))
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id, embedding, label) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (SELECT r, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS v FROM kept, (SELECT CAST(unnest(range({parts})) AS INTEGER) AS p)),
starts AS (SELECT r, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS e FROM (SELECT vec_id, min(r) AS r FROM kept WHERE vec_id IS NOT NULL GROUP BY vec_id ORDER BY vec_id LIMIT {entries})),
books0 AS MATERIALIZED (SELECT p, e, v FROM pieces JOIN starts USING (r)),
{chain},
{near(rounds)},
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books{rounds}),
codes AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN codes USING (r), digest"""


ORACLES: dict[str, str] = {"op8_mixing": OP8_SQL, "op9_quality": OP9_SQL, "op12_filter_audit": OP12_SQL, "op13_vector_codes": _op13_sql()}
