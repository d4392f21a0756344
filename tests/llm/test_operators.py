"""Operators against plain versions, on small tables with everything that goes wrong easily."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clinicweave.llm import common, decontamination, graph, lines, mixing, neardup, quality, secrets, substrings, suffix, tokens, toxicity
from clinicweave.llm.queries import vocabulary
from clinicweave.llm.suffix import permuted_lcp, suffix_array

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- tokens ---------------------------------------------------------------------------------------------------------


def odd_texts(n=1500):
    rng = random.Random(1)
    bits = ["a", "b", "É", "ß", " ", "  ", "\n", "\t", "\r", ".", ",", "!", "_", "1", "'s", "'", "<|endoftext|>", "\x1c", "\x85", "\xa0", "é", "İ", "Σ", "漢字", "　", ", ", ". ", ".\n", "\x00", "🙂"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(n)]


tokens_letters = [chr(c) for a, b in ((65, 90), (97, 122), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x12F), (0x131, 0x24F)) for c in range(a, b + 1)]


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    path = vocabulary("word_bpe_49k.json")
    texts = odd_texts()
    assert tokens._plain_words(path)
    monkeypatch.setattr(tokens, "WORDS_AT_ONCE", 40)
    got = [x.tolist() for ids, sizes in tokens.encode_column(path, pa.array([None, *texts])) for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [[], *tokens._encode(path, texts)]
    words = ["".join(random.Random(i).choices(tokens_letters, k=i % 9 + 1)) for i in range(3000)]
    ids, sizes = tokens._encode_plain(path, words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == tokens._encode(path, words)
    assert [len(x) for x in tokens.slices(pa.array(["a" * 10, None, "b" * 3, "c" * 30, "d"]), 150)] == [3, 2]


def test_words_give_the_counts_of_whole_texts():
    path = vocabulary("byte_bpe_50k.json")
    texts = odd_texts()
    want = [len(x) for x in tokens._encode(path, texts)]
    assert tokens.count_tokens_byte_level(path, texts) == want
    assert [sum(map(len, tokens._encode(path, tokens.safe_parts(t, 5)))) for t in texts] == want


def test_a_full_cache_changes_nothing(monkeypatch):
    path = vocabulary("byte_bpe_50k.json")
    long = ["x1y2" * n for n in range(20, 90, 7)] * 2  # words without a blank, longer than what is kept
    monkeypatch.setattr(tokens, "CACHE_CHARS", 300)
    tokens._CACHES.clear()
    for texts in (long[:5], long, odd_texts(100), long):
        assert tokens.count_tokens_byte_level(path, texts) == [len(x) for x in tokens._encode(path, texts)]
        for cache in tokens._CACHES.values():
            assert sum(len(w) for w in cache if len(w) <= tokens.LONGEST_KEPT) <= 300 + max(sum(map(len, set(texts))), 300)
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 3)
    tokens._CACHES.clear()
    assert [tokens.count_tokens_byte_level(path, [t])[0] for t in odd_texts(200)] == [len(x) for x in tokens._encode(path, odd_texts(200))]
    tokens._CACHES.clear()


def test_batches_are_bounded_by_bytes(spark):
    df = common.bounded_batches(spark.range(60, numPartitions=1).selectExpr("repeat('x', 1000000) AS text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    rows = [r["n"] for r in df.mapInArrow(sizes, "n long").collect()]
    assert sum(rows) == 60 and max(rows) <= 40


def test_token_files(spark, docs):
    path = vocabulary("word_bpe_49k.json")
    got = tokens.token_output(docs, path, end_id=2).orderBy("start").collect()
    at = 0
    texts = sorted(plain(docs), key=lambda r: (r[0] is not None, r[0] or 0))
    for row, (doc, text) in zip(got, texts, strict=True):
        ids = [*tokens._encode(path, [text or ""])[0], 2]
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert tokens.token_output(docs.limit(0), path).count() == 0


def test_token_files_are_read_in_part(spark, tmp_path):
    import pyarrow.parquet as pq

    path, at = vocabulary("word_bpe_49k.json"), str(tmp_path / "ids")
    rng = random.Random(2)
    rows = [(i, " ".join(f"{rng.choice('abcd')}{rng.randint(0, 999)}" for _ in range(50))) for i in range(4000)] + [(7, "c"), (7, "b b b b b b"), (7, "b b b b b b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("place", F.lit("x"))
    files = tokens.write_token_ids(df, at, path, row_group_bytes=1 << 16, page_bytes=4 << 10, page_rows=100)
    starts = sorted((r["start"], r["n_tokens"]) for r in tokens.token_file_digest(files).filter("doc_id = 7").collect())
    assert [n for _, n in starts[1:3]] == [7, 2] and starts[0][1] > 50 or [n for _, n in starts[:3]] == [7, 7, 2]  # equal ids lie in the order of their texts, as in the files
    some = tokens.read_token_ids(spark, at, 100, 102)
    assert sorted(r["doc_id"] for r in some.collect()) == [100, 101, 102]
    counts = tokens.read_token_counts(spark, at)
    assert counts.agg(F.sum("n_tokens")).first() == files.agg(F.sum("n_tokens")).first()
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,100)" in plan(some) and "ids" not in plan(counts).split("ReadSchema")[1]
    meta = [pq.ParquetFile(f).metadata for f in tmp_path.glob("ids/*.parquet")]
    column = lambda m, name: next(m.row_group(0).column(i) for i in range(m.num_columns) if m.row_group(0).column(i).path_in_schema.startswith(name))
    assert any(m.num_row_groups > 1 for m in meta)
    for m in meta:
        assert column(m, "ids").has_dictionary_page and "RLE_DICTIONARY" in column(m, "ids").encodings
        assert any(e.startswith("DELTA") for e in column(m, "doc_id").encodings)
        assert column(m, "doc_id").has_offset_index and column(m, "doc_id").has_column_index


def test_token_counts(docs):
    path = vocabulary("byte_bpe_50k.json")
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.token_counts(docs, path).collect())
    n = lambda t: len(tokens._encode(path, [t])[0])
    assert got == sorted((d or -1, len((t or "").encode()), n(t or ""), n(t or "") > 512) for d, t in plain(docs))


# --- suffix arrays and repeated strings -----------------------------------------------------------------------------


def test_suffix_arrays_recurse(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    raw = np.frombuffer(" ".join(rng.choice(words) for _ in range(4000)).encode() + b"\0", np.uint8).astype(np.int64)
    alphabets = []
    plain_init = suffix._Induce.__init__
    monkeypatch.setattr(suffix._Induce, "__init__", lambda self, s, small, sigma: (alphabets.append(sigma), plain_init(self, s, small, sigma))[1])
    data = raw.astype(np.uint8).tobytes()
    assert suffix_array(raw, 256).tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    assert len(alphabets) > 2 and max(alphabets) > suffix.WAVE_CHARACTERS  # induced in waves and singly


@pytest.mark.parametrize("waves", [1 << 10, 0])
def test_suffix_arrays(monkeypatch, waves):
    monkeypatch.setattr(suffix, "WAVE_CHARACTERS", waves)
    rng = random.Random(3)
    for _ in range(400):
        sigma = rng.choice([1, 2, 3, 200])
        s = [rng.randint(1, sigma) for _ in range(rng.randint(0, 60))] + [0]
        sa = suffix_array(np.array(s), sigma + 1)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        common = permuted_lcp(np.array(s), sa, sigma + 1)
        for a, b in zip(sa, sa[1:], strict=False):
            k = 0
            while s[a + k : a + k + 1] == s[b + k : b + k + 1] != []:
                k += 1
            assert common[b] == k


def removal(rows):
    """Plain version: doc -> (bytes, removed, spans, sha256), rows in order of ids."""
    seen, out = {}, []
    for doc, text in sorted(((d, t) for d, t in rows if d is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if seen.get(raw[i : i + 50], doc) < doc:
                gone[i : i + 50] = b"\1" * 50
            seen.setdefault(raw[i : i + 50], doc)
        rest = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        out.append((doc, len(raw), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def noisy(seed, n):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab cdé") for _ in range(rng.randint(10, 160))) for _ in range(12)]
    return [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for i in range(n)]


@pytest.mark.parametrize(("most", "broadcast"), [(2000, 48 << 20), (1, 0)])
def test_repeated_strings(spark, docs, monkeypatch, most, broadcast):
    monkeypatch.setattr(substrings, "MAX_CONTEXTS", most)
    for module in (substrings, common):
        monkeypatch.setattr(module, "BROADCAST_BYTES", broadcast)
    for df in (docs, spark.createDataFrame(noisy(5, 60), "doc_id long, text string")):
        got = sorted(tuple(r) for r in substrings.substring_dedup(df).collect() if r["doc_id"] is not None)
        assert got == removal(plain(df))
    assert substrings.substring_dedup(docs.limit(0)).count() == 0


# --- lines ----------------------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize(("edits", "frequent", "broadcast"), [(1, 32, None), (2, 32, 0), (3, 32, None), (1, 1, None), (2, 1, 0)])
def test_similar_lines(spark, docs, monkeypatch, edits, frequent, broadcast):
    monkeypatch.setattr(lines, "FREQUENT", frequent)
    for module in (lines, common) if broadcast is not None else ():
        monkeypatch.setattr(module, "BROADCAST_BYTES", broadcast)
    rng = random.Random(edits)
    texts = []
    for _ in range(40):
        base = "".join(rng.choice("abcd") for _ in range(rng.randint(8, 30)))
        for _ in range(rng.randint(1, 3)):
            x = list(base)
            for _ in range(rng.randint(0, edits + 1)):
                p = rng.randrange(len(x))
                x[p : p + rng.randint(0, 1)] = rng.choice(["", "a", "z"])
            texts.append("".join(x))
    texts += [rng.choice(["ab", "ac", "a", " a", "漢", "", " ", "\t", "abcdefg"]) for _ in range(40)]  # short ones, and some without a word
    rng.shuffle(texts)
    rows = [(i, "\n".join(texts[3 * i : 3 * i + 3])) for i in range(len(texts) // 3)] + [(1000, None), (1001, "")]
    first = {}
    for d, t in rows:
        for i, x in enumerate((t or "").split("\n")):
            if WORD.search(x):
                first.setdefault(x, (d, i))
    like = lambda x, y: y != x and min(len(x), len(y)) >= 8 and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits
    near = {x: min((first[y] for y in first if like(x, y)), default=(9999, 0)) for x in first}
    want = {}
    for d, t in rows:
        gone = [(i, x) for i, x in enumerate((t or "").split("\n")) if WORD.search(x) and min(first[x], near[x]) < (d, i)]
        kept = [x for i, x in enumerate((t or "").split("\n")) if i not in {g for g, _ in gone}]
        want[d] = (len((t or "").split("\n")), len(gone), sum(first[x] == (d, i) for i, x in gone), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    got = by_id(lines.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), edits=edits, least=8))
    assert {d: tuple(r)[1:] for d, r in got.items()} == want
    assert lines.line_dedup(docs, edits=edits).count() == docs.count() and lines.line_dedup(docs.limit(0)).count() == 0


def test_signatures_bound_the_edits(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        x = "".join(rng.choice("abcd 漢😀") for _ in range(rng.randint(1, 40)))
        y = list(x)
        for _ in range(2):
            p = rng.randrange(len(y) + 1)
            y[p : p + rng.randint(0, 1)] = rng.choice(["", "a", "z", "😀"])
        rows.append((x, "".join(y) or "a", "".join(rng.choice("efgh") for _ in range(60))))
    bits = lambda a, b: F.bit_count(lines._signature(F.col(a)).bitwiseXOR(lines._signature(F.col(b))))
    got = spark.createDataFrame(rows, "x string, y string, z string").select(bits("x", "y").alias("near"), bits("x", "z").alias("far")).collect()
    assert max(r["near"] for r in got) <= 8 < sum(r["far"] for r in got) / len(got)


def test_lines_of_a_large_group_of_near_copies(spark):
    rng = random.Random(17)
    base = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(40))
    texts = [base]
    while len(texts) < 260:
        x = list(rng.choice(texts[:40]) if rng.random() < 0.4 else base)
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(x))
            x[at : at + rng.randint(0, 1)] = "".join(rng.choice("abcxyz") for _ in range(rng.choice([0, 1, 1, 4])))
        texts.append("".join(x))
    rng.shuffle(texts)
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(t, i)
    near = {t for t in first for o in first if first[o] < first[t] and abs(len(o) - len(t)) <= 2 and decontamination.best_match(o, t)[0] <= 2 and distance(o, t) <= 2}
    want = {i: (int(t in near or first[t] < i), int(t in near and first[t] == i)) for i, t in enumerate(texts)}
    got = by_id(lines.line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert 30 < sum(n for _, n in want.values()) < 230
    assert {d: (r["n_removed"], r["n_near"]) for d, r in got.items()} == want


# --- near-duplicates ------------------------------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(300)] + [(1000 + rng.randint(0, 80), 1000 + rng.randint(0, 80)) for _ in range(60)] + [(5000, i) for i in range(5001, 5200)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def links(rows, k):
    sets = {}
    for d, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    label = {d: d for d in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def near_copies():
    rng = random.Random(9)
    rows, n = [], 0
    for size in (1, 2, 3, 40):
        base = [rng.choice("abcdefghijklmnop") + str(rng.randint(0, 99)) for _ in range(60)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(len(words))] = str(rng.random())
            rows.append((n := n + 1, " ".join(words).upper() if n % 2 else " ".join(words)))
    return rows


@pytest.mark.parametrize(("k", "broadcast"), [(2, 48 << 20), (5, 0)])
def test_near_duplicates(spark, docs, monkeypatch, k, broadcast):
    monkeypatch.setattr(common, "BROADCAST_BYTES", broadcast)
    rows = near_copies() + [(500, None), (501, ""), (502, " "), (503, "one"), (504, "ONE"), (505, "x y"), (506, "x y x y x y")]
    got = by_id(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=k))
    assert {d: (r["n_shingles"], r["component_id"], r["kept"]) for d, r in got.items()} == links(rows, k)
    known = [(d, t) for d, t in plain(docs) if d is not None]
    got = by_id(neardup.near_duplicates(docs, shingle_words=k).filter("doc_id is not null"))
    assert {d: (r["n_shingles"], r["component_id"], r["kept"]) for d, r in got.items()} == links(known, k)
    assert neardup.near_duplicates(docs.limit(0)).count() == 0 and neardup.near_duplicates(docs).count() == docs.count()


def test_texts_of_one_id_join_what_is_near_to_each(spark):
    rng = random.Random(4)
    text = lambda: [f"w{rng.randrange(10_000)}" for _ in range(100)]
    w, v = text(), text()
    near = lambda x: " ".join([*x[:50], "changed", *x[51:]])
    rows = [(5, " ".join(w)), (5, " ".join(v)), (6, near(w)), (7, near(v)), (8, None), (8, None)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [(5, 5, True), (5, 5, True), (6, 5, False), (7, 5, False), (8, 8, True), (8, 8, True)]


def star(copies):
    """An original (id 0) and copies of it, each near to it and none near to another."""
    rng = random.Random(21)
    base = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(base))]
    for n in range(1, copies + 1):
        words = list(base)
        for at in rng.sample(range(400), 20):
            words[at] = f"x{n}-{at}"
        rows.append((n, " ".join(words)))
    return rows


def test_near_duplicates_that_only_an_original_joins(spark):
    rows = star(500)
    want = links(rows, 2)
    assert {r[1] for r in want.values()} == {0} and all(not r[2] for d, r in links(rows[1:61], 2).items() if d != r[1])
    assert sum(r[2] for r in links(rows[1:61], 2).values()) > 55
    got = by_id(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {d: (r["n_shingles"], r["component_id"], r["kept"]) for d, r in got.items()} == want


# --- quality, secrets, mixing ---------------------------------------------------------------------------------------


def measures(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {x for x in windows if windows.count(x) > 1} if len(windows) < 3000 else {x for x in set(windows) if sum(x == y for y in windows) > 1}
    covered = {j for i, x in enumerate(windows) if x in twice for j in (i, i + 1, i + 2)}
    found = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(found) - len(set(found)), len(covered)


def test_quality(spark, docs):
    texts = ["a b c a b c", "a b c d", "x\nx\ny\n\n\n x", "# * $", None, "", "a a a a a"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(quality.quality(rows))
    assert {d: tuple(r)[1:6] for d, r in got.items()} == {i: measures(t) for i, t in enumerate(texts)}
    out = by_id(quality.quality(docs))
    assert out[6]["base_failed"] and not out[6]["kept"] and len(out) == len({d for d, _ in plain(docs)})
    good = " ".join(f"word{i}" for i in range(80))
    rules = [quality.Rule("never", F.lit(None).cast("boolean")), quality.Rule("always", F.col("n_words") > 0)]
    one = spark.createDataFrame([(1, good)], "doc_id long, text string")
    assert quality.quality(one).first()["kept"] and quality.quality(one, rules).first()["rejected_by"] == "always"
    assert quality.quality(docs.limit(0)).count() == 0


def test_secrets(spark, docs):
    rare, common = "q8Zt" + "Kx92Lm04Pq7w5Rb1Yc", "t0" + "K3nF0rAll0fTheWorld9"
    texts = ["api_key = '" + "x1Y2z3W4v5U6" + "' 漢 " + rare, "before " + common, "Secret:short", "again " + common, "more " + common + " token=" + common]
    df = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = by_id(secrets.secret_scan(df))
    at = texts[0].index(rare)
    assert got[0]["spans"] == f"assign:0:{texts[0].index(chr(39) + ' 漢')},token:{at}:{at + len(rare)}" and got[0]["n_live"] == 1
    assert got[1]["spans"] == got[3]["spans"] == "" and got[4]["n_copied"] == 1 and got[4]["n_live"] == 0
    assert got[2]["n_assign"] == 0 and got[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    out = secrets.secret_scan(docs).collect()
    assert len(out) == docs.count() and [(r["n_assign"], r["n_access"], r["n_hex"]) for r in out if r["doc_id"] == 9] == [(1, 1, 1)] * 2
    assert secrets.secret_scan(docs.limit(0)).count() == 0


def spans_of(text):
    """Plain version of the base spans of a text."""
    out = []
    for kind, (pattern, least, group) in enumerate(((secrets.ASSIGN, 8, 2), (secrets.ACCESS, 16, 0), ("[0-9a-f]+", 32, 0))):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_base_spans_equal_a_plain_scan(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(secrets, "ROWS_OF_A_KEY", 2)
    rng = random.Random(14)
    bits = ["password", "Secret", "API_key", "apikey", "token", "passwd", "=", ":", " ", "\"", "'", "AKIA", "ABCDEFGH", "0123456789abcdef", "x9.Z", "漢", "\n", "é", "tokentoken=", "deadbeef"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(400)] + [None, "", "password = abcdefgh1 " * 300]
    fuzz = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for df in (fuzz, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        got = by_id(secrets.secret_scan(df))
        for d, t in plain(df):
            want = spans_of(t)
            assert got[d]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
            assert set(filter(None, want.split(","))) <= set(got[d]["spans"].split(","))
    assert sum(bool(spans_of(t)) for t in texts) > 50


@pytest.mark.parametrize("broadcast", [48 << 20, 0])
def test_mixing(spark, docs, monkeypatch, broadcast):
    monkeypatch.setattr(common, "BROADCAST_BYTES", broadcast)
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_digest(df).collect()
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_digest(df.repartition(3)).collect()}
    assert {r["doc_id"]: r["taken"] for r in got} == again
    of = dict((i, s) for i, _, s in rows)
    size, taken, target = {}, {}, {}
    for r in got:
        s = of[r["doc_id"]]
        size[s], taken[s], target[s] = size.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"], r["target"]
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
    left, active = float(sum(size.values())), dict(zip(["a", "b", "c", None], [5, 2, 1, 5], strict=True))
    want = {}
    while active:
        level = left / sum(active.values())
        stops = [s for s in active if active[s] * level > 3 * size[s]]
        for s in stops or list(active):
            want[s] = 3.0 * size[s] if stops else active[s] * level
            left -= want[s] if stops else 0
            del active[s]
    assert all(abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - target[s]) <= 30 for s in want)
    _, draws = mixing.mix_plan(df)
    shards = [r["n"] for r in draws.groupBy("shard").agg(F.count_distinct("copy", "doc_id").alias("n")).collect()]
    assert len(shards) == 16 and sum(shards) == sum(r["taken"] // r["size"] for r in got if r["size"]) + draws.join(df.filter("trim(text) = ''"), "doc_id").count()
    assert mixing.mix_digest(docs).count() == docs.count() and mixing.mix_digest(docs.limit(0)).count() == 0
    mixed = mixing.mix_documents(df.withColumn("shard", F.lit("x")).withColumn("place", F.lit(None).cast("int")))
    assert mixed.columns == ["doc_id", "text", "source", "shard", "place"]
    times = {r["doc_id"]: r["n"] for r in mixed.filter("shard = 'x' and place is null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {d: n for d, n in times.items() if rows[d][1]} == {r["doc_id"]: r["taken"] // r["size"] for r in got if r["taken"]}
    order = [r["doc_id"] for r in mixed.collect()]
    assert order != sorted(order) and order == [r["doc_id"] for r in mixing.mix_documents(df.repartition(5)).collect()]
    assert mixing.mix_documents(docs).columns == docs.columns and mixing.mix_documents(docs).count() > 0 and mixing.mix_documents(docs.limit(0)).count() == 0


def test_quotas_of_shards(spark):
    rows = [(f"s{i}", n) for i, n in enumerate([700, 40, 1, 0, 259])]
    df = spark.createDataFrame(rows, "_s string, quota int")
    seen = {}
    for seed in range(8):
        got = mixing.shard_quotas(df, 3, f"seed {seed}").collect()
        by = {}
        for r in got:
            by.setdefault(r["_s"], []).append((r["shard"], r["_from"], r["_to"]))
        for s, n in rows:
            runs = sorted(by[s])
            assert [x[0] for x in runs] == list(range(8)) and runs[0][1] == 0 and runs[-1][2] == n
            assert all(a[2] == b[1] for a, b in zip(runs, runs[1:], strict=False))
        assert [sum(b - a for x in by.values() for k, a, b in x if k == shard) for shard in range(8)] == [125] * 8
        seen.setdefault("s0", []).extend(b - a for _, a, b in by["s0"])
    # of 125 units a shard has 125 * 0.7 of the largest source, give or take 5 (the law's standard deviation is 4.8)
    assert abs(np.mean(seen["s0"]) - 87.5) < 1e-9 and 3 < np.std(seen["s0"]) < 7


# --- toxicity -------------------------------------------------------------------------------------------------------


def test_toxicity(spark, docs):
    rng = random.Random(8)
    words = ["calm", "river", "stone", "house", "green", "walk", "paper", "light"]
    rows = []
    for i in range(900):
        text = [rng.choice(words) for _ in range(40)]
        toxic = i % 4 == 0
        for _ in range(rng.randint(2, 5) if toxic else 0):
            text[rng.randrange(40)] = rng.choice(["grobulous", "snarfhead", "snarfface"]) + rng.choice(["", ",", "!"])
        rows.append((i, " ".join(text), int(toxic)))
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows] + [(None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, source string")
    got = by_id(toxicity.toxicity(df, labels))
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r["held_out"]} == set(held)
    right = sum(got[i]["predicted"] == rows[i][2] for i in held) / len(held)
    assert right > 0.95 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    assert toxicity.toxicity(docs, labels).count() == docs.count() and toxicity.toxicity(docs.limit(0), labels).count() == 0
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns and 600 <= kept.count() <= 720


def test_features_of_a_very_long_word_take_no_longer():
    import time

    for text in ("a" * 1_000_000, "a1" * 500_000, "A" * 500_000 + "b", "." * 500_000 + "a", "b-a_s-t@rd " * 50_000):
        began = time.process_time()
        assert len(toxicity.text_features(text, toxicity.Lexicon(["bastard"], []))) == len(toxicity.FEATURES)
        assert time.process_time() - began < 30
    plain_words = re.compile(r"[^\W\d_]+(?:[0-9@$!|*._-]+[^\W\d_]+)+")
    for t in odd_texts(500) + ["a.b c1d e--f_g h", "x@@y.z!"]:
        assert toxicity._DISGUISED.findall(t) == plain_words.findall(t)


# --- decontamination ------------------------------------------------------------------------------------------------


def test_edit_search():
    rng = random.Random(5)
    for _ in range(200):
        a, b = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12))), "".join(rng.choice("abc") for _ in range(rng.randint(0, 18)))
        want = min(distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert decontamination.best_match(a, b)[0] == want


@pytest.mark.parametrize("block", [512 << 10, 2000])
def test_leaks(spark, docs, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", block)
    rng = random.Random(12)
    text = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    items = [(i, text(30)) for i in range(40)] + [(100, None), (101, ""), (102, "short"), (104, "k l m"), (None, text(30)), (103, "Twenty  three letters!")]
    rows, want = [(900, "x twenty three\nletters! y"), (901, "twenty three letters!y"), (902, "twenty three letter! y"), (903, "漢字" * 400 + items[3][1] + "漢" * 90), (904, "short K\tl m"), (905, "shorter k l mm twenty three")], {(900, 103), (901, 103), (902, 103), (903, 3), (904, 102), (904, 104)}
    for i in range(200):
        body = text(60)
        if i % 5 == 0:
            item, source = items[i % 40]
            edited = list(source.upper() if i % 2 else source)
            for _ in range(int(0.05 * len(edited))):
                edited[rng.randrange(len(edited))] = rng.choice("klm")
            body = body + "\n" + "".join(edited) + "  " + text(10)
            want.add((i, item))
        rows.append((i, body))
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(df, bench).collect()}
    assert found <= want and len(found) >= 0.95 * len(want)
    assert decontamination.find_leaks(docs, bench).count() == 0 and decontamination.find_leaks(df, bench.limit(0)).count() == 0
    left = decontamination.drop_leaking(df.withColumn("item_id", F.lit(1)), bench)
    assert left.count() == 206 - len({d for d, _ in found}) and "item_id" in left.columns


def edited(source, k, rng, kinds=(0, 1, 2), spread=False):
    """``k`` replacements, deletions and insertions."""
    source = list(source)
    places = [int((j + 0.5) * len(source) / k) for j in range(k)] if spread else rng.sample(range(len(source)), k)
    for at in sorted(places, reverse=True):
        source[at : at + 1] = [rng.choice("klm"), "", source[at] + rng.choice("klm")][rng.choice(kinds)]
    return "".join(source)


def fewest(item, text):
    """Edits of the best passage; short items are passages of whole words."""
    return decontamination.best_match(item, text)[0] if len(item) >= decontamination.LEAST_WALKED else decontamination.best_match(f" {item} ", f" {text} ")[0]


def test_leaks_with_all_the_edits_that_count(spark):
    rng = random.Random(31)
    text = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(60))[:n].strip()
    items = [(i, text((13, 34, 63, 64, 90, 160, 233, 300)[i % 8])) for i in range(80)]
    rows = []
    for i in range(480):
        source = items[i % 80][1]
        k = int((0.05, 0.1, 0.12, 0.15, 0.15, 0.16)[i // 80] * len(source)) + (i >= 400)
        rows.append((i, text(200) + " " + edited(source, k, rng, (0, 1, 2) if i % 3 else (0,), i % 2 == 1) + " " + text(100)))
    want = {}
    for d, t in rows:
        for i, item in items:
            edits = fewest(item, decontamination.normalize(t))
            if edits <= int(0.15 * len(item)):
                want[d, i] = edits
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontamination.find_leaks(df, bench).collect()}
    assert got.items() <= want.items() and len(want) >= 380
    short = {key for key in want if len(items[key[1]][1]) < decontamination.LEAST_WALKED}
    assert len(short) >= 120 and short <= got.keys()
    walked = want.keys() - short
    for share in (0, 80, 160, 240, 320):  # each share of edits for itself
        some = {key for key in walked if share <= key[0] < share + 80}
        assert len(some & got.keys()) >= 0.9 * len(some) > 30, share
    assert len(walked & got.keys()) >= 0.95 * len(walked)


def test_leaks_in_runs_and_in_any_grouping():
    rng = random.Random(8)
    body = "".join(rng.choice("abcdefghij  ") for _ in range(400))
    rows = [(1, "a" * 100), (2, "a" * 200), (3, body[:150]), (4, body[:150]), (5, ""), (6, "é"), (7, None)]
    items = decontamination.Items(rows, 0.15)
    texts = [decontamination.normalize(t) for t in ("a" * 60_000, body, "x" + body[:130] + "y", "", "é", "aéa", "b" * 500 + "a" * 90)]
    whole = sorted(items.leaks(texts))
    assert [x[:3] for x in whole] == [(0, 1, 0), (0, 2, 0), (1, 3, 0), (1, 4, 0), (2, 3, whole[4][2]), (2, 4, whole[4][2]), (4, 6, 0), (6, 1, 10)]
    assert whole == sorted((t, *x[1:]) for t, one in enumerate(texts) for x in items.leaks([one]))


def test_few_passages_are_verified_in_vain(spark, docs, sf_dir, monkeypatch):
    verified, one = [], decontamination.passage
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    texts = [decontamination.normalize(r["text"]) for r in docs.select("text").collect()]
    monkeypatch.setattr(decontamination, "passage", lambda *x: verified.append(x) or one(*x))
    leaks = list(decontamination.Items(items, 0.15).leaks(texts))
    assert 0 < len(leaks) and len(verified) <= 3 * len(leaks)


def test_walks_follow_the_edits_that_count():
    rng = random.Random(9)
    items = [(i, decontamination.normalize("".join(rng.choice("abcdefghij  ") for _ in range(90)))) for i in range(60)]
    few, many = decontamination.walks_needed(items, 0.02), decontamination.walks_needed(items, 0.25)
    assert decontamination.LEAST_WALKS == len(few) < len(many) <= decontamination.MOST_WALKS


def test_texts_of_one_64_bit_hash_are_not_equal(spark):
    rng, full = random.Random(3), 2**64 - 1
    p1, p2 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F

    def after(word):
        v = (42 + p1 + p2 + int.from_bytes(word, "little") * p2) & full
        return ((v << 31 | v >> 33) & full) * p1 & full

    letters = lambda n: bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    while True:  # the first lane of XXH64 after two stripes is the same for both
        a, b, c = letters(8), letters(8), letters(8)
        d = ((int.from_bytes(c, "little") + (after(a) - after(b)) * pow(p2, -1, 1 << 64)) & full).to_bytes(8, "little")
        if all(32 <= x < 127 for x in d):
            break
    middle, rest = letters(24), letters(24).decode() + "z" * 80
    texts = [(a + middle + c).decode() + rest, (b + middle + d).decode() + rest]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert df.select(F.xxhash64("text")).distinct().count() == 1
    assert {r["n_removed"] for r in lines.line_dedup(df).collect()} == {0}
    assert substrings.exact_copies(df.withColumn("rid", F.col("doc_id"))).count() == 0
