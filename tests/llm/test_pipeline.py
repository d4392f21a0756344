"""The pipeline and the SQL of the operators over the smallest tables."""

import os
import random
import zlib
from array import array

import duckdb
import pytest
from test_operators import links
from tokenizers import Tokenizer

from clinicweave.llm import common, decontamination
from clinicweave.llm.queries import OP8_SQL, ORACLES, QUERIES, vocabulary


def test_operators_equal_their_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.sql(f"create view {t} as select * from '{os.path.join(sf_dir, t)}.parquet'")
    for name, sql in ORACLES.items():
        got, want = QUERIES[name](spark, sf_dir).toPandas(), con.sql(sql).df()
        key = sorted(want.columns)
        assert sorted(got.columns) == key
        got, want = (df[key].sort_values([c for c in ("doc_id", "vec_id", "part", "filter_order", "step") if c in key]).reset_index(drop=True) for df in (got, want))
        assert ((got == want) | (got.isna() & want.isna())).all().all(), name


def test_stages(spark, sf_dir):
    import corpus_pipeline
    from clinicweave.llm.common import documents, materialize
    from clinicweave.llm.decontamination import find_leaks
    from clinicweave.llm.neardup import near_duplicates

    docs = documents(spark, sf_dir)
    columns, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= ids and len(now) > 0.6 * len(ids), name
        if name == "minhash_near_dedup":
            assert near_duplicates(docs, shingle_words=5).filter("not kept").count() == 0
        if name == "decontamination":
            assert find_leaks(docs, bench).count() == 0
        ids = now
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert out.count() == docs.count()


def corpus():
    """(documents, labels, benchmark) with toxic documents, groups of copies, and passages at several shares of edits."""
    rng = random.Random(41)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(4, 8)))
    clean, rude = [word("abcdefghijkl") for _ in range(500)], [word("qxzvw") for _ in range(8)]
    text = lambda n: [rng.choice(clean) for _ in range(n)]
    items = [(i, " ".join(text(8 + i % 3 * 8))) for i in range(12)]
    docs, toxic = [], set()

    def add(words, is_toxic=False):
        docs.append((len(docs), " ".join(words), ("a", "b", "c", None)[rng.choice((0, 0, 0, 1, 2, 3))]))
        if is_toxic:
            toxic.add(docs[-1][0])

    for i in range(420):
        words = text(rng.randint(40, 90))
        if i % 5 == 0:
            for _ in range(10):
                words.insert(rng.randrange(len(words)), rng.choice(rude))
        add(words, i % 5 == 0)
    original = text(400)
    add(original)
    for _ in range(60):  # near to the original, and not to each other
        words = list(original)
        for at in rng.sample(range(5, 395), 7):
            words[at] = word("mnop")
        add(words)
    for i in range(20):
        add(docs[7 * i + 1][1].split(), docs[7 * i + 1][0] in toxic)
    for i in range(48):
        passage = list(items[i % 12][1])
        edits = int((0, 0.08, 0.14, 0.25)[i // 12] * len(passage))
        for at in rng.sample(range(len(passage)), edits):
            passage[at] = rng.choice("rst")
        add([*text(40), "".join(passage), *text(30)])
    return docs, [(d, int(d in toxic)) for d, _, _ in docs], items


@pytest.mark.parametrize("broadcast", [48 << 20, 0])
def test_run_equals_plain_stages(spark, tmp_path, monkeypatch, broadcast):
    import corpus_pipeline

    monkeypatch.setattr(common, "BROADCAST_BYTES", broadcast)
    docs, labels, items = corpus()
    table = spark.createDataFrame([(d, t, "en", s, len(t)) for d, t, s in docs], "doc_id long, text string, lang string, source string, n_chars long")
    table.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, 1, y) for d, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    toxic = {d for d, y in labels if y}
    left = [r for r in docs if r[0] not in toxic]
    kept = links([r[:2] for r in left], 5)
    assert sum(not k for _, _, k in kept.values()) >= 60 + 20 - 8
    left = [r for r in left if kept[r[0]][2]]
    leaks = lambda t: any(decontamination.best_match(i, decontamination.normalize(t))[0] <= int(0.15 * len(i)) for _, i in items)
    clean = [r for r in left if not leaks(r[1])]
    assert 36 <= len(left) - len(clean) <= 40
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", clean)
    taken = {d: (n // size) for d, size, _, _, n in con.sql(OP8_SQL).fetchall()}
    words, want, start = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), [], 0
    for d, t, _ in sorted(clean):
        ids = array("I", [*words.encode(t, add_special_tokens=False).ids, 2])
        for _ in range(taken[d]):
            want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    assert got == want


def test_stages_with_odd_rows(spark, docs, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(0, 1, 0), (None, 0, 1), (3, None, None), (0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "an item of some length that has no id"), (2, ""), (3, "quick brown fox jumps over the lazy dog again and again")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        rows[name] = [r["doc_id"] for r in out.collect()]
        assert name == "token_output" or out.columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    known = sorted(x for x in rows["toxicity"] if x is not None)
    assert known == [*range(10), 9, 10, 11] and rows["toxicity"].count(None) == 1
    assert sorted(x for x in rows["minhash_near_dedup"] if x is not None) == [0, 1, 2, 3, 4, 5, 6, 8, 9, 10, 11]
    assert rows["minhash_near_dedup"].count(None) == 1
    assert sorted(x for x in rows["decontamination"] if x is not None) == known[1:] and rows["decontamination"].count(None) == 1
    assert set(rows["mixing"]) <= {None, *known} and max(map(rows["mixing"].count, known)) <= 6
    assert len(rows["token_output"]) == docs.count()
