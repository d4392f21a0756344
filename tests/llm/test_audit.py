"""The filter audit against a plain version that applies every order to every document."""

import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinicweave.llm import audit

WORD = re.compile("[^\x20\x09-\x0d]+")
COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text, repeated):
    words = WORD.findall(text)
    return {
        "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)), "E": repeated,
    }


def plain_audit(docs, labels):
    """(id, text, part) rows -> {(part, order, step): figures}."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows, out = {}, {}
    for i, text, part in docs:
        again = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in docs)
        rows.setdefault(part or "", []).append((i, fails(text or "", again)))
    for part, own in rows.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(own)
            for step, f in enumerate(order, 1):
                out_now = [(i, x) for i, x in left if x[f]]
                left = [(i, x) for i, x in left if not x[f]]
                shapley[f] += len(out_now)
                failing = [x for _, x in own if x[f]]
                unique = sum(sum(x.values()) == 1 for x in failing)
                out[part, "".join(order), step] = [len(left), len(out_now), len(failing) - len(out_now), unique, sum(i in good for i, _ in out_now), sum(i in toxic for i, _ in out_now), f]
        for key, v in out.items():
            if key[0] == part:
                v[-1] = shapley[v[-1]]
    return {k: tuple(v) for k, v in out.items()}


def result(df):
    rows = df.collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(found) == len(rows)
    return found


def tables(spark, docs, labels):
    d = spark.createDataFrame([(i, t, s, 1, True, "q") for i, t, s in docs], "doc_id long, text string, source string, mask int, good boolean, part string")
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def random_docs(n, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(["a", "B", "word", "Other", "x" * 9, "#", " ", " ", " ", "\n"]) + rng.choice(["", " "]) for _ in range(rng.choice([0, 5, 300, 900]))) for _ in range(n // 3)]
    return [(rng.choice([None, *range(-20, 3 * n)]), rng.choice([*texts, None, ""]), rng.choice(["p", "p", "p", "q", None, ""])) for _ in range(n)]


def test_sorted_lists_against_sets():
    rng = np.random.default_rng(0)
    for _ in range(400):
        a, b = (np.unique(rng.integers(0, rng.choice([5, 60, 5000]), rng.integers(0, 60))) for _ in range(2))
        assert (audit.gallop(a, b) == np.searchsorted(b, a)).all()
        assert (audit.members(a, b) == np.isin(a, b)).all()
        assert (audit.merge(a, b) == np.union1d(a, b)).all()
    many = np.arange(0, 1_000_000, 3)
    assert (audit.merge(many, np.array([-5, 7, 9, 2_000_000])) == np.union1d(many, [-5, 7, 9, 2_000_000])).all()


@pytest.mark.parametrize("seed,bits", [(1, 12), (2, 2), (3, 0)])
def test_audit_against_every_order(spark, seed, bits):
    docs = random_docs(240, seed)
    docs += docs[:30] + [(i, "one text in a third of all rows #", "p") for i in range(500, 640)] + [(77, "same id " * 300, "q"), (77, "OTHER TEXT", "q")] * 3
    rng = random.Random(seed)
    labels = [(rng.choice([None, *range(0, 600)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(300)]
    labels += labels[:20]
    df = audit.filter_audit(*tables(spark, docs, labels), range_bits=bits)
    assert result(df) == plain_audit(docs, labels)


def test_long_text_empty_tables_and_edge_ids(spark):
    docs = [(2**63 - 1, "w " * 600_000, "a"), (-(2**63), "w " * 600_000, "b"), (0, None, None)]
    assert result(audit.filter_audit(*tables(spark, docs, []))) == plain_audit(docs, [])
    assert audit.filter_audit(*tables(spark, [], [(1, 1, 1)])).count() == 0


def test_repeats_are_told_by_128_bits(spark):
    """Two texts that differ in the first lane of XXH64 only, in a way that cancels for several of its seeds."""
    rng, full = random.Random(3), 2**64 - 1
    p1, p2 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F

    def after(word):
        v = (42 + p1 + p2 + int.from_bytes(word, "little") * p2) & full
        return ((v << 31 | v >> 33) & full) * p1 & full

    letters = lambda n: bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    while True:
        a, b, c = letters(8), letters(8), letters(8)
        d = ((int.from_bytes(c, "little") + (after(a) - after(b)) * pow(p2, -1, 1 << 64)) & full).to_bytes(8, "little")
        if all(32 <= x < 127 for x in d):
            break
    middle = letters(24)
    docs = [(1, (a + middle + c).decode() + "z" * 80, "p"), (2, (b + middle + d).decode() + "z" * 80, "p")]
    df, labels = tables(spark, docs, [])
    assert df.select(F.xxhash64("text")).distinct().count() == df.select(F.xxhash64(F.lit("second"), "text")).distinct().count() == 1
    assert result(audit.filter_audit(df, labels)) == plain_audit(docs, [])


def test_filters_of_ones_own(spark):
    docs, labels = tables(spark, [(1, "a", "p"), (2, "a", "p"), (3, "bb", "p")], [(2, 1, 0)])
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["good_lost"], r["shapley"]) for r in audit.filter_audit(docs, labels, filters={"short": F.length("text") < 2, "null": F.lit(None).cast("boolean")}, repeats="twice").collect()}
    assert len(got) == 6 * 3
    assert got["shorttwicenull", 1] == (1, 2, 0, 1, 9) and got["shorttwicenull", 2] == (1, 0, 1, 0, 3) and got["nulltwiceshort", 2] == (2, 1, 0, 1, 3)
    with pytest.raises(ValueError):
        audit.filter_audit(docs, labels, filters={"E": F.lit(True)})


def test_documents_with_odd_rows(spark, docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    labels = [(0, 1, 0), (9, 1, 1), (10, 0, 1)]
    assert result(audit.filter_audit(docs, tables(spark, [], labels)[1])) == plain_audit(rows, labels)
