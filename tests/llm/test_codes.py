"""Vector codes against a plain version that evaluates every entry."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinicweave.llm import codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, label, vector) -> sorted (vec_id, code, error, label_error, digest)."""
    kept = [(i, y, [math.floor(4096 * x) for x in v]) for i, y, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][2]) // parts if kept else 0
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    first = {}
    for i, _, v in kept:
        if i is not None:
            first[i] = min(first.get(i, v), v)
    books = [[cut(first[i])[p] for i in sorted(first)[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, x: min((far(x, b), e) for e, b in enumerate(books[p]))
    for _ in range(rounds):
        met = {}
        for _, _, v in kept:
            for p, x in enumerate(cut(v)):
                met.setdefault((p, nearest(p, x)[1]), []).append(x)
        for (p, e), xs in met.items():
            books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs, strict=True))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    coded = [(i, y, [nearest(p, x) for p, x in enumerate(cut(v))]) for i, y, v in kept]
    total = {}
    for _, y, found in coded:
        total[y] = total.get(y, 0) + sum(f for f, _ in found)
    out = [(i, "".join(f"{e:02x}" for _, e in found), sum(f for f, _ in found), total[y], digest) for i, y, found in coded]
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 3) for i, y, v in rows], "vec_id long, embedding array<float>, label int, code string, error int")


def result(df):
    return sorted([(r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect()], key=repr)


def vectors(n, dims=16, seed=1, steps=64):
    rng = random.Random(seed)
    return [(rng.randrange(-5, 5 * n), rng.choice([0, 1, None]), [rng.randrange(-steps, steps) / 128 for _ in range(dims)]) for _ in range(n)]


@pytest.mark.parametrize("cell", [1, 100, 256, 5000])
def test_candidates_hold_the_nearest_entry_of_every_point(cell):
    rng = np.random.default_rng(cell)
    book = rng.integers(-900, 900, (16, 3))
    book[5] = book[2]
    points = np.concatenate([rng.integers(-1500, 1500, (3000, 3)), book, np.full((3, 3), 1 << 25)])
    far = np.square(points[:, None] - book).sum(2)
    for memo in (1 << 15, 7):
        grid = codes.Grid(book, cell, memo)
        for _ in range(2):
            entry, best = grid.nearest(points)
            assert (entry == far.argmin(1)).all() and (best == far.min(1)).all()
        assert grid.computed == grid.looked_up // 2 or memo == 7
        assert len(grid.memo) == len(grid.kept_cells) == len(grid.kept_masks)
    if cell <= 256:
        assert grid.evaluated < 2 * 16 * len(points)


def test_cells_of_one_hash_do_not_mix():
    rng = np.random.default_rng(3)
    book, points = rng.integers(-900, 900, (16, 4)), rng.integers(-1500, 1500, (2000, 4))
    grid = codes.Grid(book, 64)
    grid.factors[:] = 0  # all cells have the same hash
    for part in np.array_split(points, 5):
        far = np.square(part[:, None] - book).sum(2)
        entry, best = grid.nearest(part)
        assert (entry == far.argmin(1)).all() and (best == far.min(1)).all()


def test_codes_against_every_entry(spark):
    rows = vectors(300)
    rows += rows[:40]  # rows that are repeated
    rows += [(i, 7, rows[0][2]) for i in range(1000, 1150)]  # one vector in a third of all rows
    rows += [(None, 1, rows[3][2]), (5, None, None), (6, 1, [0.1] * 15 + [None]), (7, 1, [math.nan] + [0.0] * 15), (8, 1, [math.inf] + [0.0] * 15), (9, 0, [-16383.0] + [0.0] * 15)]
    assert result(codes.vector_codes(table(spark, rows))) == plain_codes(rows)
    assert result(codes.vector_codes(table(spark, rows).repartition(7), cell=1000)) == plain_codes(rows)


def test_few_vectors_and_ties(spark):
    rows = [(3, None, [0.0] * 16), (1, None, [0.0] * 16), (2, 1, [0.25] * 8 + [-0.25] * 8)]
    assert result(codes.vector_codes(table(spark, rows))) == plain_codes(rows)


def test_vectors_that_make_no_parts(spark):
    rows = vectors(20)
    odd = [(500, 1, [0.5] * 12), (501, 1, []), (502, 1, [0.5] * 24)]
    assert result(codes.vector_codes(table(spark, rows + odd))) == plain_codes(rows)
    assert codes.vector_codes(table(spark, [])).count() == 0
    assert codes.vector_codes(table(spark, [(1, 1, None), (None, 1, [0.0] * 16)])).count() == 0
    with pytest.raises(Exception, match="might not fit a long"):
        codes.vector_codes(table(spark, [(1, 1, [1e30] * 16)])).count()
    with pytest.raises(ValueError):
        codes.vector_codes(table(spark, rows), dims=12)


def test_long_vectors_and_doubles(spark):
    rows = vectors(40, dims=4000, seed=4)
    df = table(spark, rows).withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert result(codes.vector_codes(df)) == plain_codes(rows)
