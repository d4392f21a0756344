"""Connected components of large edge lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicweave.llm.common import materialize

#: Rounds after which something must be wrong: every round at least halves the nodes of a component.
MAX_ROUNDS = 60


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a partition as stars around the smallest node: same components, no long paths, never more edges."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    stars = [(find(x), x) for x in parent if find(x) != x]
    for at in range(0, len(stars), 50_000):
        part = np.array(stars[at : at + 50_000], np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b), label being the smallest node of its component.

    Each partition first turns its edges into stars. Then every node hooks to its smallest neighbour, hooks are
    followed four steps, edges are rewritten to the nodes they lead to, and loops and repeats go. A node with very
    many neighbours costs one row a task, because the smallest neighbour is a partial aggregate. Rounds are written
    to the shared folder; no edge reaches the driver.
    """
    plain = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    e = materialize(plain.mapInArrow(_local_forest, "a long, b long").distinct(), "edges")
    labels = materialize(e.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    for _ in range(MAX_ROUNDS):
        if e.isEmpty():
            return labels
        hook = materialize(e.groupBy("b").agg(F.min("a").alias("to")), "hooks")
        for _ in range(2):
            jump = hook.select(F.col("b").alias("to"), F.col("to").alias("far"))
            hook = hook.join(jump, "to", "left").select("b", F.coalesce("far", "to").alias("to"))
        hook = materialize(hook, "hooks")
        to = lambda df, c: df.join(hook.select(F.col("b").alias(c), F.col("to").alias("_to")), c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
        labels = materialize(to(labels, "label"), "labels")
        moved = to(to(e, "a"), "b").filter("a != b")
        e = materialize(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().mapInArrow(_local_forest, "a long, b long").distinct(), "edges")
    raise RuntimeError("components did not converge")
