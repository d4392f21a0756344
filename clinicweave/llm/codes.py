"""Codes of vectors: a codebook a part of the vector, entries found through memoised grid cells, all in integers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicweave.llm.common import join_bounded, materialize

#: Components are cut to integers in steps of 1 / SCALE.
SCALE = 4096
#: Side of a grid cell. Narrow cells rule out more entries, wide ones are met again more often; results do not depend on it.
CELL = 256
#: Cells that a worker keeps a part; the memo starts anew beyond, so that its memory is bounded. Results do not depend on it.
MEMO_CELLS = 1 << 15
#: Beyond this size of a component's integer the squared distances of a vector might not fit a long.
LARGEST = 1 << 26
#: Vectors that are encoded at once.
ROWS = 4096


class Grid:
    """Nearest entries of one part's codebook ``[entries, dims]``.

    A part lies in a cell of the grid. For a cell that was not met before, the least and the greatest squared distance
    of its box to every entry are computed; an entry whose least distance exceeds the smallest greatest distance of
    any entry is nearest to no point of the box (it is dominated across it), all others are the cell's candidates and
    are kept under the cell's hash. Only candidates are evaluated. The cell is kept with them: where another cell has
    the same hash, all entries are its candidates.
    """

    def __init__(self, book: np.ndarray, cell: int = CELL, memo_cells: int = MEMO_CELLS):
        self.book, self.cell, self.memo_cells = book, cell, memo_cells
        self.factors = np.random.default_rng(1).integers(1, 1 << 62, book.shape[1], np.int64) * 2 + 1
        self.memo: dict[int, int] = {}  # hash -> place
        self.kept_cells = np.zeros((0, book.shape[1]), np.int64)
        self.kept_masks = np.zeros((0, len(book)), bool)
        self.evaluated = self.looked_up = self.computed = 0

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """Boolean ``[cells, entries]``: entries that some point of the cell's box may have as its nearest."""
        least, most = np.zeros((2, len(cells), len(self.book)), np.int64)
        for d in range(cells.shape[1]):
            at, of = np.unique(cells[:, d], return_inverse=True)  # few different slabs of a dimension
            low = at[:, None] * self.cell
            below, above = low - self.book[:, d], self.book[:, d] - (low + self.cell - 1)
            least += np.square(np.maximum(np.maximum(below, above), 0))[of]
            most += np.square(np.maximum(np.abs(below), np.abs(above)))[of]
        return least <= most.min(1, keepdims=True)

    def masks(self, hashes: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """The candidates of cells of different hashes, from the memo where it has them."""
        place = np.array([self.memo.get(h, -1) for h in hashes.tolist()], np.int64)
        new = np.flatnonzero(place < 0)
        self.looked_up += len(cells)
        self.computed += len(new)
        if len(self.kept_cells) + len(new) > self.memo_cells:
            self.memo, self.kept_cells, self.kept_masks, new = {}, self.kept_cells[:0], self.kept_masks[:0], np.arange(len(cells))
        place[new] = np.arange(len(self.kept_cells), len(self.kept_cells) + len(new))
        self.memo.update(zip(hashes[new].tolist(), place[new].tolist(), strict=True))
        self.kept_cells = np.concatenate([self.kept_cells, cells[new]])
        self.kept_masks = np.concatenate([self.kept_masks, self.candidates(cells[new])])
        return self.kept_masks[place] | (self.kept_cells[place] != cells).any(1, keepdims=True)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each part, ties to the lower index, and its squared distance."""
        cells = parts // self.cell
        hashes, first, cell_of = np.unique((cells * self.factors).sum(1), return_index=True, return_inverse=True)
        masks = self.masks(hashes, cells[first])[cell_of]
        masks |= (cells[first][cell_of] != cells).any(1, keepdims=True)
        row, entry = np.nonzero(masks)
        far = np.square(parts[row] - self.book[entry]).sum(1)
        self.evaluated += len(row)
        starts = np.searchsorted(row, np.arange(len(parts)))
        best = np.minimum.reduceat(far, starts)
        first_best = np.where(far == best[row], entry, len(self.book))
        return np.minimum.reduceat(first_best, starts), best


def integers(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that count, as positions in ``vectors``, and their integers ``[rows, dims]``.

    A vector counts if it has ``dims`` components, none of them null or not finite. Raises where a component is so
    large that squared distances might not fit a long.
    """
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.asarray(vectors.value_lengths().fill_null(-1))
    rows = np.flatnonzero(lengths == dims)
    if not len(rows):
        return rows, np.zeros((0, dims), np.int64)
    values = np.asarray(vectors.take(pa.array(rows)).flatten().cast(pa.float64()).fill_null(np.nan)).reshape(-1, dims)
    fit = np.isfinite(values).all(1)
    scaled = np.floor(values[fit] * SCALE)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component's integer is beyond {LARGEST}: squared distances might not fit a long")
    return rows[fit], scaled.astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], vector: str, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            rows, ints = integers(part.column(vector), dims)
            if len(rows):
                yield part, rows, ints


def _sums(books: np.ndarray, vector: str, cell: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task and used entry: how many parts have it as their nearest, and the sums of their components."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_parts, entries, width = books.shape
        grids = [Grid(b, cell) for b in books]
        n, sums = np.zeros((n_parts, entries), np.int64), np.zeros((n_parts, entries, width), np.int64)
        for _, _, ints in _slices(batches, vector, n_parts * width):
            for p, grid in enumerate(grids):
                parts = ints[:, p * width : (p + 1) * width]
                entry = grid.nearest(parts)[0]
                n[p] += np.bincount(entry, minlength=entries)
                np.add.at(sums[p], entry, parts)
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(n[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    return of


def _encode(books: np.ndarray, vector: str, keep: list[str], cell: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_parts, _, width = books.shape
        grids = [Grid(b, cell) for b in books]
        for batch, rows, ints in _slices(batches, vector, n_parts * width):
            found = [g.nearest(ints[:, p * width : (p + 1) * width]) for p, g in enumerate(grids)]
            code = np.stack([f[0] for f in found], 1).astype(np.uint8).tobytes().hex()
            size = 2 * n_parts
            kept = batch.take(pa.array(rows))
            codes = pa.array([code[i : i + size] for i in range(0, len(code), size)], pa.string())
            yield pa.RecordBatch.from_arrays([*[kept.column(c) for c in keep], codes, pa.array(sum(f[1] for f in found))], [*keep, "code", "error"])

    return of


def common_dims(vectors: DataFrame, vector: str, parts: int) -> int | None:
    """The most frequent length of a vector that ``parts`` divides, of equally frequent ones the smallest."""
    counts = vectors.select(F.size(vector).alias("d")).filter(f"d > 0 AND d % {parts} = 0").groupBy("d").count()
    first = counts.orderBy(F.desc("count"), "d").first()
    return first["d"] if first else None


def first_codebooks(vectors: DataFrame, vec_id: str, vector: str, dims: int, parts: int, entries: int) -> np.ndarray:
    """``[parts, entries, width]``: the parts of the vectors of the ``entries`` smallest ids, ascending.

    Where rows share an id the vector that sorts first stands for it. Fewer ids give fewer entries.
    """
    x = F.col(vector)
    whole = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    kept = vectors.filter((F.size(x) == dims) & whole & F.col(vec_id).isNotNull())
    ids = [r[0] for r in kept.select(vec_id).distinct().orderBy(vec_id).limit(entries).collect()]
    rows = kept.filter(F.col(vec_id).isin(ids)).groupBy(vec_id).agg(F.min(vector).alias("v")).orderBy(vec_id).collect() if ids else []
    if not rows:
        return np.zeros((parts, 0, dims // parts), np.int64)
    _, ints = integers(pa.array([r["v"] for r in rows], pa.list_(pa.float64())), dims)
    return np.ascontiguousarray(ints.reshape(len(rows), parts, -1).transpose(1, 0, 2))


def train_codebooks(vectors: DataFrame, books: np.ndarray, vector: str, rounds: int, cell: int = CELL) -> np.ndarray:
    """``rounds`` times: every part goes to its nearest entry, every used entry becomes the floored mean of its parts.

    A round is one pass over the vectors' column. A task emits a row a used entry, so that a shuffle of counts and sums
    follows and the driver gets one row an entry, whatever the input's size; a lost task is simply run again.
    """
    n_parts, entries, width = books.shape
    for _ in range(rounds):
        partial = vectors.select(vector).mapInArrow(_sums(books, vector, cell), "part int, entry int, n long, sums array<long>")
        sums = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)])
        new = books.copy()
        for r in sums.collect():  # at most parts * entries rows
            new[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
        books = new
    return books


def vector_codes(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, dims: int | None = None, cell: int = CELL) -> DataFrame:
    """Per vector its id, label, code, error, label_error and the codebooks' digest.

    Components become ``floor(4096 * x)``, vectors are cut into ``parts`` equal parts, and each part's codebook of
    ``entries`` (256 at most) is fitted to all rows in ``rounds`` rounds. ``code`` holds two hex digits a part, ``error``
    the squared distances to the entries, summed over parts, ``label_error`` the errors summed over equal labels.

    Rows whose vector is null, or holds a null, NaN or infinite component, are dropped, and so are vectors of another
    length than ``dims`` (unless given, the most frequent length that ``parts`` divides). Ties go to the entry with the
    lower index. Rows with a null id are encoded, but start no entry; repeated rows each give a row; null labels are one
    label. Other columns are not read. Without a vector that counts the result is empty. Components beyond 16384 in size
    raise, because errors would not fit a long.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    dims = dims or common_dims(rows, "vector", parts) or parts
    if dims % parts:
        raise ValueError(f"{dims} components do not make {parts} equal parts")
    books = first_codebooks(rows, "vec_id", "vector", dims, parts, entries)
    if not books.size:  # no vector that counts and has an id
        rows = rows.limit(0)
    else:
        books = train_codebooks(rows, books, "vector", rounds, cell)
    types = dict(rows.dtypes)
    schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"
    coded = materialize(rows.mapInArrow(_encode(books, "vector", ["vec_id", "label"], cell), schema), "codes")
    totals = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "_label")
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    joined = join_bounded(coded, totals, F.col("label").eqNullSafe(F.col("_label")), "inner", 64)
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
