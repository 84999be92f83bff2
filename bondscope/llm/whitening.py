"""Embedding whitening by spectrum slicing.

Entries become whole numbers; one pass over the table adds up rows and sums, a second the centred outer
products, as one matrix a task. The leading eigenvalues of that covariance, whose size depends on the vectors' length
only, are then isolated: an LDL^T factorisation of the covariance less a shift tells by its inertia how many
eigenvalues lie above the shift, and intervals are halved until one holds a single eigenvalue. From its middle, Rayleigh
quotient iteration converges cubically; counts on both sides of the result certify its number. Eigenvalues that
cannot be told apart in doubles are one cluster, whose vectors are any orthonormal basis of its space. A third pass
projects the rows and measures the covariance of the whitened values.

Nulls: rows whose vector is null or has a null or non-finite entry are dropped; a null identifier is kept. Repeated rows
and equal vectors count as often as they stand there. Components whose eigenvalue is zero in doubles do not exist: there is
nothing to scale, so a table of one vector, or of equal ones, gives no rows, and so does an empty one. Vectors of unlike
lengths are refused with an error, and so are entries too large for exact sums. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
STEP, SHIFT = 64.0, 1_000_000
#: Rows that are centred or projected at once.
AT_ONCE = 4_096
#: Vectors are made orthogonal to those of eigenvalues nearer than this, relative to the largest.
NEAR = 1e-3

WHITENED = "component int, n long, deviation long, whitened double, explained double"


@dataclass
class Whitening:
    """The fitted transform: rows, sums, unit eigenvectors as columns, eigenvalues and their shares of the trace."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def fit_whitening(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The transform of all usable rows; None where there is nothing to scale."""
    kept = usable(rows, vector)
    sizes = kept.agg(F.min(F.size(vector)), F.max(F.size(vector)), F.count("*")).first()
    if not sizes[2] or not sizes[1]:
        return None
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors of unlike lengths: {sizes[0]} and {sizes[1]}")
    n, sums = _column_sums(kept, vector, sizes[1])
    total = _added(kept, vector, (sizes[1], sizes[1]), lambda whole: _outer(centred(whole, n, sums)))
    covariance = total / n
    values, vectors = leading_eigenpairs(covariance, components)
    if not len(values):
        return None
    return Whitening(n, sums, vectors, values, values / np.trace(covariance))


def whiten(rows: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``; a row for each component."""
    kept = usable(rows, vector)
    schema = f"{key} long, {WHITENED}"
    if model is None:
        return kept.select(key, vector).limit(0).mapInArrow(lambda batches: iter(()), f"{schema}, identity_error double")
    scale, many = model.vectors / np.sqrt(model.values), len(model.values)

    def moments(whole: np.ndarray) -> np.ndarray:
        found = centred(whole, model.n, model.sums) @ scale
        return np.vstack([found.T @ found, found.sum(axis=0)])

    told = _added(kept, vector, (many + 1, many), moments) / model.n
    error = float(np.abs(told[:-1] - np.outer(told[-1], told[-1]) - np.eye(many)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, *(c.split()[0] for c in WHITENED.split(", ")), "identity_error"]
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(start, AT_ONCE)
                whole = whole_numbers(part.column(vector))
                found = centred(whole, model.n, model.sums) @ scale
                rows = len(found) * many
                arrays = [
                    part.column(key).take(pa.array(np.repeat(np.arange(len(found)), many))),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(found))),
                    pa.array(np.full(rows, model.n)),
                    pa.array(np.repeat(deviations(whole, model.n, model.sums), many)),
                    pa.array(found.ravel()),
                    pa.array(np.tile(model.explained, len(found))),
                    pa.array(np.full(rows, error)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return kept.select(F.col(key).cast("long").alias(key), vector).mapInArrow(project, f"{schema}, identity_error double")


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is there and holds finite numbers only."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) != float("inf")))
    return rows.where(F.col(vector).isNotNull() & finite)


def whole_numbers(vectors: pa.Array) -> np.ndarray:
    """The entries as whole numbers, a row for each vector."""
    flat = pc.list_flatten(vectors).cast(pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.floor(STEP * flat.reshape(len(vectors), -1))
    if len(scaled) and np.abs(scaled).max() > 1 << 50:
        raise ValueError("entries are too large for exact sums")
    return scaled.astype(np.int64) + SHIFT


def centred(whole: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n: the whole mean is taken off exactly, then its remainder."""
    return (whole - sums // n) - (sums % n) / n


def deviations(whole: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """The exact sums of (n x - S)^2 over a row's entries."""
    away = n * whole - sums
    if len(away) and float(np.abs(away).max()) ** 2 * away.shape[1] >= 2.0**62:
        exact = [sum(int(v) ** 2 for v in row) for row in away.tolist()]
        if max(exact) >= 1 << 63:
            raise ValueError("the squared deviation of a vector goes beyond 64 bits")
        return np.array(exact, np.int64)
    return (away * away).sum(axis=1)


def _outer(rows: np.ndarray) -> np.ndarray:
    return rows.T @ rows


def _column_sums(kept: DataFrame, vector: str, size: int) -> tuple[int, np.ndarray]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(size, np.int64), 0
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                held += whole_numbers(batch.column(vector).slice(start, AT_ONCE)).sum(axis=0)
            n += batch.num_rows
        places = [pa.array(np.arange(size + 1)), pa.array(np.append(held, n))]
        yield pa.RecordBatch.from_arrays(places, names=["place", "total"])

    told = kept.select(vector).mapInArrow(add, "place long, total long").groupBy("place").agg(F.sum("total")).collect()
    totals = np.zeros(size + 1, np.int64)
    for place, total in told:
        totals[place] = total
    return int(totals[-1]), totals[:-1]


def _added(kept: DataFrame, vector: str, shape: tuple[int, int], work) -> np.ndarray:
    """The sum over all rows of the matrix that ``work`` makes of some rows; a matrix a task, added by rows of it."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(shape)
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                held += work(whole_numbers(batch.column(vector).slice(start, AT_ONCE)))
        values = pa.FixedSizeListArray.from_arrays(pa.array(held.ravel()), shape[1]).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(shape[0])), values], names=["line", "line_values"])

    def join(table: pa.Table) -> pa.Table:
        lines = np.stack(table.column("line_values").to_numpy())
        order = np.lexsort(lines.T)  # the same order of adding in every run
        values = pa.array([lines[order].sum(axis=0)], pa.list_(pa.float64()))
        return pa.table({"line": table.column("line")[:1].cast(pa.int64()), "line_values": values})

    # one row a task and line: a line's rows are as many as there are tasks
    told = kept.select(vector).mapInArrow(add, "line long, line_values array<double>")
    total = np.zeros(shape)
    for line, values in told.groupBy("line").applyInArrow(join, "line long, line_values array<double>").collect():
        total[line] = values
    return total


def inertia(matrix: np.ndarray, shift: float, scale: float) -> int:
    """How many eigenvalues lie above ``shift``: the positive ones of D in LDL^T of the shifted matrix.

    Pivots of one or two rows are chosen by the growth they allow (Bunch and Kaufman); what is left after each is
    updated in place. A pivot of nothing is taken as a tiny negative one, as if the shift lay a little higher.
    """
    left = matrix - shift * np.eye(len(matrix))
    tiny, bound = np.finfo(float).eps * max(scale, 1e-300), (1 + 17**0.5) / 8
    positive = 0
    while (size := len(left)) > 0:
        column = np.abs(left[1:, 0])
        far = int(column.argmax()) + 1 if size > 1 else 0
        reach = column[far - 1] if size > 1 else 0.0
        pair = False
        if reach > 0 and abs(left[0, 0]) < bound * reach:
            line = np.abs(left[far])
            line[far] = 0
            most = line.max()
            if abs(left[0, 0]) * most < bound * reach * reach:
                if abs(left[far, far]) >= bound * most:
                    _swap(left, 0, far)
                else:
                    _swap(left, 1, far)
                    pair = True
        if pair:
            block, below = left[:2, :2], left[2:, :2]
            # a pivot of two rows has one positive and one negative eigenvalue
            positive += 1
            left = left[2:, 2:] - below @ np.linalg.solve(block, below.T)
        else:
            pivot = left[0, 0] if abs(left[0, 0]) > tiny else -tiny
            positive += pivot > 0
            below = left[1:, 0]
            left = left[1:, 1:] - np.outer(below, below / pivot)
    return int(positive)


def _swap(matrix: np.ndarray, one: int, other: int) -> None:
    if one != other:
        matrix[[one, other]] = matrix[[other, one]]
        matrix[:, [one, other]] = matrix[:, [other, one]]


def leading_eigenpairs(matrix: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``many`` largest eigenvalues above zero, falling, and their unit vectors as columns."""
    matrix = (matrix + matrix.T) / 2
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max())
    if scale == 0:
        return np.zeros(0), np.zeros((size, 0))
    least = size * np.finfo(float).eps * scale
    top = scale * (1 + 1e-9)
    counts: dict[float, int] = {top: 0}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = inertia(matrix, shift, scale)
        return counts[shift]

    wanted = min(many, above(least))
    values, vectors = np.zeros(0), np.zeros((size, 0))
    while len(values) < wanted:
        number = len(values) + 1
        # the narrowest known interval of eigenvalue ``number``, halved until it is alone there
        low, high = _around(counts, number)
        while above(low) - above(high) > 1 and high - low > 2 * least:
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= number else (low, middle)
        many_here = min(above(low) - above(high), wanted - len(values))
        while True:
            found = _iterate(matrix, (low + high) / 2, low, high, values, vectors, scale, least, many_here)
            if found is not None:
                # counts on both sides certify the numbers
                value, basis = found
                reach = 4 * least + (high - low if many_here > 1 else 0)
                if above(value + reach) < number and above(value - reach) >= number - 1 + many_here:
                    break
            if high - low <= least:
                raise ArithmeticError(f"eigenvalue {number} could not be certified")
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= number else (low, middle)
        values = np.append(values, [basis[:, c] @ matrix @ basis[:, c] for c in range(basis.shape[1])])
        vectors = np.column_stack([vectors, basis])
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _around(counts: dict[float, int], number: int) -> tuple[float, float]:
    """The highest shift with at least ``number`` eigenvalues above it, and the lowest with fewer."""
    low = max(s for s, c in counts.items() if c >= number)
    return low, min(s for s, c in counts.items() if c < number and s > low)


def _close(values: np.ndarray, value: float, reach: float) -> np.ndarray:
    return np.flatnonzero(np.abs(values - value) <= reach)


def _iterate(matrix, shift, low, high, values, vectors, scale, least, many) -> tuple[float, np.ndarray] | None:
    """Rayleigh quotient iteration from a shift; None if it leaves the interval before it converges.

    Several eigenvalues that cannot be told apart are iterated as one space, at the fixed shift.
    """
    near = vectors[:, _close(values, shift, NEAR * scale)]
    block = np.random.default_rng(23).normal(size=(len(matrix), many))
    value, settled = shift, False
    for turn in range(40):
        shifted = matrix - value * np.eye(len(matrix))
        try:
            block = np.linalg.solve(shifted, block)
        except np.linalg.LinAlgError:
            block = np.linalg.solve(shifted + least * np.eye(len(matrix)), block)
        for _ in range(2):
            block -= near @ (near.T @ block)
            block, _ = np.linalg.qr(block)
        quotients = np.einsum("dc,dc->c", block, matrix @ block)
        reach = 2 * least
        rest = np.linalg.norm(matrix @ block - block @ (block.T @ matrix @ block))
        if settled:
            return (float(quotients.max()), block) if low - reach <= quotients.min() and quotients.max() <= high + reach else None
        # a last step takes the vectors from here to the last digits
        settled = turn > 1 and rest <= 4 * least
        # inverse iteration at the middle first, so that the quotient starts within the interval
        if many == 1 and turn >= 1:
            if not low - reach <= quotients[0] <= high + reach:
                return None
            value = float(quotients[0])
    return None
