"""Decorrelated embeddings, whitened by an exact covariance.

Cross-covariances come by polarisation: tasks add up squares only, of every dimension's
centred value and of every pair of dimensions' sum, and 2 cov(i, j) is the variance of the
sum less both variances. Entries are whole numbers, so all sums are exact whatever the order
of rows and tasks. Three passes read the vectors: sums, squares, projection. A task sends
one row per pair of dimensions, which the shuffle adds up; the driver holds one number per
pair and the square matrix of its eigenvectors, sizes that the vectors' width fixes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewise.functions import column
from gradewise.llm.text import fresh, show_code
from gradewise.sources.scratch import materialize

# x = floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 1024, 100_000

#: Entries beyond are taken as this far out, so that x is a long.
LARGEST = 1 << 62
#: Sums of squares stay in 64 bits while entries are within SMALL and a task adds ROWS rows at a time.
SMALL, ROWS = 1 << 21, 1 << 16
#: Whole numbers of any size travel as digits to the base 2**32, the last one signed; they add up digit by digit.
DIGITS = 8
#: Eigenvalues of at most this share of the largest are zero but for rounding.
ZERO = 1e-13


def _digits() -> list[str]:
    return [f"d{k}" for k in range(DIGITS)]


def to_digits(value: int) -> list[int]:
    low = [(value >> (32 * k)) & 0xFFFFFFFF for k in range(DIGITS - 1)]
    return [*low, value >> (32 * (DIGITS - 1))]


def from_digits(digits) -> int:
    return sum(int(d) << (32 * k) for k, d in enumerate(digits))


def usable(vector: Column) -> Column:
    """True for vectors that are there and hold neither null nor NaN nor infinite entries."""
    out = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~out


def whole_numbers(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of x, ``width`` wide; missing entries of shorter vectors are 0."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    entries = np.zeros((len(lengths), width))
    entries[np.arange(width) < lengths[:, None]] = flat
    with np.errstate(over="ignore"):  # what overflows is held at LARGEST
        scaled = np.clip(np.floor(SCALE * entries), -LARGEST, LARGEST)
    return scaled.astype(np.int64) + SHIFT


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield pa.concat_arrays([batch.column(0).slice(at, ROWS)])


def _send(values: dict[tuple[int, int], int]) -> Iterator[pa.RecordBatch]:
    if values:
        rows = [(i, j, *to_digits(v)) for (i, j), v in values.items()]
        types = [pa.int32(), pa.int32(), *[pa.int64()] * DIGITS]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["i", "j", *_digits()])


def _sums(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Sum of x by dimension, and the number of rows at (-1, -1)."""
    rows, totals = 0, [0] * width
    for vectors in _parts(batches):
        x = whole_numbers(vectors, width)
        rows += len(x)
        small = not x.size or np.abs(x).max() <= 1 << 46
        totals = [a + int(b) for a, b in zip(totals, (x if small else x.astype(object)).sum(0))]
    if rows:
        yield from _send({(-1, -1): rows} | {(i, i): t for i, t in enumerate(totals)})


def _squares(batches: Iterator[pa.RecordBatch], centre: list[int]) -> Iterator[pa.RecordBatch]:
    """Sums of squares of each dimension (i, i) and of each pair's sum (i, j) around ``centre``."""
    width = len(centre)
    totals: dict[tuple[int, int], int] = {}
    for vectors in _parts(batches):
        x = whole_numbers(vectors, width)
        y = x.astype(object) - np.array(centre, object) if _is_wide(x, centre) else x - np.array(centre, np.int64)
        for i in range(width):
            own = y[:, i]
            sums = y[:, i + 1 :] + own[:, None]
            for j, value in enumerate([(own * own).sum(), *(sums * sums).sum(0)], i):
                totals[i, j] = totals.get((i, j), 0) + int(value)
    yield from _send(totals)


def _is_wide(x: np.ndarray, centre: list[int]) -> bool:
    if not x.size:
        return False
    far = max(max(abs(int(x.max())), abs(int(x.min()))), max(abs(c) for c in centre))
    return far > LARGEST // 4 or np.abs(x - np.array(centre, np.int64)).max() > SMALL


def _added(vectors: DataFrame, summing) -> dict[tuple[int, int], int]:
    """What the tasks found, added up: one number per pair of dimensions."""
    schema = "i int, j int, " + ", ".join(f"{d} long" for d in _digits())
    found = vectors.mapInArrow(summing, schema).groupBy("i", "j").agg(*[F.sum(d).alias(d) for d in _digits()])
    return {(r.i, r.j): from_digits(r[2:]) for r in found.collect()}  # fixed by the vectors' width


@dataclass
class Whitening:
    """Exact sums over ``n`` vectors, their covariance, and its unit eigenvectors by falling eigenvalue."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    eigenvalues: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        """Each eigenvalue's share of the trace, 0 if nothing varies."""
        trace = float(np.trace(self.covariance))
        return self.eigenvalues / trace if trace > 0 else np.zeros(len(self.sums))

    @property
    def varies(self) -> np.ndarray:
        """Which eigenvalues are more than rounding."""
        return self.eigenvalues > max(ZERO * float(self.eigenvalues.max(initial=0)), 0)


def _rows(vectors: DataFrame, vector: str) -> DataFrame:
    return vectors.filter(usable(column(vector))).select(column(vector).cast("array<double>").alias("vector"))


def fit_whitening(vectors: DataFrame, vector: str = "embedding") -> Whitening:
    """Mean and covariance of all usable vectors' whole numbers x, exact but for one last division.

    Vectors that are null or hold null, NaN or infinite entries are left out. Shorter vectors
    end in zeros. Entries too far out for a long count as ``LARGEST``. Repeated rows count as
    often as they come. Without vectors, or with empty ones only, there is no component.
    """
    show_code(vectors)
    rows = _rows(vectors, vector)
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    if width == 0:
        none = np.zeros((0, 0))
        return Whitening(rows.count(), [], none, none[0:0].ravel(), none)
    sums = _added(rows, partial(_sums, width=width))
    n, totals = sums[-1, -1], [sums[i, i] for i in range(width)]
    centre = [round(t / n) if abs(t) < 1 << 52 else t // n for t in totals]
    squares = _added(rows, partial(_squares, centre=centre))
    # Sums of squares around the mean, times n * n: the whole centre's remainder is taken out.
    rest = [t - n * c for t, c in zip(totals, centre)]
    own = [n * squares[i, i] - rest[i] ** 2 for i in range(width)]
    covariance = np.empty((width, width))
    for i in range(width):
        covariance[i, i] = own[i] / n**2
        for j in range(i + 1, width):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            covariance[i, j] = covariance[j, i] = (both - own[i] - own[j]) / (2 * n**2)
    values, unit = np.linalg.eigh(covariance)
    return Whitening(n, totals, covariance, np.maximum(values[::-1], 0), unit[:, ::-1].copy())


def _projected(batches: Iterator[pa.RecordBatch], model: Whitening, components: int) -> Iterator[pa.RecordBatch]:
    """Deviation and whitened values of each row, behind its other columns."""
    width, n = len(model.sums), model.n
    centre = [t // n for t in model.sums]
    rest = [t - n * c for t, c in zip(model.sums, centre)]
    kept = model.varies[:components]
    unit = np.where(kept, model.vectors[:, :components] / np.sqrt(np.where(kept, model.eigenvalues[:components], 1)), 0)
    means = np.array([r / n for r in rest])
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            x = whole_numbers(pa.concat_arrays([part.column(0)]), width)
            wide = _is_wide(x, centre)
            y = x.astype(object) - np.array(centre, object) if wide else x - np.array(centre, np.int64)
            whitened = (y.astype(np.float64) - means) @ unit
            far = 0 if not y.size else int(np.abs(y).max()) + 1
            if wide or (n * far) ** 2 * width >= 1 << 62:
                y = y.astype(object)
            apart = n * y - np.array(rest, y.dtype)
            deviation = [d if d < 1 << 63 else None for d in map(int, (apart * apart).sum(1))]
            lists = pa.ListArray.from_arrays(
                np.arange(len(x) + 1, dtype=np.int32) * whitened.shape[1], np.ascontiguousarray(whitened).ravel()
            )
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(deviation, pa.int64()), lists],
                [*part.schema.names[1:], "deviation", "whitened"],
            )


def whiten(
    vectors: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding", components: int = 8
) -> DataFrame:
    """The key of each usable vector, ``deviation`` and the array ``whitened``.

    The deviation is the sum over dimensions of (n * x - sum)**2, exact, null where a long
    cannot hold it. A whitened value is the centred x along a component over the root of its
    eigenvalue, 0 where nothing varies. Fewer dimensions than ``components`` give as many
    values. Other columns play no part.
    """
    show_code(vectors)
    rows = vectors.filter(usable(column(vector))).select(
        column(vector).cast("array<double>").alias(fresh([key], "vector")), column(key)
    )
    kind = dict(rows.dtypes)[key]
    schema = f"`{key.replace('`', '``')}` {kind}, deviation long, whitened array<double>"
    if not model.sums:
        empty = F.array().cast("array<double>").alias("whitened")
        return rows.select(column(key), F.lit(0).cast("long").alias("deviation"), empty)
    return rows.mapInArrow(partial(_projected, model=model, components=components), schema)


def identity_error(whitened: DataFrame, model: Whitening, components: int = 8) -> float:
    """How far the whitened values' covariance, as computed from them, is off the identity at most.

    Components along which nothing varies are left out; without any other it is 0.
    """
    places = [int(i) for i in np.flatnonzero(model.varies[:components])]
    pairs = [(i, j) for i in places for j in places if i <= j]
    if not pairs:
        return 0.0
    value = F.col("whitened")
    found = whitened.agg(*[F.covar_pop(value[i], value[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def whitened_components(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8
) -> DataFrame:
    """A row per usable vector and component: ``component, n, deviation, whitened, explained, identity_error``.

    Components are numbered from 1 by falling eigenvalue. ``fit_whitening`` and ``whiten``
    say what becomes of odd vectors; an empty table gives an empty one.
    """
    model = fit_whitening(vectors, vector)
    # Written, as the covariance of the result is measured before its rows are returned.
    rows = materialize(whiten(vectors, model, key, vector, components), "whitened")
    error = identity_error(rows, model, components)
    explained = F.array(*[F.lit(float(e)) for e in model.explained[:components]]).cast("array<double>")
    return rows.select(column(key), "deviation", F.posexplode("whitened").alias("place", "value")).select(
        column(key),
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
