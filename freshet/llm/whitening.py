"""Whitening by a Chebyshev-filtered subspace iteration over the stored vectors.

The covariance is never formed: each pass multiplies it by a narrow block, task by task, as the sum of centred X'(XQ).
A polynomial recurrence of such passes damps the unwanted end of the spectrum, then QR and Rayleigh-Ritz give components,
until the residuals of the wanted ones certify them. What reaches the driver is one number per dimension and column.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import stored, table

COMPONENTS, GUARD, DEGREE = 8, 16, 12
SCALE, SHIFT = 1024, 100_000
#: Entries beyond this times 1 / SCALE are taken as this, so that every x is a whole number in a double.
LARGEST = float(2**52)
#: A component is certified when its residual is below this part of the largest eigenvalue.
CERTIFIED = 4e-14
#: An eigenvalue below this part of the largest is zero up to rounding.
FLAT = 1e-13
BLOCK = 1024


def blocks(vectors: DataFrame, size: int = BLOCK) -> DataFrame:
    """Rows (ids, x, width): up to ``size`` usable vectors as a matrix of whole numbers, row after row.

    A usable vector is not null and holds no null and no non-finite entry. Shorter vectors of a block are filled up
    with zeros.
    """
    v = F.col("embedding").cast("array<double>")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.coalesce(sound, F.lit(False)))

    def pack(batches):
        for batch in batches:
            for first in range(0, len(batch), size):
                part = batch.slice(first, size)
                lists = part.column("v")
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                x = np.zeros((len(part), int(sizes.max())))
                x[np.arange(x.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
                x = np.clip(np.floor(SCALE * x), -LARGEST, LARGEST).astype(np.int64) + SHIFT
                ids = pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary()), pa.array([x.shape[1]], pa.int32())], names=["ids", "x", "width"])

    return rows.mapInArrow(pack, "ids array<long>, x binary, width int")


def _matrices(batches, width: int):
    """(ids, whole-number matrix of ``width`` columns) of each block."""
    for batch in batches:
        for ids, raw, own in zip(batch.column("ids"), batch.column("x"), batch.column("width"), strict=True):
            x = np.frombuffer(raw.as_py(), dtype=np.int64).reshape(len(ids), own.as_py())
            if own.as_py() < width:
                x = np.hstack([x, np.full((len(x), width - own.as_py()), SHIFT)])
            yield ids.values, x


def _summed(made: DataFrame, work, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all blocks of the array that ``work`` gives for each; added up per task and then per place."""
    size = int(np.prod(shape))

    def run(batches):
        total = np.zeros(size)
        for part in work(batches):
            total += part.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["place", "value"])

    rows = made.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size)
    for row in rows:
        out[row["place"]] = row["value"]
    return out.reshape(shape)


@dataclass(frozen=True)
class Fit:
    """Count, exact sums per dimension, and components: eigenvalues falling, vectors as columns."""

    n: int
    sums: list[int]
    reach: int
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def exact_sums(made: DataFrame) -> tuple[int, list[int], int]:
    """Rows, exact sum of x per dimension, and the largest distance between two x of the table."""
    head = made.agg(F.sum(F.size("ids")).alias("n"), F.max("width").alias("width")).first()
    n, width = head["n"] or 0, head["width"] or 0
    if not n or not width:
        return n, [], 0

    def run(batches):
        sums, low, high = [0] * width, SHIFT, SHIFT
        for _, x in _matrices(batches, width):
            # halves of 32 bits, so that no sum of a block leaves 64 bits
            top, rest = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            sums = [s + (int(t) << 32) + int(r) for s, t, r in zip(sums, top, rest, strict=True)]
            low, high = min(low, int(x.min())), max(high, int(x.max()))
        exact = pa.array([str(s) for s in sums]).cast(pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), exact, pa.array([low] * width), pa.array([high] * width)], names=["place", "total", "low", "high"])

    rows = made.mapInArrow(run, "place int, total decimal(38,0), low long, high long").groupBy("place").agg(F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    rows.sort(key=lambda r: r["place"])
    return n, [int(r["total"]) for r in rows], max(r["high"] for r in rows) - min(r["low"] for r in rows)


def _times(made: DataFrame, mean: np.ndarray, n: int, block: np.ndarray) -> np.ndarray:
    """The covariance times ``block``: one pass over the vectors, centred before multiplying."""
    width = len(mean)

    def work(batches):
        for _, x in _matrices(batches, width):
            centred = x - mean
            yield centred.T @ (centred @ block)

    return _summed(made, work, block.shape) / n


class _LowEnd:
    """Lanczos steps of one more column, riding on the first filter's passes; they bound the spectrum from below."""

    def __init__(self, width: int, draw: np.random.Generator):
        start = draw.normal(size=width)
        self.basis, self.diagonal, self.beside = [start / np.linalg.norm(start)], [], []

    @property
    def column(self) -> np.ndarray:
        return self.basis[-1][:, None]

    def step(self, image: np.ndarray) -> None:
        q = self.basis[-1]
        self.diagonal.append(q @ image)
        rest = image.copy()
        for _ in range(2):
            for b in self.basis:
                rest -= (b @ rest) * b
        self.beside.append(np.linalg.norm(rest))
        self.basis.append(rest / self.beside[-1] if self.beside[-1] > 0 else np.zeros_like(rest))

    def bound(self) -> float:
        k = len(self.diagonal)
        inner = np.diag(self.diagonal) + np.diag(self.beside[: k - 1], 1) + np.diag(self.beside[: k - 1], -1)
        return max(0.0, float(np.linalg.eigvalsh(inner)[0] - self.beside[-1]))


def fit(made: DataFrame, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE, rounds: int = 40) -> Fit | None:
    """The leading components of the stored ``made``; None without a vector or dimension. Raises if not certified."""
    n, sums, reach = exact_sums(made)
    if not n or not sums:
        return None
    width, wanted = len(sums), min(components, len(sums))
    mean = np.array([s / n for s in sums])

    def spread(batches):
        for _, x in _matrices(batches, width):
            centred = x - mean
            yield np.array([(centred * centred).sum()])

    trace = float(_summed(made, spread, (1,))[0]) / n
    draw = np.random.default_rng(0)
    q = np.linalg.qr(draw.normal(size=(width, min(width, wanted + guard))))[0]
    if trace == 0:
        return Fit(n, sums, reach, 0.0, np.zeros(wanted), q[:, :wanted], 0)
    passes, before, low, lanczos = 0, np.inf, 0.0, _LowEnd(width, draw)
    for _ in range(rounds):
        # Rayleigh-Ritz on the block; the same product gives the residuals
        image = _times(made, mean, n, q)
        passes += 1
        inner = q.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        residual = np.linalg.norm(image - q * values, axis=0)[:wanted].max() / values[0]
        if q.shape[1] == width or residual <= CERTIFIED or (residual < 1e-12 and residual > before / 2):
            return Fit(n, sums, reach, trace, values[:wanted], q[:, :wanted], passes)
        before = residual
        # the recurrence: damps [low, high], grows fastest at the top
        high = max(float(values[-1]), low + 1e-6 * float(values[0]))
        half, centre = (high - low) / 2, (high + low) / 2
        first = half / (float(values[0]) - centre)
        sigma, old, now = first, q, (image - centre * q) * (first / half)
        for _ in range(degree - 1):
            if len(lanczos.diagonal) < min(degree - 1, width):
                both = _times(made, mean, n, np.hstack([now, lanczos.column]))
                image = both[:, :-1]
                lanczos.step(both[:, -1])
            else:
                image = _times(made, mean, n, now)
            passes += 1
            following = 1 / (2 / first - sigma)
            old, now = now, (image - centre * now) * (2 * following / half) - sigma * following * old
            sigma = following
        low = min(lanczos.bound(), high)
        q = np.linalg.qr(now)[0]
    raise RuntimeError(f"components are not certified after {rounds} rounds")


def identity_error(made: DataFrame, model: Fit, weights: np.ndarray) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured over all rows."""
    k = weights.shape[1]
    if not k:
        return None
    mean = model.mean

    def sums(batches):
        for _, x in _matrices(batches, len(mean)):
            yield ((x - mean) @ weights).sum(axis=0)

    middle = _summed(made, sums, (k,)) / model.n

    def products(batches):
        for _, x in _matrices(batches, len(mean)):
            w = (x - mean) @ weights - middle
            yield w.T @ w

    return float(np.abs(_summed(made, products, (k, k)) / model.n - np.eye(k)).max())


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per usable vector and component.

    ``vectors`` has vec_id and embedding; further columns are ignored. Null vectors and those with null or non-finite
    entries are dropped; shorter vectors are filled up with zeros; repeated rows and null ids stay, each row by itself.
    Entries beyond 2^42 in size are taken as that. A deviation that no long holds is null. With fewer dimensions than
    ``components`` there are that many components; one without variance has null ``whitened`` and takes no part in
    ``identity_error``, which is null where all are so; ``explained`` is null where nothing varies. An empty table gives no rows.
    """
    made = stored(blocks(vectors), "whitening-blocks")
    model = fit(made, components)
    if model is None:
        return made.sparkSession.createDataFrame([], _OUT)
    mean, width = model.mean, len(model.sums)
    live = model.values > FLAT * model.values[0]
    scale = np.where(live, 1 / np.sqrt(np.where(live, model.values, 1)), np.nan)
    weights = model.vectors * np.where(live, scale, 0)
    error = identity_error(made, model, weights[:, live])
    explained = [float(v / model.trace) if model.trace else None for v in model.values]
    n, k, sums = model.n, len(model.values), model.sums
    fits_long = width * (n * model.reach) ** 2 < 2**62

    def deviations(x: np.ndarray) -> list[int | None]:
        if fits_long:
            away = n * x - np.array(sums, dtype=np.int64)
            return (away * away).sum(axis=1).tolist()
        exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
        return [d if d < 2**63 else None for d in exact]

    def run(batches):
        for ids, x in _matrices(batches, width):
            m = len(x)
            whitened = ((x - mean) @ weights).ravel()
            flat = np.tile(~live, m)
            columns = [
                ids.take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)),
                pa.array(deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(whitened, mask=flat),
                pa.array(explained * m, pa.float64()),
                pa.array([error] * (m * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, _KINDS, strict=True)], names=[f.split()[0] for f in _OUT.split(", ")])

    return made.mapInArrow(run, _OUT)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
