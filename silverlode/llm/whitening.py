"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, so their sums per dimension, and with them the
centring of rows, are exact. The centred rows are a matrix X that stays where it
is. Two products alternate, ``X v`` and the transpose of X times ``u``: each task makes both for its
rows and passes on sums of fixed size. A left vector is kept as the combination of
columns that makes it (``u = X y``), so tasks make any of them again from their rows, nothing
as long as the table is written, and a lost executor costs its tasks alone.
Both sides are fully reorthogonalised, twice; the left side by the inner products
that the tasks sum up. The bidiagonal matrix is small: its singular vectors
give the components, its singular values the deviations.

``block`` vectors advance together (1 gives the plain form), so a pass over the
table serves all of them and vectors of equal deviation cannot hide each other.
Where a direction gives nothing new, a fresh one takes its place until the wanted
components have converged or the space is used up.

Rows whose vector is null, empty, or holds null, NaN, infinite or absurdly large
entries (2 ** 50 and more) take no part, nor do those of another length than most
vectors have (of equally frequent lengths the longest counts). Null and repeated
ids are kept. Directions without any deviation have no component; so one row, or
equal rows, give no result. Further columns are left out; an empty table gives no
rows. Components of equal deviation are any basis of their space; of either sign
the one whose largest entry is positive is taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
BLOCK = 8
SCALE, SHIFT = 64, 1_000_000
# A singular value below this share of the largest is none.
RANK_TOLERANCE = 1e-12
# A component has converged when its residual is below this share of the largest singular value.
TOLERANCE = 1e-14
# Entries that a task turns into doubles at a time.
ENTRIES = 1 << 20


class Whitening(NamedTuple):
    """What is known of the fit list; ``axes`` holds one component per column."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    total_variance: float
    identity_error: float
    passes: int


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, entries`` of the rows that take part."""
    entries = F.col(vector).cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= float(2**50)))
    rows = vectors.select(F.col(key).alias("key"), entries.alias("entries")).filter((F.size(entries) > 0) & ~bad)
    lengths = rows.groupBy(F.size("entries").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return rows.filter(F.size("entries") == (most["length"] if most else 0))


def _whole(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
    """The whole-number rows of a batch, a bounded number of entries at a time, and where they begin."""
    lists = batch.column(column)
    if len(lists):
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        rows = flat.reshape(len(lists), -1)
        step = max(1, ENTRIES // rows.shape[1])
        for at in range(0, len(rows), step):
            yield at, np.floor(SCALE * rows[at : at + step]).astype(np.int64) + SHIFT


def _total(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int, kind: str) -> list:
    """The sum over all rows of what ``part`` gives for some of them: ``size`` numbers."""
    number = np.float64 if kind == "double" else np.int64

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, number)
        for batch in batches:
            for _, x in _whole(batch, 0):
                sums += part(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(sums)], names=["place", "part"])

    parts = rows.select("entries").mapInArrow(add, f"place int, part {kind}")
    exact = F.col("part").cast("decimal(38,0)") if kind == "long" else F.col("part")
    total = dict(parts.groupBy("place").agg(F.sum(exact)).collect())
    return [total.get(i, 0) for i in range(size)]


def _sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums per dimension; halves of the numbers keep the tasks' sums within 64 bits."""

    def halves(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], (x >> 28).sum(0), (x & (2**28 - 1)).sum(0)])

    found = [int(v) for v in _total(rows, halves, 1 + 2 * width, "long")]
    return found[0], [(hi << 28) + lo for hi, lo in zip(found[1 : 1 + width], found[1 + width :])]


def _centring(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """Rows less the mean: first its whole part, exactly, then the fraction."""
    whole = np.array([s // n for s in sums])
    fraction = np.array([(s % n) / n for s in sums])
    return lambda x: (x - whole) - fraction


def _less(r: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """What is left of the columns outside the basis; twice is enough."""
    for _ in range(2):
        r = r - basis @ (basis.T @ r)
    return r


def _orthonormal(
    products: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], y: np.ndarray, made: np.ndarray, images: np.ndarray, largest: float
) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Combinations whose left vectors are orthonormal to each other and to earlier ones, and their images.

    A pass gives all inner products; a second one follows where the first shows that much was taken away or that
    the vectors lie close together. Directions that X takes to rounding errors are dropped.
    """
    for attempt in range(1, 4):
        inner, image = products(y)
        along = made.T @ image  # inner products with the earlier left vectors
        y, image, inner = y - made @ along, image - images @ along, inner - along.T @ along
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        y, image, sizes = y @ turn, image @ turn, np.sqrt(np.maximum(values, 0.0))
        norms = np.linalg.norm(y, axis=0)
        largest = max(largest, float((sizes / norms).max()))
        kept = sizes > RANK_TOLERANCE * largest * norms
        y, image, sizes = y[:, kept] / sizes[kept], image[:, kept] / sizes[kept], sizes[kept]
        if not len(sizes) or (sizes.min() >= 1e-3 * sizes.max() and np.abs(along).max(initial=0.0) <= 1e-10 * sizes.min()):
            break
    return y, image, largest, attempt


def bidiagonalise(
    products: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], width: int, wanted: int, block: int = BLOCK
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Right singular vectors (columns) and values of X, largest first; the (block) bidiagonal matrix; the passes.

    ``products(y)`` gives the inner products of the columns of ``X y`` with each other, and the transpose of X times
    ``X y``. The largest ``wanted`` have converged; values that are nothing beside the largest are left out.
    """
    rng = np.random.default_rng(0)
    v = np.linalg.qr(rng.standard_normal((width, min(block, width))))[0]
    right, largest, passes = v, 0.0, 0
    # Left vectors as combinations of columns, and the transpose of X times each.
    made, images = np.zeros((width, 0)), np.zeros((width, 0))
    while True:
        # u = X v, less what earlier left vectors give.
        y, image, largest, used = _orthonormal(products, v - made @ (images.T @ v), made, images, largest)
        passes += used
        made, images = np.hstack([made, y]), np.hstack([images, image])
        band = images.T @ right
        p, s, q = np.linalg.svd(band, full_matrices=False)
        # v = X'u, less what earlier right vectors give.
        rest = _less(image, right)
        left = width - right.shape[1]
        if not left:
            break
        fresh, sizes, _ = np.linalg.svd(rest, full_matrices=False)
        fresh = fresh[:, sizes > 1e-13 * largest][:, :left]
        residuals = np.linalg.norm(rest @ p[len(band) - image.shape[1] :], axis=0)
        if fresh.shape[1] == v.shape[1] and len(s) >= wanted and (residuals[:wanted] <= TOLERANCE * largest).all():
            break
        missing = min(v.shape[1], left) - fresh.shape[1]
        if missing > 0:
            fresh = np.hstack([fresh, rng.standard_normal((width, missing))])
        v = np.linalg.qr(_less(fresh, right))[0]
        v = np.linalg.qr(_less(v, right))[0]
        right = np.hstack([right, v])
    found = s > RANK_TOLERANCE * largest
    return right @ q[found].T, s[found], band, passes


def fit(rows: DataFrame, components: int = COMPONENTS, block: int = BLOCK) -> Whitening | None:
    """Components of usable rows, largest deviation first; None for no rows."""
    first = rows.first()
    if first is None:
        return None
    width = len(first["entries"])
    n, sums = _sums(rows, width)
    centred = _centring(n, sums)

    def products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = y.shape[1]

        def both(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            u = c @ y
            return np.concatenate([(u.T @ u).ravel(), (c.T @ u).ravel()])

        total = np.array(_total(rows, both, k * k + width * k, "double"))
        return total[: k * k].reshape(k, k), total[k * k :].reshape(width, k)

    axes, values, _, passes = bidiagonalise(products, width, min(components, width), block)
    axes, variances = axes[:, :components], values[:components] ** 2 / n
    signs = np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    axes = axes * signs
    k = axes.shape[1]

    def moments(x: np.ndarray) -> np.ndarray:
        c = centred(x)
        z = c @ axes / np.sqrt(variances)
        return np.concatenate([[(c * c).sum()], z.sum(0), (z.T @ z).ravel()])

    total = np.array(_total(rows, moments, 1 + k + k * k, "double"))
    mean = total[1 : 1 + k] / n
    covariance = total[1 + k :].reshape(k, k) / n - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(k)).max(initial=0.0))
    return Whitening(n, sums, axes, variances, total[0] / n, error, passes)


def whitened(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """``key, component, deviation, whitened`` of usable rows, one row for each component from 1.

    ``deviation`` is the sum over dimensions of (n x - sum) squared, exactly; null where a long cannot hold it.
    """
    schema = f"key {dict(rows.dtypes)['key']}, component int, deviation long, whitened double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    n, sums, axes, variances = model[:4]
    centred = _centring(n, sums)
    whole, fraction = np.array([s // n for s in sums]), np.array([s % n for s in sums])
    scaled = axes / np.sqrt(variances)
    k = axes.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _whole(batch, 1):
                z = centred(x) @ scaled
                # Whole numbers wrap around, so what fits a long is right whatever lies between.
                exact = ((n * (x - whole) - fraction) ** 2).sum(1)
                about = ((n * (x - whole).astype(np.float64) - fraction) ** 2).sum(1)
                keys = batch.column(0).take(pa.array(np.repeat(np.arange(at, at + len(x)), k)))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.repeat(exact, k), mask=np.repeat(about >= 2.0**63 * (1 - 1e-9), k)),
                        pa.array(z.ravel()),
                    ],
                    names=["key", "component", "deviation", "whitened"],
                )

    return rows.select("key", "entries").mapInArrow(project, schema)


def whiten(vectors: DataFrame, key: str, vector: str, components: int = COMPONENTS, block: int = BLOCK) -> DataFrame:
    """Whitened coordinates of all usable rows on the components of all of them.

    ``key, component, n, deviation, whitened, explained, identity_error``: the share of the variance that the
    component explains, and by how much the covariance of the coordinates misses the identity at most.
    """
    rows = usable(vectors, key, vector)
    model = fit(rows, components, block)
    share = F.lit(None).cast("double")
    if model is not None and len(model.variances):
        share = F.element_at(F.array(*[F.lit(float(e / model.total_variance)) for e in model.variances]), F.col("component"))
    return whitened(rows, model).select(
        "key",
        "component",
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        share.alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
