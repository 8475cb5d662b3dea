"""Whitening of embeddings: principal directions scaled to unit variance."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import narrow
from ebbtide.llm.folding import folded
from ebbtide.llm.singular import EPS, right_singular

BLOCK = 2048
SCALE, SHIFT = 64, 1_000_000
#: A vector with an entry beyond has no place among 64-bit integers.
LARGEST = 2.0**62
_LOW = np.int64((1 << 32) - 1)


def _taken(batch: pa.RecordBatch, size: int):
    """Ids and integer vectors of the usable rows of ``size`` entries, in blocks."""
    column = batch.column(1)
    ids = batch.column(0).filter(pa.compute.equal(column.value_lengths(), size).fill_null(False))
    column = column.filter(pa.compute.equal(column.value_lengths(), size).fill_null(False))
    for i in range(0, len(column), BLOCK):
        part = column.slice(i, BLOCK).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = np.floor(SCALE * part)
            fine = (np.abs(scaled) < LARGEST).all(1)
        if fine.any():
            yield ids.slice(i, BLOCK).filter(pa.array(fine)), scaled[fine].astype(np.int64) + SHIFT


@dataclass
class Whitening:
    """A fitted whitening: ``n`` vectors, their integer sums, directions and variances."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n`` from exact integers, rounded once."""
        whole = [s // self.n for s in self.sums]
        rest = [(s - w * self.n) / self.n for s, w in zip(self.sums, whole)]
        return (x - np.array(whole, np.int64)).astype(float) - np.array(rest)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n * x - sums) ** 2`` over the entries; None beyond 64 bits."""
        whole = [s // self.n for s in self.sums]
        rest = [s - w * self.n for s, w in zip(self.sums, whole)]
        y = x - np.array(whole, np.int64)
        far = (int(np.abs(y).max()) + 1) * self.n
        if far * far * len(whole) >= 1 << 63:
            y, rest = y.astype(object), np.array(rest, object)
        else:
            rest = np.array(rest, np.int64)
        found = ((y * self.n - rest) ** 2).sum(1).tolist()
        return [d if d < 1 << 63 else None for d in found]


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number and integer sums of the usable vectors of the most frequent length (the longest of several)."""

    def run(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for size in pa.compute.unique(batch.column(1).value_lengths()).to_pylist():
                for _, x in _taken(batch, size) if size else ():
                    of = found.setdefault(size, [0, [0] * size])
                    high, low = (x >> 32).sum(0).tolist(), (x & _LOW).sum(0).tolist()
                    of[0] += len(x)
                    of[1] = [s + (h << 32) + l for s, h, l in zip(of[1], high, low)]
        for size, (n, sums) in found.items():
            values = pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))
            names = ["size", "entry", "n", "s"]
            yield pa.RecordBatch.from_arrays([pa.array([size] * size), pa.array(range(size)), pa.array([n] * size), values], names)

    parts = vectors.mapInArrow(run, "size long, entry long, n long, s decimal(38, 0)")
    sums = parts.groupBy("size", "entry").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    usual = sums.where("entry = 0").orderBy(F.desc("n"), F.desc("size")).limit(1).select("size")
    rows = sorted(sums.join(usual, "size").collect(), key=lambda r: r["entry"])
    return (rows[0]["n"], [int(r["s"]) for r in rows]) if rows else (0, [])


def fit_whitening(vectors: DataFrame, components: int) -> Whitening | None:
    """Fitted on all usable rows of ``id, vector``; None without any.

    A pass sums the integer vectors, one reduces the centred rows block by block to a triangular
    matrix per partition, merged in a tree; its singular values and directions are found at the driver,
    from as many numbers as a vector has entries, squared. A last pass measures the covariance of
    what comes out.
    """
    n, sums = _sums(vectors)
    if not n:
        return None
    size = len(sums)
    fit = Whitening(n, sums, np.eye(size), np.ones(size), 0.0)

    def reduced(rows: np.ndarray) -> np.ndarray:
        return np.linalg.qr(rows, mode="r")

    def triangle(batches) -> bytes | None:
        r = np.empty((0, size))
        for batch in batches:
            for _, x in _taken(batch, size):
                r = reduced(np.concatenate([r, fit.centred(x)]))
        return r.tobytes() if len(r) else None

    def merged(a: bytes, b: bytes) -> bytes:
        return reduced(np.concatenate([np.frombuffer(a).reshape(-1, size), np.frombuffer(b).reshape(-1, size)])).tobytes()

    r = np.frombuffer(folded(vectors, triangle, merged)).reshape(-1, size)
    r = np.concatenate([r, np.zeros((size - len(r), size))])
    squares, directions = right_singular(r)
    # below this share of the largest, a singular value is what rounding leaves of zero
    some = min(components, int((squares > squares[0] * (size * EPS) ** 2).sum()))
    fit = Whitening(n, sums, directions[:, :some], squares[:some] / n, float((r * r).sum()) / n)

    def products(batches) -> bytes | None:
        found = np.zeros((some + 1, some))
        for batch in batches:
            for _, x in _taken(batch, size):
                w = fit.whitened(x)
                found[0] += w.sum(0)
                found[1:] += w.T @ w
        return found.tobytes()

    def added(a: bytes, b: bytes) -> bytes:
        return (np.frombuffer(a) + np.frombuffer(b)).tobytes()

    if some:
        found = np.frombuffer(folded(vectors, products, added)).reshape(-1, some) / n
        fit.identity_error = float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(some)).max())
    return fit


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32
) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: a row per vector and component.

    Entries ``c`` become the integers ``floor(64 * c) + 1000000``. Components are the unit eigenvectors of their
    covariance (divisor ``n``) by falling variance; ``whitened`` is the centred vector along one, over
    its standard deviation; ``explained`` the share of all variance; ``deviation`` the exact sum of
    ``(n * x - S) ** 2`` (null beyond 64 bits), with ``S`` the sums; ``identity_error`` the largest
    difference of the covariance of all that is returned from the identity.

    Left out are vectors that are null, empty, hold a null or non-finite entry or one beyond 2**56, and
    those of another than the most frequent length. Components without variance (constant or dependent
    entries, fewer rows than entries) are left out too; equal variances take any orthonormal directions. Null
    and repeated ids pass as they are, other columns don't matter, an empty table gives no rows.
    """
    rows = narrow(vectors, id=id_col, vector=vector_col)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = fit_whitening(rows, components)

    def run(batches):
        for batch in batches:
            for ids, x in _taken(batch, len(fit.sums)) if fit else ():
                w = fit.whitened(x)
                rows, some = w.shape
                each = np.repeat(np.arange(rows), some)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, some + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * some, fit.n, np.int64)),
                        pa.array(fit.deviations(x), pa.int64()).take(pa.array(each)),
                        pa.array(w.ravel()),
                        pa.array(np.tile(fit.variances / fit.total, rows) if some else np.empty(0)),
                        pa.array(np.full(rows * some, fit.identity_error)),
                    ],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema)
