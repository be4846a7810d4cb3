"""Whitening of vectors on whole-number coordinates, each distinct vector fitted and whitened once.

A component c of a vector becomes ``x = floor(1024 * c) + 100000``. With n vectors and sums S per dimension, vectors are
centred at S / n, rotated to the eigenvectors of their covariance (divisor n) and divided by the square roots of the
eigenvalues.

1. Identical x vectors are grouped; a group counts with its *multiplicity* (``weights="counts"``) or once (``"one"``).
   Copies collapse in each task before the shuffle, so a vector that a third of all rows hold is one row per task.
2. S and n are exact: sums of weight times x in two halves of 31 bits.
3. The covariance is one weighted product of centred matrices per batch, ``(w * y)ᵀ y``. Entries are centred as the whole
   number ``n * x - S`` over n, before anything is multiplied. Only width² sums per task are shuffled.
4. Its eigenvectors rotate the vectors, and the same product in the rotated axes corrects them by Jacobi rotations:
   small eigenvalues are then exact to their own size, also beside one that is many orders larger.
5. Every distinct vector is whitened once and written; rows are joined with it by a 128-bit hash of x.

Defined results: vectors that are missing, empty, hold a missing or non-finite component, or whose width is not the most
frequent one (ties: the largest) take no part. A component too large for ``LARGEST`` counts as ``LARGEST`` with its sign.
A component without variance, as with one vector or equal ones, has ``whitened`` missing and ``explained`` 0 (missing
if all variance is 0). ``deviation`` is missing where it exceeds a long. Rows that repeat an id are whitened each; a missing
id stays missing; an empty table gives an empty result. Eigenvectors point so that their largest entry is positive.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import lookup
from tickloom.session import materialize

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = 1 << 52
HALF_BITS = 31


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, x`` of the vectors that take part; ``x`` an array of longs of one width."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = vectors.where((F.size(v) > 0) & finite).select(F.col(f"`{id_col}`").alias("id"), v.alias("v"))
    widths = rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    width = widths.agg(F.max(F.struct("n", "width"))["width"]).head()[0]
    limit = float(LARGEST)
    x = F.transform("v", lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-limit)), F.lit(limit))).cast("long") + SHIFT)
    return rows.where(F.size("v") == (width or 0)).select("id", x.alias("x"))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def totals(distinct: DataFrame) -> tuple[int, list]:
    """``(n, S)`` as exact numbers, from one row per dimension."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, w = _matrix(batch.column("x")), batch.column("w").to_numpy()
                if int(w.max()) * len(w) >> HALF_BITS:  # products of halves could leave the longs
                    x, w = x.astype(object), w.astype(object)
                high, low = ((w @ part).tolist() for part in (x >> HALF_BITS, x & ((1 << HALF_BITS) - 1)))
                sums = [str((h << HALF_BITS) + a) for h, a in zip(high, low)]
                yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(sums)), pa.int64()), pa.array([str(w.sum()), *sums])], names=["j", "s"])

    rows = distinct.select("x", "w").mapInArrow(run, "j long, s string").groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = {r["j"]: int(r["s"]) for r in rows.collect()}
    n = found.pop(-1, 0)
    return n, [found[j] for j in sorted(found)]


class Centre:
    """Centres whole vectors at S / n."""

    def __init__(self, n: int, sums: list):
        self.n, self.sums = n, sums
        self.exact = np.array(sums, object)
        self.fits = max(map(abs, sums), default=0) < 1 << 62

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: as longs where that is safe, else as Python numbers."""
        if self.fits and int(np.abs(x).max(initial=0)) * self.n < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - self.exact

    def deviations(self, numerators: np.ndarray) -> list:
        """Sums of squares of the numerators; None beyond a long."""
        largest = int(np.abs(numerators).max(initial=0))
        if numerators.dtype != object and largest ** 2 * numerators.shape[1] < 1 << 63:
            return (numerators * numerators).sum(axis=1).tolist()
        exact = (numerators.astype(object) ** 2).sum(axis=1)
        return [int(d) if d < 1 << 63 else None for d in exact]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(np.float64) / self.n


def covariance(distinct: DataFrame, centre: Centre, axes: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the centred vectors, in the rotated ``axes`` (columns) if given."""
    width = len(centre.sums)

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                y = centre.centred(_matrix(batch.column("x")))
                y = y if axes is None else y @ axes
                total += (y * batch.column("w").to_numpy()[:, None]).T @ y
        j, k = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(j), pa.array(k), pa.array(total[j, k])], names=["j", "k", "v"])

    parts = distinct.select("x", "w").mapInArrow(run, "j long, k long, v double").groupBy("j", "k").agg(F.sum("v").alias("v"))
    table = parts.toArrow()
    out = np.zeros((width, width))
    j, k, v = (table[c].to_numpy() for c in ("j", "k", "v"))
    out[j, k] = out[k, j] = v
    return out / centre.n


def jacobi(matrix: np.ndarray, sweeps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of a nearly diagonal covariance by rotations of pairs of axes that still correlate.

    A rotation compares an entry with the two variances beside it, so small variances keep their relative accuracy.
    """
    a, vectors = matrix.copy(), np.eye(len(matrix))
    for _ in range(sweeps):
        scale = np.sqrt(np.maximum(np.diag(a), 0))
        todo = np.argwhere(np.triu(np.abs(a) > 1e-14 * np.outer(scale, scale), 1))
        if not len(todo):
            break
        for p, q in todo.tolist():
            if a[p, q] == 0:
                continue
            theta = (a[q, q] - a[p, p]) / (2 * a[p, q])
            t = (1.0 if theta >= 0 else -1.0) / (abs(theta) + np.hypot(theta, 1))
            c = 1 / np.hypot(t, 1)
            turn = np.array([[c, t * c], [-t * c, c]])
            shift = t * a[p, q]
            pp, qq = a[p, p] - shift, a[q, q] + shift
            a[:, [p, q]] = a[:, [p, q]] @ turn
            a[[p, q], :] = turn.T @ a[[p, q], :]
            a[p, p], a[q, q], a[p, q], a[q, p] = pp, qq, 0.0, 0.0
            vectors[:, [p, q]] = vectors[:, [p, q]] @ turn
    return np.diag(a).copy(), vectors


def principal_axes(distinct: DataFrame, centre: Centre) -> tuple[np.ndarray, np.ndarray]:
    """``(eigenvalues, eigenvectors as columns)`` of the covariance, largest first."""
    _, axes = np.linalg.eigh(covariance(distinct, centre))
    values, turn = jacobi(covariance(distinct, centre, axes[:, ::-1]))
    order = np.argsort(-values, kind="stable")
    axes = (axes[:, ::-1] @ turn)[:, order]
    axes = axes / np.linalg.norm(axes, axis=0)
    peak = axes[np.abs(axes).argmax(axis=0), np.arange(len(values))]
    return np.maximum(values[order], 0.0), axes * np.where(peak < 0, -1.0, 1.0)


def _identity_error(whitened: DataFrame, names: list, n: int) -> float:
    """Largest absolute entry of the covariance of ``names``, weighted by ``w``, minus the identity."""
    if not names:
        return None
    means = whitened.agg(*[(F.sum(F.col(c) * F.col("w")) / n).alias(c) for c in names]).head()
    centred = {c: F.col(c) - F.lit(means[c]) for c in names}
    entries = [F.abs(F.sum(centred[a] * centred[b] * F.col("w")) / n - (1.0 if a == b else 0.0))
               for i, a in enumerate(names) for b in names[i:]]
    return max(whitened.agg(*entries).head())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           weights: str = "counts") -> DataFrame:
    """Per vector that takes part: ``id, n, deviation, whitened, explained, identity_error``; ``whitened`` and
    ``explained`` are arrays with an entry for each component, the largest eigenvalue first."""
    if weights not in ("counts", "one"):
        raise ValueError("weights is 'counts' or 'one'")
    rows = whole_vectors(vectors, id_col, vector_col).withColumns({"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit(1), "x")})
    grouped = rows.groupBy("h1", "h2", "x").agg(F.count(F.lit(1)).alias("copies"))
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    distinct = materialize(grouped.select("h1", "h2", "x", weight.alias("w")), "whiten-distinct")
    n, sums = totals(distinct)
    centre = Centre(n, sums)
    values, axes = principal_axes(distinct, centre) if n else (np.zeros(0), np.zeros((0, 0)))
    keep = min(components, len(values))
    trace, floor = values.sum(), values.max(initial=0) * np.finfo(float).eps ** 2
    explained = [v / trace if trace else None for v in values[:keep].tolist()]
    scale = [v ** 0.5 if v > floor else None for v in values[:keep].tolist()]
    axes = axes[:, :keep]
    names = [f"w{i}" for i in range(keep)]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                numerators = centre.numerators(_matrix(batch.column("x")))
                z = numerators.astype(np.float64) / n @ axes
                columns = [pa.array(z[:, i] / s) if s else pa.nulls(len(z), pa.float64()) for i, s in enumerate(scale)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("h1", "h2", "w")),
                                                  pa.array(centre.deviations(numerators), pa.int64()), *columns],
                                                 names=["h1", "h2", "w", "deviation", *names])

    schema = ", ".join(["h1 long, h2 long, w long, deviation long", *(f"{c} double" for c in names)])
    whitened = materialize(distinct.mapInArrow(run, schema), "whiten-vectors")
    error = _identity_error(whitened, [c for c, s in zip(names, scale) if s], n)
    joined = lookup(rows.select("id", "h1", "h2"), whitened.drop("w"), ["h1", "h2"], "inner")
    return joined.select("id", F.lit(n).cast("long").alias("n"), "deviation", F.array(*names).cast("array<double>").alias("whitened"),
                         F.lit(explained).cast("array<double>").alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def per_component(whitened: DataFrame) -> DataFrame:
    """One row per vector and component: ``id, component`` from 1 ``, n, deviation, whitened, explained, identity_error``."""
    each = whitened.select("id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "value"))
    return each.select("id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("value").alias("whitened"),
                       F.get("explained", F.col("at")).alias("explained"), "identity_error")
