"""QR of tall matrices of any width, one panel of columns after another.

A table of panels holds the columns ``p0, p1, …`` of a matrix as arrays of at most ``panel`` values beside the key columns
of its rows. One step turns a panel into columns of Q and takes them out of the panels behind it:

* the panel's triangular factor is folded from all rows (``matrix.qr_r``);
* its orthonormal columns times the later panels, summed up in each task and then ``FAN_IN`` tasks at a time, are the
  other blocks of that row of R;
* the rewritten panels are written, so the next step starts from files.

One sweep over the panels loses orthogonality in proportion to the condition number; a second sweep over the Q of the
first restores it, and R is the product of both. What is sent to the tasks in a step is one row of blocks of R,
``panel * width`` numbers; it grows with the width, never with the rows.
"""

from contextlib import contextmanager
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import materialize

PANEL = 512
FAN_IN = 32
BATCH_BYTES = 32 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batches_of(spark, width: int):
    """Jobs within hand over batches of about ``BATCH_BYTES`` of rows of ``width`` numbers."""
    before = spark.conf.get(_BATCH_CONF)
    spark.conf.set(_BATCH_CONF, str(max(1, min(int(before) if int(before) > 0 else 10_000, BATCH_BYTES // (8 * width)))))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_CONF, before)


def widths_of(width: int, panel: int) -> list:
    return [min(panel, width - at) for at in range(0, width, panel)]


def split(rows: DataFrame, vector_col: str, width: int, panel: int = PANEL, keys=()) -> DataFrame:
    """``(keys…, p0, p1, …)`` of array rows. A missing row, one of another length or with a missing value is an error."""
    value = F.col(vector_col).cast("array<double>")
    good = F.coalesce((F.size(value) == width) & ~F.exists(value, lambda x: x.isNull()), F.lit(False))
    checked = F.when(good, value).otherwise(F.raise_error(F.lit(f"row without {width} values")))
    parts = [F.slice("_v", k * panel + 1, w).alias(f"p{k}") for k, w in enumerate(widths_of(width, panel))]
    return rows.select(*keys, checked.alias("_v")).select(*keys, *parts)


def right_solve(x: np.ndarray, r: np.ndarray, step: int = 64) -> np.ndarray:
    """``x · r⁻¹`` for an upper triangle ``r``, by substitution in blocks of columns."""
    out = np.empty_like(x)
    for a in range(0, len(r), step):
        b = min(a + step, len(r))
        rest = x[:, a:b] - out[:, :a] @ r[:a, a:b]
        out[:, a:b] = np.linalg.solve(r[a:b, a:b].T, rest.T).T
    return out


def _dense(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sum_blocks(parts: DataFrame, tasks: int) -> DataFrame:
    """Blocks ``(k, task, block)`` added up by ``k``, at most ``FAN_IN`` tasks' blocks of a panel in one group."""
    import pandas as pd

    def add(pdf):
        total = sum(np.frombuffer(x) for x in pdf["block"])
        return pd.DataFrame({"k": pdf["k"].iloc[:1], "task": pdf["task"].iloc[:1], "block": [total.tobytes()]})

    while True:
        tasks = -(-tasks // FAN_IN)
        parts = parts.withColumn("task", F.pmod("task", F.lit(tasks).cast("long"))).groupBy("k", "task").applyInPandas(
            add, "k long, task long, block binary")
        if tasks == 1:
            return parts.select("k", "block")


def _triangle(table: DataFrame, k: int, width: int) -> np.ndarray:
    """The triangular factor of panel ``k``, diagonal above 0."""
    from tickloom.operators.matrix import qr_r

    cells = qr_r(table.select(f"p{k}"), f"p{k}", width).toArrow()
    r = np.zeros((width, width))
    r[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
    return r


def _projections(table: DataFrame, k: int, r: np.ndarray, widths: list) -> dict:
    """The blocks right of ``r`` in its row of R: panel → Qₖᵀ · panel."""
    later = list(range(k + 1, len(widths)))
    if not later:
        return {}
    import pyarrow as pa

    def run(batches):
        from pyspark import TaskContext

        totals = [np.zeros((len(r), widths[m])) for m in later]
        for batch in batches:
            q = right_solve(_dense(batch.column(0)), r)
            for n, total in enumerate(totals):
                total += q.T @ _dense(batch.column(1 + n))
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(later), pa.array([task] * len(later)), pa.array([t.tobytes() for t in totals], pa.binary())],
                                         names=["k", "task", "block"])

    parts = table.select(*[f"p{m}" for m in [k, *later]]).mapInArrow(run, "k long, task long, block binary")
    summed = _sum_blocks(parts, table.rdd.getNumPartitions()).collect()
    found = {row["k"]: np.frombuffer(row["block"]).reshape(len(r), -1) for row in summed}
    return {m: found.get(m, np.zeros((len(r), widths[m]))) for m in later}


def _eliminate(table: DataFrame, k: int, r: np.ndarray, blocks: dict) -> DataFrame:
    """Panel ``k`` times ``r⁻¹``, taken out of the panels in ``blocks``; written."""
    import pyarrow as pa

    changed = [f"p{m}" for m in [k, *blocks]]
    rest = [c for c in table.columns if c not in changed]

    def run(batches):
        for batch in batches:
            q = right_solve(_dense(batch.column(f"p{k}")), r)
            new = [q, *(_dense(batch.column(f"p{m}")) - q @ block for m, block in blocks.items())]
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel())) for x in new]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *lists], names=[*rest, *changed])

    fields = {f.name: f for f in table.schema.fields}
    schema = T.StructType([fields[c] for c in rest] + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in changed])
    return materialize(table.mapInArrow(run, schema).select(*table.columns), "panels")


def _refuse_deficient(diagonal: np.ndarray, largest: float, width: int):
    if diagonal.min(initial=np.inf) <= largest * width * np.finfo(float).eps:
        raise ValueError("the matrix has no full column rank, its Q is not unique")


_BLOCKS = "bi long, bj long, w long, block binary"


def _stored(spark, k: int, blocks: dict) -> DataFrame:
    """One row of blocks of R, written: ``bi, bj``, the number of columns and the values."""
    rows = [(k, m, x.shape[1], x.tobytes()) for m, x in blocks.items()]
    return materialize(spark.createDataFrame(rows, _BLOCKS).repartition(len(rows)), "panels-r")


def _sweep(table: DataFrame, widths: list) -> tuple[DataFrame, DataFrame]:
    """``(panels of Q, blocks of R)``."""
    stored, largest = [], 0.0
    for k, width in enumerate(widths):
        r = _triangle(table, k, width)
        largest = max(largest, np.diag(r).max())
        _refuse_deficient(np.diag(r), largest, sum(widths))
        later = _projections(table, k, r, widths)
        stored.append(_stored(table.sparkSession, k, {k: r, **later}))
        table = _eliminate(table, k, r, later)
    return table, reduce(DataFrame.unionByName, stored)


def _product(left: DataFrame, right: DataFrame) -> DataFrame:
    """Product of two upper triangles in blocks: joined on the inner panel, summed by block."""
    import pandas as pd
    import pyarrow as pa

    second = right.select(F.col("bi").alias("bk"), F.col("bj").alias("to"), F.col("w").alias("wide"), F.col("block").alias("other"))
    pairs = left.withColumnRenamed("bj", "bk").join(second, "bk")

    def multiply(batches):
        for batch in batches:
            x, w, y, wide = (batch.column(c).to_pylist() for c in ("block", "w", "other", "wide"))
            made = [(np.frombuffer(a).reshape(-1, m) @ np.frombuffer(b).reshape(-1, n)).tobytes() for a, m, b, n in zip(x, w, y, wide)]
            yield pa.RecordBatch.from_arrays([batch.column("bi"), batch.column("to"), batch.column("wide"), pa.array(made, pa.binary())],
                                             names=["bi", "bj", "w", "block"])

    def add(pdf):
        total = sum(np.frombuffer(x) for x in pdf["block"])
        return pd.DataFrame({"bi": pdf["bi"].iloc[:1], "bj": pdf["bj"].iloc[:1], "w": pdf["w"].iloc[:1], "block": [total.tobytes()]})

    parts = pairs.select("bi", "to", "wide", "block", "w", "other").mapInArrow(multiply, _BLOCKS)
    return parts.groupBy("bi", "bj").applyInPandas(add, _BLOCKS)


def _cells(blocks: DataFrame, panel: int) -> DataFrame:
    """Blocks of an upper triangle as cells."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for bi, bj, w, raw in zip(*(batch.column(c).to_pylist() for c in ("bi", "bj", "w", "block"))):
                x = np.frombuffer(raw).reshape(-1, w)
                i, j = np.triu_indices(len(x)) if bi == bj else (at.ravel() for at in np.indices(x.shape))
                yield pa.RecordBatch.from_arrays([pa.array(i + bi * panel), pa.array(j + bj * panel), pa.array(x[i, j])], names=["i", "j", "v"])

    return blocks.mapInArrow(run, "i long, j long, v double")


def factor(rows: DataFrame, vector_col: str, width: int, keys=(), panel: int = PANEL) -> tuple[DataFrame, DataFrame]:
    """``(Q, R)`` of array rows of ``width`` values: Q as rows ``(keys…, q)``, written; R as cells of its upper triangle.

    diag(R) > 0, which makes both unique. A matrix without full column rank, or with fewer rows than columns, is an error.
    """
    spark, widths = rows.sparkSession, widths_of(width, panel)
    with batches_of(spark, width):
        table = materialize(split(rows, vector_col, width, panel, keys), "panels")
        table, first = _sweep(table, widths)
        table, second = _sweep(table, widths)
    with batches_of(spark, 2 * panel * panel):
        r = materialize(_cells(_product(second, first), panel), "panels-r")
    return table.select(*keys, F.concat(*[f"p{k}" for k in range(len(widths))]).alias("q")), r


def solve_rows(rows: DataFrame, vector_col: str, r: DataFrame, width: int, keys=(), panel: int = PANEL) -> DataFrame:
    """``A · R⁻¹`` by triangular solves: rows ``(keys…, q)``, written. ``r`` holds the cells of an upper triangle, of which
    one row of panels at a time is read."""
    spark, widths = rows.sparkSession, widths_of(width, panel)
    r = materialize(r.select("i", "j", "v"), "panels-r")
    sizes = np.zeros(width)
    for cell in r.where("i = j").collect():
        sizes[cell["i"]] = abs(cell["v"])
    _refuse_deficient(sizes, sizes.max(), width)
    with batches_of(spark, width):
        table = split(rows, vector_col, width, panel, keys)
        for k, w in enumerate(widths):
            at = k * panel
            cells = r.where((F.col("i") >= at) & (F.col("i") < at + w)).toArrow()
            block = np.zeros((w, width - at))
            block[cells["i"].to_numpy() - at, cells["j"].to_numpy() - at] = cells["v"].to_numpy()
            later = {m: block[:, (m - k) * panel:(m - k) * panel + widths[m]] for m in range(k + 1, len(widths))}
            table = _eliminate(table, k, block[:, :w], later)
    return table.select(*keys, F.concat(*[f"p{k}" for k in range(len(widths))]).alias("q"))
