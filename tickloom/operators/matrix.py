"""Matrices and n-d arrays as cell tables.

A matrix is rows ``(i, j, v)``, a vector ``(i, v)``, an n-d array ``(i0, …, ik, v)``; cells not listed
are zero and an index is held at most once. A tall matrix may also be rows with one array column.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import panels
from tickloom.operators.rows import row_positions
from tickloom.operators.skew import fits_broadcast, lookup_join, skew_join
from tickloom.session import materialize

# Widest array row for which one task holds a width × width matrix (8 MiB).
NARROW = 1024
FAN_IN = 32
VECTOR_BLOCK = 1024
# Blocks that take the dense kernel: cells as a share of the rectangle they span, and at least so many.
DENSE_SHARE = 1 / 8
DENSE_CELLS = 4096
# Block rows or columns that go to one task together.
STRIPE = 4


def _index_names(shape) -> list:
    return {1: ["i"], 2: ["i", "j"]}.get(len(shape)) or [f"i{a}" for a in range(len(shape))]


def _strides(shape, order: str) -> list:
    if order not in ("C", "F"):
        raise ValueError("order is 'C' (last index fastest) or 'F' (first index fastest)")
    if order == "C":
        return [math.prod(shape[a + 1:]) for a in range(len(shape))]
    return [math.prod(shape[:a]) for a in range(len(shape))]


def _unravel(linear: Column, shape, order: str = "C") -> list:
    """Index columns of a linear position."""
    return [(F.floor(linear / s) % n).cast("long").alias(name)
            for name, s, n in zip(_index_names(shape), _strides(shape, order), shape)]


# --- creation


def grid(spark: SparkSession, shape) -> DataFrame:
    """Every index of ``shape``, generated in parallel."""
    return spark.range(math.prod(shape)).select(*_unravel(F.col("id"), shape))


def fill(spark: SparkSession, shape, value) -> DataFrame:
    """Zeros, ones or another constant of any type and any number of dimensions."""
    return grid(spark, shape).withColumn("v", F.lit(value))


def identity(spark: SparkSession, n: int) -> DataFrame:
    """The n × n identity; its zeros are left out."""
    return spark.range(n).select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(1.0).alias("v"))


def random_matrix(spark: SparkSession, shape, draw) -> DataFrame:
    """``draw`` maps the index columns to a random column (see ``functions.randoms``)."""
    cells = grid(spark, shape)
    return cells.withColumn("v", draw(*[F.col(c) for c in cells.columns]))


def densify(cells: DataFrame, shape) -> DataFrame:
    """The same array with its zeros listed."""
    names = _index_names(shape)
    zeros = fill(cells.sparkSession, shape, 0.0)
    return cells.select(*names, "v").unionByName(zeros).groupBy(*names).agg(F.sum("v").alias("v"))


def dense_from_column_major(df: DataFrame, keys, values_col: str, n_rows: int, n_cols: int) -> DataFrame:
    """One column-major array per row of ``df`` as cells ``(keys…, i, j, v)``."""
    wrong = F.raise_error(F.lit(f"array does not have {n_rows} x {n_cols} values"))
    values = F.when(F.size(values_col) != n_rows * n_cols, wrong).otherwise(F.col(values_col))
    cells = df.select(*keys, F.posexplode(values).alias("_p", "v"))
    return cells.select(*keys, *_unravel(F.col("_p"), (n_rows, n_cols), "F"), F.col("v").cast("double").alias("v"))


def sparse_from_csc(df: DataFrame, keys, col_ptr: str, row_indices: str, values: str) -> DataFrame:
    """One compressed-column matrix per row of ``df`` as cells ``(keys…, i, j, v)``.

    Column ``j`` owns the positions from ``col_ptr[j]`` up to ``col_ptr[j + 1]``; each row of ``df`` is
    expanded where it lies.
    """
    owned = F.transform(F.slice(col_ptr, 1, F.size(col_ptr) - 1), lambda start, j: F.struct(
        j.alias("j"), start.alias("start"), F.element_at(F.col(col_ptr), j + 2).alias("stop")))
    runs = df.select(*keys, F.col(row_indices).alias("_rows"), F.col(values).alias("_vals"), F.explode(owned).alias("_c"))
    runs = runs.where(F.col("_c.stop") > F.col("_c.start"))
    at = runs.select(*keys, "_rows", "_vals", F.col("_c.j").cast("long").alias("j"),
                     F.explode(F.sequence(F.col("_c.start") + 1, F.col("_c.stop"))).alias("_p"))
    return at.select(*keys, F.element_at("_rows", F.col("_p")).cast("long").alias("i"), "j",
                     F.element_at("_vals", F.col("_p")).cast("double").alias("v"))


def array_fill(df: DataFrame, count_col: str, name: str = "filled") -> DataFrame:
    """``x`` becomes an array of x² copies of x."""
    x = F.col(count_col)
    return df.withColumn(name, F.array_repeat(x.cast("double"), (x * x).cast("int")))


# --- layout


def shape(cells: DataFrame) -> DataFrame:
    return cells.agg((F.max("i") + 1).alias("n_rows"), (F.max("j") + 1).alias("n_cols"), F.count(F.lit(1)).alias("entries"))


def row_cells(rows: DataFrame, vector_col: str, keys=()) -> DataFrame:
    """Array rows as ``(keys…, j, v)``."""
    return rows.select(*keys, F.posexplode(vector_col).alias("_j", "_v")).select(
        *keys, F.col("_j").cast("long").alias("j"), F.col("_v").cast("double").alias("v"))


def indexed_rows(rows: DataFrame, order_cols) -> DataFrame:
    """Array rows with a consecutive 0-based row index ``i``."""
    return row_positions(rows, order_cols, name="i")


def indexed_row_segments(cells: DataFrame, width: int = 4096) -> DataFrame:
    """Sparse rows ``(i, segment, cells)``, ``cells`` a map from column to value.

    A row wider than ``width`` columns comes in several segments, so no group grows with the matrix.
    """
    return (cells.groupBy("i", F.expr(f"j div {width}").alias("segment"))
            .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("j", "v")))).alias("cells")))


def transpose(cells: DataFrame) -> DataFrame:
    return cells.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def blocks(cells: DataFrame, block: int) -> DataFrame:
    """Cells with their block ``(bi, bj)`` and place in it ``(li, lj)``."""
    return cells.select(F.expr(f"i div {block}").alias("bi"), F.expr(f"j div {block}").alias("bj"),
                        (F.col("i") % block).alias("li"), (F.col("j") % block).alias("lj"), "v")


def validate_blocks(blocked: DataFrame, n_rows: int, n_cols: int, block: int) -> DataFrame:
    """Per block: cells, cells held twice, cells outside the matrix, and whether it is valid."""
    outside = ((F.col("bi") * block + F.col("li") >= n_rows) | (F.col("bj") * block + F.col("lj") >= n_cols)
               | (F.col("li") < 0) | (F.col("lj") < 0))
    per_cell = blocked.groupBy("bi", "bj", "li", "lj").agg(F.count(F.lit(1)).alias("n"))
    return (per_cell.groupBy("bi", "bj")
            .agg(F.sum("n").alias("cells"), F.sum((F.col("n") > 1).cast("long")).alias("twice"),
                 F.sum(outside.cast("long")).alias("outside"))
            .withColumn("valid", (F.col("twice") == 0) & (F.col("outside") == 0)))


def ndarray_from_flat(flat: DataFrame, shape, order: str = "C") -> DataFrame:
    """``(pos, v)`` as an n-d array."""
    return flat.select(*_unravel(F.col("pos"), shape, order), "v")


def flatten(cells: DataFrame, shape, order: str = "C") -> DataFrame:
    """An n-d array as ``(pos, v)``."""
    at = sum((F.col(n) * s for n, s in zip(_index_names(shape), _strides(shape, order))), F.lit(0))
    return cells.select(at.cast("long").alias("pos"), "v")


def reshape(cells: DataFrame, old_shape, new_shape, *, read_order: str = "C", write_order: str = "C") -> DataFrame:
    """The same values read in one order and laid out in another shape and order."""
    if math.prod(old_shape) != math.prod(new_shape):
        raise ValueError(f"cannot reshape {tuple(old_shape)} into {tuple(new_shape)}: lengths differ")
    return ndarray_from_flat(flatten(cells, old_shape, read_order), new_shape, write_order)


def diag_from_vector(vector: DataFrame) -> DataFrame:
    """``(i, v)`` on the diagonal of a square matrix; its zeros are left out."""
    return vector.select("i", F.col("i").alias("j"), "v")


# --- algebra


def scal(cells: DataFrame, a: float) -> DataFrame:
    return cells.withColumn("v", a * F.col("v"))


def _add(index, *parts: DataFrame) -> DataFrame:
    """Sum of cell tables over the union of their cells: one shuffle with map-side sums."""
    whole = parts[0].select(*index, "v")
    for p in parts[1:]:
        whole = whole.unionByName(p.select(*index, "v"))
    return whole.groupBy(*index).agg(F.sum("v").alias("v"))


def axpy(a: float, x: DataFrame, y: DataFrame, index=("i",)) -> DataFrame:
    """``y + a·x``."""
    return _add(list(index), y, scal(x, a))


def dot(x: DataFrame, y: DataFrame, *, index=("j",), keys=()) -> DataFrame:
    """``x·y``, one product per key where several vector pairs are given."""
    y = y.withColumnRenamed("v", "_w")
    return x.join(y, [*keys, *index]).groupBy(*keys).agg(F.sum(F.col("v") * F.col("_w")).alias("dot"))


def _pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cells of ``a`` beside the cells of ``b`` with the same inner index, as ``(i, j, v, w)``."""
    left = a.select("i", F.col("j").alias("_k"), "v")
    right = b.select(F.col("i").alias("_k"), "j", F.col("v").alias("_w"))
    return lookup_join(left, right, "_k")


def matmul(a: DataFrame, b: DataFrame, block: int = 512) -> DataFrame:
    """``A·B``, its form chosen by measured density, block by block.

    Blocks whose cells fill ``DENSE_SHARE`` of the rectangle they span are dense. Products of two dense blocks are made by
    a dense kernel; all others by joining cells on the inner index, which costs as much as there are products of cells.
    Both give the cells whose inner indices meet, and are summed together. The counts, one row per block, are written;
    ``materialize`` operands that are costly to compute, since they are read for the counts first.
    """
    if fits_broadcast(b):
        return matmul_sparse(a, b)
    a_dense, b_dense = _dense_blocks(a, block), _dense_blocks(b, block)
    if a_dense.isEmpty() or b_dense.isEmpty():
        return matmul_sparse(a, b)
    (a_full, a_rest), (b_full, b_rest) = _by_density(a, a_dense, block), _by_density(b, b_dense, block)
    parts = [matmul_blocked(a_full, b_full, block)]
    parts += [_pairs(x, y).select("i", "j", (F.col("v") * F.col("_w")).alias("v")) for x, y in ((a_rest, b), (a_full, b_rest))]
    return _add(["i", "j"], *parts)


def _dense_blocks(cells: DataFrame, block: int) -> DataFrame:
    """``(bi, bj)`` of the blocks that are dense, written."""
    spans = [F.max(c) - F.min(c) + 1 for c in ("li", "lj")]
    counted = blocks(cells, block).groupBy("bi", "bj").agg((F.count(F.lit(1)) >= spans[0] * spans[1] * DENSE_SHARE).alias("dense"),
                                                          F.count(F.lit(1)).alias("n"))
    return materialize(counted.where("dense").where(F.col("n") >= DENSE_CELLS).select("bi", "bj"), "dense-blocks")


def _by_density(cells: DataFrame, dense: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """The cells of dense blocks, and all others."""
    dense = F.broadcast(dense) if fits_broadcast(dense) else dense
    placed = cells.withColumns({"bi": F.expr(f"i div {block}"), "bj": F.expr(f"j div {block}")})
    return tuple(placed.join(dense, ["bi", "bj"], how).select("i", "j", "v") for how in ("left_semi", "left_anti"))


def matmul_sparse(a: DataFrame, b: DataFrame) -> DataFrame:
    """``A·B`` for sparse operands, or dense ones where B is small: join on the inner index and sum.

    ``b`` is counted first; ``materialize`` it when it is costly to compute.
    """
    return _pairs(a, b).groupBy("i", "j").agg(F.sum(F.col("v") * F.col("_w")).alias("v"))


def matmul_blocked(a: DataFrame, b: DataFrame, block: int = 512) -> DataFrame:
    """``A·B`` for two large dense operands.

    The blocks of A are cut into stripes of ``STRIPE`` block rows, those of B into stripes of ``STRIPE`` block columns. A
    group is a block column of one stripe of A and the same block row of one stripe of B, so a cell is copied once per
    stripe of the other operand and no group holds more than two stripes of blocks, whatever the shape of the matrices.
    Each pair of blocks in a group is one dense kernel call; partial products are summed by cell.
    """
    left = a.select(F.expr(f"i div {block * STRIPE}").alias("si"), F.expr(f"j div {block}").alias("bk"), "i", "j", "v")
    right = b.select(F.expr(f"i div {block}").alias("bk"), F.expr(f"j div {block * STRIPE}").alias("sj"),
                     F.col("i").alias("k"), F.col("j").alias("c"), F.col("v").alias("w"))
    group = ["si", "bk", "sj"]
    # columns under new names of their own, since the two joined tables meet again in the cogroup
    spread_left = skew_join(left, right.select(F.col("bk").alias("bk"), F.col("sj").alias("sj")).distinct(), "bk")
    spread_right = skew_join(right, left.select(F.col("bk").alias("bk"), F.col("si").alias("si")).distinct(), "bk")

    def multiply(key, x, y):
        import numpy as np
        import pandas as pd

        bk = int(key[1])
        # a block is dealt with densely over the part it spans; a cell that is held twice counts twice, as in the join
        def dense(rows, cols, v, n_rows, n_cols):
            m, held = np.zeros((n_rows, n_cols)), np.zeros((n_rows, n_cols), np.float32)
            np.add.at(m, (rows, cols), v)
            held[rows, cols] = 1
            return m, held

        def cut(frame, along):
            number = frame[along].to_numpy() // block
            for n in np.unique(number):
                yield int(n), frame[number == n]

        depth = int(max(x["j"].max(), y["k"].max())) - bk * block + 1
        right_blocks = [(bj, dense(part["k"] - bk * block, part["c"] - bj * block, part["w"], depth, int(part["c"].max()) - bj * block + 1))
                        for bj, part in cut(y, "c")]
        out = []
        for bi, part in cut(x, "i"):
            m, here = dense(part["i"] - bi * block, part["j"] - bk * block, part["v"], int(part["i"].max()) - bi * block + 1, depth)
            for bj, (n, there) in right_blocks:
                i, j = np.nonzero(here @ there)  # cells with an inner index that both operands hold
                out.append(pd.DataFrame({"i": i + bi * block, "j": j + bj * block, "v": (m @ n)[i, j]}))
        return pd.concat(out)

    partial = (spread_left.groupBy(*group).cogroup(spread_right.groupBy(*group))
               .applyInPandas(multiply, "i long, j long, v double"))
    return partial.groupBy("i", "j").agg(F.sum("v").alias("v"))


def gemm(alpha: float, a: DataFrame, b: DataFrame, beta: float, c: DataFrame) -> DataFrame:
    """``α·A·B + β·C``."""
    return _add(["i", "j"], scal(matmul(a, b), alpha), scal(c, beta))


def gemv(alpha: float, a: DataFrame, x: DataFrame, beta: float, y: DataFrame) -> DataFrame:
    """``α·A·x + β·y`` for vectors ``(i, v)``."""
    column = materialize(x.select("i", F.lit(0).cast("long").alias("j"), "v"), "vector")  # measured, then joined
    product = _pairs(a, column).select("i", (F.col("v") * F.col("_w") * alpha).alias("v"))
    return _add(["i"], product, scal(y, beta))


def rank1_update(alpha: float, x: DataFrame, a: DataFrame) -> DataFrame:
    """``α·x·xᵀ + A``.

    x is cut into blocks; every value is copied once per block and meets that block's values there, so the n² products
    are made by as many tasks as there are blocks, each with a bounded part of x.
    """
    x = materialize(x.select("i", "v", F.expr(f"i div {VECTOR_BLOCK}").alias("blk")), "vector")
    last = x.agg(F.max("blk")).scalar()
    left = x.select("i", (alpha * F.col("v")).alias("v"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("blk"))
    right = x.select(F.col("i").alias("j"), F.col("v").alias("w"), "blk")
    return _add(["i", "j"], left.join(right.hint("shuffle_hash"), "blk").select("i", "j", (F.col("v") * F.col("w")).alias("v")), a)


def elementwise_mul(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b.withColumnRenamed("v", "_w"), ["i", "j"]).select("i", "j", (F.col("v") * F.col("_w")).alias("v"))


def elementwise_div(a: DataFrame, b: DataFrame) -> DataFrame:
    """``A ⊘ B`` at the cells of A; division by a zero of B is missing."""
    other = b.withColumnRenamed("v", "_w")
    return a.join(other, ["i", "j"], "left").select("i", "j", F.try_divide("v", F.coalesce("_w", F.lit(0.0))).alias("v"))


# --- tall matrices of narrow array rows


def gramian(rows: DataFrame, vector_col: str, width: int) -> DataFrame:
    """``AᵀA`` as cells for a matrix of any number of array rows with ``width`` values each.

    Up to ``NARROW`` values a row, each task reduces its rows to one width × width triangle before anything is
    shuffled; wider ones are multiplied block by block with the same result. A missing row or a row of another length
    is an error.
    """
    right = F.col(vector_col).isNotNull() & (F.size(vector_col) == width)
    if width > NARROW:
        value = F.when(right, F.col(vector_col).cast("array<double>")).otherwise(F.raise_error(F.lit(f"row without {width} values")))
        checked = rows.select(F.monotonically_increasing_id().alias("i"), value.alias("v"))
        return gramian_cells(materialize(checked.select("i", F.posexplode("v").alias("j", "v")).withColumn("j", F.col("j").cast("long")), "wide-rows"))

    def partial(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        total = np.zeros((width, width))
        for batch in batches:
            vectors = batch.column(0)
            if len(vectors) and (vectors.null_count or not pc.all(pc.equal(pc.list_value_length(vectors), width)).as_py()):
                raise ValueError(f"row without {width} values")
            x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            total += x.T @ x
        j, k = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(j), pa.array(k), pa.array(total[j, k])], names=["j", "k", "v"])

    triangles = rows.select(F.col(vector_col).cast("array<double>")).mapInArrow(partial, "j long, k long, v double")
    upper = triangles.groupBy("j", "k").agg(F.sum("v").alias("v"))
    both = F.array(F.struct("j", "k"), F.struct(F.col("k").alias("j"), F.col("j").alias("k")))
    places = F.when(F.col("j") == F.col("k"), F.slice(both, 1, 1)).otherwise(both)
    return upper.select(F.explode(places).alias("p"), "v").select(F.col("p.j").alias("i"), F.col("p.k").alias("j"), "v")


def gramian_cells(cells: DataFrame, block: int = 512) -> DataFrame:
    """``AᵀA`` of a matrix of any width."""
    return matmul_blocked(transpose(cells), cells, block)


def _stack_r(width):
    """Grouped reduction of stacked triangular factors to the factor of the stack."""

    def reduce_group(pdf):
        import numpy as np
        import pandas as pd

        r = np.linalg.qr(np.stack(pdf["r"].to_numpy()), mode="r")
        return pd.DataFrame({"part": pdf["part"].iloc[0], "r": list(r)})

    return reduce_group


def qr_r(rows: DataFrame, vector_col: str, width: int) -> DataFrame:
    """The R of a tall-skinny QR as cells ``(i, j, v)`` of its upper triangle, with diag(R) > 0.

    Each task folds its rows into one triangular factor; the factors are then stacked and folded
    again, at most ``FAN_IN`` at a time. A missing row or a row of another length is an error; a
    matrix with fewer rows than columns gives zero rows at the end. Beyond ``NARROW`` values a row the factor is made
    panel by panel (``panels.factor``), where a matrix without full column rank is an error.
    """
    if width > NARROW:
        return panels.factor(rows, vector_col, width, panel=min(panels.PANEL, NARROW))[1]

    def fold(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        r = np.zeros((0, width))
        for batch in batches:
            vectors = batch.column(0)
            if len(vectors) and (vectors.null_count or not pc.all(pc.equal(pc.list_value_length(vectors), width)).as_py()):
                raise ValueError(f"row without {width} values")
            x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            r = np.linalg.qr(np.vstack([r, x]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array(list(r), pa.list_(pa.float64()))], names=["r"])

    factors = rows.select(F.col(vector_col).cast("array<double>")).mapInArrow(fold, "r array<double>")
    factors = factors.withColumn("part", F.spark_partition_id().cast("long"))
    rounds, groups = [], rows.rdd.getNumPartitions()
    while groups > 1:
        groups = -(-groups // FAN_IN)
        rounds.append(groups)
    for groups in rounds or [1]:
        factors = factors.withColumn("part", F.col("part") % groups).groupBy("part").applyInPandas(
            _stack_r(width), "part long, r array<double>")

    def to_cells(pdf):
        import numpy as np
        import pandas as pd

        r = np.stack(pdf["r"].to_numpy())
        r = np.vstack([r, np.zeros((width - len(r), width))])  # fewer rows than columns
        r = r * np.where(np.diag(r) < 0, -1.0, 1.0)[:, None]
        i, j = np.triu_indices(width)
        return pd.DataFrame({"i": i, "j": j, "v": r[i, j]})

    return factors.groupBy("part").applyInPandas(to_cells, "i long, j long, v double")


def qr_q(cells: DataFrame, r: DataFrame, width: int) -> DataFrame:
    """The Q that belongs to ``qr_r``: ``A·R⁻¹`` as cells, by triangular solves of A's rows. A rank-deficient R is an
    error. For wide matrices ``panels.factor`` gives Q itself, orthogonal whatever the condition number."""
    at = F.sort_array(F.collect_list(F.struct("j", "v")))
    held = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).groupBy("i").agg(at.alias("m"))
    every = F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long"))
    gaps = F.transform(every, lambda j: F.coalesce(F.try_element_at(F.map_from_entries("m"), j), F.lit(0.0)))
    dense = F.when(F.size("m") == width, F.transform("m", lambda e: e["v"])).otherwise(gaps)
    solved = panels.solve_rows(held.select("i", dense.alias("v")), "v", r, width, ["i"])
    return row_cells(solved, "q", ["i"])
