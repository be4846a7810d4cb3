"""A matrix in blocks that stays laid out: written once, multiplied many times without being shuffled again.

A block is one row ``(bi, bj, n, i, j, v)``: its cells as three arrays, indices counted within the block. Blocks are written as a
table in buckets of (bi, bj), so that every product joins what it needs *to the blocks where they lie*: of a vector, a copy
of its part for every block; of another matrix, the blocks of the matching rows. Only those copies and the partial results
are shuffled; a dense block of 512 by 512 meets 512 values of a vector, so a copy is a small part of what stays in place.
A block with many cells per row is multiplied by a dense kernel, one with few cell by cell.
"""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.panels import batches_of
from tickloom.operators.skew import BROADCAST_BYTES, skew_join
from tickloom.session import materialize, scratch_path

BLOCK = 512
BUCKETS = 64
# Cells as a share of the rectangle they span from which a block is multiplied as a dense matrix.
DENSE_SHARE = 1 / 8


@dataclass(frozen=True)
class Stored:
    """A written matrix. ``table`` is the name of the table, ``block`` the side of a block."""

    spark: object
    table: str
    block: int
    buckets: int

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def cells(self) -> DataFrame:
        """``(i, j, v)``."""
        each = self.rows().select("bi", "bj", F.explode(F.arrays_zip("i", "j", "v")).alias("c"))
        return each.select((F.col("bi") * self.block + F.col("c.i")).alias("i"), (F.col("bj") * self.block + F.col("c.j")).alias("j"),
                           F.col("c.v").alias("v"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def packed(cells: DataFrame, block: int) -> DataFrame:
    """One row per block with cells. A block holds at most ``block²`` cells; a cell that is held twice is summed."""
    single = cells.groupBy("i", "j").agg(F.sum("v").alias("v"))
    place = F.struct((F.col("i") % block).cast("int").alias("i"), (F.col("j") % block).cast("int").alias("j"), F.col("v").cast("double").alias("v"))
    blocks = single.groupBy(F.expr(f"i div {block}").alias("bi"), F.expr(f"j div {block}").alias("bj")).agg(
        F.sort_array(F.collect_list(place)).alias("c"))
    return blocks.select("bi", "bj", F.size("c").alias("n"), "c.i", "c.j", "c.v")


def store(cells: DataFrame, block: int = BLOCK, buckets: int = BUCKETS) -> Stored:
    """Write a matrix of cells ``(i, j, v)`` in buckets of its blocks.

    The number of buckets is the number of tasks of every later product; take about one for 100 MB of blocks.
    """
    spark, name = cells.sparkSession, f"blocks_{uuid.uuid4().hex}"
    placed = packed(cells, block).repartition(buckets, "bi", "bj")
    (placed.write.bucketBy(buckets, "bi", "bj").sortBy("bi", "bj").option("path", scratch_path(spark, "blocks")).format("parquet").saveAsTable(name))
    return Stored(spark, name, block, buckets)


def _meeting(matrix: Stored, other: DataFrame, size: int) -> DataFrame:
    """Each block of the matrix beside the rows of ``other``, written, whose ``bk`` is its block column.

    An ``other`` of at most ``BROADCAST_BYTES`` is sent to all tasks. Otherwise its rows are copied for the blocks that need
    them, found from the block numbers alone, and the copies are shuffled to the buckets of the matrix.
    """
    rows = matrix.rows()
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(other), rows["bj"] == other["bk"])
    numbers = matrix.rows().select(F.col("bi").alias("to_i"), F.col("bj").alias("bk"))
    copies = skew_join(numbers, other, "bk", sides=("left",))
    return rows.hint("merge").join(copies, (rows["bi"] == copies["to_i"]) & (rows["bj"] == copies["bk"]))


def gemv(matrix: Stored, x: DataFrame) -> DataFrame:
    """``A·x`` for a vector ``(i, v)``, written; rows of A without a cell that meets x are left out, as zeros are."""
    import numpy as np
    import pyarrow as pa

    block = matrix.block
    place = F.struct((F.col("i") % block).cast("int").alias("i"), F.col("v").cast("double").alias("v"))
    parts = x.groupBy(F.expr(f"i div {block}").alias("bk")).agg(F.collect_list(place).alias("c"))
    parts = materialize(parts.select("bk", F.transform("c", lambda e: e["i"]).alias("xi"), F.transform("c", lambda e: e["v"]).alias("xv")), "vector-blocks")
    size = 16 * (parts.agg(F.sum(F.size("xi"))).head()[0] or 0)

    def run(batches):
        for batch in batches:
            ends = np.cumsum([0, *(len(r) for r in batch.column("i"))])
            at, to, v = (batch.column(c).flatten().to_numpy() for c in ("i", "j", "v"))
            for k, bi in enumerate(batch.column("bi").to_pylist()):
                part = np.zeros(block)
                held = np.zeros(block, bool)
                xi = batch.column("xi")[k].values.to_numpy()
                np.add.at(part, xi, batch.column("xv")[k].values.to_numpy())
                held[xi] = True
                i, j = at[ends[k]:ends[k + 1]], to[ends[k]:ends[k + 1]]
                met = held[j]
                sums = np.bincount(i[met], v[ends[k]:ends[k + 1]][met] * part[j[met]], block).astype(float)  # whole numbers if empty
                rows = np.unique(i[met])
                yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int64) + bi * block), pa.array(sums[rows])], names=["i", "v"])

    with batches_of(matrix.spark, 2 * block * block):
        partial = _meeting(matrix, parts, size).select("bi", "i", "j", "v", "xi", "xv").mapInArrow(run, "i long, v double")
        return materialize(partial.groupBy("i").agg(F.sum("v").alias("v")), "product")


def block_product(a, b, block: int):
    """``(i, j, v)`` of the product of two blocks given as ``(i, j, v)``, sorted by row: the cells whose inner indices meet.

    Dense matrices are multiplied where both fill ``DENSE_SHARE`` of their rectangles, else cells are paired.
    """
    import numpy as np

    (ai, aj, av), (bi, bj, bv) = a, b
    depth = int(max(aj.max(), bi.max())) + 1
    height, width = int(ai.max()) + 1, int(bj.max()) + 1
    if len(ai) >= height * depth * DENSE_SHARE and len(bi) >= depth * width * DENSE_SHARE:
        m, n = np.zeros((height, depth)), np.zeros((depth, width))
        here, there = m.astype(np.float32), n.astype(np.float32)
        m[ai, aj], n[bi, bj], here[ai, aj], there[bi, bj] = av, bv, 1, 1
        i, j = np.nonzero(here @ there)
        return i, j, (m @ n)[i, j]
    first, last = np.searchsorted(bi, aj, "left"), np.searchsorted(bi, aj, "right")
    many = last - first
    index = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    key, place = np.unique(np.repeat(ai, many).astype(np.int64) * block + bj[index], return_inverse=True)
    return key // block, key % block, np.bincount(place, np.repeat(av, many) * bv[index], len(key)).astype(float)


def matmul(a: Stored, b: Stored) -> DataFrame:
    """``A·B`` as cells, written. A stays where it lies; the blocks of B are sent or copied to A's."""
    import numpy as np
    import pyarrow as pa

    if a.block != b.block:
        raise ValueError("the blocks of both matrices must have the same side")
    block = a.block
    other = b.rows().select(F.col("bi").alias("bk"), F.col("bj").alias("to"), *[F.col(c).alias(f"w{c}") for c in "ijv"])
    size = 16 * (b.rows().agg(F.sum("n")).head()[0] or 0)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                held = [[batch.column(p + c)[k].values.to_numpy() for c in "ijv"] for p in ("", "w")]
                i, j, v = block_product(*held, block)
                yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int64) + batch.column("bi")[k].as_py() * block),
                                                  pa.array(j.astype(np.int64) + batch.column("to")[k].as_py() * block), pa.array(v)], names=["i", "j", "v"])

    with batches_of(a.spark, 4 * block * block):
        cells = _meeting(a, other, size).select("bi", "to", "i", "j", "v", "wi", "wj", "wv").mapInArrow(run, "i long, j long, v double")
        return materialize(cells.groupBy("i", "j").agg(F.sum("v").alias("v")), "product")
