"""Queries: matrices and n-d arrays. The embeddings table is the matrix: one row per vector, 64 columns."""

from pyspark.sql import functions as F

from tickloom.operators import blocks as bl
from tickloom.operators import matrix as mx
from tickloom.operators import panels
from tickloom.plans import base as b
from tickloom.plans.registry import query
from tickloom.session import materialize

WIDTH = 64
VEC = f"WITH {b.VEC}"
GRAM = "gram AS (SELECT a.j AS i, b.j AS j, sum(a.v * b.v) AS v FROM vec a JOIN vec b USING (i) GROUP BY 1, 2)"


def _embeddings(spark, d):
    return b.table(spark, d, "embeddings")


def _counted(spark, d):
    """Rows of the matrix: one more than the largest index, whichever indices are missing."""
    return (_embeddings(spark, d).agg(F.max("vec_id")).head()[0] or 0) + 1


def _row_sums(spark, d):
    """The sum of every vector's values as a vector ``(i, v)``."""
    total = F.aggregate("embedding", F.lit(0.0), lambda done, x: done + x.cast("double"))
    return _embeddings(spark, d).select(F.col("vec_id").alias("i"), total.alias("v"))


def _column_means(spark, d):
    cells = b.vector_cells(spark, d)
    return cells.groupBy("j").agg(F.avg("v").alias("v")).withColumnRenamed("j", "i")


MEANS = "m AS (SELECT j AS i, avg(v) AS v FROM vec GROUP BY 1)"


@query("coordinate_matrix", f"{VEC} SELECT max(i) + 1 AS n_rows, max(j) + 1 AS n_cols, count(*) AS entries FROM vec")
def coordinate_matrix(spark, d):
    return mx.shape(b.vector_cells(spark, d))


@query("row_matrix", f"{VEC} SELECT j, v FROM vec")
def row_matrix(spark, d):
    return mx.row_cells(_embeddings(spark, d), "embedding")


@query("indexed_row_matrix", f"""{VEC}, ranked AS (SELECT vec_id, row_number() OVER (ORDER BY label, vec_id) - 1 AS i FROM embeddings)
SELECT r.i, vec.j, vec.v FROM vec JOIN ranked r ON r.vec_id = vec.i""")
def indexed_row_matrix(spark, d):
    indexed = mx.indexed_rows(_embeddings(spark, d), ["label", "vec_id"])
    return mx.row_cells(indexed, "embedding", ["i"])


@query("gramian", f"{VEC}, {GRAM} SELECT i, j, ROUND(v, 6) AS v FROM gram")
def gramian(spark, d):
    return b.rounded(mx.gramian(_embeddings(spark, d), "embedding", WIDTH), "v")


@query("gramian_cells", f"{VEC}, {GRAM} SELECT i, j, ROUND(v, 6) AS v FROM gram")
def gramian_cells(spark, d):
    return b.rounded(mx.gramian_cells(b.vector_cells(spark, d)), "v")


@query("tall_skinny_qr", f"{VEC}, {GRAM} SELECT i, j, ROUND(v, 6) AS v FROM gram")
def tall_skinny_qr(spark, d):
    """RᵀR, which equals the Gramian."""
    r = materialize(mx.qr_r(_embeddings(spark, d), "embedding", WIDTH), "r")
    return b.rounded(mx.matmul(mx.transpose(r), r), "v")


@query("tall_skinny_q", """SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v
FROM (SELECT i, unnest(range(0, n)) AS j FROM (SELECT n, unnest(range(0, n)) AS i FROM (SELECT max(len(embedding)) AS n FROM embeddings)))""")
def tall_skinny_q(spark, d):
    """QᵀQ, which is the identity."""
    cells = b.vector_cells(spark, d)
    q = mx.qr_q(cells, mx.qr_r(_embeddings(spark, d), "embedding", WIDTH), WIDTH)
    return mx.gramian_cells(q).withColumn("v", F.round("v", 6) + F.lit(0.0))


@query("qr_wide", f"{VEC}, {GRAM} SELECT i, j, ROUND(v, 6) AS v FROM gram")
def qr_wide(spark, d):
    """RᵀR of the factor that is made panel by panel, here in panels of 24 columns."""
    r = panels.factor(_embeddings(spark, d), "embedding", WIDTH, panel=24)[1]
    return b.rounded(mx.matmul(mx.transpose(r), r), "v")


@query("qr_wide_q", f"{VEC} SELECT i, j, ROUND(v, 6) AS v FROM vec")
def qr_wide_q(spark, d):
    """Q·R, which is the matrix again."""
    q, r = panels.factor(_embeddings(spark, d), "embedding", WIDTH, ["vec_id"], panel=24)
    cells = mx.row_cells(q.withColumnRenamed("vec_id", "i"), "q", ["i"])
    return mx.matmul(cells, r).withColumn("v", F.round("v", 6) + F.lit(0.0))


@query("coordinate_to_indexed_rows", f"""{VEC} SELECT i, j // 24 AS segment, count(*) AS n, min(j) AS first_j, max(j) AS last_j,
  ROUND(sum(v), 6) AS total FROM vec GROUP BY ALL""")
def coordinate_to_indexed_rows(spark, d):
    segments = mx.indexed_row_segments(b.vector_cells(spark, d), 24)
    keys, total = F.map_keys("cells"), F.aggregate(F.map_values("cells"), F.lit(0.0), lambda a, x: a + x)
    return segments.select("i", "segment", F.size("cells").cast("long").alias("n"), F.array_min(keys).alias("first_j"),
                           F.array_max(keys).alias("last_j"), F.round(total, 6).alias("total"))


@query("block_matrix", f"{VEC} SELECT i // 16 AS bi, j // 16 AS bj, i % 16 AS li, j % 16 AS lj, v FROM vec")
def block_matrix(spark, d):
    return mx.blocks(b.vector_cells(spark, d), 16)


@query("block_matrix_validate", f"""{VEC} SELECT i // 16 AS bi, j // 16 AS bj, count(*) AS cells, CAST(0 AS BIGINT) AS twice,
  CAST(0 AS BIGINT) AS outside, TRUE AS valid FROM vec GROUP BY ALL""")
def block_matrix_validate(spark, d):
    return mx.validate_blocks(mx.blocks(b.vector_cells(spark, d), 16), _counted(spark, d), WIDTH, 16)


@query("dense_from_column_major", f"{VEC} SELECT i AS vec_id, j % 8 AS i, j // 8 AS j, v FROM vec")
def dense_from_column_major(spark, d):
    return mx.dense_from_column_major(_embeddings(spark, d), ["vec_id"], "embedding", 8, 8)


@query("sparse_from_csc", f"{VEC} SELECT i AS vec_id, j % 8 AS i, j // 8 AS j, v FROM vec WHERE v <> 0")
def sparse_from_csc(spark, d):
    """Each vector is packed as the non-zero cells of an 8 × 8 matrix, then unpacked."""
    placed = F.transform("embedding", lambda x, p: F.struct(p.alias("p"), x.alias("x")))
    kept = F.filter(placed, lambda c: c.x != 0)
    starts = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda col: F.size(F.filter("kept", lambda c: c.p < col * 8)))
    packed = _embeddings(spark, d).withColumn("kept", kept).select(
        "vec_id", starts.alias("col_ptr"), F.transform("kept", lambda c: c.p % 8).alias("row_indices"),
        F.col("kept.x").alias("vals"))
    return mx.sparse_from_csc(packed, ["vec_id"], "col_ptr", "row_indices", "vals")


@query("transpose", f"{VEC} SELECT j AS i, i AS j, v FROM vec")
def transpose(spark, d):
    return mx.transpose(b.vector_cells(spark, d))


def _gramian(spark, d):
    return materialize(mx.gramian(_embeddings(spark, d), "embedding", WIDTH), "gramian")


MATMUL = f"""{VEC}, {GRAM}
SELECT a.i, g.j, ROUND(sum(a.v * g.v), 4) AS v FROM vec a JOIN gram g ON a.j = g.i GROUP BY 1, 2"""


@query("matmul", MATMUL)
def matmul(spark, d):
    """The vectors times their own Gramian."""
    gram = _gramian(spark, d)
    return b.rounded(mx.matmul(b.vector_cells(spark, d), gram), "v", digits=4)


@query("matmul_blocked", MATMUL)
def matmul_blocked(spark, d):
    gram = _gramian(spark, d)
    return b.rounded(mx.matmul_blocked(b.vector_cells(spark, d), gram, 128), "v", digits=4)


@query("gemm", f"""{VEC}, {GRAM}, p AS (SELECT a.i, g.j, sum(a.v * g.v) AS v FROM vec a JOIN gram g ON a.j = g.i GROUP BY 1, 2)
SELECT p.i, p.j, ROUND(0.5 * p.v - 2 * vec.v, 4) AS v FROM p JOIN vec ON vec.i = p.i AND vec.j = p.j""")
def gemm(spark, d):
    cells = b.vector_cells(spark, d)
    gram = _gramian(spark, d)
    return b.rounded(mx.gemm(0.5, cells, gram, -2.0, cells), "v", digits=4)


@query("matmul_by_density", f"""{VEC}, {GRAM}, part AS (SELECT * FROM vec WHERE i % 96 < 48 OR (i + j) % 40 = 0)
SELECT a.i, g.j, ROUND(sum(a.v * g.v), 4) AS v FROM part a JOIN gram g ON a.j = g.i GROUP BY 1, 2""")
def matmul_by_density(spark, d):
    """Blocks of full rows take the dense kernel, blocks of scattered cells the join."""
    cells = b.vector_cells(spark, d).where("i % 96 < 48 OR (i + j) % 40 = 0")
    return b.rounded(mx.matmul(cells, _gramian(spark, d), 48), "v", digits=4)


@query("stored_matmul", MATMUL)
def stored_matmul(spark, d):
    """Both operands written in blocks; the second is sent to the blocks of the first."""
    a, g = bl.store(b.vector_cells(spark, d), 64, 8), bl.store(_gramian(spark, d), 64, 8)
    return b.rounded(bl.matmul(a, g), "v", digits=4)


@query("stored_gemv", f"""{VEC}, {MEANS}, p AS (SELECT a.i, sum(a.v * m.v) AS v FROM vec a JOIN m ON a.j = m.i GROUP BY 1)
SELECT vec.j AS i, ROUND(sum(vec.v * p.v), 6) AS v FROM vec JOIN p USING (i) GROUP BY 1""")
def stored_gemv(spark, d):
    """Aᵀ·(A·x): two products with matrices that are written once."""
    cells = b.vector_cells(spark, d)
    a, t = bl.store(cells, 64, 8), bl.store(mx.transpose(cells), 64, 8)
    return b.rounded(bl.gemv(t, bl.gemv(a, _column_means(spark, d))), "v")


# consecutive vectors: (i, j, v) beside the next vector's cells
NEXT = f"{VEC}, nxt AS (SELECT i - 1 AS i, j, v FROM vec)"


def _next(cells):
    return cells.withColumn("i", F.col("i") - 1)


@query("axpy", f"""{NEXT} SELECT i, j, ROUND(sum(v), 6) AS v FROM (SELECT i, j, v FROM vec UNION ALL SELECT i, j, 3 * v FROM nxt) GROUP BY 1, 2""")
def axpy(spark, d):
    cells = b.vector_cells(spark, d)
    return b.rounded(mx.axpy(3.0, _next(cells), cells, ["i", "j"]), "v")


@query("dot", f"{NEXT} SELECT vec.i, ROUND(sum(vec.v * nxt.v), 6) AS dot FROM vec JOIN nxt USING (i, j) GROUP BY 1")
def dot(spark, d):
    cells = b.vector_cells(spark, d)
    return b.rounded(mx.dot(cells, _next(cells), keys=["i"]), "dot")


@query("gemv", f"""{VEC}, {MEANS}, y AS (SELECT i, sum(v) AS v FROM vec GROUP BY 1)
SELECT i, ROUND(sum(v), 6) AS v FROM (SELECT a.i, 2 * sum(a.v * m.v) AS v FROM vec a JOIN m ON a.j = m.i GROUP BY 1
  UNION ALL SELECT i, 0.5 * v FROM y) GROUP BY 1""")
def gemv(spark, d):
    out = mx.gemv(2.0, b.vector_cells(spark, d), _column_means(spark, d), 0.5, _row_sums(spark, d))
    return b.rounded(out, "v")


@query("scal", f"{VEC} SELECT i, j, 2.5 * v AS v FROM vec")
def scal(spark, d):
    return mx.scal(b.vector_cells(spark, d), 2.5)


@query("rank1_update", f"""{VEC}, {GRAM}, {MEANS}
SELECT g.i, g.j, ROUND(g.v + 3 * a.v * c.v, 6) AS v FROM gram g JOIN m a ON a.i = g.i JOIN m c ON c.i = g.j""")
def rank1_update(spark, d):
    gram = _gramian(spark, d)
    return b.rounded(mx.rank1_update(3.0, _column_means(spark, d), gram), "v")


@query("elementwise_mul", f"{NEXT} SELECT vec.i, vec.j, vec.v * nxt.v AS v FROM vec JOIN nxt USING (i, j)")
def elementwise_mul(spark, d):
    cells = b.vector_cells(spark, d)
    return mx.elementwise_mul(cells, _next(cells))


@query("elementwise_div", f"{NEXT} SELECT vec.i, vec.j, ROUND(vec.v / NULLIF(nxt.v, 0), 6) AS v FROM vec LEFT JOIN nxt USING (i, j)")
def elementwise_div(spark, d):
    cells = b.vector_cells(spark, d)
    return b.rounded(mx.elementwise_div(cells, _next(cells)), "v")


@query("elementwise_mul_div", f"""{NEXT} SELECT i, j, ROUND(vec.v * nxt.v / NULLIF(nxt.v, 0), 6) AS v FROM vec JOIN nxt USING (i, j)""")
def elementwise_mul_div(spark, d):
    """The product with the next vectors, divided by them again."""
    cells = b.vector_cells(spark, d)
    return b.rounded(mx.elementwise_div(mx.elementwise_mul(cells, _next(cells)), _next(cells)), "v")


GRID = "(SELECT i, unnest(range(0, 10)) AS j FROM (SELECT unnest(range(0, (SELECT max(vec_id) + 1 FROM embeddings))) AS i))"


@query("fill_matrix", f"SELECT i, j, 0.0::DOUBLE AS zero, 1.0::DOUBLE AS one FROM {GRID}")
def fill_matrix(spark, d):
    zeros = mx.fill(spark, (_counted(spark, d), 10), 0.0).withColumnRenamed("v", "zero")
    return zeros.withColumn("one", F.lit(1.0))


@query("identity_matrix", "SELECT i, i AS j, 1.0::DOUBLE AS v FROM (SELECT unnest(range(0, (SELECT max(vec_id) + 1 FROM embeddings))) AS i)")
def identity_matrix(spark, d):
    return mx.identity(spark, _counted(spark, d))


@query("fill_ndarray", """SELECT i0, i1, unnest(range(0, 3)) AS i2, 7 AS v FROM (SELECT i0, unnest(range(0, 3)) AS i1
FROM (SELECT unnest(range(0, (SELECT max(vec_id) + 1 FROM embeddings))) AS i0))""")
def fill_ndarray(spark, d):
    return mx.fill(spark, (_counted(spark, d), 3, 3), 7)


@query("typed_array_create", f"SELECT i, j, TRUE AS v FROM {GRID}")
def typed_array_create(spark, d):
    return mx.fill(spark, (_counted(spark, d), 10), True)


@query("ndarray_from_flat", f"{VEC} SELECT i AS i0, j // 8 AS i1, j % 8 AS i2, v FROM vec")
def ndarray_from_flat(spark, d):
    flat = mx.flatten(b.vector_cells(spark, d), (_counted(spark, d), WIDTH))
    return mx.ndarray_from_flat(flat, (_counted(spark, d), 8, 8))


@query("reshape", f"""{VEC}, n AS (SELECT count(*) AS n FROM embeddings), lin AS (SELECT i * 64 + j AS p, v FROM vec)
SELECT p % 32 AS i, p // 32 AS j, v FROM lin""")
def reshape(spark, d):
    n = _counted(spark, d)
    return mx.reshape(b.vector_cells(spark, d), (n, WIDTH), (32, 2 * n), read_order="C", write_order="F")


@query("diag_from_vector", f"{VEC} SELECT i, i AS j, ROUND(sum(v), 6) AS v FROM vec GROUP BY 1")
def diag_from_vector(spark, d):
    return b.rounded(mx.diag_from_vector(_row_sums(spark, d)), "v")


@query("flatten", f"{VEC} SELECT i + j * (SELECT max(vec_id) + 1 FROM embeddings) AS pos, v FROM vec")
def flatten(spark, d):
    return mx.flatten(b.vector_cells(spark, d), (_counted(spark, d), WIDTH), "F")


@query("densify", f"""{VEC} SELECT g.i, g.j, CASE WHEN v.v <> 0 THEN v.v ELSE 0.0::DOUBLE END AS v
FROM (SELECT i, unnest(range(0, 64)) AS j FROM (SELECT vec_id AS i FROM embeddings)) g JOIN vec v USING (i, j)""")
def densify(spark, d):
    return mx.densify(b.vector_cells(spark, d).where("v <> 0"), (_counted(spark, d), WIDTH))


@query("array_fill", """SELECT n_nationkey, CAST(CAST(n_regionkey + 1 AS DOUBLE) AS DOUBLE) AS v, unnest(range(0, (n_regionkey + 1) * (n_regionkey + 1))) AS place
FROM nation""")
def array_fill(spark, d):
    filled = mx.array_fill(b.table(spark, d, "nation").withColumn("x", F.col("n_regionkey") + 1), "x")
    return filled.select("n_nationkey", F.posexplode("filled").alias("place", "v")).withColumn("place", F.col("place").cast("long"))
