"""The registered queries of the numbered operators and their SQL."""

from pyspark.sql import functions as F

from tickloom.llm import counting, exact, licenses, minhash, mixing, neighbours, packing, periods, quality, secrets, sql, substring, twofit, whitening
from tickloom.llm.common import documents
from tickloom.session import materialize

QUERIES, SQL = {}, {}


def query(name, text=None):
    def add(fn):
        QUERIES[name] = fn
        if text:
            SQL[name] = text
        return fn

    return add


@query("op4_source_mixing", sql.OP4)
def op4(spark, d):
    """In the order of the documents' first training positions, those that are not taken last."""
    plan = mixing.mix_plan(documents(spark, d)).orderBy(F.asc_nulls_last("first_position"), "id", "size")
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "first_position", "last_position")


@query("op10_exact_dedup", sql.OP10)
def op10(spark, d):
    return exact.duplicate_report(documents(spark, d)).withColumnRenamed("id", "doc_id")


@query("op7_power_of_two_packing")
def op7(spark, d):
    return packing.pack(documents(spark, d), added=True).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def derived_edits():
    """Three edits of every document that follow from its own row: a title line put in front, forty characters
    replaced somewhere within, and the language appended."""
    n = F.length(F.coalesce("text", F.lit(""))).cast("long")
    inner = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), n + 1)
    edits = [(F.lit(0), F.lit(0), F.concat(F.coalesce("source", F.lit("none")), F.lit("\n"))),
             (inner, F.lit(40), F.coalesce(F.substring("text", 3, 25), F.lit("x"))),
             (n, F.lit(0), F.concat(F.lit(" "), F.coalesce("lang", F.lit("none"))))]
    return F.array(*[F.struct(a.cast("long").alias("at"), d.cast("long").alias("drop"), p.alias("put")) for a, d, p in edits])


@query("op5_edit_aware_token_counts")
def op5(spark, d):
    """Trees of all documents are built and written; the edits are applied to the stored trees."""
    trees = materialize(counting.build_trees(documents(spark, d), "doc_id", "text", derived_edits().alias("edits"), added=True), "token-trees")
    done = counting.apply_edits(trees, added=True)
    return done.select(F.col("id").alias("doc_id"), F.col("n_before").alias("n_tokens"),
                       F.element_at("counts", 2).alias("n_tokens_after"), F.length("text").cast("long").alias("n_chars_after"),
                       "encoded_chars")


@query("op1_license_scan")
def op1(spark, d):
    return licenses.summary(licenses.scan(documents(spark, d))).withColumnRenamed("id", "doc_id")


@query("op9_secret_scan")
def op9(spark, d):
    return secrets.summary(secrets.scan(documents(spark, d))).withColumnRenamed("id", "doc_id")


@query("op6_quality_classifier")
def op6(spark, d):
    table = quality.feature_table(documents(spark, d))
    model = quality.fit(table, spark.read.parquet(f"{d}/labels.parquet"))
    return quality.score_table(table, model).select(
        F.col("id").alias("doc_id"), quality.held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_minhash_near_duplicates", sql.OP2)
def op2(spark, d):
    found = minhash.near_duplicates(documents(spark, d), width=3, percent=85)
    return found.withColumnRenamed("id", "doc_id")


@query("op3_substring_dedup", sql.OP3)
def op3(spark, d):
    return substring.remove_repeats(documents(spark, d)).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_nn_descent_search")
def op8(spark, d):
    found = neighbours.nearest(spark.read.parquet(f"{d}/embeddings.parquet"), F.col("id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


@query("op11_embedding_whitening")
def op11(spark, d):
    found = whitening.per_component(whitening.whiten(spark.read.parquet(f"{d}/embeddings.parquet")))
    return found.withColumnRenamed("id", "vec_id")


@query("op12_best_two_fit_packing")
def op12(spark, d):
    return twofit.pack(documents(spark, d), added=True).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def with_derived_runs(docs):
    """Every tenth document by a digest of its id gets a tail that repeats a few of its own words."""
    digest = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(digest / 10)
    words = F.split(F.btrim("text", F.lit(mixing.BLANKS)), r"[\x20\x09-\x0D]+")
    n = F.size("words").cast("long")
    a = g % n
    period = 1 + F.floor((n - a) / (3 + g % 8))
    tail = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get("words", (a + (i - a) % period).cast("int"))))
    chosen = (digest % 10 == 0) & (F.btrim("text", F.lit(mixing.BLANKS)) != "")
    return docs.withColumn("words", F.when(chosen, words)).withColumn(
        "text", F.when(F.col("words").isNotNull(), F.array_join(tail, " ")).otherwise(F.col("text"))).drop("words")


@query("op13_periodic_runs")
def op13(spark, d):
    docs = with_derived_runs(documents(spark, d).select("doc_id", "text"))
    return periods.summary(periods.find_runs(docs)).withColumnRenamed("id", "doc_id")
