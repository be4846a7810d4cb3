"""Mixing sources to target weights along a curriculum that changes over training time.

1. Every source has a weight. The words of all documents are shared out by weight; a source stops at
   ``max_epochs`` times its own size and the rest is shared among the others by weight until none is above.
   Sorted by size per weight, the level at which sharing settles follows from running sums over sources.
2. The schedule of a source is ``w(t) = 1 + slope * (1 - 2t)`` for training time t in 0…1, which integrates to
   ``D(t) = t + slope * (t - t²)`` of its target. Its documents stand in a seeded order; a copy that begins
   after the share y of the source's demand gets the position ``D⁻¹(y)``.
3. Whole passes take every document once each; the last pass is cut where the target ends, within a document
   if need be. Copies of all sources are sorted by position.

Running sums over a source are cut into blocks of the seeded order, about ``BLOCK_ROWS`` documents each; only
block sums are added up per source, so a source that holds a third of all rows is summed by many tasks. Rows that are
alike in id, source and size are one entry of the order with a count, so rows without an id fill no block. Sources
themselves are numbered and summed by range, however many there are.

Defined results: a missing text has size 0, is never taken; a missing source is a source of its own, ordered
last; a source without words has target 0; rows with equal ids and sizes follow each other, by their content; an empty
table gives an empty result. The order is a digest of seed, id and size: reruns agree.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import lookup
from tickloom.operators.rows import row_positions, running_sums
from tickloom.session import materialize

MAX_EPOCHS = 3
BLOCK_ROWS = 5_000
LIKE_ROWS = 10_000
SEED = "mix-1"
BLANKS = " \t\n\x0b\x0c\r"
WORD_AND_BLANKS = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


def word_count(text):
    """How many runs of non-blank characters ``text`` has; 0 for a missing text."""
    marks = F.regexp_replace(F.ltrim(F.coalesce(text, F.lit("")), F.lit(BLANKS)), WORD_AND_BLANKS, "x")
    return F.length(marks).cast("long")


def cyclic_weights(sources: DataFrame, cycle=(1, 2, 3)) -> DataFrame:
    """Weights 1, 2, 3, repeating, along the order of the sources by code point, missing last."""
    placed = row_positions(sources, [F.asc_nulls_last("source")], name="sid").withColumn("sid", F.col("sid") + 1)
    return placed.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in cycle]), ((F.col("sid") - 1) % len(cycle) + 1).cast("int")))


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to ``(source, source_size, weight, sid)``, from running sums over the sources by their room."""
    cap = F.col("source_size") * max_epochs
    stepped = running_sums(sources.withColumn("cap", cap).withColumn("room", F.col("cap") / F.col("weight")), ["room", "sid"], ["cap", "weight"])
    words, weights = stepped.agg(F.sum("source_size"), F.sum("weight")).head()
    level = (F.lit(words) - F.col("before_cap")) / (F.lit(weights) - F.col("before_weight"))
    settled = stepped.withColumn("level", level).where("level <= room").agg(F.min(F.struct("room", "sid", "level"))["level"]).head()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(settled).cast("double") * F.col("weight"))
    return stepped.withColumn("target", target).drop("cap", "room", "before_cap", "before_weight")


def _sources(distinct: DataFrame, max_epochs: int, weigh, slope) -> DataFrame:
    per_source = distinct.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count(F.lit(1)).alias("n"))
    planned = targets(weigh(materialize(per_source, "mix-source-sizes")), max_epochs)
    take = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * max_epochs)
    some = F.col("source_size") > 0
    return materialize(
        planned.withColumn("slope", slope(F.col("weight"))).withColumn("take", take)
        .withColumn("passes", F.when(some, F.floor(F.col("take") / F.col("source_size"))).otherwise(F.lit(0).cast("long")))
        .withColumn("rest", F.when(some, F.col("take") - F.col("passes") * F.col("source_size")).otherwise(F.lit(0).cast("long")))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK_ROWS))), "mix-sources")


def default_slope(weight):
    """Light sources early, heavy ones late: 0.5, 0 and -0.5 for the weights 1, 2 and 3."""
    return (F.lit(2.0) - weight) / 2


def _key():
    """A 128-bit name of a row's ``(id, source, size)``; a number of times is not part of it."""
    return {"k1": F.xxhash64("id", "source", "size"), "k2": F.xxhash64(F.lit(1), "id", "source", "size")}


def _offsets(sized: DataFrame, max_epochs, weigh, slope, seed) -> DataFrame:
    """For every distinct ``(id, source, size)`` its source's plan, how many rows have it (``times``) and the words of the
    source before the first of them (``offset``); written."""
    distinct = materialize(sized.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("times")), "mix-sizes")
    sources = _sources(distinct, max_epochs, weigh, slope)
    s = sources.withColumnRenamed("source", "s_source").drop("n", "weight")
    named = lookup(distinct, s, distinct.source.eqNullSafe(s.s_source), "inner").drop("s_source")
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("size").cast("string")))
    share = F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long") / float(1 << 32)
    placed = materialize(named.withColumn("order_key", digest).withColumn("block", F.floor(share * F.col("blocks"))).withColumn(
        "words", F.col("size") * F.col("times")), "mix-placed")
    sums = placed.groupBy("sid", "block").agg(F.sum("words").alias("block_size"))
    earlier = Window.partitionBy("sid").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(sums.select("sid", "block", F.coalesce(F.sum("block_size").over(earlier), F.lit(0)).alias("base")), "mix-blocks")
    within = Window.partitionBy("sid", "block").orderBy("order_key", F.asc_nulls_first("id"), "size").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("base") + F.coalesce(F.sum("words").over(within), F.lit(0))
    return materialize(lookup(placed, bases, ["sid", "block"], "inner").withColumn("offset", offset).drop(
        "base", "words", "order_key", "block", "blocks"), "mix-offsets")


def _taken(rows: DataFrame) -> DataFrame:
    """The last pass's ``part`` of a row and all its words ``taken``, from its ``nth`` place among the rows like it."""
    rows = rows.withColumn("offset", F.col("offset") + F.col("nth") * F.col("size"))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - F.col("offset")))
    return rows.withColumn("part", part).withColumn("taken", F.col("size") * F.col("passes") + F.col("part"))


def _each(distinct: DataFrame) -> DataFrame:
    """A row for each of the ``times`` rows that are alike, with its number ``nth``; many are made by many tasks."""
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {LIKE_ROWS}"))).alias("chunk")
    nth = F.sequence(F.col("chunk") * LIKE_ROWS, F.least(F.col("times"), (F.col("chunk") + 1) * LIKE_ROWS) - 1)
    few = distinct.where(F.col("times") <= LIKE_ROWS).withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    many = distinct.where(F.col("times") > LIKE_ROWS)
    if many.isEmpty():
        return few
    dealt = many.select("*", chunk).repartition("sid", "offset", "chunk").withColumn("nth", F.explode(nth)).drop("chunk")
    return few.unionByName(dealt)


def _sized(docs, id_col, text_col, source_col, *more):
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                       word_count(F.col(f"`{text_col}`")).alias("size"), *more)


def position(start):
    """Training time at which the demand of the source reaches ``start`` words: the inverse of D."""
    y = start / F.greatest(F.col("take"), F.lit(1))
    b = 1 + F.col("slope")
    return 2 * y / (b + F.sqrt(F.greatest(b * b - 4 * F.col("slope") * y, F.lit(0.0))))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             max_epochs: int = MAX_EPOCHS, weigh=cyclic_weights, slope=default_slope, seed: str = SEED) -> DataFrame:
    """Per document: ``id, source, size, source_size, target, taken, first_position, last_position``, the training times of its
    first and its last copy, missing if it is not taken."""
    planned = _taken(_each(_offsets(_sized(docs, id_col, text_col, source_col), max_epochs, weigh, slope, seed)))
    last = F.when(F.col("part") > 0, F.col("passes")).otherwise(F.col("passes") - 1)
    return planned.select("id", "source", "size", "source_size", "target", "taken",
                          F.when(F.col("taken") > 0, position(F.col("offset"))).alias("first_position"),
                          F.when(F.col("taken") > 0, position(last * F.col("source_size") + F.col("offset"))).alias("last_position"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        max_epochs: int = MAX_EPOCHS, weigh=cyclic_weights, slope=default_slope, seed: str = SEED) -> DataFrame:
    """The copies to train on, in training order: the columns of ``docs``; a row as often as it is taken.

    The copy in which a source's target ends holds its first words only, joined by single spaces. Rows that are alike in id,
    source and size are numbered by their content.
    """
    offsets = _offsets(_sized(docs, id_col, text_col, source_col), max_epochs, weigh, slope, seed)
    plan = offsets.withColumns(_key()).drop("id", "source", "size", "target")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # the plan grows with the documents: joined by shuffling both at every size, a hot key's rows are split by the adaptive join
    rows = _sized(docs, id_col, text_col, source_col, row.alias("row")).withColumns(_key()).join(plan.hint("merge"), ["k1", "k2"])
    once = rows.where("times = 1").withColumn("nth", F.lit(0).cast("long"))
    alike = rows.where("times > 1").withColumn("tie", F.xxhash64("row"))
    if not plan.where("times > 1").isEmpty():
        once = once.unionByName(row_positions(alike, ["tie"], key_cols=["k1", "k2"], name="nth").drop("tie"))
    planned = _taken(once)
    last = F.when(F.col("part") > 0, F.col("passes")).otherwise(F.col("passes") - 1)
    copies = planned.where(F.col("taken") > 0).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    copies = copies.withColumn("position", position(F.col("copy") * F.col("source_size") + F.col("offset")))
    cut = (F.col("copy") == F.col("passes")) & (F.col("part") < F.col("size"))
    text = F.col(f"row.`{text_col}`")
    head = F.array_join(F.slice(F.split(F.ltrim(text, F.lit(BLANKS)), r"[\x20\x09-\x0D]+"), 1, F.col("part").cast("int")), " ")
    sorted_copies = copies.orderBy("position", "sid", "offset", "copy")
    return sorted_copies.select(*[
        (F.when(cut, head).otherwise(text) if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
