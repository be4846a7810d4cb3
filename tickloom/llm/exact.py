"""Exact duplicates: an extendible-hash index on shared files, chains compared byte by byte.

Texts count as equal when they are identical after every run of blanks (space, tab, line feed, vertical tab,
form feed, carriage return) became one space.

1. Every row becomes an index entry (id, 64-bit hash, SHA-256); repeated rows are one entry with a count.
   Entries are counted per hash before anything else, so copies never fill a bucket.
2. The directory doubles until no bucket holds more than ``capacity`` hashes, or until its buckets are single hashes. It
   starts with as many bits as even hashes need; only buckets that are overfull then are looked at again, with more bits.
   Slots that need fewer bits share a bucket, as usual in extendible hashing. A bucket is a range of the hash; the index is
   written to the shared folder in the order of the hash.
3. A hash that occurs once needs nothing more. The texts of the other hashes go to the *owner* of their bucket, together with
   the bucket's part of the index. An owner chains the texts of a hash: equal bytes are one link, texts that collide
   are links of their own, and the links' rows must add up to the index's count. Buckets hold equally many hashes;
   copies of a text are merged in up to ``COPY_GROUPS`` groups of tasks, in each task first, before they are sent, so an owner
   gets that many rows of a text at most, however many copies there are.

Defined results: a missing text is empty; empty texts are equal to each other; missing ids come after all
others (``keep_id`` is missing when all ids of a group are); of rows that repeat the id which stays, one is
kept. An empty table gives an empty result. Extra columns are left alone whatever they are called.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SPACE_RUN, lookup
from tickloom.session import materialize

BUCKET_CAPACITY = 4_000
FIRST_BITS = 20
MORE_BITS = 8
HASH_BITS = 64
COPY_GROUPS = 16


def normal_text(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), normal_text(F.col(f"`{text_col}`")).alias("text"), *more)
    return plain.withColumn("h", F.xxhash64("text"))


def prefix(h, bits):
    """The first ``bits`` bits of a hash, a number or a column, as a signed number: prefixes have the order of the hashes."""
    shift = F.lit(HASH_BITS) - bits
    return F.when(F.lit(0) == bits, F.lit(0).cast("long")).otherwise(F.call_function("shiftright", F.col(h), shift.cast("int")))


def directory(keys: DataFrame, capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """``(slot, bits, depth, bucket, size)``: a row for every used slot of the directory, written.

    ``keys`` has one row per hash ``h``. A slot is a prefix of ``bits`` bits; its bucket holds the hashes that share the first
    ``depth`` bits, is named by the smallest hash with them, and has ``size`` hashes: at most ``capacity`` unless ``depth``
    is all bits of the hash.
    """
    total, known, done = keys.count(), None, 0
    bits = min(FIRST_BITS, max(0, math.ceil(math.log2(max(1, total) / capacity))) + 4)
    while True:
        slots = keys.groupBy(prefix("h", F.lit(bits)).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        levels = slots.select("slot", "n", F.explode(F.sequence(F.lit(done), F.lit(bits))).alias("depth"))
        shift = (F.lit(bits) - F.col("depth")).cast("int")
        levels = levels.withColumn("first", F.call_function("shiftleft", F.call_function("shiftright", "slot", shift), shift))
        sizes = levels.groupBy("depth", "first").agg(F.sum("n").alias("size"))
        # with all bits a slot is one hash, which may have any size
        fits = (F.col("size") <= capacity) | (F.col("depth") == HASH_BITS)
        chosen = levels.join(sizes.where(fits), ["depth", "first"]).groupBy("slot").agg(F.min(F.struct("depth", "first", "size")).alias("b"))
        low = F.call_function("shiftleft", F.col("b.first"), F.lit(HASH_BITS - bits)) if bits else F.lit(-(1 << 63))
        part = materialize(slots.join(chosen, "slot", "left").select(
            "slot", F.lit(bits).alias("bits"), F.col("b.depth").alias("depth"), low.alias("bucket"), F.col("b.size").alias("size")), "exact-directory")
        split = part.where("depth IS NULL").select("slot")
        known = part.where("depth IS NOT NULL") if known is None else known.unionByName(part.where("depth IS NOT NULL"))
        if bits == HASH_BITS or split.isEmpty():
            return known
        keys = materialize(lookup(keys.withColumn("slot", prefix("h", F.lit(bits))), split, "slot", "inner").select("h"), "exact-overfull")
        done, bits = bits, min(HASH_BITS, bits + MORE_BITS)


def find_buckets(keys: DataFrame, table: DataFrame) -> DataFrame:
    """``keys`` with ``bucket``, looked up by the prefixes of the directory's lengths, the longest that has a slot."""
    for r in table.select("bits").distinct().orderBy("bits").collect():
        slots = materialize(table.where(F.col("bits") == r.bits).select("slot", F.col("bucket").alias("found")), "exact-slots")
        keys = lookup(keys.withColumn("slot", prefix("h", F.lit(r.bits))), slots, "slot")
        keys = keys.withColumn("bucket", F.coalesce("found", "bucket") if "bucket" in keys.columns else F.col("found")).drop("found", "slot")
    return keys if "bucket" in keys.columns else keys.withColumn("bucket", F.lit(None).cast("long"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = BUCKET_CAPACITY) -> tuple[DataFrame, DataFrame]:
    """``entries (id, h, sha, times)`` and ``index (bucket, h, n)``, both written, the index in the order of the hash."""
    entries = materialize(
        _keyed(docs, id_col, text_col).select("id", "h", F.sha2("text", 256).alias("sha"))
        .groupBy("id", "h", "sha").agg(F.count(F.lit(1)).alias("times")), "exact-entries")
    keys = materialize(entries.groupBy("h").agg(F.sum("times").alias("n")), "exact-keys")
    placed = find_buckets(keys, directory(keys.select("h"), capacity))
    return entries, materialize(placed.select("bucket", "h", "n").repartitionByRange("h").sortWithinPartitions("h"), "exact-index")


def chains(docs: DataFrame, index: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(h, link, sha, keep_id, group_size)``: the links of every hash that several rows have, made by its owner."""
    shared = index.where(F.col("n") > 1)
    texts = lookup(_keyed(docs, id_col, text_col), shared, "h", "inner")
    group = F.pmod(F.spark_partition_id(), F.lit(COPY_GROUPS))
    merged = texts.groupBy(group.alias("copy_group"), "bucket", "h", "text").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("rows"))
    sent = merged.select("bucket", "h", "text", "low", "rows", F.lit(None).cast("long").alias("n"))
    listed = shared.select("bucket", "h", F.lit(None).cast("string").alias("text"), F.lit(None).cast(sent.schema["low"].dataType).alias("low"),
                           F.lit(None).cast("long").alias("rows"), "n")
    owned = sent.unionByName(listed).repartition("bucket")
    links = owned.groupBy("bucket", "h", "text").agg(F.min("low").alias("keep_id"), F.sum("rows").alias("group_size"), F.max("n").alias("n"))
    link = F.struct(F.sha2("text", 256).alias("sha"), "keep_id", "group_size")
    chain = links.groupBy("bucket", "h").agg(F.sort_array(F.collect_list(F.when(F.col("text").isNotNull(), link))).alias("chain"),
                                             F.sum("group_size").alias("rows"), F.max("n").alias("n"))
    wrong = F.raise_error(F.concat(F.lit("the index does not count the rows of hash "), F.col("h").cast("string")))
    checked = F.when(F.col("rows").eqNullSafe(F.col("n")), F.col("chain")).otherwise(wrong)
    return chain.select("h", F.posexplode(checked).alias("link", "c")).select("h", "link", "c.*")


def resolve(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """One row per entry: ``id, h, sha, times, keep_id, group_size, first`` where ``first`` marks the entry
    of which one row stays."""
    entries, index = build_index(docs, id_col, text_col, capacity)
    groups = materialize(chains(docs, index, id_col, text_col).drop("link"), "exact-chains")
    found = lookup(entries, groups, ["h", "sha"])
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep_id"))
    return found.select("id", "h", "sha", "times", keep.alias("keep_id"),
                        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                        F.col("id").eqNullSafe(keep).alias("first"))


def duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """One row per row of ``docs``: ``id, keep_id, group_size, kept, text_sha256``."""
    rows = resolve(docs, id_col, text_col, capacity).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return rows.select("id", "keep_id", "group_size", (F.col("first") & (F.col("nth") == 1)).alias("kept"),
                       F.col("sha").alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are matched with the dropped entries by id and hash; only when an id that stays is repeated with
    the same text are those few rows numbered to keep one of them.
    """
    report = materialize(resolve(docs, id_col, text_col, capacity), "exact-resolved")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = _keyed(docs, id_col, text_col, whole).withColumn("sha", F.sha2("text", 256))

    def matched(table, how):
        t = table.select(F.col("id").alias("t_id"), F.col("h").alias("t_h"), F.col("sha").alias("t_sha"))
        return lookup(rows, t, rows.id.eqNullSafe(t.t_id) & (rows.h == t.t_h) & (rows.sha == t.t_sha), how)

    repeated = report.where(F.col("first") & (F.col("times") > 1))
    gone = report.where(~F.col("first") | (F.col("times") > 1))
    kept = matched(gone, "left_anti").select("row.*")
    if repeated.isEmpty():
        return kept
    one = matched(repeated, "left_semi").groupBy("id", "h", "sha").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.unionByName(one.select("row.*"))
