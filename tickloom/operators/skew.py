"""Equi-join that splits hot keys."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import materialize

SALT_ROWS = 10_000
BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df`` take at most ``limit`` bytes: text as long as it is, other values 16 bytes.

    Measured by a job; ``materialize`` a costly ``df`` first. Nested columns are never called small.
    """
    size = total_bytes(df)
    return size is not None and (df.agg(size).head()[0] or 0) <= limit


def total_bytes(df: DataFrame):
    """The aggregate that ``fits_broadcast`` measures; None for nested columns."""
    kinds = [f.dataType for f in df.schema.fields]
    if any(isinstance(k, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for k in kinds):
        return None
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    row_bytes = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(16 * len(kinds)))
    return F.sum(row_bytes.cast("long"))


def _salt_counts(df: DataFrame, on, name: str) -> DataFrame:
    """``(on…, name)`` for the hot keys of ``df``: over how many salts to deal their rows."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > SALT_ROWS)
    return materialize(counts.select(*on, F.ceil(F.col("_n") / SALT_ROWS).cast("int").alias(name)), "hot-keys")


def _dealt(df: DataFrame, hot: DataFrame, on, name: str) -> DataFrame:
    """``df`` with a salt: 0 for rows of ordinary keys, the salts in turn for those of hot ones.

    Only the rows of hot keys are written, with their running number in the task that wrote them, so rows that are alike
    are dealt as evenly as others, and a task that runs again reads the same numbers.
    """
    numbered = materialize(df.join(hot, on).withColumn("_n", F.monotonically_increasing_id()), "hot-rows")
    dealt = numbered.withColumn(name, F.pmod("_n", "_salts").cast("int")).select(*df.columns, name)
    return df.join(hot, on, "left_anti").withColumn(name, F.lit(0)).unionByName(dealt)


def skew_join(left: DataFrame, right: DataFrame, on, sides=("left", "right")) -> DataFrame:
    """Inner equi-join in which no key's pairs land in one task.

    A key is hot on a side when it holds more than ``SALT_ROWS`` rows there. Its rows are dealt over
    salts of about that many rows in turn, and the other side's rows of that key are copied
    once per salt, so a task gets about ``SALT_ROWS`` squared pairs of a key, however many the key has.
    Other keys keep one copy under salt 0; without hot keys it is the plain join. Every pair appears exactly once. The
    table of hot keys is broadcast when its measured size allows; otherwise it is joined like any other table.

    ``sides`` names the sides whose keys are counted, each at the price of one more pass over the key
    column; leave out a side whose keys are known to be even. A side with hot keys is read once more for their rows.
    """
    on = [on] if isinstance(on, str) else list(on)
    frames = {"left": left, "right": right}
    hot = {side: _salt_counts(frames[side], on, "_salts") for side in sides}
    hot = {side: F.broadcast(t) if fits_broadcast(t) else t for side, t in hot.items() if not t.isEmpty()}
    for side, keys in hot.items():
        frames[side] = _dealt(frames[side], keys, on, f"_{side}_salt")
    for side, keys in hot.items():
        other = "right" if side == "left" else "left"
        copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
        frames[other] = frames[other].join(keys, on, "left").withColumn(f"_{side}_salt", copies).drop("_salts")
    salts = [f"_{side}_salt" for side in hot]
    return frames["left"].join(frames["right"], [*on, *salts]).drop(*salts)


def lookup_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Inner equi-join with a side that is usually small: broadcast when its counted size allows,
    otherwise shuffled with the hot keys of both sides split."""
    if fits_broadcast(right):
        return left.join(F.broadcast(right), on)
    return skew_join(left, right, on)
