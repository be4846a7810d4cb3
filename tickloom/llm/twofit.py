"""Packing documents into as few sequences as possible: greedy filling, then best-two-fit.

A document's ids end with an end mark. One of more than ``max_tokens`` is cut into pieces of exactly that length, of
which the first may be shorter; all others stay whole.

1. Every piece is encoded once and written with its number among the pieces of its length in its task. What the packing
   decides by is the number of pieces of each length, at most ``max_tokens`` counts however many documents there are.
2. *Patterns*, lists of lengths that share a sequence, are made from these counts on the driver, one sequence after
   another: the longest length left, then again and again the longest that still fits. Then the two-fit step: if the
   sequence has a gap, its shortest piece is taken out where two pieces not packed yet fill the larger gap more
   closely, and the pair that fills it most closely takes its place. A pattern is repeated as often as the counts allow,
   since each repetition would decide the same, so the patterns are about as few as the lengths.
3. The pieces of a length are numbered through all tasks by running sums over the tasks' counts; a piece finds its
   sequence and offset by its length and number. No piece is shuffled for that, and no task holds the pieces of a length.

Defined results: a missing or empty text is the end mark alone; rows that repeat an id are packed each; a missing id
stays missing; an empty table gives no piece; extra columns are left alone. Sequences may differ between runs only if
the input is split otherwise; how many there are depends on the documents only.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import tokens, vec
from tickloom.llm.common import lookup, over_texts
from tickloom.session import materialize

MAX_TOKENS = 1024
END_ID = 2
BYTES_PER_BATCH = 16 << 20


class Stock:
    """How many pieces of each length are left; finds the longest length that fits and the pair that fills a gap."""

    def __init__(self, counts: dict, max_tokens: int):
        self.left = np.zeros(max_tokens + 1, np.int64)
        self.left[list(counts)] = list(counts.values())

    def longest(self, room: int, taken: Counter) -> int:
        """The longest length up to ``room`` of which more is left than ``taken``; 0 if none."""
        lengths = np.flatnonzero(self.left[:room + 1])[::-1]
        return next((n for n in lengths.tolist() if self.left[n] > taken[n]), 0)

    def pair(self, above: int, room: int, taken: Counter):
        """Two lengths left, longer first, with the largest sum above ``above`` and up to ``room``; of equal sums the
        one with the longest length. None if there is no such pair."""
        left = self.left[:room + 1].copy()
        for n, k in taken.items():
            if n <= room:
                left[n] -= k
        lengths = np.flatnonzero(left > 0)
        if not len(lengths):
            return None
        fit = np.zeros(room + 1, np.int64)  # the longest length left up to each size
        fit[lengths] = lengths
        fit = np.maximum.accumulate(fit)
        long = lengths[lengths < room]
        short = np.minimum(fit[room - long], long)
        twice = (short == long) & (left[long] < 2)
        short = np.where(twice, fit[long - 1], short)
        sums = np.where(short > 0, long + short, 0)
        if not len(sums) or sums.max() <= above:
            return None
        at = int(len(sums) - 1 - np.argmax(sums[::-1]))
        return int(long[at]), int(short[at])


def next_pattern(stock: Stock, max_tokens: int) -> list:
    """Lengths of the next sequence, longest first."""
    taken, used = Counter(), 0
    while room := max_tokens - used:
        n = stock.longest(room, taken)
        if not n:
            break
        taken[n] += 1
        used += n
    if room and taken.total() > 1:
        shortest = min(taken)
        taken[shortest] -= 1
        pair = stock.pair(shortest, room + shortest, taken + Counter([shortest]))
        taken.update(pair or [shortest])
    return sorted(taken.elements(), reverse=True)


def patterns(counts: dict, max_tokens: int = MAX_TOKENS) -> list:
    """``(times, lengths)`` that use up ``counts``, a number of pieces for each length."""
    stock, out = Stock(counts, max_tokens), []
    while stock.left.any():
        lengths = next_pattern(stock, max_tokens)
        needed = Counter(lengths)
        times = min(int(stock.left[n]) // k for n, k in needed.items())
        for n, k in needed.items():
            stock.left[n] -= times * k
        out.append((times, lengths))
    return out


def places(plan: list):
    """Rows ``(length, low, high, first_sequence, offset)``: the pieces of a length numbered from ``low`` up to ``high``,
    exclusive, lie at ``offset`` in as many sequences from ``first_sequence`` on."""
    used, sequence, out = Counter(), 0, []
    for times, lengths in plan:
        offset = 0
        for n in lengths:
            out.append((n, used[n], used[n] + times, sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    return out


def cut(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, max_tokens: int, end_id: int, added: bool) -> DataFrame:
    """``id, piece, start, length, ids, task, nth``: all pieces; ``nth`` counts those of a length in a task."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        from pyspark import TaskContext

        encoder, seen, task = tokens.encoder(vocabulary, added), np.zeros(max_tokens + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            doc_ids = batch.column("id")
            for row, data, offsets in vec.slices(batch.column("text"), tokens.SLICE_BYTES):
                ids, bounds = encoder.encode(data, offsets, end_id)
                total = np.diff(bounds)
                number = -(-total // max_tokens)
                doc = np.repeat(np.arange(len(total)), number)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
                head = total - (number - 1) * max_tokens
                length = np.where(piece == 0, head[doc], max_tokens)
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * max_tokens)
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                nth = np.empty_like(length)
                nth[order] = seen[ordered] + np.arange(len(ordered)) - np.searchsorted(ordered, ordered)
                seen += np.bincount(length, minlength=max_tokens + 1)
                ends = np.cumsum(length)
                edges = np.concatenate([[0], np.flatnonzero(np.diff(ends // (BYTES_PER_BATCH // 4))) + 1, [len(doc)]])
                for a, b in zip(edges[:-1], edges[1:]):
                    if a < b:
                        low, high = int(ends[a] - length[a]), int(ends[b - 1])
                        offs = pa.py_buffer(np.concatenate([[0], (ends[a:b] - low) * 4]).astype(np.int32))
                        raw = pa.py_buffer(np.ascontiguousarray(ids[low:high], "<u4"))
                        yield pa.RecordBatch.from_arrays(
                            [doc_ids.take(pa.array(row + doc[a:b])), pa.array(piece[a:b].astype(np.int32)), pa.array(start[a:b]),
                             pa.array(length[a:b]), pa.Array.from_buffers(pa.binary(), b - a, [None, offs, raw]),
                             pa.array(np.full(b - a, task, np.int32)), pa.array(nth[a:b])],
                            names=["id", "piece", "start", "length", "ids", "task", "nth"])

    fields = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()),
              ("task", T.IntegerType()), ("nth", T.LongType())]
    return over_texts(rows, run, T.StructType([rows.schema["id"], *[T.StructField(n, t) for n, t in fields]]))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = tokens.VOCABULARY,
         max_tokens: int = MAX_TOKENS, end_id: int = END_ID, added: bool = False) -> DataFrame:
    """Per piece: ``id, piece, start, length, ids, sequence_id, offset``.

    ``ids`` holds the token ids as little-endian unsigned 32-bit numbers. Sequences are numbered from 0. With ``added``,
    marks of added tokens in a text become their ids.
    """
    pieces = materialize(cut(docs, id_col, text_col, vocabulary, max_tokens, end_id, added), "twofit-pieces")
    spark = docs.sparkSession
    per_task = materialize(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "twofit-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(places(patterns(counts, max_tokens)), "length long, low long, high long, first_sequence long, offset long")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "twofit-before")
    numbered = lookup(pieces, before, ["length", "task"], "inner").withColumn("number", F.col("before") + F.col("nth"))
    slot = F.broadcast(plan.withColumnRenamed("length", "of"))
    placed = numbered.join(slot, (F.col("length") == F.col("of")) & (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high")))
    return placed.select("id", "piece", "start", "length", "ids",
                         (F.col("first_sequence") + F.col("number") - F.col("low")).alias("sequence_id"), "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids, doc_ids``: whole sequences for training, pieces in order of their offset. A group
    is one sequence, so at most ``max_tokens`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "id")))
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return whole.select("sequence_id", "n_tokens", joined.alias("ids"), F.transform("p", lambda x: x["id"]).alias("doc_ids"))
