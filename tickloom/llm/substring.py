"""Substring dedup: Rabin-Karp hashes of every window of words, counted over all documents.

A word is removed when a window of ``width`` consecutive words that covers it also starts in a document with a smaller
id. Windows are judged on the input, not on what is left.

1. Every window has a representative, the smallest hash among its runs of ``PART`` words. Equal windows have equal
   representatives, and neighbouring windows mostly share one, so a document has about a fifth as many
   representatives as windows. They are counted over all documents; those of two documents or more set a bit in a map
   of fixed size (``MAP_BITS``), which every task gets. A bit that is set by chance lets a window pass, nothing more: the
   map only spares shuffling windows that cannot repeat.
2. The hashes of all windows that pass are grouped: smallest and largest id per hash, summed up in each task before the
   shuffle, so a passage that many documents share is one row per task. Hashes of two ids or more remain.
3. Every place of such a hash, in a document whose id is larger than the smallest, is a removal. Places of a document
   merge into maximal intervals. A hash with very many places is a hot key on the left side of the join, which the
   adaptive skew join splits.

With far more than ``MAP_BITS`` / 4 repeated representatives the map lets most windows pass; results stay the same and
the shuffles of steps 2 and 3 then carry every window, in proportion to the input.

Defined results: a missing text has no words; rows with a missing id lose nothing and no other document loses words to
them; rows that repeat an id lose nothing to each other; texts shorter than a window lose nothing; an empty table gives
an empty result. Windows are told apart by 64-bit hashes.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import vec
from tickloom.llm.common import lookup, over_texts
from tickloom.session import materialize

WIDTH = 13
PART = 4
MAP_BITS = 1 << 27
BUCKET_BITS = 32_768  # bits of one row of bitmap_construct_agg


class Windows:
    """The words and windows of a slice of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int):
        self.start, self.end, self.first = vec.words(data, offsets, vec.NOT_SPACE)
        words = vec.span_hashes(data, self.start, self.end)
        inside = vec.window_starts(self.first, width)
        self.place = np.flatnonzero(inside)
        self.hash = vec.window_hashes(words, width)[self.place]
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))[self.place]
        self.position = self.place - self.first[self.text]
        part = min(PART, width)
        parts = vec.window_hashes(words, part)
        self.part = vec.sliding_min(parts, width - part + 1)[self.place] if len(parts) > width - part else parts[:0]
        self.tags = text_tags(words, self.first)

    def distinct_parts(self):
        """``(text, representative)`` without repeats within a text."""
        runs = np.flatnonzero(np.concatenate([[True], (self.part[1:] != self.part[:-1]) | (self.text[1:] != self.text[:-1])])
                              ) if len(self.part) else np.zeros(0, np.int64)
        text, part = self.text[runs], self.part[runs]
        _, once = np.unique(vec.mix(part + text.astype(np.uint64) * vec.BASE), return_index=True)
        return text[once], part[once]


def text_tags(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 32-bit digest of each text's words, to tell rows of the same id apart."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * vec.powers(vec.BASE, len(words)), dtype=np.uint64)])
    whole = (sums[first[1:]] - sums[first[:-1]]) * vec.powers(vec.BASE_INVERSE, len(words) + 1)[first[:-1]]
    return (vec.mix(whole + np.diff(first).astype(np.uint64)) >> np.uint64(33)).astype(np.int32)


def map_slot(part: np.ndarray, bits: int) -> np.ndarray:
    return (part & np.uint64(bits - 1)).astype(np.int64)


def repeated_map(rows: DataFrame, width: int, bits: int = MAP_BITS) -> np.ndarray:
    """The map of representatives that two documents or more hold: ``bits`` / 8 bytes; ``bits`` is a power of two."""

    def run(batches):
        for batch in batches:
            for _, data, offsets in vec.slices(batch.column("text")):
                _, part = Windows(data, offsets, width).distinct_parts()
                yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64))], names=["part"])

    shared = over_texts(rows.select("text"), run, "part long").groupBy("part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slot = F.col("part").bitwiseAND(F.lit(bits - 1)) + 1
    parts = shared.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))
    out = np.zeros(max(bits, BUCKET_BITS) // 8, np.uint8)
    for r in parts.toLocalIterator():
        at = (r.bucket - 1) * (BUCKET_BITS // 8)
        out[at:at + BUCKET_BITS // 8] = np.frombuffer(r.bitmap, np.uint8)
    return out


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
             bits: int = MAP_BITS) -> DataFrame:
    """``id, tag, starts, ends``, written: the maximal removed intervals of every row that loses words, in words from
    0, ends exclusive. ``tag`` tells rows of the same id apart."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("id IS NOT NULL")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(repeated_map(rows, width, bits))
    kind = rows.schema["id"].dataType

    def passing(with_places):
        def run(batches):
            bitmap = shared.value
            for batch in batches:
                ids = batch.column("id")
                for row, data, offsets in vec.slices(batch.column("text")):
                    w = Windows(data, offsets, width)
                    slot = map_slot(w.part, bits)
                    hit = np.flatnonzero(bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                    columns = {"h": pa.array(w.hash[hit].view(np.int64)), "id": ids.take(pa.array(row + w.text[hit]))}
                    if with_places:
                        columns |= {"tag": pa.array(w.tags[w.text[hit]]), "pos": pa.array(w.position[hit].astype(np.int32))}
                    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        fields = [T.StructField("h", T.LongType()), T.StructField("id", kind)]
        return over_texts(rows, run, T.StructType(fields + [T.StructField(c, T.IntegerType()) for c in ("tag", "pos")] * with_places))

    lowest = passing(False).groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    lowest = materialize(lowest.select("h", "low"), "repeated-windows")
    places = passing(True).join(lowest, "h").where("id > low").groupBy("id", "tag").agg(F.collect_set("pos").alias("pos"))

    def merge(batches):
        for batch in batches:
            starts, ends = [], []
            for pos in batch.column("pos"):
                p = np.sort(pos.values.to_numpy())
                cut = np.flatnonzero(np.diff(p) > width)
                starts.append(p[np.concatenate([[0], cut + 1])])
                ends.append(p[np.concatenate([cut, [len(p) - 1]])] + width)
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (starts, ends)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tag"), *lists], names=["id", "tag", "starts", "ends"])

    schema = T.StructType([T.StructField("id", kind), *T.StructType.fromDDL("tag int, starts array<int>, ends array<int>")])
    return materialize(over_texts(places, merge, schema), "removed-intervals")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                   bits: int = MAP_BITS) -> DataFrame:
    """Per row: ``id, n_words, n_removed, kept, starts, ends``; ``kept`` holds the words that stay, joined by one space."""
    found = removals(docs, id_col, text_col, width, bits)
    per_id = materialize(found.groupBy("id").agg(F.to_json(F.collect_list(F.struct("tag", "starts", "ends"))).alias("cuts")), "removed-by-id")
    rows = lookup(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), per_id, "id")
    parsed = F.from_json("cuts", "array<struct<tag:int,starts:array<int>,ends:array<int>>>")

    def run(batches):
        for batch in batches:
            ids, cuts = batch.column("id"), batch.column("cuts")
            for row, data, offsets in vec.slices(batch.column("text")):
                start, end, first = vec.words(data, offsets, vec.NOT_SPACE)
                tags = None
                out = {c: [] for c in ("n_words", "n_removed", "kept", "starts", "ends")}
                for i in range(len(offsets) - 1):
                    words = data[offsets[i]:offsets[i + 1]].tobytes().split()
                    cut, kept = cuts[row + i].as_py(), words
                    if cut and tags is None:
                        tags = text_tags(vec.span_hashes(data, start, end), first)
                    cut = next((c for c in cut or () if c["tag"] == tags[i]), {"starts": [], "ends": []})
                    if cut["starts"]:
                        edges = [0, *(x for pair in zip(cut["starts"], cut["ends"]) for x in pair), len(words)]
                        kept = [w for a, b in zip(edges[0::2], edges[1::2]) for w in words[a:b]]
                    for c, v in zip(out, (len(words), len(words) - len(kept), b" ".join(kept).decode(), cut["starts"], cut["ends"])):
                        out[c].append(v)
                types = dict(zip(out, (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()))))
                yield pa.RecordBatch.from_arrays([ids.slice(row, len(offsets) - 1), *(pa.array(v, types[c]) for c, v in out.items())],
                                                 names=["id", *out])

    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL(
        "n_words long, n_removed long, kept string, starts array<int>, ends array<int>")])
    return over_texts(rows.select("id", "text", parsed.alias("cuts")), run, schema)
