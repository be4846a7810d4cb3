"""Packing by power-of-two pieces: no sequence crosses documents and none needs padding.

A document of L tokens (its end mark included) is cut into as many whole sequences of ``max_tokens`` as it fills,
and the rest by the binary digits of its length, longest piece first. Every piece is a sequence of its own whose
length is a power of two; training draws batches from buckets of equal lengths. Pieces depend on their document
only, so nothing is shuffled: a row is read, encoded and cut where it lies, a long text included.

Defined results: a missing or empty text is the end mark alone, one piece of length 1; rows that repeat an id are
packed each; a missing id stays missing; an empty table gives no piece. ``sequence_id`` numbers the pieces by
input split; it is unique, and the same for the same files.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import tokens, vec
from tickloom.llm.common import over_texts

MAX_TOKENS = 2048
ROWS_PER_BATCH = 20_000
BYTES_PER_BATCH = 16 << 20


def piece_lengths(total: int, max_tokens: int = MAX_TOKENS) -> list:
    """Lengths of the pieces of a document of ``total`` tokens; ``max_tokens`` is a power of two."""
    whole, rest = divmod(total, max_tokens)
    return [max_tokens] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = tokens.VOCABULARY,
         max_tokens: int = MAX_TOKENS, added: bool = False) -> DataFrame:
    """Per piece: ``id, start, length, doc_tokens, ids, sequence_id, offset``.

    ``ids`` holds the token ids as little-endian unsigned 32-bit numbers; ``offset`` is 0, since a sequence is one
    piece. ``length`` is the bucket. With ``added``, marks of added tokens in a text become their ids.
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def cut(batches):
        encoder = tokens.encoder(vocabulary, added)
        for batch in batches:
            ids_in = batch.column("id")
            for row, data, offsets in vec.slices(batch.column("text"), tokens.SLICE_BYTES):
                ids, bounds = encoder.encode(data, offsets)
                yield from _batches(ids_in.slice(row, len(offsets) - 1), ids, bounds)

    def _batches(doc_ids, ids, bounds):
        counts = np.diff(bounds)
        lengths = [piece_lengths(n, max_tokens) for n in counts.tolist()]
        pieces = np.fromiter(map(len, lengths), np.int64, len(lengths))
        length = np.fromiter((x for per_doc in lengths for x in per_doc), np.int64, int(pieces.sum()))
        ends = np.cumsum(length)
        doc = np.repeat(np.arange(len(lengths)), pieces)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(ends // (BYTES_PER_BATCH // 4))) + 1, [len(doc)]])
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            low, high = int(ends[a] - length[a]), int(ends[b - 1])
            offs = pa.py_buffer(np.concatenate([[0], (ends[a:b] - low) * 4]).astype(np.int32))
            raw = pa.py_buffer(np.ascontiguousarray(ids[low:high], "<u4"))
            yield pa.RecordBatch.from_arrays([
                doc_ids.take(pa.array(doc[a:b])), pa.array(ends[a:b] - length[a:b] - bounds[doc[a:b]]),
                pa.array(length[a:b]), pa.array(counts[doc[a:b]]),
                pa.Array.from_buffers(pa.binary(), b - a, [None, offs, raw])],
                names=["id", "start", "length", "doc_tokens", "ids"])

    pieces = over_texts(rows, cut, f"id {id_type}, start long, length long, doc_tokens long, ids binary")
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder of files per length, from which batches of equal sequences are read."""
    pieces.write.partitionBy("length").parquet(path)
