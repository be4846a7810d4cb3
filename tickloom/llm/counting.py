"""Token counts that follow edits: a segment tree per document over pieces of its text.

Leaves are runs of about ``LEAF_UNITS`` units (see ``tokens``); a leaf ends where a split changes no token, so the
count of a text is the sum over its leaves. The tree is an array in heap order, node i above 2i and 2i + 1, with
characters and tokens of every subtree; it is stored beside the document.

An edit ``(at, drop, put)`` replaces ``drop`` characters at character ``at`` by ``put``. The leaves that it touches
are found by going down the tree; they are widened by one leaf on either side where the edit reaches their border,
since a border is only safe while the characters on both sides of it stay. With added tokens they are widened until
no mark that the edit completes can lie across a border. That region alone is encoded again,
its units are dealt over the same leaf slots, and the sums above them are renewed.

Defined results: a missing text is empty and counts 0 tokens; edits of a document are applied from the largest ``at``
to the smallest, so all positions are those of the text before (equal ones in the reverse of their order); positions
beyond the end append, and what is dropped ends with the text; a missing ``at`` or ``drop`` is 0, a missing ``put``
is empty. Rows that repeat an id are counted each; an empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import tokens, vec
from tickloom.llm.common import over_texts

LEAF_UNITS = 64


def heap(leaves: np.ndarray) -> np.ndarray:
    """Sums in heap order over a power of two of leaves; entry 0 is unused, entry 1 the total."""
    size = 1
    while size < len(leaves):
        size *= 2
    tree = np.zeros(2 * size, np.int64)
    tree[size:size + len(leaves)] = leaves
    while size > 1:
        tree[size // 2:size] = tree[size:2 * size].reshape(-1, 2).sum(axis=1)
        size //= 2
    return tree


def descend(tree: np.ndarray, place: int) -> tuple[int, int]:
    """``(leaf, before)``: the leaf in which character ``place`` lies, and the characters before that leaf."""
    node, size, before = 1, len(tree) // 2, 0
    while node < size:
        node *= 2
        if place - before >= tree[node]:
            before += int(tree[node])
            node += 1
    return node - size, before


def renew(tree: np.ndarray, low: int, values) -> None:
    """Set the leaves from ``low`` on and the sums above them."""
    size = len(tree) // 2
    a, b = size + low, size + low + len(values) - 1
    tree[a:b + 1] = values
    while a > 1:
        a, b = a // 2, b // 2
        tree[a:b + 1] = tree[2 * a:2 * b + 2].reshape(-1, 2).sum(axis=1)


class Document:
    """A text with its tree."""

    def __init__(self, text: str, chars: np.ndarray, counts: np.ndarray):
        self.text, self.chars, self.counts = text, chars, counts

    def open(self, at: int, drop: int, put: str, reach: int = 1) -> str:
        """Change the text; returns the region to encode again and keeps its place in ``region``. Its borders keep
        ``reach`` characters between them and the change."""
        total, size = len(self.text), len(self.chars) // 2
        at = min(max(at, 0), total)
        end = min(at + max(drop, 0), total)
        low, begin = descend(self.chars, at)
        while low and begin > at - reach:  # the border before the region keeps the characters on both its sides
            low -= 1
            begin -= int(self.chars[size + low])
        high, before = descend(self.chars, end)
        stop = before + int(self.chars[size + high])
        while high < size - 1 and stop < end + max(2, reach):
            high += 1
            stop += int(self.chars[size + high])
        region = self.text[begin:at] + put + self.text[end:stop]
        self.text = self.text[:begin] + region + self.text[stop:]
        self.region = (low, high - low + 1)
        return region

    def close(self, chars: np.ndarray, counts: np.ndarray) -> None:
        """Set the sums of the region's leaves and all above them."""
        low, leaves = self.region
        renew(self.chars, low, np.pad(chars, (0, leaves - len(chars))))
        renew(self.counts, low, np.pad(counts, (0, leaves - len(counts))))


def leaf_sums(encoder, texts, leaves: list | None = None) -> list:
    """Per text: characters and tokens of its leaves, of ``LEAF_UNITS`` units each or in ``leaves[i]`` parts."""
    out = []
    for _, data, offsets in vec.slices(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), tokens.SLICE_BYTES):
        start, end, first = tokens.units(data, offsets, encoder.marks)
        total = np.concatenate([[0], np.cumsum(encoder.counts(data, start, end))]) if len(start) else np.zeros(1, np.int64)
        is_char = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        byte = np.append(start, len(data))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            step = LEAF_UNITS if leaves is None else max(1, -(-(b - a) // leaves[len(out)]))
            cut = np.append(np.arange(a, b, step), b)
            out.append((np.diff(is_char[byte[cut]]), np.diff(total[cut])))
    return out


def _trees(encoder, texts: pa.Array) -> list:
    return [(heap(chars), heap(counts)) for chars, counts in leaf_sums(encoder, texts)]


def _edited(encoder, documents: list, edits: list) -> list:
    """Apply each document's edits; returns the characters encoded again. The regions of all documents' next edits
    are encoded together."""
    queues = [sorted(enumerate(e or []), key=lambda x: (x[1]["at"] or 0, x[0])) for e in edits]
    encoded = [0] * len(documents)
    while any(queues):
        active = [i for i, q in enumerate(queues) if q]
        regions = []
        for i in active:
            _, e = queues[i].pop()
            regions.append(documents[i].open(e["at"] or 0, e["drop"] or 0, e["put"] or "", encoder.reach))
            encoded[i] += len(regions[-1])
        sums = leaf_sums(encoder, regions, [documents[i].region[1] for i in active])
        for i, s in zip(active, sums):
            documents[i].close(*s)
    return encoded


ROWS_AT_ONCE = 1_000
LISTS = {c: T.StructField(c, T.ArrayType(T.LongType())) for c in ("chars", "counts")}
REPORT = [T.StructField(c, T.LongType()) for c in ("n_before", "encoded_chars")]


def _pieces(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _apply(encoder, batch, trees):
    """The result rows of a batch with columns ``id, text, edits`` and the tree of every row."""
    documents = [Document(t, *tree) for t, tree in zip(batch.column("text").to_pylist(), trees)]
    before = [int(d.counts[1]) for d in documents]
    encoded = _edited(encoder, documents, batch.column("edits").to_pylist())
    trees = [pa.array([getattr(d, c) for d in documents], pa.list_(pa.int64())) for c in LISTS]
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), pa.array([d.text for d in documents], pa.string()), *trees, pa.array(before, pa.int64()),
         pa.array(encoded, pa.int64())], names=["id", "text", *LISTS, "n_before", "encoded_chars"])


def _rows(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *more)


def build_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more,
                vocabulary: str = tokens.VOCABULARY, added: bool = False) -> DataFrame:
    """``id, text, …, chars, counts``: every document with its tree. ``more`` are columns to carry along; ``added`` as
    in ``tokens``, the same for the edits."""
    rows = _rows(docs, id_col, text_col, *more)

    def run(batches):
        encoder = tokens.encoder(vocabulary, added)
        for batch in _pieces(batches):
            trees = zip(*_trees(encoder, batch.column("text")))
            lists = [pa.array(list(t), pa.list_(pa.int64())) for t in trees] or [pa.array([], pa.list_(pa.int64()))] * 2
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, *LISTS])

    return over_texts(rows, run, T.StructType([*rows.schema.fields, *LISTS.values()]))


def token_counts(trees: DataFrame) -> DataFrame:
    """``id, n_tokens``, read off the roots."""
    return trees.select("id", F.element_at("counts", 2).alias("n_tokens"))


def attach_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """Rows with an ``id`` get an ``edits`` array from a table ``(id, seq, at, drop, put)``; ids must be unique in
    ``docs``. The edits of one document are one list, since they follow each other."""
    row = F.struct("seq", *[F.col(c).cast(t).alias(c) for c, t in (("at", "long"), ("drop", "long"), ("put", "string"))])
    per_doc = edits.groupBy("id").agg(F.sort_array(F.collect_list(row)).alias("e")).select(
        "id", F.transform("e", lambda e: F.struct(e["at"].alias("at"), e["drop"].alias("drop"), e["put"].alias("put"))).alias("edits"))
    return docs.join(per_doc, "id", "left")


def apply_edits(trees: DataFrame, vocabulary: str = tokens.VOCABULARY, added: bool = False) -> DataFrame:
    """``id, text, chars, counts`` after the row's ``edits`` (a missing list changes nothing), ``n_before``, and
    ``encoded_chars``, the characters that were encoded again."""
    rows = trees.select("id", "text", "edits", "chars", "counts")

    def run(batches):
        encoder = tokens.encoder(vocabulary, added)
        for batch in _pieces(batches):
            pairs = zip(*([v.values.to_numpy().copy() for v in batch.column(c)] for c in LISTS))
            yield _apply(encoder, batch, pairs)

    return over_texts(rows, run, T.StructType([rows.schema["id"], rows.schema["text"], *LISTS.values(), *REPORT]))


def recount(docs: DataFrame, edits, id_col: str = "doc_id", text_col: str = "text",
            vocabulary: str = tokens.VOCABULARY, added: bool = False) -> DataFrame:
    """``build_trees`` and ``apply_edits`` in one pass, for edits that are a column of the rows themselves."""
    rows = _rows(docs, id_col, text_col, edits.alias("edits"))

    def run(batches):
        encoder = tokens.encoder(vocabulary, added)
        for batch in _pieces(batches):
            yield _apply(encoder, batch, _trees(encoder, batch.column("text")))

    return over_texts(rows, run, T.StructType([rows.schema["id"], rows.schema["text"], *LISTS.values(), *REPORT]))
