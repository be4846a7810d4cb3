"""Periodic runs of words: suffix-tree extensions of Lyndon roots.

A run is a stretch of consecutive words with smallest period q, at least ``max(min_words, min_exponent * q)`` words
long, that no neighbouring word extends. By the theorem on runs, every run has a Lyndon root under the order of words
or under the reversed one: a place i whose longest Lyndon word, which ends before the next smaller suffix, has length q.

1. A word of a run that lies q or more behind its start equals the word q before it. So those words form a stretch in
   which every word stands again within a distance of q, and q is at most 1 / (min_exponent - 1) of the stretch. Words
   outside such stretches are in no run and get no tree; the rest are *regions*, widened to hold any run's start.
2. The regions of a slice are strung together, each with an end mark that occurs once, so nothing extends across them.
   A suffix tree of the string (Ukkonen) gives the ranks of all suffixes in both orders, and with them the longest
   Lyndon word at every place. A second tree, of the reversal, and the Euler tours of both give extensions to the right
   and to the left in constant time.
3. Every candidate (place, length of its Lyndon word) is extended both ways; what is long enough is a run. Equal runs
   found from several roots are one.

Everything is per document, so nothing is shuffled. A task needs about one kilobyte for each word of the region string,
which holds ``STRING_WORDS`` words, or one region that is longer, beside a slice of texts.

Defined results: a missing or empty text has no words and no runs; a missing id stays missing, rows that repeat an id
are read each; an empty table gives an empty result; extra columns are left alone. Words are told apart by 64-bit hashes.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import vec
from tickloom.llm.common import over_texts
from tickloom.llm.suffix_tree import SuffixTree

MIN_WORDS = 6
MIN_EXPONENT = 4
STRING_WORDS = 20_000


def repeat_distances(hashes: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """For every word the distance to the last equal word before it in its text; 0 where there is none.

    Words are compared by the high bits of a digest: two that differ may count as equal, which only keeps more.
    """
    bits = np.uint64(max(1, int(len(hashes)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    keys = vec.mix(hashes + (text_of.astype(np.uint64) + np.uint64(1)) * vec.BASE) & ~low | np.arange(len(hashes), dtype=np.uint64)
    keys.sort()
    place = (keys & low).astype(np.int64)
    same = np.flatnonzero(keys[1:] >> bits == keys[:-1] >> bits) + 1
    out = np.zeros(len(hashes), np.int64)
    out[place[same]] = place[same] - place[same - 1]
    return out


def regions(distance: np.ndarray, first: np.ndarray, min_words: int, min_exponent: int):
    """``(start, stop)`` of the parts of the texts that may hold a run, in words of the slice, without overlaps.

    ``first`` numbers each text's first word, with one entry more at the end.
    """
    place = np.flatnonzero(distance)
    times, least = min_exponent - 1, min(max(min_words, min_exponent * q) - q for q in range(1, min_words + 1))
    while len(place):
        heads = np.flatnonzero(np.diff(place, prepend=-2) != 1)
        length = np.diff(np.append(heads, len(place)))
        each = np.repeat(length, length)
        good = (distance[place] * times <= each) & (each >= least)
        if good.all():
            break
        place = place[good]
    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = place[heads]
    text = np.searchsorted(first, start, "right") - 1
    low, high = np.maximum(start - length // times - 1, first[text]), np.minimum(start + length + 1, first[text + 1])
    order = np.argsort(low, kind="stable")  # a long stretch may reach back before a short one ahead of it
    low, far, text = low[order], np.maximum.accumulate(high[order]), text[order]
    new = np.append(True, (low[1:] >= far[:-1]) | (text[1:] != text[:-1]))
    return low[new], far[np.append(np.flatnonzero(new)[1:] - 1, len(far) - 1)]


def lyndon_lengths(ranks: list) -> np.ndarray:
    """Length of the longest Lyndon word at every place: the distance to the next smaller suffix."""
    out, stack = [0] * len(ranks), []
    for i, rank in enumerate(ranks):
        while stack and ranks[stack[-1]] > rank:
            j = stack.pop()
            out[j] = i - j
        stack.append(i)
    return np.array(out, np.int64)


def string_runs(symbols: np.ndarray, lengths: np.ndarray, min_words: int, min_exponent: int):
    """Runs ``(start, length, period)`` of several strings: ``symbols`` one after another, from 0, ``lengths`` of each.

    Starts count along ``symbols``.
    """
    n, ends = len(lengths), np.cumsum(lengths)
    marked = np.insert(symbols + n, ends, np.arange(n))  # the k-th end mark is number k, words come after all marks
    text = marked.tolist()
    tree, back = SuffixTree(text), SuffixTree(text[-2::-1] + text[-1:])
    last, found = len(text) - 1, []
    for largest_first in (False, True):
        length = lyndon_lengths(tree.suffix_ranks(largest_first, n))
        place = np.flatnonzero((marked >= n) & (length > 0))
        found.append(place * len(text) + length[place])
    place, period = np.divmod(np.unique(np.concatenate(found)), len(text))
    right = tree.tour().common(place, place + period)
    left = back.tour().common(last - place, last - place - period)
    runs = np.stack([place - left, period + left + right, period])
    runs = runs[:, runs[1] >= np.maximum(min_words, min_exponent * period)]
    runs = runs[:, np.unique(runs[0] * len(text) + runs[2], return_index=True)[1]]  # start and period name a run
    runs[0] -= np.searchsorted(ends + np.arange(n), runs[0], "right")  # without the marks before it
    return runs


def slice_runs(hashes: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT,
               string_words: int = STRING_WORDS) -> np.ndarray:
    """All runs of a slice of texts as columns ``(start, length, period)`` by start and period, in words of the slice."""
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start, stop = regions(repeat_distances(hashes, text_of), first, min_words, min_exponent)
    out, at = [np.zeros((3, 0), np.int64)], 0
    filled = np.cumsum(stop - start)
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(filled, (filled[at - 1] if at else 0) + string_words, "right")))
        sizes = (stop - start)[at:upto]
        before = np.cumsum(sizes) - sizes
        index = np.repeat(start[at:upto] - before, sizes) + np.arange(int(sizes.sum()))
        runs = string_runs(np.unique(hashes[index], return_inverse=True)[1], sizes, min_words, min_exponent)
        runs[0] = index[runs[0]]
        out.append(runs)
        at = upto
    runs = np.concatenate(out, axis=1)
    return runs[:, np.lexsort((runs[2], runs[0]))]


def _collapsed(data, start, end, first, runs) -> pa.Array:
    """The texts without the words that a run repeats, the rest joined by one space."""
    cover = np.zeros(len(start) + 1, np.int64)
    np.add.at(cover, runs[0] + runs[2], 1)
    np.add.at(cover, runs[0] + runs[1], -1)
    kept = np.cumsum(cover)[:-1] == 0
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[kept]
    begin, size = start[kept], (end - start)[kept]
    blank = np.append(text[1:] == text[:-1], False) if len(text) else np.zeros(0, bool)
    width = size + blank
    after = np.cumsum(width)
    out = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
    shift = np.arange(int(size.sum()))
    out[np.repeat(after - width - (np.cumsum(size) - size), size) + shift] = data[np.repeat(begin - (np.cumsum(size) - size), size) + shift]
    bounds = np.append(0, after)[np.searchsorted(text, np.arange(len(first)))]
    return pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out)])


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
              min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row: ``id, n_words, runs, collapsed``. ``runs`` lists ``(start, length, period)`` by start and period, words
    counted from 0; ``collapsed`` holds the words that stay when each run keeps its first period only.

    ``min_exponent`` is 2 or more.
    """
    if min_exponent < 2 or min_words < 1:
        raise ValueError("a run repeats its period at least twice")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            for row, data, offsets in vec.slices(batch.column("text")):
                start, end, first = vec.words(data, offsets, vec.NOT_SPACE)
                runs = slice_runs(vec.span_hashes(data, start, end), first, min_words, min_exponent)
                text = np.searchsorted(first, runs[0], "right") - 1
                fields = [pa.array(runs[0] - first[text]), pa.array(runs[1]), pa.array(runs[2])]
                bounds = np.searchsorted(text, np.arange(len(first))).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(fields, names=RUN.names))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(first) - 1), pa.array(np.diff(first)), listed,
                     _collapsed(data, start, end, first, runs).cast(pa.string())], names=["id", "n_words", "runs", "collapsed"])

    schema = T.StructType([rows.schema["id"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                           T.StructField("collapsed", T.StringType())])
    return over_texts(rows, run, schema)


def summary(found: DataFrame) -> DataFrame:
    """Per row: ``id, n_runs``, the longest run (ties: smallest start, then period) as ``start, length, period,
    exponent_milli``, missing without runs, and SHA-256 digests of all runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                   F.lit(","), r["period"].cast("string"), F.lit("\n")))
    length = -F.col("best.n")
    return found.withColumn("best", best).select(
        "id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
        F.col("best.period").alias("period"), F.expr("(1000 * -best.n) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
