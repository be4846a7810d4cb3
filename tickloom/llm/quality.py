"""Quality classifier: a generalised additive model with pairwise interactions.

1. Every text becomes a short row of features: shares of letters, marks and blanks, repeated and distinct words, word
   and line lengths. Features are written once; no label, language, source or id is among them.
2. The model is fitted on at most ``max_rows`` labelled rows, those with the smallest hash of the id, so the driver
   holds a matrix of that bound. Rounds go over the features in turn; each adds a shallow tree of one feature, shrunk,
   to that feature's lookup table over bins. Then the pairs of features whose four-way split explains most
   of what is left get tables of two dimensions in the same way.
3. A score is the logistic of the intercept plus one table entry per feature and pair.

Defined results: a missing text is empty; an empty text has all features 0 and is scored like any other; without a
labelled row the model knows nothing, scores 0.5 and rejects nothing; labels of a repeated id are averaged (0.5 counts as
1); rows that repeat an id are scored each; an empty table gives an empty result.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import vec
from tickloom.llm.common import lookup, over_texts
from tickloom.session import materialize

MAX_ROWS = 20_000
BINS = 64
PAIR_BINS = 12
PAIRS = 4
ROUNDS = 60
RATE = 0.2

FEATURES = ["log_words", "word_length", "upper", "digits", "exclamations", "bars", "symbols", "stops", "repeats", "distinct",
            "line_words", "longest_word", "short_words", "blanks"]

# Byte classes that the features count.
LOWER_CASE, UPPER_CASE, DIGIT, EXCLAMATION, BAR, STOP, SYMBOL, BLANK, LINE, OTHER = range(10)
CLASSES = np.full(256, OTHER, np.int64)
CLASSES[33:127] = SYMBOL
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58] = LOWER_CASE, UPPER_CASE, DIGIT
CLASSES[[46, 44, 59, 58, 63, 39, 34, 40, 41, 45]] = STOP
CLASSES[33], CLASSES[124] = EXCLAMATION, BAR
CLASSES[[9, 11, 12, 13, 32]], CLASSES[10] = BLANK, LINE


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text of a slice."""
    texts = len(offsets) - 1
    size = np.diff(offsets)
    text_of = np.repeat(np.arange(texts), size)
    by_class = np.bincount(text_of * 10 + CLASSES[data], minlength=10 * texts).reshape(texts, 10).astype(float)
    start, end, first = vec.words(data, offsets, vec.NOT_SPACE)
    words = np.diff(first)
    word_text = np.repeat(np.arange(texts), words)
    length = end - start
    hashes = vec.span_hashes(data, start, end)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (word_text[1:] == word_text[:-1])
    order = np.lexsort((hashes, word_text))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (word_text[1:] != word_text[:-1])
    distinct = np.bincount(word_text[fresh], minlength=texts)
    n = np.maximum(words, 1).astype(float)
    total = np.bincount(word_text, weights=length, minlength=texts)
    longest = np.zeros(texts)
    np.maximum.at(longest, word_text, length)
    letters = np.maximum(by_class[:, LOWER_CASE] + by_class[:, UPPER_CASE], 1)
    chars = np.maximum(size, 1)
    return np.stack([
        np.log1p(words), total / n, by_class[:, UPPER_CASE] / letters, by_class[:, DIGIT] / chars, by_class[:, EXCLAMATION] / n,
        by_class[:, BAR] / n, by_class[:, SYMBOL] / n, by_class[:, STOP] / n, np.bincount(word_text, weights=again, minlength=texts) / n,
        np.where(words > 0, distinct / n, 0), words / (by_class[:, LINE] + 1), np.log1p(longest),
        np.bincount(word_text, weights=length <= 3, minlength=texts) / n, (by_class[:, BLANK] + by_class[:, LINE]) / chars], axis=1)


@dataclass
class Model:
    """Lookup tables over bins; ``edges`` are the upper borders of the bins of each feature."""

    intercept: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: list = field(default_factory=list)  # (feature, feature, coarse edges, coarse edges, table)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, f])]
        for a, b, ea, eb, table in self.pairs:
            total += table[np.searchsorted(ea, x[:, a]), np.searchsorted(eb, x[:, b])]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _borders(x: np.ndarray, bins: int) -> np.ndarray:
    values = np.unique(x)
    if len(values) > bins:
        values = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)))
    return (values[1:] + values[:-1]) / 2


def _best_cut(g: np.ndarray, h: np.ndarray):
    """``(gain, cut)`` of splitting bins into those up to ``cut`` and those after."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    gain = cg[:-1] ** 2 / (ch[:-1] + 1) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + 1) - cg[-1] ** 2 / (ch[-1] + 1)
    return (float(gain.max()), int(gain.argmax()) + 1) if len(gain) else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """The values that a tree of ``depth`` levels over one feature's bins adds to them."""
    gain, cut = _best_cut(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + 1))
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of one cut along the first feature and one along the second on either side."""
    best = (0.0, np.full(g.shape, g.sum() / (h.sum() + 1)))
    for cut in range(1, g.shape[0]):
        gain, parts = 0.0, []
        for rows in (slice(None, cut), slice(cut, None)):
            gs, hs = g[rows].sum(axis=0), h[rows].sum(axis=0)
            gain += _best_cut(gs, hs)[0] + gs.sum() ** 2 / (hs.sum() + 1)
            parts.append(np.tile(_tree(gs, hs, 1), (g[rows].shape[0], 1)))
        if gain > best[0]:
            best = (gain, np.concatenate(parts))
    return best


def fit_rows(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS) -> Model:
    """Fit on rows held in memory; ``y`` is 0 or 1."""
    if not len(y):
        return Model()
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    edges = [_borders(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)]
    model = Model(float(np.log(share / (1 - share))), edges, [np.zeros(len(e) + 1) for e in edges])
    total = np.full(len(y), model.intercept)

    def rest():
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, b in enumerate(bins):
            g, h = rest()
            size = len(edges[f]) + 1
            step = rate * _tree(np.bincount(b, g, size), np.bincount(b, h, size))
            model.tables[f] += step
            total += step[b]
    coarse = [_borders(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    cbins = [np.searchsorted(e, x[:, f]) for f, e in enumerate(coarse)]

    def grid(a, b, values):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        return np.bincount(cbins[a] * shape[1] + cbins[b], values, shape[0] * shape[1]).reshape(shape)

    g, h = rest()
    gains = sorted(((-_pair_tree(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(x.shape[1]) for b in range(a)))
    chosen = [(a, b) for gain, a, b in gains[:pairs] if gain < 0]
    model.pairs = [(a, b, coarse[a], coarse[b], np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for a, b in chosen]
    for _ in range(rounds // 2):
        for a, b, _, _, table in model.pairs:
            g, h = rest()
            step = rate * _pair_tree(grid(a, b, g), grid(a, b, h))[1]
            table += step
            total += step[cbins[a], cbins[b]]
    return model


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, x`` per row, written; x holds ``FEATURES``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            for row, data, offsets in vec.slices(batch.column("text")):
                x = features(data, offsets)
                lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([ids.slice(row, len(x)), lists], names=["id", "x"])

    schema = T.StructType([rows.schema["id"], T.StructField("x", T.ArrayType(T.DoubleType()))])
    return materialize(over_texts(rows, run, schema), "quality-features")


def held_out(doc_id):
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(table: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows of a feature table that are not held out."""
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
    known = materialize(known.groupBy("id").agg((F.avg("label") >= 0.5).cast("double").alias("y")), "quality-labels")
    sample = lookup(table, known, "id", "inner").orderBy(F.xxhash64("id"), "id", "x").limit(max_rows).select("x", "y").toArrow()
    x = sample["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES)) if sample.num_rows else np.zeros((0, len(FEATURES)))
    return fit_rows(x, sample["y"].to_numpy())


def score_table(table: DataFrame, model: Model) -> DataFrame:
    """``id, score`` of every row of a feature table."""

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.score(x))], names=["id", "score"])

    return table.mapInArrow(run, T.StructType([table.schema["id"], T.StructField("score", T.DoubleType())]))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``."""
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            good = [model.score(features(data, offsets)) >= least for _, data, offsets in vec.slices(batch.column(place))]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return over_texts(docs, run, docs.schema)
