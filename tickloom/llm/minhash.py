"""Near-duplicates: one-permutation MinHash, optimal densification, banded buckets, star-shaped candidate edges.

A document's set holds the hashes of its distinct runs of ``width`` words, ASCII letters in lower case; a document
of fewer words has its whole sequence as its one element, one without words has the empty set and no links.

1. One hash per element: its leading bits choose one of m bins, a bin keeps its smallest hash. An empty bin copies
   from the first filled bin in an order of its own (drawn uniformly, the same for all documents).
2. Documents with the same word sequence are one class, counted before the shuffle; its smallest id stands for it.
3. Bands of four bins are bucket keys, as many as keep the chance to miss a pair at the threshold under one in a
   million; bands of 8 and 16 bins are added as finer buckets. In every bucket the smallest id is the centre, and only
   (centre, member) edges are candidates, so a bucket gives at most as many pairs as it has members.
4. Candidates are confirmed on the full sets. Confirmed links make components.
5. A star leaves out pairs of members that the centre does not link. An exact way handles the rest: a bucket whose
   members are in one component needs nothing more; in the others, members outside the largest component are compared
   with all members of other components in blocks of bounded size: first by size and signature, each pair in the first
   band it shares; then those members for which a partner is left bring their full sets into the block, where all
   their links are found. Of these a member reports one per component, so what leaves a block is bounded as well.

Nothing is sampled or capped. What remains to chance is the hashing: 64-bit collisions, the bands (step 3), and the
signature test (step 5), which lets pass whatever is within five standard deviations of the threshold.

Defined results: rows with a missing id are linked with nothing, their component is missing and they stay; rows that
repeat an id are each placed by their own text, and classes whose smallest id is the same count as one; texts that are
missing count as empty; an empty table gives an empty result. Extra columns are left alone whatever they are called.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import vec
from tickloom.llm.common import lookup, over_texts
from tickloom.llm.components import components
from tickloom.session import materialize

BAND = 4
MISS = 1e-6
BLOCK = 512
BLOCK_ELEMENTS = 1 << 19
OTHER_BASE = np.uint64(0xD1342543DE82EF95)
OTHER_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def bands_for(percent: int) -> int:
    """Bands of four bins that a pair at the threshold misses all of with a chance of at most ``MISS``."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** BAND) / 4) * 4


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """``(sets, digests)``: per text its sorted distinct element hashes, and a 128-bit digest of its words."""
    low = vec.LOWER[data]
    start, end, first = vec.words(low, offsets, vec.NOT_SPACE)
    words = vec.span_hashes(low, start, end)
    windows = vec.window_hashes(words, width)
    digests = []
    for base, inverse, h in ((vec.BASE, vec.BASE_INVERSE, words), (OTHER_BASE, OTHER_INVERSE, vec.mix(words ^ OTHER_BASE))):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * vec.powers(base, len(h)), dtype=np.uint64)])
        whole = (sums[first[1:]] - sums[first[:-1]]) * vec.powers(inverse, len(h) + 1)[first[:-1]]
        digests.append(vec.mix(whole + np.diff(first).astype(np.uint64) * base))
    sets = []
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b - a >= width:
            sets.append(np.unique(windows[a:b - width + 1]))
        else:
            sets.append(digests[0][i:i + 1] if b > a else windows[:0])
    return sets, digests


class Sketcher:
    """Signatures and bucket keys of element sets."""

    def __init__(self, bands: int):
        self.bands, self.bins = bands, bands * BAND
        rng = np.random.default_rng(7)
        self.orders = np.argsort(rng.random((self.bins, self.bins)), axis=1)
        self.borders = np.array([(i << 64) // self.bins for i in range(self.bins)], np.uint64)

    def signature(self, elements: np.ndarray) -> np.ndarray:
        """The densified bins of a sorted, non-empty set."""
        at = np.searchsorted(elements, self.borders)
        filled = at < np.append(at[1:], len(elements))
        out = elements[np.minimum(at, len(elements) - 1)]
        empty = np.flatnonzero(~filled)
        if len(empty):
            orders = self.orders[empty]
            out[empty] = out[orders[np.arange(len(empty)), filled[orders].argmax(axis=1)]]
        return out

    def keys(self, signatures: np.ndarray) -> np.ndarray:
        """Per row the keys of the bands of 4, 8 and 16 bins, in this order."""
        mixed = vec.mix(signatures + np.arange(self.bins, dtype=np.uint64) * vec.BASE)
        four = mixed.reshape(len(mixed), self.bands, BAND).sum(axis=2, dtype=np.uint64)
        eight = four.reshape(len(mixed), -1, 2).sum(axis=2, dtype=np.uint64)
        sixteen = four.reshape(len(mixed), -1, 4).sum(axis=2, dtype=np.uint64)
        parts = [vec.mix(p + np.uint64(level * int(OTHER_BASE) % (1 << 64))) for level, p in enumerate((four, eight, sixteen), 1)]
        return np.concatenate(parts, axis=1).view(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))


def sketch(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """``id, n, d1, d2, sig, keys`` per row, written; ``sig`` has one byte per bin."""
    rows = _texts(docs, id_col, text_col)
    bands = bands_for(percent)

    def run(batches):
        sketcher = Sketcher(bands)
        for batch in batches:
            ids = batch.column("id")
            for row, data, offsets in vec.slices(batch.column("text")):
                sets, (d1, d2) = shingle_sets(data, offsets, width)
                n = np.array([len(s) for s in sets], np.int64)
                signatures = np.zeros((len(sets), sketcher.bins), np.uint64)
                for i in np.flatnonzero(n).tolist():
                    signatures[i] = sketcher.signature(sets[i])
                keys = sketcher.keys(signatures)
                lists = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1], pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(sets)), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     pa.array([s.tobytes() for s in (signatures & np.uint64(255)).astype(np.uint8)], pa.binary()), lists],
                    names=["id", "n", "d1", "d2", "sig", "keys"])

    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL("n long, d1 long, d2 long, sig binary, keys array<bigint>")])
    return materialize(over_texts(rows, run, schema), "minhash-sketch")


def element_sets(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id, s``, written: the whole sets of the rows of ``docs`` with these ids."""
    rows = lookup(_texts(docs, id_col, text_col), materialize(ids, "minhash-ends"), "id", "left_semi")

    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            for row, data, offsets in vec.slices(batch.column("text")):
                sets, _ = shingle_sets(data, offsets, width)
                at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(sets)), pa.ListArray.from_arrays(at, pa.array(np.concatenate(sets).view(np.int64)))], names=["id", "s"])

    schema = T.StructType([rows.schema["id"], T.StructField("s", T.ArrayType(T.LongType()))])
    return materialize(over_texts(rows, run, schema), "minhash-sets")


def confirm(edges: DataFrame, percent: int, sets_of) -> DataFrame:
    """``a, b, linked`` of every edge ``(a, b)``, written: the full sets of both ends are compared.

    The sets of all ends are made once. A node with very many edges is dealt over salts by the other end, and its set
    is copied only to the salts that its edges fall on.
    """
    salts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = sets_of(edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct())
    dealt = edges.select("a", "b").withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)))
    left = sets.withColumnsRenamed({"id": "a", "s": "sa"}).join(dealt.select("a", "salt").distinct(), "a")
    right = dealt.join(sets.withColumnsRenamed({"id": "b", "s": "sb"}), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    linked = 100 * common >= percent * (F.size("sa") + F.size("sb") - common)
    judged = right.join(left, ["a", "salt"]).select("a", "b", linked.alias("linked"))
    return materialize(judged.groupBy("a", "b").agg(F.max("linked").alias("linked")), "minhash-judged")


def _sizes_fit(x, y, percent):
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def stars(classes: DataFrame, bands: int, percent: int):
    """``(edges, rows)``: the candidate edges, and the rows ``key, band, node, n, centre, size`` of buckets of four bins
    with three members or more; both written."""
    each = classes.select("node", "n", F.posexplode("keys").alias("band", "key"))
    centres = each.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("centre"),
                                      F.min(F.struct("node", "n"))["n"].alias("centre_n")).where("size > 1")
    members = materialize(each.join(centres, "key").select("key", "band", "node", "n", "centre", "centre_n", "size"), "minhash-members")
    edges = members.where((F.col("node") != F.col("centre")) & _sizes_fit(F.col("n"), F.col("centre_n"), percent)).select(
        F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    return materialize(edges, "minhash-edges"), members.where((F.col("band") < bands) & (F.col("size") > 2)).drop("centre_n")


def rest_links(rows: DataFrame, classes: DataFrame, labels: DataFrame, bands: int, percent: int, sets_of) -> DataFrame:
    """``a, b``: links between members of a bucket that are in different components, enough of them to join all
    components that any link joins; written.

    ``sets_of`` gives ``id, s`` for a table of ids. Blocks pair about ``BLOCK`` members that ask with as many that answer,
    or fewer when their sets hold more than ``BLOCK_ELEMENTS`` elements together.
    """
    known = lookup(lookup(rows, labels, "node"), classes.select("node", "sig", F.slice("keys", 1, bands).alias("keys")), "node", "inner")
    known = known.withColumn("component", F.coalesce("component", "node"))
    parts = known.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("held_n"))
    opened = parts.groupBy("key").agg(F.max(F.struct("held", "component", "held_n")).alias("main"), F.sum("held_n").alias("total_n"),
                                      F.count(F.lit(1)).alias("parts")).where("parts > 1")
    opened = materialize(opened.select("key", "main.held", "main.held_n", "total_n", F.col("main.component").alias("main")), "minhash-open")
    here = lookup(known, opened, "key", "inner").withColumn("rest", F.col("component") != F.col("main"))

    def blocks_for(members, elements):
        return F.greatest(F.ceil(members / BLOCK), F.ceil(elements / BLOCK_ELEMENTS))

    blocks = blocks_for(F.col("size"), F.col("total_n"))
    rest_blocks = blocks_for(F.col("size") - F.col("held"), F.col("total_n") - F.col("held_n"))
    mine = ["band", "node", "n", "component", "sig", "keys", "rest", (F.col("node") == F.col("centre")).alias("is_centre")]
    asking = here.where("rest").select("key", F.pmod(F.xxhash64("node"), rest_blocks).alias("rb"), F.explode(
        F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("mb"), F.lit(True).alias("asks"), *mine)
    answering = here.select("key", F.explode(F.sequence(F.lit(0).cast("long"), rest_blocks - 1)).alias("rb"),
                            F.pmod(F.xxhash64("node", F.lit(1)), blocks).alias("mb"), F.lit(False).alias("asks"), *mine)
    group = ["key", "rb", "mb"]

    def blockwise(df, fn, schema):
        def run(batches):
            for table in _groups(batches, group):
                found = fn(table, table["asks"])
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], names=schema.names)

        return over_texts(df.repartition(*group).sortWithinPartitions(*group), run, schema)

    def possible(table, asks):
        """The members with a partner that could be a link by size and signature, in the first band they share."""
        x, y = ({c: v[m] for c, v in table.items()} for m in (asks, ~asks))
        bins, band = table["sig"].shape[1], int(table["band"][0])
        small = np.minimum(x["n"][:, None], y["n"])
        spread = math.sqrt(percent / 100 * (1 - percent / 100) / bins) * np.where(small < 4 * bins, 8, 5)
        ok = (x["component"][:, None] != y["component"]) & ~x["is_centre"][:, None] & ~y["is_centre"]
        ok &= 100 * small >= percent * np.maximum(x["n"][:, None], y["n"])
        ok &= ~y["rest"] | (x["node"][:, None] < y["node"])
        for i in np.flatnonzero(ok.any(axis=1)).tolist():
            ok[i] &= (y["sig"] == x["sig"][i]).sum(axis=1) >= (percent / 100 - spread[i]) * bins
            ok[i] &= ~(y["keys"][:, :band] == x["keys"][i, :band]).any(axis=1)
        i, j = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
        at = np.concatenate([np.flatnonzero(asks)[i], np.flatnonzero(~asks)[j]])
        return [table[c][at] for c in schema.names]

    schema = T.StructType.fromDDL("key long, rb long, mb long, asks boolean, node long, component long")
    needed = materialize(blockwise(asking.unionByName(answering), possible, schema), "minhash-rest")
    sets = sets_of(needed.select(F.col("node").alias("id")).distinct())

    def linked(table, asks):
        """For every member that asks, one link to each component it is linked with."""
        codes = np.unique(np.concatenate(table["s"]), return_inverse=True)[1] if len(asks) else np.zeros(0, np.int64)
        size = np.array([len(v) for v in table["s"]])
        at = np.concatenate([[0], np.cumsum(size)])
        answers = np.flatnonzero(~asks)
        theirs = np.concatenate([codes[at[j]:at[j + 1]] for j in answers]) if len(answers) else codes[:0]
        begin = np.concatenate([[0], np.cumsum(size[answers])[:-1]]).astype(np.int64)
        a, b = [], []
        held = np.zeros(int(codes.max()) + 1 if len(codes) else 1, np.int32)
        for i in np.flatnonzero(asks).tolist() if len(answers) else ():
            held[codes[at[i]:at[i + 1]]] = 1
            common = np.add.reduceat(held[theirs], begin)
            held[codes[at[i]:at[i + 1]]] = 0
            link = 100 * common >= percent * (size[i] + size[answers] - common)
            link &= table["component"][answers] != table["component"][i]
            other = answers[link]
            for j in other[np.unique(table["component"][other], return_index=True)[1]].tolist():
                a.append(min(table["node"][i], table["node"][j]))
                b.append(max(table["node"][i], table["node"][j]))
        return np.array(a, np.int64), np.array(b, np.int64)

    whole = needed.join(sets.withColumnRenamed("id", "node"), "node").select(*schema.names, "s")
    return materialize(blockwise(whole, linked, T.StructType.fromDDL("a long, b long")).distinct(), "minhash-rest-links")


def _groups(batches, group):
    """Consecutive rows with the same values in ``group``, as arrays by column name: ``sig`` and ``keys`` are matrices,
    ``s`` holds one array per row."""
    def columns(table):
        out = {}
        for c in table.schema.names:
            if c == "sig":
                out[c] = np.frombuffer(b"".join(table[c].to_pylist()), np.uint8).reshape(table.num_rows, -1)
            elif c == "keys":
                out[c] = table[c].flatten().to_numpy().reshape(table.num_rows, -1)
            else:
                out[c] = table[c].to_numpy(zero_copy_only=False)
        return out

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = columns(batch)
        held = part if held is None else {c: np.concatenate([held[c], part[c]]) for c in part}
        change = np.zeros(len(held["asks"]), bool)
        for c in group:
            change[1:] |= held[c][1:] != held[c][:-1]
        cuts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield {c: v[a:b] for c, v in held.items()}
        held = {c: v[cuts[-1]:] for c, v in held.items()}
    if held is not None:
        yield held


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """Per row: ``id, n_shingles, component_id, n_copies, kept``.

    Documents are linked when 100 * |intersection| >= ``percent`` * |union| of their sets. ``n_copies`` counts the rows
    with the same words; ids are whole numbers.
    """
    sketched = sketch(docs, id_col, text_col, width, percent)
    some = sketched.where("n > 0 AND id IS NOT NULL")
    classes = materialize(some.groupBy("d1", "d2").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("n", "sig", "keys")]), "minhash-classes")
    edges, rows = stars(classes, bands_for(percent), percent)
    def sets_of(ids):
        return element_sets(ids, docs, id_col, text_col, width)

    links = confirm(edges, percent, sets_of).where("linked").select("a", "b")
    labels = components(links)
    more = rest_links(rows, classes, labels, bands_for(percent), percent, sets_of)
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    placed = classes.select("d1", "d2", "node", "copies").join(labels, "node", "left").where("copies > 1 OR component IS NOT NULL")
    placed = materialize(placed.select("d1", "d2", F.coalesce("component", "node").alias("component"), "copies"), "minhash-placed")
    found = lookup(sketched.select("id", "n", "d1", "d2"), placed, ["d1", "d2"])
    linkable = (F.col("n") > 0) & F.col("id").isNotNull()
    component = F.when(linkable, F.coalesce("component", "id")).otherwise(F.col("id"))
    return found.select(
        "id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.when(linkable, F.coalesce("copies", F.lit(1).cast("long"))).otherwise(F.lit(1).cast("long")).alias("n_copies"),
        component.eqNullSafe(F.col("id")).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
               percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of every group the document with the smallest id."""
    found = near_duplicates(docs, id_col, text_col, width, percent)
    gone = found.groupBy("id").agg(F.max("kept").alias("kept")).where(~F.col("kept")).select(F.col("id").alias("_gone"))
    gone = materialize(gone, "minhash-gone")
    return lookup(docs, gone, docs[f"`{id_col}`"] == gone["_gone"], "left_anti")
