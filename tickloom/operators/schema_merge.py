"""Schema inference over JSON documents, merged across all of them.

Rules: a field has the type of its value (text, 32- or 64-bit integer, double, boolean, timestamp; a
null or unknown value counts as text); a list has the type of its first element, an empty list is a
list of text; a field of two types becomes text, a list of two element types a list of text; structs
are merged field by field, but among lists of structs the first document's struct wins.

A schema is held as rows ``(path, type)``: ``a.b`` for field b of a, ``a[]`` for the elements of a, names
with other marks in backquotes. Merging is then a grouping by path, so neither the documents nor their
shapes meet on the driver, and type texts are folded from the paths level by level, so a schema is one text only in the
end. Documents are walked as VARIANT values inside the JVM; very deeply nested ones by a loop over their text. Texts that are not JSON objects have no schema and
add nothing; they are the rows ``nested.failed_rows`` returns. Of a name that an object holds twice the last value counts;
what follows the object in a text is not read.
"""

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.deep_json import document_types
from tickloom.session import materialize

# Spark type names of the inferred scalar types.
SCALARS = {"string": "string", "int": "int", "long": "bigint", "double": "double", "boolean": "boolean",
           "timestamp": "timestamp"}
# Wrapped scalars of extended JSON and the type each stands for.
WRAPPED = {"$numberLong": "long", "$numberInt": "int", "$numberDouble": "double", "$date": "timestamp",
           "$timestamp": "timestamp", "$oid": "string", "$numberDecimal": "string"}

# A path is its steps, each after one separator; a list's elements are a step of their own.
_STEP, _ELEMENTS = "\u0001", "\u0002"
_DEEP = "\u0003"
# Levels that one pass follows; what lies deeper is walked on from there.
LEVELS = 6
FOLDED_AT_ONCE = 16
# Documents nested deeper are read by a loop.
NESTED = 250

# The types of a path's places are kept as one letter each.
_LETTERS = {"struct": "s", "list": "l", "string": "t", "int": "i", "long": "g", "double": "d", "boolean": "b", "timestamp": "m"}


def _literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


# What the names of VARIANT types begin with, and their letters.
_VARIANT_LETTERS = {"STRING": "t", "BOOLEAN": "b", "DOUBLE": "d", "FLOAT": "d", "DECIMAL": "d", "OBJECT": "s", "ARRAY": "l"}


def _letter(v: Column) -> Column:
    """The type of a value without fields or elements, by a lookup of its name, so that the name is made once."""
    name = F.substring_index(F.substring_index(F.schema_of_variant(v), "(", 1), "<", 1)
    fits = F.when(F.try_variant_get(v, "$", "int").isNotNull(), "+").otherwise("-")
    letters = {n + f: letter for n, letter in _VARIANT_LETTERS.items() for f in "+-"}
    return F.coalesce(F.try_element_at(_literal_map(letters | {"BIGINT+": "i", "BIGINT-": "g"}), F.concat(name, fits)), F.lit("t"))


def _level(nodes: DataFrame) -> DataFrame:
    """Rows ``(k, p, t, v, done)`` one level further: an object becomes a row for each field, a list its first element.

    What has neither is done. ``t`` gets the letter of every place that is left behind.
    """
    opened = nodes.lateralJoin(nodes.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
    pos, key = F.col("pos"), F.col("key")
    alone = F.size(F.map_keys(F.try_variant_get("v", "$", "map<string,variant>"))) == 1
    wrapped = F.when((pos == 0) & key.isin(*WRAPPED), F.when(alone, F.try_element_at(_literal_map({k: _LETTERS[t] for k, t in WRAPPED.items()}), key)))
    ends = F.col("done") | pos.isNull() | wrapped.isNotNull()
    letter = F.when(F.col("done"), "").when(wrapped.isNotNull(), wrapped).when(key.isNotNull(), "s").when(pos.isNotNull(), "l").otherwise(_letter(F.col("v")))
    step = F.when(ends, "").when(key.isNotNull(), F.concat(F.lit(_STEP), key)).otherwise(_STEP + _ELEMENTS)
    return opened.where(pos.isNull() | key.isNotNull() | (pos == 0)).select(
        "k", F.concat("p", step).alias("p"), F.concat("t", letter).alias("t"), F.when(~ends, F.col("value")).alias("v"), ends.alias("done"))


@contextmanager
def _last_of_repeated_names(spark):
    name = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _nesting(text: Column) -> Column:
    """How deep a text is nested: counted for texts with many opening brackets, 0 for others."""
    openings = F.length(text) - F.length(F.translate(text, "{[", ""))
    outside = F.regexp_replace(text, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', "")
    marks = F.split(F.regexp_replace(outside, r"[^\[\]{}]", ""), "")

    def count(state, mark):
        depth = state["depth"] + F.when(mark.isin("{", "["), 1).when(mark.isin("}", "]"), -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.greatest(state["top"], depth).alias("top"))

    counted = F.aggregate(marks, F.struct(F.lit(0).alias("depth"), F.lit(0).alias("top")), count, lambda s: s["top"])
    return F.when(openings > NESTED, counted).otherwise(F.lit(0))


def document_paths(df: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """``(path, root, type, first_key)`` found in the documents: the smallest key of each path and type.

    ``root`` is empty, or the path of the outermost list of structs that a path lies in. Every document is read once; those
    deeper than ``LEVELS`` are walked on from their open ends, those deeper than ``NESTED``, where a recursive reader could
    exhaust its stack, by a loop over their text.
    """
    texts = df.where(F.col(text_col).isNotNull() & F.col(key_col).isNotNull()).select(
        F.col(key_col).alias("k"), F.col(text_col).alias("text"), _nesting(F.col(text_col)).alias("nesting"))
    deep = F.col("nesting") > NESTED
    ways, by_text = None, False
    with _last_of_repeated_names(df.sparkSession):  # the setting counts when the parse is analysed
        parsed = F.explode(F.array(F.when(~deep, F.try_parse_json("text")))).alias("v")
        nodes = texts.select("k", F.lit("").alias("p"), F.when(deep, _DEEP).otherwise("").alias("t"), parsed, deep.alias("done"))
        while True:
            for _ in range(LEVELS):
                nodes = _level(nodes)
            part = materialize(nodes.groupBy("p", "t", "done").agg(F.min("k").alias("k")), "document-ways")
            ways = part if ways is None else ways.unionByName(part)
            still_open, any_deep = part.agg(F.bool_or(~F.col("done")), F.bool_or(F.col("t") == _DEEP)).head()
            by_text = by_text or any_deep
            if not still_open:
                break
            nodes = materialize(nodes.where(~F.col("done")), "deeper-nodes")
    found = _smallest(_places_on(ways.where(F.col("done") & F.col("t").startswith("s"))))
    return found.unionByName(materialize(_deep_paths(texts.where(deep)), "deep-paths")) if by_text else found


def _places_on(ways: DataFrame) -> DataFrame:
    """``(k, p, r, t)``: every place on the way from the root to a value or an empty list or object."""
    open_list = F.col("t").endswith("l")
    p = F.when(open_list, F.concat("p", F.lit(_STEP + _ELEMENTS))).otherwise(F.col("p"))
    ways = ways.select("k", F.split(F.substr(p, F.lit(2)), _STEP).alias("steps"), F.when(open_list, F.concat("t", F.lit("t"))).otherwise(F.col("t")).alias("t"))
    names = _literal_map({letter: name for name, letter in _LETTERS.items()})
    # the kinds of the places below the root, which is an object
    kinds = F.transform(F.split(F.substr("t", F.lit(2)), ""), lambda c: F.try_element_at(names, c))
    ways = ways.where(F.length("t") > 1).select("k", "steps", kinds.alias("kinds"))
    tops = F.filter(F.sequence(F.lit(1), F.size("steps")), lambda n: (F.get("steps", n - 1) == _ELEMENTS) & (F.get("kinds", n - 1) == "struct"))
    ways = ways.withColumn("top", F.coalesce(F.get(tops, F.lit(0)), F.lit(1 << 30)))

    def path(n):
        return F.concat(F.lit(_STEP), F.array_join(F.slice("steps", 1, n), _STEP))

    each = F.transform(F.sequence(F.lit(1), F.size("steps")), lambda n: F.struct(
        path(n).alias("p"), F.when(n > F.col("top"), path(F.col("top"))).otherwise("").alias("r"), F.get("kinds", n - 1).alias("t")))
    return ways.select("k", F.explode(each).alias("n")).select("k", "n.*")


def _smallest(each: DataFrame) -> DataFrame:
    return each.groupBy(F.col("p").alias("path"), F.col("r").alias("root"), F.col("t").alias("type")).agg(F.min("k").alias("first_key"))


def _deep_paths(texts: DataFrame) -> DataFrame:
    def read(frames):
        import pandas as pd

        for frame in frames:
            rows = [(k, *found) for k, text in zip(frame["k"], frame["text"]) for found in document_types(text, WRAPPED, _STEP, _ELEMENTS)]
            yield pd.DataFrame(rows, columns=["k", "p", "r", "t"])

    schema = T.StructType([texts.schema["k"], *[T.StructField(c, T.StringType()) for c in "prt"]])
    return _smallest(texts.select("k", "text").mapInPandas(read, schema))


def _steps(path) -> Column:
    return F.split(F.substr(path, F.lit(2)), _STEP)


def _above(path) -> Column:
    """The path without its last step."""
    cut = F.length(path) - F.length(F.substring_index(path, _STEP, -1)) - 1
    return F.substr(path, F.lit(1), cut)


def fold(nodes: DataFrame) -> DataFrame:
    """``(root, type)``: the type texts of whole trees.

    ``nodes`` has a row ``(root, path, depth, kind, text)`` for every node, the root's at depth 0; ``text`` is the type where
    it is known. Each level is one grouping of the level's nodes with the texts of their children. Fields are in the order
    of their names.
    """
    nodes = materialize(nodes, "schema-nodes")
    deepest = nodes.agg(F.max("depth")).head()[0] or 0
    child, texts = "struct<name:string,text:string>", None
    for depth in range(deepest, -1, -1):
        level = nodes.where(F.col("depth") == depth).select("root", "path", "kind", "text", F.lit(None).cast(child).alias("c"))
        if texts is not None:
            name = F.substring_index("path", _STEP, -1)
            level = level.unionByName(texts.select("root", _above(F.col("path")).alias("path"), F.lit(None).cast("string").alias("kind"),
                                                   F.lit(None).cast("string").alias("text"), F.struct(name.alias("name"), F.col("type").alias("text")).alias("c")))
        held = level.groupBy("root", "path").agg(F.max("kind").alias("kind"), F.max("text").alias("text"), F.sort_array(F.collect_list("c")).alias("c"))
        tick = F.lit("`")
        fields = F.transform("c", lambda c: F.concat(tick, F.replace(c["name"], tick, F.lit("``")), F.lit("`:"), c["text"]))
        made = F.when(F.col("kind") == "struct", F.concat(F.lit("struct<"), F.array_join(fields, ","), F.lit(">"))).when(
            F.col("kind") == "list", F.concat(F.lit("array<"), F.get("c", F.lit(0))["text"], F.lit(">"))).otherwise(
            F.try_element_at(_literal_map(SCALARS), F.col("kind")))
        texts = held.select("root", "path", F.coalesce("text", made).alias("type"))
        if depth and depth % FOLDED_AT_ONCE == 0:
            texts = materialize(texts, "schema-texts")
    return texts.select("root", "type")


def merge_paths(found: DataFrame) -> DataFrame:
    """One type per path: ``(path, type, element, steps)``; ``element`` is the struct of a list of structs.

    Paths below one that became text are dropped with it. The grouped paths are written before they are compared
    with each other.
    """
    merged = found.where("root = ''").groupBy("path").agg(
        F.min("type").alias("_low"), F.max("type").alias("_high"), F.min("first_key").alias("_key"))
    merged = materialize(merged, "schema-paths")
    agreed = F.col("_low") == F.col("_high")
    closed = merged.where(~agreed).select(F.col("path").alias("_above"), F.size(_steps(F.col("path"))).alias("_n"))
    lists = merged.where(agreed & (F.col("_low") == "struct") & F.col("path").endswith(_STEP + _ELEMENTS)).select(F.col("path").alias("root"), "_key")
    inner = found.where("root <> ''").groupBy("root", "path").agg(F.min("first_key").alias("_key"), F.min_by("type", "first_key").alias("kind"))
    inner = inner.join(lists, ["root", "_key"]).select("root", "path", (F.size(_steps(F.col("path"))) - F.size(_steps(F.col("root")))).alias("depth"), "kind")
    tops = lists.select("root", F.col("root").alias("path"), F.lit(0).alias("depth"), F.lit("struct").alias("kind"))
    structs = fold(inner.unionByName(tops).withColumn("text", F.lit(None).cast("string")))
    merged = merged.join(structs.withColumnRenamed("root", "path"), "path", "left").select(
        "path", F.when(agreed, F.col("_low")).otherwise("string").alias("type"),
        F.when(agreed, F.coalesce("type", F.lit(""))).otherwise("").alias("element"), _steps(F.col("path")).alias("steps"))
    merged = materialize(merged, "schema-merged")
    lengths = [r["_n"] for r in closed.select("_n").distinct().collect()]  # at most as many as there are levels
    prefixes = F.transform(F.filter(F.lit(lengths).cast("array<int>"), lambda n: n < F.size("steps")), lambda n: F.concat(
        F.lit(_STEP), F.array_join(F.slice("steps", 1, n), _STEP)))
    below = merged.select("path", F.explode(prefixes).alias("_above"))
    cut = below.join(closed, "_above", "left_semi").select("path").distinct()
    return merged.join(cut, "path", "left_anti").select(_shown(F.col("steps")).alias("path"), "type", "element", "steps")


def _shown(steps):
    """Steps as text: ``a.b``, ``a[]``, and backquotes around names that hold a mark."""
    tick = F.lit("`")

    def name(s):
        return F.when(s.rlike(r"^\w+$"), s).otherwise(F.concat(tick, F.replace(s, tick, F.lit("``")), tick))

    parts = F.transform(steps, lambda s, i: F.when(s == _ELEMENTS, F.lit("[]")).when(i == 0, name(s)).otherwise(
        F.concat(F.lit("."), name(s))))
    return F.array_join(parts, "")


def infer_schema(df: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """Merged schema of all documents as ``(path, type, element, steps)``."""
    return merge_paths(document_paths(df, key_col, text_col))


def schema_text(merged: DataFrame) -> str:
    """The merged paths as one type text; only that text is read."""
    known = F.when(F.col("element") != "", F.col("element"))
    nodes = merged.select(F.lit("").alias("root"), F.concat(F.lit(_STEP), F.array_join("steps", _STEP)).alias("path"),
                          F.size("steps").alias("depth"), F.col("type").alias("kind"), known.alias("text"))
    top = merged.sparkSession.range(1).select(F.lit("").alias("root"), F.lit("").alias("path"), F.lit(0).alias("depth"),
                                              F.lit("struct").alias("kind"), F.lit(None).cast("string").alias("text"))
    return fold(nodes.unionByName(top)).head()["type"]


def schema_of(merged: DataFrame) -> T.StructType:
    """The merged paths as a Spark schema, for ``from_json``."""
    return T.StructType.fromDDL(schema_text(merged))
