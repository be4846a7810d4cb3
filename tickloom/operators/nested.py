"""Nested documents: typed extraction of JSON text, unit lists, lists, structs and maps.

A company document is ``{cik, taxonomy, tag, label, description, entityName, units: {unit: [item]}}``.
Everything here is per document, so it runs where the document lies; only ``units_for_keys`` joins.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalar import coerce
from tickloom.operators.skew import lookup_join

# The fields of a company document and of one unit item, in the order of the target schema.
DOCUMENT_FIELDS = ["cik", "taxonomy", "tag", "label", "description", "entityName"]
UNIT_TEXT_FIELDS = ["accn", "form", "fp", "fy", "type"]
UNIT_DATE_FIELDS = ["end", "filed"]

_ITEM = "struct<end:string, val:string, accn:string, fy:string, fp:string, form:string, filed:string>"
DOCUMENT_SCHEMA = ", ".join(f"{f} string" for f in DOCUMENT_FIELDS) + f", units map<string, array<{_ITEM}>>"
_CORRUPT = "_corrupt"

# Text that a cast reads as a whole number, blanks and control marks around it included, and text of an ISO date. A cast that
# fails throws and catches an error inside, which takes far longer than the row, so text is matched first.
_WHOLE = r"\A[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*\z"
_ISO_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def parse_documents(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with the parsed ``doc`` beside the text; ``_corrupt`` holds a text that is not a JSON object.

    Scalars are read as text, so a number of another kind stays as it is written; a list or map field that holds
    something else is missing, and the document stays.

    The parse is generated as a one-element list: Spark would copy a plain ``from_json`` into every
    later filter and field access, and parse each text that many times.
    """
    schema = f"{DOCUMENT_SCHEMA}, {_CORRUPT} string"
    doc = F.from_json(text_col, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    text = F.col(f"doc.{_CORRUPT}")
    an_object = F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))
    return df.select("*", F.explode(F.array(doc)).alias("doc")).withColumn(_CORRUPT, F.when(text.isNotNull() & ~an_object, text))


def drop_failed_rows(parsed: DataFrame) -> DataFrame:
    """Only documents that parsed."""
    return parsed.where(F.col(_CORRUPT).isNull() & F.col("doc").isNotNull()).drop(_CORRUPT)


def failed_rows(parsed: DataFrame) -> DataFrame:
    """The other side of ``drop_failed_rows``."""
    return parsed.where(F.col(_CORRUPT).isNotNull() | F.col("doc").isNull()).drop("doc")


def json_to_document(df: DataFrame, text_col: str) -> DataFrame:
    """JSON text as the document columns; keys outside the schema are dropped, failed texts too."""
    rest = [c for c in df.columns if c != text_col]
    good = drop_failed_rows(parse_documents(df, text_col))
    return good.select(*rest, *[F.col(f"doc.{f}").alias(f) for f in [*DOCUMENT_FIELDS, "units"]])


def extract_unit_list(docs: DataFrame, unit: str = "USD") -> DataFrame:
    """``units`` replaced by the list of one unit; a document without that unit has a missing list."""
    return docs.withColumn("units", F.col("units")[unit])


def tag_unit_type(docs: DataFrame, unit: str = "USD") -> DataFrame:
    """``type`` added to every list element."""
    return docs.withColumn("units", F.transform("units", lambda u: u.withField("type", F.lit(unit))))


def replace_key(docs: DataFrame, requested: Column, key: str = "cik") -> DataFrame:
    """The key overwritten by the id the document was requested under."""
    return docs.withColumn(key, requested.cast("string"))


def whole_number(text: Column) -> Column:
    """The long that ``text`` writes, also as ``7.0``; missing for anything else."""
    number = text.try_cast("decimal(38,10)")
    return F.coalesce(F.when(text.rlike(_WHOLE), text.try_cast("long")),
                      F.when(text.rlike(r"\p{Nd}") & (number == F.floor(number)), number.try_cast("long")))


def iso_date(text: Column) -> Column:
    """The date that ``text`` writes as ``yyyy-MM-dd``; missing for anything else. Plain ISO text needs no formatter."""
    return F.when(text.rlike(_ISO_DATE), text.try_cast("date")).otherwise(F.try_to_date(text, "yyyy-MM-dd"))


def write_units_struct(docs: DataFrame) -> DataFrame:
    """List elements in the target schema: text, ISO dates as dates, ``val`` as a long; null elements skipped.

    A date or number that cannot be read is missing, its element stays.
    """

    def item(u):
        text = [u[f].cast("string").alias(f) for f in UNIT_TEXT_FIELDS]
        dates = [iso_date(u[f]).alias(f) for f in UNIT_DATE_FIELDS]
        return F.struct(*text, *dates, whole_number(u["val"]).alias("val"))

    return docs.withColumn("units", F.transform(F.array_compact("units"), item))


def company_table(df: DataFrame, text_col: str, requested: Column, unit: str = "USD") -> DataFrame:
    """The whole path from JSON text to the target schema."""
    docs = tag_unit_type(extract_unit_list(json_to_document(df, text_col), unit), unit)
    return write_units_struct(replace_key(docs, requested))


def explode_units(docs: DataFrame, keep=("cik",)) -> DataFrame:
    """All units as one flat table that keeps the document's key; empty lists leave one row."""
    return docs.select(*keep, F.explode_outer("units").alias("u")).select(*keep, "u.*")


def units_for_keys(docs: DataFrame, keys: DataFrame, key: str = "cik") -> DataFrame:
    """Units and their number for the documents whose key is in ``keys`` (one row per key)."""
    docs, wanted = docs.select(key, "units"), keys.select(key).distinct()
    return lookup_join(docs, wanted, key).withColumn("n_units", F.greatest(F.coalesce(F.size("units"), F.lit(0)), F.lit(0)))


def write_scalar_fields(docs: DataFrame, types: dict, *, strict: bool = False) -> DataFrame:
    """Top-level fields cast to the named types.

    ``strict`` raises an error that names the field; otherwise the value is missing and the field is
    listed in ``_errors``.
    """
    rest = [c for c in docs.columns if c not in types]
    kinds = {f: T.StructType.fromDDL(f"x {t}")[0].dataType for f, t in types.items()}
    number = {f: isinstance(kinds[f], _WHOLE_TYPES) and isinstance(docs.schema[f].dataType, T.StringType) for f in types}

    def read(f):
        value = F.col(f).try_cast(types[f])
        return F.when(F.col(f).rlike(_WHOLE), value) if number[f] else value

    # a column of its own, so that the cast runs once and not for the value and the error each
    docs = docs.select("*", *[read(f).alias(f"_read_{f}") for f in types])
    values = {f: F.col(f"_read_{f}") for f in types}
    failed = {f: F.col(f).isNotNull() & values[f].isNull() for f in types}
    if strict:
        def value(f):
            message = F.concat(F.lit(f"field {f} cannot be read as {types[f]}: "), F.col(f).cast("string"))
            return F.when(failed[f], F.raise_error(message)).otherwise(values[f]).alias(f)

        return docs.select(*rest, *[value(f) for f in types])
    errors = F.array_compact(F.array(*[F.when(bad, F.lit(f)) for f, bad in failed.items()])).alias("_errors")
    return docs.select(*rest, *[values[f].alias(f) for f in types], errors)


def build_list(*items: Column) -> Column:
    """A list of the non-null items."""
    return F.array_compact(F.array(*items))


def build_list_of(values: Column, convert) -> Column:
    """``convert`` applied to the non-null elements of a list."""
    return F.transform(F.array_compact(values), convert)


def build_struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def build_map(entries: Column) -> Column:
    """A map from a list of ``{key, value}`` structs; an element without a key is an error."""
    bad = F.exists(entries, lambda e: e["key"].isNull())
    pairs = F.transform(entries, lambda e: F.struct(e["key"], e["value"]))
    return F.map_from_entries(F.when(bad, F.raise_error(F.lit("map entry without a key"))).otherwise(pairs))


def resolve_field(document: Column, path: str, target: str = "string", resolver=F.get_json_object) -> Column:
    """One field of a document, cast to a type. ``resolver`` finds it: any (document, path) → Column."""
    return resolver(document, path).try_cast(target)


def _path_parts(path: str) -> list:
    """``$.units.USD[*].val`` as the parts between list wildcards: ``["$.units.USD", "$.val"]``."""
    if not path.startswith("$"):
        raise ValueError(f"a path starts with $: {path}")
    first, *rest = path.split("[*]")
    return [first, *(f"${part}" for part in rest)]


def variant_field(document: Column, path: str, target: str = "string") -> Column:
    """One field of a VARIANT as ``target``; with list wildcards a list of the fields found in the elements, a list in it for
    every further wildcard. Missing where the path leads nowhere or the value cannot be read as the type; null elements
    and elements without the field are missing elements."""

    def read(value, parts):
        if len(parts) == 1:
            return F.try_variant_get(value, parts[0], target)
        return F.transform(F.try_variant_get(value, parts[0], "array<variant>"), lambda x: read(x, parts[1:]))

    return read(document, _path_parts(path))


def resolve_fields(df: DataFrame, text_col: str, fields: dict) -> DataFrame:
    """``df`` with a column for every entry ``name: (path, type)`` of ``fields``, all read from one parse of the text.

    The parsed document is generated as a one-element list, so that Spark does not copy the parse into every field. A text that
    is not JSON has missing fields.
    """
    parsed = df.select("*", F.explode(F.array(F.try_parse_json(text_col))).alias("_document"))
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns if c not in fields],
                         *[variant_field(F.col("_document"), path, target).alias(name) for name, (path, target) in fields.items()])


def variant_resolver(document: Column, path: str) -> Column:
    """A resolver for ``resolve_field`` over documents that are VARIANT already."""
    return variant_field(document, path)


def write_nested(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """A list, struct or map of ``source`` type as ``target`` type, at any depth.

    Lists lose their null elements; struct fields are matched by name, one the source lacks is missing; a value whose
    kind differs from the target's is missing; scalars follow ``coerce``.
    """
    if isinstance(target, (T.ArrayType, T.StructType, T.MapType)) and type(source) is not type(target):
        return F.lit(None).cast(target)
    if isinstance(target, T.ArrayType):
        return F.transform(F.array_compact(value), lambda x: write_nested(x, source.elementType, target.elementType))
    if isinstance(target, T.MapType):
        return F.map_from_entries(F.transform(F.map_entries(value), lambda e: F.struct(
            write_nested(e["key"], source.keyType, target.keyType).alias("key"),
            write_nested(e["value"], source.valueType, target.valueType).alias("value"))))
    if isinstance(target, T.StructType):
        held = {f.name: f.dataType for f in source.fields}
        fields = [(write_nested(value[f.name], held[f.name], f.dataType) if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name)
                  for f in target.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return coerce(value, source, target)
