"""Queries: nested documents. One JSON document is derived from every line item, where it lies."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import nested as ns
from tickloom.operators import schema_merge as sm
from tickloom.plans import base as b
from tickloom.plans.registry import query
from tickloom.session import spread

ID = ["l_orderkey", "l_linenumber"]


def documents(spark, d):
    """``(l_orderkey, l_linenumber, text)``: as many USD units as the line number, none without a
    discount; a second unit for taxed lines; keys outside the schema; a null description for open lines."""
    ship = F.to_date("l_shipdate")
    # what all items of a line share is computed once, beside the list
    lines = spread(b.table(spark, d, "lineitem")).withColumns({
        "ship": ship, "base": F.floor("l_quantity") * 1000, "key": F.col("l_orderkey").cast("string"), "fy": F.year(ship),
        "fp": F.concat(F.lit("Q"), F.quarter(ship).cast("string")), "form": F.when(F.col("l_returnflag") == "A", "10-K").otherwise("10-Q")})

    def item(k):
        return F.struct(
            F.date_add("ship", k).cast("string").alias("end"), (F.col("base") + k).cast("long").alias("val"),
            F.concat_ws("-", "key", k.cast("string")).alias("accn"), "fy", "fp", "form",
            F.date_add("ship", k + 30).cast("string").alias("filed"), F.lit("CY").alias("frame"))

    top = F.struct(
        F.col("l_partkey").alias("cik"), F.lit("us-gaap").alias("taxonomy"), F.lit("Assets").alias("tag"),
        F.col("l_returnflag").alias("label"), F.when(F.col("l_linestatus") == "F", "final").alias("description"),
        F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("entityName"))
    # the items are written as JSON once, for both units; the top ends with a text field, so only its own brace is cut off
    units = F.concat_ws(",", F.when(F.col("l_discount") > 0, F.concat(F.lit('"USD":'), "items")),
                        F.when(F.col("l_tax") > 0.04, F.concat(F.lit('"shares":'), "items")))
    text = F.concat(F.rtrim("top", F.lit("}")), F.lit(',"units":{'), units, F.lit('},"extra":"not in the schema"}'))
    items = F.to_json(F.transform(F.sequence(F.lit(1), "l_linenumber"), item))
    return lines.withColumns({"items": items, "top": F.to_json(top)}).select(*ID, "l_suppkey", text.alias("text"))


UNITS = """items AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount, l_tax, k,
    CAST(CAST(l_shipdate AS DATE) + CAST(k AS INTEGER) AS DATE) AS "end", CAST(floor(l_quantity) * 1000 + k AS BIGINT) AS val,
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(k AS VARCHAR)) AS accn, CAST(year(l_shipdate) AS VARCHAR) AS fy,
    'Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS fp, CASE WHEN l_returnflag = 'A' THEN '10-K' ELSE '10-Q' END AS form,
    CAST(CAST(l_shipdate AS DATE) + CAST(k + 30 AS INTEGER) AS DATE) AS filed
  FROM (SELECT *, unnest(range(1, l_linenumber + 1)) AS k FROM lineitem))"""
TOP = """CAST(l_partkey AS VARCHAR) AS cik, 'us-gaap' AS taxonomy, 'Assets' AS tag, l_returnflag AS label,
  CASE WHEN l_linestatus = 'F' THEN 'final' END AS description, 'Supplier ' || CAST(l_suppkey AS VARCHAR) AS "entityName" """


def _tagged(docs):
    return ns.tag_unit_type(ns.extract_unit_list(docs))


def _usd(spark, d):
    return _tagged(ns.json_to_document(documents(spark, d), "text"))


def _typed(spark, d):
    return ns.write_units_struct(_usd(spark, d))


@query("json_to_document", f"""SELECT l_orderkey, l_linenumber, {TOP}, CASE WHEN l_discount > 0 THEN l_linenumber END AS n_usd,
  CASE WHEN l_tax > 0.04 THEN l_linenumber END AS n_shares FROM lineitem""")
def json_to_document(spark, d):
    docs = ns.json_to_document(documents(spark, d), "text")
    n = {u: F.when(F.col("units")[u].isNotNull(), F.size(F.col("units")[u])) for u in ("USD", "shares")}
    return docs.select(*ID, *ns.DOCUMENT_FIELDS, n["USD"].alias("n_usd"), n["shares"].alias("n_shares"))


def _partly_broken(spark, d):
    """Short documents; those of lines with a tax of 0.03 lack their last character."""
    whole = b.table(spark, d, "lineitem").withColumn("text", F.to_json(F.struct(F.col("l_partkey").alias("cik"))))
    cut = F.when(F.col("l_tax") == 0.03, F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    return whole.select(*ID, cut.alias("text"))


@query("json_to_document_mistyped", """SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS cik, CASE WHEN l_tax <> 0.03 THEN 2 END AS n,
  CASE WHEN l_tax NOT IN (0.02, 0.03) THEN CAST(l_suppkey AS BIGINT) END AS val, CASE WHEN l_tax <> 0.03 THEN 8 END AS other FROM lineitem""")
def json_to_document_mistyped(spark, d):
    """A fraction for a tax of 0.02, text for 0.01, and something that is no map of units for 0.03: all documents stay."""
    supp = F.col("l_suppkey").cast("string")
    val = (F.when(F.col("l_tax") == 0.02, F.concat(supp, F.lit(".5"))).when(F.col("l_tax") == 0.01, F.concat(F.lit('"'), supp, F.lit('"')))
           .when(F.col("l_tax") == 0.04, F.concat(supp, F.lit(".0"))).otherwise(supp))
    units = F.when(F.col("l_tax") == 0.03, F.lit("5")).otherwise(
        F.concat(F.lit('{"USD":[{"val":'), val, F.lit('},{"val":8}]}')))
    text = F.concat(F.lit('{"cik":'), F.col("l_partkey").cast("string"), F.lit(',"units":'), units, F.lit("}"))
    docs = ns.write_units_struct(_tagged(ns.json_to_document(b.table(spark, d, "lineitem").select(*ID, text.alias("text")), "text")))
    held = F.when(F.col("units").isNotNull(), F.size("units"))
    return docs.select(*ID, "cik", held.alias("n"), F.try_element_at("units", F.lit(1))["val"].alias("val"),
                       F.try_element_at("units", F.lit(2))["val"].cast("int").alias("other"))


@query("drop_failed_rows", "SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS cik FROM lineitem WHERE l_tax <> 0.03")
def drop_failed_rows(spark, d):
    return ns.drop_failed_rows(ns.parse_documents(_partly_broken(spark, d), "text")).select(*ID, F.col("doc.cik").alias("cik"))


@query("failed_rows", "SELECT l_orderkey, l_linenumber, '{\"cik\":' || CAST(l_partkey AS VARCHAR) AS _corrupt FROM lineitem WHERE l_tax = 0.03")
def failed_rows(spark, d):
    return ns.failed_rows(ns.parse_documents(_partly_broken(spark, d), "text")).select(*ID, "_corrupt")


@query("extract_unit_list", f"""WITH {UNITS} SELECT l_orderkey, l_linenumber, accn, val FROM items WHERE l_tax > 0.04
UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL FROM lineitem WHERE NOT l_tax > 0.04""")
def extract_unit_list(spark, d):
    docs = ns.extract_unit_list(ns.json_to_document(documents(spark, d), "text"), "shares")
    return docs.select(*ID, F.explode_outer("units").alias("u")).select(*ID, "u.accn", ns.whole_number(F.col("u.val")).alias("val"))


@query("tag_unit_type", f"""WITH {UNITS} SELECT l_orderkey, l_linenumber, accn, 'USD' AS type FROM items WHERE l_discount > 0
UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL FROM lineitem WHERE NOT l_discount > 0""")
def tag_unit_type(spark, d):
    return _usd(spark, d).select(*ID, F.explode_outer("units").alias("u")).select(*ID, "u.accn", "u.type")


@query("replace_key", "SELECT l_orderkey, l_linenumber, lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS cik FROM lineitem")
def replace_key(spark, d):
    docs = ns.json_to_document(documents(spark, d), "text")
    requested = F.lpad(F.col("l_suppkey").cast("string"), 10, "0")
    return ns.replace_key(docs, requested).select(*ID, "cik")


@query("write_units_struct", f"""WITH {UNITS} SELECT l_orderkey, l_linenumber, accn, form, fp, fy, 'USD' AS type, "end", filed, val
FROM items WHERE l_discount > 0
UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM lineitem WHERE NOT l_discount > 0""")
def write_units_struct(spark, d):
    return _typed(spark, d).select(*ID, F.explode_outer("units").alias("u")).select(*ID, "u.*")


@query("write_scalar_field", f"""SELECT l_orderkey, l_linenumber, CAST(l_partkey AS INTEGER) AS cik, CAST(NULL AS INTEGER) AS label,
  CASE WHEN l_linestatus = 'F' THEN 'final' END AS description, 'label' AS errors FROM lineitem""")
def write_scalar_field(spark, d):
    docs = ns.json_to_document(documents(spark, d), "text").select(*ID, "cik", "label", "description")
    out = ns.write_scalar_fields(docs, {"cik": "int", "label": "int", "description": "string"})
    return out.withColumn("errors", F.array_join("_errors", ",")).drop("_errors")


@query("write_scalar_field_strict", f"""SELECT l_orderkey, l_linenumber, CAST(l_partkey AS INTEGER) AS cik, l_returnflag AS label FROM lineitem""")
def write_scalar_field_strict(spark, d):
    docs = ns.json_to_document(documents(spark, d), "text").select(*ID, "cik", "label")
    return ns.write_scalar_fields(docs, {"cik": "int", "label": "string"}, strict=True)


@query("explode_units", f"""WITH {UNITS} SELECT CAST(l_partkey AS VARCHAR) AS cik, accn, form, fp, fy, 'USD' AS type, "end", filed, val
FROM items WHERE l_discount > 0
UNION ALL SELECT CAST(l_partkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM lineitem WHERE NOT l_discount > 0""")
def explode_units(spark, d):
    return ns.explode_units(_typed(spark, d))


@query("company_table", """SELECT lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS cik, l_returnflag AS label,
  CASE WHEN l_discount > 0 THEN l_linenumber END AS n,
  CASE WHEN l_discount > 0 THEN CAST(l_linenumber * floor(l_quantity) * 1000 + l_linenumber * (l_linenumber + 1) // 2 AS BIGINT) END AS total
FROM lineitem""")
def company_table(spark, d):
    docs = ns.company_table(documents(spark, d), "text", F.lpad(F.col("l_suppkey").cast("string"), 10, "0"))
    total = F.aggregate("units", F.lit(0).cast("long"), lambda s, u: s + u["val"])
    return docs.select("cik", "label", F.when(F.col("units").isNotNull(), F.size("units")).alias("n"), total.alias("total"))


@query("units_for_key", """SELECT CAST(l_partkey AS VARCHAR) AS cik, CASE WHEN l_discount > 0 THEN l_linenumber ELSE 0 END AS n_units
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size <= 10""")
def units_for_key(spark, d):
    wanted = b.table(spark, d, "part").where("p_size <= 10").select(F.col("p_partkey").cast("string").alias("cik"))
    return ns.units_for_keys(_usd(spark, d), wanted).drop("units")


def mixed_documents(spark, d):
    """One document per event whose field types depend on the event."""
    click = F.col("event_type") == "click"
    text = F.concat(
        F.lit('{"id":'), F.col("event_id").cast("string"),
        F.lit(',"big":'), (F.col("event_id") + 3_000_000_000).cast("string"),
        F.lit(',"k":'), F.when(click, "7").otherwise("2.5"),
        F.lit(',"flag":true,"none":null,"at":{"$date":"2024-01-01T00:00:00Z"},"tags":'),
        F.when(click, "[]").otherwise("[1,2]"),
        F.lit(',"list":[1,"a"],"pairs":[{"x":'), F.col("user_id").cast("string"), F.lit('}],"user":{"uid":'),
        F.col("user_id").cast("string"), F.lit(',"name":'), F.when(click, '"n"').otherwise("1"),
        F.when(F.col("value") > 50, ',"rich":true').otherwise(""),
        F.lit('},"shape":'), F.when(click, '{"inner":1}').otherwise("1"), F.lit("}"))
    return spread(b.table(spark, d, "events")).select("event_id", text.alias("text"))


MERGED = """SELECT path, CASE WHEN count(DISTINCT t) = 1 THEN min(t) ELSE 'string' END AS type FROM (
  SELECT unnest(['id', 'big', 'k', 'flag', 'none', 'at', 'tags', 'tags[]', 'list', 'list[]', 'pairs', 'pairs[]', 'user',
                 'user.uid', 'user.name', 'shape']) AS path,
    unnest(['int', 'long', CASE WHEN c THEN 'int' ELSE 'double' END, 'boolean', 'string', 'timestamp', 'list',
            CASE WHEN c THEN 'string' ELSE 'int' END, 'list', 'int', 'list', 'struct', 'struct', 'int',
            CASE WHEN c THEN 'string' ELSE 'int' END, CASE WHEN c THEN 'struct' ELSE 'int' END]) AS t
  FROM (SELECT event_type = 'click' AS c FROM events)
  UNION ALL SELECT 'user.rich', 'boolean' FROM events WHERE value > 50) GROUP BY path"""


@query("infer_document_schema", f"""WITH m AS ({MERGED}) SELECT path, type FROM m""")
def infer_document_schema(spark, d):
    return sm.infer_schema(mixed_documents(spark, d), "event_id", "text").select("path", "type")


@query("merge_schemas", f"""WITH m AS ({MERGED}) SELECT path, type, CASE WHEN path = 'pairs[]' THEN 'struct<`x`:int>' ELSE '' END AS element FROM m
WHERE path NOT LIKE '%[]'  OR path = 'pairs[]'""")
def merge_schemas(spark, d):
    merged = sm.merge_paths(sm.document_paths(mixed_documents(spark, d), "event_id", "text"))
    return merged.where(~F.col("path").endswith("[]") | (F.col("path") == "pairs[]")).drop("steps")


@query("merge_list_schemas", f"""WITH m AS ({MERGED}) SELECT replace(path, '[]', '') AS field, 'array<' || CASE WHEN path = 'pairs[]'
  THEN 'struct<`x`:int>' ELSE type END || '>' AS type FROM m WHERE path LIKE '%[]'""")
def merge_list_schemas(spark, d):
    merged = sm.infer_schema(mixed_documents(spark, d), "event_id", "text").where(F.col("path").endswith("[]"))
    kind = F.when(F.col("element") != "", F.col("element")).otherwise(F.col("type"))
    return merged.select(F.replace("path", F.lit("[]"), F.lit("")).alias("field"),
                         F.concat(F.lit("array<"), kind, F.lit(">")).alias("type"))


@query("build_list", """SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) || CASE WHEN l_discount > 0
  THEN ',' || CAST(l_suppkey AS VARCHAR) ELSE '' END || ',' || CAST(l_linenumber AS VARCHAR) AS items FROM lineitem""")
def build_list(spark, d):
    items = ns.build_list(F.col("l_partkey"), F.when(F.col("l_discount") > 0, F.col("l_suppkey")), F.col("l_linenumber").cast("long"))
    text = F.array_join(ns.build_list_of(items, lambda x: x.cast("string")), ",")
    return b.table(spark, d, "lineitem").select(*ID, text.alias("items"))


def _rewritten(spark, d, value, target):
    """``lineitem`` ids and ``value`` written as the type ``target``."""
    df = b.table(spark, d, "lineitem").select(*ID, value.alias("v"))
    kind = T.StructType.fromDDL(f"x {target}")[0].dataType
    return df.select(*ID, ns.write_nested(F.col("v"), df.schema["v"].dataType, kind).alias("v"))


@query("build_list_nested", """SELECT l_orderkey, l_linenumber, '[' || l_partkey || CASE WHEN l_discount > 0 THEN ',' || l_suppkey ELSE '' END || ']'
  || CASE WHEN l_tax > 0 THEN ';[' || l_linenumber || ']' ELSE '' END AS lists, l_suppkey AS supp, l_returnflag AS flag FROM lineitem""")
def build_list_nested(spark, d):
    """A list of lists, and in it a list of structs with a list of its own."""
    numbers = F.array(F.array("l_partkey", F.when(F.col("l_discount") > 0, F.col("l_suppkey"))),
                      F.when(F.col("l_tax") > 0, F.array(F.col("l_linenumber").cast("long"))))
    inner = F.struct(F.col("l_suppkey").cast("string").alias("supp"), F.array(F.lit(None).cast("string"), F.col("l_returnflag")).alias("flags"))
    out = _rewritten(spark, d, F.struct(numbers.alias("n"), F.array(F.lit(None).cast("struct<supp:string,flags:array<string>>"), inner).alias("s")),
                     "struct<n:array<array<string>>,s:array<struct<supp:bigint,flags:array<string>,none:int>>>")
    text = F.array_join(F.transform("v.n", lambda x: F.concat(F.lit("["), F.array_join(x, ","), F.lit("]"))), ";")
    one = F.element_at("v.s", 1)
    return out.select(*ID, text.alias("lists"), one["supp"].alias("supp"), F.element_at(one["flags"], 1).alias("flag"))


@query("build_map_nested", """SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS supp, CAST(l_linenumber AS BIGINT) AS line,
  CAST(NULL AS INTEGER) AS odd FROM lineitem""")
def build_map_nested(spark, d):
    """A map of structs that hold a map; the text in place of a map is missing."""
    value = F.create_map(F.lit("a"), F.struct(F.col("l_suppkey").alias("supp"), F.create_map(F.col("l_returnflag"), F.col("l_linenumber").cast("int")).alias("m"),
                                              F.lit("text").alias("odd")))
    out = _rewritten(spark, d, value, "map<string,struct<supp:string,m:map<string,bigint>,odd:map<string,int>>>")
    a = F.col("v")["a"]
    return out.select(*ID, a["supp"].alias("supp"), F.element_at(F.map_values(a["m"]), 1).alias("line"), F.element_at(F.map_values(a["odd"]), 1).alias("odd"))


@query("build_struct", "SELECT l_orderkey, l_linenumber, l_quantity AS qty, l_returnflag AS flag, l_linestatus AS status FROM lineitem")
def build_struct(spark, d):
    s = ns.build_struct(qty=F.col("l_quantity"), codes=ns.build_struct(flag=F.col("l_returnflag"), status=F.col("l_linestatus")))
    return b.table(spark, d, "lineitem").select(*ID, s.alias("s")).select(*ID, "s.qty", "s.codes.flag", "s.codes.status")


@query("build_map", "SELECT l_orderkey, l_linenumber, l_quantity AS qty, l_tax AS tax, CAST(2 AS INTEGER) AS n FROM lineitem")
def build_map(spark, d):
    def entry(name, value):
        return F.struct(F.lit(name).alias("key"), F.col(value).alias("value"))

    m = ns.build_map(F.array(entry("qty", "l_quantity"), entry("tax", "l_tax")))
    return b.table(spark, d, "lineitem").withColumn("m", m).select(
        *ID, F.col("m")["qty"].alias("qty"), F.col("m")["tax"].alias("tax"), F.size("m").alias("n"))


@query("resolve_field", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS other FROM events")
def resolve_field(spark, d):
    props = F.col("props")
    return b.table(spark, d, "events").select("event_id", ns.resolve_field(props, "$.k", "int").alias("k"),
                                              ns.resolve_field(props, "$.other").alias("other"))


TEN = {"cik": ("$.cik", "string"), "entity": ("$.entityName", "string"), "tag": ("$.tag", "string"), "label": ("$.label", "string"),
       "taxonomy": ("$.taxonomy", "string"), "usd": ("$.units.USD[*].val", "bigint"), "filed": ("$.units.USD[*].filed", "string"),
       "forms": ("$.units.USD[*].form", "string"), "first_val": ("$.units.USD[0].val", "bigint"), "none": ("$.units.none[*].val", "string")}


@query("resolve_fields", """SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS cik, 'Supplier ' || CAST(l_suppkey AS VARCHAR) AS entity,
  'Assets' AS tag, l_returnflag AS label, 'us-gaap' AS taxonomy, CASE WHEN l_discount > 0 THEN CAST(floor(l_quantity) * 1000 + 1 AS BIGINT) END AS first_val,
  CASE WHEN l_discount > 0 THEN array_to_string(list_transform(range(1, l_linenumber + 1), lambda k: CAST(CAST(floor(l_quantity) * 1000 + k AS BIGINT) AS VARCHAR)), ',') END AS usd,
  CASE WHEN l_discount > 0 THEN array_to_string(list_transform(range(1, l_linenumber + 1), lambda k: CAST(CAST(CAST(l_shipdate AS DATE) + CAST(k + 30 AS INTEGER) AS DATE) AS VARCHAR)), ',') END AS filed,
  CASE WHEN l_discount > 0 THEN array_to_string(list_transform(range(1, l_linenumber + 1), lambda k: CASE WHEN l_returnflag = 'A' THEN '10-K' ELSE '10-Q' END), ',') END AS forms,
  CAST(NULL AS VARCHAR) AS "none" FROM lineitem""")
def resolve_fields(spark, d):
    """Ten fields of each document, lists of fields among them, from one parse."""
    found = ns.resolve_fields(documents(spark, d), "text", TEN)
    lists = {c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",") for c in ("usd", "filed", "forms", "none")}
    return found.drop("text", "l_suppkey").withColumns(lists)
