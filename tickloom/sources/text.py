"""Delimited, fixed-width and JSON text scans, and their sinks."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Marks without width that a header may start with.
_NO_WIDTH = "﻿​‌‍"


def clean_names(df: DataFrame) -> DataFrame:
    """Column names without zero-width marks, outer blanks and the quotes those marks protected."""
    return df.toDF(*[c.strip(_NO_WIDTH + " \t").strip('"') for c in df.columns])


def scan_csv_inferred(spark: SparkSession, path: str, **options) -> DataFrame:
    """Header and type inference: one extra pass over the text. Name a schema for large inputs."""
    opts = {"header": True, "inferSchema": True, "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    return clean_names(spark.read.options(**{**opts, **options}).csv(path))


def scan_delimited(spark: SparkSession, path, schema, *, sep: str = "\t", header: bool = False,
                   max_chars: int = -1, **options) -> DataFrame:
    """Separator-delimited text with a known schema; ``max_chars`` makes a longer field an error."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("maxCharsPerColumn", max_chars)
    return reader.options(**options).csv(path)


def scan_quarters(spark: SparkSession, base: str, schema, **options) -> DataFrame:
    """All ``<year>q<quarter>/<table>.txt`` under ``base`` as one table with ``year, quarter, tbl``.

    A directory level may also be written ``name=value``. The keys come from each file's path; rows of files whose
    path is none of these are left out.
    """
    reader = scan_delimited(spark, base, schema, **{"recursiveFileLookup": True, **options})
    at = r"(\d{4})q([1-4])/(?:[^/=]+=)?(\w+)\.txt(?:/|$)"
    path = F.col("_metadata.file_path")
    return reader.select("*", F.regexp_extract(path, at, 1).try_cast("int").alias("year"),
                         F.regexp_extract(path, at, 2).try_cast("int").alias("quarter"),
                         F.regexp_extract(path, at, 3).alias("tbl")).where("year IS NOT NULL")


def scan_quarter_tables(spark: SparkSession, base: str, schemas: dict, **options) -> DataFrame:
    """The named tables of all quarters, each read with its own schema, as one table of all their columns.

    ``schemas`` maps a table's name to its schema; a column that a table lacks is missing in its rows. Only the files
    of these tables are opened.
    """
    tables = [scan_quarters(spark, f"{base}/*q[1-4]/{{{name}.txt,tbl={name}.txt}}", schema, **options) for name, schema in schemas.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def scan_csv_strict(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Rows with too few or too many fields, or a value of another type, keep their text in ``_corrupt_record``."""
    checked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    # every field must be read to be checked, whichever columns the query goes on to use
    return scan_delimited(spark, path, checked, sep=options.pop("sep", ","), mode="PERMISSIVE", columnPruning=False,
                          columnNameOfCorruptRecord="_corrupt_record", **options)


def scan_fixed_width(spark: SparkSession, path: str, fields, *, pad: str = "_", missing: str = "null") -> DataFrame:
    """Lines cut at fixed places: ``fields`` is ``[(name, width, type)]``.

    Padding is stripped on the right; the missing token becomes NULL. ``_wrong_length`` marks lines
    whose length is not the sum of the widths.
    """
    total = sum(w for _, w, _ in fields)
    line, cols, start = F.col("value"), [], 1
    for name, width, kind in fields:
        text = F.rtrim(F.substring(line, start, width), F.lit(pad))
        cols.append(F.when(~text.isin("", missing), text).try_cast(kind).alias(name))
        start += width
    return spark.read.text(path).select(*cols, (F.length(line) != total).alias("_wrong_length"))


def scan_json_documents(spark: SparkSession, path: str, schema, *, whole_file: bool = False) -> DataFrame:
    """JSON documents with a known schema, one per line, or one per file with ``whole_file``."""
    return spark.read.schema(schema).option("multiLine", whole_file).json(path)


def sink_csv(df: DataFrame, path: str, **options) -> None:
    df.write.mode("overwrite").options(**{"header": True, **options}).csv(path)


def render_row(*cols, sep: str = "\t") -> Column:
    """One row as delimited text."""
    return F.to_csv(F.struct(*cols), {"sep": sep})


def safe_member(name: str) -> bool:
    """Whether an archive member stays inside the directory it would be unpacked to."""
    depth = 0
    if re.match(r"^([/\\]|[A-Za-z]:)", name):
        return False
    for step in re.split(r"[/\\]", name):
        depth += {"..": -1, ".": 0, "": 0}.get(step, 1)
        if depth < 0:
            return False
    return True
