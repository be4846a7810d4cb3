"""Scalar functions: text, dates, numbers and typed conversion. All are Column → Column."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The range of a 32-bit integer.
INT_MIN, INT_MAX = -2147483648, 2147483647


def left_pad_id(col: Column, width: int = 10) -> Column:
    """Zeros in front up to ``width``; longer ids stay whole. Width 9 is the coded variant."""
    return F.when(F.length(col) < width, F.lpad(col, width, "0")).otherwise(col)


def ci_not_equal(a: Column, b: Column) -> Column:
    return F.lower(a) != F.lower(b)


def join_strings(*cols: Column) -> Column:
    return F.concat_ws(", ", *cols)


def iso_date(col: Column) -> Column:
    return F.to_date(col, "yyyy-MM-dd")


def minus_years(col: Column, years) -> Column:
    return F.add_months(col, years * -12)


def local_date_in_zone(ts: Column, zone) -> Column:
    """Calendar day of an instant in a time zone; a zone-less timestamp is read as UTC."""
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp_ntz").cast("timestamp"), zone))


def two_digit_year_date(col: Column, fmt: str, asof: str) -> Column:
    """Date text with a two-digit year: a year after that of ``asof`` belongs to the century before."""
    day = F.to_date(col, fmt)
    return F.when(F.year(day) > F.year(F.lit(asof).cast("date")), F.add_months(day, -1200)).otherwise(day)


def to_int(col: Column) -> Column:
    """Truncate towards zero and clamp to 32 bits, NaN as 0."""
    whole = F.when(col < 0, F.ceil(col)).otherwise(F.floor(col))
    return (F.when(F.isnan(col), 0).when(col >= INT_MAX, INT_MAX).when(col <= INT_MIN, INT_MIN)
            .otherwise(whole).cast("int"))


def to_decimal(col: Column, precision: int, scale: int) -> Column:
    """Decimal with half-up rounding of the shortest decimal text of a double."""
    return col.cast(T.DecimalType(precision, scale))


def number_to_bool(col: Column) -> Column:
    """True for numbers above zero; a missing value stays missing."""
    return col > 0


def date_from_days(col: Column) -> Column:
    return F.date_from_unix_date(col.cast("int"))


def coerce(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """A value of ``source`` type as ``target`` type, by the rules of the document writers."""
    numeric = isinstance(source, T.NumericType)
    if isinstance(target, T.BooleanType):
        return number_to_bool(col) if numeric else col.try_cast("boolean")
    if isinstance(target, T.IntegerType) and isinstance(source, (T.DoubleType, T.FloatType)):
        return to_int(col)
    if isinstance(target, T.TimestampType) and numeric:
        return F.timestamp_seconds(col)
    if isinstance(target, T.DateType) and numeric:
        return date_from_days(col)
    if isinstance(target, T.DateType) and isinstance(source, T.StringType):
        return F.try_to_date(col, "yyyy-MM-dd")
    return col.try_cast(target)


# Unsigned and other column types by name, and the Spark type that holds them.
TYPE_NAMES = {
    "TIMESTAMPMILLITZ": "timestamp", "DATEMILLI": "timestamp", "DATEDAY": "date", "FLOAT8": "double",
    "FLOAT4": "float", "INT": "int", "BIGINT": "bigint", "TINYINT": "tinyint", "SMALLINT": "smallint",
    "UINT1": "smallint", "UINT2": "int", "UINT4": "bigint", "UINT8": "decimal(20,0)", "VARBINARY": "binary",
    "DECIMAL": "decimal(38,10)", "VARCHAR": "string", "BIT": "boolean",
}


def null_value(type_name: str) -> Column:
    """A missing value of the named column type; an unknown type is an error."""
    if type_name not in TYPE_NAMES:
        raise ValueError(f"Unknown type {type_name}")
    return F.lit(None).cast(TYPE_NAMES[type_name])


def write_value(col: Column, source: T.DataType, type_name: str) -> Column:
    """A value of ``source`` type as the named column type; missing where it cannot be written.

    Whole numbers are milliseconds for ``TIMESTAMPMILLITZ`` and ``DATEMILLI``, and days for ``DATEDAY``. ``BIT`` is true
    for true and for whole numbers above zero, false for everything else that is there. Decimals round half up.
    """
    if type_name not in TYPE_NAMES:
        raise ValueError(f"Unknown type {type_name}")
    target = T.StructType.fromDDL(f"x {TYPE_NAMES[type_name]}")[0].dataType
    if type_name == "BIT" and not isinstance(source, T.BooleanType):
        return F.when(col.isNotNull(), col > 0 if isinstance(source, T.IntegralType) else F.lit(False))
    if type_name in ("TIMESTAMPMILLITZ", "DATEMILLI") and isinstance(source, T.IntegralType):
        return F.timestamp_millis(col.cast("long"))
    if type_name == "VARBINARY":
        return col if isinstance(source, T.BinaryType) else col.cast("string").cast("binary")
    return coerce(col, source, target)
