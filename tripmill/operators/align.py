"""Fit a frame to the columns of a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tripmill.functions.names import by_lower_name, column

# Decimal digits the whole numbers need, narrowest first.
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}

# Whole numbers that each kind of fraction holds exactly.
_EXACT = {FloatType: (ByteType, ShortType), DoubleType: (ByteType, ShortType, IntegerType, FloatType)}


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: its names and order, names matched without regard to case.

    Columns the frame lacks become nulls of the table's type. Columns the table lacks are left out.
    Types are not changed here; the insert checks them.
    """
    have = by_lower_name(df.columns)

    def pick(field):
        source = have.get(field.name.lower())
        value = F.lit(None).cast(field.dataType) if source is None else column(source)
        return value.alias(field.name)

    return df.select([pick(field) for field in schema])


def missing_from(df: DataFrame, schema: StructType) -> StructType:
    """The fields of ``df`` that ``schema`` has no column for, in input order."""
    known = {name.lower() for name in schema.names}
    return StructType([field for field in df.schema if field.name.lower() not in known])


def check_types(df: DataFrame, schema: StructType) -> None:
    """Refuse input that the table's types do not hold as it is, naming every such column at once.

    Whole numbers fit wider ones, fractions and decimals that hold all their values; ``float`` fits
    ``double``, a decimal one with no fewer digits on either side, a date a timestamp. Timestamps with
    and without zone fit each other, as times of the session zone. Anything plain fits text. So bigint
    into int, bigint or a decimal into double, and a timestamp into a date are refused, whatever the values.
    Nested types must fit part by part.
    """
    target = {field.name.lower(): field.dataType for field in schema}
    drifted = [
        f"{field.name}: {field.dataType.simpleString()} into {want.simpleString()}"
        for field in df.schema
        if (want := target.get(field.name.lower())) is not None and not _fits(field.dataType, want)
    ]
    if drifted:
        raise TypeError("column types drifted from the table: " + "; ".join(drifted))


def _fits(have: DataType, want: DataType) -> bool:
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return _fits(have.elementType, want.elementType)
    if isinstance(have, MapType) and isinstance(want, MapType):
        return _fits(have.keyType, want.keyType) and _fits(have.valueType, want.valueType)
    if isinstance(have, StructType) and isinstance(want, StructType):
        pairs = zip(have.fields, want.fields, strict=False)
        return len(have) == len(want) and all(_fits(a.dataType, b.dataType) for a, b in pairs)
    if isinstance(have, DecimalType) and isinstance(want, DecimalType):
        whole = have.precision - have.scale <= want.precision - want.scale
        return whole and have.scale <= want.scale
    if type(have) is type(want):
        return True
    if not (isinstance(have, AtomicType) and isinstance(want, AtomicType)):
        # Others have no common form; a void column is null throughout.
        return not isinstance(have, AtomicType) and have.simpleString() == "void"
    if isinstance(want, StringType):
        return True
    if type(have) in _DIGITS and type(want) in _DIGITS:
        return _DIGITS[type(have)] <= _DIGITS[type(want)]
    if type(have) in _DIGITS and isinstance(want, DecimalType):
        return _DIGITS[type(have)] <= want.precision - want.scale
    if type(want) in _EXACT:
        return isinstance(have, _EXACT[type(want)])
    moments = (TimestampType, TimestampNTZType)
    return isinstance(want, moments) and isinstance(have, (DateType, *moments))
