"""Headered CSV with a declared schema; bad cells become nulls, and can be reported."""

import unicodedata
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tripmill.functions.names import column
from tripmill.schema import TRIP

BAD_CELLS = "bad_cells"
RAW = "raw"
LINE = "line"
FILE = "file"
FAULTY = "faulty"

# Endings of compressed files that a single task reads from the first byte to the last.
WHOLE_FILES = (".gz", ".zst", ".snappy", ".lz4", ".deflate")

# Bits in a note of files, as many as Spark's bitmaps have: 4 KB, however many files there are.
_BITS = 32768

# The only words that the CSV reader takes for numbers that are not finite.
_WORDS = r"^(-?Inf|\s*[+-]?(Infinity|NaN)\s*)$"
_WHOLE = r"^[+-]?[0-9]+$"

# The digits of all scripts, which the CSV reader takes in whole numbers and a cast does not, and what they stand for.
_DIGITS = "".join(c for c in map(chr, range(128, 0x10000)) if unicodedata.decimal(c, None) is not None)
_AS_ASCII = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = TRIP,
    *,
    check_header: bool = False,
) -> DataFrame:
    """Read headered CSV, binding cells to columns by position.

    The header line is skipped. With ``check_header`` its names count: those of each file are compared
    with the declared ones by the task that opens it, without regard to case, and another header fails
    the read. A cell that does not parse is null and the rest of its row is kept; short rows end in
    nulls; cells beyond the schema are cut; blank lines are ignored.
    """
    # The zone of this moment, also if the session's changes before the frame is used.
    zone = spark.conf.get("spark.sql.session.timeZone")
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", not check_header)
    return reader.option("timeZone", zone).csv(path)


def read_noted_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = TRIP,
    *,
    check_header: bool = False,
) -> DataFrame:
    """Read like ``read_csv`` and add ``faulty`` (whether the reader found fault with the row) and ``file``.

    It costs little more than a plain read, and tells which files to put to ``read_checked_csv`` for the cells. Use it where all
    columns are used: the reader finds fault with the number of cells, and with those that it is asked for.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    with_line = StructType([*schema, StructField(LINE, StringType())])
    reader = spark.read.schema(with_line).option("header", True).option("enforceSchema", not check_header)
    reader = reader.option("columnNameOfCorruptRecord", LINE).option("columnPruning", False)
    rows = reader.option("timeZone", zone).csv(path)
    faulty = F.col(LINE).isNotNull() & _read(column(schema.names[0]))
    return rows.select(*[column(n) for n in schema.names], faulty.alias(FAULTY), F.col("_metadata.file_path").alias(FILE))


def _read(value: Column) -> Column:
    """True; the column is asked for, since Spark does not read the text of malformed records alone."""
    return F.length(F.coalesce(value.cast("string"), F.lit(""))) >= 0


def read_checked_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = TRIP,
    *,
    check_header: bool = False,
    files: bytes | None = None,
) -> DataFrame:
    """Read like ``read_csv`` and add ``bad_cells`` (names of the bad columns), ``raw`` (the texts) and ``file``.

    All cells are read as text and cast here, so a bad cell is found no matter which columns a query
    goes on to use. A row with more or fewer cells than the schema is reported under ``line``, and ``raw``
    then keeps its whole line, all surplus cells with it.

    With ``files``, a note made by ``files_of``, only files that are in it are opened: all that were noted, and
    of very many others a few.
    """
    # Spark's text of malformed records tells rows by their number of cells, as nothing else can be wrong
    # with text. It depends on which columns are read, so all are: every reject is asked about all of them.
    texts = StructType([StructField(n, StringType()) for n in [*schema.names, LINE]])
    reader = spark.read.schema(texts).option("header", True).option("enforceSchema", not check_header)
    cells = reader.option("columnNameOfCorruptRecord", LINE).option("columnPruning", False).csv(path)
    if files is not None:
        # On the scan itself, where Spark asks a filter on nothing but the file before it opens it.
        cells = cells.where(_noted(F.col("_metadata.file_path"), files))
    typed = cells.select(
        *[_cell(column(f.name), f.dataType).alias(f.name) for f in schema],
        F.struct(*[column(n) for n in [*schema.names, LINE]]).alias(RAW),
        F.col("_metadata.file_path").alias(FILE),
    )
    bad = {
        f.name: F.col(RAW)[f.name].isNotNull() & column(f.name).isNull()
        for f in schema
        if not isinstance(f.dataType, StringType)
    }
    bad[LINE] = F.col(RAW)[LINE].isNotNull() & _read(F.col(RAW)[schema.names[0]])
    names = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in bad.items()]))
    # Most rows are good: ask that first, and only then put the names together.
    bad_cells = F.when(reduce(or_, bad.values()), names).otherwise(F.array().cast("array<string>"))
    return typed.select(*[column(n) for n in schema.names], bad_cells.alias(BAD_CELLS), RAW, FILE)


def rows_of(checked: DataFrame) -> DataFrame:
    """The typed rows of a checked read, bad cells as nulls: the same rows ``read_csv`` gives."""
    return checked.drop(BAD_CELLS, RAW, FILE)


def rejects_of(checked: DataFrame) -> DataFrame:
    """The rows with bad cells: every cell as it stood in the file, and the names of the bad ones.

    ``line`` has the whole line where the number of its cells is not that of the schema.
    """
    return checked.where(is_reject()).select(f"{RAW}.*", BAD_CELLS)


def is_reject() -> Column:
    return F.size(BAD_CELLS) > 0


def files_of(flag: Column) -> Column:
    """An aggregate of a read with ``file``: a note, of fixed size, of the files that have such rows. A row counted twice does not matter."""
    return F.bitmap_construct_agg(F.when(flag, _bit(F.col(FILE))))


def _bit(path: Column) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(_BITS))


def _noted(path: Column, files: bytes) -> Column:
    # Position p is bit p % 8 of byte p / 8.
    byte = F.conv(F.hex(F.substring(F.lit(files), F.floor(_bit(path) / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (_bit(path) % 8).cast("int")) == 1


def _cell(text: Column, data_type: DataType) -> Column:
    value = text.try_cast(data_type)
    if isinstance(data_type, (IntegerType, LongType)):
        # A cast trims blanks, the reader of typed CSV does not; and that knows all digits.
        other = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, _DIGITS, _AS_ASCII))
        return F.when(text.rlike(_WHOLE), value).when(other.rlike(_WHOLE), other.try_cast(data_type))
    if isinstance(data_type, DoubleType):
        finite = F.abs(value) < F.lit(float("inf"))
        return F.when(finite | text.rlike(_WORDS) | text.rlike("[0-9]"), value)
    if isinstance(data_type, (StringType, TimestampType)):
        return value
    raise ValueError(f"a checked read has no rule for {data_type.simpleString()} cells")

