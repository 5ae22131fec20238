"""Names: quoting, and case-insensitive look-up of columns."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quote_table(name: str) -> str:
    """Quote ``table`` or ``database.table`` part by part; a name already in backticks is left as it is."""
    return name if "`" in name else ".".join(quote(part) for part in name.split("."))


def column(name: str) -> Column:
    """The column of exactly this name, also when it holds a dot."""
    return F.col(quote(name))


def by_lower_name(names: Iterable[str]) -> dict[str, str]:
    """Map lower-cased names to names; two names that differ at most in case are an error."""
    found: dict[str, str] = {}
    for name in names:
        if name.lower() in found:
            raise ValueError(f"columns {found[name.lower()]!r} and {name!r} cannot be told apart")
        found[name.lower()] = name
    return found


def type_ddl(data_type: DataType) -> str:
    """The type as SQL text, with nested field names quoted where they need it."""
    return StructType([StructField("c", data_type)]).toDDL().removeprefix("c ")


def columns_ddl(fields: Iterable[StructField]) -> str:
    return ", ".join(f"{quote(f.name)} {type_ddl(f.dataType)}" for f in fields)
