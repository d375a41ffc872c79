"""Small helpers shared by the function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return c if isinstance(c, Column) else F.col(c)


def quote(name: str) -> str:
    """Backtick-quote a column name for use inside SQL text / ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    """Column by exact name, even when the name holds dots or spaces."""
    return F.col(quote(name))
