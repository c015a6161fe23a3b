from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def col_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def quoted(name: str) -> Column:
    """The column of this very name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")
