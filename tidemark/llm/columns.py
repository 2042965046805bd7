"""Column helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def named(name: str) -> Column:
    """A column by its whole name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(named(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def hidden(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
