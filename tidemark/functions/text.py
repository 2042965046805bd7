"""Text forms: trimming, names, amounts, labels, ids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

# The characters that count as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Texts that stand for "no value" in an all-text table.
NULL_TOKENS = ("nan", "None", "<NA>", "")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_if_token(c: Column) -> Column:
    return F.when(c.isin(*NULL_TOKENS), F.lit(None)).otherwise(c)


def first_nonempty(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(""))


def full_name(first: Column, last: Column, *, strict: bool = False) -> Column:
    """Join two name parts; null when none is given (strict: when one is missing)."""
    has_first = F.coalesce(first, F.lit("")) != ""
    has_last = F.coalesce(last, F.lit("")) != ""
    if strict:
        return F.when(has_first & has_last, F.concat_ws(" ", first, last))
    return F.when(has_first | has_last, strip(F.concat_ws(" ", first, last)))


def float_text(c: Column) -> Column:
    """Shortest text of a double, positional between 1e-4 and 1e16.

    A plain cast prints ``1.0E7``; amounts and ids must read ``10000000.0``. Values that
    the cast prints well take that way alone; the others go through a lambda, whose
    expressions stay out of the generated code: inlined for every column of a wide table
    they made methods too large to compile.
    """
    size = F.abs(c)
    plain = ((size >= 1e-3) & (size < 1e7)) | (size == 0)
    return F.when(plain, c.cast("string")).otherwise(F.get(F.transform(F.array(c), _rare_float_text), F.lit(0)))


def _rare_float_text(c: Column) -> Column:
    """The text of doubles below 1e-3 or from 1e7 on, and of those that are no number."""
    size = F.abs(c)
    positional = F.regexp_replace(c.try_cast("decimal(38,21)").cast("string"), r"^(-?\d+\.(?:\d*[1-9]|0))0*$", "$1")
    signed = F.replace(F.regexp_replace(c.cast("string"), r"(\.0)?E", "e+"), F.lit("e+-"), F.lit("e-"))
    two_digits = F.regexp_replace(signed, r"e([+-])(\d)$", "e$10$2")
    scientific = F.replace(F.replace(two_digits, F.lit("NaN"), F.lit("nan")), F.lit("Infinity"), F.lit("inf"))
    return F.when((size >= 1e-4) & (size < 1e16), positional).otherwise(scientific)


def as_text(c: Column, dtype: T.DataType) -> Column:
    """Text of any value: JSON for nested data, shortest decimal for floats."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    if isinstance(dtype, T.FloatType):
        return float_text(c.cast("string").cast("double"))
    if isinstance(dtype, T.DoubleType):
        return float_text(c)
    return c.cast("string")


def canonical_amount(text: Column) -> Column:
    """Trimmed amount text without one trailing ``.0``; blank is null."""
    return blank_to_null(F.regexp_replace(strip(text), r"\.0$", ""))


def norm_label(c: Column) -> Column:
    """Label key: underscores and spaces removed, lower case."""
    return F.lower(F.translate(F.coalesce(c, F.lit("")), "_ ", ""))


def clean_name(c: Column) -> Column:
    """Column-level form of :func:`tidemark.operators.normalize.loader_name`."""
    flat = F.translate(F.replace(c, F.lit("$"), F.lit("")), "-. ", "___")
    return F.when(flat.rlike("^[0-9]"), F.concat(F.lit("_"), flat)).otherwise(flat)


def change_reasons(reasons: Sequence[tuple[str, Column]]) -> Column:
    """``"A and B"`` for the reasons whose condition holds, empty when none does."""
    return F.concat_ws(" and ", *[F.when(test, F.lit(text)) for text, test in reasons])


def action_id(run_id: str, key: Column, kind: Column) -> Column:
    """Stable id of one logged change: a retried task or a repeated run makes it again."""
    parts = F.concat_ws("\x1f", F.lit(run_id), key, kind)
    return F.concat(F.lit("A"), F.sha2(parts, 256))


def any_of(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
