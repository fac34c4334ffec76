"""Tolerant text-to-typed expressions. Bad text becomes NULL, never an error.

The text conversions take a column name (or SQL expression) and are one parsed expression each,
which keeps building a projection of many columns cheap on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_long(text: str) -> Column:
    """Whole number from text; decimals round half away from zero.

    The decimal detour runs only for text that is not a plain integer, so 19-digit
    identifiers stay exact and the usual case is one parse.
    """
    rounded = f"round(try_cast({text} AS decimal(38,10)))"
    return F.expr(f"coalesce(try_cast({text} AS bigint), try_cast({rounded} AS bigint))")


def strict_long(text: str) -> Column:
    """Whole number from text; bad text fails the job (ANSI cast)."""
    return F.expr(f"cast({text} AS bigint)")


def try_double(text: str) -> Column:
    """Finite number from text. Java-only spellings (``5d``, ``NaN``, hex) are refused."""
    ends_plain = f"right(trim({text}), 1) IN ('0','1','2','3','4','5','6','7','8','9','.')"
    finite = f"abs(try_cast({text} AS double)) <= 1.7976931348623157E308D"
    return F.expr(
        f"CASE WHEN {ends_plain} AND instr(lower({text}), 'x') = 0 AND {finite} THEN try_cast({text} AS double) END"
    )


def currency(text: str) -> Column:
    """``$1,234.50`` to 1234.5."""
    return try_double(f"replace(replace({text}, '$', ''), ',', '')")


def percent(text: str) -> Column:
    """``95%`` to 95.0."""
    return try_double(f"replace({text}, '%', '')")


def equals_flag(text: str, literal: str) -> Column:
    """TRUE on equality; FALSE otherwise, also for NULL."""
    return F.coalesce(F.expr(text) == literal, F.lit(False))


def flag(text: str) -> Column:
    """``t``/``f`` text to a boolean that is never NULL."""
    return F.expr(f"coalesce({text} = 't', false)")


def above_flag(number: Column, threshold: float) -> Column:
    """TRUE above the threshold; FALSE otherwise, also for NULL."""
    return F.coalesce(number > threshold, F.lit(False))


def bucket_below(number: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose threshold lies above the number; NULL takes ``otherwise``."""
    (bound, label), *rest = steps
    out = F.when(number < bound, label)
    for bound, label in rest:
        out = out.when(number < bound, label)
    return out.otherwise(otherwise)


def bucket_at_least(number: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose threshold the number reaches; NULL takes ``otherwise``."""
    (bound, label), *rest = steps
    out = F.when(number >= bound, label)
    for bound, label in rest:
        out = out.when(number >= bound, label)
    return out.otherwise(otherwise)


def null_tokens(text: str, tokens: Sequence[str]) -> Column:
    """NULL for text that is one of the tokens."""
    listed = ", ".join("'" + token.replace("'", "\\'") + "'" for token in tokens)
    return F.expr(f"CASE WHEN {text} NOT IN ({listed}) THEN {text} END")
