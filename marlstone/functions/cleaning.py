"""Safe typing and text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_cast(col: str | Column, data_type: str) -> Column:
    """Cast that gives NULL for text that does not parse, in ANSI mode too."""
    return as_column(col).try_cast(data_type)


def clean_text(col: str | Column, case: str | None = None) -> Column:
    """Trim, and fold to 'upper' or 'lower' on request. Blank text stays blank, not NULL."""
    trimmed = F.trim(as_column(col).cast("string"))
    if case is None:
        return trimmed
    return {"upper": F.upper, "lower": F.lower}[case](trimmed)


def flag(col: str | Column) -> Column:
    """'true' / 'false' in any case, or a boolean, as 1 / 0; anything else is NULL."""
    word = F.lower(as_column(col).cast("string"))
    return F.when(word == "true", 1).when(word == "false", 0).cast("int")


def default_blank(col: str | Column, default: str) -> Column:
    """Trimmed text, with `default` for NULL or blank."""
    return F.coalesce(F.nullif(F.trim(as_column(col)), F.lit("")), F.lit(default))


def null_if(col: str | Column, sentinel) -> Column:
    return F.nullif(as_column(col), F.lit(sentinel))


def present(col: str | Column, blank: bool = True) -> Column:
    """1 when the value is there, else 0. With blank=False an empty text counts as absent."""
    value = as_column(col)
    there = value.isNotNull() if blank else F.coalesce(F.trim(value) != "", F.lit(False))
    return there.cast("int")


def at_least(col: str | Column, bound) -> Column:
    return F.coalesce(as_column(col) >= bound, F.lit(False)).cast("int")


def at_most(col: str | Column, bound) -> Column:
    return F.coalesce(as_column(col) <= bound, F.lit(False)).cast("int")


def pseudonymise(col: str | Column, salt: str | None = None) -> Column:
    """SHA-256 hex of the id as text; NULL stays NULL.

    Without a salt small id ranges can be reversed by trying them all.
    """
    text = as_column(col).cast("string")
    return F.sha2(text if salt is None else F.concat(F.lit(salt), text), 256)


def megabytes(col: str | Column, digits: int = 2) -> Column:
    return F.round(as_column(col) / F.lit(1024 * 1024), digits)


def stamp(now=None) -> Column:
    """The run's time: the one given, or the query's own."""
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
