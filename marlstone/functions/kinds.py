"""Column treatments by name, so a cleaning job is a table of column -> kind."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

from marlstone.functions import cleaning
from marlstone.functions.times import parse_offset_ts

KINDS: dict[str, Callable[[str], Column]] = {
    "plain": lambda c: F.col(c).cast("string"),
    "text": cleaning.clean_text,
    "upper": lambda c: cleaning.clean_text(c, "upper"),
    "int": lambda c: cleaning.safe_cast(c, "int"),
    "score": lambda c: cleaning.null_if(cleaning.safe_cast(c, "int"), 0),
    "float": lambda c: cleaning.safe_cast(c, "float"),
    "flag": cleaning.flag,
    "hashed": cleaning.pseudonymise,
    "time": parse_offset_ts,
}


def by_kind(kinds: Mapping[str, str]) -> dict[str, Column]:
    """A `rows.clean` spec from column -> kind."""
    return {name: KINDS[kind](name) for name, kind in kinds.items()}
