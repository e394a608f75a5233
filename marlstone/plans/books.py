"""Books: clean snapshot, author dimension, book-author bridge and shelves."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from marlstone import fixed_values as fixed
from marlstone.functions.cleaning import clean_text, default_blank, safe_cast, stamp
from marlstone.functions.kinds import by_kind
from marlstone.functions.labels import canonicalise
from marlstone.operators.dedupe import dedupe, dedupe_repeated
from marlstone.operators.features import label_totals
from marlstone.operators.rows import clean, explode_structs, require
from marlstone.streaming.ingest import LOADED_AT

BOOK_KINDS = {
    "book_id": "plain",
    "title": "text",
    "title_without_series": "text",
    "average_rating": "float",
    "ratings_count": "int",
    "text_reviews_count": "int",
    "language_code": "upper",
    "num_pages": "int",
    "publication_year": "int",
    "publication_month": "int",
    "publisher": "text",
    "format": "text",
    "description": "text",
    "isbn": "plain",
    "isbn13": "plain",
    "country_code": "plain",
    "is_ebook": "flag",
}


def with_load_time(raw: DataFrame, columns) -> DataFrame:
    """The wanted raw columns, and the load time where the table has one."""
    return raw.select(*columns, *[c for c in (LOADED_AT,) if c in raw.columns])


def valid_books(raw: DataFrame) -> DataFrame:
    low, high = fixed.BOOK_RATING_RANGE
    return require(with_load_time(raw, BOOK_KINDS), "book_id", "title").filter(
        safe_cast("average_rating", "float").between(low, high)
        & (safe_cast("ratings_count", "int") > 0)
    )


def staging_books(raw: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """One clean row per valid book. Repeats go before the text is cleaned, not after."""
    cleaned = clean(dedupe(valid_books(raw), ["book_id"]), by_kind(BOOK_KINDS))
    return cleaned.withColumns({"last_updated_at": stamp(now), "_staging_timestamp": stamp(now)})


def book_author_rows(raw: DataFrame) -> DataFrame:
    """book_id, author_id, role: one row per listed author with an id."""
    listed = explode_structs(
        with_load_time(raw, ["book_id", "authors"]),
        "authors",
        {"author_id": "author_id", "role": "role"},
        keep=[c for c in ("book_id", LOADED_AT) if c in raw.columns],
    )
    return require(
        listed.withColumns(
            {
                "book_id": F.col("book_id").cast("string"),
                "author_id": F.col("author_id").cast("string"),
                "role": default_blank("role", fixed.DEFAULT_ROLE),
            }
        ),
        "author_id",
        blank=False,
    )


def author_versions(raw: DataFrame) -> DataFrame:
    """One row per author, the role as loaded last: the source of the author dimension."""
    rows = book_author_rows(raw).drop("book_id")
    return dedupe_repeated(rows, ["author_id"], LOADED_AT).select("author_id", "role")


def bridge_book_authors(raw: DataFrame) -> DataFrame:
    """One row per book and author."""
    rows = require(book_author_rows(raw), "book_id")
    return dedupe(rows, ["book_id", "author_id"]).select("book_id", "author_id", "role")


def shelf_rows(raw: DataFrame, dedupe_books: bool = True) -> DataFrame:
    """book_id, shelf_name, shelf_count with synonyms folded, shelves without readers dropped.

    With `dedupe_books` only the delivery of a book loaded last counts; without it shelf
    counts of a book delivered twice add up.
    """
    books = require(with_load_time(raw, ["book_id", "popular_shelves"]), "book_id")
    if dedupe_books:
        books = dedupe(books, ["book_id"])
    shelves = explode_structs(
        books, "popular_shelves", {"name": "_name", "count": "_count"}, keep=["book_id"]
    )
    typed = shelves.select(
        F.col("book_id").cast("string").alias("book_id"),
        clean_text("_name", "lower").alias("_name"),
        safe_cast("_count", "int").alias("shelf_count"),
    )
    return require(typed.filter(F.col("shelf_count") > 0), "_name").select(
        "book_id", canonicalise("_name").alias("shelf_name"), "shelf_count"
    )


def dim_shelves(raw: DataFrame, dedupe_books: bool = True) -> DataFrame:
    rows = shelf_rows(raw, dedupe_books)
    return label_totals(rows, ["book_id", "shelf_name"], "shelf_count", "shelf_count")


def top_shelves(shelves: DataFrame, n: int = 10) -> DataFrame:
    """Shelves by total count; equal totals go by name."""
    totals = label_totals(shelves, ["shelf_name"], "shelf_count", "total")
    return totals.orderBy(F.col("total").desc(), "shelf_name").limit(n)
