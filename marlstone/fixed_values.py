"""Values fixed by the published tables' definition.

Fixed values: results only agree when these are exactly as written, so they are
kept together here as plain text and passed to the operators as defaults.
"""

from __future__ import annotations

import datetime as dt

# Open end of a validity interval, and the span of the calendar dimension.
OPEN_END = dt.date(9999, 12, 31)
CALENDAR_START = dt.date(1990, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)

# Accepted ranges and rating thresholds, both ends included.
BOOK_RATING_RANGE = (0.0, 5.0)
REVIEW_RATING_RANGE = (1, 5)
POSITIVE_FROM = 4
NEGATIVE_UP_TO = 2

# Author role used when the source leaves it blank.
DEFAULT_ROLE = "Author"

# Shelf synonyms in priority order: the first group holding a word wins
# ("to-buy" is listed twice, so it counts as "to-read").
SHELF_GROUPS = (
    (
        "to-read",
        (
            "to-read", "want-to-read", "watchlist", "wish-list", "to-buy", "next-to-read",
            "tbr", "my-to-read", "to-read-fiction", "want-to-buy", "to-read-soon",
        ),
    ),
    (
        "currently-reading",
        (
            "currently-reading", "reading", "in-progress", "currently-reading-2023",
            "now-reading", "currently",
        ),
    ),
    (
        "read",
        (
            "read", "already-read", "finished", "books-read", "have-read", "read-2023",
            "read-books", "done",
        ),
    ),
    (
        "favorites",
        ("favorites", "favourite", "favourites", "faves", "all-time-favorites", "my-favorites"),
    ),
    ("owned", ("owned", "own-it", "i-own", "owned-books", "to-buy", "my-library")),
)

# Shelves that become feature columns.
SHELF_SIGNALS = {
    "to-read": "to_read_count",
    "currently-reading": "currently_reading_count",
    "read": "shelf_read_count",
}

# Popularity blend: rating, log of rating volume, log demand, positive share.
RATING_WEIGHT = 0.4
VOLUME_WEIGHT = 0.2
DEMAND_WEIGHT = 0.25
SENTIMENT_WEIGHT = 0.15

# Priority rules in order: fewest pages, most pages, lowest rating, label.
PRIORITY_RULES = ((50, 400, 4.0, "High"), (50, 600, 3.5, "Medium"))
PRIORITY_OTHERWISE = "Low"

# Columns whose change opens a new version of a dimension row.
BOOK_TRACKED = (
    "average_rating", "ratings_count", "text_reviews_count", "num_pages", "publisher", "format",
)
AUTHOR_TRACKED = ("role",)

# Columns a newer interaction overwrites; the others keep the stored value.
INTERACTION_UPDATES = (
    "review_id", "is_read", "rating", "date_updated", "read_at", "started_at", "has_review",
    "last_updated_at",
)

# Column order of the two gold products, before the version columns.
PRIORITY_COLUMNS = (
    "book_id", "title", "author_ids", "language_code", "publication_year", "num_pages", "format",
    "is_ebook", "average_rating", "ratings_count", "total_reviews", "positive_reviews",
    "negative_reviews", "avg_review_rating", "positive_review_pct", "to_read_count",
    "currently_reading_count", "shelf_read_count", "total_read", "total_interactions",
    "demand_score", "popularity_score", "audiobook_priority",
)
FEATURE_COLUMNS = (
    "book_id", "title", "description", "language_code", "num_pages", "publication_year",
    "publication_month", "is_ebook", "format", "average_rating", "ratings_count",
    "text_reviews_count", "total_reviews", "positive_reviews", "negative_reviews",
    "avg_review_rating", "positive_review_pct", "avg_votes", "to_read_count",
    "currently_reading_count", "shelf_read_count", "total_read", "total_interactions",
    "avg_interaction_rating", "popularity_score",
)

TOP_TITLE_COLUMNS = (
    "title", "author_ids", "average_rating", "positive_review_pct", "to_read_count",
    "popularity_score", "audiobook_priority",
)

# How each silver table is loaded, as its summary says.
STRATEGIES = {
    "dim_books": "SCD Type 2",
    "dim_authors": "SCD Type 2",
    "dim_shelves": "Overwrite",
    "bridge_book_authors": "Overwrite",
    "reviews": "Append only",
    "interactions": "Merge",
}

# Routing: the catch-all type, then the first keyword found in the file name.
WHOLE_SET_TYPE = "complete"
NAME_KEYWORDS = ("books", "reviews", "interactions")
