"""The same results in DuckDB SQL over the given tables, written independently of the operators."""

from __future__ import annotations

import re


def rounded(value: str, digits: int) -> str:
    """Decimal rounding, half up, as Spark rounds doubles."""
    return f"round(cast({value} AS decimal(18, 10)), {digits})::double"


def epoch(text: str) -> str:
    return f"cast(epoch(try_strptime({text}, '%a %b %d %H:%M:%S %z %Y')) AS bigint)"


def day_key(text: str) -> str:
    return f"strftime(make_timestamp({epoch(text)} * 1000000), '%Y%m%d')"


def site_date(ts: str, offset: str) -> str:
    return f"strftime({ts}, '%a %b %d %H:%M:%S {offset} %Y')"


def tri_state(col: str) -> str:
    return f"CASE lower({col}) WHEN 'true' THEN 1 WHEN 'false' THEN 0 END"


# Fixed values, written out here a second time: a wrong word in the operators must not pass.
SHELF_WORDS = (
    ("to-read", ["to-read", "want-to-read", "watchlist", "wish-list", "to-buy", "next-to-read",
                 "tbr", "my-to-read", "to-read-fiction", "want-to-buy", "to-read-soon"]),
    ("currently-reading", ["currently-reading", "reading", "in-progress",
                           "currently-reading-2023", "now-reading", "currently"]),
    ("read", ["read", "already-read", "finished", "books-read", "have-read", "read-2023",
              "read-books", "done"]),
    ("favorites", ["favorites", "favourite", "favourites", "faves", "all-time-favorites",
                   "my-favorites"]),
    ("owned", ["owned", "own-it", "i-own", "owned-books", "to-buy", "my-library"]),
)
PRIORITY_LIST = (
    "book_id, title, author_ids, language_code, publication_year, num_pages, format, is_ebook, "
    "average_rating, ratings_count, total_reviews, positive_reviews, negative_reviews, "
    "avg_review_rating, positive_review_pct, to_read_count, currently_reading_count, "
    "shelf_read_count, total_read, total_interactions, demand_score, popularity_score, "
    "audiobook_priority"
)
FEATURE_LIST = (
    "book_id, title, description, language_code, num_pages, publication_year, "
    "publication_month, is_ebook, format, average_rating, ratings_count, text_reviews_count, "
    "total_reviews, positive_reviews, negative_reviews, avg_review_rating, positive_review_pct, "
    "avg_votes, to_read_count, currently_reading_count, shelf_read_count, total_read, "
    "total_interactions, avg_interaction_rating, popularity_score"
)


def shelf_label(col: str) -> str:
    cases = " ".join(
        f"WHEN {col} IN ({', '.join(repr(w) for w in words)}) THEN '{label}'"
        for label, words in SHELF_WORDS
    )
    return f"CASE {cases} ELSE {col} END"


def score(demand: str) -> str:
    blend = (
        f"average_rating * 0.4::double + ln(1 + ratings_count) * 0.2::double"
        f" + {demand} * 0.25::double + positive_review_pct / 100 * 0.15::double"
    )
    return rounded(blend, 3)


REVIEW_DATE = site_date("l_shipdate", "-0700")
EVENT_DATE = site_date("ts", "+0000")
EVENT_BOOK = (
    "cast(1 + (user_id * 20 + cast(json_extract_string(props, '$.k') AS integer) % 20)"
    " % (SELECT max(p_partkey) FROM part) AS varchar)"
)

PARTS: dict[str, str] = {
    "raw_books": """
        SELECT cast(p_partkey AS varchar) AS book_id, ' ' || p_name || ' ' AS title,
            p_type || ' ' AS title_without_series,
            CASE WHEN p_partkey % 11 = 0 THEN 'n/a'
                ELSE cast(cast(p_partkey * 37 % 51 AS double) / 10 AS varchar) END AS average_rating,
            cast(p_partkey % 500 + delivery AS varchar) AS ratings_count,
            cast(p_partkey % 97 AS varchar) AS text_reviews_count,
            CASE WHEN p_size % 4 = 0 THEN ' en-us' ELSE 'eng ' END AS language_code,
            cast(p_size * 15 AS varchar) AS num_pages,
            cast(1950 + p_partkey % 70 AS varchar) AS publication_year,
            CASE WHEN p_size % 7 = 0 THEN '' ELSE cast(1 + p_size % 12 AS varchar) END
                AS publication_month,
            p_brand AS publisher, p_type AS format, p_name || '. ' || p_type AS description,
            cast(100000 + p_partkey AS varchar) AS isbn, '978' || p_partkey AS isbn13,
            'US' AS country_code,
            CASE p_size % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'false' END AS is_ebook, delivery
        FROM (SELECT *, unnest(CASE WHEN p_partkey % 5 = 0 THEN [0, 1] ELSE [0] END) AS delivery
              FROM part)""",
    "typed_books": f"""
        SELECT book_id, trim(title) AS title, trim(title_without_series) AS title_without_series,
            try_cast(average_rating AS float) AS average_rating,
            try_cast(ratings_count AS integer) AS ratings_count,
            try_cast(text_reviews_count AS integer) AS text_reviews_count,
            upper(trim(language_code)) AS language_code, try_cast(num_pages AS integer) AS num_pages,
            try_cast(publication_year AS integer) AS publication_year,
            try_cast(publication_month AS integer) AS publication_month,
            trim(publisher) AS publisher, trim(format) AS format, trim(description) AS description,
            isbn, isbn13, country_code, {tri_state("is_ebook")} AS is_ebook, delivery
        FROM raw_books""",
    "clean_books": """
        SELECT * EXCLUDE (delivery) FROM typed_books
        WHERE book_id IS NOT NULL AND title IS NOT NULL
            AND average_rating BETWEEN 0 AND 5 AND ratings_count > 0
        QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY delivery DESC) = 1""",
    "raw_reviews": f"""
        SELECT l_orderkey || '-' || l_linenumber AS review_id, cast(l_partkey AS varchar) AS book_id,
            cast(l_suppkey AS varchar) AS user_id, cast(l_linenumber % 6 AS integer) AS rating,
            l_returnflag || '/' || l_linestatus AS review_text,
            cast(cast(l_quantity AS integer) AS varchar) AS n_votes,
            cast(l_linenumber AS varchar) AS n_comments,
            {REVIEW_DATE} AS date_added, {REVIEW_DATE} AS date_updated,
            CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE {REVIEW_DATE} END AS read_at,
            CASE WHEN l_linenumber % 3 = 0 THEN 'garbage' END AS started_at, l_shipdate
        FROM lineitem""",
    "kept_reviews": """
        SELECT * FROM raw_reviews WHERE rating BETWEEN 1 AND 5
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY l_shipdate DESC, book_id DESC,
            user_id DESC, rating DESC, review_text DESC, n_votes DESC) = 1""",
    "clean_reviews": f"""
        SELECT review_id, book_id, sha256(user_id) AS user_id, rating, review_text,
            cast(n_votes AS integer) AS n_votes, cast(n_comments AS integer) AS n_comments,
            {epoch("date_added")} AS date_added, {epoch("date_updated")} AS date_updated,
            {epoch("read_at")} AS read_at, {epoch("started_at")} AS started_at,
            CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS is_positive,
            CASE WHEN rating <= 2 THEN 1 ELSE 0 END AS is_negative,
            {day_key("date_added")} AS date_id
        FROM kept_reviews""",
    "raw_interactions": f"""
        SELECT CASE WHEN event_id % 29 <> 0 THEN cast(user_id AS varchar) END AS user_id,
            {EVENT_BOOK} AS book_id,
            CASE WHEN event_id % 3 <> 0 THEN cast(event_id AS varchar) END AS review_id,
            CASE WHEN value > 50 THEN 'True' WHEN value > 10 THEN 'false' END AS is_read,
            cast(event_id % 6 AS varchar) AS rating, {EVENT_DATE} AS date_added,
            CASE WHEN event_id % 17 = 0 THEN '' ELSE {EVENT_DATE} END AS date_updated,
            '' AS read_at, cast(NULL AS varchar) AS started_at
        FROM events""",
    "clean_interactions": f"""
        SELECT sha256(user_id) AS user_id, book_id, review_id, {tri_state("is_read")} AS is_read,
            nullif(cast(rating AS integer), 0) AS rating, {epoch("date_added")} AS date_added,
            {epoch("date_updated")} AS date_updated, {epoch("read_at")} AS read_at,
            {epoch("started_at")} AS started_at,
            CASE WHEN review_id IS NOT NULL THEN 1 ELSE 0 END AS has_review,
            {day_key("date_added")} AS date_id, {epoch("date_updated")} AS last_updated_at
        FROM (SELECT * FROM raw_interactions WHERE user_id IS NOT NULL AND book_id IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY user_id, book_id
                  ORDER BY {epoch("date_updated")} DESC NULLS LAST, review_id DESC NULLS LAST,
                  is_read DESC NULLS LAST, rating DESC, date_added DESC) = 1)""",
    "deliveries": """
        SELECT cast(l_partkey AS varchar) AS book_id,
            CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 17 = 0 THEN []
                ELSE [
                {'author_id': cast(l_suppkey AS varchar), 'role': CASE l_returnflag
                    WHEN 'A' THEN ' Author ' WHEN 'N' THEN '' ELSE 'Illustrator' END},
                {'author_id': CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 5 THEN ''
                    ELSE cast(l_suppkey + l_linenumber AS varchar) END,
                 'role': cast(NULL AS varchar)}] END AS authors,
            CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE [
                {'name': CASE l_orderkey % 6 WHEN 0 THEN ' Want-To-Read' WHEN 1 THEN 'tbr'
                    WHEN 2 THEN 'reading' WHEN 3 THEN 'Finished ' WHEN 4 THEN 'sci-fi' END,
                 'n': cast(l_quantity AS integer)},
                {'name': CASE l_linenumber % 4 WHEN 0 THEN 'to-buy' WHEN 1 THEN 'Favourites'
                    WHEN 2 THEN 'my-library' ELSE 'poetry' END,
                 'n': cast(l_linenumber - 2 AS integer)}] END AS shelves,
            l_shipdate + to_microseconds(l_orderkey * 10 + l_linenumber) AS loaded
        FROM lineitem""",
    "author_rows": """
        SELECT book_id, a.author_id AS author_id,
            coalesce(nullif(trim(a.role), ''), 'Author') AS role, loaded
        FROM (SELECT book_id, loaded, unnest(authors) AS a FROM deliveries)
        WHERE a.author_id IS NOT NULL AND a.author_id <> ''""",
    "author_versions": """
        SELECT author_id, role FROM author_rows
        QUALIFY row_number() OVER (PARTITION BY author_id ORDER BY loaded DESC, role DESC) = 1""",
    "early_authors": """
        SELECT author_id, role FROM author_rows WHERE loaded < timestamp '1999-01-01'
        QUALIFY row_number() OVER (PARTITION BY author_id ORDER BY loaded DESC, role DESC) = 1""",
    "bridge": """
        SELECT book_id, author_id, role FROM author_rows
        QUALIFY row_number() OVER (PARTITION BY book_id, author_id
            ORDER BY loaded DESC, role DESC) = 1""",
    "author_ids": """
        SELECT book_id, string_agg(author_id, ', ' ORDER BY author_id) AS author_ids
        FROM bridge WHERE role = 'Author' GROUP BY book_id""",
    "last_deliveries": """
        SELECT * FROM deliveries
        QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY loaded DESC) = 1""",
    "shelves": f"""
        SELECT book_id, {shelf_label("shelf")} AS shelf_name, cast(sum(n) AS bigint) AS shelf_count
        FROM (SELECT book_id, lower(trim(s.name)) AS shelf, s.n AS n
              FROM (SELECT book_id, unnest(shelves) AS s FROM deliveries))
        WHERE shelf IS NOT NULL AND n > 0 GROUP BY ALL""",
    "last_shelves": f"""
        SELECT book_id, {shelf_label("shelf")} AS shelf_name, cast(sum(n) AS bigint) AS shelf_count
        FROM (SELECT book_id, lower(trim(s.name)) AS shelf, s.n AS n
              FROM (SELECT book_id, unnest(shelves) AS s FROM last_deliveries))
        WHERE shelf IS NOT NULL AND n > 0 GROUP BY ALL""",
    "signals": """
        SELECT book_id, max(CASE WHEN shelf_name = 'to-read' THEN shelf_count END) AS to_read_count,
            max(CASE WHEN shelf_name = 'currently-reading' THEN shelf_count END)
                AS currently_reading_count,
            max(CASE WHEN shelf_name = 'read' THEN shelf_count END) AS shelf_read_count
        FROM shelves WHERE shelf_name IN ('to-read', 'currently-reading', 'read')
        GROUP BY book_id""",
    "review_features": f"""
        SELECT book_id, count(*) AS total_reviews, {rounded("avg(rating)", 2)} AS avg_review_rating,
            count(*) FILTER (rating >= 4) AS positive_reviews,
            count(*) FILTER (rating <= 2) AS negative_reviews,
            {rounded("avg(cast(n_votes AS integer))", 2)} AS avg_votes
        FROM kept_reviews GROUP BY book_id""",
    "interaction_features": f"""
        SELECT book_id, count(*) AS total_interactions, cast(sum(is_read) AS bigint) AS total_read,
            cast(sum(has_review) AS bigint) AS total_reviewed,
            {rounded("avg(rating)", 2)} AS avg_interaction_rating
        FROM clean_interactions GROUP BY book_id""",
    "wide": f"""
        SELECT *, CASE WHEN total_reviews > 0
            THEN {rounded("positive_reviews / total_reviews * 100", 1)} ELSE 0.0::double END
            AS positive_review_pct
        FROM clean_books LEFT JOIN review_features USING (book_id)
            LEFT JOIN interaction_features USING (book_id) LEFT JOIN signals USING (book_id)
            LEFT JOIN author_ids USING (book_id)""",
    "priorities": f"""
        SELECT *, {rounded("ln(1 + coalesce(to_read_count, 0))", 3)} AS demand_score,
            {score("demand_score")} AS popularity_score,
            CASE WHEN num_pages BETWEEN 50 AND 400 AND average_rating >= 4.0::float THEN 'High'
                WHEN num_pages BETWEEN 50 AND 600 AND average_rating >= 3.5::float THEN 'Medium'
                ELSE 'Low' END AS audiobook_priority
        FROM wide""",
    "features": f"""
        SELECT *, {score("ln(1 + coalesce(to_read_count, 0))")} AS popularity_score FROM wide""",
    "stored_parts": """
        SELECT p_partkey AS book_id, p_name AS title, p_brand AS publisher,
            CASE WHEN p_partkey % 13 <> 0 THEN p_size END AS num_pages, true AS is_current,
            date '2024-01-01' AS valid_from, date '9999-12-31' AS valid_to
        FROM part WHERE p_partkey % 10 <> 9""",
    "older_parts": """
        SELECT p_partkey AS book_id, p_name AS title, p_brand AS publisher, p_size + 7 AS num_pages,
            false AS is_current, date '2023-06-01' AS valid_from, date '2023-12-31' AS valid_to
        FROM part WHERE p_partkey % 10 = 3""",
    "offered_parts": """
        SELECT p_partkey AS book_id, p_name AS title,
            CASE WHEN p_partkey % 17 = 0 THEN 'Brand#X' ELSE p_brand END AS publisher,
            CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN p_size + 1
                ELSE p_size END AS num_pages
        FROM part""",
    "incoming_parts": "SELECT * FROM offered_parts WHERE book_id % 10 <> 8",
    "changed_parts": """
        SELECT s.book_id FROM incoming_parts s JOIN stored_parts t USING (book_id)
        WHERE s.num_pages <> t.num_pages OR s.publisher <> t.publisher""",
    "distinct_parts": """
        SELECT s.book_id FROM incoming_parts s JOIN stored_parts t USING (book_id)
        WHERE s.num_pages IS DISTINCT FROM t.num_pages
            OR s.publisher IS DISTINCT FROM t.publisher""",
    "events_of": f"""
        SELECT cast(user_id AS varchar) AS user_id, {EVENT_BOOK} AS book_id,
            CASE WHEN event_id % 3 <> 0 THEN cast(event_id AS varchar) END AS review_id,
            CASE WHEN value > 50 THEN 1 ELSE 0 END AS is_read,
            nullif(cast(event_id % 6 AS integer), 0) AS rating, ts AS date_added,
            CASE WHEN event_id % 17 <> 0 THEN ts END AS date_updated
        FROM events""",
    "merge_t": """
        SELECT * FROM events_of WHERE date_added < timestamp '2024-01-16'
        QUALIFY row_number() OVER (PARTITION BY user_id, book_id
            ORDER BY date_updated DESC NULLS LAST, date_added DESC) = 1""",
    "merge_s": """
        SELECT * FROM events_of WHERE date_added >= timestamp '2024-01-11'
        QUALIFY row_number() OVER (PARTITION BY user_id, book_id
            ORDER BY date_updated DESC NULLS LAST, date_added DESC) = 1""",
    "merge_both": """
        SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.book_id, s.book_id) AS book_id,
            t, s, t.user_id IS NULL AS fresh,
            t.user_id IS NULL OR (s.user_id IS NOT NULL AND (t.date_updated IS NULL
                OR coalesce(s.date_updated > t.date_updated, false))) AS newer
        FROM merge_t t FULL JOIN merge_s s ON t.user_id = s.user_id AND t.book_id = s.book_id""",
    "order_files": """
        SELECT CASE WHEN o_orderstatus = 'F' THEN 'complete' ELSE 'byGenre' END AS type,
            CASE o_orderkey % 4 WHEN 0 THEN 'books' WHEN 1 THEN 'reviews' WHEN 2 THEN 'interactions'
                ELSE 'reviews_of_books' END || '_' || o_orderkey || '.json.gz' AS name,
            o_orderkey * 1000 + o_custkey AS length, o_orderkey
        FROM orders""",
    "routed": """
        SELECT name, type,
            CASE type WHEN 'complete' THEN 'site/whole/' ELSE 'site/genre/' END || name AS url,
            CASE WHEN type = 'complete' THEN 'raw/complete/' WHEN name LIKE '%books%'
                THEN 'raw/books/' WHEN name LIKE '%reviews%' THEN 'raw/reviews/'
                ELSE 'raw/interactions/' END || name AS path, length
        FROM order_files""",
}


# What two daily runs leave. Loads are a day apart; within a day equal rows tie, and the rest of
# the columns decide. A review keeps its first day, an interaction its newest date.
PARTS |= {
    "two_day_books": """
        SELECT b.* EXCLUDE (ratings_count), try_cast(l.ratings_count AS integer) AS ratings_count
        FROM (SELECT * FROM typed_books WHERE delivery = 0) b JOIN (
            SELECT cast(l_partkey AS varchar) AS book_id,
                cast(l_partkey % 500 + l_linenumber % 2 AS varchar) AS ratings_count,
                l_shipdate >= timestamp '1999-01-01' AS late
            FROM lineitem) l USING (book_id)
        WHERE average_rating BETWEEN 0 AND 5 AND try_cast(l.ratings_count AS integer) > 0
        QUALIFY row_number() OVER (PARTITION BY book_id
            ORDER BY late DESC, l.ratings_count DESC) = 1""",
    "two_day_reviews": """
        SELECT *, l_shipdate >= timestamp '1999-01-01' AS late FROM raw_reviews
        WHERE rating BETWEEN 1 AND 5
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY late, book_id DESC,
            user_id DESC, rating DESC, review_text DESC, n_votes DESC, n_comments DESC,
            date_added DESC) = 1""",
    "day_interactions": f"""
        SELECT *, {epoch("date_added")} >= epoch(timestamp '2024-01-16') AS late
        FROM raw_interactions WHERE user_id IS NOT NULL AND book_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY user_id, book_id, late
            ORDER BY {epoch("date_updated")} DESC NULLS LAST, review_id DESC NULLS LAST,
            is_read DESC NULLS LAST, rating DESC, date_added DESC) = 1""",
    "two_day_interactions": f"""
        SELECT book_id, count(*) AS total_interactions, cast(sum(flag) AS bigint) AS total_read
        FROM (
            SELECT coalesce(t.book_id, s.book_id) AS book_id,
                CASE WHEN t.user_id IS NULL OR (s.user_id IS NOT NULL AND (
                        {epoch("t.date_updated")} IS NULL OR
                        coalesce({epoch("s.date_updated")} > {epoch("t.date_updated")}, false)))
                    THEN {tri_state("s.is_read")} ELSE {tri_state("t.is_read")} END AS flag
            FROM (SELECT * FROM day_interactions WHERE NOT late) t
            FULL JOIN (SELECT * FROM day_interactions WHERE late) s
                ON t.user_id = s.user_id AND t.book_id = s.book_id)
        GROUP BY book_id""",
    "two_day_features": f"""
        SELECT book_id, count(*) AS total_reviews, {rounded("avg(rating)", 2)} AS avg_review_rating,
            count(*) FILTER (rating >= 4) AS positive_reviews,
            count(*) FILTER (rating <= 2) AS negative_reviews
        FROM two_day_reviews GROUP BY book_id""",
    "two_day_bridge": """
        SELECT book_id, author_id, role, loaded >= timestamp '1999-01-01' AS late FROM author_rows
        QUALIFY row_number() OVER (PARTITION BY book_id, author_id
            ORDER BY late DESC, role DESC) = 1""",
    "two_day_authors": """
        SELECT book_id, string_agg(author_id, ', ' ORDER BY author_id) AS author_ids
        FROM two_day_bridge WHERE role = 'Author' GROUP BY book_id""",
    "two_day_deliveries": """
        SELECT * FROM deliveries
        QUALIFY row_number() OVER (PARTITION BY book_id
            ORDER BY loaded >= timestamp '1999-01-01' DESC, shelves IS NULL,
                cast(shelves[1].n AS varchar) DESC, shelves[1].name DESC NULLS LAST,
                cast(shelves[2].n AS varchar) DESC, shelves[2].name DESC) = 1""",
    "two_day_shelves": f"""
        SELECT book_id, {shelf_label("shelf")} AS shelf_name, cast(sum(n) AS bigint) AS shelf_count
        FROM (SELECT book_id, lower(trim(s.name)) AS shelf, s.n AS n
              FROM (SELECT book_id, unnest(shelves) AS s FROM two_day_deliveries))
        WHERE shelf IS NOT NULL AND n > 0 GROUP BY ALL""",
    "two_day_signals": PARTS["signals"].replace("FROM shelves", "FROM two_day_shelves"),
    "two_day_wide": f"""
        SELECT *, CASE WHEN total_reviews > 0
            THEN {rounded("positive_reviews / total_reviews * 100", 1)} ELSE 0.0::double END
            AS positive_review_pct
        FROM two_day_books LEFT JOIN two_day_features USING (book_id)
            LEFT JOIN two_day_interactions USING (book_id)
            LEFT JOIN two_day_signals USING (book_id)
            LEFT JOIN two_day_authors USING (book_id)""",
    "two_day_priorities": PARTS["priorities"].replace("FROM wide", "FROM two_day_wide"),
}


def sql(body: str) -> str:
    """`body` preceded by the named parts it needs, in the order they are defined."""

    def needs(text: str, found: set[str]) -> set[str]:
        for name in PARTS:
            if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                found.add(name)
                needs(PARTS[name], found)
        return found

    used = needs(body, set())
    steps = ",\n".join(f"{name} AS ({text})" for name, text in PARTS.items() if name in used)
    return f"WITH {steps}\n{body}" if steps else body


OPENED = "true AS is_current, date '2024-02-01' AS valid_from, date '9999-12-31' AS valid_to"


def second_day(changed: str) -> str:
    """Expire, then insert: the two-step form."""
    return f"""
        SELECT book_id, title, publisher, num_pages, false AS is_current, valid_from,
            date '2024-01-31' AS valid_to
        FROM stored_parts WHERE book_id IN (SELECT book_id FROM {changed})
        UNION ALL
        SELECT * FROM stored_parts WHERE book_id NOT IN (SELECT book_id FROM {changed})
        UNION ALL
        SELECT * FROM older_parts
        UNION ALL
        SELECT book_id, title, publisher, num_pages, {OPENED} FROM incoming_parts
        WHERE book_id NOT IN (SELECT book_id FROM stored_parts)
            OR book_id IN (SELECT book_id FROM {changed})"""


ORACLES: dict[str, str] = {
    "clean_books": sql("SELECT * FROM clean_books"),
    "parse_offset_timestamps": sql(
        f"""SELECT review_id, {epoch("date_added")} AS added, {epoch("read_at")} AS read,
            {epoch("started_at")} AS started, {day_key("date_added")} AS date_id
        FROM raw_reviews"""
    ),
    "pseudonymise_users": (
        "SELECT c_custkey, sha256(cast(c_custkey AS varchar)) AS user_id FROM customer"
    ),
    "sentiment_flags": sql(
        """SELECT review_id, book_id, cast(n_votes AS integer) AS n_votes, nullif(rating, 0) AS score,
            CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS is_positive,
            CASE WHEN rating <= 2 THEN 1 ELSE 0 END AS is_negative
        FROM raw_reviews"""
    ),
    "null_expectations": sql(
        """SELECT count(*) - count(book_id) AS book_id, count(*) - count(title) AS title,
            count(*) - count(average_rating) AS average_rating,
            count(*) - count(publication_month) AS publication_month,
            count(*) - count(is_ebook) AS is_ebook
        FROM typed_books"""
    ),
    "dedupe_reviews": sql("SELECT * FROM clean_reviews"),
    "latest_interactions": sql("SELECT * FROM clean_interactions"),
    "role_default": sql("SELECT book_id, author_id, role FROM author_rows"),
    "author_versions": sql("SELECT * FROM author_versions"),
    "bridge_item_authors": sql("SELECT * FROM bridge"),
    "author_list": sql("SELECT * FROM author_ids"),
    "canonical_shelves": sql("SELECT * FROM shelves"),
    "canonical_shelves_latest": sql("SELECT * FROM last_shelves"),
    "top_shelves": sql(
        """SELECT shelf_name, cast(sum(shelf_count) AS bigint) AS total FROM shelves
        GROUP BY shelf_name ORDER BY total DESC, shelf_name LIMIT 10"""
    ),
    "shelf_signals": sql("SELECT * FROM signals"),
    "calendar": """
        SELECT strftime(d, '%Y%m%d') AS date_id, d AS full_date, cast(year(d) AS integer) AS year,
            cast(month(d) AS integer) AS month, cast(day(d) AS integer) AS day,
            cast(quarter(d) AS integer) AS quarter, monthname(d) AS month_name,
            dayname(d) AS day_of_week
        FROM (SELECT cast(unnest(generate_series(first, last, interval 1 day)) AS date) AS d
              FROM (SELECT cast(min(o_orderdate) AS date)::timestamp AS first,
                  cast(max(o_orderdate) AS date)::timestamp AS last FROM orders))""",
    "orders_by_weekday": """
        SELECT cast(year(o_orderdate) AS integer) AS year,
            cast(quarter(o_orderdate) AS integer) AS quarter,
            monthname(o_orderdate) AS month_name, dayname(o_orderdate) AS day_of_week,
            count(*) AS orders, max(o_totalprice) AS largest
        FROM orders WHERE o_orderdate >= date '1990-01-01' AND o_orderdate < date '2031-01-01'
        GROUP BY ALL""",
    "reviews_agg": sql("SELECT * FROM review_features"),
    "interactions_agg": sql("SELECT * FROM interaction_features"),
    "scd2_first_load": sql(f"SELECT *, {OPENED} FROM offered_parts"),
    "scd2_second_day": sql(second_day("changed_parts")),
    "scd2_null_safe": sql(second_day("distinct_parts")),
    "scd2_current": sql(f"SELECT * FROM ({second_day('changed_parts')}) WHERE is_current"),
    "scd2_version_counts": sql(
        f"""SELECT count(*) AS total, count(*) FILTER (is_current) AS current,
            count(*) FILTER (NOT is_current) AS history
        FROM ({second_day("changed_parts")})"""
    ),
    "scd2_authors": sql(
        """SELECT e.author_id, e.role, e.role = v.role AS is_current, date '2024-01-01' AS valid_from,
            CASE WHEN e.role = v.role THEN date '9999-12-31' ELSE date '2024-01-31' END AS valid_to
        FROM early_authors e JOIN author_versions v USING (author_id)
        UNION ALL
        SELECT v.author_id, v.role, true, date '2024-02-01', date '9999-12-31'
        FROM author_versions v LEFT JOIN early_authors e USING (author_id)
        WHERE e.role IS DISTINCT FROM v.role"""
    ),
    "append_new_reviews": sql(
        """SELECT review_id, book_id, sha256(user_id) AS user_id, rating, review_text,
            cast(n_votes AS integer) AS n_votes
        FROM (
            (SELECT * FROM raw_reviews
             WHERE rating BETWEEN 1 AND 5 AND l_shipdate < timestamp '1999-01-01'
             QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY l_shipdate DESC,
                 book_id DESC, user_id DESC, rating DESC, review_text DESC, n_votes DESC) = 1)
            UNION ALL
            (SELECT * FROM kept_reviews k WHERE NOT EXISTS (
                SELECT 1 FROM raw_reviews r WHERE r.review_id = k.review_id
                    AND r.rating BETWEEN 1 AND 5 AND r.l_shipdate < timestamp '1999-01-01')))"""
    ),
    "summed_up_signals": sql(
        "SELECT * FROM review_features FULL JOIN interaction_features USING (book_id)"
    ),
    "merge_newest_interactions": sql(
        """SELECT user_id, book_id, CASE WHEN newer THEN s.review_id ELSE t.review_id END AS review_id,
            CASE WHEN newer THEN s.is_read ELSE t.is_read END AS is_read,
            CASE WHEN newer THEN s.rating ELSE t.rating END AS rating,
            strftime(CASE WHEN fresh THEN s.date_added ELSE t.date_added END,
                '%Y-%m-%d %H:%M:%S.%f') AS date_added,
            strftime(CASE WHEN newer THEN s.date_updated ELSE t.date_updated END,
                '%Y-%m-%d %H:%M:%S.%f') AS date_updated,
            CASE WHEN (CASE WHEN newer THEN s.review_id ELSE t.review_id END) IS NULL
                THEN 0 ELSE 1 END AS has_review,
            strftime(CASE WHEN newer THEN s.date_updated ELSE t.date_updated END,
                '%Y-%m-%d %H:%M:%S.%f') AS last_updated_at
        FROM merge_both"""
    ),
    "supersede_snapshot": """
        SELECT p_partkey AS book_id, p_size AS score, cast(NULL AS varchar) AS label,
            false AS is_current, date '2024-01-01' AS valid_from, date '2024-01-31' AS valid_to
        FROM part WHERE p_partkey % 3 <> 0
        UNION ALL
        SELECT p_partkey, p_size + 1, NULL, false, date '2024-02-01', date '2024-02-29' FROM part
        UNION ALL
        SELECT p_partkey, p_size + 2, p_brand, true, date '2024-03-01', date '9999-12-31'
        FROM part WHERE p_partkey % 4 <> 0""",
    "priority_product": sql(f"SELECT {PRIORITY_LIST}, {OPENED} FROM priorities"),
    "feature_product": sql(f"SELECT {FEATURE_LIST}, {OPENED} FROM features"),
    "top_priority": sql(
        """SELECT title, author_ids, average_rating, positive_review_pct, to_read_count,
            popularity_score, audiobook_priority
        FROM priorities WHERE audiobook_priority = 'High'
        ORDER BY popularity_score DESC, book_id LIMIT 10"""
    ),
    "catalogue_counts": sql("SELECT type, count(*) AS files FROM order_files GROUP BY type"),
    "route_files": sql("SELECT name, type, url, path FROM routed"),
    "manifest_job": sql("SELECT name, type, url, path FROM routed"),
    "pending_files": sql("SELECT path, name, type, url FROM routed WHERE length % 3 <> 0"),
    "file_status_summary": sql(
        f"""SELECT CASE WHEN length % 3 = 0 THEN 'skipped' ELSE 'pending' END AS status,
            count(*) AS count,
            {rounded("sum(CASE WHEN length % 3 = 0 THEN length / 1048576 ELSE 0 END)", 1)}
                AS total_mb
        FROM routed GROUP BY 1"""
    ),
    "read_catalogue": sql(
        "SELECT type, name FROM order_files WHERE o_orderkey % 10 NOT IN (3, 7)"
    ),
    "file_sizes": sql(
        f"""SELECT type, cast(sum(octet_length(encode(name)) + 1) AS bigint) AS bytes,
            {rounded("sum(octet_length(encode(name)) + 1) / 1048576", 2)} AS size_mb
        FROM order_files GROUP BY type"""
    ),
    "row_count_delta": """
        SELECT nullif(count(*) FILTER (ts <= timestamp '2024-01-29'), 0) AS yesterday,
            count(*) AS today,
            count(*) - nullif(count(*) FILTER (ts <= timestamp '2024-01-29'), 0) AS difference,
            CASE WHEN count(*) FILTER (ts <= timestamp '2024-01-29') = 0 THEN 'First load'
                ELSE 'Loaded' END AS status
        FROM events""",
    "read_as_of": """
        SELECT event_type, count(*) AS events FROM events
        WHERE ts <= timestamp '2024-01-20 12:00:00' GROUP BY event_type""",
    "layer_summary": sql(
        f"""SELECT 'dim_books' AS "table", count(*) AS "rows", count(*) FILTER (is_current) AS current,
            'SCD Type 2' AS strategy FROM ({second_day("changed_parts")})
        UNION ALL SELECT 'bridge_book_authors', count(*), count(*), 'Overwrite' FROM bridge
        UNION ALL SELECT 'reviews', count(*), count(*), 'Append only' FROM kept_reviews"""
    ),
    "published_table": """
        SELECT o_orderkey, o_orderstatus, o_totalprice,
            cast(CASE WHEN o_orderstatus = 'F' THEN 1 END AS integer) AS late
        FROM orders""",
    "versioned_table": sql(second_day("changed_parts")),
    "registered_table": sql(
        """SELECT (SELECT count(*) FROM stored_parts) + (SELECT count(*) FROM older_parts)
                + (SELECT count(*) FROM incoming_parts) AS total_rows,
            (SELECT count(*) FROM incoming_parts) AS current_rows"""
    ),
    "inferred_json": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "growing_types": """
        SELECT p_partkey,
            CASE p_partkey % 3 WHEN 2 THEN p_size || ' cm' WHEN 1 THEN p_size || '.5'
                ELSE cast(p_size AS varchar) END AS width,
            CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE p_size + 0.25 END::double AS depth,
            CASE WHEN p_partkey % 3 = 1 THEN p_size + 0.5 ELSE p_size END::double AS side,
            false AS rescued
        FROM part""",
    "promoted_fields": """
        SELECT p_partkey, p_name, cast(p_size AS bigint) AS size,
            CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS brand, p_type AS waiting_type,
            cast(NULL AS varchar) AS broken_line
        FROM part WHERE p_partkey % 10 <> 0
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, '{broken ' || p_partkey FROM part
        WHERE p_partkey % 10 = 0""",
    "waiting_fields_by_name": """
        SELECT 'OBJECT<' || string_agg(field || ': ' || kind, ', ' ORDER BY field) || '>' AS fields
        FROM (
            SELECT 'brand' AS field, 'STRING' AS kind FROM part WHERE p_partkey % 4 <> 0
                AND p_partkey % 10 <> 0
            UNION SELECT 'types', 'ARRAY<STRING>' FROM part WHERE p_partkey % 10 <> 0
            UNION SELECT 'what', 'OBJECT<size: BIGINT>' FROM part WHERE p_partkey % 10 <> 0)""",
    "rescued_by_day": """
        SELECT entity, date '2024-02-01' + cast(key % 2 AS integer) AS load_date,
            count(*) AS "rows", count(*) FILTER (broken) AS rescued
        FROM (
            SELECT 'books' AS entity, p_partkey AS key, p_partkey % 10 = 0 AS broken FROM part
            UNION ALL SELECT 'reviews', o_orderkey, o_orderkey % 7 = 0 FROM orders
            UNION ALL SELECT 'interactions', c_custkey, false FROM customer)
        GROUP BY ALL""",
    "monitored_feeds": """
        SELECT entity, nullif(count(*) FILTER (key % 2 = 0), 0) AS yesterday, count(*) AS today,
            count(*) - nullif(count(*) FILTER (key % 2 = 0), 0) AS difference, 'Loaded' AS status
        FROM (
            SELECT 'books' AS entity, p_partkey AS key FROM part
            UNION ALL SELECT 'reviews', o_orderkey FROM orders
            UNION ALL SELECT 'interactions', c_custkey FROM customer)
        GROUP BY entity""",
    "file_inventory": sql(
        f"""SELECT {rounded("sum(octet_length(encode(name)) + 1) / 1048576", 2)} AS size_mb,
            true AS named, true AS dated
        FROM order_files GROUP BY type"""
    ),
    "day_report": sql(
        """SELECT 'bronze_books' AS "table", unnest(['rows', 'rescued']) AS metric,
            unnest([(SELECT count(*) FROM lineitem), 0]) AS value
        UNION ALL SELECT 'bronze_reviews', unnest(['rows', 'rescued']),
            unnest([(SELECT count(*) FROM lineitem), 0])
        UNION ALL SELECT 'bronze_interactions', unnest(['rows', 'rescued']),
            unnest([(SELECT count(*) FROM events), 0])
        UNION ALL SELECT 'reviews', 'rows', count(*) FROM kept_reviews
        UNION ALL SELECT 'interactions', 'rows', count(*) FROM clean_interactions"""
    ),
    "live_silver": sql(
        """SELECT * FROM two_day_features FULL JOIN two_day_interactions USING (book_id)"""
    ),
    "lake_two_days": sql(
        f"""SELECT {PRIORITY_LIST}, true AS is_current, date '2024-02-02' AS valid_from,
            date '9999-12-31' AS valid_to
        FROM two_day_priorities"""
    ),
    "inventory_difference": """
        WITH line AS (
            SELECT cast(regexp_extract(p_brand, '([0-9]+)', 1) AS integer) AS brand,
                octet_length(encode(p_name)) + 1 AS bytes
            FROM part
        ), first AS (
            SELECT brand, cast(sum(bytes) AS bigint) AS n FROM line WHERE brand % 5 <> 0 GROUP BY brand
        ), second AS (
            SELECT brand, cast(sum(bytes + CASE WHEN brand % 3 = 0 THEN 5 ELSE 0 END) AS bigint) AS n
            FROM line WHERE brand % 7 <> 0 GROUP BY brand
        )
        SELECT 'brand=' || brand AS folder,
            CASE WHEN f.n IS NULL THEN 'new' WHEN s.n IS NULL THEN 'gone' ELSE 'changed' END AS change,
            f.n AS length_before, s.n AS length_now, coalesce(s.n, 0) - coalesce(f.n, 0) AS bytes_added
        FROM first f FULL JOIN second s USING (brand) WHERE f.n IS DISTINCT FROM s.n""",
    "bronze_row_delta": """
        SELECT nullif(count(*) FILTER (event_id % 5 <= 2), 0) AS yesterday, count(*) AS today,
            count(*) - nullif(count(*) FILTER (event_id % 5 <= 2), 0) AS difference,
            CASE WHEN count(*) FILTER (event_id % 5 <= 2) = 0 THEN 'First load' ELSE 'Loaded' END
                AS status
        FROM events""",
    "stream_ingest": """
        SELECT event_id, user_id, event_type, value,
            CASE WHEN event_id % 2 = 1 THEN 'late' END AS source, event_id % 7 AS known,
            CASE WHEN event_id % 2 = 1 THEN event_id % 5 END AS added,
            cast(NULL AS varchar) AS broken_line,
            CASE WHEN event_id % 2 = 1 THEN 'late' ELSE 'early' END AS wave, true AS dated
        FROM events
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{broken ' || event_id, 'broken', true
        FROM events WHERE event_id % 2 = 1 AND event_id % 101 = 0""",
}
ORACLES["append_to_stored_reviews"] = ORACLES["append_new_reviews"]
ORACLES["bucketed_signals"] = ORACLES["feature_product"]
ORACLES["clustered_top"] = ORACLES["top_priority"]
