"""Raw inputs in the shape the jobs expect, drawn from the given tables by projection.

All are plain expressions over whole tables, dirty on purpose; `oracles.py` states the same
expressions in SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marlstone.functions.cleaning import present
from marlstone.operators.dedupe import latest_per_key
from marlstone.session import narrow_splits

AS_OF = dt.date(2024, 2, 1)
EARLIER = dt.date(2024, 1, 1)


AUTHORS = (
    "CASE WHEN l_orderkey % 13 = 0 THEN NULL"
    " WHEN l_orderkey % 17 = 0 THEN array()"
    " ELSE array("
    "named_struct('author_id', cast(l_suppkey AS string), 'role',"
    " CASE l_returnflag WHEN 'A' THEN ' Author ' WHEN 'N' THEN '' ELSE 'Illustrator' END),"
    "named_struct('author_id', CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 5 THEN ''"
    " ELSE cast(l_suppkey + l_linenumber AS string) END, 'role', cast(NULL AS string))"
    ") END AS authors"
)
SHELVES = (
    "CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE array("
    "named_struct('name', CASE l_orderkey % 6 WHEN 0 THEN ' Want-To-Read' WHEN 1 THEN 'tbr'"
    " WHEN 2 THEN 'reading' WHEN 3 THEN 'Finished ' WHEN 4 THEN 'sci-fi' END,"
    " 'count', cast(cast(l_quantity AS int) AS string)),"
    "named_struct('name', CASE l_linenumber % 4 WHEN 0 THEN 'to-buy' WHEN 1 THEN 'Favourites'"
    " WHEN 2 THEN 'my-library' ELSE 'poetry' END,"
    " 'count', cast(l_linenumber - 2 AS string))"
    ") END AS popular_shelves"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def site_date(ts: str, offset: str) -> Column:
    """A timestamp as text the way the site writes it."""
    return F.concat(
        F.date_format(ts, "EEE MMM dd HH:mm:ss"), F.lit(f" {offset} "), F.date_format(ts, "yyyy")
    )


def raw_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per part, two for every fifth; scalar columns only."""
    deliveries = table(spark, sf_dir, "part").selectExpr(
        "*", "explode(CASE WHEN p_partkey % 5 = 0 THEN array(0, 1) ELSE array(0) END) AS delivery"
    )
    return deliveries.selectExpr(
        "cast(p_partkey AS string) AS book_id",
        "concat(' ', p_name, ' ') AS title",
        "concat(p_type, ' ') AS title_without_series",
        "CASE WHEN p_partkey % 11 = 0 THEN 'n/a'"
        " ELSE cast(cast(p_partkey * 37 % 51 AS double) / 10 AS string) END AS average_rating",
        "cast(p_partkey % 500 + delivery AS string) AS ratings_count",
        "cast(p_partkey % 97 AS string) AS text_reviews_count",
        "CASE WHEN p_size % 4 = 0 THEN ' en-us' ELSE 'eng ' END AS language_code",
        "cast(p_size * 15 AS string) AS num_pages",
        "cast(1950 + p_partkey % 70 AS string) AS publication_year",
        "CASE WHEN p_size % 7 = 0 THEN '' ELSE cast(1 + p_size % 12 AS string) END"
        " AS publication_month",
        "p_brand AS publisher",
        "p_type AS format",
        "concat(p_name, '. ', p_type) AS description",
        "cast(100000 + p_partkey AS string) AS isbn",
        "concat('978', p_partkey) AS isbn13",
        "'US' AS country_code",
        "CASE p_size % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'false' END AS is_ebook",
        "delivery AS _ingestion_timestamp",
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per order line; line numbers repeat within an order, so ids repeat too."""
    written = site_date("l_shipdate", "-0700")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        F.col("l_partkey").cast("string").alias("book_id"),
        F.col("l_suppkey").cast("string").alias("user_id"),
        (F.col("l_linenumber") % 6).alias("rating"),
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("review_text"),
        F.col("l_quantity").cast("int").cast("string").alias("n_votes"),
        F.col("l_linenumber").cast("string").alias("n_comments"),
        written.alias("date_added"),
        written.alias("date_updated"),
        F.when(F.col("l_linenumber") % 2 == 0, "").otherwise(written).alias("read_at"),
        F.when(F.col("l_linenumber") % 3 == 0, "garbage").alias("started_at"),
        F.col("l_shipdate").alias("_ingestion_timestamp"),
    )


def event_book(spark: SparkSession, sf_dir: str) -> Column:
    """The book of an event, any of the parts: the same for events alike in user and `k`."""
    last = table(spark, sf_dir, "part").select(F.max("p_partkey")).scalar()
    pair = F.col("user_id") * 20 + F.get_json_object("props", "$.k").cast("int") % 20
    return (1 + pair % last).cast("string")


def raw_interactions(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """One interaction per event, dates as text, some of them missing."""
    event, value = F.col("event_id"), F.col("value")
    written = site_date("ts", "+0000")
    return table(spark, sf_dir, "events").select(
        F.when(event % 29 != 0, F.col("user_id").cast("string")).alias("user_id"),
        event_book(spark, sf_dir).alias("book_id"),
        F.when(event % 3 != 0, event.cast("string")).alias("review_id"),
        F.when(value > 50, "True").when(value > 10, "false").alias("is_read"),
        (event % 6).cast("string").alias("rating"),
        written.alias("date_added"),
        F.when(event % 17 == 0, "").otherwise(written).alias("date_updated"),
        F.lit("").alias("read_at"),
        F.lit(None).cast("string").alias("started_at"),
        *keep,
    )


def raw_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book deliveries with nested authors and shelves, one per order line.

    A book comes many times, so the nested parts repeat across deliveries.
    """
    loaded = (
        "timestampadd(MICROSECOND, cast(l_orderkey * 10 + l_linenumber AS bigint), l_shipdate)"
        " AS _ingestion_timestamp"
    )
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_partkey AS string) AS book_id", AUTHORS, SHELVES, loaded
    )


def whole_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries with the scalar columns of their book too, as the site's files have them."""
    scalars = raw_books(spark, sf_dir).filter("_ingestion_timestamp = 0")
    # The nested parts are built after the join, so that a shuffle has plain columns to move, and it
    # goes by the number, which is shorter than its text and sorts faster.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_quantity",
        "l_shipdate",
    )
    part = F.col("book_id").cast(lines.schema["l_partkey"].dataType)
    scalars = scalars.drop("_ingestion_timestamp")
    count = F.col("ratings_count").cast("int") + F.col("l_linenumber") % 2
    return (
        lines.join(scalars, F.col("l_partkey") == part)
        .withColumn("ratings_count", count.cast("string"))
        .selectExpr("book_id", AUTHORS, SHELVES, "l_shipdate", *scalars.columns[1:])
    )


def write_lines(records: DataFrame, folder: str) -> None:
    """Records as JSON lines, nulls written too, in gzip files small enough for one task each.

    Packing at the usual level takes as long as making the lines; level 3 takes a fifth of that for
    files a quarter to a half larger.
    """
    writer = records.write.option("ignoreNullFields", False).option("maxRecordsPerFile", 500_000)
    writer = writer.option("compression", "gzip").option("zlib.compress.level", "THREE")
    # A line takes many times the bytes of its row in Parquet, so tasks take few of these.
    with narrow_splits(records):
        writer.json(folder)


def dated_interactions(events: DataFrame, book: Column) -> DataFrame:
    """The newest event per user and book, typed, as the merge expects it."""
    event = F.col("event_id")
    rows = events.select(
        F.col("user_id").cast("string").alias("user_id"),
        book.alias("book_id"),
        F.when(event % 3 != 0, event.cast("string")).alias("review_id"),
        (F.col("value") > 50).cast("int").alias("is_read"),
        F.nullif((event % 6).cast("int"), F.lit(0)).alias("rating"),
        F.col("ts").alias("date_added"),
        F.when(event % 17 != 0, F.col("ts")).alias("date_updated"),
        F.lit(None).cast("timestamp_ntz").alias("read_at"),
        F.lit(None).cast("timestamp_ntz").alias("started_at"),
    )
    newest = latest_per_key(rows, ["user_id", "book_id"], ["date_updated", "date_added"])
    return newest.withColumns(
        {"has_review": present("review_id"), "last_updated_at": F.col("date_updated")}
    )


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").filter("ts < '2024-01-16'")
    return dated_interactions(events, event_book(spark, sf_dir))


def merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").filter("ts >= '2024-01-11'")
    return dated_interactions(events, event_book(spark, sf_dir))


def stored_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A versioned dimension of parts: current rows, and an older version of some."""
    part = table(spark, sf_dir, "part")
    current = part.filter("p_partkey % 10 <> 9").selectExpr(
        "p_partkey AS book_id", "p_name AS title", "p_brand AS publisher",
        "CASE WHEN p_partkey % 13 <> 0 THEN p_size END AS num_pages",
        "true AS is_current", "date'2024-01-01' AS valid_from", "date'9999-12-31' AS valid_to",
    )
    older = part.filter("p_partkey % 10 = 3").selectExpr(
        "p_partkey AS book_id", "p_name AS title", "p_brand AS publisher", "p_size + 7 AS num_pages",
        "false AS is_current", "date'2023-06-01' AS valid_from", "date'2023-12-31' AS valid_to",
    )
    return current.unionByName(older)


def incoming_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery, which leaves out one part in ten."""
    return offered_parts(spark, sf_dir).filter("book_id % 10 <> 8")


def offered_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS book_id", "p_name AS title",
        "CASE WHEN p_partkey % 17 = 0 THEN 'Brand#X' ELSE p_brand END AS publisher",
        "CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN p_size + 1"
        " ELSE p_size END AS num_pages",
    )


def order_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a file: type, name, and its bytes."""
    return table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderstatus = 'F' THEN 'complete' ELSE 'byGenre' END AS type",
        "concat(CASE o_orderkey % 4 WHEN 0 THEN 'books' WHEN 1 THEN 'reviews'"
        " WHEN 2 THEN 'interactions' ELSE 'reviews_of_books' END, '_', o_orderkey, '.json.gz')"
        " AS name",
        "o_orderkey * 1000 + o_custkey AS length",
    )
