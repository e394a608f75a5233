import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from marlstone import fixed_values as fixed
from marlstone.functions import cleaning, labels, scoring, times
from tests.conftest import values


def column(spark, cells, kind="string"):
    return spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, x {kind}")


def applied(spark, cells, expr, kind="string"):
    out = column(spark, cells, kind).select("i", expr.alias("y")).orderBy("i")
    return [r.y for r in out.collect()]


def test_safe_cast_gives_null_for_bad_text(spark):
    cells = ["12", "7.9", " 7 ", "", "n/a", None, "99999999999"]
    assert applied(spark, cells, cleaning.safe_cast("x", "int")) == [12, None, 7, None, None, None, None]


def test_float_ratings_and_range(spark):
    cells = ["4.13", "5.0", "5.01", "-1", "n/a", "NaN", ""]
    rating = cleaning.safe_cast("x", "float")
    kept = column(spark, cells).filter(rating.between(*fixed.BOOK_RATING_RANGE))
    assert [r.x for r in kept.orderBy("i").collect()] == ["4.13", "5.0"]


def test_text_and_case(spark):
    assert applied(spark, [" eng ", "", None], cleaning.clean_text("x", "upper")) == ["ENG", "", None]


def test_flag_takes_text_and_booleans(spark):
    assert applied(spark, ["true", "FALSE", "", "yes", None], cleaning.flag("x")) == [1, 0, None, None, None]
    assert applied(spark, [True, False, None], cleaning.flag("x"), "boolean") == [1, 0, None]


def test_blank_roles_get_the_default(spark):
    got = applied(spark, [" Author ", "", "  ", None, "Editor"], cleaning.default_blank("x", "Author"))
    assert got == ["Author", "Author", "Author", "Author", "Editor"]


def test_sentinel_and_presence(spark):
    assert applied(spark, [0, 3, None], cleaning.null_if("x", 0), "int") == [None, 3, None]
    assert applied(spark, ["a", "", None], cleaning.present("x")) == [1, 1, 0]
    assert applied(spark, ["a", " ", None], cleaning.present("x", blank=False)) == [1, 0, 0]


def test_thresholds(spark):
    assert applied(spark, [1, 4, 5, None], cleaning.at_least("x", 4), "int") == [0, 1, 1, 0]
    assert applied(spark, [1, 2, 3, None], cleaning.at_most("x", 2), "int") == [1, 1, 0, 0]


def test_hash_is_sha256_hex_and_salted_on_request(spark):
    plain = hashlib.sha256(b"8842").hexdigest()
    salted = hashlib.sha256(b"s8842").hexdigest()
    assert applied(spark, ["8842", None], cleaning.pseudonymise("x")) == [plain, None]
    assert applied(spark, ["8842"], cleaning.pseudonymise("x", "s")) == [salted]


def test_offset_dates(spark):
    cells = [
        "Tue Jun 12 08:59:04 -0700 2012",
        "Sat Jun 2 23:59:04 -0700 2012",
        "",
        "garbage",
        None,
        "Tue Jun 12 08:59:04 -0700 2012 and more",
    ]
    parsed = times.parse_offset_ts("x")
    assert applied(spark, cells, F.date_format(parsed, "yyyy-MM-dd HH:mm:ss")) == [
        "2012-06-12 15:59:04", "2012-06-03 06:59:04", None, None, None, None,
    ]
    assert applied(spark, cells[:2], times.date_key(parsed)) == ["20120612", "20120603"]


def test_shelf_synonyms_fold_to_the_first_group(spark):
    cells = ["tbr", "to-buy", "currently", "done", "faves", "i-own", "fantasy", None]
    assert applied(spark, cells, labels.canonicalise("x")) == [
        "to-read", "to-read", "currently-reading", "read", "favorites", "owned", "fantasy", None,
    ]


def test_every_group_label_stands_for_itself(spark):
    names = [label for label, _ in fixed.SHELF_GROUPS]
    assert applied(spark, names, labels.canonicalise("x")) == names
    assert [len(words) for _, words in fixed.SHELF_GROUPS] == [11, 6, 8, 6, 6]


def test_shadowed_synonyms_are_refused_unless_allowed():
    with pytest.raises(ValueError, match="to-buy"):
        labels.check_groups(fixed.SHELF_GROUPS)
    labels.check_groups(fixed.SHELF_GROUPS, allow_shadowed=True)


@pytest.mark.parametrize(
    "pages, rating, label",
    [
        (49, 4.5, "Low"), (50, 4.0, "High"), (400, 4.0, "High"), (401, 4.9, "Medium"),
        (600, 3.5, "Medium"), (601, 5.0, "Low"), (300, 3.99, "Medium"), (300, 3.4, "Low"),
        (None, 4.5, "Low"), (300, None, "Low"),
    ],
)
def test_priority_rules(spark, pages, rating, label):
    row = spark.createDataFrame([(pages, rating)], "p int, r float")
    assert row.select(labels.priority("p", "r").alias("y")).first().y == label


def test_scores(spark):
    row = spark.createDataFrame([(4.13, 1000, 57, 3, 4)], "r float, n int, want long, pos long, all long")
    demand = F.round(scoring.log_volume("want"), 3)
    out = row.select(
        scoring.share_pct("pos", "all").alias("pct"), demand.alias("demand"),
        scoring.popularity("r", "n", demand, F.lit(75.0)).alias("rounded"),
        scoring.popularity("r", "n", scoring.log_volume("want"), F.lit(75.0)).alias("whole"),
    ).first()
    assert (out.pct, out.demand) == (75.0, 4.06)
    assert (out.rounded, out.whole) == (4.161, 4.161)
    none = spark.createDataFrame([(None, None)], "pos long, all long")
    assert none.select(scoring.share_pct("pos", "all").alias("y")).first().y == 0.0
    assert none.select(scoring.log_volume("pos").alias("y")).first().y == 0.0


def test_megabytes(spark):
    assert applied(spark, [1048576, 1572864, 0], cleaning.megabytes("x"), "long") == [1.0, 1.5, 0.0]


def test_stamp(spark):
    now = dt.datetime(2024, 2, 1, 6, tzinfo=dt.timezone.utc)
    row = spark.range(1).select(F.unix_timestamp(cleaning.stamp(now)).alias("t"))
    assert values(row) == [(1706767200,)]
