import os

import pytest
from pyspark.sql import functions as F

from marlstone.operators import mutations
from marlstone.sources import catalog, files, fs, store
from tests.conftest import AS_OF, NOW, values


@pytest.fixture
def root(tmp_path):
    return f"{tmp_path}/table"


def numbers(spark, *cells):
    return spark.createDataFrame([(c,) for c in cells], "n int")


def test_replace_append_and_earlier_runs(spark, root):
    assert not store.has_table(spark, root)
    assert store.replace(numbers(spark, 1, 2), root) == {"rows": 2}
    store.append(numbers(spark, 3), root)
    store.append(numbers(spark, 9).withColumn("more", F.lit("x")), root)
    assert values(store.read_table(spark, root)) == [(1, None), (2, None), (3, None), (9, "x")]
    assert values(store.read_table(spark, root, run=1)) == [(1,), (2,), (3,)]
    store.replace(numbers(spark, 5), root)
    assert values(store.read_table(spark, root)) == [(5,)]
    assert values(store.read_table(spark, root, run=0)) == [(1,), (2,)]


def test_a_table_may_be_rewritten_from_itself(spark, root):
    store.replace(numbers(spark, 1, 2), root)
    store.replace(store.read_table(spark, root).selectExpr("n * 10 AS n"), root)
    assert values(store.read_table(spark, root)) == [(10,), (20,)]


def test_a_run_without_its_log_line_does_not_count(spark, root):
    store.replace(numbers(spark, 1), root)
    numbers(spark, 7).write.parquet(f"{root}/data/run_id=1")  # lost before the commit
    assert values(store.read_table(spark, root)) == [(1,)]
    store.append(numbers(spark, 2), root)
    assert values(store.read_table(spark, root)) == [(1,), (2,)]


def test_a_write_that_fails_half_way_leaves_the_table_as_it_was(spark, root):
    store.replace(numbers(spark, 1), root)
    broken = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") < 99, F.col("id").cast("int")).otherwise(F.raise_error(F.lit("lost"))).alias("n")
    )
    with pytest.raises(Exception, match="lost"):
        store.append(broken, root)
    assert values(store.read_table(spark, root)) == [(1,)]
    assert store.append(numbers(spark, 2), root) == {"rows": 1}
    assert values(store.read_table(spark, root)) == [(1,), (2,)]


def test_a_committed_run_is_never_overwritten(spark, root):
    store.replace(numbers(spark, 1), root, run_id=5)
    with pytest.raises(ValueError, match="not after"):
        store.replace(numbers(spark, 2), root, run_id=5)
    with pytest.raises(ValueError, match="one part"):
        store.write_parts(numbers(spark, 2), root, F.lit("x"))


def test_absent_table(spark, root):
    with pytest.raises(FileNotFoundError):
        store.read_table(spark, root)
    calls = []

    def build():
        calls.append(1)
        return numbers(spark, 4)

    assert values(store.ensure_table(spark, root, build)) == [(4,)]
    assert values(store.ensure_table(spark, root, build)) == [(4,)]
    assert calls == [1]


def test_empty_runs(spark, root):
    store.append(numbers(spark), root)
    assert values(store.read_table(spark, root)) == []
    empty = mutations.versioned(numbers(spark), AS_OF)
    store.write_versions(empty, f"{root}2")
    assert store.read_table(spark, f"{root}2").columns == ["n", "is_current", "valid_from", "valid_to"]


def test_history_newest_first(spark, root):
    for i in range(7):
        store.replace(numbers(spark, *range(i)), root, operation=f"STEP {i}", now=NOW)
    history = store.table_history(spark, root).collect()
    assert [h.version for h in history] == [6, 5, 4, 3, 2]
    assert tuple(history[0]) == (6, "2024-02-01 06:00:00", "STEP 6", {"rows": "6"})


def three_days(spark, root):
    for day, cells in enumerate(([(1, "a"), (2, "a")], [(1, "b"), (3, "b")], [(1, "b"), (2, "c")])):
        source = spark.createDataFrame(cells, "k int, v string")
        current = store.read_current(spark, root) if day else None
        delta = mutations.scd2_delta(current, source, ["k"], ["v"], AS_OF.replace(day=day + 1))
        store.write_versions(delta, root)


def test_versions_keep_history_where_it_is(spark, root):
    three_days(spark, root)
    brief = ("k", "v", "is_current")
    assert values(store.read_table(spark, root), *brief) == [
        (1, "a", False), (1, "b", True), (2, "a", False), (2, "c", True), (3, "b", True),
    ]
    assert values(store.read_current(spark, root), *brief) == [
        (1, "b", True), (2, "c", True), (3, "b", True),
    ]
    assert values(store.read_table(spark, root, run=1), *brief) == [
        (1, "a", False), (1, "b", True), (2, "a", True), (3, "b", True),
    ]
    closed = [n for n in fs.list_names(spark, f"{root}/data/run_id=2") if n.startswith("part=")]
    assert closed == ["part=closed", "part=current"]
    assert spark.read.parquet(f"{root}/data/run_id=2/part=closed").count() == 1


def test_catalog_names(spark, root):
    three_days(spark, root)
    catalog.register_table(spark, "shop.parts", root)
    out = spark.sql("SELECT count(*) AS n, count_if(is_current) AS current FROM shop.parts")
    assert values(out) == [(5, 3)]
    assert spark.table("shop.parts").columns == ["k", "v", "is_current", "valid_from", "valid_to"]
    source = spark.createDataFrame([(4, "z")], "k int, v string")
    current = store.read_current(spark, root)
    delta = mutations.scd2_delta(current, source, ["k"], ["v"], AS_OF.replace(day=9))
    store.write_versions(delta, root)
    assert spark.table("shop.parts").count() == 5
    catalog.register_table(spark, "shop.parts", root)
    assert spark.table("shop.parts").count() == 6

    store.replace(numbers(spark, 1, 2), f"{root}2")
    store.append(numbers(spark, 3), f"{root}2")
    catalog.register_table(spark, "shop.numbers", f"{root}2")
    assert values(spark.table("shop.numbers")) == [(1,), (2,), (3,)]
    catalog.register_path(spark, "shop.raw", f"{root}2/data/run_id=1")
    assert values(spark.table("shop.raw")) == [(3,)]


def test_catalogue_file(spark, tmp_path):
    path = f"{tmp_path}/names.csv"
    with open(path, "w") as out:
        out.write(
            "type , name\ncomplete, books.json.gz\n byGenre ,reviews.json\nshort\n\n"
            "byGenre,long,line\nbyGenre,\nbyGenre,\"quoted\"\n"
        )
    table = files.read_catalogue(spark, path)
    assert table.count() == 4
    assert values(table) == sorted(
        [("complete", "books.json.gz"), ("byGenre", "reviews.json"), ("byGenre", ""),
         ("byGenre", '"quoted"')], key=repr,
    )


def test_catalogue_columns_go_by_name(spark, tmp_path):
    path = f"{tmp_path}/names.csv"
    with open(path, "w") as out:
        out.write("name,type\nbooks.json,complete\n")
    assert values(files.read_catalogue(spark, path)) == [("complete", "books.json")]
    with pytest.raises(ValueError, match="lacks"):
        files.read_catalogue(spark, path, ("type", "size"))


def test_file_inventory(spark, tmp_path):
    os.makedirs(f"{tmp_path}/raw/deep")
    with open(f"{tmp_path}/raw/deep/a.json", "wb") as out:
        out.write(b"x" * 1572864)
    os.utime(f"{tmp_path}/raw/deep/a.json", (1706767200, 1706767200))
    assert values(files.file_inventory(spark, f"{tmp_path}/raw")) == [
        ("a.json", 1.5, "2024-02-01 06:00:00")
    ]


def test_parts_are_replaced_added_to_or_left(spark, root):
    part = F.concat(F.lit("p"), F.col("n") % 3)
    store.write_parts(numbers(spark, 0, 1, 2, 3, 4), root, part)
    store.write_parts(numbers(spark, 30, 31), root, part, replaced=["p0"])
    assert values(store.read_table(spark, root)) == [(1,), (2,), (30,), (31,), (4,)]
    assert values(store.read_table(spark, root, parts=["p1", "p2"])) == [(1,), (2,), (31,), (4,)]
    assert values(store.read_table(spark, root, run=0)) == [(0,), (1,), (2,), (3,), (4,)]
    store.write_parts(numbers(spark), root, part, replaced=["p1"])
    assert values(store.read_table(spark, root)) == [(2,), (30,)]
    assert store.state(spark, root)["parts"] == {"p0": [1], "p2": [0]}
    catalog.register_table(spark, "shop.split", root)
    assert values(spark.table("shop.split")) == [(2,), (30,)]


def test_old_runs_go_when_nothing_needs_them(spark, root):
    three_days(spark, root)
    before = values(store.read_table(spark, root))
    gone = store.drop_old_runs(spark, root, keep=2)
    assert [g.rpartition("/data/")[2] for g in gone] == ["run_id=0/part=current"]
    assert values(store.read_table(spark, root)) == before
    assert len(values(store.read_table(spark, root, run=1))) == 4
    assert store.versions(spark, root) == [1, 2]


def test_balanced_parts_leave_few_files(spark, root):
    df = spark.range(0, 4000, 1, 8).select((F.col("id") % 5).alias("m"), "id")
    store.write_parts(df, root, F.concat(F.lit("m"), "m"))
    names = [f for f in spark.read.parquet(f"{root}/data/run_id=0").inputFiles()]
    assert len(names) == 5
