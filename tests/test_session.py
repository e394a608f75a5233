import pytest

from marlstone import session

PARTITIONS, SPLIT = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
FILE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
GB, TB = 1 << 30, 1 << 40


@pytest.mark.parametrize(
    "size, partitions, split, file",
    [
        (0, 0, 128 << 20, 64 << 20), (GB, 4, 128 << 20, 64 << 20), (TB, 4096, 128 << 20, 64 << 20),
        (100 * TB, 40000, 1 << 30, 512 << 20),
    ],
)
def test_sizes(size, partitions, split, file):
    assert session.sizes_for(size) == {PARTITIONS: partitions, SPLIT: split, FILE: file}


def test_sizes_only_ever_rise_and_are_put_back(spark):
    before = {name: spark.conf.get(name) for name in (PARTITIONS, SPLIT)}
    small = spark.range(10)
    with session.sized_for(small):
        assert spark.conf.get(PARTITIONS) == before[PARTITIONS]
    huge = spark.range(5 * TB // 8)
    with session.sized_for(huge, small):
        wanted = session.sizes_for(session.plan_bytes(huge) + session.plan_bytes(small))
        assert spark.conf.get(PARTITIONS) == str(wanted[PARTITIONS]) != before[PARTITIONS]
    assert {name: spark.conf.get(name) for name in before} == before


def test_scratch_folders_differ_and_are_below_the_shared_one(spark):
    one, two = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert one != two
    assert one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_prepared_puts_settings_back(spark):
    zone = "spark.sql.session.timeZone"
    before = spark.conf.get(zone)
    spark.conf.set(zone, "Asia/Tokyo")
    try:
        with pytest.raises(ZeroDivisionError), session.prepared(spark):
            assert spark.conf.get(zone) == "UTC"
            1 / 0
        assert spark.conf.get(zone) == "Asia/Tokyo"
    finally:
        spark.conf.set(zone, before)


def test_scratch_can_be_freed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "scratch_base", lambda _: str(tmp_path))
    path = session.scratch_dir(spark, "x")
    spark.range(3).write.parquet(path)
    session.free_scratch(spark)
    assert list(tmp_path.glob("marlstone/*")) == []


def test_splits_to_sort_are_narrow_and_buckets_follow_the_input(spark):
    before = spark.conf.get(SPLIT)
    small, huge = spark.range(10), spark.range(5 * TB)
    with session.narrow_splits(small):
        assert spark.conf.get(SPLIT) == str(16 << 20)
    with session.narrow_splits(huge):
        assert spark.conf.get(SPLIT) == before
    assert spark.conf.get(SPLIT) == before
    assert session.buckets_for(8, small) == 8
    assert session.buckets_for(8, spark.range(1 << 30), small) == 1025
