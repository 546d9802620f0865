from __future__ import annotations

from starmart import session

GB = 1024**3


def test_shuffle_partitions_follow_the_data(spark):
    def size(bytes_):
        with session.sized_shuffles(spark, bytes_):
            return spark.conf.get(session.INITIAL_PARTITIONS, None)

    assert size(GB // 10) is None
    assert size(100 * GB) == "400"
    assert size(100_000 * GB) == "400000"
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None
    spark.conf.set(session.INITIAL_PARTITIONS, "500")
    try:
        assert size(GB) == "500" and size(200 * GB) == "800"
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "500"
    finally:
        spark.conf.unset(session.INITIAL_PARTITIONS)


def test_shared_folder(spark):
    assert session.shared_folder(spark, "nowhere") == spark.conf.get("spark.checkpoint.dir")


def test_settings_given_by_the_caller_win(spark):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
