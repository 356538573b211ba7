"""Session plumbing: what is proven before a broadcast, settings for a while."""

from corpusloom.cluster import broadcast_if_small, with_conf


def test_rows_and_bytes_are_proven(spark):
    rows = spark.createDataFrame([(i, "가" * 10) for i in range(10)] + [(10, None)], "n long, t string")
    assert broadcast_if_small(rows, 11)[1] and not broadcast_if_small(rows, 10)[1]
    assert broadcast_if_small(rows, 11, max_bytes=400)[1] and not broadcast_if_small(rows, 11, max_bytes=380)[1]
    assert broadcast_if_small(rows.limit(0), 0)[1]


def test_settings_are_restored(spark):
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    try:
        with with_conf(spark, name, "false"):
            assert spark.conf.get(name) == "false"
            raise KeyError
    except KeyError:
        assert spark.conf.get(name) == before
