"""Tables between steps: what stays, what goes, and the settings after."""

import pytest

from corpusmill.sources import scratch
from corpusmill.sources.files import exists


def test_tables_on_the_way_go_and_the_result_stays(spark):
    seen = []

    def inner():
        df, path = scratch.stored(spark.range(5), "first")
        seen.append(path)
        again, kept = scratch.settled(spark, "nested", lambda: scratch.stored(df.filter("id > 1"), "second")[0])
        seen.append(kept)
        return again.filter("id > 2")

    found, path = scratch.settled(spark, "result", inner)
    assert sorted(r.id for r in found.collect()) == [3, 4] and exists(spark, path)
    assert not any(exists(spark, p) for p in seen)
    scratch.removed(spark, path)


def test_a_failure_leaves_nothing_and_restores_settings(spark):
    paths, before = [], spark.conf.get(scratch._CLEANED)

    def fails():
        paths.append(scratch.stored(spark.range(3), "lost")[1])
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        scratch.settled(spark, "result", fails)
    assert not exists(spark, paths[0]) and spark.conf.get(scratch._CLEANED) == before
    with pytest.raises(RuntimeError), scratch.setting(spark, scratch._CLEANED, "true"):
        assert spark.conf.get(scratch._CLEANED) == "true"
        raise RuntimeError
    assert spark.conf.get(scratch._CLEANED) == before
    outside, path = scratch.stored(spark.range(2), "outside")
    assert outside.count() == 2 and exists(spark, path)
    scratch.removed(spark, path)
