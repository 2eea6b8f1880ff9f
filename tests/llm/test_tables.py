"""Stored steps and what a worker process keeps."""

import pytest

from waybill.llm import tables


def test_a_worker_remembers_for_one_owner():
    made = []
    make = lambda name: lambda: made.append(name) or [name]
    first = tables.remembered("a", make("a"))
    assert tables.remembered("a", make("again")) is first and made == ["a"]
    assert tables.remembered(("b", 1), make("b")) == ["b"]
    assert tables.remembered("a", make("a")) is not first and made == ["a", "b", "a"]


def test_small_batches_are_for_the_jobs_within(spark):
    def measured(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(batch)]})

    before = spark.conf.get(tables.BATCH_ROWS)
    sizes = lambda df: max(r[0] for r in df.mapInArrow(measured, "n long").collect())
    rows = spark.range(0, 5000, 1, 1)
    with tables.small_batches(spark):
        assert sizes(rows) == 1000
    assert spark.conf.get(tables.BATCH_ROWS) == before and sizes(rows) == 5000
    with pytest.raises(ValueError), tables.small_batches(spark):
        raise ValueError
    assert spark.conf.get(tables.BATCH_ROWS) == before
    spark.conf.set(tables.BATCH_ROWS, "7")
    try:
        with tables.small_batches(spark):
            assert sizes(rows) == 7  # never more than the session allows
    finally:
        spark.conf.set(tables.BATCH_ROWS, before)


def test_sums_hand_python_small_batches(spark):
    def largest(batches):
        import numpy as np
        import pyarrow as pa

        yield pa.RecordBatch.from_pydict({"part": [np.array([max(map(len, batches))]).tobytes()]})

    before = spark.conf.get(tables.BATCH_ROWS)
    rows = spark.range(0, 5000, 1, 1).mapInArrow(largest, "part binary")
    assert tables.summed(rows, "int64").tolist() == [1000]
    assert spark.conf.get(tables.BATCH_ROWS) == before
