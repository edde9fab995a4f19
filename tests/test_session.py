from __future__ import annotations

import pyarrow as pa
import pytest

from mailrisk.session import BATCH_BYTES, new_stage, small_batches


def test_stages_are_written_in_small_batches(spark):
    def batch_sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    before = spark.conf.get(BATCH_BYTES)
    rows = spark.range(0, 3_000, 1, 1).selectExpr("id", "repeat('x', 10000) AS text")
    stage = new_stage(rows.mapInArrow(batch_sizes, "n long, size long"), "sizes")
    sizes = stage.rows.collect()
    assert sum(r.n for r in sizes) == 3_000 and len(sizes) >= 3 and max(r.size for r in sizes) < 9 << 20
    assert spark.conf.get(BATCH_BYTES) == before


def test_own_settings_and_failures_leave_the_session_as_it_was(spark):
    before = spark.conf.get(BATCH_BYTES)
    with pytest.raises(KeyError):
        with small_batches(spark):
            raise KeyError
    assert spark.conf.get(BATCH_BYTES) == before
    try:
        spark.conf.set(BATCH_BYTES, "1m")
        with small_batches(spark):
            assert spark.conf.get(BATCH_BYTES) == "1m"
    finally:
        spark.conf.set(BATCH_BYTES, before)
