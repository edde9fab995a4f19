"""The stream reads a table that is one file as well as one that is a folder of files."""

from __future__ import annotations

from pathlib import Path

import pytest

from workload import queries

SMALL = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("files", [1, 3])
def test_stream_scores_every_file(spark, tmp_path, files):
    for path in SMALL.glob("*.parquet"):
        if path.stem != "conversations":
            (tmp_path / path.name).symlink_to(path)
    rows = [(n // 3, n % 3, "user", f"please see http://a.example/{n}") for n in range(12)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    written = tmp_path / ("conversations.parquet" if files > 1 else "one")
    table.repartition(files).write.parquet(str(written))
    if files == 1:
        (part,) = written.glob("part-*.parquet")
        part.rename(tmp_path / "conversations.parquet")
    scored = queries.QUERIES["q_score_stream"](spark, str(tmp_path)).collect()
    assert sorted((row.conv_id, row.turn) for row in scored) == sorted(row[:2] for row in rows)
    assert all(row.error is None for row in scored)
