"""What a load asks of the tasks that write its tables."""

from __future__ import annotations

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from conftest import source_frames
from pyspark.sql import functions as F

from niaga.operators import BUCKET_BYTES, write_buckets
from niaga.plans import pipeline
from niaga.plans.incremental import run_incremental
from niaga.plans.pipeline import _bytes, run_load

SNAPSHOT = dt.date(2026, 7, 1)
WRITERS, READ = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.maxPartitionBytes"


@pytest.mark.parametrize("load", [run_load, run_incremental])
def test_tasks_of_a_load_hold_few_files_open_and_read_what_they_can_sort(spark, tmp_path, monkeypatch, load):
    """F1-F17: with a file open for each of a hundred buckets a task took three times as long as with sorted rows."""
    seen, write = [], pipeline.Load.write

    def watched(self, layer, name, *rest, **more):
        if name.startswith("stg_"):
            seen.append([_bytes(spark.conf.get(each)) for each in (WRITERS, READ)])
        return write(self, layer, name, *rest, **more)

    run_load(spark, source_frames(spark), str(tmp_path), SNAPSHOT, publish_failed_checks=True)
    before = [spark.conf.get(each) for each in (WRITERS, READ)]
    monkeypatch.setattr(pipeline.Load, "write", watched)
    load(spark, source_frames(spark), str(tmp_path), SNAPSHOT, publish_failed_checks=True)
    assert len(seen) == 5 and all(1 <= writers <= 16 and read <= BUCKET_BYTES // 2 for writers, read in seen)
    assert [spark.conf.get(each) for each in (WRITERS, READ)] == before


def test_rows_for_many_files_are_all_written(spark, tmp_path):
    """More buckets than files that a task holds open: the first rows go to open files, the others are sorted."""
    rows = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") % 7000).alias("k"), "id").union(spark.sql("SELECT CAST(NULL AS STRING), -1L"))
    with pipeline.bounded_writes(spark):
        dealt = write_buckets(rows, "k", 50, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty() and back.count() == 20_001
    assert "Exchange hashpartitioning" not in dealt.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()


def test_columns_of_many_values_keep_no_large_dictionary(spark, tmp_path):
    """F1-F17: a dictionary of up to a megabyte for each column of each file, which keys fill and give up in the end."""
    rows = spark.range(0, 24_000, 1, 1).select(F.sha2((F.col("id") % 8000).cast("string"), 256).alias("k"), (F.col("id") % 3).alias("few"))
    write_buckets(rows, "k", 1, str(tmp_path / "t"))
    (file,) = glob.glob(str(tmp_path / "t" / "*.parquet"))
    key, few = (pq.ParquetFile(file).metadata.row_group(0).column(i) for i in (0, 1))
    assert "PLAIN" in key.encodings and not {"RLE_DICTIONARY", "PLAIN_DICTIONARY"} & set(key.encodings)
    assert {"RLE_DICTIONARY", "PLAIN_DICTIONARY"} & set(few.encodings)


def test_sizes_as_settings_state_them():
    assert [_bytes(t) for t in ("134217728b", "128MB", "128m", "8192", "1g", "16k")] == [1 << 27, 1 << 27, 1 << 27, 8192, 1 << 30, 1 << 14]
