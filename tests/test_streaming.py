import datetime as dt

from cohortkit.operators.snapshots import activity_snapshots
from cohortkit.streaming import merged_snapshots, start_snapshot_stream
from tests.fixtures import D, frame

TS = dt.datetime


def test_incremental_snapshots_equal_batch(spark, tmp_path):
    grid = [D(2021, 1, 1), D(2021, 3, 1)]
    first = [(D(2021, 1, 1), 1, TS(2020, 12, 30, 9), "Default"),
             (D(2021, 1, 1), 2, TS(2020, 12, 1), "Administrator"),
             (D(2021, 2, 1), 2, TS(2021, 1, 9), "Default")]
    second = [(D(2021, 1, 1), 1, TS(2020, 12, 31, 9), "finance manager"),   # same partition, later batch
              (D(2021, 3, 1), 3, TS(2021, 2, 2), "Default"),
              (D(2021, 3, 1), None, TS(2021, 2, 2), "Default")]
    src, parts, ckpt = (str(tmp_path / n) for n in ("src", "parts", "ckpt"))
    frame(spark, "user_hist", first).write.mode("append").parquet(src)
    start_snapshot_stream(spark, src, grid, parts, ckpt).awaitTermination()
    frame(spark, "user_hist", second).write.mode("append").parquet(src)
    start_snapshot_stream(spark, src, grid, parts, ckpt).awaitTermination()
    got = sorted(tuple(r) for r in merged_snapshots(spark, parts).collect())
    want = sorted(tuple(r) for r in activity_snapshots(frame(spark, "user_hist", first + second), grid)
                  .select(*merged_snapshots(spark, parts).columns).collect())
    assert got == want and len(got) == 3
