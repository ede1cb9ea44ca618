"""Event archive: batches counted once, closed dates compacted, late events."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from wattlake.schemas import EVENTS
from wattlake.sources import versions
from wattlake.streaming import archive

D1, D2, D3 = (dt.date(2024, 5, k) for k in (1, 2, 3))


def events(spark, *rows):
    """(event id, date or None)."""
    made = [{"event_id": i, "ts": None if d is None else dt.datetime(d.year, d.month, d.day, 9)} for i, d in rows]
    return spark.createDataFrame([tuple(r.get(f.name) for f in EVENTS.fields) for r in made], EVENTS)


def held(spark, root):
    return sorted((r.event_id, r.event_date) for r in archive.read_archive(spark, root).collect())


def data_files(root, date):
    return (glob.glob(f"{root}/batches/event_date={date}/*/*.parquet")
            + glob.glob(f"{root}/closed/year={date.year}/month={date.month}/day={date.day}/*/*.parquet"))


def test_rows_stay_while_dates_are_compacted_and_late_events_come(spark, tmp_root):
    root = f"{tmp_root}/archive"
    assert held(spark, root) == [] and archive.compact(spark, root, D3) == [] and archive.tidy(spark, root) == 0
    write = archive.archive_writer(root, files_per_date=2)
    want = []
    for batch in range(6):
        rows = [(10 * batch + k, day) for k, day in enumerate((D1, D1, D2, D3, None))]
        write(events(spark, *rows), batch)
        want += rows
    assert held(spark, root) == sorted(want)
    assert len(data_files(root, D1)) >= 6
    assert archive.compact(spark, root, D3) == [D1, D2]
    assert held(spark, root) == sorted(want)
    assert archive.tidy(spark, root) == 12
    assert len(data_files(root, D1)) == len(data_files(root, D2)) == 1 and len(data_files(root, D3)) >= 6
    assert held(spark, root) == sorted(want)
    late = [(100, D1), (101, D3)]
    write(events(spark, *late), 6)
    want += late
    assert held(spark, root) == sorted(want)
    assert archive.compact(spark, root, D2) == [D1] and archive.compact(spark, root, D2) == []
    archive.tidy(spark, root)
    assert held(spark, root) == sorted(want)
    assert len(data_files(root, D1)) == 1
    # both have one version behind them or none: the third date is new, the first is not
    write(events(spark, (102, D1), (103, D2)), 7)
    assert archive.compact(spark, root, D3 + dt.timedelta(days=1)) == [D1, D2, D3]
    assert held(spark, root) == sorted(want + [(102, D1), (103, D2)])


def test_half_written_and_replayed_batches(spark, tmp_root):
    root = f"{tmp_root}/archive"
    write = archive.archive_writer(root)
    first, second = [(1, D1), (2, D2)], [(3, D1)]
    write(events(spark, *first), 0)
    (events(spark, *second).withColumn("event_date", F.to_date("ts")).withColumn("batch_id", F.lit(1))
     .write.mode("append").partitionBy("event_date", "batch_id").parquet(f"{root}/batches"))
    assert held(spark, root) == first                   # no marker yet
    assert archive.compact(spark, root, D3) == [D1, D2]
    assert held(spark, root) == first
    write(events(spark, *second), 1)                    # the batch again, whole
    write(events(spark, *first), 0)                     # and one that is in a version
    assert held(spark, root) == sorted(first + second)
    archive.compact(spark, root, D3)
    archive.tidy(spark, root)
    assert held(spark, root) == sorted(first + second)


def test_an_uncommitted_version_does_not_count_and_files_follow_bytes(spark, tmp_root, monkeypatch):
    root = f"{tmp_root}/archive"
    rows = [(k, D1) for k in range(400)]
    archive.archive_writer(root)(events(spark, *rows), 0)

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lost)
        try:
            archive.compact(spark, root, D2)
        except OSError:
            pass
    assert held(spark, root) == rows
    size = sum(archive._length(spark, f) for f in data_files(root, D1) if "/batches/" in f)
    archive.compact(spark, root, D2, file_bytes=size // 3)
    assert held(spark, root) == rows
    standing = versions.current(spark, f"{root}/closed")[D1].folder(f"{root}/closed")
    assert 2 <= len(glob.glob(f"{standing}/*.parquet")) <= 4
