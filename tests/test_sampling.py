import random

import pytest

from conftest import rows
from tintflow.operators.sampling import first_stream, sample_frames
from tintflow.session import new_folder
from tintflow.streaming.sampler import sample_frames_stream

EVENT = "video_key string, stream_index int, pts_us long, seq long"


def sampled(events, interval, start=None):
    """The rule in words: a picture at or after the open deadline is written, and closes that deadline."""
    deadline, written = start, []
    for _, _, pts, seq in sorted(events, key=lambda e: (e[2], e[3])):
        deadline = pts if deadline is None else deadline
        if pts >= deadline:
            written.append((seq, len(written)))
            deadline += interval
    return written


def clip(rng, key, size, interval):
    """Events with bursts, gaps and equal times."""
    pts, events = rng.randrange(10**6), []
    for seq in range(size):
        pts += rng.choice([0, 1, interval // 9, interval // 2, interval, 4 * interval + 3])
        events.append((key, seq % 2, pts, seq))
    return events


@pytest.mark.parametrize("chunks", [1, 6, 17])
def test_equals_the_rule(spark, chunks):
    rng = random.Random(chunks)
    interval = 1000
    clips = {f"v{n}": clip(rng, f"v{n}", 60, interval) for n in range(12)}
    clips["hot"] = clip(rng, "hot", 800, interval)
    events = [e for c in clips.values() for e in c]
    rng.shuffle(events)
    found = sample_frames(spark.createDataFrame(events, EVENT), interval_us=interval, chunks=chunks)
    expected = [(key, seq, no) for key, c in clips.items() for seq, no in sampled(c, interval)]
    assert rows(found, "video_key", "seq", "frame_no") == sorted(expected, key=repr)


def test_catches_up_after_a_gap(spark):
    times = [0, 1, 20, 20.1, 20.2, 20.3]
    events = spark.createDataFrame([("v", 0, int(t * 1e6), n) for n, t in enumerate(times)], EVENT)
    found = sample_frames(events)
    assert [r[0] / 1e6 for r in rows(found, "pts_us")] == [0, 20, 20.1, 20.2]


def test_two_minute_video(spark):
    events = spark.range(120 * 25 + 1).selectExpr("'v' as video_key", "0 as stream_index", "id * 40000 as pts_us", "id as seq")
    assert sample_frames(events).count() == 22


def test_first_stream(spark):
    events = spark.createDataFrame(
        [("a", 1, 5, 10), ("a", 0, 1, 11), ("a", 1, 9, 12), ("b", 0, 1, 3), ("b", 1, 0, 4)], EVENT)
    assert rows(first_stream(events), "video_key", "seq") == [("a", 10), ("a", 12), ("b", 3)]


def arrivals(spark, batches):
    """A stream that reads one file per micro-batch, oldest first."""
    folder = new_folder(spark, "arrivals")
    for n, batch in enumerate(batches):
        (spark.createDataFrame(batch, EVENT).coalesce(1).write.mode("append").parquet(f"{folder}"))
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(folder)


def run_stream(spark, events, **options):
    out, state = new_folder(spark, "out"), new_folder(spark, "state")
    query = (sample_frames_stream(events, **options).writeStream.outputMode("append")
             .option("checkpointLocation", state).trigger(availableNow=True).format("parquet").start(out))
    query.awaitTermination()
    return spark.read.parquet(out)


def test_stream_equals_the_batch(spark):
    rng = random.Random(3)
    clips = [clip(rng, f"v{n}", 120, 1000) for n in range(6)]
    cut = [[e for c in clips for e in c[:70]], [e for c in clips for e in c[70:]]]
    found = run_stream(spark, arrivals(spark, cut), interval_us=1000, first_stream_only=False)
    expected = [(c[0][0], seq, no) for c in clips for seq, no in sampled(c, 1000)]
    assert rows(found, "video_key", "seq", "frame_no") == sorted(expected, key=repr)


def test_late_events_and_second_stream(spark):
    cut = [[("v", 1, 1000, 0), ("v", 0, 1001, 1), ("v", 1, 4000, 2)],
           [("v", 1, 1500, 3), ("v", 1, 4100, 4), ("v", 0, 9000, 5), ("v", 1, 4200, 6), ("w", 0, 7, 7)]]
    found = run_stream(spark, arrivals(spark, cut), interval_us=1000)
    # Deadlines of v: 1000, 2000, 3000, 4000; the event at 1500 comes late and lies before the open one.
    assert rows(found, "video_key", "seq") == [("v", 0), ("v", 2), ("v", 4), ("v", 6), ("w", 7)]


def test_stream_may_start_with_another_streams_events(spark):
    cut = [[("v", 1, 50, 1)], [("v", 0, 60, 2), ("v", 1, 1100, 3)]]
    found = run_stream(spark, arrivals(spark, cut), interval_us=1000)
    assert rows(found, "seq", "frame_no") == [(1, 0), (3, 1)]


def test_stream_leaves_out_pictures_without_a_time(spark):
    arrived, out, state = (new_folder(spark, name) for name in ("arrived", "sampled", "state"))
    spark.createDataFrame([("v", 0, 0, 0), ("v", 0, None, 1), ("v", 0, 2000, 2), ("w", 0, None, 3)], EVENT).write.parquet(arrived)
    events = spark.readStream.schema(EVENT).parquet(arrived)
    (sample_frames_stream(events, interval_us=1000).writeStream.outputMode("append").option("checkpointLocation", state)
     .trigger(availableNow=True).format("parquet").start(out).awaitTermination())
    assert rows(spark.read.parquet(out), "video_key", "seq", "frame_no") == [("v", 0, 0), ("v", 2, 1)]
