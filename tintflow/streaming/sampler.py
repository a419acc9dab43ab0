"""The fixed-interval sampler on a stream of picture events."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

from tintflow.operators.sampling import DEFAULT_INTERVAL_US


def sample_frames_stream(events: DataFrame, *, interval_us: int = DEFAULT_INTERVAL_US,
                         first_stream_only: bool = True, forget_after_ms: int | None = None) -> DataFrame:
    """Written pictures of a stream of (video_key, stream_index, pts_us, seq), in append mode.

    State per video: the chosen stream, the first picture's time and the number of pictures written. Within a
    micro-batch a video's events are taken in (pts_us, seq) order; a later batch's event that lies
    before the next deadline is not written. A task holds one video's events of one micro-batch, four numbers each:
    set the source's ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` so that a whole micro-batch would fit. Pictures without a
    time or a place in their video are not written.

    With ``forget_after_ms`` the state of a video without events for that long is dropped; should it go on
    later, it starts anew. Without it a video is never forgotten. For many videos, name the RocksDB state store provider.
    """
    columns = ["video_key", "stream_index", "pts_us", "seq"]
    key_type = events.schema["video_key"].dataType.simpleString()

    def sample(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        # Arrays: a video has few events in a micro-batch, and a call for each is most of the work.
        parts = [[part[c].to_numpy() for c in columns] for part in batches]
        video, streams, times, seq = parts[0] if len(parts) == 1 else map(np.concatenate, zip(*parts))
        if state.exists:
            stream, start, written = state.get
        else:
            stream, start, written = int(streams[np.argmin(seq)]), None, 0
        at = np.lexsort((seq, times))
        if first_stream_only:
            at = at[streams[at] == stream]
        if start is None:
            start = int(times[at[0]])
        reached = (times[at] - start) // interval_us + 1
        at, reached = at[reached > written], reached[reached > written]
        if len(at):
            slack = reached - np.arange(1, len(at) + 1)
            floor = np.minimum.accumulate(np.concatenate([[written], slack]))
            at = at[slack >= floor[:-1]]
            yield pd.DataFrame({"video_key": video[at], "stream_index": streams[at], "pts_us": times[at], "seq": seq[at],
                                "frame_no": np.arange(written, written + len(at))})
            written += len(at)
        state.update((stream, start, written))
        if forget_after_ms is not None:
            state.setTimeoutDuration(forget_after_ms)

    return events.select(*columns).dropna(subset=["pts_us", "seq"]).groupBy("video_key").applyInPandasWithState(
        sample,
        f"video_key {key_type}, stream_index int, pts_us long, seq long, frame_no long",
        "stream_index int, start long, written long",
        "append", GroupStateTimeout.NoTimeout if forget_after_ms is None else GroupStateTimeout.ProcessingTimeTimeout)
