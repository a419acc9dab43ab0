"""From requests to strips."""

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintflow.functions.requests import accepted
from tintflow.operators.color import attach_frames, requested_colors
from tintflow.operators.history import KEPT_VERSIONS, append_history, last_versions, upsert_frame_colors, upsert_video_metadata
from tintflow.operators.lookup import ASKED, key_bits, may_be_wanted, route_requests
from tintflow.operators.sampling import DEFAULT_INTERVAL_US, first_stream, sample_frames
from tintflow.plans.ingest import ingest
from tintflow.plans.strips import video_strip
from tintflow.session import join_on_group, staged


class Analysis(NamedTuple):
    """``routed``: what each accepted request needed; ``ingested``: metadata records of videos that were new;
    ``fresh``: the colours computed now; ``strips``: those of all requests; ``unserved``: requests without a strip, and why."""

    routed: DataFrame
    ingested: DataFrame | None
    fresh: DataFrame
    strips: DataFrame
    unserved: DataFrame


def analyze(requests: DataFrame, videos: DataFrame, blocks: DataFrame, events: DataFrame, pixels: DataFrame,
            stored: DataFrame, *, arrivals: DataFrame | None = None, interval_us: int = DEFAULT_INTERVAL_US,
            first_stream_only: bool = True, rounding: str = "truncate", force: bool = False,
            kept_versions: int = KEPT_VERSIONS) -> Analysis:
    """Route the requests, sample and colour what has no result yet, and draw the strips of all of them.

    ``videos`` are the metadata records; ``arrivals`` (video_key, name, size, recorded_at) are stored files, from which
    those routed to ``ingest`` get their record. ``pixels`` belong to picture events (video_key, seq); ``stored`` are frame
    colours of earlier runs, and only requests that have some are shown from them. A video's newest ``kept_versions``
    block records count; an older one is computed again. Routes, ordered events and new colours are staged, so that the
    colours are computed once for the strips and for ``save``.
    """
    asked = staged(accepted(requests))
    # Records and colours of videos nobody asks for are left out where they are scanned; all rows of a video share its bit.
    bits = key_bits(asked)
    blocks, stored = (may_be_wanted(history, asked, bits) for history in (blocks, stored))
    kept = last_versions(blocks, ["video_key"], kept=kept_versions)
    with_colors = stored.groupBy(*ASKED).agg(F.count(F.lit(1)).alias("_frames")).drop("_frames")
    routed = staged(route_requests(
        asked, videos, kept.join(with_colors, ASKED, "left_semi"), force=force))
    work = routed.filter("action != 'show'").select(*ASKED)
    shown = routed.filter("action = 'show'").select(*ASKED)
    ingested = None
    if arrivals is not None:
        new = routed.filter("action = 'ingest'").select("video_key").distinct()
        ingested = staged(ingest(arrivals.join(new, "video_key", "left_semi"), videos))

    open_videos = work.select("video_key").distinct()
    pictures = join_on_group(events, open_videos, "video_key", ["seq"], "left_semi")
    if first_stream_only:
        pictures = first_stream(pictures)
    frames = sample_frames(pictures, interval_us=interval_us).select(
        "video_key", "seq", (F.col("frame_no") + 1).alias("frame_index"))
    fresh = staged(requested_colors(attach_frames(pixels, frames), work, rounding=rounding))

    # The stored side is the large one; equality on the key also keeps a key from matching another it begins.
    cached = join_on_group(stored, shown, ASKED, ["frame_index"], "left_semi").select(*fresh.columns)
    colors = fresh.unionByName(cached)
    drawn = colors.groupBy(*ASKED).agg(F.count(F.lit(1)).alias("frames"))
    unserved = routed.join(drawn, ASKED, "left_anti").withColumn("reason", F.lit("no usable picture"))
    return Analysis(routed, ingested, fresh, video_strip(colors), unserved)


def save(fresh: DataFrame, colors_path: str, blocks_path: str, *, ingested: DataFrame | None = None,
         metadata_path: str | None = None) -> None:
    """Store new metadata and colours, and only then that their bucket sizes and kinds are analysed.

    All colours of a run carry one stamp, which no other run has and by which reading tells the newest run from those before it. The block
    records carry it too: a run that ends before they are written leaves colours that ``recorded_runs`` does not see.
    """
    if ingested is not None:
        upsert_video_metadata(ingested, metadata_path)
    now = fresh.sparkSession.sql("select current_timestamp() as t").first()["t"]
    run = uuid.uuid4().int >> 65
    stamp = [F.lit(now).alias("recorded_at"), F.lit(run).cast("long").alias("seq")]
    upsert_frame_colors(fresh.select("*", *stamp), colors_path)
    append_history(fresh.select(*ASKED).distinct().select("*", *stamp), blocks_path)
