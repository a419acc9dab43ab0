"""Operator inputs derived from the test tables: a DataFrame function and the same relation as SQL text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintflow.functions.colour import pack_rgb
from tintflow.operators.color import average_color
from tintflow.operators.strip import gradient
from tintflow.session import apply_defaults

HOURS_6 = 6 * 3600 * 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_defaults(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


VIDEO = "concat('video_', l_returnflag, l_linestatus)"
RGB = ["cast((l_partkey * 7) % 256 as int) as r", "cast((l_suppkey * 13) % 256 as int) as g",
       "(cast(l_quantity as int) * 5) % 256 as b"]


def pixels(spark, sf_dir, frame="l_linenumber"):
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{VIDEO} as video_key", f"cast({frame} as bigint) as frame_index", *RGB)


def pixels_sql(name="px", frame="l_linenumber"):
    return (f"{name} AS (SELECT {VIDEO} AS video_key, CAST({frame} AS BIGINT) AS frame_index, "
            f"{', '.join(RGB)} FROM lineitem)")


FRAME_12, FRAME_24 = "l_orderkey % 12 + 1", "l_orderkey % 24 + 1"
PX, PX12, PX24 = pixels_sql(), pixels_sql("px12", FRAME_12), pixels_sql("px24", FRAME_24)


SUPPLIER = "concat('supplier_', l_suppkey)"


def supplier_pixels(spark, sf_dir):
    """One video of up to 24 frames per supplier, so that the number of videos grows with the tables."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{SUPPLIER} as video_key", f"cast({FRAME_24} as bigint) as frame_index", *RGB)


SUPPLIER_PX = (f"supplier_px AS (SELECT {SUPPLIER} AS video_key, CAST({FRAME_24} AS BIGINT) AS frame_index, "
               f"{', '.join(RGB)} FROM lineitem)")


def frame_dims(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as frame_index", "p_size as width", "p_size % 7 + 1 as height")


FRAME_DIMS = ("frame_dims AS (SELECT p_partkey AS frame_index, p_size AS width, p_size % 7 + 1 AS height FROM part)")


def frame_events(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "user_id as video_key", "cast(event_id % 3 as int) as stream_index",
        "unix_micros(cast(ts as timestamp)) as pts_us", "event_id as seq")


FRAME_EVENTS = ("frame_events AS (SELECT user_id AS video_key, CAST(event_id % 3 AS INTEGER) AS stream_index, "
                "epoch_us(ts) AS pts_us, event_id AS seq FROM events)")


BLOCK_KIND = "CASE WHEN event_id % 2 = 0 THEN 'average' ELSE 'dominant' END"


def video_blocks(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "user_id as video_key", "cast(event_id % 255 + 1 as int) as bucket_size", f"{BLOCK_KIND} as kind",
        "unix_micros(cast(ts as timestamp)) as recorded_at", "event_id as seq")


VIDEO_BLOCKS = (f"video_blocks AS (SELECT user_id AS video_key, CAST(event_id % 255 + 1 AS INTEGER) AS bucket_size, "
                f"{BLOCK_KIND} AS kind, epoch_us(ts) AS recorded_at, event_id AS seq FROM events)")
KEPT_BLOCKS = ("kept_blocks AS (SELECT * FROM video_blocks QUALIFY row_number() OVER "
               "(PARTITION BY video_key ORDER BY recorded_at DESC, seq DESC) <= 20)")

KIND = "CASE c_custkey % 3 WHEN 0 THEN 'average' WHEN 1 THEN 'domiant' ELSE 'dominant' END"
OTHER_KIND = "CASE WHEN event_id % 4 < 2 THEN 'average' ELSE 'domiant' END"


OTHER_SIZE = "event_id % 17 * 15 + 1"


def own_requests(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as video_key", "cast(c_custkey % 300 - 10 as int) as bucket_size", f"{KIND} as kind")


OWN_REQUESTS = ("requests AS (SELECT c_custkey AS video_key, CAST(c_custkey % 300 - 10 AS INTEGER) AS bucket_size, "
                f"{KIND} AS kind FROM customer)")


def customer_files(spark, sf_dir):
    """The stored file of every customer's video."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as video_key", "c_name as name", "c_custkey * 1000 as size", "timestamp_seconds(c_custkey) as recorded_at")


def requests(spark, sf_dir):
    """Customers ask for a video each, and every event for its user's: 17 sizes and both kinds of one video."""
    own = own_requests(spark, sf_dir)
    again = table(spark, sf_dir, "events").selectExpr(
        "user_id as video_key", f"cast({OTHER_SIZE} as int) as bucket_size", f"{OTHER_KIND} as kind")
    return own.unionByName(again)


REQUESTS = (f"requests AS (SELECT c_custkey AS video_key, CAST(c_custkey % 300 - 10 AS INTEGER) AS bucket_size, "
            f"{KIND} AS kind FROM customer UNION ALL SELECT user_id, CAST({OTHER_SIZE} AS INTEGER), {OTHER_KIND} "
            "FROM events)")
ACCEPTED = ("accepted AS (SELECT DISTINCT video_key, bucket_size, CASE WHEN kind = 'average' THEN 'average' "
            "ELSE 'dominant' END AS kind FROM requests WHERE bucket_size BETWEEN 1 AND 255)")

# Request fields as a user may type them: numbers, signs, words, blanks or nothing.
TYPED_SIZE = ("CASE WHEN c_custkey % 17 = 0 THEN 'abc' WHEN c_custkey % 17 = 1 THEN '' WHEN c_custkey % 17 = 2 THEN '5.5' "
              "WHEN c_custkey % 17 = 3 THEN NULL WHEN c_custkey % 17 = 4 THEN '99999999999' "
              "ELSE CAST(c_custkey % 300 - 10 AS STRING) END")


def typed_requests(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"{TYPED_SIZE} as bucket_size")


def color_requests(spark, sf_dir, video=VIDEO):
    """Requests for the videos of line items: sizes 1, 16, 40 and one that is rejected, both kinds."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{video} as video_key", "element_at(array(1, 16, 40, 256), cast(l_partkey % 4 + 1 as int)) as bucket_size",
        "if(l_linenumber % 2 = 0, 'average', 'domiant') as kind").distinct()


def color_requests_sql(video=VIDEO):
    return (f"color_requests AS (SELECT DISTINCT {video} AS video_key, "
            "CAST(list_extract([1, 16, 40, 256], l_partkey % 4 + 1) AS INTEGER) AS bucket_size, "
            "CASE WHEN l_linenumber % 2 = 0 THEN 'average' ELSE 'dominant' END AS kind FROM lineitem), "
            "color_asked AS (SELECT * FROM color_requests WHERE bucket_size BETWEEN 1 AND 255)")


def file_log(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "event_type as directory", "cast(event_id as string) as path",
        "cast(date_trunc('HOUR', ts) as timestamp) as modified_at")


def blobs(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr("source as volume", "doc_id as seq", "n_chars as size")


def stored_colors(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{VIDEO} as video_key", "l_orderkey as frame_index", "cast(l_linenumber * 8 as int) as bucket_size",
        "if(l_linenumber % 2 = 0, 'average', 'dominant') as kind", *RGB)


STORED_COLORS = (f"stored_colors AS (SELECT {VIDEO} AS video_key, l_orderkey AS frame_index, "
                 "CAST(l_linenumber * 8 AS INTEGER) AS bucket_size, "
                 "CASE WHEN l_linenumber % 2 = 0 THEN 'average' ELSE 'dominant' END AS kind, "
                 f"{', '.join(RGB)} FROM lineitem)")


def averages_sql(px: str, size: int, name="averages", rounding="truncate"):
    """Average colour per frame, one row per channel."""
    value = ("sum((cnt * bucket) // pixels)" if rounding == "truncate" else "sum(cnt * bucket) // max(pixels)")
    return (
        f"{name}_counts AS (SELECT video_key, frame_index, channel, level - level % {size} AS bucket, count(*) AS cnt FROM "
        f"(SELECT video_key, frame_index, 'R' AS channel, r AS level FROM {px} "
        f"UNION ALL SELECT video_key, frame_index, 'G', g FROM {px} "
        f"UNION ALL SELECT video_key, frame_index, 'B', b FROM {px}) GROUP BY ALL), "
        f"{name}_hist AS (SELECT *, sum(cnt) OVER (PARTITION BY video_key, frame_index, channel) AS pixels "
        f"FROM {name}_counts), "
        f"{name} AS (SELECT video_key, frame_index, channel, CAST({value} AS INTEGER) AS value "
        f"FROM {name}_hist GROUP BY ALL)")


def channels_long(spark, sf_dir, frame=FRAME_24):
    """One row per frame and channel; every fifth frame lacks blue."""
    return average_color(pixels(spark, sf_dir, frame), 40).selectExpr(
        "video_key", "frame_index", "stack(3, 'R', r, 'G', g, 'B', b) as (channel, value)"
    ).filter(~((F.col("channel") == "B") & (F.col("frame_index") % 5 == 0)))


def channels_sql(px="px24"):
    return (averages_sql(px, 40) + ", channels AS (SELECT * FROM averages "
            "WHERE NOT (channel = 'B' AND frame_index % 5 = 0)), "
            "wide AS (SELECT video_key, frame_index, max(CASE channel WHEN 'R' THEN value END) AS r, "
            "max(CASE channel WHEN 'G' THEN value END) AS g, max(CASE channel WHEN 'B' THEN value END) AS b "
            "FROM channels GROUP BY ALL)")


def asked_colors_sql(px: str, asked: str, name="colors"):
    """Frame colours for (video_key, bucket_size, kind) requests; ``px`` has frames and channels."""
    frame = "video_key, frame_index, bucket_size"
    label = "'R ' || rb || ',G ' || gb || ',B ' || bb"
    return (
        f"{name}_px AS (SELECT p.video_key, frame_index, bucket_size, kind, r - r % bucket_size AS rb, "
        f"g - g % bucket_size AS gb, b - b % bucket_size AS bb FROM {px} p JOIN {asked} a ON p.video_key = a.video_key), "
        f"{name}_counts AS (SELECT {frame}, channel, bucket, count(*) AS cnt FROM ("
        f"SELECT {frame}, 'R' AS channel, rb AS bucket FROM {name}_px WHERE kind = 'average' UNION ALL "
        f"SELECT {frame}, 'G', gb FROM {name}_px WHERE kind = 'average' UNION ALL "
        f"SELECT {frame}, 'B', bb FROM {name}_px WHERE kind = 'average') GROUP BY ALL), "
        f"{name}_hist AS (SELECT *, sum(cnt) OVER (PARTITION BY {frame}, channel) AS pixels FROM {name}_counts), "
        f"{name}_avg AS (SELECT {frame}, channel, sum((cnt * bucket) // pixels) AS value FROM {name}_hist GROUP BY ALL), "
        f"{name}_joint AS (SELECT {frame}, rb, gb, bb, count(*) AS cnt, {label} AS label FROM {name}_px "
        "WHERE kind = 'dominant' GROUP BY ALL), "
        f"{name}_top AS (SELECT * FROM {name}_joint QUALIFY row_number() OVER "
        f"(PARTITION BY {frame} ORDER BY cnt DESC, label DESC) = 1), "
        f"{name} AS (SELECT {frame}, 'average' AS kind, CAST(max(CASE channel WHEN 'R' THEN value END) AS INTEGER) AS r, "
        "CAST(max(CASE channel WHEN 'G' THEN value END) AS INTEGER) AS g, "
        f"CAST(max(CASE channel WHEN 'B' THEN value END) AS INTEGER) AS b FROM {name}_avg GROUP BY {frame} UNION ALL "
        f"SELECT {frame}, 'dominant', CAST(rb AS INTEGER), CAST(gb AS INTEGER), CAST(bb AS INTEGER) FROM {name}_top)")


def sampled_sql(events="frame_events", name="sampled", interval=HOURS_6):
    return (
        f"{name}_slack AS (SELECT *, row_number() OVER w AS i, "
        f"(pts_us - min(pts_us) OVER (PARTITION BY video_key)) // {interval} + 1 - row_number() OVER w AS slack "
        f"FROM {events} WINDOW w AS (PARTITION BY video_key ORDER BY pts_us, seq)), "
        f"{name}_floor AS (SELECT *, min(slack) OVER (PARTITION BY video_key ORDER BY pts_us, seq "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lowest FROM {name}_slack), "
        f"{name} AS (SELECT video_key, stream_index, pts_us, seq, "
        "row_number() OVER (PARTITION BY video_key ORDER BY pts_us, seq) - 1 AS frame_no "
        f"FROM {name}_floor WHERE lowest IS NULL OR slack >= lowest)")


STRIP_KEYS = "video_key, bucket_size, kind"


def strip_sql(colors: str, name="strip"):
    return (
        f"{name} AS (SELECT {STRIP_KEYS}, row_number() OVER (PARTITION BY {STRIP_KEYS} "
        "ORDER BY (r IS NULL OR g IS NULL OR b IS NULL), frame_index) - 1 AS x, "
        "CASE WHEN r IS NULL OR g IS NULL OR b IS NULL THEN 0 ELSE (r << 16) | (g << 8) | b END AS rgb, "
        f"count(*) OVER (PARTITION BY {STRIP_KEYS}) AS width, "
        f"greatest(1, count(*) OVER (PARTITION BY {STRIP_KEYS}) // 4) AS height FROM {colors})")


def scaled_sql(strip="strip", name="scaled"):
    return (
        f"{name} AS (SELECT {STRIP_KEYS}, x * s + k AS x, rgb, width * s AS width, height * s AS height FROM "
        "(SELECT *, unnest(range(s)) AS k FROM (SELECT *, CASE WHEN width * (width // 5) < 8 THEN 200 "
        f"WHEN width * (width // 5) < 50 THEN 160 ELSE 1 END AS s FROM {strip})))")


def event_pixels(spark, sf_dir):
    """Pixels of picture events: line items belong to the event their order's number points at, going round all events."""
    events = table(spark, sf_dir, "events")
    owners = events.selectExpr("event_id as seq", "user_id as video_key")
    items = table(spark, sf_dir, "lineitem").selectExpr(f"l_orderkey % {max(events.count(), 1)} as seq", *RGB)
    return items.join(owners, "seq").select("video_key", "seq", "r", "g", "b")


EVENT_PIXELS = ("event_pixels AS (SELECT user_id AS video_key, event_id AS seq, "
                f"{', '.join(RGB)} FROM lineitem JOIN events ON l_orderkey % (SELECT count(*) FROM events) = event_id)")

CACHED_EXPR = ["user_id as video_key", "event_id as frame_index", "cast(event_id % 255 + 1 as int) as bucket_size",
               f"{BLOCK_KIND} as kind",
               "cast(event_id % 256 as int) as r", "cast(event_id * 3 % 256 as int) as g",
               "cast(event_id * 7 % 256 as int) as b"]


def cached_colors(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*CACHED_EXPR)


CACHED_COLORS = f"cached_colors AS (SELECT {', '.join(CACHED_EXPR)} FROM events)"


PICTURE_RGB = ["cast((r + p_partkey * 7) % 256 as int) as r", "cast((g + p_partkey * 13) % 256 as int) as g",
               "cast(p_partkey % 256 as int) as b"]


def pictures(spark, sf_dir):
    """A picture per part, all of whose pixels differ, as (name, x, y, rgb); parts of one size 1 a side are no usable picture."""
    rasters = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "concat(p_partkey, '.png') as name", "p_size % 10 + 1 as width", "p_size % 7 + 1 as height")
    return (gradient(rasters).drop("b", "rgb").selectExpr("name", "x", "y", *PICTURE_RGB)
            .select("name", "x", "y", pack_rgb().alias("rgb")))


def picture_requests(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(
        "p_brand as video_key", "element_at(array(1, 16, 40, 256), cast(p_partkey % 4 + 1 as int)) as bucket_size",
        "if(p_size % 2 = 0, 'average', 'domiant') as kind").distinct()


PICTURES = ("rasters AS (SELECT p_partkey, p_brand AS video_key, p_size % 10 + 1 AS width, p_size % 7 + 1 AS height, "
            "row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS frame_index FROM part), "
            "lines AS (SELECT *, unnest(range(height)) AS y FROM rasters WHERE width > 1 AND height > 1), "
            "places AS (SELECT *, unnest(range(width)) AS x FROM lines), "
            "ramps AS (SELECT *, y * 255 // (height - 1) AS r, x * 255 // (width - 1) AS g FROM places), "
            f"pictures AS (SELECT video_key, frame_index, {', '.join(PICTURE_RGB)} FROM ramps), "
            "picture_asked AS (SELECT DISTINCT p_brand AS video_key, CAST(list_extract([1, 16, 40, 256], p_partkey % 4 + 1) AS INTEGER) "
            "AS bucket_size, CASE WHEN p_size % 2 = 0 THEN 'average' ELSE 'dominant' END AS kind FROM part WHERE p_partkey % 4 < 3)")
