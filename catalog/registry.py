"""Every registered query with the SQL it is checked against (None where SQL cannot express it)."""

from pyspark.sql import functions as F

from catalog import inputs as i
from tintflow.functions import colour, naming
from tintflow.functions.requests import kind_choice, validate_requests
from tintflow.operators import color, filters, history, lookup, ordering, packing, sampling, strip
from tintflow.plans.analyze import analyze
from tintflow.plans.colors import frame_colors, frame_colors_from_files, image_frame_colors
from tintflow.plans.ingest import ingest
from tintflow.plans.store import commit, load
from tintflow.plans.strips import prefix_scan, video_strip
from tintflow.schemas import VIDEO_METADATA
from tintflow.session import new_folder
from tintflow.sources import files, images, manifests, ranges
from tintflow.sources import requests as request_files
from tintflow.streaming import sampler

QUERIES = {}
ORACLES = {}


def query(sql=None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run
    return register


def with_(*relations):
    return "WITH " + ", ".join(relations) + " "


# Sources and sinks -------------------------------------------------------------------------------------------------

LINES = ("texts AS (SELECT doc_id, regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\n|\\r)$', ''), '\\r\\n|\\n|\\r') "
         "AS lines FROM documents), all_lines AS (SELECT doc_id, lines[1] AS video_key, "
         "CAST(unnest(range(len(lines))) AS INTEGER) AS line_no, unnest(lines) AS path FROM texts), "
         "frame_lines AS (SELECT * FROM all_lines WHERE line_no > 0)")


def document_lines(spark, sf_dir):
    texts = i.table(spark, sf_dir, "documents").selectExpr("doc_id", "text as value")
    return manifests.manifest_lines(texts)


@query(with_(LINES) + "SELECT * FROM frame_lines")
def manifest_read(spark, sf_dir):
    return document_lines(spark, sf_dir)


def event_frames(spark, sf_dir):
    events = i.table(spark, sf_dir, "events").selectExpr("cast(user_id as string) as video_key", "event_id")
    numbered = ordering.frame_ordinals(events, ["video_key"], ["event_id"], first=0)
    return numbered.select(
        "video_key", F.col("frame_index").alias("frame_no"),
        naming.frame_path("Frames", "video_key", "video_key", "frame_index").alias("path"))


EVENT_FRAMES = ("event_frames AS (SELECT CAST(user_id AS VARCHAR) AS video_key, row_number() OVER "
                "(PARTITION BY user_id ORDER BY event_id) - 1 AS frame_no FROM events)")


@query(with_(EVENT_FRAMES) + "SELECT DISTINCT video_key, CAST(0 AS BIGINT) AS line_no, video_key AS value "
       "FROM event_frames UNION ALL SELECT video_key, frame_no + 1, 'Frames/' || video_key || '-' || video_key || "
       "'/' || video_key || frame_no || '.png' FROM event_frames")
def manifest_write(spark, sf_dir):
    return manifests.manifest_rows(event_frames(spark, sf_dir))


@query("SELECT page_id, 'getVideoRecord' AS command, url AS video_key, CAST(page_id % 255 + 1 AS VARCHAR) AS bucket_size, "
       "CASE WHEN page_id % 2 = 0 THEN 'average' ELSE 'domiant' END AS kind FROM pages")
def request_read(spark, sf_dir):
    texts = i.table(spark, sf_dir, "pages").selectExpr(
        "page_id", "concat_ws('\n', 'getVideoRecord', url, page_id % 255 + 1, "
                   "if(page_id % 2 = 0, 'average', 'domiant')) as value")
    return request_files.parse_requests(texts, "form")


@query("SELECT doc_id || '.ogg' AS name, CAST(strlen(text) AS BIGINT) AS size, sha256(text) AS digest FROM documents WHERE strlen(text) > 0")
def video_ingest(spark, sf_dir):
    """Every text stored as a file and read back as opaque bytes; files without bytes are not listed."""
    folder = new_folder(spark, "videos")
    texts = i.table(spark, sf_dir, "documents").selectExpr("concat(doc_id, '.ogg') as name", "cast(text as binary) as content")
    files.write_files(texts.filter("content is not null"), folder).write.format("noop").mode("overwrite").save()
    return files.read_videos(spark, folder).select("name", "size", F.sha2("content", 256).alias("digest"))


CONTAINER_BYTES, RANGE = 400_000, 30_000

STORED_SQL = f"""WITH RECURSIVE d AS (SELECT source AS volume, doc_id AS seq, CAST(strlen(text) AS BIGINT) AS size, text,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents),
  p AS (SELECT volume, seq, size, text, n, CAST(0 AS BIGINT) AS container_id, CAST(0 AS BIGINT) AS byte_offset FROM d WHERE n = 1
    UNION ALL SELECT d.volume, d.seq, d.size, d.text, d.n,
      CASE WHEN byte_offset + p.size > 0 AND byte_offset + p.size + d.size > {CONTAINER_BYTES} THEN container_id + 1 ELSE container_id END,
      CASE WHEN byte_offset + p.size > 0 AND byte_offset + p.size + d.size > {CONTAINER_BYTES} THEN 0 ELSE byte_offset + p.size END
    FROM p JOIN d ON d.volume = p.volume AND d.n = p.n + 1)"""


def stored_documents(spark, sf_dir):
    """The documents written one after the other into few large files, as containers hold videos; and where each lies."""
    folder = new_folder(spark, "containers")
    documents = i.table(spark, sf_dir, "documents").selectExpr(
        "source as volume", "doc_id as seq", "octet_length(text) as size", "cast(text as binary) as content")
    placed = packing.pack_containers(documents, cap=CONTAINER_BYTES).withColumn(
        "name", F.format_string("%s_%d.mp4", "volume", "container_id"))
    ranges.write_joined(placed.select("name", "byte_offset", "seq", "content"), folder, order=["byte_offset", "seq"]).write.format(
        "noop").mode("overwrite").save()
    return folder, placed.drop("content")


@query(STORED_SQL + f""", files AS (SELECT volume || '_' || container_id || '.mp4' AS name, encode(string_agg(text, '' ORDER BY seq)) AS content
    FROM p GROUP BY ALL),
  parts AS (SELECT name, content, unnest(range(greatest(1, (octet_length(content) + {RANGE - 1}) // {RANGE}))) AS part FROM files)
  SELECT name, CAST(any_value(octet_length(content)) AS BIGINT) AS bytes, count(*) AS ranges,
    sha256(string_agg(sha256(array_slice(content, part * {RANGE} + 1, (part + 1) * {RANGE})), '' ORDER BY part)) AS digest
  FROM parts GROUP BY name""")
def container_ingest(spark, sf_dir):
    """Large files read back in ranges by many tasks."""
    folder, _ = stored_documents(spark, sf_dir)
    return ranges.read_files(spark, folder, range_bytes=RANGE).drop("path")


@query(STORED_SQL + """ SELECT volume, seq, container_id, byte_offset, size AS bytes, sha256(sha256(text)) AS digest FROM p""")
def container_read(spark, sf_dir):
    """Every stored document read back from its place in its container."""
    folder, placed = stored_documents(spark, sf_dir)
    files = placed.withColumn("path", F.concat(F.lit(folder + "/"), "name"))
    found = ranges.fold_ranges(ranges.range_digests(ranges.split_ranges(files)), ["volume", "seq", "container_id", "byte_offset"])
    return found.drop("ranges")


@query("SELECT event_type AS directory, CAST(event_id AS VARCHAR) AS path, epoch_us(date_trunc('hour', ts)) AS modified_us "
       "FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('hour', ts) DESC, "
       "CAST(event_id AS VARCHAR)) = 1")
def latest_file(spark, sf_dir):
    return files.latest_file(i.file_log(spark, sf_dir), ["directory"])


VIDEO_WRITES = [
    "user_id as video_key", "event_type as name", "concat('http://v/', user_id, '.ogg') as hyperlink",
    "case when event_id % 3 <> 0 then concat('video_', event_id % 7, '.mp4') end as path",
    "event_id * 10 as byte_offset", "case when event_id % 5 <> 0 then event_id * 3 end as filesize"]


def _latest_cell(name):
    return f"last({name} ORDER BY ts, event_id) FILTER (WHERE {name} IS NOT NULL) AS {name}"


@query(f"WITH writes AS (SELECT ts, event_id, {', '.join(VIDEO_WRITES)} FROM events) SELECT video_key, "
       + ", ".join(_latest_cell(c) for c in history.VIDEO_CELLS) + " FROM writes GROUP BY video_key")
def video_metadata_upsert(spark, sf_dir):
    events = i.table(spark, sf_dir, "events")
    writes = events.selectExpr(*VIDEO_WRITES, "cast(ts as timestamp) as recorded_at", "event_id as seq")
    return history.merge_video_metadata(writes.filter("seq % 2 = 0"), writes.filter("seq % 2 = 1"))


FRAME_WRITE_SEQ = ("(((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100 "
                   "+ cast(l_quantity as int)")


@query(with_(f"writes AS (SELECT {i.VIDEO} AS video_key, l_orderkey % 24 + 1 AS frame_index, 40 AS bucket_size, "
             f"l_shipdate AS recorded_at, {FRAME_WRITE_SEQ} AS seq, {', '.join(i.RGB)} FROM lineitem)",
             "kinds AS (SELECT *, 'average' AS kind FROM writes UNION ALL SELECT * REPLACE (b AS r, r AS b), "
             "'dominant' FROM writes)")
       + "SELECT video_key, frame_index, bucket_size, kind, r, g, b FROM kinds QUALIFY row_number() OVER "
         "(PARTITION BY video_key, frame_index, bucket_size, kind ORDER BY recorded_at DESC, seq DESC) = 1")
def frame_color_upsert(spark, sf_dir):
    writes = i.table(spark, sf_dir, "lineitem").selectExpr(
        f"{i.VIDEO} as video_key", "l_orderkey % 24 + 1 as frame_index", "40 as bucket_size",
        "l_shipdate as recorded_at", f"{FRAME_WRITE_SEQ} as seq", *i.RGB,
    ).selectExpr("* except (r, g, b)", "concat_ws(';', r, g, b) as average", "concat_ws(';', b, g, r) as dominant")
    typed = history.split_addressed_triples(writes)
    merged = history.merge_frame_colors(typed.filter("seq % 2 = 0"), typed.filter("seq % 2 = 1"))
    return merged.drop("recorded_at", "seq")


@query("SELECT page_id, url FROM pages WHERE url LIKE 'http://%' ORDER BY url, page_id")
def prefix_scan_(spark, sf_dir):
    return prefix_scan(i.table(spark, sf_dir, "pages").select("page_id", "url"), "url", "http://", "page_id")


def strip_of(pixels):
    return strip.strip_scale(strip.color_strip(color.dominant_color(pixels, 40)))


def strip_of_sql(relation, name):
    return [relation, f"asked AS (SELECT DISTINCT video_key, 40 AS bucket_size, 'dominant' AS kind FROM {name})",
            i.asked_colors_sql(name, "asked"), i.strip_sql("colors"), i.scaled_sql()]


SUPPLIER_STRIP = strip_of_sql(i.SUPPLIER_PX, "supplier_px")
STRIP_FILE = "^.*/([^/-]*)-[0-9A-F]+-[a-z]+-[0-9]+-[0-9]+-[0-9]+[.]png$"


def exported(spark, sf_dir, *, tile=images.TILE):
    """Strips of the suppliers' videos, written as PNG files by the executors."""
    folder = new_folder(spark, "strips")
    tiles = images.strip_png(strip_of(i.supplier_pixels(spark, sf_dir)), tile=tile)
    return folder, images.write_png(tiles, folder)


def exported_images(spark, sf_dir):
    folder, written = exported(spark, sf_dir)
    written.write.format("noop").mode("overwrite").save()
    return images.read_images(spark, folder).withColumn("video_key", F.regexp_extract("path", STRIP_FILE, 1))


@query(with_(*SUPPLIER_STRIP) + "SELECT DISTINCT video_key, bucket_size, kind, CAST(0 AS BIGINT) AS tile_x, "
       "CAST(0 AS BIGINT) AS tile_y, CAST(width AS INTEGER) AS width, CAST(height AS INTEGER) AS height FROM scaled")
def strip_png(spark, sf_dir):
    _, written = exported(spark, sf_dir)
    return written.drop("name", "path")


@query(with_(*SUPPLIER_STRIP) + "SELECT video_key, CAST(width AS INTEGER) AS width, CAST(height AS INTEGER) AS height, "
       "rgb >> 16 AS r, (rgb >> 8) & 255 AS g, rgb & 255 AS b, CAST(sum(height) AS BIGINT) AS weight "
       "FROM scaled GROUP BY ALL")
def frame_image_scan(spark, sf_dir):
    counted = images.image_color_counts(exported_images(spark, sf_dir))
    return counted.select(F.regexp_extract("path", STRIP_FILE, 1).alias("video_key"), "width", "height", "r", "g", "b", "weight")


@query(with_(*SUPPLIER_STRIP) + "SELECT video_key, x, unnest(range(height)) AS y, rgb >> 16 AS r, "
       "(rgb >> 8) & 255 AS g, rgb & 255 AS b FROM scaled")
def image_pixels(spark, sf_dir):
    flat = images.image_pixels(exported_images(spark, sf_dir))
    return flat.select(F.regexp_extract("path", STRIP_FILE, 1).alias("video_key"), "x", "y", "r", "g", "b")


@query(with_(*SUPPLIER_STRIP, "raster AS (SELECT video_key, CAST(1 AS BIGINT) AS frame_index, rgb >> 16 AS r, "
             "(rgb >> 8) & 255 AS g, rgb & 255 AS b FROM (SELECT *, unnest(range(height)) FROM scaled))",
             i.color_requests_sql(i.SUPPLIER), i.asked_colors_sql("raster", "color_asked", "found")) + "SELECT * FROM found")
def image_colors(spark, sf_dir):
    """Colours of the exported strips, each taken as a one-frame video."""
    pictures = exported_images(spark, sf_dir)
    frames = pictures.select("video_key", F.lit(1).cast("long").alias("frame_index"), "path")
    return image_frame_colors(frames, pictures.drop("video_key"), i.color_requests(spark, sf_dir, i.SUPPLIER))


@query(with_(i.PICTURES, i.asked_colors_sql("pictures", "picture_asked", "found")) + "SELECT * FROM found")
def frame_colors_from_files_(spark, sf_dir):
    """Colours from stored manifests and images: the pictures of a brand's parts, in the order of their numbers, are its video."""
    folder = new_folder(spark, "clips")
    drawn = images.write_png(images.picture_png(i.pictures(spark, sf_dir)), f"{folder}/Frames")
    drawn.write.format("noop").mode("overwrite").save()
    parts = i.table(spark, sf_dir, "part").select(F.col("p_brand").alias("video_key"), "p_partkey")
    manifests.write_manifests(
        ordering.number_rows(parts, ["video_key"], ["p_partkey"], number="frame_no").select(
            "video_key", F.col("frame_no") - 1, F.format_string(f"{folder}/Frames/%d.png", "p_partkey")).toDF("video_key", "frame_no", "path"),
        f"{folder}/manifests")
    return frame_colors_from_files(spark, f"{folder}/manifests", f"{folder}/Frames", i.picture_requests(spark, sf_dir), per_directory=True)


# Scalar functions --------------------------------------------------------------------------------------------------

@query(with_(i.PX) + "SELECT video_key, frame_index, r - r % 40 AS r40, (g // 7) * 7 AS g7, (b // 1) * 1 AS b1 FROM px")
def bucketize(spark, sf_dir):
    return i.pixels(spark, sf_dir).select(
        "video_key", "frame_index", colour.bucketize("r", 40).alias("r40"), colour.bucketize("g", 7).alias("g7"),
        colour.bucketize("b", 1).alias("b1"))


PACKED = "cast((l_partkey * 7919 + l_suppkey * 104729) % 16777216 as int)"


@query(f"WITH p AS (SELECT {PACKED} AS rgb FROM lineitem) SELECT rgb, rgb // 65536 AS r, rgb // 256 % 256 AS g, "
       "rgb % 256 AS b FROM p")
def rgb_unpack(spark, sf_dir):
    packed = i.table(spark, sf_dir, "lineitem").selectExpr(f"{PACKED} as rgb")
    return packed.select("rgb", *[c.alias(n) for n, c in colour.unpack_rgb("rgb").items()])


@query(with_(i.PX) + "SELECT r, g, b, r * 65536 + g * 256 + b AS rgb FROM px")
def rgb_pack(spark, sf_dir):
    return i.pixels(spark, sf_dir).select("r", "g", "b", colour.pack_rgb().alias("rgb"))


KEYED = "l_partkey * l_partkey * l_linenumber % 3000000"


@query(f"WITH k AS (SELECT l_returnflag, {KEYED} AS n FROM lineitem) SELECT n, l_returnflag || '_' || lpad(CAST(n AS "
       "VARCHAR), 7, '0') AS key, l_returnflag || '_' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 7, '0') "
       "WHEN n < 100000 THEN lpad(CAST(n AS VARCHAR), 6, '0') ELSE CAST(n AS VARCHAR) END AS compat_key FROM k")
def frame_key(spark, sf_dir):
    keyed = i.table(spark, sf_dir, "lineitem").selectExpr("l_returnflag", f"{KEYED} as n")
    return keyed.select("n", naming.frame_key("l_returnflag", "n").alias("key"),
                        naming.frame_key("l_returnflag", "n", compat=True).alias("compat_key"))


@query(with_(i.PX) + "SELECT concat_ws(';', r, g, b) AS triple, r, g, b FROM px")
def triple_parse(spark, sf_dir):
    triples = i.pixels(spark, sf_dir).selectExpr("concat_ws(';', r, g, b) as triple")
    return triples.select("triple", *[c.alias(n) for n, c in colour.parse_triple("triple").items()])


@query("SELECT page_id, list_extract(string_split(rtrim(url, '/'), '/'), -1) AS name, list_extract(string_split(rtrim("
       "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/'), -1) AS path_name FROM pages")
def url_basename(spark, sf_dir):
    return i.table(spark, sf_dir, "pages").select(
        "page_id", naming.url_basename("url").alias("name"),
        naming.url_basename("url", path_only=True).alias("path_name"))


@query("SELECT page_id, regexp_extract(list_extract(string_split(rtrim(url, '/'), '/'), -1), '^[^.]*') AS stem FROM pages")
def url_stem(spark, sf_dir):
    return i.table(spark, sf_dir, "pages").select(
        "page_id", naming.stem(naming.url_basename("url")).alias("stem"))


def _slug_sql(ts):
    return (f"translate(regexp_replace(strftime({ts}, '%Y-%m-%d %H:%M:%S.%g'), '(\\.\\d+?)0*$', '\\1'), "
            "': .', '---')")


@query(f"SELECT event_id AS id, 'event' AS origin, {_slug_sql('ts')} AS slug FROM events UNION ALL "
       f"SELECT o_orderkey, 'order', {_slug_sql('o_orderdate')} FROM orders")
def timestamp_slug(spark, sf_dir):
    times = i.table(spark, sf_dir, "events").selectExpr("event_id as id", "'event' as origin", "ts").unionByName(
        i.table(spark, sf_dir, "orders").selectExpr("o_orderkey as id", "'order' as origin", "o_orderdate as ts"))
    return times.select("id", "origin", naming.timestamp_slug("ts").alias("slug"))


@query("SELECT p_partkey, replace(replace(replace(p_name || '(' || p_size || '%)', '(', ''), ')', ''), '%', '') "
       "AS name FROM part")
def clean_name(spark, sf_dir):
    names = i.table(spark, sf_dir, "part").selectExpr("p_partkey", "concat(p_name, '(', p_size, '%)') as name")
    return names.select("p_partkey", naming.clean_name("name").alias("name"))


@query(with_(i.REQUESTS) + "SELECT video_key, bucket_size, CASE kind WHEN 'average' THEN 'average' ELSE 'dominant' END "
       "AS kind FROM requests")
def kind_choice_(spark, sf_dir):
    return i.requests(spark, sf_dir).withColumn("kind", kind_choice("kind"))


@query(with_(i.PX) + ", l AS (SELECT r - r % 10 AS rb, g - g % 10 AS gb, b - b % 10 AS bb FROM px) "
       "SELECT rb AS r, gb AS g, bb AS b, 'R ' || rb || ',G ' || gb || ',B ' || bb AS label FROM l")
def bucket_label(spark, sf_dir):
    labels = i.pixels(spark, sf_dir).select(
        colour.bucket_label(*[colour.bucketize(c, 10) for c in "rgb"]).alias("label"))
    return labels.select("label", *[c.alias(n) for n, c in colour.parse_bucket_label("label").items()])


@query("SELECT p_partkey, 'Frames/' || p_brand || '-' || p_type || '/' || p_brand || p_partkey || '.png' AS path FROM part")
def frame_path(spark, sf_dir):
    return i.table(spark, sf_dir, "part").select(
        "p_partkey", naming.frame_path("Frames", "p_brand", "p_type", "p_partkey").alias("path"))


@query(f"WITH typed AS (SELECT c_custkey, {i.TYPED_SIZE} AS t FROM customer), checked AS (SELECT c_custkey, "
       "CASE WHEN t IS NULL THEN 'missing' WHEN NOT regexp_full_match(t, '[+-]?[0-9]+') THEN 'not a number' "
       "WHEN NOT TRY_CAST(t AS BIGINT) BETWEEN 1 AND 255 THEN 'out of range' END AS reject_reason, t FROM typed) "
       "SELECT c_custkey, reject_reason, CASE WHEN reject_reason IS NULL THEN TRY_CAST(t AS INTEGER) END AS bucket_size "
       "FROM checked")
def request_validate(spark, sf_dir):
    return validate_requests(i.typed_requests(spark, sf_dir))


# Filters -----------------------------------------------------------------------------------------------------------

@query(with_(i.FRAME_DIMS) + "SELECT * FROM frame_dims WHERE width > 1 AND height > 1")
def valid_images(spark, sf_dir):
    return filters.valid_images(i.frame_dims(spark, sf_dir))


@query(with_(LINES) + "SELECT * FROM frame_lines WHERE contains(path, 'the')")
def manifest_filter(spark, sf_dir):
    return filters.manifest_filter(document_lines(spark, sf_dir), token="the")


@query(with_(i.STORED_COLORS) + "SELECT * FROM stored_colors WHERE kind = 'dominant'")
def kind_filter(spark, sf_dir):
    return filters.kind_filter(i.stored_colors(spark, sf_dir), "dominant")


@query(with_(i.FRAME_EVENTS) + ", s AS (SELECT *, first_value(stream_index) OVER (PARTITION BY video_key ORDER BY seq) "
       "AS f FROM frame_events) SELECT video_key, stream_index, pts_us, seq FROM s WHERE stream_index = f")
def first_stream(spark, sf_dir):
    return sampling.first_stream(i.frame_events(spark, sf_dir))


@query(with_(i.PX24, i.channels_sql()) + "SELECT video_key, frame_index FROM channels GROUP BY ALL "
       "HAVING count(DISTINCT channel) = 3")
def complete_frames(spark, sf_dir):
    return filters.complete_frames(i.channels_long(spark, sf_dir))


# Lookup ------------------------------------------------------------------------------------------------------------

# Requests name a kind as typed.
SAME_KIND = "CASE r.kind WHEN 'average' THEN 'average' ELSE 'dominant' END"
KNOWN = with_(i.REQUESTS, i.VIDEO_BLOCKS, i.KEPT_BLOCKS)


def kept_blocks(spark, sf_dir):
    return history.last_versions(i.video_blocks(spark, sf_dir), ["video_key"])


@query(KNOWN + "SELECT DISTINCT * FROM requests WHERE video_key IN (SELECT video_key FROM video_blocks)")
def known_requests(spark, sf_dir):
    return lookup.known_requests(i.requests(spark, sf_dir), i.video_blocks(spark, sf_dir))


@query(KNOWN + "SELECT DISTINCT * FROM requests WHERE video_key NOT IN (SELECT video_key FROM video_blocks)")
def unknown_requests(spark, sf_dir):
    return lookup.unknown_requests(i.requests(spark, sf_dir), i.video_blocks(spark, sf_dir))


@query(KNOWN + "SELECT DISTINCT r.*, EXISTS (SELECT 1 FROM kept_blocks k WHERE k.video_key = r.video_key "
       f"AND k.bucket_size = r.bucket_size AND k.kind = {SAME_KIND}) AS analyzed FROM requests r")
def analyzed_flag(spark, sf_dir):
    return lookup.analyzed_flag(i.requests(spark, sf_dir), kept_blocks(spark, sf_dir))


ROUTE = ("CASE WHEN video_key NOT IN (SELECT video_key FROM video_blocks) THEN 'ingest' "
         "WHEN EXISTS (SELECT 1 FROM kept_blocks k WHERE k.video_key = r.video_key "
         f"AND k.bucket_size = r.bucket_size AND k.kind = {SAME_KIND}) THEN 'show' ELSE 'analyze' END AS action")


@query(KNOWN + f"SELECT DISTINCT r.*, {ROUTE} FROM requests r")
def route_requests(spark, sf_dir):
    blocks = i.video_blocks(spark, sf_dir)
    return lookup.route_requests(i.requests(spark, sf_dir), blocks, kept_blocks(spark, sf_dir))


# Aggregations ------------------------------------------------------------------------------------------------------

@query(with_(i.PX) + "SELECT video_key, frame_index, count(*) AS pixels FROM px GROUP BY ALL")
def pixel_count(spark, sf_dir):
    return color.pixel_count(i.pixels(spark, sf_dir))


@query(with_(i.PX, i.averages_sql("px", 40)) + "SELECT video_key, frame_index, channel, bucket, cnt FROM averages_hist")
def channel_histogram(spark, sf_dir):
    return color.channel_histogram(i.pixels(spark, sf_dir), 40)


@query(with_(i.PX, i.averages_sql("px", 40)) + "SELECT video_key, frame_index, channel, bucket, cnt, "
       "CAST(pixels AS BIGINT) AS pixels, CAST(cnt AS DOUBLE) / CAST(pixels AS DOUBLE) AS share, "
       "CAST(cnt AS DOUBLE) / CAST(pixels AS DOUBLE) * bucket AS contribution FROM averages_hist")
def bucket_share(spark, sf_dir):
    return color.bucket_share(i.pixels(spark, sf_dir), 40)


def _average_sql(rounding):
    return (with_(i.PX, i.averages_sql("px", 40, rounding=rounding))
            + "SELECT video_key, frame_index, max(CASE channel WHEN 'R' THEN value END) AS r, max(CASE channel WHEN 'G' "
              "THEN value END) AS g, max(CASE channel WHEN 'B' THEN value END) AS b FROM averages GROUP BY ALL")


@query(_average_sql("truncate"))
def average_color(spark, sf_dir):
    return color.average_color(i.pixels(spark, sf_dir), 40).drop("bucket_size", "kind")


@query(_average_sql("exact"))
def average_color_exact(spark, sf_dir):
    return color.average_color(i.pixels(spark, sf_dir), 40, rounding="exact").drop("bucket_size", "kind")


JOINT = ("joint AS (SELECT video_key, frame_index, r - r % 40 AS rb, g - g % 40 AS gb, b - b % 40 AS bb, count(*) AS cnt "
         "FROM px GROUP BY ALL)")


@query(with_(i.PX, JOINT) + "SELECT * FROM joint")
def joint_histogram(spark, sf_dir):
    return color.joint_histogram(i.pixels(spark, sf_dir), 40)


@query(with_(i.PX, JOINT) + "SELECT video_key, frame_index, rb AS r, gb AS g, bb AS b FROM joint QUALIFY row_number() "
       "OVER (PARTITION BY video_key, frame_index ORDER BY cnt DESC, 'R ' || rb || ',G ' || gb || ',B ' || bb DESC) = 1")
def dominant_color(spark, sf_dir):
    return color.dominant_color(i.pixels(spark, sf_dir), 40).drop("bucket_size", "kind")


@query(with_(i.STORED_COLORS) + "SELECT video_key, count(*) AS frames FROM stored_colors GROUP BY ALL")
def frame_count(spark, sf_dir):
    return color.frame_count(i.stored_colors(spark, sf_dir))


@query("SELECT source AS volume, CAST(sum(n_chars) AS BIGINT) AS bytes, count(*) AS files FROM documents GROUP BY ALL")
def byte_totals(spark, sf_dir):
    return color.byte_totals(i.blobs(spark, sf_dir), ["volume"], "size")


@query(with_(i.PX24, i.channels_sql()) + "SELECT * FROM wide")
def channel_pivot(spark, sf_dir):
    return color.channel_pivot(i.channels_long(spark, sf_dir))


# Ordered work ------------------------------------------------------------------------------------------------------

SAMPLED = with_(i.FRAME_EVENTS, i.sampled_sql()) + "SELECT * FROM sampled"


@query(SAMPLED)
def sample_frames(spark, sf_dir):
    return sampling.sample_frames(i.frame_events(spark, sf_dir), interval_us=i.HOURS_6)


@query(SAMPLED)
def sample_frames_stream(spark, sf_dir):
    """The events arrive in three micro-batches, one after the other in time, so that state is carried.

    Each third is written as it is partitioned and taken by one run of the stream, which goes on where the last one ended.
    """
    arrived, out, state = (new_folder(spark, name) for name in ("arrived", "sampled", "sampled-state"))
    events = i.frame_events(spark, sf_dir)
    first, second = events.approxQuantile("pts_us", [1 / 3, 2 / 3], 0.01) or [0, 0]
    later, last = F.coalesce(F.col("pts_us") > first, F.lit(False)), F.coalesce(F.col("pts_us") > second, F.lit(False))
    for part in (~later, later & ~last, last):
        events.filter(part).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(events.schema).parquet(arrived)
        sampled = sampler.sample_frames_stream(stream, interval_us=i.HOURS_6, first_stream_only=False)
        (sampled.writeStream.outputMode("append").option("checkpointLocation", state).trigger(availableNow=True)
         .format("parquet").start(out).awaitTermination())
    return spark.read.parquet(out)


@query(with_(LINES) + "SELECT doc_id, video_key, line_no, path, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) "
       "AS frame_index FROM frame_lines WHERE contains(path, 'the')")
def frame_ordinal(spark, sf_dir):
    usable = filters.manifest_filter(document_lines(spark, sf_dir), token="the")
    return ordering.frame_ordinals(usable, ["doc_id"], ["line_no"])


@query(with_(i.VIDEO_BLOCKS, i.KEPT_BLOCKS) + "SELECT * FROM kept_blocks")
def last_versions(spark, sf_dir):
    return kept_blocks(spark, sf_dir)


PACKING_CAP = 20_000


PACKED_SQL = f"""WITH RECURSIVE d AS (SELECT source AS volume, doc_id AS seq, n_chars AS size,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents),
  p AS (SELECT volume, seq, size, n, CAST(0 AS BIGINT) AS container_id, CAST(0 AS BIGINT) AS byte_offset FROM d WHERE n = 1
    UNION ALL SELECT d.volume, d.seq, d.size, d.n,
      CASE WHEN byte_offset + p.size > 0 AND byte_offset + p.size + d.size > {PACKING_CAP}
        THEN container_id + 1 ELSE container_id END,
      CASE WHEN byte_offset + p.size > 0 AND byte_offset + p.size + d.size > {PACKING_CAP}
        THEN 0 ELSE byte_offset + p.size END
    FROM p JOIN d ON d.volume = p.volume AND d.n = p.n + 1)
  SELECT volume, seq, size, container_id, byte_offset FROM p"""


@query(PACKED_SQL)
def pack_containers(spark, sf_dir):
    return packing.pack_containers(i.blobs(spark, sf_dir), cap=PACKING_CAP)


@query(PACKED_SQL)
def append_containers(spark, sf_dir):
    """Packing the later documents onto the earlier ones gives what packing all at once gives."""
    numbered = ordering.number_rows(i.blobs(spark, sf_dir), ["volume"], ["seq"], total="files")
    earlier = numbered.filter("2 * row_no <= files").drop("row_no", "files")
    later = numbered.filter("2 * row_no > files").drop("row_no", "files")
    first = packing.pack_containers(earlier, cap=PACKING_CAP)
    second = packing.pack_containers(later, cap=PACKING_CAP, opened=packing.open_containers(first))
    return first.unionByName(second)


@query(with_(i.VIDEO_BLOCKS) + "SELECT * FROM video_blocks QUALIFY row_number() OVER "
       "(PARTITION BY video_key ORDER BY recorded_at DESC, seq DESC) = 1")
def latest_record(spark, sf_dir):
    return history.latest_record(i.video_blocks(spark, sf_dir), ["video_key"])


@query(with_(i.STORED_COLORS) + "SELECT * FROM stored_colors ORDER BY video_key, frame_index")
def ordered_frames(spark, sf_dir):
    return ordering.ordered_frames(i.stored_colors(spark, sf_dir))


INGEST_CAP = 100_000


@query(f"""WITH RECURSIVE d AS (SELECT 'http://' || source || '/' || doc_id || '.ogg' AS video_key, doc_id || '.ogg' AS name,
    n_chars AS size, row_number() OVER (ORDER BY doc_id) AS n FROM documents),
  p AS (SELECT *, CAST(0 AS BIGINT) AS container, CAST(0 AS BIGINT) AS byte_offset FROM d WHERE n = 1
    UNION ALL SELECT d.*,
      CASE WHEN byte_offset + p.size > 0 AND byte_offset + p.size + d.size > {INGEST_CAP}
        THEN container + 1 ELSE container END,
      CASE WHEN byte_offset + p.size > 0 AND byte_offset + p.size + d.size > {INGEST_CAP}
        THEN 0 ELSE byte_offset + p.size END
    FROM p JOIN d ON d.n = p.n + 1)
  SELECT video_key, name, video_key AS hyperlink, 'videos/video_' || container || '.mp4' AS path, byte_offset,
    size AS filesize FROM p""")
def ingest_videos(spark, sf_dir):
    """The documents as stored videos: the earlier half, then all of them, of which only the later half is new."""
    videos = i.table(spark, sf_dir, "documents").selectExpr(
        "concat('http://', source, '/', doc_id, '.ogg') as video_key", "concat(doc_id, '.ogg') as name",
        "n_chars as size", "timestamp_seconds(doc_id) as recorded_at")
    halves = ordering.number_rows(videos.withColumn("volume", F.lit("videos")), ["volume"], ["recorded_at"], total="files")
    earlier = halves.filter("2 * row_no <= files").select(videos.columns)
    first = ingest(earlier, spark.createDataFrame([], VIDEO_METADATA), cap=INGEST_CAP)
    return first.unionByName(ingest(videos, first, cap=INGEST_CAP)).drop("recorded_at", "seq")


# Strips ------------------------------------------------------------------------------------------------------------

def incomplete_strip(spark, sf_dir):
    """Average strips of the 24-frame videos, where every fifth frame lacks blue."""
    wide = color.channel_pivot(i.channels_long(spark, sf_dir))
    return strip.color_strip(wide.selectExpr("*", "40 as bucket_size", "'average' as kind"))


INCOMPLETE = [i.PX24, i.channels_sql(), "keyed AS (SELECT *, 40 AS bucket_size, 'average' AS kind FROM wide)",
              i.strip_sql("keyed")]


@query(with_(*INCOMPLETE) + "SELECT * FROM strip")
def color_strip(spark, sf_dir):
    return incomplete_strip(spark, sf_dir)


@query(with_(*strip_of_sql(i.PX12, "px12")) + "SELECT * FROM scaled")
def strip_scale(spark, sf_dir):
    return strip_of(i.pixels(spark, sf_dir, i.FRAME_12))


@query(with_(*INCOMPLETE) + "SELECT *, unnest(range(height)) AS y FROM strip")
def strip_raster(spark, sf_dir):
    return strip.strip_raster(incomplete_strip(spark, sf_dir))


@query("WITH d AS (SELECT p_partkey, p_size % 10 + 1 AS width, p_size % 7 + 1 AS height FROM part), "
       "ys AS (SELECT *, unnest(range(height)) AS y FROM d), p AS (SELECT *, unnest(range(width)) AS x FROM ys), "
       "c AS (SELECT *, CAST(y * 255 // greatest(height - 1, 1) AS INTEGER) AS r, "
       "CAST(x * 255 // greatest(width - 1, 1) AS INTEGER) AS g, 128 AS b FROM p) "
       "SELECT p_partkey, width, height, x, y, r, g, b, r * 65536 + g * 256 + b AS rgb FROM c")
def gradient(spark, sf_dir):
    rasters = i.table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_size % 10 + 1 as width", "p_size % 7 + 1 as height")
    return strip.gradient(rasters)


# Composites --------------------------------------------------------------------------------------------------------

ASKED_COLORS = [i.PX, i.color_requests_sql(), i.asked_colors_sql("px", "color_asked")]


@query(with_(*ASKED_COLORS) + "SELECT * FROM colors")
def frame_colors_(spark, sf_dir):
    return frame_colors(i.pixels(spark, sf_dir), i.color_requests(spark, sf_dir))


@query(with_(*ASKED_COLORS, i.strip_sql("colors"), i.scaled_sql()) + "SELECT * FROM scaled")
def video_strip_(spark, sf_dir):
    return video_strip(frame_colors(i.pixels(spark, sf_dir), i.color_requests(spark, sf_dir)))


@query(with_(i.REQUESTS, i.ACCEPTED, i.VIDEO_BLOCKS, i.KEPT_BLOCKS, i.FRAME_EVENTS, i.EVENT_PIXELS, i.CACHED_COLORS,
             f"routed AS (SELECT r.*, {ROUTE} FROM accepted r)",
             "work AS (SELECT video_key, bucket_size, kind FROM routed WHERE action <> 'show')",
             "open_events AS (SELECT * FROM frame_events WHERE video_key IN (SELECT video_key FROM work) "
             "QUALIFY stream_index = first_value(stream_index) OVER (PARTITION BY video_key ORDER BY seq))",
             i.sampled_sql("open_events"),
             "frame_px AS (SELECT p.video_key, s.frame_no + 1 AS frame_index, r, g, b FROM event_pixels p "
             "JOIN sampled s ON p.video_key = s.video_key AND p.seq = s.seq)",
             i.asked_colors_sql("frame_px", "work", "fresh"),
             "results AS (SELECT video_key, frame_index, bucket_size, kind, r, g, b FROM fresh UNION ALL "
             "SELECT c.video_key, c.frame_index, c.bucket_size, c.kind, c.r, c.g, c.b FROM cached_colors c JOIN routed q "
             "ON c.video_key = q.video_key AND c.bucket_size = q.bucket_size AND c.kind = q.kind "
             "WHERE action = 'show')",
             i.strip_sql("results"), i.scaled_sql())
       + "SELECT * FROM scaled")
def analyze_(spark, sf_dir):
    blocks = i.video_blocks(spark, sf_dir)
    done = analyze(i.requests(spark, sf_dir), blocks, blocks, i.frame_events(spark, sf_dir),
                   i.event_pixels(spark, sf_dir), i.cached_colors(spark, sf_dir), interval_us=i.HOURS_6)
    return done.strips


def _run_sql(name: str, events: str, interval: int):
    """Sampled pictures and colours of a run over all accepted requests."""
    return (f"{i.sampled_sql(events, f'{name}_sampled', interval)}, "
            f"{name}_frames AS (SELECT p.video_key, s.frame_no + 1 AS frame_index, r, g, b FROM event_pixels p "
            f"JOIN {name}_sampled s ON p.video_key = s.video_key AND p.seq = s.seq), "
            + i.asked_colors_sql(f"{name}_frames", "accepted", name))


def _drawn_sql(run: int, action: str, colors: str):
    """One row per request: what it needed and a digest of its strip."""
    name = f"run{run}"
    return (f"{i.strip_sql(colors, f'{name}_strip')}, {i.scaled_sql(f'{name}_strip', f'{name}_scaled')}, "
            f"{name} AS (SELECT CAST({run} AS INTEGER) AS run, a.*, {action} AS action, s.width, s.height, s.checksum FROM accepted a "
            f"LEFT JOIN (SELECT {i.STRIP_KEYS}, max(width) AS width, max(height) AS height, "
            f"CAST(sum((x + 1) * (CAST(rgb AS BIGINT) + 1)) AS BIGINT) AS checksum FROM {name}_scaled GROUP BY ALL) s "
            "ON a.video_key = s.video_key AND a.bucket_size = s.bucket_size AND a.kind = s.kind)")


@query(with_(i.OWN_REQUESTS, i.ACCEPTED, i.FRAME_EVENTS, i.EVENT_PIXELS,
             "open_events AS (SELECT * FROM frame_events WHERE video_key IN (SELECT video_key FROM accepted) "
             "QUALIFY stream_index = first_value(stream_index) OVER (PARTITION BY video_key ORDER BY seq))",
             _run_sql("six", "open_events", i.HOURS_6), _run_sql("twelve", "open_events", 2 * i.HOURS_6),
             f"kept_colors AS (SELECT * FROM twelve UNION ALL SELECT * FROM six WHERE ({i.STRIP_KEYS}) NOT IN "
             f"(SELECT ({i.STRIP_KEYS}) FROM twelve))",
             _drawn_sql(1, "'ingest'", "six"), _drawn_sql(2, "'analyze'", "twelve"),
             _drawn_sql(3, "CASE WHEN s.width IS NULL THEN 'analyze' ELSE 'show' END", "kept_colors"))
       + "SELECT * FROM run1 UNION ALL SELECT * FROM run2 UNION ALL SELECT * FROM run3")
def analyze_again(spark, sf_dir):
    """Three runs on one store: all videos are new; all are drawn again from half as many pictures; all is shown as stored."""
    folder, drawn = new_folder(spark, "store"), []
    asked, files_ = i.own_requests(spark, sf_dir), i.customer_files(spark, sf_dir)
    for run, interval, force in ((1, i.HOURS_6, False), (2, 2 * i.HOURS_6, True), (3, i.HOURS_6, False)):
        done = analyze(asked, events=i.frame_events(spark, sf_dir), pixels=i.event_pixels(spark, sf_dir), arrivals=files_,
                       interval_us=interval, force=force, **load(spark, folder, key_type="long"))
        commit(done, folder)
        strips = done.strips.groupBy(*lookup.ASKED).agg(
            F.max("width").alias("width"), F.max("height").alias("height"),
            F.sum((F.col("x") + 1) * (F.col("rgb").cast("long") + 1)).alias("checksum"))
        drawn.append(done.routed.join(strips, lookup.ASKED, "left").withColumn("run", F.lit(run)))
    return drawn[0].unionByName(drawn[1]).unionByName(drawn[2])


# Functions whose plain name belongs to the operator they call.
for _registered in (QUERIES, ORACLES):
    for _name in [n for n in _registered if n.endswith("_")]:
        _registered[_name.rstrip("_")] = _registered.pop(_name)
