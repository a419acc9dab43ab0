"""Looking requests up in the video metadata."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from tintflow.functions.requests import kind_choice
from tintflow.session import staged

ASKED = ["video_key", "bucket_size", "kind"]

# Words of 64 bits in a filter of keys: 4 million bits, at most this many rows to send out whatever the number of keys.
FILTER_WORDS = 1 << 16


def _word_and_bit(key: str):
    place = F.pmod(F.xxhash64(key), F.lit(FILTER_WORDS * 64))
    return F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")


def key_bits(wanted: DataFrame, key: str = "video_key") -> DataFrame:
    """One bit of each key of ``wanted`` in a table of at most ``FILTER_WORDS`` rows, staged; bits meet before they are shuffled."""
    word, bit = _word_and_bit(key)
    placed = wanted.select(word.alias("_word"), bit.alias("_bit"))
    return staged(placed.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits")))


def may_be_wanted(rows: DataFrame, wanted: DataFrame, bits: DataFrame, key: str = "video_key") -> DataFrame:
    """The rows whose key has its bit in ``bits``: all with a key of ``wanted``, and of the others about one in
    (4 million / keys). Taken where the rows are scanned, before any of them is shuffled.

    Keys that are neither texts nor whole numbers, or not of one type on both sides, may be equal without being hashed alike: all rows pass.
    """
    kind = rows.schema[key].dataType
    if kind != wanted.schema[key].dataType or not isinstance(kind, (IntegralType, StringType)):
        return rows
    word, bit = _word_and_bit(key)
    other = "_" * (1 + max(map(len, rows.columns)))  # longer than any column's name
    named = bits.toDF(f"{other}word", f"{other}bits")
    return (rows.join(F.broadcast(named), word == F.col(f"{other}word"))
            .filter(F.getbit(F.col(f"{other}bits"), bit) == 1).drop(*named.columns))


def known_requests(requests: DataFrame, videos: DataFrame) -> DataFrame:
    return requests.distinct().join(videos.select("video_key").distinct(), "video_key", "left_semi")


def unknown_requests(requests: DataFrame, videos: DataFrame) -> DataFrame:
    return requests.distinct().join(videos.select("video_key").distinct(), "video_key", "left_anti")


def analyzed_flag(requests: DataFrame, blocks: DataFrame) -> DataFrame:
    """Distinct requests, each with whether one of the video's kept versions has its bucket size and kind.

    A request's kind may be as typed; ``blocks`` name the kind that was computed.
    """
    done = blocks.select("video_key", "bucket_size", F.col("kind").alias("_kind")).distinct().withColumn("_done", F.lit(True))
    return (requests.distinct().withColumn("_kind", kind_choice("kind")).join(done, ["video_key", "bucket_size", "_kind"], "left")
            .withColumn("analyzed", F.col("_done").isNotNull()).drop("_done", "_kind"))


def route_requests(requests: DataFrame, videos: DataFrame, blocks: DataFrame, *,
                   force: bool = False) -> DataFrame:
    """Distinct requests with the work each needs: ``show``, ``analyze`` or ``ingest``.

    ``force`` redoes the analysis of videos that have been analysed before.
    """
    known = videos.select("video_key").distinct().withColumn("_known", F.lit(True))
    action = F.when(F.col("_known").isNull(), "ingest")
    if not force:
        action = action.when(F.col("analyzed"), "show")
    return (analyzed_flag(requests, blocks).join(known, "video_key", "left")
            .withColumn("action", action.otherwise("analyze")).drop("_known", "analyzed"))
