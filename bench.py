"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the number of local cores (default 8).
"""

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from catalog import inputs, registry
from tintflow.operators.color import requested_colors

HEADLINE = ["frame_colors", "video_strip", "sample_frames", "average_color", "dominant_color", "color_strip",
            "pack_containers", "last_versions", "route_requests", "frame_image_scan", "sample_frames_stream", "analyze"]


def frame_colors_1_40(spark, sf_dir):
    """Both kinds at block sizes 1 and 40 for every video."""
    pixels = inputs.pixels(spark, sf_dir)
    sizes = F.explode(F.array(F.lit(1), F.lit(40)))
    kinds = F.explode(F.array(F.lit("average"), F.lit("dominant")))
    asked = (pixels.select("video_key").distinct().withColumn("bucket_size", sizes).withColumn("kind", kinds))
    return requested_colors(pixels, asked)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    def run(query):
        started = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    queries = {"frame_colors_1_40": frame_colors_1_40, **{name: registry.QUERIES[name] for name in HEADLINE}}
    run(registry.QUERIES["average_color"])  # start Python workers and compile once, outside the measurement
    seconds = {name: round(min(run(query), run(query)), 3) for name, query in queries.items()}

    pixels = inputs.pixels(spark, sf_dir).count()
    frames = registry.QUERIES["pixel_count"](spark, sf_dir).count()
    both = seconds["frame_colors_1_40"]
    print(json.dumps({
        "metric": "headline queries, best of two", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "pixels_per_sec": round(4 * pixels / both), "frames_per_sec": round(4 * frames / both, 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
