"""Words of the licence scan."""

from pyspark.sql import functions as F

from tintflow.llm import license_scan


def test_words_are_cut_at_separators_and_not_collected(spark):
    texts = spark.createDataFrame([("",), (" \n",), ("a1 B-c",), ("-é ü\u007f𝒳'q\x00z-",), (None,)], "text string")
    found = texts.select(license_scan.words(F.col("text")).alias("w"))
    assert [r["w"] for r in found.collect()] == [[], [], ["a1", "c"], ["é ü", "𝒳", "q", "z"], None]
    assert "regexp_extract_all" not in found._jdf.queryExecution().analyzed().toString()
