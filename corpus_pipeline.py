"""The corpus pipeline: language, near duplicates, source mix, tokens.

Each stage works on all that the one before it kept, and its decisions take effect; all but the last return the columns
of ``documents``. A stage's result is written as Parquet in the shared folder and reread as the next one's input, which
also is what lets the stages read their input twice and know its rows by their place in the files.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintflow.llm import jaccard_join, language_id, mixing
from tintflow.llm.byte_bpe import encode_table
from tintflow.llm.common import staged, table, unused, with_row


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, and those of which no word and no n-gram belongs to a learned language.

    Null and empty texts have no letter; without a labelled document nothing is learned and all are rejected; an empty table stays
    empty; all other columns are kept, whatever their names.
    """
    return language_id.keep_identified(docs, language_id.fit(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at five words and a similarity of 0.8, the one with the smallest id stays, one row of it.

    Null and empty texts are linked with nothing and stay, each row of them; a null id comes after all others; an empty table
    stays empty; all other columns are kept, whatever their names.
    """
    rows, row = with_row(docs)
    found = jaccard_join.join(rows, row=row).select("_group", F.col("doc_id").alias("_id"), "_row")
    first = found.groupBy("_group").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_row")).alias("first"))
    first = first.select(F.col("first._row").alias(row))
    return rows.join(first, row, "left_semi").drop(row)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    A null text has no words and is taken once; null is a source; rows that are equal are taken one by one; an empty table stays
    empty; all other columns are kept, whatever their names.
    """
    rows, row = with_row(docs)
    times, copy = unused(rows, "times"), unused(rows, "copy")
    taken = mixing.mix(rows, row=row).where("copies > 0").select(F.col("_row").alias(row), F.col("copies").cast("int").alias(times))
    return (rows.join(taken, row).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(f"`{times}`"))))
            .drop(row, times, copy))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: id, number of tokens, digests of the ids and of the decoded bytes, and the ids.

    Null and empty texts have no tokens; repeated rows are encoded one by one; an empty table stays empty; other columns are left out.
    """
    return encode_table(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_each_group),
    ("mixing", mixed),
    ("byte_bpe", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
