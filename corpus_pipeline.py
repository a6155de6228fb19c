"""The corpus pipeline: documents to token files, one dealt operator a stage.

Every stage gets the documents that its predecessor kept, reread from Parquet, and
returns the columns of ``documents``; the last returns what its token files hold.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from marketbars.llm.common import ship_package, stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; every other row stays as it is."""
    from marketbars.llm.quality import keep_good
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by Jaccard 0.8 or more on five-word shingles, one
    document stays."""
    from marketbars.llm.jaccard_join import keep_one
    return keep_one(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ten words and more that a benchmark item holds are cut out."""
    from marketbars.llm.decontaminate import remove_spans
    return remove_spans(docs, table(spark, sf_dir, "benchmark"), chars_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    from marketbars.llm.mixing import mixed_documents
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; a row per document as read back from them."""
    from marketbars.llm.queries import tokenizer_file
    from marketbars.llm.token_files import read_token_files, write_token_files
    from marketbars.session import scratch_path
    folder = scratch_path(spark, "token-files")
    return read_token_files(write_token_files(docs, tokenizer_file(), folder), folder)


def _shipped(function):
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, docs, sf_dir)
    return run_stage


STAGES = [("quality", quality), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("mix", mix), ("token_files", token_files)]
STAGES = [(name, _shipped(function)) for name, function in STAGES]

ORACLE_SQL = None       # a fitted classifier, Newton's iterations and a tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
