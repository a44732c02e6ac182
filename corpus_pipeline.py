"""Documents to token files, in stages.

Each stage takes the documents that its predecessor kept and calls one operator
of ``tidemark.llm``; all but the last return the columns of ``documents``, and
others that the table may have.  An empty table stays so in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common
from tidemark.llm.decontaminate import keep_uncontaminated
from tidemark.llm.mixing import mixed
from tidemark.llm.ngram_join import keep_one
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.token_store import token_store
from tidemark.llm.toxicity import keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    A null text is judged as an empty one, repeated rows share their fate, ids
    choose nothing, and without labels of both kinds all stay.
    """
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at a five-word shingle similarity of 0.8, the least doc_id stays.

    Of rows repeated whole one stays; of rows that share an id but not the text
    each goes by its text; rows without an id are the last choice of their
    group.  Texts without words are copies of nothing and stay.
    """
    return keep_one(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, whole or edited, go.

    Rows go by their text, so repeated ones share their fate and one without an
    id goes too; texts without words stay, and so do all without test items.
    """
    return keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; documents taken twice are there twice.

    Rows of equal id are taken together within a source, null ids and null
    sources among them; texts without words are never taken.
    """
    return mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: one row a document of the mix.

    In ascending order of ids, null first and equal ones by their texts; a null
    text has an end id alone.
    """
    return token_store(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: SQL can't express the first stage's classifier, the alignments or the tokenizer; each is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read by the next, then deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        path = common.scratch_path(spark, name)
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            common.remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
