"""From raw documents to token files: five stages, each over all that the last one kept.

Rejected documents are gone for the later stages: toxic ones, all but one of each group
of near-duplicates, and those that hold a benchmark item.  The mix may repeat or leave out
documents; the token files hold every row of the mix.

A stage takes the session, the documents and the folder of the tables.  All but the last
return the columns of documents.  Between stages the rows are written and read back, so a
later stage never repeats an earlier one, nor depends on the executors that ran it.

Null ids and texts, repeated rows and empty tables are treated as the operators' modules
say; columns beyond the five are passed through by the first four stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, mixing, simhash, token_files, toxicity
from millrace.llm.common import table, written

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the compression distance rejects."""
    model = toxicity.learnt(docs, table(spark, sf_dir, "labels"))
    return toxicity.ordinary(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a benchmark item is found."""
    found = decontamination.searched(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("items") == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    mix = mixing.mixed(docs).filter("copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mix.withColumn("__copy", copies).select(*docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each row, read back from its file."""
    files = token_files.write_tokens(docs, public_tokenizers.path(VOCABULARY), END_ID)
    return token_files.read_tokens(files)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mix", mix_sources),
    ("token_files", write_token_files),
]

# Classification, fingerprints and token files are beyond SQL; tests compare the rows with
# a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
