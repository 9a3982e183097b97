"""Corpus cleaning pipeline: five stages over ``documents``.

1. quality rules: rejected documents go;
2. SimHash near-duplicates: one document of each class stays;
3. benchmark decontamination: documents that hold a benchmark passage go;
4. secret scan: secrets are masked in the texts that stay;
5. byte-level BPE: the cleaned texts encoded and decoded (last stage).

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet to the cluster's shared folder and read again as the next one's input,
so a lost executor never reaches back beyond its stage.  All but the last
return the columns of their input.

Defined results: null and empty texts fail the quality rules (too few words);
repeated rows are copies, of which one stays; texts are read whole, however long;
an empty table gives an empty table; further columns of the documents pass
through to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featflow.llm import byte_bpe, decontam, quality, secret_scan, simhash
from featflow.llm.common import table, tokenizer_path
from featflow.session import delete_path, fresh_path, stage_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_per_class(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return byte_bpe.round_trip(docs, tokenizer_path("byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("byte-level bpe", bpe),
]

#: SQL has neither the fingerprints' hash nor the tokenizer; the pipeline is
#: tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; the last one's rows.

    A stage's input and its own intermediate files are deleted once its result
    is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        path = fresh_path(spark, "pipeline", name.replace(" ", "-"))
        with stage_scope(spark):
            result = step(spark, docs, sf_dir)
            result.write.parquet(path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.schema(result.schema).parquet(path), path
    return docs
