"""Corpus pipeline: documents -> training mix, a stage for each operator.

Every stage takes what the one before kept, written as Parquet and read
again. All but the last return the columns of ``documents``; the last adds
``copies`` and ``taken``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folia.llm import classifier, decontaminate, mixing, pii, simhash
from folia.llm.common import session
from folia.session import scratch_folder

STAGES = [
    ("quality classifier", classifier.stage),
    ("SimHash near-dedup", simhash.stage),
    ("benchmark decontamination", decontaminate.stage),
    ("PII", pii.stage),
    ("mixing sources to target weights", mixing.stage),
]

#: Model training, Hamming links and hash thresholds have no SQL form: the
#: pipeline is tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written to the shared
    checkpoint folder and read again by the next."""
    session(spark)
    folder = scratch_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
