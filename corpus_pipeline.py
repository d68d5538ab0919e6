"""The corpus pipeline: language ID, near duplicates, decontamination, secrets, mix.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns what is kept, which is written
as Parquet and read again as the next one's docs. All but the last return the columns of ``documents`` and any others that
the input has, with its own values, whatever the operators call theirs.

* language_id: rejected documents go (no letters, or further from every language than texts of that length are).
* near_duplicates: of each group of linked rows the one of smallest doc_id stays (one row, where ids repeat).
* decontaminate: spans that benchmark windows occur in are cut out; documents that are mostly such spans go.
* redact_secrets: secrets are replaced by a mark; no document goes.
* mix: each document as often as the mix of sources takes it, with copy_no and its source's target in words.

Defined results: null and empty texts, and such without a letter, are rejected by the first stage. Ids may be null or
repeated: rows are told apart by themselves, and of linked rows with the smallest id one stays. Repeated rows are linked
rows. A null source is a source of its own. A very long text goes through every stage as a whole. An empty table stays
empty. Columns of the input named copy_no or target are replaced by the mix's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm import decontam, jaccard, langid, mixing, secretscan
from lakestar.llm.common import materialize, packed, table, unpacked


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.select("text", "lang"))
    return unpacked(langid.identify(packed(docs, "text"), model).where(~F.col("rejected")), docs.columns, "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secretscan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.materialized_mix(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("redact_secrets", redact_secrets), ("mix", mix)]

#: No stage but the mix's targets can be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over the written rows of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
