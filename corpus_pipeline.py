"""The corpus pipeline: five stages over ``documents``, each calling one operator of ``vigil.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next one's ``docs``; all but the last return the columns of documents.

* toxicity: learnt from the rows of ``labels`` that may be learnt from, documents with a score of
  ``TOXIC`` or more go;
* near-duplicates: of each group (five-word shingles, similarity 0.8 or more) the document of the
  smallest id stays; documents without an id stay, and rows that repeat an id share its fate;
* decontamination: documents that hold a passage of ``benchmark`` go;
* personal data: its spans are replaced by their kinds;
* SentencePiece: the ids of each text and their number, checked against what they decode to.

Empty tables pass through all stages; null texts count as empty and stay null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import decontaminate, minhash, pii, sentence_pieces
from vigil.llm import toxicity as toxic
from vigil.llm.common import unused_name
from vigil.session import materialize
from vigil.sources.tables import table

TOXIC = 0.3
#: learnt models and candidate verification can't be put into SQL
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxic.keep_below(docs, toxic.train_on(docs, table(spark, sf_dir, "labels")), TOXIC)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = minhash.near_duplicates(docs, shingle=5, percent=80)
    key = unused_name(docs, "copy")
    copies = groups.where("not kept").select(F.col("id").alias(key))
    return docs.join(copies, docs["doc_id"].cast("long") == copies[key], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.train(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_crc32, decoded_sha256, decoded_bytes`` of each document."""
    import public_tokenizers  # here and not above: the other stages don't need it

    out = sentence_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), more=("ids",))
    return out.withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("sentencepiece", sentencepiece)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
