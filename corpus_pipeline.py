"""From raw documents to packed sequences, in five stages.

Each stage takes the rows its predecessor kept, and its result is written as
Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.deobfuscated_pii import mask_spans, private_spans
from tallyfold.llm.line_quality import line_first_quality
from tallyfold.llm.near_copies import similar_groups
from tallyfold.llm.packing import pack_documents
from tallyfold.llm.pfair_mixing import mix_sources
from tallyfold.llm.queries import tokenizer_path
from tallyfold.session import materialize, shared_work_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Near copies: five-word shingles that agree to 0.8. Sets of equal size with a
# Jaccard similarity of 0.8 have a cosine of 8/9, an angle of 0.476, and so differ
# in 15 % of a fingerprint's bits, 58 +- 7 of 384; 80 takes in nearly all of them,
# and one of 32 blocks of 12 bits is shared with a chance of 0.99. The sets decide.
SIMILAR = {"width": 5, "percent": 80, "words": 6, "radius": 80, "blocks": 32}


def _with_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines.

    A null or empty text has no words and goes; a text of any length is judged
    whole. Rows with a null id are judged like others; repeated rows are judged
    alike and all stay or go; an empty table gives an empty result; other columns
    than those of ``documents`` are dropped.
    """
    judged = line_first_quality(docs, "doc_id", "text", keep=["lang", "source"])
    # A filter on the verdict would be moved below it and work it out twice; one on what explode yields is not.
    passed = F.filter(F.array(F.struct("kept", "clean_text")), lambda q: q["kept"])
    kept = judged.select("doc_id", "lang", "source", F.explode_outer(passed).alias("q")).where("q IS NOT NULL")
    return _with_text(kept.withColumn("text", F.col("q.clean_text")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id.

    Documents are told apart by id and text, so unlike texts that share an id are
    compared like any others and none is lost; of a row repeated whole one stays.
    Of equal texts, or near copies, under one id the least text stays. Rows with
    a null id all stay, repeated or not; null and empty texts are equal to each
    other; texts are compared whole; an empty table gives an empty result.
    """
    # A number for each row, stored so that it stays the same whoever reads it.
    known = docs.where("doc_id IS NOT NULL").select(*COLUMNS, F.monotonically_increasing_id().alias("number"))
    numbered = materialize(known, "numbered")
    groups = similar_groups(numbered, "number", "text", **SIMILAR)
    order = F.struct("doc_id", F.col("text").isNotNull(), F.sha2("text", 256), "number")
    named = numbered.select("number", order.alias("place")).join(groups, "number")
    leaders = named.groupBy("component_id").agg(F.min("place").alias("place")).select("place.number")
    kept = numbered.join(leaders, "number", "left_semi")
    return kept.select(*COLUMNS).union(docs.where("doc_id IS NULL").select(*COLUMNS))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind.

    A null text stays null, an empty one empty; every text is searched whole.
    Overlapping finds are masked as one. Repeated rows and null ids stay; an empty
    table gives an empty result.
    """
    found = private_spans(docs, "doc_id", "text", keep=["lang", "source"])
    return _with_text(found.withColumn("text", mask_spans(F.col("text"), F.col("spans"))))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture across and within files, which packing follows.

    A null source is one source of its own, a null or empty text counts one
    character. Repeated rows and null ids stay; an empty table gives an empty result.
    """
    mixed = mix_sources(docs, "doc_id", "text", "source", keep=COLUMNS[1:])
    return mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of 4,096 tokens, numbered in the order of the mixture.

    A null or empty text is its end token alone; a text longer than a sequence is
    cut. Repeated rows and null ids are packed each; an empty table gives an empty result.
    """
    return pack_documents(docs, "doc_id", "text", tokenizer_path("word_bpe_49k.json"), ordered=True)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("privacy", privacy),
    ("mixing", mixing),
    ("packing", packing),
]

# Fingerprints, spans and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
