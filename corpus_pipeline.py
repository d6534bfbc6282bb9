"""From raw documents to packed training sequences, a stage at a time.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``. A
stage's result is written to the shared folder and read again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.llm import decontam, langid, linededup, neardup, packing
from tablegate.llm.queries import vocabulary
from tablegate.llm.store import kept

LEAST_SCORE = 0.3  # of the language predicted; four equal ones have 0.25
CAPACITY = 2048
_OWN = uuid4().hex  # no column of a caller's ends so
ROW, LANGUAGE, SCORE = (f"{name}_{_OWN}" for name in ("row", "language", "score"))  # ROW: a number of its own for every row


def numbered(docs: DataFrame) -> DataFrame:
    """docs with a number for every row, written down unless they have it, since it must not change."""
    return docs if ROW in docs.columns else kept(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the labels teach; null, letterless and undecided texts go.

    The network learns from a bounded sample of the documents with a lang. Where no document has one, only what has no
    letter goes.
    """
    network = langid.learn(docs)
    if network is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.predict(docs, network, (LANGUAGE, SCORE))
    good = (F.col(LANGUAGE) != langid.UNDETERMINED) & (F.col(SCORE) >= LEAST_SCORE)
    return found.filter(good).drop(LANGUAGE, SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines an earlier line is near to; those that are null, or blank now, go.

    Every row is a document, whether it has no doc_id or shares one. Rows go by doc_id, those without one first.
    """
    rows, kind = numbered(docs), docs.schema["doc_id"].dataType
    own = rows.withColumn("doc_id", F.struct(F.col("doc_id").cast("long").alias("id"), F.col(ROW).alias("row")))
    rest = linededup.without(own, linededup.duplicates(own))
    return rest.withColumn("doc_id", F.col("doc_id.id").cast(kind)).select(docs.columns).filter(F.col("text").rlike(r"\S"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near-duplicates: five-word shingles, a similarity of 0.8 or more.

    Every row is a document, whether it has no doc_id or shares one. The first is that of the smallest doc_id; rows
    without one come last.
    """
    rows = numbered(docs)
    groups = neardup.near_duplicates(rows.withColumn("doc_id", F.col(ROW)), size=5, percent=80)
    groups = kept(groups.select(F.col("doc_id").alias(ROW), "component_id", "kept"), "groups")
    several = groups.filter("NOT kept").select("component_id").distinct()
    members = groups.join(several, "component_id", "left_semi").join(rows.select(ROW, F.col("doc_id").cast("long").alias("doc_id")), ROW)
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.col(ROW).alias("row"))
    firsts = members.groupBy("component_id").agg(F.min(place).alias("first")).select(F.col("first.row").alias(ROW))
    gone = members.select(ROW).join(firsts, ROW, "left_anti")
    return rows.join(gone, ROW, "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, placed in sequences of at most 2048 tokens."""
    done = packing.packed(docs, vocabulary("byte_bpe_50k.json"), end_id=0, capacity=CAPACITY)
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # a network's decisions have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        if ROW not in result.columns:
            result = result.withColumn(ROW, F.monotonically_increasing_id())
        docs = kept(result, name)
    return STAGES[-1][1](spark, docs.drop(ROW), sf_dir)
