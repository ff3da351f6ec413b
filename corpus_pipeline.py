"""A corpus made ready for training: five stages, each written and read again before the next.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm import exact_dedup, langid, packing, queries, secrets, simhash
from tallyhouse.session import written
from tallyhouse.sources.tables import scan

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language model accepts go; the accepted ones keep their rows as they are.

    Without any labelled row there is no model to reject by: every text that has a letter stays.
    """
    model = langid.train(docs)
    if model is None:
        return docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}"))
    return langid.identify(docs.select(*COLUMNS), model).where("lang_accepted").select(*COLUMNS)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays; a row that repeats id and text stays once.

    Only rows whose id is in a group of copies are looked at again; there, id
    and digest of the normalised text tell rows apart.
    """
    docs = docs.select(*COLUMNS)
    found = written(exact_dedup.exact_groups(docs), "exact")
    grouped = written(found.where("group_size > 1").select("doc_id").distinct(), "grouped")
    touched = _sent(grouped.withColumnRenamed("doc_id", "grouped_id"))
    met = F.col("doc_id").eqNullSafe(F.col("grouped_id"))
    body = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    again = docs.join(touched, met, "left_semi").withColumn("digest", F.sha2(body, 256))
    kept = found.where("kept").select(F.col("doc_id").alias("kept_id"), "text_sha256")
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("text_sha256"))
    once = again.join(kept, same, "left_semi").dropDuplicates(["doc_id", "digest"]).select(*COLUMNS)
    return docs.join(touched, met, "left_anti").unionByName(once)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash links (three-word shingles, at most two bits apart), the one with the smallest id stays.

    A document without an id goes if it is linked to one that has an id.
    """
    docs = docs.select(*COLUMNS)
    found = written(simhash.near_groups(docs), "near")
    gone = written(found.where("not (doc_id <=> component_id)").select(
        F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")), "gone")
    met = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (simhash.mark_of("text") == F.col("gone_mark"))
    return docs.join(_sent(gone), met, "left_anti")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, with its new length."""
    model = secrets.train(secrets.labelled_tokens(docs))
    clean = secrets.redacted(secrets.scan_secrets(docs.select(*COLUMNS), model))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens.

    Workers keep fewer words than in packing alone: they also hold what the
    earlier stages left in memory.
    """
    return queries.pieces(docs, packing.Packing(words=50_000))


def _sent(rows: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``rows`` (stored, a few numbers each) to be broadcast if there are at most ``most``, else joined by a shuffle."""
    return F.broadcast(rows) if rows.count() <= most else rows


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id), ("exact dedup", exact_copies), ("SimHash near-dedup", near_copies),
    ("secret scans", secret_scan), ("packing", pack)]

#: Character models, SimHash and retrieval have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the result of the last one."""
    queries.find_package(spark)
    docs = scan(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
