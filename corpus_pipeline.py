"""A corpus in five stages: toxicity, line dedup, near duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes each
stage's rows as Parquet to the shared folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import jaccard, line_dedup, mixing, toxicity
from panelspark.llm.catalog import bpe_digest
from panelspark.llm.common import discard, n_words, settled, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    A null or empty text is scored as the empty text; null ids and labels teach nothing; repeated rows
    share a fate; an empty table gives no rows; other columns, whatever their names, pass untouched.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"))
    kept = rows.withColumn("score", toxicity.score(rows, model, "row.text")).where(F.col("score") < toxicity.THRESHOLD)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Duplicate lines go, and with them documents that had words and have none left: all they said stands elsewhere.

    A null text has no lines and stays; documents without words stay; repeated rows (equal id and text)
    count as one document and all stay; an empty table gives no rows. n_chars is counted anew, unless
    the text is null; columns named n_lines, n_dropped or n_near come back as they were.
    """
    counts = {c: f"{c}_{k}" for k, c in enumerate(("n_lines", "n_dropped", "n_near")) if c in docs.columns}
    while set(counts.values()) & set(docs.columns):
        counts = {c: f"{x}_" for c, x in counts.items()}
    out = line_dedup.dedup_lines(docs.withColumnsRenamed(counts))
    out = out.where((F.col("n_dropped") == 0) | (n_words(F.col("text")) > 0)).drop("n_lines", "n_dropped", "n_near")
    out = out.withColumnsRenamed({x: c for c, x in counts.items()})
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join stays: its least by (doc_id, hash of the text).

    Documents without words all stay, null texts among them; a null id is less than others; of repeated
    rows one stays; an empty table gives no rows; other columns, whatever their names, pass untouched.
    """
    return jaccard.keep_one(docs, settled(lambda: jaccard.jaccard_components(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeated, kept, cut or left out.

    Documents without words, null texts among them, take no part in a mix of words and go. A null source
    is one of its own, the last. Rows meet by id and text, so repeated rows must be gone, as they are
    after the stage before. An empty table gives no rows; other columns pass untouched.
    """
    return mixing.apply_mix(docs, settled(lambda: mixing.mix(docs)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document: counts and digests of ids and of the decoded bytes. A null text is empty; repeated rows repeat; an empty table gives no rows; other columns are left out."""
    return bpe_digest(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("n-gram Jaccard join", drop_near), ("mixing sources", mix_sources), ("byte-level BPE", tokens)]

#: A trained classifier and a tokenizer have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs, before = settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir)), docs
        if k:
            discard(before)
    return docs
