"""Corpus preparation: language, near duplicates, benchmark leaks, source mix, shards.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's documents. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgrid.llm.bin_packing import pack_shards
from trustgrid.llm.common import documents, id_bucket, saved, unused
from trustgrid.llm.decontaminate import find_leaks
from trustgrid.llm.components import small_filter
from trustgrid.llm.language_id import VOCABULARY, identify, labelled_sample, learn, least_fits, load_pieces
from trustgrid.llm.shingle_join import keep_one
from trustgrid.llm.source_mixing import WEIGHTS, document_levels, mix_sources

MIN_LANGUAGE_SCORE = 0.5
MIX_SHARE = (4, 5)          # of the tokens that reach the stage
MIX_COLUMNS = ("mix_leaf", "mix_budget", "mix_cut", "mix_copies")
N_SHARDS = 40

# SQL cannot state the stages (trained model, similarity join, edit distance, packing); tests compare with brute force
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised: not ``und``, a posterior of half or more, and a fit (mean
    log-probability a character under the best language) that reaches the bound learned for that language.

    The model is learned from labelled documents outside the held-out quarter; a document without any label in the
    table to learn from cannot be recognised, so an unlabelled table comes back empty.
    """
    pieces = load_pieces(VOCABULARY)
    sample = labelled_sample(docs.filter(id_bucket(F.col("doc_id"), 4) != 2))
    model = learn(sample, pieces)
    lang_pred, score, fit = (unused(docs.columns, name) for name in ("lang_pred", "score", "fit"))
    fitting = F.lit(False)
    for lang, least in least_fits(sample, pieces).items():
        fitting = fitting | ((F.col(lang_pred) == lang) & (F.col(fit) >= least))
    found = identify(docs, model, with_fit=True, names=(lang_pred, score, fit))
    return found.filter((F.col(lang_pred) != "und") & (F.col(score) >= MIN_LANGUAGE_SCORE) & fitting).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word shingles, Jaccard 0.8) keep the smallest id, one row of it."""
    return keep_one(docs, size=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item within its edit budget, whatever their ids: leaks are a matter of the text."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    key = unused(docs.columns, "key")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    leaks = find_leaks(keyed, items, id_col=key).select(key).distinct()
    return small_filter(keyed, leaks, key, keep=False).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take the seeded prefix of every leaf that its share of the budget allows, each document once at most."""
    # columns of the documents that are named like those of the mix step aside
    aside = {c: unused([*docs.columns, *MIX_COLUMNS], c) for c in docs.columns if c.lower() in MIX_COLUMNS}
    mixed = mix_sources(docs.withColumnsRenamed(aside), document_levels(), WEIGHTS, MIX_SHARE, max_epochs=1)
    return mixed.filter("mix_copies > 0").select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return pack_shards(docs, N_SHARDS).select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                                              "slot")


STAGES = [
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("sharding", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
