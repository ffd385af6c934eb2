"""Corpus pipeline: documents to a mixed, deduplicated, tokenised corpus.

``STAGES`` lists (name, function) pairs.  Each function takes (spark, docs,
sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet to the
shared folder and reads it back as the next stage's ``docs``.  All but the
last stage return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.llm.common import WORD, broadcast_if_small, read, written
from wordloom.llm.language_id import UNKNOWN, fit_languages, predict_language
from wordloom.llm.line_dedup import line_dedup
from wordloom.llm.mixing import cycled_weights, mix, repeated
from wordloom.llm.ngram_join import jaccard_components
from wordloom.llm.sentence_pieces import encode_texts

#: A document stays when at least this share of its n-grams belongs to the predicted language.
MIN_LANGUAGE_SCORE = 0.3

#: The language ID can't be written in SQL; tests hold the pipeline against a plain version instead.
ORACLE_SQL = None


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its own columns of these names renamed, so that a stage's
    working columns don't replace them, and the names to restore."""
    own = {f"__own_{c}": c for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed({c: k for k, c in own.items()}), own


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those that no learned language
    covers.  Learns from three quarters of the documents, by crc32 of the id."""
    learned = docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    model = fit_languages(learned)
    free, own = aside(docs, "lang_pred", "score")
    judged = predict_language(free, model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return judged.drop("lang_pred", "score").withColumnsRenamed(own).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines outside the first document that holds them.
    A document that loses more than half of its words by it goes: what is
    left of a copy or near copy is no text of its own, and the next stage
    could not find it any more.  ``n_chars`` follows the text."""
    free, own = aside(docs, "n_lines", "n_dropped")
    out = line_dedup(free, min_share=0.5)
    emptied = (F.col("n_dropped") > 0) & ~F.col("text").rlike(WORD)
    out = out.filter(~emptied).drop("n_lines", "n_dropped").withColumnsRenamed(own)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of every group of linked documents, once.
    Documents link from 0.8 on sets of five-word shingles (op8: 0.9, three).
    Documents without an id link with nothing and stay."""
    found = written(jaccard_components(docs.select("doc_id", "text"), k=5, threshold=0.8).filter("doc_id is not null"))
    gone = broadcast_if_small(written(found.filter("doc_id <> component_id").select("doc_id").distinct()), 500_000)
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    twice = written(found.groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if twice.limit(1).count() == 0:
        return kept
    twice = broadcast_if_small(twice, 500_000)
    order = Window.partitionBy("doc_id").orderBy(*[c for c in docs.columns if c != "doc_id"])
    one = (kept.join(twice, "doc_id", "left_semi").withColumn("__row", F.row_number().over(order))
           .filter("__row = 1").select(*docs.columns))
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(one)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or samples the documents of every source to its target weight."""
    free, own = aside(docs, "size", "source_size", "target", "copies")
    mixed = repeated(mix(free, cycled_weights(docs)))
    return mixed.drop("size", "source_size", "target", "copies").withColumnsRenamed(own).select(*docs.columns)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with the check that they decode to its text."""
    out = encode_texts(docs.select("doc_id", "lang", "source", "text"))
    return out.select("doc_id", "lang", "source", F.size("piece_ids").cast("long").alias("n_pieces"),
                      "piece_ids", "round_trip")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", near_duplicates),
    ("source_mixing", mix_sources),
    ("sentence_pieces", sentence_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
