"""From raw documents to an encoded training mix, in stages.

Every stage takes the documents that the one before it kept, and is written as Parquet and read
again before the next one starts. Rows with the same doc_id count as one document, but the Jaccard
stage tells those of different texts apart. All stages but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm import jaccard, language, mixing, pieces_encoding, repeats
from cohortspark.llm.common import Scratch, table, unique_name

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: rows that Spark hands to Python at a time; texts are long, and a batch is held several times over
BATCH_ROWS = 1000


def bounded(stage: Stage) -> Stage:
    """``stage`` in a session that hands few rows to Python at a time, so that workers stay small."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
            spark.conf.set(setting, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


@bounded
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any language, and fills a null ``lang`` with the predicted one.

    Null and empty texts and those without a letter go; what the labels are, or that there are none,
    drops nothing. Without a usable label there is no prediction, and null stays null.
    """
    model = language.learn(docs, held_out=language.fold())
    found, odds, has = unique_name(docs, "lang_pred"), unique_name(docs, "lang_score"), unique_name(docs, "lettered")
    out = language.predict(docs, model, fields=(found, odds), lettered=has).where(F.col(has))
    predicted = F.when(F.col(found) != "und", F.col(found))
    return out.select(*(F.coalesce(F.col(c), predicted).alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns))


@bounded
def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near duplicates; rows without a doc_id stay.

    Of rows that share a doc_id, those go whose text is in a group with a smaller one.
    """
    work = Scratch(spark, "near")
    gone, of, its = (unique_name(docs, n) for n in ("gone", "of", "its"))
    groups = work.keep(jaccard.similar_groups(docs, name="name").select("doc_id", "name", (F.col("doc_id") != F.col("component_id")).alias("goes")))
    ids = groups.groupBy(F.col("doc_id").alias(gone)).agg(F.bool_or("goes").alias("some"), F.bool_and("goes").alias("all"))
    ids = work.keep(ids.where("some"))
    own = docs["doc_id"].cast("long")
    kept = docs.join(ids.where("all"), own == F.col(gone), "left_anti")
    if ids.where("not all").isEmpty():
        return kept
    # ids with a text that goes and one that stays: the texts of these alone are named
    split, probe, name = ids.where("not all").select(gone), unique_name(docs, "probe"), unique_name(docs, "set_name")
    kept = kept.join(split, own == F.col(gone), "left")
    kept = kept.withColumn(probe, F.when(F.col(gone).isNotNull(), F.col("text"))).drop(gone)
    kept = jaccard.named(kept, name, probe)
    texts = groups.where("goes").join(split, F.col("doc_id") == F.col(gone), "left_semi").select(F.col("doc_id").alias(of), F.col("name").alias(its)).distinct()
    return kept.join(texts, (kept["doc_id"].cast("long") == F.col(of)) & (kept[name] == F.col(its)), "left_anti").select(docs.columns)


@bounded
def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 100 bytes that occur earlier; a document of which nothing is left goes.

    Null and empty texts stay: nothing of them is cut. ``n_chars`` follows the text.
    """
    own = ("doc_id", "text")
    rest = unique_name(docs, "rest")
    others = [c for c in docs.columns if c not in own]
    packed = docs.select(*own, F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in others)).alias(rest))
    cut = repeats.repeated_spans(packed).withColumn("kept", repeats.kept_text(F.col("text"), F.col("spans")))
    cut = cut.where(F.col("spans").isNull() | (F.length("kept") > 0))

    def column(name: str) -> F.Column:
        if name == "text":
            return F.col("kept").alias("text")
        if name == "n_chars":
            return F.when(F.col("spans").isNull(), F.col(rest)[name]).otherwise(F.length("kept")).cast(docs.schema[name].dataType).alias(name)
        return F.col(name) if name in own else F.col(rest)[name].alias(name)

    return cut.select(*(column(c) for c in docs.columns))


@bounded
def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the balanced mix of sources takes it.

    Null, empty and blank texts weigh nothing and stay once. A null source is a source of its own.
    """
    return mixing.repeated(mixing.mixed(docs), unique_name(docs, "mix"))


@bounded
def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and a digest of what they decode to, with the document's language and source.

    A null text counts as empty: the end id alone. Other columns of the caller go.
    """
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = pieces_encoding.encode_documents(docs.select("doc_id", "lang", "source", "text"), model, fields=("n_tokens", "ids", "decoded"))
    return out.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("language", language_stage),
    ("jaccard", jaccard_stage),
    ("repeats", repeats_stage),
    ("mix", mix_stage),
    ("encode", encode_stage),
]

#: the models and the encoder of the stages have no SQL form
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    work = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
