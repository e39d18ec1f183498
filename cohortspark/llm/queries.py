"""The operators of this folder as queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cohortspark.llm import graphs_search, jaccard, language, lattice, licenses, merkle, mixing, pieces_encoding, quality, repeats, runs, sharding, toxicity
from cohortspark.llm.common import table
from cohortspark.llm.oracles import OP12_MERKLE_MANIFEST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def sha256(column: str) -> F.Column:
    return F.sha2(F.col(column), 256)


@query
def op1_range_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Range shards of near equal bytes."""
    out = sharding.range_shards(table(spark, folder, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Copies of each document in the balanced mix."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    out = mixing.mixed(docs)
    return out.select("doc_id", "source", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


@query
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the encoding of each text and of its decoding."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = pieces_encoding.encode_documents(
        docs, public_tokenizers.path("piece_bpe_32k.model"), fields=("n_tokens", "id_text", "covered", "decoded")
    )
    return out.select("doc_id", "n_tokens", sha256("id_text").alias("ids_sha256"), sha256("decoded").alias("decoded_sha256"), F.col("covered").alias("covered_bytes"))


@query
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of each text; one document in five is held out of learning."""
    docs = table(spark, folder, "documents")
    model = language.learn(docs, held_out=language.fold())
    return language.predict(docs.select("doc_id", "text", language.fold().alias("held_out")), model).drop("text")


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities of low quality and, given that, of toxicity, for every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    categories = {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    chain = toxicity.learn(docs, table(spark, folder, "labels"), categories)
    return toxicity.predict(docs, chain).drop("text").withColumn("toxic", F.col("p_toxic") >= 0.5)


@query
def op6_jaccard_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of texts that share four fifths of their five-word shingles."""
    return jaccard.similar_groups(table(spark, folder, "documents"))


@query
def op7_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each text without passages of 100 bytes that start earlier as well."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = repeats.repeated_spans(docs, width=100)
    removed = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["size"]), F.lit(0).cast("long"))
    kept = F.sha2(repeats.kept_bytes(F.col("text"), F.col("spans")), 256)
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.greatest(F.size(F.coalesce("spans", F.array())), F.lit(0)).cast("long").alias("n_spans"), kept.alias("kept_sha256"))


@query
def op8_lattice_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of near-duplicate vectors."""
    return lattice.near_duplicates(table(spark, folder, "embeddings"))


@query
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and detections of each text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "scan.*")


@query
def op10_graph_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector."""
    return graphs_search.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of good quality for each text; one document in four is held out of learning."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, folder, "labels"), held_out=quality.fold())
    out = quality.predict(docs.select("doc_id", quality.fold().alias("held_out"), "text"), model).drop("text")
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Digest, roots and proof of each row, and whether it still leads to the root after tampering."""
    docs = table(spark, folder, "documents")
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    tampered = merkle.leaf_of(*(F.col(c) + 1 if c == "n_chars" else F.col(c) for c in columns))
    rows = docs.select("doc_id", "lang", merkle.leaf_of(*map(F.col, columns)).alias("leaf"), F.when(changed, tampered).alias("tampered"))
    out = merkle.manifest(rows, F.col("leaf"), F.col("lang"), F.col("doc_id"))
    proof = F.col("merkle.proof")
    folded = merkle.fold(F.coalesce("tampered", "merkle.leaf"), proof)
    out = out.select("doc_id", "merkle.leaf", "merkle.subroot", "merkle.root", merkle.digest(merkle.beside(proof)).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def with_planted_run(doc_id: F.Column, text: F.Column) -> F.Column:
    """The text, but for one id in ten with a tail that repeats its own first words."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(words: F.Column) -> F.Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, (a + F.pmod(i - a, p)).cast("int")))
        joined = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
        return F.when(n > 0, joined).otherwise("")

    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # one element long, so that the words are split once
    return F.when(F.pmod(h, F.lit(10)) == 0, F.transform(F.array(words), repeated)[0]).otherwise(text)


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The longest periodic run of each text, and digests of all runs and of the text without repetitions."""
    docs = table(spark, folder, "documents")
    docs = docs.select("doc_id", with_planted_run(F.col("doc_id"), F.col("text")).alias("text"))
    out = runs.periodic_runs(docs).drop("text")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), sha256("collapsed").alias("collapsed_sha256"))
    period = -F.col("best.period")
    return out.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), period.alias("period"),
        F.floor(1000 * F.col("best.length") / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus pipeline."""
    return corpus_pipeline.run(spark, folder)


ORACLES["op12_merkle_manifest"] = OP12_MERKLE_MANIFEST
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
