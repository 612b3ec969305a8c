"""The operators applied to the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import (
    chat,
    decontaminate,
    divergence,
    language,
    lines,
    minhash,
    oracles,
    packing,
    quality,
    secrets,
    sharding,
    substrings,
    toxicity,
    whitening,
)
from tallybook.llm.common import read
from tallybook.session import work_dir

SHARDS = 16


def vocabulary() -> packing.Tokens:
    """The installed vocabulary files."""
    import public_tokenizers

    return packing.Tokens(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def held_out() -> Column:
    """Whether a row is held back from learning."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2, F.lit(False)).alias("held_out")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out())
    model = language.train(docs.filter(~F.col("held_out")).select("text", "lang"))
    return language.predict(docs.drop("lang"), model, ("doc_id", "held_out")).select("row.*", *language.PREDICTED)


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of all documents with their places; digests instead of ids are written, and numbered, before the plan."""
    pieces = packing.cut(docs, vocabulary())
    digests = pieces.select("row", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    placed = packing.place(packing.number(digests)).select("piece_row.*", "sequence_id", "offset")
    return placed.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanned with the base rules, then again with more rules: the second scan adds only those."""
    versions = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    ledger, rules = work_dir(spark, "secrets"), secrets.BASE + secrets.ADDED
    secrets.open_ledger(spark, ledger)
    secrets.scan(versions, ledger, secrets.BASE)
    secrets.scan(versions, ledger, rules)
    base = [r.kind for r in secrets.BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return secrets.findings(versions, ledger, rules).select(
        F.col("path").alias("doc_id"),
        *(count(k) for k in base),
        F.sha2(secrets.as_text(of_base), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
    )


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines, how many go, and a digest of the text that stays."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    return lines.deduped(docs).select("doc.doc_id", "n_lines", "n_removed", kept)


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.parsed(docs).select(
        "doc.doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs).select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings."""
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(1).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role"),
        said.alias("text"),
    )
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_turns(turns.withColumn("content", chat.text_part(F.col("text")))))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = minhash.grouped(read(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return groups.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sized(read(spark, sf_dir, "documents"))
    placed = sharding.shuffle_to_shards(rows, SHARDS)
    law = [F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")]
    return placed.select("row.*", *law)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it holds within the edit budget."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", held_out())
    labels = read(spark, sf_dir, "labels").filter(~held_out()).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.train(docs, labels), ("doc_id", "held_out"))
    return scored.select("row.*", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.components_of(read(spark, sf_dir, "embeddings"))
    deviation = F.col("deviation").cast("bigint").alias("deviation")
    return done.select("row.vec_id", "component", "n", deviation, "whitened", "explained", "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language,
        op2_packing,
        op3_secrets,
        op4_lines,
        op5_substrings,
        op6_quality,
        op7_chat,
        op8_minhash,
        op9_sharding,
        op10_decontamination,
        op11_toxicity,
        op12_divergence,
        op13_whitening,
    )
}
SQL: dict[str, str] = oracles.SQL
