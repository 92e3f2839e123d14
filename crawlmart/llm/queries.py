"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmart import runtime
from crawlmart.llm import (
    chat, idfiles, jaccard, language, mixing, nearest, negatives, packing, pages, periods, pii,
    quality, secrets,
)
from crawlmart.llm.common import pinned, table, words_of
from crawlmart.llm.oracles import ORACLES as ORACLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def sha256(text: str | Column) -> Column:
    return F.sha2(text, 256)


@query
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    placed, mixed = mixing.plan(docs)
    return mixing.taken(placed, mixed).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "first_slot"
    )


@query
def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(table(spark, sf_dir, "documents"))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in secrets.BASE],
        sha256(secrets.written("base")).alias("base_sha256"),
        secrets.written("all").alias("spans"),
    )


@query
def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    found = nearest.nearest(rows.filter("vec_id % 20 = 0"), rows, k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(language.fold("doc_id") == 1, F.lit(False))
    docs = docs.withColumn("held_out", held)
    model = language.train(docs.filter("not held_out"))
    return language.predict(docs.drop("lang"), model, ["doc_id", "held_out"])


@query
def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        F.col("in_0").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lost_words",
    )


def tokenizer_path() -> str:
    """The vocabulary file of op8; a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op8_sequence_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    return found.select(
        "doc_id", *[f"n_{k}" for k in pii.KINDS], sha256("base").alias("base_sha256"), "spans"
    )


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    rows = rows.unionByName(spark.createDataFrame(own, rows.schema))
    out = chat.format_conversations(rows).select(
        "*", F.explode(F.array(chat.read_back(F.col("formatted")))).alias("turns")
    )
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    out = out.select(
        "*", F.explode(F.array(chat.loss_text(F.col("segments")))).alias("loss")
    )
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256(F.array_join(told, "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        sha256("loss").alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "complete",
    )


def bytes_tokenizer_path() -> str:
    """The vocabulary file of op11; a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op11_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = runtime.new_dir(spark, "token-ids")
    idfiles.write(table(spark, sf_dir, "documents"), path, bytes_tokenizer_path())
    return idfiles.read(spark, path, ids=False)


def with_period(docs: DataFrame) -> DataFrame:
    """The texts that op12 is asked about: one in ten, by its id, ends in repeated words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    text = F.col("text").cast("string")
    docs = docs.select("doc_id", text.alias("text"), h.alias("h"), F.floor(h / 10).alias("g"))
    docs = pinned(docs, words=F.when(F.col("h") % 10 == 0, words_of(F.col("text"))))
    docs = pinned(docs, n=F.size("words"))
    docs = docs.withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    docs = pinned(docs, a_=F.col("a"), p=period.cast("int"))
    moved = F.transform(
        "words",
        lambda w, i: F.when(i < F.col("a_"), w).otherwise(
            F.get("words", F.col("a_") + (i - F.col("a_")) % F.col("p"))
        ),
    )
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.find(with_period(table(spark, sf_dir, "documents")))
    line = F.transform(
        "runs",
        lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                           r["period"].cast("string"), F.lit("\n")),
    )
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        sha256(F.array_join(line, "")).alias("runs_sha256"),
        sha256("collapsed").alias("collapsed_sha256"),
    )


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return negatives.mine(rows.filter("vec_id % 100 = 0"), rows)
