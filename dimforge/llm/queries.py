"""The registered queries of the operators, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm import (
    byte_bpe,
    chat,
    hard_negatives,
    html_tree,
    langid,
    line_rules,
    mixing,
    packing,
    periodic_runs,
    pii_crf,
    signature_join,
    suffix_dedup,
    topk,
)

TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD = r"[^\x20\x09-\x0D]+"
LANG_WEIGHTS = {"en": 5, "de": 3, "fr": 2, "es": 2}  # other languages weigh 1


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def tokenizer_file(name: str = TOKENIZER) -> str:
    """Where a public tokenizer's file is; the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.extract_main_text(_read(spark, sf_dir, "pages"))


def language_weights(documents: DataFrame) -> DataFrame:
    """A weight for each leaf of the source tree, by its language."""
    weight = F.lit(1)
    for lang, w in LANG_WEIGHTS.items():
        weight = F.when(F.col("lang") == lang, w).otherwise(weight)
    keys = [F.coalesce(F.col(k), F.lit("none")).alias(k) for k in mixing.LEVELS]
    return documents.select(*keys).distinct().withColumn("weight", weight.cast("long"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = mixing.with_domain(_read(spark, sf_dir, "documents"))
    return mixing.mix(documents, language_weights(documents))


def op3_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.near_duplicates(_read(spark, sf_dir, "documents"))


def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_frequency_rules(_read(spark, sf_dir, "documents"))


def op5_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.find_personal_data(_read(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), tokenizer_file())


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_conversations(rows.unionByName(chat.control_conversation(spark))))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = tokenizer_file(BYTE_RANKS)
    encoded = byte_bpe.encode(_read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """A tenth of the documents, picked by the checksum of doc_id, repeat a passage up to their end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n = F.size(words).cast("long")

    def planted(w):
        a = g % F.size(w)
        p = 1 + F.floor((F.size(w) - a) / (3 + g % 8))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(
            F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")

    chosen = F.when(h.isNotNull() & (h % 10 == 0) & F.col("text").rlike(WORD), F.transform(F.array(words), planted)[0])
    return documents.select("doc_id", F.coalesce(chosen, F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_runs(_read(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).alias("lines"),
                         "collapsed")
    length, period = F.col("best.length"), -F.col("best.col3")
    return found.select("doc_id", "n_runs", (-F.col("best.col2")).alias("start"), length.alias("length"),
                        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
                        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine_hard_negatives(vectors, vectors.where(F.col("vec_id") % 50 == 0).select("vec_id"))


QUERIES = {f.__name__: f for f in (op1_html_tree, op2_mixing, op3_signature_join, op4_line_rules, op5_pii_crf,
                                   op6_suffix_dedup, op7_packing, op8_langid, op9_topk, op10_chat,
                                   op11_byte_bpe, op12_periodic_runs, op13_hard_negatives)}
_WEIGHT = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LANG_WEIGHTS.items()) + " ELSE 1 END"
# The other operators use a trained model or the tokenizer; tests/llm compares them with plain versions.
ORACLE: dict[str, str] = {"op2_mixing": mixing.mix_sql(_WEIGHT), "op3_signature_join": signature_join.NEAR_DUPLICATES_SQL,
                          "op4_line_rules": line_rules.LINE_FREQUENCY_SQL,
                          "op6_suffix_dedup": suffix_dedup.REMOVE_REPEATS_SQL, "op9_topk": topk.TOP_K_SQL,
                          "op10_chat": chat.DIGEST_SQL, "op13_hard_negatives": hard_negatives.HARD_NEGATIVES_SQL}
