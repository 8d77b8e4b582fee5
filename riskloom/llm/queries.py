"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, decontaminate, license_scan, line_crf, mix_sources, near_dedup, periodic_runs, prefix_trie, quality_rules, secret_scan,
               substring_dedup, suffix_dedup, token_pack)
from .common import read_table


def op1_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_pack.encode_and_read(read_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedupe(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    return judged.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read_table(spark, sf_dir, "documents"), license_scan.known_licenses(spark))
    return found.select("doc_id", "digest", "license", F.array_join("line_licenses", ",").alias("line_licenses"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    allotted = mix_sources.allot(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return allotted.select("row.doc_id", "size", "source_size", "target",
                           (F.col("size") * F.size("takes")).cast("long").alias("taken"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    says = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)],
                                  "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = chat_format.read_back(chat_format.format_chats(chat_format.messages_as_events(rows)))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length(F.array_join("loss_texts", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("loss_texts", ""), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (~F.col("contaminated")).alias("kept"), F.size("items").cast("long").alias("n_items"),
        F.array_join(F.transform("items", lambda x: x.item_id.cast("string")), ",").alias("item_ids"),
        F.coalesce(F.array_max(F.transform("items", lambda x: x.coverage)), F.lit(0.0)).alias("coverage"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = near_dedup.link(read_table(spark, sf_dir, "documents"))
    return linked.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedupe(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """Columns doc_id and text: each tenth document by crc32 of its id repeats the words from a place on with a period.

    h = crc32(decimal doc_id), g = floor(h / 10); if h % 10 = 0, each word i >= a = g % n becomes word a + (i - a) % p,
    p = 1 + floor((n - a) / (3 + g % 8)). A null doc_id or an empty text changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    text = F.coalesce("text", F.lit(""))
    planned = docs.select("doc_id", text.alias("text"), F.floor(h / 10).alias("g"), F.when(
        h % 10 == 0, F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).alias("words"))
    planned = planned.withColumn("n", F.size("words"))
    planned = planned.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    planned = planned.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) AS INT)"))
    repeated = F.expr("""array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p),
                         cast(ceil((n - a) / p) AS INT))), 1, n - a)), ' ')""")
    return planned.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse(with_repeats(read_table(spark, sf_dir, "documents")), digest=True)
    best = F.expr("""element_at(array_sort(runs, (x, y) -> CASE
        WHEN x.length * y.period > y.length * x.period THEN -1 WHEN x.length * y.period < y.length * x.period THEN 1
        WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1 WHEN x.period < y.period THEN -1
        WHEN x.period > y.period THEN 1 ELSE 0 END), 1)""")
    found = found.withColumn("best", F.when(F.size("runs") > 0, best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"),
                                                               r.period.cast("string")), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_scan.BASE]
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) AS LONG) AS n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed(F.col("spans"), kinds), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"))


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """conv_id and turns: the first h turns of conversation c - c % 100, then c's own after its first h; h = crc32(decimal c) % 6.

    A null conv_id keeps its own turns.
    """
    first = turns.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("first_id"), F.slice("turns", 1, 5).alias("head"))
    own = turns.withColumns({"first_id": F.expr("conv_id - conv_id % 100"),
                             "h": F.coalesce(F.crc32(F.col("conv_id").cast("string")) % 6, F.lit(0)).cast("int")})
    return own.join(first, "first_id", "left").select("conv_id", F.expr(
        "concat(slice(coalesce(head, slice(turns, 1, 0)), 1, h), slice(turns, h + 1, greatest(size(turns) - h, 0)))").alias("turns"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.conversations_as_turns(read_table(spark, sf_dir, "conversations"))
    nodes = prefix_trie.trie(rebuilt_conversations(turns))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


QUERIES = {
    "op1_token_pack": op1_token_pack,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_line_crf": op3_line_crf,
    "op4_quality_rules": op4_quality_rules,
    "op5_license_scan": op5_license_scan,
    "op6_mix_sources": op6_mix_sources,
    "op7_chat_format": op7_chat_format,
    "op8_decontaminate": op8_decontaminate,
    "op9_near_dedup": op9_near_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_secret_scan": op12_secret_scan,
    "op13_prefix_trie": op13_prefix_trie,
}


def registry() -> dict:
    from .oracles import SQL
    return {name: (fn, SQL.get(name)) for name, fn in QUERIES.items()}
