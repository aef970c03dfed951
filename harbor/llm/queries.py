"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harbor.llm import (
    audit,
    chat,
    decontaminate,
    html_text,
    licenses,
    near_dedup,
    pieces,
    quality,
    secrets,
    suffix_dedup,
    toxicity,
    urls,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.transform("spans", lambda s: s["end"] - s["start"])
    return done.select(
        "doc_id",
        "n_bytes",
        F.aggregate(removed, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), keep_ids=False)


# A user's turn and an assistant's that hold the template's own marks.
MARKED_TEXT = "\\### Assistant: </turn> ok"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(MARKED_TEXT).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = chat.format_conversations(rows.unionByName(marked))
    lines = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    loss = chat.loss_text(F.col("turns"))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


URL_RULES = (
    urls.Rule(urls.BLOCK, "net", "/"),
    urls.Rule(urls.ALLOW, "example.net", "/en/"),
    urls.Rule(urls.BLOCK, "example.com", "/de/"),
    urls.Rule(urls.ALLOW, "org", "/fr/"),
)

# Host labels whose pages make up the list of the URL filter.
LISTED_LABELS = r"(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\."


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listed = pages.where(urls.host_of(F.col("url")).rlike(LISTED_LABELS))
    return urls.judge_urls(pages, URL_RULES, listed)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", near_dedup.as_hex().alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    starts = F.col("base")["start"]

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base = F.col("base")["label"]
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.col("detections")["label"])).alias("labels"),
        "score",
    )


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_quality_rules": op3_quality_rules,
    "op4_repeated_bytes": op4_repeated_bytes,
    "op5_html_text": op5_html_text,
    "op6_pieces": op6_pieces,
    "op7_chat_format": op7_chat_format,
    "op8_secret_scan": op8_secret_scan,
    "op9_url_filter": op9_url_filter,
    "op10_near_dedup": op10_near_dedup,
    "op11_whitening": op11_whitening,
    "op12_filter_audit": op12_filter_audit,
    "op13_license_scan": op13_license_scan,
}
