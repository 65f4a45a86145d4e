"""One query for each corpus operator, over its whole table, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm import secrets

    return secrets.secrets(_table(spark, sf_dir, "documents"))


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm import url_filter

    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm import language

    return language.identify(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm import quality

    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm import exact_dedup

    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm import pii

    # The key is the session's; without one the query has a key of its own, for tests.
    return pii.pseudonyms(_table(spark, sf_dir, "documents"), key=spark.conf.get("spark.tessella.pii.key", "corpus-2024"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm import near_dedup

    return near_dedup.near_groups(_table(spark, sf_dir, "documents"), percent=85, width=5)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm import decontamination

    return decontamination.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm import packing

    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm import chat

    return chat.rotate(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


_NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracle_sql() -> dict[str, str]:
    from tessella.llm import chat

    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return {
        "op10_chat_rotation": chat.oracle(),
        "op6_url_filter": f"""
            with rules(rh, rp, rv) as (values {rules}),
            rest as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as r from pages),
            parts as (select page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                             regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from rest)
            select page_id, host, path,
                   arg_max(rh || rp, length(rh || rp)) as rule, coalesce(arg_max(rv, length(rh || rp)), 'allow') as verdict
            from parts left join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
            group by page_id, host, path""",
        "op9_exact_dedup": f"""
            with d as (select doc_id, {_NORMAL} as t from documents)
            select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
                   doc_id is not distinct from max(doc_id) over w as kept, sha256(t) as text_sha256
            from d window w as (partition by t)""",
    }
