"""op1_url_filter: a verdict for every URL of ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotmarket.llm.common import table
from lotmarket.llm.url_rules import HostRule, judge

#: The explicit rules.
RULES = (HostRule("allow", "com", "/"), HostRule("block", "example.com", "/en/"), HostRule("allow", "www.example.com", "/en/"),
         HostRule("block", "net", "/es/"), HostRule("block", "net", "/fr/"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, table(spark, sf_dir, "labels"), RULES).select(
        "page_id", "host", "path", "rule", "verdict", "rule_confidence")


QUERIES = {"op1_url_filter": op1_url_filter}
