"""Queries of the operators on texts and people."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomgrid.llm import leakage, markup, people, pii, sentences, tokens


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def everybody(spark: SparkSession, folder: str) -> DataFrame:
    """The person records of all services."""
    tables = [_table(spark, folder, f"people_{t}").withColumn("source", F.lit(t)) for t in ("github", "slack", "jira")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of records of one person in different services."""
    return people.pairs(people.match(everybody(spark, folder))).select("rec_id_a", "rec_id_b")


def p1_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs with the confidence of each."""
    return people.pairs(people.match(everybody(spark, folder)))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Headings, list items, code blocks and formulas of the marked-up texts of tickets."""
    return markup.elements(markup.fields(_table(spark, folder, "tickets")))


def p3_text(spark: SparkSession, folder: str) -> DataFrame:
    """Clean text of the marked-up texts of tickets."""
    return markup.clean(markup.fields(_table(spark, folder, "tickets")))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in the free texts of tickets."""
    return pii.detect(pii.fields(_table(spark, folder, "tickets"))).drop("end_at")


def p5_text(spark: SparkSession, folder: str) -> DataFrame:
    """The free texts of tickets with typed placeholders."""
    return pii.redact(pii.fields(_table(spark, folder, "tickets")))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode(_table(spark, folder, "documents"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold passages of evaluation items, with the items."""
    return leakage.leaks(_table(spark, folder, "eval_items"), _table(spark, folder, "documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sentence units of every document."""
    return sentences.split(_table(spark, folder, "documents"))


QUERIES = {"p1_found": p1_found, "p1_matches": p1_matches, "p3_found": p3_found, "p3_text": p3_text, "p5_found": p5_found, "p5_text": p5_text, "p8_ids": p8_ids, "p9_found": p9_found, "p10_found": p10_found}
ORACLES: dict[str, str] = {}
