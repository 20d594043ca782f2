"""Extractors: what is made of each article."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from spindrift.functions.grammar import plain_text
from spindrift.operators.links import page_links
from spindrift.operators.sections import section_tree

Extractor = Callable[[DataFrame], DataFrame]


@F.pandas_udf(StringType())
def to_plain_text(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Plain text of wikitext that an XML reader has decoded."""
    for s in texts:
        yield s.map(lambda t: plain_text(t, decode_entities=False), na_action="ignore")


@F.pandas_udf(StringType())
def raw_to_plain_text(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Plain text of bare wikitext, whose entities are decoded first."""
    for s in texts:
        yield s.map(plain_text, na_action="ignore")


def links(articles: DataFrame) -> DataFrame:
    """articles(title, text) as (title, record): the page's links as JSON."""
    return page_links(articles).select("title", F.to_json(F.struct("title", "links")).alias("record"))


def contents(articles: DataFrame) -> DataFrame:
    """articles(title, text) as (title, record): the tree of sections of the plain text as JSON."""
    return articles.select("title", section_tree("title", to_plain_text("text")).alias("record"))


EXTRACTORS: dict[str, Extractor] = {"links": links, "contents": contents}


def extract(articles: DataFrame, extractor: str | Extractor) -> DataFrame:
    """By a name of EXTRACTORS, or any function of a DataFrame of articles; each is a narrow transformation."""
    return (EXTRACTORS[extractor] if isinstance(extractor, str) else extractor)(articles)


def register_extractor(spark: SparkSession, name: str, f: Callable[[str, str | None], Iterable[tuple]], schema: str) -> None:
    """Makes f(title, text), which gives rows of schema, a table function of SQL, called for each article by a lateral join:

        SELECT p.title, e.* FROM pages p, LATERAL headings(p.title, p.text) e
    """

    class Extractor:
        def eval(self, title: str, text: str) -> Iterator[tuple]:
            yield from f(title, text)

    spark.udtf.register(name, F.udtf(Extractor, returnType=schema))


def register_functions(spark: SparkSession) -> None:
    """plain_text(text) and raw_plain_text(text) as functions of SQL: of decoded text, and of text whose entities are still to decode."""
    spark.udf.register("plain_text", to_plain_text)
    spark.udf.register("raw_plain_text", raw_to_plain_text)
