"""A product catalogue, word vectors and queries derived from general tables.

``documents`` and ``embeddings`` hold no tags and no words, so these views stand
in for a catalogue. The expressions are SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.english import TAG_COLUMNS
from ..operators.filters import drop_null_rows
from ..operators.tokens import process_tokens, vocabulary

PRODUCTS = {
    "code": "case when doc_id % 97 = 96 then null"
            " when doc_id % 50 = 49 then cast(doc_id - 1 as varchar(20))"
            " else cast(doc_id as varchar(20)) end",
    "url": "concat('https://example.org/p/', cast(doc_id as varchar(20)))",
    "creator": "'x'",
    "created_t": "cast(doc_id as varchar(20))",
    "last_modified_datetime": "concat('2024-01-0', cast(doc_id % 9 + 1 as varchar(2)))",
    "product_name": "case when doc_id % 17 = 0 then null else text end",
    "generic_name": "case when doc_id % 3 = 0 then null when doc_id % 3 = 1 then '' else source end",
    "brands": "source",
    "categories": "source",
    "categories_tags": "case when doc_id % 19 = 0 then null else"
                       " concat('en:', source, '-goods,', lang, ':', case when n_chars < 500"
                       " then 'short-text' else 'long-text-of-the-day' end) end",
    "main_category": "case when doc_id % 23 = 0 then null else"
                     " concat(case when doc_id % 29 = 0 then 'fr' else 'en' end, ':item-', source) end",
    "categories_en": "case when doc_id % 2 = 0 then source end",
    "ingredients_tags": "case when doc_id % 5 < 3 then concat('en:', lang) end",
    "ingredients_analysis_tags": "case when doc_id % 7 < 5 then 'en:vegan' end",
    "countries_tags": "case when doc_id % 4 = 0 then 'en:france'"
                      " when doc_id % 4 = 1 then 'en:belgium,en:france'"
                      " when doc_id % 4 = 2 then 'en:french-guiana' else 'en:germany' end",
    "packaging": "lang",
    "states_en": "lang",
    "cities": "cast(null as varchar(10))",
    "allergens_en": "cast(null as varchar(10))",
    "nutriscore_grade": "substring('abcde', cast(doc_id % 5 as int) + 1, 1)",
    "nova_group": "cast(doc_id % 4 + 1 as varchar(2))",
    "energy_100g": "cast(n_chars as varchar(20))",
    "image_url": "concat('https://example.org/i/', cast(doc_id as varchar(20)), '.jpg')",
    "completeness": "'0.5'",
}

# One query per pair of source and language; those in one language know no word.
QUERIES = {
    "query_id": "concat(source, '-', lang)",
    "text": "case lang when 'es' then '  ES mesa ' when 'fr' then concat(source, ' ', source, ' Goods zzz')"
            " when 'de' then concat('long ', source) else concat(' ', source, ' text  Item ') end",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in catalogue over ``documents``; ``url`` is its unique key."""
    documents = table(spark, sf_dir, "documents")
    return documents.selectExpr(*[f"{sql} as `{name}`" for name, sql in PRODUCTS.items()])


def tokenised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products that have tokens, with them: those with both tag columns."""
    return process_tokens(drop_null_rows(products(spark, sf_dir), TAG_COLUMNS))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector for each token of the catalogue, picked from ``embeddings`` by a hash of the word."""
    given = table(spark, sf_dir, "embeddings")
    count = given.agg(F.count("*")).scalar()
    hashed = F.conv(F.substring(F.md5("word"), 1, 7), 16, 10).cast("bigint")
    words = vocabulary(tokenised(spark, sf_dir)).withColumn("vec_id", hashed % count)
    return words.join(given, "vec_id").select("word", F.col("embedding").cast("array<double>").alias("vector"))


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of queries as ``query_id``, ``text``."""
    documents = table(spark, sf_dir, "documents")
    return documents.select("source", "lang").distinct().selectExpr(
        *[f"{sql} as {name}" for name, sql in QUERIES.items()])
