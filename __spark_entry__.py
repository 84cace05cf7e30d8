"""Entry points for checks: the flagship query, every query, and their SQL counterparts."""

from __future__ import annotations

import logging
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE))

from tagshelf import sources
from tagshelf.functions.stopwords import ENGLISH_STOP_WORDS
from tagshelf.operators import (clusters, columns, embed, english, filters, profiles, reports, search, texts,
                                tokens)
from tagshelf.plans import standin

# The training-data operators and their pipeline can be taken away as a whole, and need
# libraries that the others do without. A pipeline elsewhere on the path belongs to another copy.
try:
    if not (HERE / "corpus_pipeline.py").is_file():
        raise ImportError("no corpus_pipeline.py beside the entry points")
    import corpus_pipeline
    from tagshelf.llm import entries as llm
except ImportError as missing:
    logging.getLogger("tagshelf").warning("without the training-data operators: %s", missing)
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

# The search text of the single-query searches and the digits compared.
SEARCH_TEXT = "src3 goods goods nothing"
DIGITS = 6


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the ten products most similar to each of a table of queries."""
    return queries()["recommend_batch"](spark, "/root/testdata/sf0.001")


# ---- queries ---------------------------------------------------------------

def _on_products(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf: operator(standin.products(spark, sf), *args, **kwargs)


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return columns.with_completeness(standin.products(spark, sf))


def _joined_arrays(df: DataFrame, *names: str) -> DataFrame:
    return df.select("url", *[F.array_join(n, "|").alias(n) for n in names])


def _all_tokens(spark: SparkSession, sf: str) -> DataFrame:
    df = tokens.add_all_tokens(standin.products(spark, sf))
    names = ["categories_tokens", "main_category_tokens", "all_tokens"]
    return _joined_arrays(df.withColumn("all_tokens", F.sort_array("all_tokens")), *names)


def _clean_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _joined_arrays(tokens.process_tokens(standin.products(spark, sf)), "all_tokens", "tokens")


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Word vectors, written once as they are after training."""
    return sources.materialize(standin.vectors(spark, sf))


def _embedded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The embedded products, and the word vectors they are made of."""
    vectors = _vectors(spark, sf)
    return embed.embed_rows(standin.tokenised(spark, sf), vectors), vectors


def _long(df: DataFrame, key: str, vector: str) -> DataFrame:
    return (df.select(key, F.posexplode(vector).alias("pos", "value"))
            .withColumn("value", F.round("value", DIGITS)))


def _embed_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _long(_embedded(spark, sf)[0], "url", "embedding")


def _word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors of a saved model as the operator gives them, against the file they are saved in."""
    path = sources.scratch_path(spark)
    sources.save_word_model(_trained(spark, sf)[1], path)
    saved = spark.read.parquet(f"{path}/data").select("word", F.col("vector").cast("array<double>").alias("saved"))
    got = embed.word_vectors(sources.load_word_model(path))
    return got.join(saved, "word", "full").select(
        "word", F.coalesce(F.col("vector") == F.col("saved"), F.lit(False)).alias("same"), _non_zero("vector"))


def _query_vector(spark: SparkSession, sf: str) -> DataFrame:
    found = search.query_vectors(standin.queries(spark, sf), _vectors(spark, sf), lower=True)
    return _long(found, "query_id", "vector")


def _query_coverage(spark: SparkSession, sf: str) -> DataFrame:
    vocab = tokens.vocabulary(standin.tokenised(spark, sf))
    return search.query_coverage(standin.queries(spark, sf), vocab, lower=True)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return embed.with_norm(standin.table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")))


def _first_vector(df: DataFrame) -> list[float]:
    return df.filter("vec_id = 0").first()["embedding"]


def _cosine_similarity(spark: SparkSession, sf: str) -> DataFrame:
    df = _labelled(spark, sf)
    return search.cosine_similarity(df, _first_vector(df), DIGITS).select("vec_id", "similarity")


def _topk_similar(spark: SparkSession, sf: str) -> DataFrame:
    df = _labelled(spark, sf)
    best = search.top_similar(df, _first_vector(df), 10, "vec_id", DIGITS)
    return best.select("vec_id", "similarity")


def _recommend(spark: SparkSession, sf: str) -> DataFrame:
    products, vectors = _embedded(spark, sf)
    best = search.recommend(products, SEARCH_TEXT, vectors, digits=DIGITS)
    return best.select("url", "code", "similarity")


def _recommend_display(spark: SparkSession, sf: str) -> DataFrame:
    products, vectors = _embedded(spark, sf)
    best = search.recommend_display(products, SEARCH_TEXT.upper(), vectors)
    return best.withColumn("similarity", F.round("similarity", DIGITS))


def _recommend_batch(spark: SparkSession, sf: str) -> DataFrame:
    products, vectors = _embedded(spark, sf)
    return search.recommend_batch(products, standin.queries(spark, sf), vectors, lower=True, digits=DIGITS)


def _clustered(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The products stored by cluster, and the centres."""
    paths = [sources.scratch_path(products.sparkSession) for _ in range(2)]
    dealt, centres = clusters.cluster_products(sources.materialize(products))
    sources.write_parquet(dealt, paths[0], by="cluster")
    sources.write_parquet(centres, paths[1])
    return tuple(sources.read_parquet(products.sparkSession, path) for path in paths)


def _topk_similar_clustered(spark: SparkSession, sf: str) -> DataFrame:
    df = _labelled(spark, sf)
    best = clusters.top_similar_clustered(*_clustered(df), _first_vector(df), 10, "vec_id", DIGITS)
    return best.select("vec_id", "similarity")


def _recommend_clustered(spark: SparkSession, sf: str) -> DataFrame:
    products, vectors = _embedded(spark, sf)
    query = search.text_vector(SEARCH_TEXT, vectors)
    best = clusters.top_similar_clustered(*_clustered(products), query, digits=DIGITS)
    return best.select("url", "code", "similarity")


def _recommend_batch_clustered(spark: SparkSession, sf: str) -> DataFrame:
    products, vectors = _embedded(spark, sf)
    queries = search.query_vectors(standin.queries(spark, sf), vectors, lower=True)
    return clusters.nearest_clustered(*_clustered(products), queries, digits=DIGITS)


def _nearest_clustered(spark: SparkSession, sf: str) -> DataFrame:
    """Every fiftieth stored vector as a query against all."""
    df = _labelled(spark, sf)
    asked = df.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return clusters.nearest_clustered(*_clustered(df), asked, key="vec_id", digits=DIGITS)


def _match_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    words = standin.table(spark, sf, "benchmark").select(F.explode(texts.text_words("text")).alias("word"))
    return texts.match_vocabulary(standin.table(spark, sf, "conversations"), words, ["conv_id", "turn"])


def _match_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of one to four words, taken from the benchmark's items, in all documents."""
    entries = texts.split_phrases(standin.table(spark, sf, "benchmark"), 4)
    return texts.match_vocabulary(standin.table(spark, sf, "documents"), entries, ["doc_id"])


def _split_ingredients(spark: SparkSession, sf: str) -> DataFrame:
    return texts.split_ingredients(standin.table(spark, sf, "benchmark"), "item_id")


def _csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = sources.scratch_path(spark)
    sources.write_delimited(standin.products(spark, sf), path)
    return sources.read_delimited(spark, path, ",", multi_line=True)


def _csv_gzip_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = sources.scratch_path(spark)
    sources.write_delimited(standin.products(spark, sf), path, "\t", compression="gzip")
    return sources.read_delimited(spark, path, "\t", multi_line=True,
                                  min_partitions=spark.sparkContext.defaultParallelism)


def _parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = sources.scratch_path(spark)
    sources.write_parquet(standin.products(spark, sf), path)
    return sources.read_parquet(spark, path)


def _stored_products(spark: SparkSession, sf: str, **options) -> str:
    path = sources.scratch_path(spark)
    sources.write_parquet(standin.products(spark, sf), path, **options)
    return path


def _parquet_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Scored products in files of one size, sorted by score, and those over the threshold read back."""
    path = sources.scratch_path(spark)
    sources.write_parquet(_scored(spark, sf), path, order=["completeness"], file_bytes=4 << 20, group_bytes=1 << 20)
    return filters.filter_complete(sources.read_parquet(spark, path))


def _embed_changed(spark: SparkSession, sf: str) -> DataFrame:
    """A delivery against an older one: some rows are new, some have other tokens."""
    vectors = _vectors(spark, sf)
    products = sources.materialize(standin.tokenised(spark, sf))
    other = F.when(F.col("code") % 3 == 1, F.slice("tokens", 1, 1)).otherwise(F.col("tokens"))
    older = embed.embed_rows(products.filter("code % 4 <> 2").withColumn("tokens", other), vectors)
    return _long(embed.embed_changed(products, sources.materialize(older), vectors), "url", "embedding")


def _trained(spark: SparkSession, sf: str) -> tuple[DataFrame, object]:
    df = standin.tokenised(spark, sf)
    return df, embed.fit_word_model(df)


def _non_zero(vector: str) -> Column:
    return F.exists(vector, lambda x: ~F.isnan(x) & (x != 0)).alias("non_zero")


def _w2v_fit_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vectors = embed.word_vectors(_trained(spark, sf)[1])
    return vectors.select("word", F.size("vector").cast("bigint").alias("n_values"), _non_zero("vector"))


def _w2v_transform(spark: SparkSession, sf: str) -> DataFrame:
    """The model's own embedding against the join with its vectors."""
    df, model = _trained(spark, sf)
    joined = embed.embed_rows(df, sources.materialize(embed.word_vectors(model)))
    both = embed.embed_with_model(df, model).select("url", "embedding").join(
        joined.select("url", F.col("embedding").alias("joined")), "url", "full")
    close = F.forall(F.zip_with("embedding", "joined", lambda x, y: F.abs(x - y) < 1e-6), lambda x: x)
    return both.select("url", F.size("embedding").cast("bigint").alias("n_values"),
                       F.coalesce(close, F.lit(False)).alias("agrees"), _non_zero("embedding"))


def _w2v_save_load(spark: SparkSession, sf: str) -> DataFrame:
    model = _trained(spark, sf)[1]
    path = sources.scratch_path(spark)
    sources.save_word_model(model, path)
    saved = embed.word_vectors(sources.load_word_model(path)).withColumnRenamed("vector", "loaded")
    both = embed.word_vectors(model).join(saved, "word", "full")
    return both.select("word", F.coalesce(F.col("vector") == F.col("loaded"), F.lit(False)).alias("same"))


def _bounded_records(spark: SparkSession, sf: str) -> DataFrame:
    """The first products as records on the driver, and a table of these again."""
    found = profiles.records(standin.products(spark, sf).orderBy("url"), 20)
    return spark.createDataFrame(found, standin.products(spark, sf).schema)


def queries() -> dict[str, Query]:
    """Every query by name, each a function of the session and the folder of the tables."""
    if llm is None:
        return core_queries()
    return {**core_queries(), **llm.queries(), "pipeline": corpus_pipeline.run}


def core_queries() -> dict[str, Query]:
    """The queries that need nothing of ``tagshelf.llm``."""
    return {
        # sources and sinks
        "csv_roundtrip": _csv_roundtrip,
        "csv_gzip_roundtrip": _csv_gzip_roundtrip,
        "parquet_roundtrip": _parquet_roundtrip,
        "parquet_ordered": _parquet_ordered,
        "w2v_save_load": _w2v_save_load,
        # profiles
        "preview": _on_products(profiles.preview, order=["url"]),
        "bounded_records": _bounded_records,
        "schema_profile": _on_products(profiles.schema_profile),
        "null_profile": _on_products(profiles.null_profile),
        "stored_null_profile": lambda spark, sf: sources.stored_null_profile(spark, _stored_products(spark, sf)),
        "stored_filled_columns": lambda spark, sf: sources.read_filled_columns(spark, _stored_products(spark, sf)),
        "stage_counts": _on_products(profiles.stage_counts),
        "completeness_stats": lambda spark, sf: _rounded_stats(_scored(spark, sf)),
        # columns
        "drop_null_columns_fixed": _on_products(columns.drop_null_columns_fixed),
        "drop_all_null_columns": _on_products(columns.drop_all_null_columns),
        "drop_columns_matching": _on_products(columns.drop_columns_matching),
        "drop_columns_suffix": _on_products(columns.drop_columns_suffix),
        "drop_unused_columns": _on_products(columns.drop_unused_columns),
        "completeness": lambda spark, sf: _scored(spark, sf).select("url", "completeness"),
        # filters
        "filter_country": _on_products(filters.filter_country, "fr"),
        "filter_complete": lambda spark, sf: filters.filter_complete(_scored(spark, sf)),
        "drop_null_rows": _on_products(filters.drop_null_rows),
        "non_english_tag_check": lambda spark, sf: profiles.row_count(
            english.non_english_tags(standin.products(spark, sf))),
        # joins and sets
        "non_english_codes": _on_products(english.non_english_codes),
        "english_only": _on_products(english.english_only),
        # reports
        "count_by_country": _on_products(reports.count_by_country),
        "count_by_nutriscore": _on_products(reports.count_by_nutriscore),
        "count_by_nova": _on_products(reports.count_by_nova),
        "explode_tags": _on_products(reports.explode_tags),
        "top_categories": _on_products(reports.top_categories),
        "top_main_categories": _on_products(reports.top_main_categories),
        "top_name_words": _on_products(reports.top_name_words),
        "tag_count_histogram": _on_products(reports.tag_count_histogram),
        # tokens
        "all_tokens": _all_tokens,
        "clean_tokens": _clean_tokens,
        # embeddings and search
        "w2v_fit_vectors": _w2v_fit_vectors,
        "w2v_transform": _w2v_transform,
        "word_vectors": _word_vectors,
        "embed_rows": _embed_rows,
        "embed_changed": _embed_changed,
        "query_vector": _query_vector,
        "cosine_similarity": _cosine_similarity,
        "topk_similar": _topk_similar,
        "topk_similar_clustered": _topk_similar_clustered,
        "nearest_clustered": _nearest_clustered,
        "recommend": _recommend,
        "recommend_clustered": _recommend_clustered,
        "recommend_batch_clustered": _recommend_batch_clustered,
        "recommend_display": _recommend_display,
        "recommend_batch": _recommend_batch,
        "query_coverage": _query_coverage,
        # texts
        "split_ingredients": _split_ingredients,
        "match_vocabulary": _match_vocabulary,
        "match_phrases": _match_phrases,
    }


def _rounded_stats(df: DataFrame) -> DataFrame:
    stats = profiles.completeness_stats(df)
    return stats.withColumns({c: F.round(c, DIGITS) for c in ("mean", "stddev")})


# ---- the same in SQL -------------------------------------------------------

_P = "products as (select " + ", ".join(f'{sql} as "{c}"' for c, sql in standin.PRODUCTS.items()) + " from documents)"
_SCORE = ("round((" + " + ".join(f"case when {c} is not null then 1 else 0 end"
                                  for c in columns.COMPLETENESS_COLUMNS) + ") / 6.0::double, 3)")
_SCORED = f"{_P}, scored as (select * replace ({_SCORE} as completeness) from products)"

_BAD = """bad as (
    select code from (select code, trim(unnest(string_split(main_category, ','))) as t from products)
    where not starts_with(t, 'en:')
    union
    select code from (select code, trim(unnest(string_split(categories_tags, ','))) as t from products)
    where not starts_with(t, 'en:'))"""

_STOPS = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)
_SLUGS = "[replace(x, 'en:', '') for x in string_split({0}, ',') if starts_with(x, 'en:')]"
_TOKENS = f"""parts as (
    select *, case when categories_tags is not null then {_SLUGS.format('categories_tags')} end as categories_tokens,
      case when main_category is not null then {_SLUGS.format('main_category')} end as main_category_tokens
    from products),
  unioned as (
    select *, case when categories_tags is not null and main_category is not null
      then list_sort(list_distinct(list_concat(categories_tokens, main_category_tokens))) end as phrases
    from parts),
  worded as (
    select *, case when phrases is not null then list_sort(list_distinct(
      [w for w in string_split_regex(lower(replace(array_to_string(phrases, ' '), '-', ' ')), '\\s+') if w <> '']
      )) end as words
    from unioned),
  tokenised as (
    select *, case when words is not null then [w for w in words if w not in ({_STOPS})] end as tokens
    from worded)"""

_VECTORS = f"""{_P}, {_TOKENS},
  vocab as (select distinct unnest(tokens) as word from tokenised),
  vectors as (
    select word, embedding::double[] as vector from vocab join embeddings
    on vec_id = ('0x' || substring(md5(word), 1, 7))::bigint % (select count(*) from embeddings)),
  vector_items as (
    select word, unnest(vector) as value, unnest(range(len(vector))) as pos from vectors)"""

_EMBEDDED = f"""{_VECTORS},
  embedded as (
    select url, pos, sum(value) / any_value(len(tokens)) as value
    from (select url, tokens, unnest(tokens) as word from tokenised) join vector_items using (word)
    group by url, pos)"""

_QUERIES = ("queries as (select distinct " + ", ".join(f"{sql} as {c}" for c, sql in standin.QUERIES.items())
            + " from documents)")
_QUERY_WORDS = f"""{_QUERIES},
  query_words as (
    select query_id, unnest([w for w in string_split_regex(lower(text), '\\s+') if w <> '']) as word from queries)"""
_QUERY_VECTORS = f"""{_QUERY_WORDS},
  query_vectors as (
    select query_id, pos, avg(value) as value from query_words join vector_items using (word) group by query_id, pos)"""

_SIMILAR = """scores as (
    select query_id, url, sum(e.value * q.value) / sqrt(sum(e.value * e.value)) / sqrt(sum(q.value * q.value)) as raw,
      round(raw, 6) as similarity
    from embedded e join query_vectors q using (pos) group by query_id, url),
  ranked as (
    select *, row_number() over (partition by query_id order by similarity desc, url) as rank from scores)"""

_ONE_QUERY = ("query_words as (select 1 as query_id, unnest(string_split('" + SEARCH_TEXT + "', ' ')) as word),"
              " query_vectors as (select query_id, pos, avg(value) as value"
              " from query_words join vector_items using (word) group by query_id, pos)")

_COSINE = """select e.vec_id, round(list_dot_product(e.embedding::double[], q.embedding::double[])
      / sqrt(list_dot_product(e.embedding::double[], e.embedding::double[]))
      / sqrt(list_dot_product(q.embedding::double[], q.embedding::double[])), 6) as similarity
  from embeddings e, (select embedding from embeddings where vec_id = 0) q"""


# Of all entries at all places those are taken that a reader from left to right meets first, the
# longest of one place; ``next`` is the first place that the one taken doesn't cover.
_MATCH_PHRASES = """with recursive items as (
    select list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') as words from benchmark),
  cut as (
    select words, unnest(range(0, len(words), 10)) as start from items),
  vocab as (
    select distinct array_to_string(words[start + k * (k - 1) // 2 + 1:start + k * (k + 1) // 2], ' ') as word, k
    from cut, unnest([1, 2, 3, 4]) t(k) where start + k * (k + 1) // 2 <= len(words)),
  worded as (
    select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') as words
    from documents),
  places as (
    select doc_id, unnest(range(1, len(words) + 1)) as place, unnest(words) as word from worded),
  ahead as (
    select doc_id, place, word as w1, word || ' ' || lead(word, 1) over d as w2,
      word || ' ' || lead(word, 1) over d || ' ' || lead(word, 2) over d as w3,
      word || ' ' || lead(word, 1) over d || ' ' || lead(word, 2) over d || ' ' || lead(word, 3) over d as w4
    from places window d as (partition by doc_id order by place)),
  grams as (
    select doc_id, place, unnest([w1, w2, w3, w4]) as word, unnest([1, 2, 3, 4]) as k from ahead),
  spans as materialized (
    select doc_id, place, max(k) as k, max_by(word, k) as word, place + max(k) as behind
    from grams join vocab using (word, k) group by doc_id, place),
  steps as materialized (
    select s.doc_id, s.place, s.word, n.place as next
    from spans s asof left join spans n on n.doc_id = s.doc_id and n.place >= s.behind),
  taken as (
    select doc_id, place, word, next from steps
    qualify row_number() over (partition by doc_id order by place) = 1
    union all
    select s.doc_id, s.place, s.word, s.next from taken t join steps s on s.doc_id = t.doc_id and s.place = t.next)
  select doc_id, word, count(*) as "count" from taken group by all"""


def _with(views: str, select: str) -> str:
    return f"with {views} {select}"


def _products_without(dropped: Callable[[str], bool]) -> str:
    kept = ", ".join(f'"{c}"' for c in standin.PRODUCTS if not dropped(c))
    return _with(_P, f"select {kept} from products")


def _count_by(column: str, limit: str = "") -> str:
    return _with(_P, f'select {column}, count(*) as "count" from products group by {column}'
                     f' order by "count" desc, {column} nulls first {limit}')


def _per_column(select: Callable[[int, str], str]) -> str:
    return _with(_P, " union all ".join(f"select {select(i, c)} from products"
                                        for i, c in enumerate(standin.PRODUCTS)))


def _as_written_to_text() -> str:
    """Values as they come back from text: empty ones are NULL."""
    return _with(_P, "select " + ", ".join(f"""nullif("{c}", '') as "{c}\"""" for c in standin.PRODUCTS) + " from products")


def _stage_counts() -> str:
    steps = {
        "all": "true",
        "country": "countries_tags like '%en:fr%'",
        "complete": "countries_tags like '%en:fr%' and completeness > 0.5",
        "filled": "countries_tags like '%en:fr%' and completeness > 0.5 and product_name is not null"
                  " and categories_tags is not null and main_category is not null",
    }
    counts = [f"select '{name}' as stage, count(*) as rows from scored where {test}" for name, test in steps.items()]
    bad = _BAD.replace("from products", "from filled")
    english_count = ("select 'english' as stage, count(*) as rows from filled f"
                     " where not exists (select 1 from bad where bad.code = f.code)")
    return _with(f"{_SCORED}, filled as (select * from scored where {steps['filled']}), {bad}",
                 " union all ".join([*counts, english_count]))


def oracle_sql() -> dict[str, str]:
    """The SQL counterpart of each query that has one, for DuckDB over the same tables."""
    if llm is None:
        return core_oracle_sql()
    whole = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {**core_oracle_sql(), **llm.oracle_sql(), **whole}


def core_oracle_sql() -> dict[str, str]:
    """The SQL counterpart of each of ``core_queries``."""
    display = ", ".join(columns.DISPLAY_COLUMNS)
    one = _with(f"{_EMBEDDED}, {_ONE_QUERY}, {_SIMILAR}", "{0}")
    vocabulary = f"{_P}, {_TOKENS}, vocab as (select distinct unnest(tokens) as word from tokenised)"
    return {
        "csv_roundtrip": _as_written_to_text(),
        "csv_gzip_roundtrip": _as_written_to_text(),
        "parquet_roundtrip": _with(_P, "select * from products"),
        "parquet_ordered": _with(_SCORED, "select * from scored where completeness > 0.5"),
        "w2v_save_load": _with(vocabulary, "select word, true as same from vocab"),

        "preview": _with(_P, "select * from products order by url limit 20"),
        "bounded_records": _with(_P, "select * from products order by url limit 20"),
        "schema_profile": _per_column(
            lambda i, c: f"""{i}::bigint as position, '{c}' as "column", 'string' as data_type,
                {'100g' in c} as is_nutrition, count("{c}") as non_null"""),
        "null_profile": _per_column(lambda i, c: f"""'{c}' as "column", count("{c}") as non_null"""),
        "stored_null_profile": _per_column(lambda i, c: f"""'{c}' as "column", count("{c}") as non_null"""),
        "stored_filled_columns": _products_without(lambda c: c in ("cities", "allergens_en")),
        "stage_counts": _stage_counts(),
        "completeness_stats": _with(_SCORED, """select count(completeness) as "count",
            round(avg(completeness), 6) as mean, round(stddev_samp(completeness), 6) as stddev,
            min(completeness) as "min", max(completeness) as "max" from scored"""),

        "drop_null_columns_fixed": _products_without(lambda c: c in ("cities", "allergens_en")),
        "drop_all_null_columns": _products_without(lambda c: c in ("cities", "allergens_en")),
        "drop_columns_matching": _products_without(
            lambda c: c in ("countries_tags", "packaging", "states_en", "cities", "energy_100g")),
        "drop_columns_suffix": _products_without(lambda c: c in ("created_t", "last_modified_datetime")),
        "drop_unused_columns": _products_without(lambda c: c in ("creator", "categories", "completeness")),
        "completeness": _with(_SCORED, "select url, completeness from scored"),

        "filter_country": _with(_P, "select * from products where countries_tags like '%en:fr%'"),
        "filter_complete": _with(_SCORED, "select * from scored where completeness > 0.5"),
        "drop_null_rows": _with(_P, "select * from products where product_name is not null"
                                    " and categories_tags is not null and main_category is not null"),
        "non_english_tag_check": _with(_P, """select count(*) as rows from
            (select trim(unnest(string_split(categories_tags, ','))) as tag from products)
            where not starts_with(tag, 'en:')"""),

        "non_english_codes": _with(f"{_P}, {_BAD}", "select code from bad"),
        "english_only": _with(f"{_P}, {_BAD}", "select * from products p where not exists"
                                               " (select 1 from bad where bad.code = p.code)"),

        "count_by_country": _count_by("countries_tags"),
        "count_by_nutriscore": _count_by("nutriscore_grade"),
        "count_by_nova": _count_by("nova_group"),
        "explode_tags": _with(_P, """select url, (generate_subscripts(tags, 1) - 1)::int as pos, unnest(tags) as tag
            from (select url, string_split(categories_tags, ',') as tags from products)"""),
        "top_categories": _with(_P, """select category, count(*) as "count" from
            (select unnest(string_split(categories_tags, ',')) as category from products)
            group by category order by "count" desc, category limit 10"""),
        "top_main_categories": _count_by("main_category", "limit 20"),
        "top_name_words": _with(_P, """select word, count(*) as "count" from (select unnest(string_split_regex(
            regexp_replace(lower(product_name), '[^a-zA-Z ]', '', 'g'), '\\s+')) as word from products)
            where regexp_full_match(word, '[a-z]{3,}') group by word order by "count" desc, word limit 30"""),
        "tag_count_histogram": _with(_P, """select len(string_split(categories_tags, ','))::int as num_categories,
            count(*) as "count" from products group by 1 order by 1"""),

        "all_tokens": _with(f"{_P}, {_TOKENS}", """select url,
            array_to_string(categories_tokens, '|') as categories_tokens,
            array_to_string(main_category_tokens, '|') as main_category_tokens,
            array_to_string(phrases, '|') as all_tokens from tokenised"""),
        "clean_tokens": _with(f"{_P}, {_TOKENS}", """select url, array_to_string(words, '|') as all_tokens,
            array_to_string(tokens, '|') as tokens from tokenised"""),

        "w2v_fit_vectors": _with(vocabulary, "select word, 100::bigint as n_values, true as non_zero from vocab"),
        "w2v_transform": _with(f"{_P}, {_TOKENS}", "select url, 100::bigint as n_values, true as agrees,"
                                                   " len(tokens) > 0 as non_zero from tokenised where tokens is not null"),
        "word_vectors": _with(vocabulary, "select word, true as same, true as non_zero from vocab"),
        "embed_rows": _with(_EMBEDDED, "select url, pos::int as pos, round(value, 6) as value from embedded"),
        "embed_changed": _with(_EMBEDDED, "select url, pos::int as pos, round(value, 6) as value from embedded"),
        "query_vector": _with(f"{_VECTORS}, {_QUERY_VECTORS}",
                              "select query_id, pos::int as pos, round(value, 6) as value from query_vectors"),
        "cosine_similarity": _COSINE,
        "topk_similar": f"{_COSINE} order by similarity desc, e.vec_id limit 10",
        "topk_similar_clustered": f"{_COSINE} order by similarity desc, e.vec_id limit 10",
        "nearest_clustered": """with scores as (
              select q.vec_id as query_id, e.vec_id, round(list_dot_product(e.embedding::double[], q.embedding::double[])
                / sqrt(list_dot_product(e.embedding::double[], e.embedding::double[]))
                / sqrt(list_dot_product(q.embedding::double[], q.embedding::double[])), 6) as similarity
              from embeddings e join embeddings q on q.vec_id % 50 = 0)
            select query_id, (row_number() over (partition by query_id order by similarity desc, vec_id))::int as rank,
              vec_id, similarity from scores qualify rank <= 10""",
        "recommend": one.format("select url, code, similarity from ranked join products using (url) where rank <= 10"),
        "recommend_clustered": one.format(
            "select url, code, similarity from ranked join products using (url) where rank <= 10"),
        "recommend_display": one.format(
            f"select {display}, similarity, printf('%.2f', raw * 100) as similarity_text"
            " from ranked join products using (url) where rank <= 10"),
        "recommend_batch": _with(f"{_EMBEDDED}, {_QUERY_VECTORS}, {_SIMILAR}",
                                 "select query_id, rank::int as rank, url, similarity from ranked where rank <= 10"),
        "recommend_batch_clustered": _with(f"{_EMBEDDED}, {_QUERY_VECTORS}, {_SIMILAR}",
                                           "select query_id, rank::int as rank, url, similarity from ranked where rank <= 10"),
        "query_coverage": _with(f"{vocabulary}, {_QUERY_WORDS}", """select query_id,
            count(v.word) as known_words, count(w.word) - count(v.word) as unknown_words
            from queries q left join query_words w using (query_id) left join vocab v on v.word = w.word
            group by query_id"""),

        "split_ingredients": """select item_id, pos::int as pos, ingredient from (
            select item_id, generate_subscripts(parts, 1) - 1 as pos,
              lower(regexp_replace(unnest(parts), '^\\s+|\\s+$', '', 'g')) as ingredient
            from (select item_id, string_split(text, ',') as parts from benchmark)) where ingredient <> ''""",
        "match_vocabulary": """with vocab as (
              select distinct unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) as word from benchmark),
            words as (
              select conv_id, turn, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) as word
              from conversations)
            select conv_id, turn, word, count(*) as "count" from words join vocab using (word)
            where word <> '' group by all""",
        "match_phrases": _MATCH_PHRASES,
    }
