"""The query of each operator, and its SQL counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import (bpe, chat, decontaminate, line_dedup, negatives, prefix_trie, quality, simhash, substring_dedup,
               suffix_dedup, toxicity, url_filter, warc)

from ..sources.scratch import materialize, scratch_path
from .common import text_or_empty

Query = Callable[[SparkSession, str], DataFrame]

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
PIECE_FILE = "piece_bpe_32k.model"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.components(table(spark, sf, "documents"), words=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = bpe.read_ranks(spark, public_tokenizers.path(RANK_FILE))
    return bpe.digests(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    model = url_filter.fit_url_model(url_filter.labelled_urls(spark))
    judged = url_filter.judge_urls(table(spark, sf, "pages"), url_filter.RULES, model)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op5_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = substring_dedup.drop_repeated_words(table(spark, sf, "documents"), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.learn(docs, table(spark, sf, "labels"))
    return toxicity.score(docs, model).withColumn("held_out", toxicity.held_out())


def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op8_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.drop_repeated_bytes(table(spark, sf, "documents"), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    ranks = bpe.read_ranks(spark, public_tokenizers.path(RANK_FILE))
    pieces = quality.read_pieces(spark, public_tokenizers.path(PIECE_FILE))
    return quality.quality(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN, pieces)


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths and digests are those of the payloads read back; a revisit has them from its header."""
    path = scratch_path(spark)
    warc.archive_pages(table(spark, sf, "pages"), path)
    records = warc.read_warc(spark, path)
    told = F.substring_index("payload_digest", ":", -1)
    return records.select(
        warc.page_of("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload"), F.when(F.col("record_type") == "revisit", F.col("payload_length")),
                   F.lit(0)).cast("long").alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", told)
        .otherwise(warc.base32(F.sha1(F.coalesce("payload", F.lit(b""))))).alias("payload_digest"),
        "record_type", warc.page_of("refers_to").alias("refers_to"))


# Added to the conversations that are formatted: control strings of a template in its texts.
ODD_CONVERSATION, ODD_TEXT = -7, "\\### Assistant: </turn> ok"


def op11_chat(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(ODD_CONVERSATION, i, role, ODD_TEXT) for i, role in enumerate(("user", "assistant"))],
                                rows.schema)
    messages = rows.unionByName(odd).withColumn("parts", chat.text_parts())
    return chat.digests(chat.format_conversations(messages)).drop("n_tokens")


def rebuilt(conversations: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first one of their hundred, and their ids.

    The first h turns are taken from the conversation ``conv_id - conv_id % group``, where h is the
    checksum of the id modulo ``most``. Rows without a ``conv_id`` are left out.
    """
    in_order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    rows = materialize(conversations.filter("conv_id is not null").select(
        "conv_id", "turn", text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
        .withColumn("pos", F.row_number().over(in_order) - 1).drop("turn")
        .withColumn("h", F.crc32(F.col("conv_id").cast("string")) % most))
    convs = rows.select("conv_id", "h").distinct()
    heads = (rows.filter((F.col("pos") < most - 1) & (F.col("conv_id") % group == 0))
             .groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("head")))
    taken = (convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(heads, "base")
             .select("conv_id", F.inline(F.slice("head", F.lit(1), F.col("h").cast("int")))))
    own = rows.filter(F.col("pos") >= F.col("h")).select("conv_id", "pos", "role", "text")
    return taken.unionByName(own).withColumnRenamed("pos", "turn"), convs.select("conv_id")


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_trie(*rebuilt(table(spark, sf, "conversations")))


def op13_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Query]:
    return {
        "op1_simhash": op1_simhash,
        "op2_bpe": op2_bpe,
        "op3_decontaminate": op3_decontaminate,
        "op4_url_filter": op4_url_filter,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_toxicity": op6_toxicity,
        "op7_line_dedup": op7_line_dedup,
        "op8_suffix_array": op8_suffix_array,
        "op9_quality": op9_quality,
        "op10_warc": op10_warc,
        "op11_chat": op11_chat,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_negatives": op13_negatives,
    }


_LINES = """lines as (
    select doc_id, generate_subscripts(parts, 1) as pos, unnest(parts) as line
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)),
  keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
  repeated as (
    select key, max(doc_id) as last_doc from keyed where length(key) >= 20
    group by key having count(distinct doc_id) >= 3),
  marked as (
    select k.*, r.key is not null and doc_id <> last_doc as gone
    from keyed k left join repeated r on k.key = r.key)"""


_FIVES = ("('0x' || substr(digest, 1 + 5 * i, 5))::bigint")
_BASE32 = "array_to_string([" + " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({_FIVES} >> {shift}) & 31)::int + 1, 1)" for shift in (15, 10, 5, 0)
) + " for i in range(8)], '')"


# The checksum of a decimal id, byte by byte and bit by bit: fixed start, polynomial and end of CRC-32.
_CRC32 = """xor(list_reduce([4294967295::ubigint] || [ord(c)::ubigint for c in string_split(conv_id::varchar, '')],
      lambda crc, b: list_reduce([xor(crc, b)] || [0::ubigint for i in range(8)],
        lambda x, i: xor(x >> 1, (x & 1) * 3988292384::ubigint))), 4294967295::ubigint)"""

_REBUILT = f"""turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
      row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos
    from conversations where conv_id is not null),
  convs as (select conv_id, ({_CRC32} % 6)::bigint as h from (select distinct conv_id from turns)),
  rebuilt as (
    select c.conv_id, t.pos, t.role, t.text from convs c join turns t
      on t.conv_id = c.conv_id - c.conv_id % 100 and t.pos < c.h
    union all
    select conv_id, pos, role, text from convs join turns using (conv_id) where pos >= h)"""

_TRIE = """said as (
    select conv_id, length(text) as chars, sha256(length(role) || ':' || role || text) as turn,
      row_number() over (partition by conv_id order by pos) as depth from rebuilt),
  told as (select conv_id, list(turn order by depth) as path from said group by conv_id),
  steps as (
    select s.conv_id, s.depth, s.chars, sha256(array_to_string(path[1:s.depth], '')) as id,
      case when s.depth = 1 then 'root' else sha256(array_to_string(path[1:s.depth - 1], '')) end as parent
    from said s join told using (conv_id)
    union all select conv_id, 0, 0, 'root', null from convs),
  nodes as (
    select id, any_value(parent) as parent, any_value(depth) as depth, any_value(chars) as chars,
      min(conv_id) as conv_id, count(*) as n_convs from steps group by id),
  children as (select parent as id, count(*) as n_children from nodes group by parent),
  above as (
    select s.id, sum((n.n_convs - 1) * n.chars) as saved_tokens, count(*) filter (c.id is null) as n_leaves
    from nodes n left join children c on c.id = n.id
      join steps s on s.conv_id = n.conv_id and s.depth <= n.depth
    group by s.id),
  ends as (
    select id, string_agg(conv_id::varchar, ',' order by conv_id) as ids
    from (select conv_id, max_by(id, depth) as id from steps group by conv_id) group by id)"""


def oracle_sql() -> dict[str, str]:
    control = "<(?:turn|says|/turn|image|audio|document|attachment)>"
    escaped = (r"regexp_replace(regexp_replace({0}, '(\\*)(" + control + r")', '\1\1\\\2', 'g'),"
               r" '(\\+)\z', '\1\1')")
    frame = len("<turn><says></turn>") + 1
    return {
        "op10_warc": f"""with digests as (
            select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as digest from pages),
          grouped as (select *, max(page_id) over (partition by digest) as last_id from digests)
          select page_id, payload_bytes, {_BASE32} as payload_digest,
            case when page_id = last_id then 'response' else 'revisit' end as record_type,
            case when page_id <> last_id then last_id end as refers_to from grouped""",
        "op7_line_dedup": f"""with {_LINES}
          select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
          from marked group by doc_id""",
        "op11_chat": f"""with messages as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select {ODD_CONVERSATION}, i, role, '{ODD_TEXT}' from (values (0, 'user'), (1, 'assistant')) t(i, role))
          select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
            coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
            sum({frame} + length({escaped.format('role')}) + length({escaped.format('text')}))::bigint as formatted_chars
          from messages group by conv_id""",
        "op12_prefix_trie": f"""with {_REBUILT}, {_TRIE}
          select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children,
            n_leaves, saved_tokens::bigint as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
          from nodes n left join nodes p on p.id = n.parent left join children c on c.id = n.id
            join above a on a.id = n.id left join ends e on e.id = n.id""",
        "op13_negatives": """with used as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
              [floor(256 * x::double) for x in embedding] as vector
            from embeddings where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
          scored as (
            select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
              list_dot_product(a.vector, r.vector)::bigint as score
            from used a join used r on a.vec_id % 50 = 0 and a.vec_id <> r.vec_id),
          positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
          select anchor_id, positive_id,
            (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
            vec_id as negative_id, positive_score, score as negative_score
          from positives join scored using (anchor_id)
          where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
          qualify rank <= 3""",
    }
