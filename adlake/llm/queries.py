"""Registered queries of the operators, each next to its SQL counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from adlake.llm import audit, bpe, chat, decontaminate, licenses, mixing, quality, secrets, shards, simhash, tokens, turns, urls
from adlake.llm.common import prepared, table
from adlake.operators.relational import join_reduced

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

UPPER = f"'{urls.UPPER}', '{urls.LOWER}'"


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


URL_RULES = (
    urls.Rule("block", "net"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)
# A page with one of these in its html puts its URL on the list.
JUNK_RUNS = ("###", "***", "$$$", "%%%")
_CANONICAL = f"""
CASE WHEN bare <> '' THEN bare || regexp_replace(path, '/+\\z', '') || CASE WHEN tail = '' THEN '' ELSE '?' || tail END END
"""


@query("op1_url_filter", f"""
WITH rest AS (
  SELECT page_id, html, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), {UPPER}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1) AS query
  FROM rest
), spelled AS (
  SELECT *, regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)\\z', '') AS bare,
         array_to_string(list_sort(list_filter(string_split(query, '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '{urls.TRACKING}'))), '&') AS tail
  FROM parts
), named AS (SELECT *, {_CANONICAL} AS canonical FROM spelled),
list AS (
  SELECT DISTINCT canonical FROM named WHERE canonical IS NOT NULL AND ({" OR ".join(f"contains(html, '{j}')" for j in JUNK_RUNS)})
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
    canonical IS NOT NULL AND canonical IN (FROM list) AS listed
  FROM named
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict, canonical, listed
FROM ruled""")
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    junk = reduce(lambda a, b: a | b, [F.contains("html", F.lit(j)) for j in JUNK_RUNS])
    return urls.url_filter(pages.select("page_id", "url"), pages.filter(junk).select("url"), URL_RULES).drop("url")


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return tokens.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), 4096)


@query("op3_sharding")
def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    dealt = shards.shard(table(spark, folder, "documents"), ["doc_id"])
    return dealt.select(
        "row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, folder, "documents"))
    return found.select("doc_id", "n_matches", F.array_join("licenses", ",").alias("licenses"), "best", "best_dice")


# A conversation whose texts are made of control strings.
PLANTED = "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"


def _escaped_sql(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in chat.INSTRUCT.controls:
        out = f"replace({out}, '{c}', '{c[0]}\\-{c[1:]}')"
    return out


def _role_sql(pick) -> str:
    known = "".join(f" WHEN '{n}' THEN '{pick(m)}'" for n, m in chat.INSTRUCT.roles.items() if n)
    return f"CASE role{known} ELSE '{pick(chat.INSTRUCT.roles[chat.OTHER])}' END"


_NAMED = ", ".join(f"'{n}'" for n in chat.INSTRUCT.roles if n)


@query("op5_chat_format", f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
), pieces AS (
  SELECT *, {_role_sql(lambda m: m.open)} || CASE WHEN role IN ({_NAMED}) THEN '' ELSE {_escaped_sql('role')} || '{chat.INSTRUCT.named}' END
    || {_escaped_sql('text')} || {_role_sql(lambda m: m.close)} AS piece
  FROM turns
), whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         string_agg(piece, '' ORDER BY turn NULLS FIRST, role, text) AS formatted,
         string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, '' ORDER BY turn NULLS FIRST, role, text) AS path
  FROM pieces GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       length(formatted) AS formatted_chars, regexp_full_match(path, 's?(ua)+') AS valid
FROM whole""")
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.format_chats(rows.unionByName(spark.sql(PLANTED)))
    turns = made.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.learned_text(F.col("segments")))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), " + UPPER + "), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query("op6_decontaminate", f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS span
  FROM (SELECT item, words, least(10, len(words)) AS size, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
spans AS (
  SELECT row, size, unnest(range(1, len(words) - size + 2)) AS i,
         unnest(list_transform(range(1, len(words) - size + 2), lambda i: array_to_string(words[i:i + size - 1], ' '))) AS span
  FROM docs, sizes WHERE len(words) >= size
), hits AS (SELECT row, i, size, item FROM spans JOIN windows USING (size, span)),
covered AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS place FROM hits) GROUP BY row),
found AS (SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (row) LEFT JOIN found USING (row)""")
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = (table(spark, folder, t) for t in ("documents", "benchmark"))
    return decontaminate.decontaminate(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


@query("op7_mixing")
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mix(table(spark, folder, "documents"), ["doc_id"])
    return mix.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(table(spark, folder, "documents"))


@query("op9_simhash_dedup")
def op9_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"))


@query("op11_bpe_codec")
def op11_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, folder, "documents"), *vocabulary)
    return bpe.decode(encoded, *vocabulary).select(
        "doc_id", "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


_RUNS = "regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+')"


@query("op12_filter_audit", f"""
WITH base AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
firsts AS (SELECT body, min(doc_id) AS least FROM base GROUP BY body),
held AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, CASE WHEN len(words) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > 5 * length(body) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails, good, toxic
  FROM (SELECT *, {_RUNS} AS words FROM base) JOIN firsts USING (body) LEFT JOIN held USING (doc_id)
), cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS letter, left(filter_order, step - 1) AS before FROM orders, (SELECT unnest(range(1, 6))::INT AS step)
), judged AS (
  SELECT *, contains(fails, letter) AS failed, translate(fails, before, '') = fails AS alive FROM cells, steps
), counted AS (
  SELECT part, filter_order, step, letter, sum(CASE WHEN alive AND NOT failed THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN alive AND failed THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN failed AND NOT alive THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = letter THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN alive AND failed THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN alive AND failed THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted""")
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    return audit.interactions(audit.masked(docs, audit.text_rules, "E", labels), "ABCDE").drop("letter")


# States of a repaired conversation: 0 empty, 1 behind system, 2 behind user, 3 behind assistant.
@query("op13_turn_repair", r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), kinds AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 20 AS kind
  FROM named, crc
), hurt AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS again
  FROM kinds WHERE kind <> 0
), convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
copies AS (
  SELECT c, turn, role, text, row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST) AS copy
  FROM hurt JOIN convs ON hurt.conv_id IS NOT DISTINCT FROM convs.conv_id
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS j,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS last
  FROM copies
), judged AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY c ORDER BY j) || left(role, 1) AS pair
  FROM placed
), moves AS (
  SELECT * FROM (VALUES (0, 0, 0, ''), (0, 1, 2, 'user:'), (0, 2, 3, 'user:' || chr(10) || 'assistant:'), (1, 0, 1, ''), (1, 1, 2, 'user:'),
    (1, 2, 3, 'user:' || chr(10) || 'assistant:'), (2, 0, 2, ''), (2, 1, 3, 'assistant:'), (2, 2, 2, 'assistant:' || chr(10) || 'user:'),
    (3, 0, 3, ''), (3, 1, 2, 'user:'), (3, 2, 3, 'user:' || chr(10) || 'assistant:')) AS m(state, inserts, mid, lines)
), ops AS (
  SELECT * FROM (VALUES (0, 'K', 's', 1, ''), (0, 'K', 'u', 2, ''), (1, 'K', 'u', 2, ''), (2, 'K', 'a', 3, ''), (3, 'K', 'u', 2, ''),
    (0, 'R', NULL, 2, 'user'), (1, 'R', NULL, 2, 'user'), (2, 'R', NULL, 3, 'assistant'), (3, 'R', NULL, 2, 'user'),
    (0, 'D', NULL, 0, ''), (1, 'D', NULL, 1, ''), (2, 'D', NULL, 2, ''), (3, 'D', NULL, 3, '')) AS o(mid, op, initial, behind, new_role)
), paths AS (
  SELECT c, 0::BIGINT AS j, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM convs
  UNION ALL
  SELECT c, j, state, cost, audit, lines FROM (
    SELECT p.c, p.j + 1 AS j, o.behind AS state,
           p.cost + 2 * m.inserts + CASE o.op WHEN 'R' THEN 2 WHEN 'D' THEN 3 ELSE 0 END + CASE WHEN o.op <> 'D' AND r.fault = 'truncated' THEN 1 ELSE 0 END AS cost,
           p.audit || repeat('I', m.inserts) || o.op AS audit,
           p.lines || CASE WHEN m.lines = '' THEN '' ELSE chr(10) || m.lines END
             || CASE o.op WHEN 'D' THEN '' ELSE chr(10) || CASE o.op WHEN 'K' THEN r.role ELSE o.new_role END || ':' || r.text END AS lines
    FROM paths p JOIN judged r ON r.c = p.c AND r.j = p.j + 1 JOIN moves m ON m.state = p.state JOIN ops o ON o.mid = m.mid
    WHERE (o.op = 'D' OR r.fault NOT IN ('blank', 'duplicate')) AND (o.op <> 'K' OR o.initial = left(r.role, 1))
  ) QUALIFY row_number() OVER (PARTITION BY c, state ORDER BY cost, audit) = 1
), sizes AS (SELECT c, count(j) AS n FROM convs LEFT JOIN judged USING (c) GROUP BY c),
ends AS (
  SELECT c, cost + CASE state WHEN 2 THEN 2 WHEN 1 THEN 4 ELSE 0 END AS cost, audit || CASE state WHEN 2 THEN 'I' WHEN 1 THEN 'II' ELSE '' END AS audit,
         lines || CASE state WHEN 2 THEN chr(10) || 'assistant:' WHEN 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:' ELSE '' END AS lines
  FROM paths JOIN sizes USING (c) WHERE j = n
), best AS (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY c ORDER BY cost, audit) = 1),
facts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY c
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, cost, audit, sha256(substr(lines, 2)) AS repaired_sha256
FROM convs JOIN best USING (c) LEFT JOIN facts USING (c)""")
def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    found = turns.summaries(turns.repair(turns.damaged(rows)))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    joined = join_reduced(rows.select("conv_id").distinct(), found, {"conv_id": "conv"}, "left", null_safe=True)
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(prepared(spark), folder)
