"""The operators' queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opalgrid.llm import bytebpe, chat, fingerprint, language, neardup, neighbours, packing, quality, repair, resampling, tokenbin, toxicity, warc
from opalgrid.llm.common import cut, scratch, small_batches, stored, table

SQL: dict[str, str] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quartile_digest(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.audit(table(spark, folder, "documents"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    placed = packing.pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_nearest_toxic(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.learn(docs, table(spark, folder, "labels")))


def op4_language_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Documents (their source is the host; nothing is declared) and web pages, under one text model."""
    docs, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    model = language.learn(docs)
    of_docs = language.identified(docs.select("doc_id", "text", "source"), model, host=F.col("source"))
    parts = language.page_parts(pages.select("page_id", "url", "html"))
    columns = {c: F.col(c) for c in ("host", "domain", "declared", "suffix")}
    of_pages = language.identified(parts, model, **columns)
    found = ["lang_found", "probability", "text_lang", "accepted"]
    none = F.lit(None)
    rows = of_docs.select("doc_id", none.cast("long").alias("page_id"), F.col("source").alias("host"), none.cast("string").alias("declared"), *found)
    return rows.unionByName(of_pages.select(none.cast("long").alias("doc_id"), "page_id", "host", "declared", *found))


def with_damage(rows: DataFrame) -> DataFrame:
    """Archive records with what a damaged copy holds in their place: some with a changed byte, some cut, some missing."""
    n = F.coalesce(F.col("page_id"), F.lit(0))
    changed = F.concat(F.substring("record", 1, 20), F.lit("~").cast("binary"), F.expr("substring(record, 22)"))
    short = F.expr("substring(record, 1, octet_length(record) - 9)")
    copy = F.when(n % 307 == 19, None).when(n % 97 == 13, changed).when(n % 211 == 17, short).otherwise(F.col("record"))
    return rows.withColumn("copy_length", F.octet_length(copy).cast("long")).withColumn("copy_digest", F.sha2(copy, 256))


def op5_merkle_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Damage found between archive files of all pages and a replica of them with damage of known places."""
    rows = with_damage(warc.records(table(spark, folder, "pages")))
    both = cut(warc.leaves(rows, beside=["copy_length", "copy_digest"]))
    # Damage leaves records where they are: the replica has the offsets of the original.
    copied = both.where("copy_digest IS NOT NULL").select("file", "offset", F.col("copy_length").alias("length"), "page_id", F.col("copy_digest").alias("digest"))
    return warc.audit(both.select("file", "offset", "length", "page_id", "digest"), copied)


_RECORD = """
    SELECT CAST(page_id // 2048 AS BIGINT) AS file, page_id,
           strlen('WARC/1.1') + 2 + strlen('WARC-Type: response') + 2 + strlen('WARC-Target-URI: ' || url) + 2 + strlen('Content-Type: text/html') + 2
           + strlen('Content-Length: ' || CAST(strlen(html) AS VARCHAR)) + 4 + strlen(html) + 4 AS length
    FROM pages"""
SQL["op5_merkle_audit"] = f"""
WITH records AS ({_RECORD}),
placed AS (SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM records)
SELECT file, "offset", page_id,
       CASE WHEN page_id % 307 = 19 THEN 'missing' WHEN page_id % 97 = 13 THEN 'changed' ELSE 'cut' END AS damage,
       CAST(length AS BIGINT) AS length,
       CAST(CASE WHEN page_id % 307 = 19 THEN NULL WHEN page_id % 97 = 13 THEN length ELSE length - 9 END AS BIGINT) AS replica_length
FROM placed WHERE page_id % 307 = 19 OR page_id % 97 = 13 OR page_id % 211 = 17"""


def op6_additive_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.scored(docs, quality.learn(docs, table(spark, folder, "labels")))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bytebpe.round_trip(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = f"{scratch(spark)}/tokens-{uuid.uuid4().hex}"
    written = cut(tokenbin.write(table(spark, folder, "documents"), files, vocabulary("byte_bpe_50k.json")))
    rows = tokenbin.read(spark, files).withColumn("ids_crc32", F.crc32("ids"))
    return tokenbin.with_starts(rows, written).select("doc_id", "start", "n_tokens", "ids_crc32", "file")


def op9_weighted_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.classes(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", F.lower(F.hex("_label")).alias("class_key"), "class_size", "links")


def op10_posting_lists(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), "vec_id % 50 = 0")


def op11_importance_draw(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair(table(spark, folder, "conversations"))


#: CRC32 of the strings of a table `given` (s), which DuckDB has no function for: crcs (s, crc), by a table of 256 steps.
_CRC = """
steps AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
digits AS (SELECT s, hex(s) AS h, strlen(s) AS n FROM (SELECT DISTINCT s FROM given)),
crcs AS (SELECT s, xor(list_reduce(list_prepend(4294967295, list_transform(range(n), lambda i: CAST('0x' || h[2 * i + 1 : 2 * i + 2] AS BIGINT))),
                                   lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc FROM digits, steps)"""
SQL["op11_importance_draw"] = rf"""
WITH texts AS (SELECT doc_id, 0 AS side, coalesce(text, '') AS text FROM documents UNION ALL SELECT item_id, 1, coalesce(text, '') FROM benchmark),
found AS (SELECT doc_id, side, row_number() OVER () AS one,
                 regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
given AS (SELECT unnest(words) AS s FROM found), {_CRC},
features AS (SELECT one, side, crc % 10000 AS bucket FROM (SELECT one, side, unnest(words) AS s FROM found) JOIN crcs USING (s)),
counts AS (SELECT bucket, sum(1 - side) AS s, sum(side) AS t FROM features GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE) / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS gain FROM counts),
weights AS (SELECT one, sum(gain) AS weight FROM features JOIN gains USING (bucket) WHERE side = 0 GROUP BY one),
scored AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                  CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
           FROM found LEFT JOIN weights USING (one) WHERE side = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, sum(CAST(n_features >= 20 AS INT)) OVER () AS able FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= able * 10 // 100 THEN place END AS rank FROM placed"""


SQL["op12_conversation_repair"] = rf"""
WITH RECURSIVE originals AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
given AS (SELECT s FROM originals), {_CRC},
drawn AS (SELECT *, crc % 20 AS kind FROM originals JOIN crcs USING (s)),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS again
            FROM drawn WHERE kind <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), again) AS i FROM damaged),
rows AS (SELECT *, role[1:1] AS initial, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair,
                CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM numbered),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows GROUP BY conv_id),
edits(a, b, initial, op, price) AS (VALUES (0, 1, 's', 'K', 0), (0, 2, 'u', 'K', 0), (1, 2, 'u', 'K', 0), (3, 2, 'u', 'K', 0), (2, 3, 'a', 'K', 0),
                                    (0, 2, '', 'R', 2), (1, 2, '', 'R', 2), (3, 2, '', 'R', 2), (2, 3, '', 'R', 2), (0, 0, '', 'D', 3), (1, 1, '', 'D', 3), (2, 2, '', 'D', 3), (3, 3, '', 'D', 3)),
more(b, c, ins) AS (VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'I'), (1, 2, 'I'), (3, 2, 'I'), (2, 3, 'I'), (0, 3, 'II'), (1, 3, 'II')),
best AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, c AS state, struct_pack(cost := CAST(2 * length(ins) AS BIGINT), audit := ins) AS one FROM counts, more WHERE b = 0
    UNION ALL
    SELECT w.conv_id, w.i + 1, m.c, min(struct_pack(cost := CAST(w.one.cost + e.price + 2 * length(m.ins) + CASE WHEN r.fault = 'truncated' AND e.op <> 'D' THEN 1 ELSE 0 END AS BIGINT), audit := w.one.audit || e.op || m.ins))
    FROM best w JOIN rows r ON r.conv_id = w.conv_id AND r.i = w.i + 1 JOIN edits e ON e.a = w.state AND (e.initial = '' OR e.initial = r.initial) AND (e.op = 'D' OR r.fault IN ('', 'truncated')) JOIN more m ON m.b = e.b
    GROUP BY w.conv_id, w.i + 1, m.c),
ended AS (SELECT conv_id, min(one) AS one FROM best JOIN counts USING (conv_id) WHERE i = n AND state IN (0, 3) GROUP BY conv_id),
letters AS (SELECT conv_id, p, one.audit[p:p] AS op, length(replace(one.audit[1:p], 'I', '')) AS i FROM (SELECT conv_id, one, unnest(range(1, length(one.audit) + 1)) AS p FROM ended)),
left_over AS (SELECT l.*, r.role, r.text, row_number() OVER (PARTITION BY l.conv_id ORDER BY p) AS q, first_value(op = 'K' AND r.initial = 's') OVER (PARTITION BY l.conv_id ORDER BY p) AS led
              FROM letters l LEFT JOIN rows r ON r.conv_id = l.conv_id AND r.i = l.i AND l.op <> 'I' WHERE l.op <> 'D'),
said AS (SELECT conv_id, sha256(string_agg(CASE WHEN op = 'K' THEN role WHEN (q % 2 = 1) <> led THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN op = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS hash FROM left_over GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(one.cost, 0) AS cost, coalesce(one.audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counts USING (conv_id) LEFT JOIN ended USING (conv_id) LEFT JOIN said USING (conv_id)"""

#: What the planted conversation says twice.
SLY = r"\### Assistant: </turn> ok"


def op13_prefix_tree_chat(spark: SparkSession, folder: str) -> DataFrame:
    planted = spark.createDataFrame([(-7, 0, "user", SLY), (-7, 1, "assistant", SLY)], "conv_id long, turn long, role string, text string")
    rows = chat.table_of(table(spark, folder, "conversations")).unionByName(chat.table_of(planted))
    return chat.read(stored(chat.trees(rows), "shards"))


_ESCAPED = r"replace(replace(replace({}, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')"
SQL["op13_prefix_tree_chat"] = rf"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -7, 0, 'user', '{SLY}' UNION ALL SELECT -7, 1, 'assistant', '{SLY}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || replace({_ESCAPED.format("role")}, ':', '\:') || ': ' || {_ESCAPED.format("text")} || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""


def with_small_batches(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        small_batches(spark)
        return query(spark, folder)

    return run


_ALL = {
    "op1_quartile_digest": op1_quartile_digest,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_nearest_toxic": op3_nearest_toxic,
    "op4_language_evidence": op4_language_evidence,
    "op5_merkle_audit": op5_merkle_audit,
    "op6_additive_quality": op6_additive_quality,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_token_files": op8_token_files,
    "op9_weighted_minhash": op9_weighted_minhash,
    "op10_posting_lists": op10_posting_lists,
    "op11_importance_draw": op11_importance_draw,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_prefix_tree_chat": op13_prefix_tree_chat,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: with_small_batches(q) for k, q in _ALL.items()}
