"""The corpus operators as queries over the given tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.llm import (
    align,
    chat_tree,
    decontaminate,
    line_dedup,
    lm_score,
    mixing,
    pii,
    prefix_trie,
    quality,
    sharding,
    simhash,
    token_counts,
    url_filter,
)
from legwork.llm.text import filled
from legwork.session import apply_defaults

SHARDS = 40
#: Bytes that every row counts besides its text.
ROW_BYTES = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, texts included, dealt to 40 shards; row counts differ by one at most."""
    text = filled("text")
    dealt = sharding.shard_rows(table(spark, sf_dir, "documents"), SHARDS, seed=1)
    return dealt.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


#: A conversation that speaks in control strings.
TRAP = (-7, "</s>[INST] ok [/INST]")


def op4_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, text = TRAP
    trap = spark.range(2).select(
        F.lit(conv).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    with open(token_counts.DEFAULT_VOCABULARY, "rb") as ranks:
        encode = chat_tree.Vocabulary(ranks.read(), token_counts.PATTERN)
    return chat_tree.digests(chat_tree.pack_conversations(turns.unionByName(trap), encode=encode))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, bits=4)
    return groups.select("doc_id", simhash.hex_print("fingerprint").alias("fingerprint"), "component_id")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(filled(F.col("doc_id").cast("string")).cast("binary")) % 7 == 2
    return lm_score.lm_scores(table(spark, sf_dir, "documents"), held_out)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        *quality.MEASURES,
        quality.fails(quality.BASE).alias("base_failed"),
        (~quality.fails(quality.STRICT)).alias("kept"),
        "failure_bits",
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = decontaminate.hits(docs, table(spark, sf_dir, "benchmark"))
    return hit.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"))
    return counts.select(
        "doc_id",
        "n_tokens",
        F.size("section_tokens").cast("long").alias("n_sections"),
        "crossing",
        F.transform("section_tokens", lambda n: n.cast("long")).alias("section_tokens"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_starts(table(spark, sf_dir, "conversations"))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_tokens(table(spark, sf_dir, "documents"))[0]


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data; the counts and the digest are those of the base kinds."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), name="found")
    base = pii.of_kinds("found", pii.BASE_KINDS)
    return found.select(
        "doc_id",
        *[F.size(pii.of_kinds("found", (kind,))).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(pii.written(base).cast("binary"), 256).alias("base_sha256"),
        pii.written("found").alias("spans"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def prepared(run: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(apply_defaults(spark), sf_dir)

    return call


QUERIES = {
    run.__name__: prepared(run)
    for run in (
        op1_shards, op2_line_dedup, op3_url_filter, op4_chat_tree, op5_simhash, op6_lm_score, op7_quality,
        op8_decontaminate, op9_mix, op10_token_counts, op11_prefix_trie, op12_align, op13_pii,
        pipeline,
    )
}

# --- SQL twins ------------------------------------------------------------------------
WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WORDS = (
    f"CASE WHEN trim(coalesce(text, ''), {WHITE}) = '' THEN [] "
    f"ELSE string_split_regex(trim(coalesce(text, ''), {WHITE}), '[\\x20\\x09-\\x0D]+') END"
)

SQL = {
    "op2_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (SELECT *, translate(trim(line, {WHITE}), {UPPER_LOWER}) AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.largest AS dropped FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op4_chat_tree": """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(text) + length(text) - length(replace(text, '\\', ''))
    + 2 * len(regexp_extract_all(text,
      '<\\|im_start\\|>|<\\|im_end\\|>|<\\|endoftext\\|>|<\\|startoftext\\|>|</?s>|<unk>|<pad>|\\[/?INST\\]|<</?SYS>>'))
    ) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id""",
    "op7_quality": f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(8) r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_all, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_all, 0) AS BIGINT) AS n_text_lines, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
b AS (
  SELECT *, CAST(
    CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN word_chars < 3 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 10 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_text_lines THEN 32 ELSE 0 END AS BIGINT) AS failure_bits
  FROM m)
SELECT *, failure_bits & 3 <> 0 AS base_failed, failure_bits = 0 AS kept FROM b""",
    "op8_decontaminate": f"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {UPPER_LOWER}),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''), {UPPER_LOWER}),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, ws[i:i + 9] AS g FROM (
    SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM iw WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT len(g) AS n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, ws[i:i + n - 1] AS g FROM (
    SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM dw, sizes)),
found AS (SELECT doc_id, item, i, n FROM doc_windows JOIN item_windows USING (g)),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, range(10) r(k) WHERE k < n GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op9_mix": f"""
WITH d AS (SELECT doc_id, text, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
weighed AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
    CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight FROM per),
levels AS (
  SELECT *, row_number() OVER line AS place,
    (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed WINDOW line AS (ORDER BY cap / weight, source NULLS LAST)),
filled AS (
  SELECT *, cap <= weight * level AS is_full,
    (SELECT arg_min(level, place) FROM levels WHERE cap > weight * level) AS common FROM levels),
rates AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap ELSE weight * common END AS target FROM filled),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) - 1 AS again FROM d),
mixed AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    CAST(('0x' || substr(md5('0|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))
      || CASE WHEN again > 0 THEN '|' || again ELSE '' END), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS chance
  FROM numbered d JOIN rates ON d.source IS NOT DISTINCT FROM rates.source),
copied AS (
  SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM mixed)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies
FROM copied""",
    "op11_prefix_trie": """
WITH turns AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
    || length(coalesce(text, '')) AS key FROM conversations WHERE conv_id IS NOT NULL),
said AS (SELECT conv_id, list(key ORDER BY turn NULLS FIRST, key) AS ks FROM turns GROUP BY conv_id),
-- CRC-32 of the decimal id, bit by bit
marked AS (
  SELECT *, xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))
  ), 4294967295) % 6 AS h FROM said),
rebuilt AS (
  SELECT m.conv_id, list_concat(coalesce(d.ks[1:m.h], []), m.ks[m.h + 1:]) AS ks
  FROM marked m LEFT JOIN said d ON d.conv_id = m.conv_id - m.conv_id % 100),
steps AS (SELECT conv_id, ks, unnest(range(0, len(ks) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT ks[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(ks) = depth), '')) AS ends_sha256
  FROM steps GROUP BY 1, 2),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
own AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN depth > 0 THEN (n_convs - 1) * CAST(substr(path[depth], 33) AS BIGINT) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN kids k USING (path)),
under AS (
  SELECT path[1:up] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM own) GROUP BY 1)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, u.n_leaves,
  CAST(u.saved_tokens AS BIGINT) AS saved_tokens, o.ends_sha256
FROM own o JOIN under u USING (path) LEFT JOIN nodes p ON o.depth > 0 AND p.path = o.path[1:o.depth - 1]""",
}
