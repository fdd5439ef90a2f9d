"""One registered query per operator, with production parameters over whole
tables, and SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import (exact_dedup, langid, lexical, lmscore, mixing, packing, prefix_trie, quality, secrets, simhash,
                          token_files, warc, word_merge)
from tidepool.session import read_table

#: Places of the public vocabularies; every executor has them under the same path.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

SPLIT = "coalesce(pmod(crc32(cast(doc_id as string)), 5), 0)"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(spark, docs, PIECES, training=F.expr(f"{SPLIT} <> 0"))
    scored = docs.select("doc_id", F.expr(f"{SPLIT} = 0").alias("held_out"),
                         langid.predict(spark, model, F.col("text")).alias("p"))
    return scored.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents"))


def packed_digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    pieces = packing.token_pieces(docs, TOKENIZER)
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(spark, digests)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(spark, read_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = token_files.write_token_files(spark, read_table(spark, sf_dir, "documents"), TOKENIZER)
    read = token_files.read_token_files(parts)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    # the table has no time of capture: one second per page id from a fixed day on
    captured = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod("page_id", F.lit(10**9)))
    runs, folder = warc.write_archives(spark, pages, captured)
    records = warc.read_archives(warc.merge_runs(spark, runs), folder)
    return records.select("page_id", "payload_bytes", warc.payload_digest().alias("payload_digest"),
                          "record_type", "refers_to", "range_no", "position")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = read_table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("target_id"))
    return lmscore.subword_difference(spark, read_table(spark, sf_dir, "documents"), good, TOKENIZER)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_counts(spark, read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 4).alias("target"),
                        (F.col("size") * F.col("copies")).alias("taken"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(secrets.spans_text("base").cast("binary"), 256).alias("base_sha256"),
                        secrets.spans_text("spans").alias("spans"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(spark, read_table(spark, sf_dir, "documents"), digest=True)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = word_merge.encode(read_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(word_merge.ids_text("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = prefix_trie.with_shared_heads(spark, read_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(spark, rebuilt)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_quality_rules, op3_packing, op4_token_files, op5_simhash, op6_warc, op7_lm_scoring,
    op8_mixing, op9_secret_scan, op10_exact_dedup, op11_lexical_search, op12_byte_bpe, op13_prefix_trie)}


def _stop_list() -> str:
    return ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))


ORACLES = {
    "op2_quality_rules": rf"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        s AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                     list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
              FROM t),
        w AS (SELECT doc_id, i, words[i:i + 2] AS win FROM s, unnest(range(1, greatest(len(words) - 1, 1))) AS r(i)),
        twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM w) WHERE c > 1),
        spread AS (SELECT DISTINCT doc_id, i + k AS at FROM twice, range(3) AS o(k)),
        rep AS (SELECT doc_id, count(*) AS n FROM spread GROUP BY doc_id),
        m AS (SELECT s.doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                     length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                     len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
                     len(lines) AS n_lines, len(list_filter(words, lambda x: lower(x) IN ({_stop_list()}))) AS n_stop_words,
                     length(regexp_replace(text, '[^!]', '', 'g')) AS n_shouts,
                     length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
                     len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis,
                     len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•][\x20\x09-\x0D]'))) AS n_bullets
              FROM s LEFT JOIN rep ON rep.doc_id = s.doc_id),
        f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
               n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, n_lines::BIGINT AS n_lines,
               n_stop_words::BIGINT AS n_stop_words, n_shouts::BIGINT AS n_shouts, n_upper::BIGINT AS n_upper,
               base_failed,
               NOT base_failed AND word_chars BETWEEN 2.0 * n_words AND 14.0 * n_words AND n_symbols <= 0.1 * n_words
                 AND n_shouts <= 0.5 * n_words AND n_upper <= 0.4 * word_chars AND n_stop_words >= 2
                 AND n_stop_words >= 0.02 * n_words AND n_dup_lines <= 0.4 * n_lines
                 AND n_ellipsis <= 0.3 * n_lines AND n_bullets <= 0.9 * n_lines AS kept
        FROM f""",
    "op8_mixing": r"""
        WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS digest, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
                   FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        r AS (SELECT *, ([5.0, 2.0, 1.0])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
        c AS (SELECT *, 3.0 * source_size / weight AS bound FROM r),
        -- sources in order of the level at which they reach their bound: the first whose bound the level of the rest does not pass
        o AS (SELECT *, coalesce(sum(3.0 * source_size) OVER before, 0) AS fixed, coalesce(sum(weight) OVER before, 0) AS used
              FROM c WINDOW before AS (ORDER BY bound, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        l AS (SELECT level FROM (
                SELECT ((SELECT sum(source_size) FROM s) - fixed) / ((SELECT sum(weight) FROM r) - used) AS level, bound, source
                FROM o) WHERE level <= bound ORDER BY bound, source LIMIT 1),
        g AS (SELECT source, source_size, least(3.0 * source_size, level * weight)::DOUBLE AS target FROM r, l),
        x AS (SELECT d.doc_id, d.size, g.source_size, g.target,
                     CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
                     ('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, '') || ':' || digest), 1, 13))::BIGINT / 4503599627370496.0 AS u
              FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
        SELECT doc_id, size::BIGINT AS size, source_size, round(target, 4) AS target,
               (size * least(3, floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM x""",
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW w AS (PARTITION BY t)""",
    "op11_lexical_search": r"""
        WITH cut AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms, row_number() OVER () AS no FROM documents),
        ask AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        size AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS length FROM cut WHERE len(terms) > 0),
        tf AS (SELECT no, doc_id, len(any_value(n)) AS n, term, count(*)::BIGINT AS tf
               FROM (SELECT no, doc_id, terms AS n, unnest(terms) AS term FROM cut) GROUP BY no, doc_id, term),
        df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
        gain AS (SELECT no, doc_id, term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
                        * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))) AS gain
                 FROM tf JOIN df USING (term), size WHERE term IN (SELECT term FROM ask)),
        total AS (SELECT item_id, doc_id, no, sum(gain)::BIGINT AS score FROM ask JOIN gain USING (term) GROUP BY ALL HAVING sum(gain) > 0)
        SELECT item_id, row_number() OVER w::INTEGER AS rank, doc_id, score FROM total
        WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)
        QUALIFY row_number() OVER w <= 10""",
    "op13_prefix_trie": r"""
        WITH turns AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own
                       FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        -- the CRC of a number's digits, bit by bit (fixed value: the polynomial of the standard, reversed)
        crc AS (SELECT conv_id, own, xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT],
                    list_transform(range(1, 1 + length(conv_id::VARCHAR)), lambda i: ascii(substr(conv_id::VARCHAR, i::BIGINT, 1))::BIGINT)),
                    lambda acc, byte: list_reduce(list_concat([xor(acc, byte)], range(8)),
                        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h FROM turns),
        path AS (SELECT c.conv_id, list_concat(coalesce(b.own, [])[:c.h], c.own[c.h + 1:]) AS path
                 FROM crc c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 100),
        member AS (SELECT conv_id, d AS depth, path[:d] AS node, d = len(path) AS ends FROM path, unnest(range(0, len(path) + 1)) AS r(d)),
        node AS (SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends,
                        CASE WHEN any_value(depth) = 0 THEN 0 ELSE (count(*) - 1) * length(any_value(node)[-1].text) END AS saved
                 FROM member GROUP BY node),
        kids AS (SELECT node[:depth - 1] AS node, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
        known AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (node)),
        below AS (SELECT node[:d] AS node, sum(saved) AS saved_tokens, count_if(n_children = 0) AS n_leaves
                  FROM known, unnest(range(0, depth + 1)) AS r(d) GROUP BY ALL)
        SELECT k.conv_id, k.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, k.n_convs::BIGINT AS n_convs,
               k.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens,
               sha256(k.ends) AS ends_sha256
        FROM known k JOIN below b ON b.node = k.node LEFT JOIN known p ON k.depth > 0 AND p.node = k.node[:k.depth - 1]""",
}
