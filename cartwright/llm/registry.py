"""Queries over the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import (
    ann,
    byte_bpe,
    exact_dedup,
    line_dedup,
    main_text,
    minhash,
    mixing,
    spelling,
    token_files,
    toxicity,
    turn_trie,
    url_filters,
    word_bpe,
)
from cartwright.llm.common import store_for, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the bytes decoded from them, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = byte_bpe.encode(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), path, public_tokenizers.PATTERN, decoded=True)
    return rows.select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded_bytes", 256).alias("decoded_sha256")
    )


WORD_BPE, END_ID = "word_bpe_49k.json", 2


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as token files and read back from them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    root = store_for(docs).root
    token_files.write(docs, root, public_tokenizers.path(WORD_BPE), END_ID)
    return token_files.read(spark, root).select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents over shingles of two words."""
    return minhash.near_duplicates(table(spark, folder, "documents"), words=2)


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Copies of all documents so that no source is passed more than four times and none less than once."""
    return mixing.schedule(table(spark, folder, "documents"), mixing.Target(repetitions=4.0))


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts over all pages."""
    return url_filters.judge(table(spark, folder, "pages"), URL_RULES)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of all documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return word_bpe.count_tokens(docs, public_tokenizers.path(WORD_BPE)).drop("text")


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Copies among all documents."""
    return exact_dedup.decisions(table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fate of every line of all documents."""
    return line_dedup.judge_lines(table(spark, folder, "documents"))


TOXIC_FROM = toxicity.TOXIC_FROM


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents; lexicon and model know only rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels").select("doc_id", "toxic"))
    rows = toxicity.score(docs, model, output="score").drop("text")
    predicted = (F.col("score") >= TOXIC_FROM).cast("int")
    return rows.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty nearest rows of every twentieth vector."""
    return ann.search(table(spark, folder, "embeddings"))


SHORTEST_WORD, LEAST_COUNT, EVERY, TIMES = 7, 2, 31, 10


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    docs = table(spark, folder, "documents")
    words = store_for(docs).keep("words", spelling.count_words(docs, shortest=SHORTEST_WORD, least=LEAST_COUNT, every=EVERY))
    return spelling.group_variants(words, times=TIMES)


def op12_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return main_text.extract(table(spark, folder, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op13_turn_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Prefix nodes of all conversations after they were given common openings."""
    return turn_trie.conversation_nodes(table(spark, folder, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_token_files": op2_token_files,
    "op3_minhash": op3_minhash,
    "op4_mixing": op4_mixing,
    "op5_url_filters": op5_url_filters,
    "op6_token_counts": op6_token_counts,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_neighbours": op10_neighbours,
    "op11_spelling": op11_spelling,
    "op12_main_text": op12_main_text,
    "op13_turn_trie": op13_turn_trie,
}

OP7_SQL = """
WITH normal AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC) = 1 AS kept, text_sha256
FROM normal
WINDOW copies AS (PARTITION BY text_sha256)
"""

# The given pages hold no redirects and no canonical links, so rules alone decide.
OP5_SQL = """
WITH rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) = 1
"""

OP8_SQL = """
WITH cut AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no
    FROM documents
), lines AS (
    SELECT doc_id, line_no,
           trim(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
    FROM cut
), heads AS (
    SELECT line, min((doc_id, line_no)) AS head, list_distinct(regexp_split_to_array(line, '[ \t\r\x0B\f]+')) AS words
    FROM lines WHERE line <> '' GROUP BY line
), exploded AS (
    SELECT head, len(words) AS n, unnest(words) AS word FROM heads
), ranked AS (
    SELECT head, n, word,
           row_number() OVER (PARTITION BY head ORDER BY frequency, word) AS place
    FROM exploded JOIN (SELECT word, count(*) AS frequency FROM exploded GROUP BY word) USING (word)
), prefixes AS (
    SELECT head, n, word FROM ranked WHERE place <= n - ceil(n * 80 / 100.0 - 1e-9) + 1
), candidates AS (
    SELECT DISTINCT a.head AS earlier, b.head AS later
    FROM prefixes a JOIN prefixes b ON a.word = b.word AND a.head < b.head AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
), removed AS (
    SELECT DISTINCT later AS head
    FROM candidates JOIN heads a ON a.head = earlier JOIN heads b ON b.head = later
    WHERE len(list_intersect(a.words, b.words)) * 100 >= (len(a.words) + len(b.words) - len(list_intersect(a.words, b.words))) * 80
)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, coalesce(head[1], doc_id) AS class_doc_id, CAST(coalesce(head[2], line_no) AS INTEGER) AS class_line,
       head IS NULL OR (head = (doc_id, line_no) AND NOT EXISTS (SELECT 1 FROM removed r WHERE r.head = h.head)) AS kept
FROM lines LEFT JOIN heads h USING (line)
"""

# The given pages hold their article in one element of that name, with bold text and line breaks as its only inline tags.
OP12_SQL = r"""
WITH articles AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS inside FROM pages
), plain AS (
    SELECT page_id, url, regexp_replace(regexp_replace(inside, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS words FROM articles
), decoded AS (
    SELECT page_id, url, replace(replace(replace(replace(replace(words, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '&amp', '&') AS words FROM plain
), trimmed AS (
    SELECT page_id, url, trim(regexp_replace(words, '\s+', ' ', 'g')) AS text FROM decoded
)
SELECT page_id, url, text, length(text) AS n_chars FROM trimmed
"""

SQL: dict[str, str] = {
    "op12_main_text": OP12_SQL,
    "op8_line_dedup": OP8_SQL,
    "op5_url_filters": OP5_SQL,
    "op7_exact_dedup": OP7_SQL,
}
