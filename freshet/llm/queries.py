"""The registered corpus queries and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.base import table, words
from freshet.llm.exact_dedup import exact_duplicates
from freshet.llm.html_text import extract
from freshet.llm.lm import score_documents
from freshet.llm.mixing import mix
from freshet.llm.periodic import longest_run, periodic_runs, runs_text
from freshet.llm.pieces import decode, encode, load_pieces
from freshet.llm.pii import personal_data, pii_digest
from freshet.llm.prefix_trie import prefix_trie, turn_sequences, with_shared_heads
from freshet.llm.quality import BASE, quality
from freshet.llm.reply_trees import format_conversations, read_back
from freshet.llm.secret_scan import secret_digest, secrets
from freshet.llm.simhash import near_duplicates
from freshet.llm.toxicity import toxicity

#: The model that the registered queries encode with.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, ids, n_ids, and whether decoding gives the text again (blanks stand for the mark U+2581)."""
    pieces = load_pieces(PIECES)
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = decode(encode(docs, pieces), pieces)
    same = F.col("decoded") == F.replace(F.col("text"), F.lit("\u2581"), F.lit(" "))
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), same.alias("exact"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", *BASE, "base_failed", "kept", "rule")


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_digest(secrets(table(spark, folder, "documents")))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii_digest(personal_data(table(spark, folder, "documents")))


def op8_html(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


def op9_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, and one made of control strings, formatted and read back."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema)
    found = read_back(format_conversations(rows.unionByName(extra)))
    return found.drop("rank").withColumnRenamed("tree", "conv_id")


OP11_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
    SELECT *, regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') AS body,
           regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'),
                          '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') AS line
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length(line) + 1 + length(body) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one of ten documents, by its id, the words from some place on repeat."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, g = F.size("__words"), F.floor(h / 10)
    start = (g % n).cast("int")
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
    planted = docs.select("doc_id", "text", F.when(h % 10 == 0, words(F.col("text"))).alias("__words"))
    a, p = F.col("__start"), F.col("__period")
    many = F.size("__words") > 0
    planted = planted.withColumns({"__start": F.when(many, start), "__period": F.when(many, period)})
    moved = F.transform("__words", lambda w, i: F.when(i < a, w).otherwise(F.element_at("__words", a + (i - a) % p + 1)))
    return planted.select("doc_id", F.when(many, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The runs of every document, the longest of them, and the text without their repeats."""
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    found = periodic_runs(with_planted_runs(docs)).withColumn("best", longest_run())
    length, period = F.col("best.length"), F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(runs_text(), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations, each with the head of its hundred's first conversation."""
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    return prefix_trie(with_shared_heads(turn_sequences(table(spark, folder, "conversations")), heads))


OP13_SQL = """
WITH turns AS (
    SELECT conv_id AS c, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
           length(coalesce(text, '')) AS chars, turn FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS i FROM turns),
ids AS (
    SELECT c, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), list_transform(range(8), lambda j: CAST(j AS BIGINT))),
            lambda x, j: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END))) % 6 AS h
    FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
    SELECT ids.c, 0 AS own, i, k, chars FROM ids JOIN placed ON placed.c = ids.c - ids.c % 100 AND i <= h
    UNION ALL SELECT ids.c, 1, i, k, chars FROM ids JOIN placed USING (c) WHERE i > h),
paths AS (
    SELECT c, row_number() OVER w AS d, string_agg(k, '') OVER w AS path, chars FROM rebuilt
    WINDOW w AS (PARTITION BY c ORDER BY own, i ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT c, 0, '', 0 FROM ids),
lengths AS (SELECT c, max(d) AS deepest FROM paths GROUP BY c),
nodes AS (
    SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
           sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = deepest), '')) AS ends_sha256
    FROM paths JOIN lengths USING (c) GROUP BY d, path),
families AS (
    SELECT n.d, n.path, n.conv_id, n.n_convs, n.ends_sha256, p.conv_id AS parent_conv_id,
           (SELECT count(*) FROM nodes m WHERE m.d = n.d + 1 AND left(m.path, 64 * n.d) = n.path) AS n_children, n.chars
    FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND left(n.path, 64 * (n.d - 1)) = p.path)
SELECT n.conv_id, n.d AS depth, n.parent_conv_id, n.n_convs, n.n_children,
       count(*) FILTER (m.n_children = 0) AS n_leaves,
       CAST(sum((m.n_convs - 1) * m.chars) AS BIGINT) AS saved_tokens, n.ends_sha256
FROM families n JOIN families m ON m.d >= n.d AND left(m.path, 64 * n.d) = n.path
GROUP BY ALL
"""


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_rules": op2_quality_rules,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_secrets": op6_secrets,
    "op7_pii": op7_pii,
    "op8_html": op8_html,
    "op9_lm_scores": op9_lm_scores,
    "op10_simhash": op10_simhash,
    "op11_chat_format": op11_chat_format,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_prefix_trie": op13_prefix_trie,
}
SQL = {"op3_exact_dedup": OP3_SQL, "op11_chat_format": OP11_SQL, "op13_prefix_trie": OP13_SQL}
