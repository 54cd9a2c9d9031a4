"""The registered queries of this package, and the SQL that DuckDB checks them with.

Each query applies its operator with production parameters to its whole table and derives
the digest columns from the operator's own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm import (
    alignment, chat, decontaminate, jaccard, language, mixing, passages, quality, rans, substrings, toxicity, urls, variants,
)
from tallycast.llm.common import materialise, read_table

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
HELD_OUT = "pmod(crc32(cast(doc_id as string)), 4) = 2"
HELD_OUT_LANG = "pmod(crc32(cast(doc_id as string)), 5) = 0"
URL_RULES = (
    # fixed values: host, path, verdict
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.encode_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger, stored: policies and ablations read its bits, not the texts."""
    return materialise(quality.ledger(quality.measure(read_table(spark, sf_dir, "documents"))), "ledger")


def op3_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger(spark, sf_dir).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.verdict(quality.mask_of(quality.POLICIES["base"]))).alias("base_failed"),
        quality.verdict(quality.mask_of(quality.POLICIES["v2"])).alias("kept"),
        "failed_bits",
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ablations(_ledger(spark, sf_dir))


def op4_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(read_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    return chat.read_back(chat.format_conversations(turns.unionByName(extra)))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = urls.with_parts(read_table(spark, sf_dir, "pages"))
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    judged = urls.rule_verdicts(parts.withColumn("tokens", urls.tokens(parts)), rules)
    mined = urls.mine(
        judged.filter(F.col("rule").isNotNull()).select("tokens", F.col("rule_verdict").alias("label"))
    )
    return urls.match(judged, mined).select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", "mined_verdict").alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("mined_rule")).alias("mined_rule"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.select("doc_id", "toxic").filter(f"NOT ({HELD_OUT})"))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score", "predicted"
    )


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(read_table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path(PIECES))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(read_table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.expr(HELD_OUT_LANG), F.lit(False))
    model = language.train(docs.filter(~held_out).select("lang", "text"))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {
    "op1_benchmark_leaks": op1_benchmark_leaks,
    "op2_rans_tokens": op2_rans_tokens,
    "op3_quality_ledger": op3_quality_ledger,
    "quality_ablations": quality_ablations,
    "op4_jaccard_components": op4_jaccard_components,
    "op5_repeated_passages": op5_repeated_passages,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_chat_format": op7_chat_format,
    "op8_mix_sources": op8_mix_sources,
    "op9_url_rules": op9_url_rules,
    "op10_toxicity": op10_toxicity,
    "op11_align_tokens": op11_align_tokens,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_language_id": op13_language_id,
}

_WORD = "[^\\x20\\x09-\\x0D]+"

_LEDGER = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM d),
g AS (SELECT doc_id, i, list_slice(w, i, i + 4) AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY 1),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(len(l) AS BIGINT) AS n_lines,
             CAST(length(regexp_replace(t, '\\P{{Lu}}', '', 'g')) AS BIGINT) AS n_upper,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
b AS (SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
             + (CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END)
             + (CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words) THEN 16 ELSE 0 END)
             + (CASE WHEN 2 * n_upper > word_chars THEN 32 ELSE 0 END) AS BIGINT) AS failed_bits FROM m)
"""

ORACLE_SQL = {
    "op3_quality_ledger": _LEDGER + """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM b""",
    "quality_ablations": _LEDGER + """, p AS (
  SELECT * FROM (VALUES ('base', 3), ('v1', 15), ('v2', 63)) AS v(policy, mask)),
rr AS (SELECT * FROM (VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('duplicate_lines', 8), ('word_length', 16), ('capitals', 32)) AS v(rule, bit))
SELECT policy, rule, count(*) FILTER (failed_bits & bit <> 0) AS n_failed,
       count(*) FILTER (failed_bits & mask = bit) AS n_failed_only_here, count(*) FILTER (failed_bits & mask = 0) AS n_kept
FROM b, p, rr WHERE bit & mask <> 0 GROUP BY 1, 2""",
    "op4_jaccard_components": f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b)
SELECT r.a AS doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM reach r LEFT JOIN n ON n.doc_id = r.a GROUP BY 1""",
    "op7_chat_format": r"""WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, regexp_replace(role, '([<\[])(\\*)(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g') AS er,
             regexp_replace(text, '([<\[])(\\*)(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g') AS et FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(length('<s>[INST][/INST]</s>') + 1 + length(er) + length(et)) AS BIGINT) AS formatted_chars
FROM f GROUP BY 1""",
}
