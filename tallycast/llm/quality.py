"""Quality rules as a bitmask ledger (DataFrame functions only).

``measure`` computes every measurement of a document once; ``ledger`` evaluates every rule
on them once and stores the failures as bits of one long beside the measurements. A policy
is a versioned set of rules, i.e. a mask: applying one, or asking what each rule costs
(``ablations``), is integer work on the ledger and never touches a text again.

Null and empty texts have zero words and measurements 0. Repeated rows are judged row by
row. Only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import SPACE, WORD, let, text_of, words_of

WINDOW = 5  # words in a repeated window


@dataclass(frozen=True)
class Rule:
    """A named rule on a fixed bit; ``fails`` is a SQL predicate over the measurements."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words)"),
    Rule(5, "capitals", "2 * n_upper > word_chars"),
)
# Policies by version: the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": tuple(r.name for r in RULES),
}


def mask_of(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[n] for n in set(names))


def _repeated_words(words: Column) -> Column:
    """Words inside WINDOW-word windows whose 64-bit hash occurs twice or more in the text."""

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def from_sorted(s: Column) -> Column:
            starts = F.transform(
                s,
                lambda p, j: F.when(
                    (F.get(s, j - 1)["h"].eqNullSafe(p["h"])) | (F.get(s, j + 1)["h"].eqNullSafe(p["h"])), p["i"]
                ),
            )
            return let(
                F.sort_array(F.filter(starts, lambda i: i.isNotNull())),
                lambda d: F.aggregate(
                    F.transform(d, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(d, j + 1) - i, F.lit(WINDOW)))),
                    F.lit(0).cast("long"),
                    lambda a, x: a + x,
                ),
            )

        repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeats, let(pairs, from_sorted)).otherwise(F.lit(0).cast("long"))

    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))
    )
    return F.when(F.size(words) > WINDOW, let(hashes, covered)).otherwise(F.lit(0).cast("long"))


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and the measurements (longs)."""
    text = text_of(text_col)

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            _repeated_words(words).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    measured = df.select(
        F.col(id_col).alias("doc_id"),
        let(words_of(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
    )
    return measured.select(
        "doc_id", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines", "n_upper"
    )


def ledger(measurements: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measurements plus ``failed_bits``: bit ``r.bit`` is set where rule ``r`` fails."""
    bits = sum((F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in rules), F.lit(0))
    return measurements.withColumn("failed_bits", bits.cast("long"))


def verdict(mask: int, bits: str = "failed_bits") -> Column:
    """True where no rule of the policy fails."""
    return F.col(bits).bitwiseAND(F.lit(mask).cast("long")) == 0


def ablations(
    ledger_df: DataFrame,
    policies: dict[str, tuple[str, ...]] = POLICIES,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Per policy and rule: documents the rule fails, those only it fails (kept without it), and kept documents.

    The ledger is first counted per bit pattern (at most 2**rules rows), so the rest of the
    work does not depend on the number of documents.
    """
    patterns = ledger_df.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    cells = [
        F.struct(
            F.lit(version).alias("policy"),
            F.lit(mask_of(names, rules)).cast("long").alias("mask"),
            F.lit(r.name).alias("rule"),
            F.lit(1 << r.bit).cast("long").alias("bit"),
        )
        for version, names in sorted(policies.items())
        for r in rules
        if r.name in names
    ]
    hit = F.col("failed_bits").bitwiseAND(F.col("c.mask"))
    zero = F.lit(0).cast("long")
    return (
        patterns.withColumn("c", F.explode(F.array(*cells)))
        .groupBy(F.col("c.policy").alias("policy"), F.col("c.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit.bitwiseAND(F.col("c.bit")) != 0, F.col("n")).otherwise(zero)).alias("n_failed"),
            F.sum(F.when(hit == F.col("c.bit"), F.col("n")).otherwise(zero)).alias("n_failed_only_here"),
            F.sum(F.when(hit == 0, F.col("n")).otherwise(zero)).alias("n_kept"),
        )
    )
