"""URL filtering by association rules (DataFrame functions and pyspark.ml only).

``rule_verdicts`` applies a given list of (host, path, verdict) rules by an equality join on
host suffixes: every page lists its host and parent domains, the longest fitting rule wins.
``mine`` takes labelled URLs, turns each into a set of tokens plus its label, and lets
Spark's FP-growth mine the combinations; rules under the minimum support or confidence are
pruned. ``match`` finds each page's rules through an inverted index: a rule is posted under
its rarest token only, and a page joined to it there keeps it if it holds all its tokens.

A null URL, or one without ``://``, has empty host and path and no tokens, so it matches
nothing and gets the default verdict. Repeated rows are judged alike. Only the id and URL
columns are read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import let, text_of

MIN_SUPPORT = 0.005     # share of the labelled URLs that hold a combination
MIN_CONFIDENCE = 0.8    # share of those with the rule's label
LABEL = "label="


def split_url(url: Column) -> Column:
    """Struct (host, path, rest) of a URL; all empty without ``://``."""
    def parts(after: Column) -> Column:
        host = F.regexp_extract(after, r"^([^/?#]*)", 1)
        path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
        tail = F.regexp_extract(after, r"^[^/?#]*[^?#]*([\s\S]*)$", 1)
        lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        return F.struct(lower.alias("host"), path.alias("path"), tail.alias("tail"))

    after = F.regexp_extract(text_of(url), r"^[\s\S]*?://([\s\S]*)$", 1)
    return let(after, parts)


def with_parts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, tail)."""
    return pages.select(F.col(id_col).alias("page_id"), split_url(F.col(url_col)).alias("u")).select(
        "page_id", "u.host", "u.path", "u.tail"
    )


def suffixes(host: Column) -> Column:
    """The host and every parent domain; empty array for an empty host."""

    def of(labels: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        )

    return F.when(host == "", F.array().cast("array<string>")).otherwise(let(F.split(host, r"\."), of))


def rule_verdicts(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """``parts`` with ``rule`` and ``rule_verdict`` of the longest rule that fits, else nulls.

    ``rules``: (host, path, verdict). A rule fits its host and all subdomains if the page's
    path starts with the rule's. Among equally long rules the smallest text wins.
    The verdict is found per distinct (host, path), so repeated URLs are joined once.
    """
    r = rules.select(
        F.lower("host").alias("rhost"), F.col("path").alias("rpath"), F.col("verdict").alias("rverdict")
    ).distinct()
    places = parts.select("host", "path").distinct()
    fits = (
        places.withColumn("rhost", F.explode(suffixes(F.col("host"))))
        .join(r, "rhost")
        .filter(F.col("path").startswith(F.col("rpath")))
        .withColumn("rule", F.concat("rhost", "rpath"))
        .groupBy("host", "path")
        .agg(F.min(F.struct((-F.length("rule")).alias("l"), "rule", "rverdict")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.rverdict").alias("rule_verdict"))
    )
    return parts.join(fits, ["host", "path"], "left")


def tokens(parts: DataFrame) -> Column:
    """Distinct tokens of a URL: host labels, parent domains, path segments, query keys and fragment mark."""
    host_labels = F.transform(F.filter(F.split("host", r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    domains = F.transform(F.slice(F.reverse(suffixes(F.col("host"))), 1, 2), lambda x: F.concat(F.lit("d:"), x))
    segments = F.transform(F.filter(F.split("path", "/"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), x))
    query = F.regexp_extract("tail", r"^\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1))
    )
    return F.array_distinct(F.concat(host_labels, domains, segments, keys))


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """Rules (antecedent, label, confidence, support) from (tokens, label) rows.

    An empty table gives no rules. FP-growth keeps at most 1 / min_support frequent tokens
    per token place of a URL, which bounds the rules whatever the number of rows.
    """
    items = labelled.select(F.array_append("tokens", F.concat(F.lit(LABEL), "label")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    consequent = F.col("consequent")[0]
    return (
        model.associationRules.filter(consequent.startswith(LABEL))
        .select(
            F.array_sort("antecedent").alias("antecedent"),
            F.substring(consequent, len(LABEL) + 1, 1000).alias("label"),
            "confidence",
            "support",
        )
        .filter(~F.exists("antecedent", lambda t: t.startswith(LABEL)))
    )


def match(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(token_set, mined_verdict, mined_rule) per distinct token set of ``pages`` (tokens column).

    The rule with the highest confidence, then support, then longest antecedent, then
    smallest text decides; without any, ``default``.
    """
    counts = rules.select(F.explode("antecedent").alias("t"), "support").groupBy("t").agg(F.max("support").alias("s"))
    posted = (
        rules.withColumn("rule_id", F.array_join("antecedent", " ") )
        .withColumn("t", F.explode("antecedent"))
        .join(counts, "t")
        .groupBy("rule_id", "label", "confidence", "support", "antecedent")
        .agg(F.min(F.struct("s", "t")).alias("rarest"))
        .select("rule_id", "label", "confidence", "support", "antecedent", F.col("rarest.t").alias("token"))
    )
    sets = pages.select("tokens").distinct()
    hits = (
        sets.withColumn("token", F.explode("tokens"))
        .join(posted, "token")
        .filter(F.size(F.array_except("antecedent", "tokens")) == 0)
        .groupBy("tokens")
        .agg(
            F.min(
                F.struct(
                    (-F.col("confidence")).alias("c"),
                    (-F.col("support")).alias("s"),
                    (-F.size("antecedent")).alias("n"),
                    "rule_id",
                    "label",
                )
            ).alias("best")
        )
        .select("tokens", F.col("best.label").alias("label"), F.col("best.rule_id").alias("mined_rule"))
    )
    return pages.join(hits, "tokens", "left").select(
        *pages.columns, F.coalesce("label", F.lit(default)).alias("mined_verdict"), "mined_rule"
    )
