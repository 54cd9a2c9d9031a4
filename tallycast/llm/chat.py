"""Chat formatting from event logs.

``fold`` rebuilds the final messages of each conversation from its events: kind ``message``
opens a complete message, ``delta`` appends to the turn's newest message, ``edit`` and
``regenerate`` replace their turn's text and discard every later turn written before them.
``render`` writes one turn per row in a template with control strings, escaped inside the
texts so that ``parse`` gives them back; a conversation's formatted text is its rows in
order. ``read_back`` streams those rows per conversation and digests what it parses.

No conversation is ever held whole: whether an event survives is decided per chunk of
CHUNK sequence numbers plus one suffix minimum per chunk, messages are grouped per turn,
and the read-back hashes a sorted stream row by row (SHA-256 is sequential by definition).

Null role or text counts as empty; null kind as ``message``; rows repeated for one turn
are separate messages, ordered by sequence, role and text; an empty log gives no rows.
Rows with a null conversation id form a conversation of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.llm.common import materialise

CHUNK = 4096
ROLE_OPEN, ROLE_CLOSE, TURN_OPEN, TURN_CLOSE = "[INST]", "[/INST]", "<s>", "</s>"
# A control string is a first character and a tail; escaping puts a backslash between them.
TAILS = r"s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>"
ESCAPE = rf"([<\[])(\\*)({TAILS})"
UNESCAPE = rf"([<\[])\\(\\*)({TAILS})"
TRAINED_ROLE = "assistant"

_TURN = re.compile(
    rf"{re.escape(TURN_OPEN + ROLE_OPEN)}(.*?){re.escape(ROLE_CLOSE)}(.*){re.escape(TURN_CLOSE)}\n", re.DOTALL
)
_UNESCAPE = re.compile(UNESCAPE)


def events_from_turns(turns: DataFrame) -> DataFrame:
    """A table of finished turns as an event log: one ``message`` event each, sequenced by turn."""
    return turns.select(
        "conv_id", F.col("turn").alias("seq"), "turn", F.lit("message").alias("kind"), "role", "text"
    )


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turn, nth, role, text): the final messages; ``nth`` counts messages within a turn."""
    e = events.select(
        "conv_id",
        F.coalesce("seq", F.lit(0)).cast("long").alias("seq"),
        F.coalesce("turn", F.lit(0)).cast("long").alias("turn"),
        F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("chunk", F.floor(F.col("seq") / CHUNK))
    reset = F.when(F.col("kind").isin("edit", "regenerate"), F.col("turn"))
    later_chunks = W.partitionBy("conv_id").orderBy(F.col("chunk").desc()).rowsBetween(W.unboundedPreceding, -1)
    per_chunk = (
        e.filter(reset.isNotNull())
        .groupBy("conv_id", "chunk")
        .agg(F.min("turn").alias("lowest"))
    )
    # a chunk without resets still needs the minimum of the chunks after it
    chunks = (
        e.groupBy("conv_id", "chunk").agg(F.min(reset).alias("lowest"))
        .join(per_chunk.select("conv_id").distinct().withColumnRenamed("conv_id", "c2"),
              F.col("conv_id").eqNullSafe(F.col("c2")), "left_semi")
        .withColumn("after_chunk", F.min("lowest").over(later_chunks))
        .filter(F.col("after_chunk").isNotNull())
        .select(F.col("conv_id").alias("c3"), F.col("chunk").alias("chunk3"), "after_chunk")
    )
    in_chunk = (
        W.partitionBy("conv_id", "chunk")
        .orderBy(F.col("seq").desc(), F.col("turn").desc(), F.col("kind").desc(), F.col("text").desc())
        .rowsBetween(W.unboundedPreceding, -1)
    )
    whole_turn = W.partitionBy("conv_id", "turn").orderBy("seq", "role").rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing
    )
    e = e.withColumn("after", F.min(reset).over(in_chunk)).withColumn(
        "turn_role", F.first(F.when(F.col("role") != "", F.col("role")), ignorenulls=True).over(whole_turn)
    )
    alive = (
        e.join(chunks, F.col("conv_id").eqNullSafe(F.col("c3")) & (F.col("chunk") == F.col("chunk3")), "left")
        .filter(F.coalesce(F.least("after", "after_chunk"), F.col("turn") + 1) > F.col("turn"))
        .select("conv_id", "seq", "turn", "kind", "role", "text", "turn_role")
    )
    by_turn = W.partitionBy("conv_id", "turn").orderBy("seq", F.col("opens").desc(), "role", "text")
    opened = alive.withColumn("opens", (F.col("kind") != "delta").cast("int")).withColumn(
        "nth", F.sum("opens").over(by_turn.rowsBetween(W.unboundedPreceding, 0))
    )
    return (
        opened.groupBy("conv_id", "turn", "nth")
        .agg(
            F.sort_array(F.collect_list(F.struct("seq", (-F.col("opens")).alias("o"), "role", "text"))).alias("parts"),
            F.first("turn_role").alias("turn_role"),
        )
        .select(
            "conv_id", "turn", "nth",
            F.coalesce(F.get(F.filter("parts", lambda p: p["role"] != ""), F.lit(0))["role"], "turn_role", F.lit("")).alias("role"),
            F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
        )
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, nth, formatted, loss_start, loss_end): one formatted turn per row.

    The loss mask covers ``formatted[loss_start:loss_end]``, the text of assistant turns;
    elsewhere both are equal.
    """
    head = F.concat(F.lit(TURN_OPEN + ROLE_OPEN), escape(F.col("role")), F.lit(ROLE_CLOSE))
    body = escape(F.col("text"))
    trained = F.col("role") == TRAINED_ROLE
    return messages.select("conv_id", "turn", "nth", head.alias("head"), body.alias("body"), trained.alias("trained")).select(
        "conv_id", "turn", "nth",
        F.concat("head", "body", F.lit(TURN_CLOSE + "\n")).alias("formatted"),
        F.length("head").cast("long").alias("loss_start"),
        (F.length("head") + F.when(F.col("trained"), F.length("body")).otherwise(0)).cast("long").alias("loss_end"),
    )


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    m = _TURN.fullmatch(formatted)
    if m is None:
        raise ValueError(f"not a formatted turn: {formatted[:80]!r}")
    return unescape(m[1]), unescape(m[2])


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation, from the formatted rows alone: turns, digests and loss text."""
    spark = rendered.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def closed(c, s):
            return (c, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4])

        def frame(rows):
            out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            return out.astype({"conv_id": "Int64"})

        current, state = None, None
        for pdf in batches:
            rows = []
            for c, text, lo, hi in zip(pdf["conv_id"], pdf["formatted"], pdf["loss_start"], pdf["loss_end"], strict=True):
                c = None if pd.isna(c) else int(c)
                if state is None or c != current:
                    if state is not None:
                        rows.append(closed(current, state))
                    current, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = parse(text)
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
                loss = unescape(text[lo:hi])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(text)
            yield frame(rows)
        if state is not None:
            yield frame([closed(current, state)])

    return (
        rendered.repartition(n, "conv_id")
        .sortWithinPartitions("conv_id", "turn", "nth")
        .select("conv_id", "formatted", "loss_start", "loss_end")
        .mapInPandas(
            digest,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        )
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """Fold, render and store the formatted turns of a table of turns; returns the stored rows."""
    return materialise(render(fold(events_from_turns(turns))), "chat")
