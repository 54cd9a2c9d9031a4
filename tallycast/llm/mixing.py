"""Mixing sources to target weights in packed blocks.

Each source's documents, in a fixed pseudorandom order, form one stream of words cut into
blocks of ``block_words``. The mixture is a sequence of slots, one block each, dealt to
output shards: every shard's source counts are a multinomial draw conditioned on the
sources' remaining slots, so the totals hit the targets to about one block while shards vary as a
multinomial does. Slot j of a source shows block perm(j mod n) of its n blocks, with a
seeded pseudorandom permutation per pass over the source; blocks and slots meet in a join
on (source, block index). No block is shown more than MAX_REPEATS times.

On the driver are only per-source totals and per-shard source counts; documents, blocks and
slots stay distributed, and a source that holds most rows is spread over chunks and blocks.

Null text has size 0, such documents are taken 0 times. Null source is a source of its own,
ordered last. Repeated rows are separate documents. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.llm.common import WORD, lean, let, materialise, text_of

WEIGHTS = (5.0, 2.0, 1.0)   # by rank of the source, repeating
MAX_REPEATS = 3
BLOCK_WORDS = 32
SHARD_SLOTS = 1 << 16       # slots of an output shard
DRAWN_SHARDS = 4096         # shards, or groups of shards, that the driver draws counts for
CHUNK_ROWS = 4096           # documents per chunk of the packing order, about
SEED = 20240117


def water_fill(sizes: list[int], weights: list[float], cap: float = MAX_REPEATS) -> list[float]:
    """Targets that share ``sum(sizes)`` by weight, none above ``cap`` times its size."""
    targets = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = float(cap * sizes[i])
        left -= sum(targets[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return targets


def source_plan(sized: DataFrame, weights=WEIGHTS, block_words: int = BLOCK_WORDS) -> pd.DataFrame:
    """One row per source: rank, size, target, number of blocks and of slots."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"]) for r in rows]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(rows))])
    blocks = [-(-s // block_words) for s in sizes]
    # a source's last block may be short, so slots are passes over its blocks, not words
    slots = [min(MAX_REPEATS * b, round(b * t / s)) if s else 0 for t, b, s in zip(targets, blocks, sizes, strict=True)]
    return pd.DataFrame(
        {
            "rank": range(len(rows)), "source": [r["source"] for r in rows], "source_size": sizes,
            "target": targets, "n_blocks": blocks, "n_slots": slots,
        }
    )


def draw_shards(slots: list[int], shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> list[tuple[int, int, int, int]]:
    """(shard, source rank, first slot, count): multinomial counts per shard given what is left of each source."""
    rng = np.random.default_rng(seed)
    rem = np.array(slots, dtype=np.int64)
    first, out, shard = np.zeros_like(rem), [], 0
    while rem.sum() > 0:
        want = int(min(shard_slots, rem.sum()))
        got = np.zeros_like(rem)
        while want:  # redraw what a source could not give
            free = rem - got
            draw = np.minimum(rng.multinomial(want, free / free.sum()), free)
            got += draw
            want -= int(draw.sum())
        out += [(shard, int(s), int(first[s]), int(got[s])) for s in np.flatnonzero(got)]
        first, rem, shard = first + got, rem - got, shard + 1
    return out


def permute(j: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of [0, n) per key: four Feistel rounds, walked until below n."""
    n, key = n.astype(np.uint64), key.astype(np.uint64)
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(float) + 1)) / 2).astype(np.int64) + 1)
    half, mask = bits.astype(np.uint64), (np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1)
    out, todo = j.astype(np.uint64), np.ones(len(j), dtype=bool)
    while todo.any():
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            x = right * np.uint64(0x9E3779B97F4A7C15) + k + np.uint64(r * 0x632BE59BD9B4E019 & (2**64 - 1))
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((x ^ (x >> np.uint64(32))) & m)
        out[todo] = (left << h) | right
        todo[todo] = out[todo] >= n[todo]
    return out.astype(np.int64)


def sized_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, tie): one row per document, stored."""
    text = text_of("text")
    return materialise(
        docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("tie")),
        "mix-sized",
    )


def pack(sized: DataFrame, plan: DataFrame, n_rows: int) -> DataFrame:
    """``sized`` plus its source's plan and ``start``, its place in the source's stream.

    The order is by chunk, hashed from id and text, then id: prefix sums need one row per chunk and, within a
    chunk, about CHUNK_ROWS rows, however large the source.
    """
    chunks = max(1, n_rows // CHUNK_ROWS)
    d = sized.join(plan, sized["source"].eqNullSafe(plan["source"])).drop(plan["source"]).withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "tie", F.lit(SEED)), F.lit(chunks))
    )
    before = W.partitionBy("rank").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    bases = (
        d.groupBy("rank", "chunk").agg(F.sum("size").alias("s"))
        .select("rank", "chunk", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))
    )
    within = W.partitionBy("rank", "chunk").orderBy("doc_id", "size", "tie").rowsBetween(W.unboundedPreceding, -1)
    return (
        d.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(bases, ["rank", "chunk"])
        .withColumn("start", F.col("base") + F.col("inner"))
        .drop("chunk", "base", "inner")
    )


def shown_blocks(spark, plan: pd.DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(rank, block, times): how often the mixture shows each block that it shows."""
    # the driver draws groups of shards, at most DRAWN_SHARDS of them; tasks draw the shards of a group
    group = shard_slots * max(1, -(-int(sum(plan["n_slots"])) // (shard_slots * DRAWN_SHARDS)))
    draws = draw_shards(list(plan["n_slots"]), group, seed)
    by_rank = {int(r): (int(n)) for r, n in zip(plan["rank"], plan["n_blocks"], strict=True)}
    groups: dict[int, list[tuple[int, int, int, int]]] = {}
    for g, r, f, c in draws:
        groups.setdefault(g, []).append((r, f, c, by_rank[r]))
    parts = max(1, min(len(groups), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    fields = ["rank", "first", "count", "n_blocks"]
    held = [[dict(zip(fields, p, strict=True)) for p in ps] for ps in groups.values()]
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in fields]))
    drawn = spark.createDataFrame(
        pa.table({"shard": pa.array(list(groups), pa.int64()), "parts": pa.array(held, kind)}),
        "shard long, parts array<struct<rank:long,first:long,count:long,n_blocks:long>>",
    ).repartition(parts)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for g, held in zip(pdf["shard"], pdf["parts"], strict=True):
                rank, first, count, n = (np.array([x[k] for x in held], np.int64) for k in ("rank", "first", "count", "n_blocks"))
                rows = [
                    (s, rank[i], first[i] + f, c, n[i])
                    for s, i, f, c in (draw_shards(count.tolist(), shard_slots, seed + 1 + int(g)) if count.sum() > shard_slots else
                                       [(0, i, 0, c) for i, c in enumerate(count.tolist())])
                ]
                yield pd.DataFrame(rows, columns=["shard", "rank", "first", "count", "n_blocks"])

    schema = "shard long, rank long, first long, count long, n_blocks long"
    # dealt out again between the two steps: in one stage every task would hold two Python workers
    slots = drawn.mapInPandas(lean(split), schema).repartition(parts).select(
        "shard", "rank", "n_blocks", F.explode(F.sequence("first", F.col("first") + F.col("count") - 1)).alias("slot")
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, slot = pdf["n_blocks"].to_numpy(), pdf["slot"].to_numpy()
            key = (pdf["rank"].to_numpy() * 1_000_003 + slot // n) * 2_654_435_761 + seed
            yield pd.DataFrame({"rank": pdf["rank"], "block": permute(slot % n, n, key)})

    return slots.mapInPandas(lean(place), "rank long, block long").groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))


def _overlaps(packed: DataFrame, block_words: int) -> DataFrame:
    """One row per document with words and block it lies in, with the words of the overlap."""
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    b = packed.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words), last)))
    lo = F.greatest(F.col("start"), F.col("block") * block_words)
    hi = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return b.withColumn("from", lo - F.col("start")).withColumn("words", hi - lo)


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, tie, source_size, target, taken, and ``shown``:
    the ranges of its words that the mixture shows, as (from, words, times)."""
    spark = docs.sparkSession
    sized = sized_documents(docs)
    n_rows = sized.count()
    plan = source_plan(sized, block_words=block_words)
    plan_schema = "rank long, source string, source_size long, target double, n_blocks long, n_slots long"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    columns = {c: pa.array(plan[c].astype(object), t, from_pandas=True) for c, t in zip(plan.columns, kinds, strict=True)}
    plan_df = spark.createDataFrame(pa.table(columns), plan_schema)
    packed = pack(sized, plan_df, n_rows)
    shown = shown_blocks(spark, plan, shard_slots, seed)
    key = ["rank", "start", "doc_id", "source", "size", "tie", "source_size", "target"]
    taken = (
        _overlaps(packed, block_words)
        .join(shown.hint("merge"), ["rank", "block"])
        .groupBy(*key)
        .agg(
            F.sum(F.col("words") * F.col("times")).alias("taken"),
            F.sort_array(F.collect_list(F.struct("from", "words", "times"))).alias("shown"),
        )
    )
    out = packed.select(*key).join(
        taken.select("rank", "start", "taken", "shown", F.lit(True).alias("has")),
        ["rank", "start"],
        "left",
    )
    seen = F.col("has") & (F.col("size") > 0)
    return out.select(
        "doc_id", "source", "size", "tie", "source_size", "target",
        F.when(seen, F.col("taken")).otherwise(F.lit(0)).cast("long").alias("taken"),
        F.when(seen, F.col("shown")).alias("shown"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture as documents: all columns, one row per document and pass over it.

    Pass k holds the words of the document's blocks that the mixture shows k times or more,
    with the white space between them as it was; a document whose blocks are all shown keeps
    its text, one that is not shown is gone.
    """
    mixed = mix(docs, **options).filter("taken > 0").select(
        F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("tie").alias("t"), "shown",
        # rows repeated as a whole meet one plan each
        F.row_number().over(W.partitionBy("doc_id", "source", "tie").orderBy(F.col("taken").desc(), F.to_json("shown"))).alias("n"),
    )
    # the caller's row travels as one struct, so its column names may be any
    rows = docs.select(
        "doc_id", "source", "text", F.xxhash64(text_of("text")).alias("tie"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    )
    rows = rows.withColumn("nth", F.row_number().over(W.partitionBy("doc_id", "source", "tie").orderBy(F.monotonically_increasing_id())))
    joined = rows.join(
        mixed.hint("merge"),
        F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s"))
        & (F.col("tie") == F.col("t")) & (F.col("nth") == F.col("n")),
    )
    # words with the white space after them; the first one also keeps the text's leading space
    pieces = F.regexp_extract_all("text", F.lit(r"(^[\x20\x09-\x0D]*)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    passes = F.sequence(F.lit(1), F.array_max(F.transform("shown", lambda s: s["times"])).cast("int"))
    part = let(
        pieces,
        lambda p: F.array_join(
            F.flatten(
                F.transform(
                    F.filter("shown", lambda s: s["times"] >= F.col("pass")),
                    lambda s: F.slice(p, (s["from"] + 1).cast("int"), s["words"].cast("int")),
                )
            ),
            "",
        ),
    )
    out = joined.withColumn("pass", F.explode(passes)).select("row", part.alias("part"))
    made = {"text": F.col("part")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.length("part").cast(docs.schema["n_chars"].dataType)
    return out.select(*[made[c].alias(c) if c in made else F.col("row").getField(c).alias(c) for c in docs.columns])
