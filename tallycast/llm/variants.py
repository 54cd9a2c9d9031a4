"""Spelling variant grouping: generated edits probed against length-sharded blocked Bloom filters.

The vocabulary is counted over all texts. Its words are hashed into blocked Bloom filters, one
shard per word length (lengths from LONG on share one); their total size has a fixed limit, so
they are broadcast. Every word then generates its edits as hashes, without building strings: all
its single deletions, probed against the shard one shorter, and all its single replacements by
a greater code point, probed against the shard of its own length. Insertions and replacements
by smaller code points are the same pairs seen from the other word. Only positives are shuffled,
to a join with the vocabulary on (length, hash), and the two words of every met pair are compared,
which removes what the filter or a hash let through. A filter at its size limit lets more
through; the result stays exact.

Null and empty texts have no words. Null ids count as the empty string in the deletion rule.
Repeated rows count again; two rows with one id delete alike. An empty table, or one without a
word that is long and frequent enough, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import Scratch, text_of
from tallycast.llm.hashing import mix

RUN = re.compile("[a-zÀ-ÿ]+")
DELETE_EVERY = 31
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_TIMES = 10
ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], dtype=np.uint32)  # all code points of a word
LONG = 64                     # word lengths from here on share a filter shard
BLOCK_BITS = 256              # eight lanes of 32 bits, one bit of each per word
BITS_PER_WORD = 16
MAX_FILTER_BYTES = 64 << 20   # of all shards together
FLUSH_WORDS = 300_000         # distinct words a task counts before it hands them on
BATCH_CELLS = 200_000         # words times length that are edited at once
_BASE = 0x9E3779B97F4A7C15 | 1
_SALTS = np.array(
    [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], dtype=np.uint64
)  # fixed values of a split-block filter


def runs(doc_id: str, text: str) -> Counter[str]:
    """Lower-cased letter runs of a text after the deletion rule, with their counts."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    out: Counter[str] = Counter()
    for run, n in Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))).items():
        h = zlib.crc32(run.encode(), seed)
        if h % DELETE_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= MIN_LENGTH:
            out[run] += n
    return out


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) for the words of MIN_LENGTH code points and MIN_COUNT occurrences."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                for w, n in runs(doc_id, text).items():
                    seen[w] += n
                if len(seen) > FLUSH_WORDS:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    texts = docs.select(text_of(F.col("doc_id").cast("string")).alias("doc_id"), text_of("text").alias("text"))
    return (
        texts.mapInPandas(count, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)
    )


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n + 1, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def matrix(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a word per row."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1)


def _sums(codes: np.ndarray) -> np.ndarray:
    """Prefix sums of code point times power, from 0 to the whole word."""
    power, _ = _powers(codes.shape[1])
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
    np.cumsum(codes.astype(np.uint64) * power[:-1], axis=1, out=out[:, 1:])
    return out


def word_keys(words: list[str]) -> np.ndarray:
    """A 64-bit key per word; all words have one length. A polynomial, so that edits are reckoned from it."""
    codes = matrix(words)
    return mix(_sums(codes)[:, -1] + np.uint64(codes.shape[1]))


def deletions(codes: np.ndarray) -> np.ndarray:
    """Keys of the words without their i-th code point, a column per i."""
    length = codes.shape[1]
    sums, (_, inverse) = _sums(codes), _powers(1)
    after = (sums[:, -1:] - sums[:, 1:]) * inverse[1]
    return mix(sums[:, :-1] + after + np.uint64(length - 1))


def replacements(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each letter (row, key) of every place of a smaller code point, replaced by the letter."""
    length = codes.shape[1]
    power, _ = _powers(length)
    whole = _sums(codes)[:, -1] + np.uint64(length)
    for letter in ALPHABET:
        row, at = np.nonzero(codes < letter)
        yield row, mix(whole[row] + (np.uint64(letter) - codes[row, at].astype(np.uint64)) * power[at])


class Filters:
    """Blocked Bloom filters in one array; a shard is a range of blocks."""

    def __init__(self, first: np.ndarray, lanes: np.ndarray | None = None):
        self.first, self.lanes = first, lanes  # first block of each shard, and the end

    @classmethod
    def sized(cls, counts: dict[int, int], bits_per_word: int = BITS_PER_WORD, limit: int = MAX_FILTER_BYTES) -> Filters:
        want = np.array([counts.get(s, 0) for s in range(LONG + 1)], dtype=np.float64) * bits_per_word / BLOCK_BITS
        scale = min(1.0, (limit * 8 / BLOCK_BITS - LONG - 1) / max(want.sum(), 1.0))
        blocks = np.where(want > 0, np.maximum(1, np.floor(want * scale)), 0).astype(np.int64)
        return cls(np.concatenate([[0], np.cumsum(blocks)]))

    def block_of(self, shard: int, keys: np.ndarray) -> np.ndarray:
        n = np.uint64(self.first[shard + 1] - self.first[shard])
        return (((keys >> np.uint64(32)) * n) >> np.uint64(32)).astype(np.int64) + self.first[shard]

    @staticmethod
    def bit(keys: np.ndarray, lane: int) -> np.ndarray:
        low = keys & np.uint64(0xFFFFFFFF)
        return ((low * _SALTS[lane]) & np.uint64(0xFFFFFFFF)) >> np.uint64(27)

    def maybe(self, shard: int, keys: np.ndarray) -> np.ndarray:
        """Places in ``keys`` that the shard may hold; each lane is asked only of those that passed the one before."""
        if self.first[shard + 1] == self.first[shard]:
            return np.zeros(0, np.int64)
        left = np.arange(len(keys))
        for lane in range(len(_SALTS)):
            k = keys[left]
            words = self.lanes[self.block_of(shard, k), lane]
            left = left[(words >> self.bit(k, lane).astype(np.uint32)) & np.uint32(1) == 1]
        return left


def keyed(words: DataFrame) -> DataFrame:
    """(word, n, length, key) of (word, n)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, length = np.zeros(len(pdf), np.uint64), pdf["word"].str.len().to_numpy()
            for size in np.unique(length):
                mine = np.flatnonzero(length == size)
                for at in _parts(mine, int(size)):
                    keys[at] = word_keys(pdf["word"].iloc[at].tolist())
            yield pdf.assign(length=length, key=keys.view(np.int64))

    return words.mapInPandas(run, "word string, n long, length long, key long")


def _parts(mine: np.ndarray, length: int) -> list[np.ndarray]:
    return np.array_split(mine, max(1, -(-len(mine) * length // BATCH_CELLS)))


def build_filters(spark: SparkSession, words: DataFrame, limit: int = MAX_FILTER_BYTES) -> Filters:
    """Filters of the keyed vocabulary: bits are joined by block in Spark; a row per block comes back."""
    shard = F.least(F.col("length"), F.lit(LONG))
    filters = Filters.sized({r[0]: r[1] for r in words.groupBy(shard).count().collect()}, limit=limit)  # LONG rows
    first = filters.first

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = Filters(first)
        for pdf in batches:
            for s, part in pdf.groupby("shard"):
                keys = part["key"].to_numpy(np.int64).view(np.uint64)
                out = {"block": f.block_of(int(s), keys)}
                for lane in range(len(_SALTS)):
                    out[f"l{lane}"] = (np.uint64(1) << f.bit(keys, lane)).astype(np.int64)
                yield pd.DataFrame(out)

    names = [f"l{i}" for i in range(len(_SALTS))]
    rows = (
        words.select(shard.alias("shard"), "key")
        .mapInPandas(bits, "block long, " + ", ".join(f"{n} long" for n in names))
        .groupBy("block").agg(*[F.bit_or(n).alias(n) for n in names])
        .toPandas()  # at most limit / 32 bytes rows
    )
    filters.lanes = np.zeros((int(first[-1]), len(_SALTS)), dtype=np.uint32)
    filters.lanes[rows["block"].to_numpy(np.int64)] = rows[names].to_numpy(np.int64).astype(np.uint32)
    return filters


def positives(words: DataFrame, filters: Filters) -> DataFrame:
    """(word, n, length, key): edits of each word that the filters may hold, with the edited word's length and key."""
    shared = words.sparkSession.sparkContext.broadcast((filters.first, filters.lanes))  # at most MAX_FILTER_BYTES

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = Filters(*shared.value)
        for pdf in batches:
            length = pdf["length"].to_numpy(np.int64)
            for size in np.unique(length).tolist():
                for at in _parts(np.flatnonzero(length == size), size):
                    codes = matrix(pdf["word"].iloc[at].tolist())
                    shorter = deletions(codes)
                    hit = f.maybe(min(size - 1, LONG), shorter.ravel())
                    rows, keys, sizes = [hit // size], [shorter.ravel()[hit]], [np.full(len(hit), size - 1)]
                    for row, key in replacements(codes):
                        hit = f.maybe(min(size, LONG), key)
                        rows.append(row[hit])
                        keys.append(key[hit])
                        sizes.append(np.full(len(hit), size))
                    found = pdf.iloc[at[np.concatenate(rows)]]
                    yield pd.DataFrame(
                        {"word": found["word"], "n": found["n"], "length": np.concatenate(sizes), "key": np.concatenate(keys).view(np.int64)}
                    )

    return words.mapInPandas(run, "word string, n long, length long, key long")


def near_pairs(words: DataFrame, filters: Filters) -> DataFrame:
    """(word, n, near, near_n) in both directions for words at one insertion, deletion or replacement."""
    probes = positives(words, filters).withColumnsRenamed({"length": "l", "key": "k"})
    held = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "length", "key")
    met = probes.join(held, (F.col("l") == F.col("length")) & (F.col("k") == F.col("key")))
    pairs = met.filter(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n").distinct()
    return pairs.union(pairs.select("near", "near_n", "word", "n"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last. Each has ten times its word's count, so chains are short."""
    at = scratch.store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("of"), F.col("root").alias("then"))
        step = at.join(onward, F.col("root") == F.col("of"), "left")
        step = scratch.replace(step.select("word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")), "step")
        if step.filter("moved").limit(1).count() == 0:
            return step.select("word", "root")
        at = scratch.replace(step.select("word", "root"), "roots")


def group_variants(docs: DataFrame, limit: int = MAX_FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    words = scratch.store(keyed(vocabulary(docs)), "vocabulary")
    pairs = near_pairs(words, build_filters(spark, words, limit))
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("best"), F.first("n").alias("own")
    )
    best = best.select(
        F.col("word").alias("of"), "n_near",
        F.when(-F.col("best.least") >= FORM_TIMES * F.col("own"), F.struct(F.col("best.near").alias("form"), (-F.col("best.least")).alias("form_n"))).alias("f"),
    )
    best = scratch.store(best, "near")
    last = roots(best.filter("f IS NOT NULL").select(F.col("of").alias("word"), "f.form"), scratch)
    last = last.select(F.col("word").alias("from"), "root")
    return (
        words.join(best, F.col("word") == F.col("of"), "left")
        .join(last, F.col("word") == F.col("from"), "left")
        .select(
            "word", F.col("f.form").alias("form"), F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("f.form_n").alias("form_n"),
        )
    )
