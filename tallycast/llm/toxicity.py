"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with word ends) and itself, hashed into
BUCKETS embeddings; a window of WINDOW words is the average of its words' averages, which a
linear softmax maps to (clean, toxic). A document is toxic if any of its windows is:
p = 1 - prod(1 - p_window), and that likelihood trains embeddings and softmax together, so
one insult in a long text is not averaged away and an unseen misspelling scores by the
n-grams it shares.

Training reads a bounded sample of the labelled rows: per class at most SAMPLE_ROWS, in
order of a hash of the id, texts whole, each row weighted by its class's share so
that scores keep the corpus's rate. Scoring reads every whole text in Arrow batches; long texts are walked in pieces. Only the text enters a score.

Null or empty text has one empty window and gets the model's base score. A document labelled
more than once is toxic if any label says so; null labels are ignored. Without labels of
both classes every score is the share of toxic labels (0 without labels). Repeated rows are
scored alike.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import give_back, text_of, worker_state

BUCKETS = 1 << 18
DIM = 8
NGRAMS = (3, 4, 5, 6)
WINDOW = 2
THRESHOLD = 0.3
SAMPLE_ROWS = {1: 1500, 0: 3000}
STEPS = 150
MIN_DOCS = 3
RATES = (0.6, 0.1, 0.2)  # embeddings, softmax direction, bias
DECAY = 0.002
SEED = 7
PIECE_CHARS = 1_000_000
CACHE_WORDS = 300_000

_WORDS = re.compile(r"[^\W_]+")


@dataclass
class Model:
    """``weights``: per bucket, its embedding times the softmax's toxic-minus-clean direction."""

    weights: np.ndarray
    bias: float
    constant: float | None = None


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every subword, first subword of each word): n-grams of ``<word>`` and the word itself."""
    marked = "".join(f"<{w}>" for w in words)
    code = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lens = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lens)
    starts = ends - lens
    end_of = np.repeat(ends, lens)
    word_of = np.repeat(np.arange(len(words)), lens)
    pos = np.arange(len(code))
    base = np.uint64(0x100000001B3)
    owners, buckets = [], []

    def mixed(h: np.ndarray, salt: int) -> np.ndarray:
        h = (h + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ (h >> np.uint64(31))) % np.uint64(BUCKETS)).astype(np.int32)

    h = code.copy()
    for n in range(2, max(NGRAMS) + 1):
        if len(code) < n:
            break
        h = h[: len(code) - n + 1] * base + code[n - 1 :]
        if n in NGRAMS:
            ok = pos[: len(h)] + n <= end_of[: len(h)]
            owners.append(word_of[: len(h)][ok])
            buckets.append(mixed(h[ok], n))
    # the whole word: a polynomial over it, by segments
    power = (pos - np.repeat(starts, lens)).astype(np.uint64)
    whole = np.add.reduceat((code + np.uint64(1)) * (power * power * base + power * np.uint64(0x51ED27) + np.uint64(1)), starts)
    owners.append(np.arange(len(words)))
    buckets.append(mixed(whole, 99))
    owner, bucket = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[order], np.arange(len(words)))
    return bucket[order], first


def _segment_mean(values: np.ndarray, first: np.ndarray, total: int) -> np.ndarray:
    sizes = np.diff(np.append(first, total))
    return np.add.reduceat(values, first) / sizes


def train(texts: list[str], labels: np.ndarray, weights: np.ndarray, steps: int = STEPS) -> Model:
    """Fit embeddings and softmax on whole texts, by momentum with one step size per tensor over the full sample."""
    positive = float(weights[labels == 1].sum() / weights.sum()) if len(labels) else 0.0
    if not 0.0 < positive < 1.0:
        return Model(np.zeros(0, np.float32), 0.0, positive)
    index: dict[str, int] = {}
    ids, lens = [], []
    for t in texts:
        ws = words_of(t)
        ids.append(np.fromiter((index.setdefault(w, len(index)) for w in ws), dtype=np.int32, count=len(ws)))
        lens.append(len(ws))
    if not index:
        return Model(np.zeros(0, np.float32), 0.0, positive)
    flat = np.concatenate(ids)
    doc_start = np.concatenate([[0], np.cumsum(lens)])[:-1]
    n_win = np.maximum(1, -(-np.array(lens) // WINDOW))
    win_first = np.concatenate([s + WINDOW * np.arange(k) for s, k, n in zip(doc_start, n_win, lens, strict=True) if n])
    win_doc = np.repeat(np.arange(len(lens)), np.where(np.array(lens) > 0, n_win, 0))
    win_len = np.diff(np.append(win_first, len(flat)))
    names, n_words = list(index), len(index)
    del index
    parts = []  # (words, their subwords, first and number per word): those of all words at once would fill the driver
    for i in range(0, n_words, 20_000):
        bucket, first = subwords(names[i : i + 20_000])
        parts.append((slice(i, i + len(first)), bucket, first, np.diff(np.append(first, len(bucket)))))
    del names

    def spread(values: np.ndarray) -> np.ndarray:
        """Values of the words, added up over their subwords by bucket."""
        out = np.zeros(BUCKETS)
        for words, bucket, _, n in parts:
            out += np.bincount(bucket, np.repeat(values[words], n), minlength=BUCKETS)
        return out

    # n-grams of fewer than MIN_DOCS sampled documents carry no evidence beyond their own document
    word_doc = np.unique(np.repeat(np.arange(len(lens), dtype=np.int64), lens) * n_words + flat)
    word_df = np.bincount(word_doc % n_words, minlength=n_words)
    del word_doc
    common = spread(word_df) >= MIN_DOCS
    sub_len = np.concatenate([n for *_, n in parts]) if parts else np.zeros(0, np.int64)

    rng = np.random.default_rng(SEED)
    emb = (rng.standard_normal((BUCKETS, DIM), dtype=np.float32) * 0.1 * common[:, None]).astype(np.float32)
    direction = (rng.standard_normal(DIM) * 0.5).astype(np.float32)
    bias = np.array([-5.0], np.float32)
    params = [emb, direction, bias]
    moments = [[np.zeros_like(p), 0.0] for p in params]
    y = labels.astype(bool)
    share = (weights / weights.sum()).astype(np.float64)
    for step in range(1, steps + 1):
        a = emb @ direction
        word = np.concatenate([np.add.reduceat(a[bucket], first) for _, bucket, first, _ in parts]) / sub_len
        z = bias[0] + np.add.reduceat(word[flat], win_first) / win_len
        soft = np.logaddexp(0.0, z)
        s = np.bincount(win_doc, soft, minlength=len(y))
        s[np.array(lens) == 0] = np.logaddexp(0.0, bias[0])
        s = np.maximum(s, 1e-9)
        # d loss / d s, with loss = -log(1 - exp(-s)) for toxic and s for clean documents
        ds = np.where(y, -1.0 / np.expm1(np.minimum(s, 50.0)), 1.0) * share
        dz = ds[win_doc] / (1.0 + np.exp(-z))
        dword = np.bincount(flat, np.repeat(dz / win_len, win_len), minlength=n_words)
        da = spread((dword / sub_len).astype(np.float32)).astype(np.float32)
        da *= common
        grads = [da[:, None] * direction[None, :], emb.T @ da, np.array([dz.sum()], np.float32)]
        # momentum with one step size per tensor: evidence shared by many documents moves first,
        # where a step size per coordinate would let rare n-grams memorise their document
        for p, g, moment, rate in zip(params, grads, moments, RATES, strict=True):
            moment[0] += 0.1 * (g - moment[0])
            moment[1] += 0.1 * (float((g * g).max()) - moment[1])
            grown = 1 - 0.9**step
            p *= 1.0 - rate * DECAY
            p -= rate * (moment[0] / grown) / (np.sqrt(moment[1] / grown) + 1e-12)
    return Model((emb @ direction).astype(np.float32), float(bias[0]))


class Scorer:
    """Scores texts under a model; word scores are kept in a bounded cache."""

    def __init__(self, model: Model):
        self.model = model
        self.cache: dict[str, float] = {}

    def _word_scores(self, words: list[str]) -> np.ndarray:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = [w for w in set(words) if w not in self.cache]
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            bucket, first = subwords(part)
            self.cache.update(zip(part, _segment_mean(self.model.weights[bucket], first, len(bucket)).tolist(), strict=True))
        return np.fromiter(map(self.cache.__getitem__, words), np.float64, count=len(words))

    def _hazard(self, words: list[str]) -> float:
        """Sum over windows of -log(1 - p)."""
        scores = self._word_scores(words)
        first = np.arange(0, len(words), WINDOW)
        z = self.model.bias + _segment_mean(scores, first, len(words))
        return float(np.logaddexp(0.0, z).sum())

    def score(self, text: str) -> float:
        if self.model.constant is not None:
            return self.model.constant
        hazard, carry, at, seen = 0.0, [], 0, False
        while at < len(text):
            end = min(len(text), at + PIECE_CHARS)
            while end < len(text) and text[end].isalnum():
                end += 1
            words = carry + words_of(text[at:end])
            at = end
            keep = len(words) % WINDOW if at < len(text) else 0
            carry, words = (words[len(words) - keep :], words[: len(words) - keep]) if keep else ([], words)
            if words:
                seen = True
                hazard += self._hazard(words)
        if not seen:
            hazard = float(np.logaddexp(0.0, self.model.bias))
        return float(-np.expm1(-hazard))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample_rows: dict[int, int] = SAMPLE_ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts, labels and weights of the bounded training sample.

    ``labels``: (doc_id, toxic), already without held-out rows.
    """
    marks = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    totals = {r["y"]: r["count"] for r in marks.groupBy("y").count().collect()}
    texts: list[str] = []
    ys: list[int] = []
    ws: list[float] = []
    for y, bound in sorted(sample_rows.items()):
        ids = marks.filter(F.col("y") == y).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        rows = (
            docs.select(F.col("doc_id").alias("d"), text_of("text").alias("text"))
            .join(ids, F.col("d") == F.col("doc_id"), "left_semi")
            .orderBy(F.xxhash64("d"), "d", "text")
            .limit(bound)
            .collect()
        )
        texts += [r["text"] for r in rows]
        ys += [y] * len(rows)
        ws += [totals[y] / len(rows)] * len(rows) if rows else []
    return texts, np.array(ys, dtype=np.int64), np.array(ws, dtype=np.float64)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    return train(*labelled_sample(docs, labels))


def score_column(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A column function from text to score."""
    shared = spark.sparkContext.broadcast((model.weights, model.bias, model.constant))  # BUCKETS floats

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_state("toxicity")  # the tokenizer of an earlier run's output goes
        scorer = Scorer(Model(*shared.value))
        for texts in batches:
            yield texts.map(scorer.score).astype(float)
        del scorer
        give_back()

    return lambda text: scored(text_of(text))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) for every row."""
    scored = score_column(docs.sparkSession, model)
    return docs.select("doc_id", scored(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score under the threshold, with their columns."""
    scored = score_column(docs.sparkSession, model)
    return docs.filter(scored(F.col("text")) < threshold)
