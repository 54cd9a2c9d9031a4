"""Language identification: words first, backing off to shorter character n-grams.

Training counts every word of every labelled text per language, and from those counts the
character n-grams (1 to ORDERS code points, word ends marked) per language. A document's
score for a language is the sum over its words of the word's log frequency there. A word that
the model does not know is scored by its n-grams of the longest order of which any is known,
as the mean of their log frequencies; so shorter n-grams serve only words of which no longer
one was seen.

Counts cover all labelled texts. The model keeps the MODEL_ROWS most frequent (word, language) and
as many (n-gram, language) rows, fewer with very many languages (MODEL_CELLS / languages), so
its size has a fixed limit and it is broadcast; what it leaves out is scored by back-off. The cut is a count: rows as
frequent as each other stay or go together.

Words are maximal runs of letters (and other word signs that are neither digits nor ``_``), lower-cased,
with at least one letter. A text that is null or has no letter is ``und`` with score 0, as is
every text if nothing was learned. Otherwise the score is the predicted language's share of
the likelihood; languages that tie go to the smallest name. Rows with a null label or text
teach nothing; repeated rows count again. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import Scratch

ORDERS = 5
MODEL_ROWS = 200_000
MODEL_CELLS = 4_000_000
SMOOTHING = 0.1
FLUSH_ROWS = 300_000
CACHE_WORDS = 200_000
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    words = _WORD.findall(text.lower())
    return words if text.isascii() else [w for w in words if w.isalpha() or any(map(str.isalpha, w))]


def grams_of(word: str, order: int) -> list[str]:
    """n-grams of the word between its end marks; an order longer than the marked word has none."""
    marked = f"<{word}>" if order > 1 else word
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n) over all (lang, text) rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter[str]] = {}

        def rows() -> pd.DataFrame:
            return pd.DataFrame(
                [(lang, w, n) for lang, c in seen.items() for w, n in c.items()], columns=["lang", "word", "n"]
            )

        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text))
                if sum(map(len, seen.values())) > FLUSH_ROWS:
                    yield rows()
                    seen.clear()
        if seen:
            yield rows()

    known = texts.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return known.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, orders: int = ORDERS) -> DataFrame:
    """(lang, gram, n) from (lang, word, n)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                seen: dict[str, int] = {}
                for word, n in zip(part["word"].tolist(), part["n"].tolist(), strict=True):
                    for order in range(1, orders + 1):
                        for g in grams_of(word, order):
                            seen[g] = seen.get(g, 0) + n
                    if len(seen) > FLUSH_ROWS:
                        yield _gram_rows(lang, seen)
                        seen = {}
                yield _gram_rows(lang, seen)

    return (
        words.select("lang", "word", "n").mapInPandas(count, "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )


def _gram_rows(lang: str, seen: dict[str, int]) -> pd.DataFrame:
    return pd.DataFrame({"lang": lang, "gram": list(seen), "n": np.array(list(seen.values()), dtype=np.int64)})


def frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The rows of (.., n) with n at least the smallest of a fixed series of cuts that leaves at most ``limit``.

    Cuts are the whole numbers below 1,024 and then steps of under 0.2 percent; only a count per cut reaches the driver.
    """
    shift = F.greatest(F.floor(F.log2(F.col("n").cast("double"))) - F.lit(9), F.lit(0)).cast("int")
    cut = F.expr("shiftleft(shiftright(n, s), s)")
    rows = counts.withColumn("s", shift).withColumn("cut", cut)
    held, least = 0, None
    for r in sorted(rows.groupBy("cut").count().collect(), reverse=True):
        held += r["count"]
        if held > limit:
            break
        least = r["cut"]
    return counts.filter(F.lit(False) if least is None else F.col("n") >= least)


@dataclass
class Model:
    """Log frequencies: a row per known word, and per known n-gram, a column per language."""

    langs: list[str]
    words: list[str]
    word_logs: np.ndarray
    grams: list[str]
    gram_logs: np.ndarray


def _logs(rows: pd.DataFrame, name: str, langs: list[str], totals: dict[tuple[str, int], tuple[int, int]], order_of) -> tuple[list[str], np.ndarray]:
    """Smoothed log frequency per (entry, language); an entry is measured against all counts of its order."""
    entries = sorted(set(rows[name]))
    place = {e: i for i, e in enumerate(entries)}
    counts = np.zeros((len(entries), len(langs)))
    at = {lang: i for i, lang in enumerate(langs)}
    counts[[place[e] for e in rows[name]], [at[lang] for lang in rows["lang"]]] = rows["n"].to_numpy(np.float64)
    total = np.zeros_like(counts)
    for i, e in enumerate(entries):
        for j, lang in enumerate(langs):
            n, kinds = totals.get((lang, order_of(e)), (0, 0))
            total[i, j] = n + SMOOTHING * (kinds + 1)
    return entries, np.log((counts + SMOOTHING) / np.maximum(total, SMOOTHING))


def train(texts: DataFrame, model_rows: int = MODEL_ROWS, orders: int = ORDERS) -> Model:
    """Fit on (lang, text) rows."""
    scratch = Scratch(texts.sparkSession)
    words = scratch.store(word_counts(texts), "lang-words")
    grams = scratch.store(gram_counts(words, orders), "lang-grams")
    size = F.length("gram")
    sums = F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")
    word_totals = {(r["lang"], 0): (r["n"], r["kinds"]) for r in words.groupBy("lang").agg(*sums).collect()}
    gram_totals = {(r["lang"], r["o"]): (r["n"], r["kinds"]) for r in grams.groupBy("lang", size.alias("o")).agg(*sums).collect()}
    langs = sorted({lang for lang, _ in word_totals})
    limit = min(model_rows, MODEL_CELLS // max(1, len(langs)))
    known, parts = frequent(words, limit).toPandas(), frequent(grams, limit).toPandas()  # at most limit rows each
    model = Model(
        langs, *_logs(known, "word", langs, word_totals, lambda _: 0), *_logs(parts, "gram", langs, gram_totals, len)
    )
    scratch.release()
    return model


class Scorer:
    """Scores texts under a model; the scores of words that the model does not know are kept in a bounded cache."""

    def __init__(self, model: Model):
        self.model = model
        self.grams = {g: i for i, g in enumerate(model.grams)}
        self.orders = sorted({len(g) for g in model.grams}, reverse=True)
        self.fixed = {w: i for i, w in enumerate(model.words)}
        self.reset()

    def reset(self) -> None:
        self.place = dict(self.fixed)
        n = len(self.fixed)
        self.logs = np.zeros((n + CACHE_WORDS, len(self.model.langs)))
        self.logs[:n] = self.model.word_logs
        self.n = n

    def backed_off(self, words: list[str]) -> np.ndarray:
        """Per word the mean log frequencies of the known n-grams of the longest order that has one; zeros if none has."""
        rows, sizes = [], []
        for w in words:
            found: list[int] = []
            for order in self.orders:
                found = [self.grams[g] for g in grams_of(w, order) if g in self.grams]
                if found:
                    break
            rows += found
            sizes.append(len(found))
        out, n = np.zeros((len(words), len(self.model.langs))), np.array(sizes)
        some = n > 0
        if rows:
            first = np.cumsum(n[some]) - n[some]
            out[some] = np.add.reduceat(self.model.gram_logs[rows], first, axis=0) / n[some][:, None]
        return out

    def _rows(self, words: list[str]) -> np.ndarray:
        new = {w for w in words if w not in self.place}
        if self.n + len(new) > len(self.logs):
            self.reset()
            new = {w for w in words if w not in self.place}
        if new:
            self.logs[self.n : self.n + len(new)] = self.backed_off(list(new))
            self.place.update(zip(new, range(self.n, self.n + len(new)), strict=True))
            self.n += len(new)
        return np.fromiter(map(self.place.__getitem__, words), np.int64, count=len(words))

    def sums(self, words: list[str]) -> np.ndarray:
        """Log frequencies added over the words, by language; long texts go part by part."""
        total = np.zeros(len(self.model.langs))
        for at in range(0, len(words), CACHE_WORDS // 2):
            total += self.logs[self._rows(words[at : at + CACHE_WORDS // 2])].sum(axis=0)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not words or not self.model.langs:
            return UNKNOWN, 0.0
        s = self.sums(words)
        best = int(np.argmax(s))
        return self.model.langs[best], float(1.0 / np.exp(s - s[best]).sum())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 * MODEL_CELLS numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for pdf in batches:
            found = [scorer.predict(t) for t in pdf["text"]]
            yield pd.DataFrame(
                {"doc_id": pdf["doc_id"].astype("Int64"), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, lang_pred string, score double")
