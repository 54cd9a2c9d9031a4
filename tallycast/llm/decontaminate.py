"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are lower-cased and white space collapsed. Every benchmark item is cut into segments
of SEGMENT characters, half overlapping; a document is contaminated by an item if some part
of it aligns with a segment within EDIT_SHARE of its length in edits.

A segment of length m within k edits of a document part shares at least m - Q + 1 - k Q
q-grams with it, all on 2k + 1 neighbouring diagonals (document position minus item
position). So the document's q-grams are looked up in the benchmark's index (numpy), shared
ones are counted per item and band of diagonals - bands of twice that width, half
overlapping, so one always holds the whole alignment - and only segments whose count reaches
the bound go to the banded alignment that verifies them.

The benchmark's distinct texts, long ones in pieces of PIECE_CHARS that hold the same segments,
are split by a hash into blocks of about BLOCK_CHARS characters; each block is one bounded
broadcast and one pass over the documents, however large the benchmark grows and however often
it repeats a text. The ids of a text's items are joined to what was found.
Documents are read whole, long ones in overlapping slices.

Null or empty documents and items match nothing; neither do items shorter than Q characters
after normalising, and items shorter than SEGMENT are one segment. Repeated documents and
items are reported each, those without an id with a null id. Only ids and texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import lean, materialise, text_of

Q = 8
SEGMENT = 64
EDIT_SHARE = 0.1
BLOCK_CHARS = 1_000_000
PIECE_CHARS = 1 << 16       # a multiple of SEGMENT // 2
SLICE_CHARS = 1_000_000
MAP_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
MATCHES = "doc_id long, item_id long, edits int, length int, segments int, start long, end long"


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def qgrams(c: np.ndarray) -> np.ndarray:
    """A 64-bit hash per q-gram, by doubling (Q is a power of two)."""
    if len(c) < Q:
        return np.zeros(0, np.uint64)
    h, n, base = c.astype(np.uint64), 1, 0x100000001B3
    while n < Q:
        h = h[: len(h) - n] * np.uint64(pow(base, n, 1 << 64)) + h[n:]
        n *= 2
    return h


def edit_budget(m: int) -> int:
    """Edits allowed for a segment of m characters; small enough that the q-gram bound is at least 1."""
    return max(0, min(int(EDIT_SHARE * m), (m - Q) // Q))


class Index:
    """The q-grams and segments of one block of the benchmark; ``ready`` texts are normalised and keep their outer spaces."""

    def __init__(self, items: list[tuple], ready: bool = False):
        self.items = [(i, codes(t if ready else normalise(t or ""))) for i, t in items]
        self.items = [(i, c) for i, c in self.items if len(c) >= Q]
        hashes = [qgrams(c) for _, c in self.items]
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
        off = np.concatenate([np.arange(len(x)) for x in hashes]) if hashes else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.item, self.off = item[order], off[order]
        self.hash, self.first, self.count = np.unique(h[order], return_index=True, return_counts=True)
        self.map = np.zeros(1 << MAP_BITS, dtype=bool)
        self.map[self._slot(self.hash)] = True
        self.size = np.array([len(c) for _, c in self.items], dtype=np.int64)
        self.length = np.minimum(SEGMENT, self.size)
        self.budget = np.array([edit_budget(m) for m in self.length.tolist()], dtype=np.int64)
        self.bound = self.length - Q + 1 - self.budget * Q
        self.least = int(self.bound.min()) if len(self.items) else 1
        self.reach = SEGMENT + 2 * edit_budget(SEGMENT)

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h * _MIX) >> np.uint64(64 - MAP_BITS)).astype(np.int64)

    def _hits(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, index of the q-gram) of the document's shared q-grams in places dense enough for a match."""
        h = qgrams(c)
        pos = np.flatnonzero(self.map[self._slot(h)])
        if not len(pos):
            return pos, pos
        at = np.minimum(np.searchsorted(self.hash, h[pos]), len(self.hash) - 1)
        ok = self.hash[at] == h[pos]
        pos, at = pos[ok], at[ok]
        if self.least > 1 and len(pos):
            # some window of `reach` characters around a matching q-gram holds at least `least` of them
            right = np.searchsorted(pos, pos + self.reach, "right")
            dense = right - np.arange(len(pos)) >= self.least
            keep = np.zeros(len(pos) + 1, dtype=np.int64)
            np.add.at(keep, np.flatnonzero(dense), 1)
            np.add.at(keep, right[dense], -1)
            ok = np.cumsum(keep[:-1]) > 0
            pos, at = pos[ok], at[ok]
        return pos, at

    def candidates(self, c: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, segment start, segment length, lowest diagonal) of the segments that reach the bound."""
        pos, at = self._hits(c)
        if not len(pos):
            return []
        n = self.count[at]
        entry = np.repeat(self.first[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item, off = self.item[entry], self.off[entry]
        diagonal = np.repeat(pos, n) - off
        # most shared q-grams are chance: keep those whose item and band may reach the bound,
        # counted in a small hash table (a superset, cheap)
        width = 2 * self.budget[item] + 1
        cell = diagonal // width
        bits = max(10, int(len(cell)).bit_length())
        keep = np.zeros(len(cell), dtype=bool)
        for shift in (0, 1):
            slot = ((item * 0x9E3779B1 + (cell + shift) // 2) * 0x85EBCA6B >> 8) & ((1 << bits) - 1)
            keep |= np.bincount(slot, minlength=1 << bits)[slot] >= self.bound[item]
        if not keep.any():
            return []
        item, off, diagonal, width = item[keep], off[keep], diagonal[keep], width[keep]
        m, size = self.length[item], self.size[item]
        # band b spans 2 * width diagonals from b * width; a q-gram counts once per band and segment
        band = diagonal // width - (diagonal // width).min() + 1
        step = SEGMENT // 2
        last = (size - m) // step
        keys = []
        span = int(band.max()) + 1
        places = int(self.size.max()) // step + 2  # segment starts by number; the end-aligned one is the last number
        for bd in (band, band - 1):
            for number, start in (
                (off // step, off // step * step),
                (off // step - 1, (off // step - 1) * step),
                (np.full(len(off), places - 1), size - m),
            ):
                ok = (start >= 0) & (off - start <= m - Q) & (off >= start) & ((number <= last) | (number == places - 1))
                keys.append((((item * span + bd) * places + number) * (SEGMENT + 1) + off - start)[ok])
        key = _runs(np.sort(np.concatenate(keys)))[0] // (SEGMENT + 1)
        key, first, end = _runs(key)
        count = end - first
        who = key // (span * places)
        enough = count >= self.bound[who]
        key, who = key[enough], who[enough]
        number, bd = key % places, key // places % span
        start = np.where(number == places - 1, self.size[who] - self.length[who], number * step)
        lowest = (bd - 1 + (diagonal // width).min()) * (2 * self.budget[who] + 1)
        return list(zip(who.tolist(), start.tolist(), self.length[who].tolist(), lowest.tolist(), strict=True))

    def match(self, text: str) -> list[tuple[int, int, int, int, int, int]]:
        """(item id, edits, length, segments, start, end) per item found in a text; places count normalised characters."""
        whole = codes(normalise(text))
        found: dict[int, list] = {}
        overlap = 2 * self.reach
        for lo in range(0, max(1, len(whole) - overlap), SLICE_CHARS):
            c = whole[lo : lo + SLICE_CHARS + overlap]
            cands = self.candidates(c)
            for m in {x[2] for x in cands}:
                some = [x for x in cands if x[2] == m]
                edits, ends = align(c, [(self.items[i][1][s : s + m], s + d) for i, s, _, d in some], edit_budget(m))
                for (i, s, _, _), e, end in zip(some, edits, ends, strict=True):
                    if e <= edit_budget(m):
                        f = found.setdefault(i, [e, m, set(), lo + end - m, lo + end])
                        f[0], f[1] = min((f[0], f[1]), (int(e), m))
                        f[2].add(s)
                        f[3], f[4] = min(f[3], lo + int(end) - m), max(f[4], lo + int(end))
        return [(self.items[i][0], int(e), m, len(s), max(0, int(a)), int(z)) for i, (e, m, s, a, z) in sorted(found.items())]


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, starts and ends of the runs of equal neighbours."""
    edges = np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]]) if len(x) else np.zeros(1, np.int64)
    return x[edges[:-1]], edges[:-1], edges[1:]


def align(c: np.ndarray, segments: list[tuple[np.ndarray, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each segment against the document near its lowest diagonal, and where they end.

    All segments have one length. A band row holds the edits of a segment prefix against the
    document part ending on each diagonal from ``at`` on; starts and ends in the band are free.
    """
    m, width = len(segments[0][0]), 2 * (2 * k + 1) + 2 * k
    lo = np.array([at for _, at in segments]) - k
    seg = np.stack([s for s, _ in segments])
    place = lo[:, None] + np.arange(m + width)[None, :]
    part = np.where((place >= 0) & (place < len(c)), c[np.clip(place, 0, len(c) - 1)], np.uint32(0xFFFFFFFF))
    shift = np.arange(width + 1, dtype=np.int32)
    row = np.zeros((len(segments), width + 1), dtype=np.int32)
    for i in range(m):
        sub = row + np.concatenate(
            [(part[:, i : i + width] != seg[:, i : i + 1]).astype(np.int32), np.ones((len(seg), 1), np.int32)], axis=1
        )
        drop = np.concatenate([row[:, 1:] + 1, np.full((len(seg), 1), 1 << 20, np.int32)], axis=1)
        row = np.minimum(sub, drop)
        row = np.minimum.accumulate(row - shift, axis=1) + shift
    best = row.argmin(axis=1)
    return row[np.arange(len(seg)), best], lo + m + best


def pieces(text: str) -> list[str]:
    """A normalised text in parts that together have its segments, and no others."""
    n = max(0, len(text) - SEGMENT) // PIECE_CHARS + 1
    cuts = [(k * PIECE_CHARS, (k + 1) * PIECE_CHARS + SEGMENT // 2 if k < n - 1 else len(text)) for k in range(n)]
    return [text[a:b] for a, b in cuts]


def distinct_pieces(items: DataFrame) -> DataFrame:
    """(key, piece, text, chars) of the distinct texts of (i, key, t), normalised."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, t in zip(pdf["key"], pdf["t"], strict=True):
                parts = pieces(normalise(t))
                yield pd.DataFrame({"key": key, "piece": range(len(parts)), "text": parts, "chars": [len(x) for x in parts]})

    texts = items.groupBy("key").agg(F.first("t").alias("t"))
    return materialise(texts.mapInPandas(lean(cut), "key long, piece int, text string, chars long"), "benchmark-pieces")


def blocks(parts: DataFrame) -> Iterator[list[tuple[tuple[int, int], str]]]:
    """The pieces in blocks of about BLOCK_CHARS characters, one at a time on the driver."""
    chars = parts.agg(F.sum("chars")).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for b in range(n):
        rows = parts.filter(F.pmod(F.xxhash64("key", "piece"), F.lit(n)) == b).collect()
        yield sorted(((r["key"], r["piece"]), r["text"]) for r in rows)


def _items(benchmark: DataFrame) -> DataFrame:
    t = text_of("text")
    return benchmark.select(F.col("item_id").cast("long").alias("i"), F.xxhash64(t).alias("key"), t.alias("t")).filter("t <> ''")


def _found_in(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """(tie, doc_id, key, piece, edits, length, segments, start, end): one row per document row and piece found in it;
    ``tie`` is the hash of the document's text."""
    spark = docs.sparkSession
    text = text_of("text")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    schema = "tie long, doc_id long, key long, piece int, edits int, length int, segments int, start long, end long"
    out = None
    several = (parts.agg(F.sum("chars")).first()[0] or 0) > BLOCK_CHARS
    for block in blocks(parts):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = None
            for pdf in batches:
                index = index or Index(shared.value, ready=True)
                each = zip(pdf["tie"], pdf["doc_id"].astype("Int64"), pdf["text"], strict=True)
                rows = [(h, d, *k, *m) for h, d, t in each for k, *m in index.match(t)]
                if rows:
                    columns = ["tie", "doc_id", "key", "piece", "edits", "length", "segments", "start", "end"]
                    yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

        found = texts.mapInPandas(lean(run), schema)
        if several:  # a block is done with before the next is sent
            found = materialise(found, "found-in-block")
            shared.unpersist()
        out = found if out is None else out.union(found)
    return spark.createDataFrame([], schema) if out is None else out


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it (MATCHES)."""
    items = _items(benchmark)
    parts = distinct_pieces(items)
    found = _found_in(docs, parts)
    long_ = parts.filter("piece > 0").select("key").distinct()
    if not long_.isEmpty():
        found = _whole_texts(found, long_)
    return found.join(items.select("key", F.col("i").alias("item_id")), "key").select(
        "doc_id", "item_id", "edits", "length", "segments", "start", "end"
    )


def _whole_texts(found: DataFrame, long_: DataFrame) -> DataFrame:
    """One row per document row and text for texts of several pieces."""
    row = ["tie", "doc_id", "key"]
    measures = ["edits", "length", "segments", "start", "end"]
    # copies of a document row find the same, so each piece is counted as often as there are copies
    once = found.join(long_, "key").groupBy(*row, "piece", *measures).agg(F.count(F.lit(1)).alias("copies"))
    best = F.min(F.struct("edits", "length"))
    whole = once.groupBy(*row).agg(
        best["edits"].alias("edits"), best["length"].alias("length"), F.sum("segments").cast("int").alias("segments"),
        F.min("start").alias("start"), F.max("end").alias("end"), F.max("copies").alias("copies"),
    )
    each = whole.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return found.join(long_, "key", "left_anti").select(*row, *measures).union(each.select(*row, *measures))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item was found, all columns kept.

    Rows are judged by their own text: others with the same id, or no id either, stay.
    """
    bad = _found_in(docs, distinct_pieces(_items(benchmark))).select(F.col("doc_id").alias("of"), F.col("tie").alias("hash")).distinct()
    # the caller's row travels as one struct, so its column names may be any
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64(text_of("text")).alias("tie"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    return rows.join(bad, F.col("id").eqNullSafe(F.col("of")) & (F.col("tie") == F.col("hash")), "left_anti").select("row.*")
