"""Cross-tokenizer alignment: token ends intersected by galloping search.

Tokenizer A is a byte-level BPE of the tokenizers library and reads a space plus the text;
tokenizer B is a sentencepiece model, which adds that space itself. Special tokens are not
added, and their strings inside texts are plain text. Each side's token ends are ascending
byte offsets. The shorter end list drives: every end of it gallops (exponential steps from
where its rank in its document suggests, then binary search) to its rank in the longer list.
Offsets in both lists cut the tokens into groups; the difference of two consecutive ranks is
the range of tokens that one token overlaps.

A link is a pair of token occurrences whose byte ranges overlap. The count of an (A id, B id)
pair is the number of documents that hold it linked. Counting goes by chunks of documents of
about CHUNK_CHARS characters: a chunk's distinct pairs are counted where the chunk is read,
the counts of all chunks are summed by pair, and every chunk gets the totals of its own pairs
back, so what is shuffled are distinct pairs per chunk, not links. No table of pairs is broadcast.

Null and empty texts, and texts whose joined token bytes differ from space plus text on
either side, have no tokens: zeros, and an empty groups_sha256. Repeated rows and ids, and
null ids, are documents of their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import Scratch, text_of, worker_state
from tallycast.llm.rans import PieceEncoder

CHUNK_CHARS = 1_000_000
CACHED_UNIT = 64      # longer units are encoded each time
CACHE_ITEMS = 250_000  # per generation; two are kept for each tokenizer
_UNIT = re.compile(" +[^ ]*")


class ByteSide:
    """Tokenizer A: ids of space plus text, and the bytes of every id."""

    def __init__(self, path: str):
        self.encoder = PieceEncoder(path)
        self.encoder.tokenizer.encode_special_tokens = True
        letters = {c: b for b, c in self.encoder.letters.items()}
        vocab = self.encoder.tokenizer.get_vocab()
        self.size = max(vocab.values()) + 1
        self.bytes = np.full(self.size, b"", dtype=object)
        for token, i in vocab.items():
            known = all(c in letters for c in token)
            self.bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.length = np.array([len(b) for b in self.bytes], dtype=np.int64)

    def encode(self, text: str) -> np.ndarray:
        return self.encoder.encode(" " + text)


class PieceSide:
    """Tokenizer B: ids of a text to which the model adds a space, and the bytes of every id.

    No piece of such a model has a space after another character, so merges never cross the
    start of a run of spaces: a text's ids are those of its units (spaces with what follows
    up to the next space), and each distinct unit is encoded once. A model with other pieces,
    or one that changes its input, gets whole texts.
    """

    def __init__(self, path: str, units: bool = True):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        self.bytes = np.full(self.size, b"", dtype=object)
        for i, p in enumerate(pieces):
            self.bytes[i] = bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
        self.length = np.array([len(b) for b in self.bytes], dtype=np.int64)
        probe = "  a  b ﬁ Ⅷ\n c\t"
        kept = b"".join(self.bytes[self._ids(probe)]) == (" " + probe).encode()
        self.units = units and kept and not any("▁" in p.lstrip("▁") for p in pieces)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), dtype=np.int64)

    def encode(self, text: str) -> np.ndarray:
        if not self.units or not text:
            return self._ids(text)
        if len(self.known) > CACHE_ITEMS:
            self.old, self.known = self.known, {}
        units, known, old = _UNIT.findall(" " + text), self.known, self.old
        new = set(units).difference(known)
        known.update((u, old[u]) for u in new if u in old)
        new = [u for u in new if u not in old]
        # the model adds no space to an empty text, so a last space alone is looked up
        ids = self.model.encode([u[1:] for u in new], num_threads=1) if new else []
        fresh = {u: array("I", i if len(u) > 1 else [self.model.piece_to_id("▁")]).tobytes() for u, i in zip(new, ids, strict=True)}
        known.update(fresh)
        raw = b"".join(map(known.__getitem__, units))
        for u in new:
            if len(u) > CACHED_UNIT:
                del known[u]
        return np.frombuffer(raw, dtype=np.uint32).astype(np.int64)


def sides(path_a: str, path_b: str) -> tuple[ByteSide, PieceSide]:
    """Both tokenizers, once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    loaded = worker_state("alignment").setdefault("sides", {})
    if (path_a, path_b) not in loaded:
        loaded[path_a, path_b] = ByteSide(path_a), PieceSide(path_b)
    return loaded[path_a, path_b]


def gallop(keys: np.ndarray, into: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each key, the first position of ascending ``into`` with a value >= the key (len(into) if none).

    Each key steps 1, 2, 4, ... away from its start until its place is enclosed, then halves the range.
    """
    n = len(into)
    if not n:
        return np.zeros(len(keys), dtype=np.int64)
    hi = np.clip(start, 0, n - 1)
    lo = hi.copy()
    below = into[hi] < keys
    live, step = np.flatnonzero(~below), 1
    while len(live):
        hi[live] = lo[live]
        lo[live] = np.maximum(lo[live] - step, -1)
        live = live[lo[live] >= 0]
        live = live[into[lo[live]] >= keys[live]]
        step *= 2
    live, step = np.flatnonzero(below), 1
    while len(live):
        lo[live] = hi[live]
        hi[live] = np.minimum(hi[live] + step, n)
        live = live[hi[live] < n]
        live = live[into[hi[live]] < keys[live]]
        step *= 2
    live = np.flatnonzero(hi - lo > 1)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        less = into[mid] < keys[live]
        lo[live[less]] = mid[less]
        hi[live[~less]] = mid[~less]
        live = live[hi[live] - lo[live] > 1]
    return hi


@dataclass
class Aligned:
    """Documents of a batch: ids of both sides in one row each, document bounds, and what galloping found.

    ``cut_a`` and ``cut_b`` hold the token that ends each group; the tokens of the driving side
    overlap ``first`` to ``last`` of the other.
    """

    a: np.ndarray
    b: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    groups: np.ndarray
    a_drives: bool
    first: np.ndarray
    last: np.ndarray

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``a`` and ``b`` of every link."""
        n = self.last - self.first + 1
        drive = np.repeat(np.arange(len(n)), n)
        other = np.arange(len(drive)) - np.repeat(np.cumsum(n) - n - self.first, n)
        return (drive, other) if self.a_drives else (other, drive)


def align_ids(a_ids: list[np.ndarray], b_ids: list[np.ndarray], a_len: np.ndarray, b_len: np.ndarray) -> Aligned:
    """Align documents whose two token lists cover the same bytes; lists may be empty on both sides."""
    none = [np.zeros(0, np.int64)]
    a, b = np.concatenate(none + a_ids).astype(np.int64), np.concatenate(none + b_ids).astype(np.int64)
    at_a = np.concatenate([[0], np.cumsum([len(x) for x in a_ids], dtype=np.int64)])
    at_b = np.concatenate([[0], np.cumsum([len(x) for x in b_ids], dtype=np.int64)])
    ends_a, ends_b = np.cumsum(a_len[a]), np.cumsum(b_len[b])
    a_drives = len(a) <= len(b)
    keys, into, at_k, at_i = (ends_a, ends_b, at_a, at_b) if a_drives else (ends_b, ends_a, at_b, at_a)
    per_k, per_i = np.diff(at_k), np.diff(at_i)
    ratio = np.repeat(per_i / np.maximum(per_k, 1), per_k)
    doc = np.repeat(np.arange(len(per_k)), per_k)
    start = at_i[:-1][doc] + ((np.arange(len(keys)) - at_k[:-1][doc]) * ratio).astype(np.int64)
    last = gallop(keys, into, start)
    same = into[last] == keys if len(keys) else np.zeros(0, bool)
    first = np.zeros(len(keys), np.int64)
    first[1:] = last[:-1] + same[:-1]
    hit = np.flatnonzero(same)
    cut_a, cut_b = (hit, last[hit]) if a_drives else (last[hit], hit)
    groups = np.bincount(doc[hit], minlength=len(per_k))
    return Aligned(a, b, at_a, at_b, cut_a, cut_b, groups, a_drives, first, last)


class Renderer:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        self.table = np.array(
            [b"%d," % i for i in range(n_a)] + [b"%d|" % i for i in range(n_a)]
            + [b"%d," % i for i in range(n_b)] + [b"%d;" % i for i in range(n_b)],
            dtype=object,
        )

    def texts(self, x: Aligned) -> list[bytes]:
        size_a, size_b = np.diff(x.cut_a, prepend=-1), np.diff(x.cut_b, prepend=-1)
        order = np.empty(len(x.a) + len(x.b), dtype=np.int64)
        shown_a, shown_b = x.a.copy(), x.b + 2 * self.n_a
        shown_a[x.cut_a] += self.n_a
        shown_b[x.cut_b] += self.n_b
        order[np.arange(len(x.a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)] = shown_a
        order[np.arange(len(x.b)) + np.repeat(np.cumsum(size_a), size_b)] = shown_b
        parts, at = self.table[order], x.at_a + x.at_b
        return [b"".join(parts[lo:hi])[:-1] for lo, hi in zip(at[:-1], at[1:], strict=True)]


def _forget() -> None:
    """Free the tokenizers of a worker whose later tasks need none."""
    worker_state("alignment").clear()


def _renderer(a: ByteSide, b: PieceSide) -> Renderer:
    held = worker_state("alignment").setdefault("texts", {})
    if (a.size, b.size) not in held:
        held[a.size, b.size] = Renderer(a.size, b.size)
    return held[a.size, b.size]


def _encode(texts: pd.Series, a: ByteSide, b: PieceSide) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of both sides; none where a side does not give back space plus text."""
    none = np.zeros(0, np.int64)
    out_a, out_b = [], []
    for t in texts:
        x = y = none
        if t:
            want = (" " + t).encode("utf-8", "surrogatepass")
            x, y = a.encode(t), b.encode(t)
            if b"".join(a.bytes[x]) != want or b"".join(b.bytes[y]) != want:
                x = y = none
        out_a.append(x)
        out_b.append(y)
    return out_a, out_b


def _slices(pdf: pd.DataFrame, chars: int) -> Iterator[pd.DataFrame]:
    at = 0
    while at < len(pdf):
        sizes = pdf["text"].iloc[at:].str.len().cumsum().to_numpy()
        n = max(1, int(np.searchsorted(sizes, chars, side="right")))
        yield pdf.iloc[at : at + n]
        at += n


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_ends, b_ends): both token lists, and for every group the tokens up to its end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = sides(path_a, path_b)
        for pdf in batches:
            for part in _slices(pdf, CHUNK_CHARS):
                a_ids, b_ids = _encode(part["text"], a, b)
                x = align_ids(a_ids, b_ids, a.length, b.length)
                at = np.concatenate([[0], np.cumsum(x.groups)])
                bounds = list(zip(at[:-1], at[1:], x.at_a[:-1], x.at_b[:-1], strict=True))
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].astype("Int64").to_numpy(), "a_ids": a_ids, "b_ids": b_ids,
                        "a_ends": [x.cut_a[lo:hi] + 1 - o for lo, hi, o, _ in bounds],
                        "b_ends": [x.cut_b[lo:hi] + 1 - o for lo, hi, _, o in bounds],
                    }
                )

    return docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text")).mapInPandas(
        run, "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>"
    )


def _small(x: np.ndarray) -> bytes:
    """Counts or indices in the fewest bytes that hold them; the first byte is the width."""
    top = int(x.max()) if len(x) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _large(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{raw[0]}", offset=1).astype(np.int64)


CHUNK_SCHEMA = (
    "chunk long, codes binary, held binary, doc_ids binary, no_id binary, n_a binary, n_b binary, n_groups binary, "
    "n_links binary, digests binary, n_pairs binary, pair binary, times binary"
)


def chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per chunk of documents: its distinct pairs with the documents that hold them, and its documents.

    A pair's code is A id * size of B + B id. Per document: sizes, digest of its groups, and its
    distinct pairs (as places in ``codes``) with the links of each.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = sides(path_a, path_b)
        text = _renderer(a, b)
        task, nth = TaskContext.get().partitionId(), 0
        for pdf in batches:
            for part in _slices(pdf, CHUNK_CHARS):
                x = align_ids(*_encode(part["text"], a, b), a.length, b.length)
                digests = [hashlib.sha256(g).digest() if g else bytes(32) for g in text.texts(x)]
                from_a, from_b = x.links()
                doc = np.repeat(np.arange(len(part)), np.diff(x.at_a))[from_a]
                n_links = np.bincount(doc, minlength=len(part))
                space = a.size * b.size
                held, times = np.unique(doc * space + x.a[from_a] * b.size + x.b[from_b], return_counts=True)
                codes, pair, docs_of = np.unique(held % space, return_inverse=True, return_counts=True)
                ids = part["doc_id"].astype("Int64")
                yield pd.DataFrame(
                    {
                        "chunk": [task << 32 | nth],
                        "codes": [_small(codes)], "held": [_small(docs_of)],
                        "doc_ids": [ids.fillna(0).to_numpy(np.int64).tobytes()],
                        "no_id": [ids.isna().to_numpy().astype(np.uint8).tobytes()],
                        "n_a": [_small(np.diff(x.at_a))], "n_b": [_small(np.diff(x.at_b))],
                        "n_groups": [_small(x.groups)], "n_links": [_small(n_links)], "digests": [b"".join(digests)],
                        "n_pairs": [_small(np.bincount(held // space, minlength=len(part)))],
                        "pair": [_small(pair)], "times": [_small(times)],
                    }
                )
                nth += 1

    return docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text")).mapInPandas(run, CHUNK_SCHEMA)


def chunk_pairs(chunked: DataFrame) -> DataFrame:
    """(chunk, code, n) for every distinct pair of every chunk; n documents of the chunk hold it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _forget()
        for pdf in batches:
            for chunk, codes, held in pdf.itertuples(index=False):
                codes = _large(codes)
                yield pd.DataFrame({"chunk": np.full(len(codes), chunk), "code": codes, "n": _large(held)})

    return chunked.select("chunk", "codes", "held").mapInPandas(run, "chunk long, code long, n long")


def pair_counts(pairs: DataFrame, size_b: int) -> DataFrame:
    """(code, n, best): documents per pair, and whether no pair of its A id has more."""
    counts = pairs.groupBy("code").agg(F.sum("n").alias("n")).withColumn("a", F.floor(F.col("code") / F.lit(size_b)))
    most = counts.groupBy(F.col("a").alias("of")).agg(F.max("n").alias("most"))
    return counts.join(most, F.col("a") == F.col("of")).select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def digest(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (see the module)."""
    scratch = Scratch(docs.sparkSession)
    chunked = scratch.store(chunks(docs, path_a, path_b), "chunks")
    size_b = PieceSide(path_b, units=False).size
    pairs = scratch.store(chunk_pairs(chunked), "pairs")
    totals = pair_counts(pairs, size_b)
    known = pairs.select("chunk", F.col("code").alias("of")).join(totals, F.col("of") == F.col("code")).select("chunk", "code", "n", "best")

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        _forget()
        right = right.sort_values("code")  # the chunk's codes are ascending too
        n, best = right["n"].to_numpy(np.int64), right["best"].to_numpy(bool)
        out = []
        for row in left.itertuples(index=False):
            pair, times = _large(row.pair), _large(row.times)
            at = np.concatenate([[0], np.cumsum(_large(row.n_pairs))])
            sums = [np.concatenate([[0], np.cumsum(times * v[pair])]) for v in (best.astype(np.int64), n)] if len(pair) else [np.zeros(1, np.int64)] * 2
            raw = [row.digests[i : i + 32] for i in range(0, len(row.digests), 32)]
            ids = pd.array(np.frombuffer(row.doc_ids, np.int64).copy(), dtype="Int64")
            ids[np.frombuffer(row.no_id, np.uint8).astype(bool)] = pd.NA
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": ids,
                        **{c: _large(getattr(row, c)) for c in ("n_a", "n_b", "n_groups", "n_links")},
                        "n_best": sums[0][at[1:]] - sums[0][at[:-1]], "count_sum": sums[1][at[1:]] - sums[1][at[:-1]],
                        "groups_sha256": [d.hex() if any(d) else "" for d in raw],
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id"])

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return chunked.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(finish, schema)
