"""Token-ID output coded with a static range asymmetric numeral system.

``tokenise`` encodes whole texts and counts their ids on the way; ``frequency_table`` sums the counts of the corpus and
scales the counts to a shared table; ``encode`` sorts documents by id over shards and packs
them into independent blocks, each coded by LANES interleaved coders in numpy; ``write``
stores blocks and table as files; ``read_back`` decodes blocks in parallel, checks their
checksums and places each document by the block totals.

File format. ``table``: (token, frequency), frequencies summing to 2**SCALE_BITS at most.
``blocks``: (shard, block, n_tokens, doc_ids, doc_lens, states, words, word_counts,
checkpoints, crc): token i of a block is coded by lane i mod LANES; ``states`` are the lanes'
final states, ``words`` the renormalisation words in the order the decoder reads them,
``word_counts`` the words read before each checkpoint and ``checkpoints`` the lane states
there, one every CHECKPOINT_ROWS rows of LANES tokens, so that a block can be decoded from
several places at once; ``crc`` is the CRC-32 of the block's ids as little-endian uint32.
Blocks hold whole documents and follow each other in ascending document id.

Null text is an empty document: it has the end id only. Repeated ids are separate documents,
ordered by id, then by their tokens' checksum. Null ids come first. An empty table gives no blocks.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.llm.common import Scratch, lean, parallelism, text_of, worker_state
from tallycast.session import scratch_path

END_ID = 2
SCALE_BITS = 18
LANES = 2048
BLOCK_TOKENS = 1 << 20
CHECKPOINT_ROWS = 128
LOW = np.uint64(1 << 32)
CACHE_PIECES = 300_000  # per generation; what the last one held is not encoded anew

# The byte-level pre-tokenizer's split (letters, contractions, digits, other signs, white space),
# written for texts of ASCII and Latin letters. Other texts go to the library whole.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_PIECE = re.compile(
    rf" ?[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^ \t-\r{_LETTER}0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
)
_OTHER = re.compile("[^\x00-\x1b\x20-\x7e\u00c0-\u024f]")
_ASCII_PIECE = re.compile(_PIECE.pattern.replace(_LETTER, "A-Za-z"))  # the same pieces of an ASCII text
_ASCII_OTHER = "\x1c\x1d\x1e\x1f\x7f"


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level BPE writes each byte: itself if printable, else the next from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b if b in printable else 256 + others.index(b)) for b in range(256)}


class _Pieces(dict):
    """The packed ids of pieces; one that is not held yet is encoded, so that a text looks each of its pieces up once."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        raw = self[piece] = self.encode(piece)
        return raw


class PieceEncoder:
    """Whole-text ids from the tokenizers library; its model encodes each distinct piece once.

    ``pieces=False`` hands every text to the library whole; ``most`` replaces CACHE_PIECES.
    """

    most: int | None = None

    def __init__(self, path: str, pieces: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        t = self.tokenizer
        # only the parts wanted: the whole as JSON would hold the vocabulary several times over
        pre = json.loads(t.pre_tokenizer.__getstate__()) if t.pre_tokenizer else {}
        byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        self.pieces = pieces and bool(byte_level) and not t.normalizer and not t.post_processor
        added = [token.content for _, token in sorted(t.get_added_tokens_decoder().items())]
        self.special = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.letters = _byte_letters()
        self.model = self.tokenizer.model
        self.code, self.dtype = ("H", np.uint16) if self.tokenizer.get_vocab_size() <= 1 << 16 else ("I", np.uint32)
        self.cache, self.old = _Pieces(self._piece), {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _piece(self, piece: str) -> bytes:
        if piece in self.old:
            return self.old[piece]
        if piece.isascii() and piece.isprintable():  # its bytes but the space are their own letters
            written = piece.replace(" ", self.letters[0x20])
        else:
            written = piece.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(written)]).tobytes()

    def encode(self, text: str) -> np.ndarray:
        return self.ids(text).astype(np.uint32, copy=False)

    def ids(self, text: str) -> np.ndarray:
        """The ids, as uint16 where the vocabulary allows it and the text goes by pieces, else as uint32."""
        plain = text.isascii()
        other = any(map(text.__contains__, _ASCII_OTHER)) if plain else _OTHER.search(text)
        if not self.pieces or other or self.special.search(text):
            return self.whole(text)
        if len(self.cache) > (self.most or CACHE_PIECES):
            self.old, self.cache = self.cache, _Pieces(self._piece)
        found = (_ASCII_PIECE if plain else _PIECE).findall(text)
        raw = b"".join(itemgetter(*found)(self.cache)) if len(found) > 1 else b"".join(self.cache[p] for p in found)
        return np.frombuffer(raw, dtype=self.dtype)


def _encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker, so that its pieces serve every task the worker runs."""
    encoders = worker_state("rans")
    if path not in encoders:
        encoders[path] = PieceEncoder(path)
    return encoders[path]


def _batches_of(pdf: pd.DataFrame, chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Slices of a batch of about ``chars`` characters, so that memory follows text, not rows."""
    groups = (pdf["text"].str.len().cumsum() // chars).to_numpy()
    edges = np.flatnonzero(np.diff(groups)) + 1
    for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(pdf)], strict=True):
        if hi > lo:
            yield pdf.iloc[lo:hi]


TOKENS = "doc_id long, n_tokens long, ids binary, tie long"


def _tokens(docs: DataFrame, tokenizer_path: str, end_id: int, cache_pieces: int | None = None) -> DataFrame:
    """The rows of ``tokenise``, and in rows with ``counts`` the occurrences of every id in a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer_path)
        encoder.most = cache_pieces
        total = np.zeros(1, dtype=np.int64)
        for pdf in batches:
            for part in _batches_of(pdf):
                ids = [_ended(e, end_id) for e in map(encoder.ids, part["text"])]
                c = np.bincount(np.concatenate(ids))
                total = np.pad(total, (0, max(0, len(c) - len(total))))
                total[: len(c)] += c
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].astype("Int64"), "n_tokens": [len(i) for i in ids], "ids": [_pack(i) for i in ids],
                        "tie": [_crc(i) for i in ids], "counts": None,
                    }
                )
        if total.any():
            yield pd.DataFrame({"doc_id": [None], "n_tokens": [None], "ids": [None], "tie": [None], "counts": [total.tobytes()]})

    return docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text")).mapInPandas(lean(run), TOKENS + ", counts binary")


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids, tie): ids packed (``_unpack``), the end id last; ``tie`` is their checksum."""
    return _tokens(docs, tokenizer_path, end_id).filter("counts IS NULL").drop("counts")


def _ended(ids: np.ndarray, end_id: int) -> np.ndarray:
    return np.append(ids, ids.dtype.type(end_id) if end_id <= np.iinfo(ids.dtype).max else np.uint32(end_id))


def _pack(ids: np.ndarray) -> bytes:
    """uint16 where every id fits, marked by an odd last byte."""
    if len(ids) == 0 or ids.dtype == np.uint16 or int(ids.max()) < 1 << 16:
        return ids.astype("<u2").tobytes() + b"\x01"
    return ids.astype("<u4").tobytes() + b"\x02"


def _unpack(raw: bytes) -> np.ndarray:
    kind = "<u2" if raw[-1] == 1 else "<u4"
    return np.frombuffer(raw, dtype=kind, count=(len(raw) - 1) // np.dtype(kind).itemsize).astype(np.uint32)


def frequency_table(tokenised: DataFrame, scale_bits: int = SCALE_BITS) -> DataFrame:
    """(token, frequency): counts of the whole corpus, scaled; at least 1 each, below 2**scale_bits in all.

    Reads (ids), or where ``tokenised`` has them the (counts) of tasks.
    """
    counted = "counts" in tokenised.columns

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1, dtype=np.int64)
        for pdf in batches:
            for raw in pdf.iloc[:, 0]:
                c = np.frombuffer(raw, np.int64) if counted else np.bincount(_unpack(raw))
                if len(c) > len(total):
                    total = np.pad(total, (0, len(c) - len(total)))
                total[: len(c)] += c
        token = np.flatnonzero(total)
        yield pd.DataFrame({"token": token, "n": total[token]})

    rows = tokenised.filter("counts IS NOT NULL").select("counts") if counted else tokenised.select("ids")
    counts = rows.mapInPandas(lean(count), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = sorted((r["token"], r["n"]) for r in counts.collect())  # one row per id of the vocabulary
    tokens = np.array([t for t, _ in rows], dtype=np.int64)
    freq = scale_counts(np.array([n for _, n in rows], dtype=np.int64), scale_bits)
    # as Arrow: a list would go through Python workers of a kind of its own
    return tokenised.sparkSession.createDataFrame(
        pa.table({"token": tokens, "frequency": freq}), "token long, frequency long"
    )


def scale_counts(counts: np.ndarray, scale_bits: int = SCALE_BITS) -> np.ndarray:
    """Scale to a sum of 2**scale_bits - 1 or less, at least 1 each (the spare slot keeps one token below the full range)."""
    if not len(counts):
        return counts
    room = (1 << scale_bits) - 1 - len(counts)
    if room < 0:
        raise ValueError("more tokens than slots; raise scale_bits")
    return 1 + (counts.astype(float) / counts.sum() * room).astype(np.int64)


class Coder:
    """Interleaved rANS over a shared table; ``step`` is what a state grows by for each time the frequency goes into it."""

    def __init__(self, tokens: np.ndarray, freq: np.ndarray, scale_bits: int = SCALE_BITS):
        self.bits = np.uint64(scale_bits)
        size = int(tokens.max()) + 1 if len(tokens) else 1
        self.freq = np.zeros(size, dtype=np.uint64)
        self.freq[tokens] = freq
        self.step = (np.uint64(1) << self.bits) - self.freq
        self.cum = np.zeros(size, dtype=np.uint64)
        self.cum[tokens] = np.cumsum(freq) - freq
        self.slot = np.zeros(1 << scale_bits, dtype=np.intp)
        self.slot[: int(freq.sum())] = np.repeat(tokens, freq)
        self.limit = np.uint64((1 << 32) >> scale_bits << 32)

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(final states, words in reading order, words before each checkpoint, checkpoint states)."""
        n_rows = -(-len(ids) // LANES)
        x = np.full(LANES, LOW, dtype=np.uint64)
        emitted, marks, snaps, total = [], [], [], 0
        at = ids.astype(np.intp, copy=False)  # what take wants
        for row in range(n_rows - 1, -1, -1):
            s = at[row * LANES : (row + 1) * LANES]
            k = len(s)
            f, y = self.freq.take(s), x[:k]
            over = np.flatnonzero(y >= self.limit * f)
            if len(over):
                high = y.take(over)
                emitted.append(high.astype(np.uint32))
                total += len(over)
                y[over] = high >> np.uint64(32)
            # (y // f << bits) + y % f + cum
            q = y // f
            q *= self.step.take(s)
            y += q
            y += self.cum.take(s)
            if row % CHECKPOINT_ROWS == 0 and row:
                marks.append(total)
                snaps.append(x.copy())
        words = np.concatenate(emitted[::-1]) if emitted else np.zeros(0, np.uint32)
        return x, words, np.array([total - m for m in marks[::-1]], dtype=np.int64), (
            np.concatenate(snaps[::-1]) if snaps else np.zeros(0, np.uint64)
        )

    def decode(self, n_tokens: int, states: np.ndarray, words: np.ndarray, at: int = 0, row: int = 0, rows: int | None = None) -> np.ndarray:
        """Ids of ``rows`` rows from ``row`` on, reading words from ``at``, where the lanes had ``states``."""
        n_rows = -(-n_tokens // LANES)
        stop = n_rows if rows is None else min(n_rows, row + rows)
        x = states.astype(np.uint64).copy()
        mask = (np.uint64(1) << self.bits) - np.uint64(1)
        out = np.zeros(max(0, min(stop * LANES, n_tokens) - row * LANES), dtype=np.uint32)
        for r in range(row, stop):
            k = min(LANES, n_tokens - r * LANES)
            y = x[:k]
            low = y & mask
            s = self.slot.take(low.view(np.int64))
            out[(r - row) * LANES : (r - row) * LANES + k] = s
            # freq * (y >> bits) + low - cum
            y >>= self.bits
            y *= self.freq.take(s)
            y += low
            y -= self.cum.take(s)
            under = np.flatnonzero(y < LOW)
            if m := len(under):
                y[under] = (y.take(under) << np.uint64(32)) | words[at : at + m]
                at += m
        return out

    def decode_from_checkpoints(self, n_tokens: int, states, words, word_counts, snaps) -> np.ndarray:
        """The same ids, decoded piece by piece from the checkpoints."""
        starts = [(0, 0, states)] + [
            ((i + 1) * CHECKPOINT_ROWS, int(a), snaps[i * LANES : (i + 1) * LANES]) for i, a in enumerate(word_counts)
        ]
        return np.concatenate([self.decode(n_tokens, s, words, a, r, CHECKPOINT_ROWS) for r, a, s in starts])


BLOCKS = (
    "shard int, block int, n_tokens long, doc_ids array<long>, doc_lens array<long>, states binary, words binary, "
    "word_counts array<long>, checkpoints binary, crc long"
)


def _crc(ids: np.ndarray, crc: int = 0) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"), crc)


def _table_arrays(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = sorted((r["token"], r["frequency"]) for r in table.collect())
    return np.array([t for t, _ in rows], dtype=np.int64), np.array([f for _, f in rows], dtype=np.int64)


def encode(tokenised: DataFrame, table: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of the documents in ascending id; a block ends with the document that fills it."""
    spark = tokenised.sparkSession
    shared = spark.sparkContext.broadcast(_table_arrays(table))  # one entry per id of the vocabulary

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = None
        doc_ids: list[int | None] = []
        docs: list[np.ndarray] = []
        held, block, shard = 0, 0, 0

        def flush() -> pd.DataFrame:
            ids = np.concatenate(docs)
            states, words, counts, snaps = coder.encode(ids)
            return pd.DataFrame(
                {
                    "shard": [shard], "block": [block], "n_tokens": [len(ids)], "doc_ids": [list(doc_ids)],
                    "doc_lens": [[len(d) for d in docs]], "states": [states.tobytes()], "words": [words.tobytes()],
                    "word_counts": [counts.tolist()], "checkpoints": [snaps.tobytes()], "crc": [_crc(ids)],
                }
            )

        worker_state("rans coder")  # the tokenizer is done and goes
        for pdf in batches:
            coder = coder or Coder(*shared.value)
            shard = int(pdf["shard"].iloc[0]) if len(pdf) else shard
            for d, raw in zip(pdf["doc_id"], pdf["ids"], strict=True):
                doc_ids.append(None if pd.isna(d) else int(d))
                docs.append(_unpack(raw))
                held += len(docs[-1])
                if held >= block_tokens:
                    yield flush()
                    doc_ids, docs, held, block = [], [], 0, block + 1
        if docs:
            yield flush()

    return (
        tokenised.repartitionByRange(parallelism(spark), "doc_id", "tie")  # one id may have many rows
        .sortWithinPartitions("doc_id", "tie", "ids")
        .select("doc_id", "ids", F.spark_partition_id().alias("shard"))
        .mapInPandas(lean(run), BLOCKS)
    )


def write(tokenised: DataFrame, path: str, block_tokens: int = BLOCK_TOKENS) -> str:
    """Write the table and the blocks under ``path``."""
    table = frequency_table(tokenised)
    if "counts" in tokenised.columns:
        tokenised = tokenised.filter("counts IS NULL").drop("counts")
    table.coalesce(1).write.parquet(f"{path}/table")
    stored = tokenised.sparkSession.read.parquet(f"{path}/table")
    encode(tokenised, stored, block_tokens).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    return path


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from the files, a checksum error fails the job.

    Shards are ranges of ids, so the ids before a block are those of earlier (shard, block)
    pairs: one row per block, summed in one window.
    """
    shared = spark.sparkContext.broadcast(_table_arrays(spark.read.parquet(f"{path}/table")))
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # two steps keep the window without partition to one row per shard
    in_shard = W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    over = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    heads = blocks.select("shard", "block", "n_tokens")
    shards = heads.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    bases = (
        heads.withColumn("inner", F.coalesce(F.sum("n_tokens").over(in_shard), F.lit(0)))
        .join(shards, "shard")
        .select("shard", "block", (F.col("base") + F.col("inner")).alias("base"))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = None
        worker_state("rans coder")
        for pdf in batches:
            coder = coder or Coder(*shared.value)
            for b in pdf.itertuples(index=False):
                states, words = np.frombuffer(b.states, np.uint64), np.frombuffer(b.words, np.uint32)
                ids = coder.decode_from_checkpoints(b.n_tokens, states, words, b.word_counts, np.frombuffer(b.checkpoints, np.uint64))
                if _crc(ids) != b.crc:
                    raise ValueError(f"checksum of block {b.block} of shard {b.shard} differs")
                lens = np.array(b.doc_lens, dtype=np.int64)
                ends = np.cumsum(lens)
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([None if d is None or d != d else int(d) for d in b.doc_ids], dtype="Int64"),
                        "shard": b.shard, "block": b.block, "inner": ends - lens, "n_tokens": lens,
                        "ids_crc32": [_crc(ids[e - n : e]) for e, n in zip(ends, lens, strict=True)],
                    }
                )

    docs = blocks.mapInPandas(lean(run), "doc_id long, shard int, block int, inner long, n_tokens long, ids_crc32 long")
    return docs.join(bases, ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_documents(docs: DataFrame, tokenizer_path: str, cache_pieces: int | None = None) -> DataFrame:
    """Tokenise, write the files to the scratch folder and read them back.

    ``cache_pieces``: pieces that a worker remembers per generation, if not CACHE_PIECES; fewer take time, not rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    tokenised = scratch.store(_tokens(docs, tokenizer_path, END_ID, cache_pieces), "tokens")
    path = write(tokenised, scratch_path(spark, "rans"))
    scratch.release()
    return read_back(spark, path)
