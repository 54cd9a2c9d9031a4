"""Near-duplicate passages by compact windows.

A document is its sequence of SHINGLE-word shingle hashes. Under a hash function, the
Cartesian tree of the sequence has one compact window (l, c, r) per node: all subsequences
inside [l, r] that contain c have the min-hash of c. Only windows of WIDTH shingles or more
matter; their centres are the minima of the WIDTH-long subsequences, found by a sliding
minimum, and a stack over them (``compact_windows``) gives l and r.

Compact windows meet in a join on (function, min-hash), for FUNCTIONS functions:

1. windows whose WIDTH-long subsequences around the centre are equal as a whole are one
   class (by hash), combined in each batch before the shuffle;
2. centres whose surroundings differ get them fetched from the texts, and whole groups are
   solved in numpy: for every place of the centre, equal WIDTH-long subsequences are classed
   by hash, which finds every exact repeat. Each class is compared by its first window with those of all
   other classes of the place, whatever their frames share elsewhere, and near ones (Jaccard of PERCENT
   or more) unite. Near windows have one of their rarest shingles in common, so only windows that share
   one are looked at.
   Groups over HOT_RUNS surroundings do not fit a task and are solved by the same rules in joins:
   classes by an aggregation over window hashes, united ones as connected components, and
   every PIECE frames meet every other PIECE in a task. HOT_RUNS decides where a group is
   solved, not what is found.

The result has one row per document, first document of a class and maximal passage that also
occurs in another document: doc_id, start_word, end_word (words, end exclusive), first_doc_id
(the smallest id of its class) and exact, whether a part of it is repeated exactly. Passages
of different classes may overlap. A near passage is found with the probability that one of
the functions agrees (1 - (1 - J)**FUNCTIONS for Jaccard J) at every group size; exact ones are always found.

Null and empty texts, and texts under SHINGLE + WIDTH - 1 words, have no passages. Repeats
inside one document alone are not reported. Rows that share an id are documents of their own, shown under
that id; rows without an id too, with numbers from NO_ID on in the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.llm.common import connected_components, materialise, text_of
from tallycast.llm.hashing import mix, shingles, word_hashes
from tallycast.llm.jaccard import _probed
from tallycast.operators.rank import with_position

SHINGLE = 5
WIDTH = 46          # shingles; with SHINGLE words that is 50 words
PERCENT = 80
FUNCTIONS = 4
FRAME = 2 * WIDTH - 1
HOT_RUNS = 20_000
PIECE = 16_000      # frames of a group over HOT_RUNS that meet as many others in a task
CHUNK_SHINGLES = 1 << 15  # of short texts, whose runs are found together
LONG_LIST = 32      # windows that share a rare shingle, over which matrices compare what is not linked yet
BLOCK_ROWS = 512
SEEN_BITS = 1 << 26  # a bitmap of 8 MB of the shingles that several frames of a group over HOT_RUNS hold
NO_ID = 1 << 62
BATCH_FRAMES = 8_000
SEEDS = tuple((0x9E3779B97F4A7C15 * (i + 1)) & (2**64 - 1) for i in range(FUNCTIONS))
WANTED = ("value", "run", "last", "lo", "off", "span")
FOUND = "doc long, lo long, hi long, first long, exact boolean"
FRAMES = "value long, run long, doc long, last long, at long, lo long, hi long, frame binary"
CLASSES = "value long, run long, doc long, lo long, begin long, end long, first long, exact boolean"


def sequence(text: str) -> np.ndarray:
    """Shingle hashes of a text, empty with fewer than SHINGLE words."""
    words = word_hashes(text.encode("utf-8", "surrogatepass").lower())
    return shingles(words, SHINGLE) if len(words) >= SHINGLE else words[:0]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        x = np.minimum(x[: len(x) - k], x[k:])
        k *= 2
    rest = width - k
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _centres(s: np.ndarray, function: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash per place, centre of every WIDTH-long subsequence); ties go to the later place."""
    h = mix(s ^ np.uint64(SEEDS[function]))
    low = np.uint64((1 << 32) - 1)
    key = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
    return h, (low - (_sliding_min(key, WIDTH) & low)).astype(np.int64)


def compact_windows(s: np.ndarray, function: int = 0) -> list[tuple[int, int, int]]:
    """(l, c, r) of every Cartesian tree node that spans WIDTH places or more.

    The nearest smaller places on both sides of such a node span WIDTH or more themselves,
    so a stack over the sliding minima suffices.
    """
    if len(s) < WIDTH:
        return []
    h, picked = _centres(s, function)
    centres = picked[np.concatenate([[True], picked[1:] != picked[:-1]])].tolist()
    rank = [(int(h[c] >> np.uint64(32)), -c) for c in centres]
    left, right, stack = [0] * len(centres), [len(s) - 1] * len(centres), []
    for i, c in enumerate(centres):
        while stack and rank[stack[-1]] > rank[i]:
            right[stack.pop()] = c - 1
        left[i] = centres[stack[-1]] + 1 if stack else 0
        stack.append(i)
    return list(zip(left, centres, right, strict=True))


def _runs(s: np.ndarray, function: int, starts: np.ndarray | None = None, sums: tuple | None = None) -> tuple[np.ndarray, ...]:
    """(min-hash, centre, first and last WIDTH-long subsequence it is the minimum of, hash of their shingles).

    These are the starts that a compact window's centre owns: within [l, r], those not
    further than WIDTH - 1 before c. ``s`` may be several documents in a row, with their WIDTH-long subsequences' ``starts``.
    """
    if len(s) < WIDTH or (starts is not None and not len(starts)):
        e = np.zeros(0, np.int64)
        return e.astype(np.uint64), e, e, e, e.astype(np.uint64)
    h, picked = _centres(s, function)
    starts = np.arange(len(picked)) if starts is None else starts
    picked = picked[starts]
    # the starts that share a centre are consecutive
    first = np.concatenate([[0], np.flatnonzero(picked[1:] != picked[:-1]) + 1])
    a, b = starts[first], starts[np.append(first[1:], len(picked)) - 1]
    c = picked[first]
    value = (h[c] & ~np.uint64(7)) | np.uint64(function)
    return value, c, a, b, _run_hash(_sums(s) if sums is None else sums, a, c, b)


def _runs_of(texts: pd.Series) -> Iterator[tuple[np.ndarray, ...]]:
    """(number of the text, then as ``_runs`` within the text) under every function, some texts at a time."""
    held, numbers, size = [], [], 0

    def runs() -> Iterator[tuple[np.ndarray, ...]]:
        s, lens = np.concatenate(held), np.array([len(x) for x in held])
        at = np.cumsum(lens) - lens  # where each text begins
        n = np.maximum(0, lens - WIDTH + 1)
        starts = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())
        sums = _sums(s)
        for f in range(FUNCTIONS):
            value, c, a, b, run = _runs(s, f, starts, sums)
            x = np.searchsorted(at, a, side="right") - 1
            yield np.array(numbers, np.int64)[x], value, c - at[x], a - at[x], b - at[x], run

    for i, t in enumerate(texts):
        s = sequence(t)
        if len(s) < WIDTH:
            continue
        held.append(s)
        numbers.append(i)
        size += len(s)
        if size >= CHUNK_SHINGLES:
            yield from runs()
            held, numbers, size = [], [], 0
    if held:
        yield from runs()


def _run_hash(sums: tuple[np.ndarray, np.ndarray], a: np.ndarray, c: np.ndarray, b: np.ndarray) -> np.ndarray:
    shape = ((c - a) * WIDTH + (b - a)).astype(np.uint64)
    return mix(_window(sums, a, b + WIDTH) + shape * np.uint64(0xBF58476D1CE4E5B9))


_BASE = 0xD6E8FEB86659FD93
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n or more of the base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) <= n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(max(n, CHUNK_SHINGLES) + 1, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def _sums(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _powers_of(len(s))
    sums = np.zeros(len(s) + 1, dtype=np.uint64)
    np.cumsum(s * power[: len(s)], out=sums[1:])
    return sums, inverse


def _window(sums: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (sums[0][b] - sums[0][a]) * sums[1][a]


def located(docs: DataFrame) -> DataFrame:
    """(value, run, doc, top, lo, off, span, others): one row per different run and batch, at its earliest place;
    ``others`` packs the (doc, lo) of the batch's other copies, ``top`` is their largest doc."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = list(_runs_of(pdf["text"]))
            if not parts:
                continue
            x, v, c, a, b, run = (np.concatenate(p) for p in zip(*parts, strict=True))
            doc = pdf["doc"].to_numpy(np.int64)[x]
            order = np.lexsort((a, doc, run, v))
            v, c, a, b, run, doc = v[order], c[order], a[order], b[order], run[order], doc[order]
            first = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (run[1:] != run[:-1])]))
            end = np.append(first[1:], len(v))
            place = np.stack([doc, a], axis=1)
            yield pd.DataFrame(
                {
                    "value": v[first].view(np.int64), "run": run[first].view(np.int64), "doc": doc[first],
                    "top": doc[end - 1], "lo": a[first], "off": (c - a)[first].astype(np.int16),
                    "span": (b - a)[first].astype(np.int16),
                    "others": [place[i + 1 : e].tobytes() if e - i > 1 else None for i, e in zip(first, end, strict=True)],
                }
            )

    return docs.select("doc", "text").mapInPandas(
        find, "value long, run long, doc long, top long, lo long, off short, span short, others binary"
    )


def classed(rows: DataFrame) -> DataFrame:
    """Runs that occur twice or share their min-hash with others, with their class's smallest and largest document."""
    of_value, of_run = W.partitionBy("value"), W.partitionBy("value", "run")
    r = (
        rows.repartition("value")  # for all windows
        .withColumn("nth", F.row_number().over(of_run.orderBy("doc", "lo")))
        .withColumn("first", F.min("doc").over(of_run))
        .withColumn("last", F.max("top").over(of_run))
        .withColumn("differ", F.sum((F.col("nth") == 1).cast("int")).over(of_value))
        .withColumn("docs_differ", F.min("doc").over(of_value) != F.max("top").over(of_value))
    )
    return r.filter("docs_differ AND (first <> last OR differ > 1)").select(
        "value", "run", "doc", "lo", "off", "span", "nth", "first", "last", "differ", "others"
    )


def _places(rows: DataFrame) -> DataFrame:
    """Every copy's place (FOUND) of the starts ``begin`` to ``end`` of a run."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            packed = [np.frombuffer(o, np.int64).reshape(-1, 2) if o else np.zeros((0, 2), np.int64) for o in pdf["others"]]
            n = [len(x) for x in packed]
            place = np.concatenate([*packed, pdf[["doc", "lo"]].to_numpy()])
            begin, end, first, exact = (np.concatenate([np.repeat(pdf[c], n), pdf[c]]) for c in ("begin", "end", "first", "exact"))
            yield pd.DataFrame({"doc": place[:, 0], "lo": place[:, 1] + begin, "hi": place[:, 1] + end, "first": first, "exact": exact})

    return rows.select("doc", "lo", "begin", "end", "first", "exact", "others").mapInPandas(unpack, FOUND)


def _whole(rows: DataFrame) -> DataFrame:
    """Repeats from runs that are copies as a whole and alone in their group."""
    alone = rows.filter("first <> last AND differ = 1")
    return _places(alone.withColumns({"begin": F.lit(0).cast("long"), "end": F.col("span").cast("long"), "exact": F.lit(True)}))


def _carried(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """What was found for the first place of a run, at its other places."""
    copies = rows.filter("nth > 1 OR others IS NOT NULL").select("value", "run", "doc", "lo", "others")
    return _places(copies.join(classes.select("value", "run", "begin", "end", "first", "exact"), ["value", "run"]))


def _texts(docs: DataFrame) -> DataFrame:
    """(doc, id, text): ``doc`` numbers the rows in the order of their ids, ``id`` is what the result shows.

    Where ids are unique they are the numbers; rows without an id are numbered from NO_ID on.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("id"), text_of("text").alias("text"))
    known = base.filter("id IS NOT NULL")
    if known.groupBy("id").count().filter("count > 1").isEmpty():
        known = known.select(F.col("id").alias("doc"), "id", "text")
        nameless = base.filter("id IS NULL")
        if nameless.isEmpty():
            return known
        numbered = nameless.select((F.lit(NO_ID) + F.monotonically_increasing_id()).alias("doc"), "text")
        return known.union(materialise(numbered, "no-id").select("doc", F.col("doc").alias("id"), "text"))
    placed = with_position(base, [F.col("id").asc_nulls_last(), F.col("text").asc()])
    number = F.col("position").cast("long")
    return materialise(placed.select(number.alias("doc"), F.coalesce("id", F.lit(NO_ID) + number).alias("id"), "text"), "numbered")


def frames(docs: DataFrame, rows: DataFrame, hot: bool) -> DataFrame:
    """(value, run, doc, last, at, lo, hi, frame): FRAME shingles (32 bits) around the centres whose runs differ."""
    chosen = F.col("differ") > HOT_RUNS if hot else F.col("differ") <= HOT_RUNS
    wanted = rows.filter((F.col("nth") == 1) & (F.col("differ") > 1) & chosen).groupBy("doc").agg(
        *[F.collect_list(c).alias(c) for c in WANTED]
    )

    def pack(parts: list[tuple]) -> pd.DataFrame:
        *columns, frame = (np.concatenate(x) for x in zip(*parts, strict=True))
        rows = dict(zip(("value", "run", "doc", "last", "at", "lo", "hi"), columns, strict=True))
        return pd.DataFrame(rows | {"frame": [x.tobytes() for x in frame]})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, count = [], 0  # of several documents
        for pdf in batches:
            for doc, text, *held in zip(pdf["doc"], pdf["text"], *(pdf[c] for c in WANTED), strict=True):
                s = (sequence(text) >> np.uint64(32)).astype(np.uint32)
                value, run, last, lo, off, span = (np.asarray(x, np.int64) for x in held)
                padded = np.concatenate([np.zeros(WIDTH, np.uint32), s, np.zeros(WIDTH, np.uint32)])
                for i in range(0, len(lo), 10_000):
                    some = slice(i, i + 10_000)
                    at = (lo + off)[some]
                    frame = padded[at[:, None] + np.arange(1, FRAME + 1)[None, :]]
                    parts.append((value[some], run[some], np.full(len(at), doc), last[some], at, lo[some], (lo + span)[some], frame))
                    count += len(at)
                    if count >= 5_000:
                        yield pack(parts)
                        parts, count = [], 0
        if parts:
            yield pack(parts)

    if hot:  # few documents: the other texts are not shuffled
        keyed = docs.select(F.col("doc").alias("doc_id"), F.lit(0).alias("tie"), "text")
        some = _probed(keyed, wanted.select(F.col("doc").alias("d"), F.lit(0).alias("z")))
        docs = some.select(F.col("doc_id").alias("doc"), "text")
    return docs.join(wanted, "doc").select("doc", "text", *WANTED).mapInPandas(cut, FRAMES)


def _first_of(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, index of the first row with equal keys, by place in that order); stable."""
    by = np.lexsort(keys)
    new = np.ones(len(by), dtype=bool)
    new[1:] = False
    for k in keys:
        k = k[by]
        new[1:] |= k[1:] != k[:-1]
    return by, np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))


def _owned(at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which places f of a centre its frame owns."""
    f, start0 = np.arange(WIDTH), at - (WIDTH - 1)
    return (f >= (lo - start0)[:, None]) & (f <= (hi - start0)[:, None])


def _bodies(frame: np.ndarray) -> np.ndarray:
    """A hash of the WIDTH shingles from every place f of the frames."""
    power = _powers_of(FRAME)
    sums = np.zeros((len(frame), FRAME + 1), dtype=np.uint64)
    np.cumsum((frame.astype(np.uint64) + np.uint64(1)) * power[0][:FRAME][None, :], axis=1, out=sums[:, 1:])
    return (sums[:, WIDTH : 2 * WIDTH] - sums[:, :WIDTH]) * power[1][:WIDTH]


def solve(group: np.ndarray, value: np.ndarray, run: np.ndarray, doc: np.ndarray, last: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, frame: np.ndarray):
    """Repeats among the frames of whole groups (CLASSES), with numpy.

    ``frame``: uint32 rows of FRAME shingles around centres at WIDTH - 1; ``doc`` and ``last``
    are the smallest and largest document of the run. Every place f of the centre has classes
    of equal WIDTH-long subsequences; near pairs unite the classes of their two frames at f.
    """
    rank = np.lexsort((at, doc, group))
    group, value, run, doc, last, at, lo, hi, frame = (x[rank] for x in (group, value, run, doc, last, at, lo, hi, frame))
    m = len(doc)
    start0, f = at - (WIDTH - 1), np.arange(WIDTH)
    own = _owned(at, lo, hi)
    label = np.tile(np.arange(m)[:, None], (1, WIDTH))  # the first row of the exact class
    body = _bodies(frame)
    for k in range(WIDTH):
        ok = np.flatnonzero(own[:, k])
        if len(ok) > 1:
            by, first = _first_of([body[ok, k], group[ok]])
            label[ok[by], k] = ok[by[first]]
    node = (label * WIDTH + f)[own]
    a, b = _near_edges(group, frame, own, label)
    root = _roots(a, b, m * WIDTH)[node]

    def spans(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(smallest document, whether there is another) of every owned place's class."""
        least, most = np.full(m * WIDTH, np.iinfo(np.int64).max), np.full(m * WIDTH, np.iinfo(np.int64).min)
        np.minimum.at(least, node, np.broadcast_to(doc[:, None], own.shape)[own])
        np.maximum.at(most, node, np.broadcast_to(last[:, None], own.shape)[own])
        return least[node], least[node] != most[node]

    first, many, exact = np.zeros(own.shape, np.int64), np.zeros(own.shape, bool), np.zeros(own.shape, bool)
    first[own], many[own] = spans(root)
    exact[own] = spans(node)[1]
    # neighbouring places of one class and kind become one row
    same = np.zeros((m, WIDTH + 1), bool)
    same[:, 1:-1] = many[:, 1:] & many[:, :-1] & (first[:, 1:] == first[:, :-1]) & (exact[:, 1:] == exact[:, :-1])
    x, begin = np.nonzero(many & ~same[:, :-1])
    end = np.nonzero(many & ~same[:, 1:])[1]
    shift = (start0 - lo)[x]
    return pd.DataFrame(
        {
            "value": value[x], "run": run[x], "doc": doc[x], "lo": lo[x], "begin": begin + shift, "end": end + shift,
            "first": first[x, begin], "exact": exact[x, begin],
        }
    )


def _near_edges(group, frame, own, label) -> tuple[np.ndarray, np.ndarray]:
    """Classes (label * WIDTH + f) of pairs of frames of a group that are near at f; each class is compared by its first frame."""
    m = len(group)
    number = np.arange(m)
    first = own & (label == number[:, None])
    x, y, k = _near_pairs(group, np.zeros(m, np.int64), number, number, number, frame, first)
    return x * WIDTH + k, y * WIDTH + k


def _near_pairs(group, side, part, doc, last, frame, own) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, f): frames of a group that are near at a place f of both, or linked there by such pairs.

    Rows are sorted by group; those with a ``side`` other than 0 are only compared with the other side. Neither ``part`` nor the
    documents leave a pair out. Exact: one of the windows of equal sets stands for them; windows that hold too many shingles of no
    other frame of the group are near to none; of the others, near ones have one of their rarest shingles in common.
    """
    group = np.cumsum(np.concatenate([[False], group[1:] != group[:-1]])) if len(group) else group
    out = [np.zeros((3, 0), np.int64)]
    rows = np.flatnonzero(own.any(axis=1))
    own, before = own[rows], None
    while len(rows):
        ranks, frames_with, earlier, size = _ranked(group[rows], frame[rows], own)
        if before is None:
            out += _equal_sets(rows, group[rows], frame[rows], own, earlier)
        before = own.sum()
        least = np.full(group[-1] + 1, WIDTH)  # different shingles in a window of the group
        np.minimum.at(least, group[rows], np.where(own, size, WIDTH).min(axis=1))
        alone = (ranks >= 0) & (frames_with[ranks] < 2)
        need = _fewest_shared(size, least[group[rows]][:, None])
        own &= size - _count(alone, earlier) >= need
        stay = own.any(axis=1)
        if own.sum() > 0.9 * before:
            break
        rows, own = rows[stay], own[stay]
    for f in range(WIDTH if len(rows) else 0):
        a = np.flatnonzero(own[:, f])
        if len(a) < 2:
            continue
        windows = np.where(earlier[a, f : f + WIDTH] < f, ranks[a, f : f + WIDTH], len(frames_with))
        windows.sort(axis=1)
        for x, y in _near_windows(windows, size[a, f], size[a, f] - need[a, f] + 1, side[rows[a]], frames_with):
            out.append(np.stack([rows[a[x]], rows[a[y]], np.full(len(x), f)]))
    x, y, k = np.concatenate(out, axis=1)
    return x, y, k


def _fewest_shared(size: np.ndarray, least: np.ndarray) -> np.ndarray:
    """How many shingles a window of ``size`` different ones shares at least with a near one of ``least`` or more."""
    size = size.astype(np.int64)
    other = np.maximum(least, -(-PERCENT * size // 100))
    return -(-PERCENT * (size + other) // (100 + PERCENT))


def _ranked(group, frame, own) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rank of the shingle at every place of the frames, frames that hold a rank's shingle, place before with the same shingle,
    different shingles in the window at every f), from the windows that ``own`` names; shingles of a group are ranked by frames."""
    held = _covered(own)
    r, c = (x.astype(np.int32) for x in np.nonzero(held))
    key = group[r].astype(np.uint64) << np.uint64(32) | frame[r, c]
    by = np.argsort(key, kind="stable")
    key, r, c = key[by], r[by], c[by]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    shingle = np.cumsum(new) - 1
    again = np.flatnonzero(~new[1:] & (r[1:] == r[:-1])) + 1
    earlier = np.full((len(frame), FRAME), -1, np.int8)
    earlier[r[again], c[again]] = c[again - 1]
    count = np.bincount(shingle) - np.bincount(shingle[again], minlength=new.sum())
    order = np.argsort(count, kind="stable")
    rank = np.empty(len(count), np.int32)
    rank[order] = np.arange(len(count))
    ranks = np.full((len(frame), FRAME), -1, np.int32)
    ranks[r, c] = rank[shingle]
    return ranks, count[order], earlier, _count(held, earlier)


def _covered(own: np.ndarray) -> np.ndarray:
    """Which places of the frames are in a window that ``own`` names."""
    out = np.zeros((len(own), FRAME), bool)
    for k in range(WIDTH):
        out[:, k : k + WIDTH] |= own[:, k, None]
    return out


def _count(chosen: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """The number of different shingles among the chosen places of the window at every f."""
    sums = np.zeros((len(chosen), FRAME + 1), np.int16)
    np.cumsum(chosen, axis=1, out=sums[:, 1:])
    out = sums[:, WIDTH : 2 * WIDTH] - sums[:, :WIDTH]
    some = np.flatnonzero((earlier >= 0).any(axis=1))
    chosen, earlier = chosen[some], earlier[some]
    for f in range(WIDTH if len(some) else 0):
        out[some, f] = (chosen[:, f : f + WIDTH] & (earlier[:, f : f + WIDTH] < f)).sum(axis=1)
    return out


def _equal_sets(rows, group, frame, own, earlier) -> Iterator[np.ndarray]:
    """(x, y, f) of windows that hold the same shingles, where shingles repeat inside; y is taken out of ``own``."""
    some = np.flatnonzero((earlier >= 0).any(axis=1))
    h = mix(frame[some].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    for f in range(WIDTH):
        i = np.flatnonzero(own[some, f])
        if len(i) < 2:
            continue
        at = some[i]
        total = np.where(earlier[at, f : f + WIDTH] < f, h[i, f : f + WIDTH], np.uint64(0)).sum(axis=1)
        by, first = _first_of([total, group[at]])
        x, y = at[by[first]], at[by]
        x, y = x[x != y], y[x != y]
        own[y, f] = False
        yield np.stack([rows[x], rows[y], np.full(len(x), f)])


def _near_windows(windows, size, prefix, side, frames_with) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y) of near windows, sorted ranks each, or linked by such pairs; those of a place have a rank of their first ``prefix`` in common.

    Windows that share such a rank are a list. All pairs of short lists are compared, then what is not linked yet of long ones.
    """
    some = np.arange(prefix.max()) < prefix[:, None]
    key = windows[:, : some.shape[1]]
    some &= key < len(frames_with)
    some[some] = frames_with[key[some]] > 1
    row, c = np.nonzero(some)
    key = key[row, c]
    by = np.argsort(key, kind="stable")
    key, row = key[by], row[by]
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, int)
    length = np.diff(edges)
    after = np.repeat(edges[1:], length) - np.arange(len(key))  # rows of the list from a row on
    after[np.repeat(length > LONG_LIST, length)] = 0
    n, pairs, at = len(windows), [np.zeros(0, np.int64)], np.arange(len(key))
    for d in range(1, LONG_LIST):
        at = at[after[at] > d]
        if not len(at):
            break
        pairs.append(row[at] * n + row[at + d])
    pairs = np.unique(np.concatenate(pairs))
    x, y = pairs // n, pairs % n
    ok = (side[x] == 0) | (side[x] != side[y])
    x, y = x[ok], y[ok]
    near = np.zeros(len(x), bool)
    for i in range(0, len(x), 20_000):
        p, q = x[i : i + 20_000], y[i : i + 20_000]
        near[i : i + 20_000] = (100 + PERCENT) * _in_both(windows[p], windows[q], len(frames_with)) >= PERCENT * (size[p].astype(np.int64) + size[q])
    x, y = x[near], y[near]
    yield x, y
    if not (length > LONG_LIST).any():
        return
    linked = _roots(x, y, n)
    for i in np.argsort(length, kind="stable")[np.searchsorted(np.sort(length), LONG_LIST, side="right") :]:
        members = row[edges[i] : edges[i + 1]]
        # those of the commonest shingles may be near to most others, so they go first
        members = members[np.argsort(-windows[members, 0], kind="stable")]
        yield from _near_blocks(members[:BLOCK_ROWS], members, windows, size, side, len(frames_with), linked)
        most = np.bincount(linked[members]).argmax()
        out = linked[members] != most
        members = np.concatenate([members[out], members[~out]])
        yield from _near_blocks(members[: out.sum()], members, windows, size, side, len(frames_with), linked)


def _in_both(x: np.ndarray, y: np.ndarray, none: int) -> np.ndarray:
    """Per row the number of ranks in both; ``none`` is no rank."""
    both = np.concatenate([x, y], axis=1)
    both.sort(axis=1)
    return ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] < none)).sum(axis=1)


def _earlier(frame: np.ndarray) -> np.ndarray:
    """The place before with the same shingle for every place of the frames, or -1."""
    key = np.sort(frame.astype(np.uint64) << np.uint64(8) | np.arange(FRAME, dtype=np.uint64), axis=1)
    place = (key & np.uint64(255)).astype(np.int16)
    r, c = np.nonzero(key[:, 1:] >> np.uint64(8) == key[:, :-1] >> np.uint64(8))
    earlier = np.full(frame.shape, -1, np.int16)
    earlier[r, place[r, c + 1]] = place[r, c]
    return earlier


def _distinct(frame: np.ndarray) -> np.ndarray:
    """The number of different shingles in the window at every place f of the frames."""
    return _count(np.ones(frame.shape, bool), _earlier(frame))


def _near_distinct(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """As ``_near_sets``, at places f whose windows hold no shingle twice."""
    return _near_sets(x, y, 2 * WIDTH)


def _near_sets(x: np.ndarray, y: np.ndarray, sizes: np.ndarray | int | None = None) -> np.ndarray:
    """Per pair of frames and place f: Jaccard of PERCENT or more; ``sizes`` adds up the different shingles of both windows."""
    sizes = _distinct(x) + _distinct(y) if sizes is None else sizes
    n, width = len(x), WIDTH + 1
    pos = np.arange(FRAME, dtype=np.uint64) * np.uint64(2)
    low = np.uint64(8)
    s = np.sort(np.concatenate([x.astype(np.uint64) << low | pos, y.astype(np.uint64) << low | (pos + np.uint64(1))], axis=1), axis=1)
    # neighbours of one shingle and of both frames: a window holds it twice over if it holds such neighbours
    r, at = np.nonzero((s[:, 1:] >> low == s[:, :-1] >> low) & ((s[:, 1:] ^ s[:, :-1]) & np.uint64(1)).astype(bool))
    value = s[r, at] >> low
    i, j = ((s[r, c] & np.uint64(255)).astype(np.int64) // 2 for c in (at, at + 1))
    # counted at the first neighbours a window holds, so not where it holds those before as well
    begin = np.maximum(0, j - WIDTH + 1)
    if len(r):
        again = (r[1:] == r[:-1]) & (value[1:] == value[:-1])
        begin[1:] = np.maximum(begin[1:], np.where(again, i[:-1] + 1, 0))
    end = np.minimum(i, WIDTH - 1) + 1
    ok = begin < end
    step = np.bincount(r[ok] * width + begin[ok], minlength=n * width) - np.bincount(r[ok] * width + end[ok], minlength=n * width)
    inter = np.cumsum(step.reshape(n, width), axis=1)[:, :WIDTH]
    return 100 * inter >= PERCENT * (sizes - inter)


def _near_blocks(p, q, windows, size, side, none, linked) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y) of near windows of ``p`` and ``q``, by products of matrices, that are not linked yet; ``linked`` is kept up to date."""
    for s in range(0, len(p), BLOCK_ROWS):
        for t in range(0, len(q), BLOCK_ROWS):
            a, b = p[s : s + BLOCK_ROWS], q[t : t + BLOCK_ROWS]
            ok = (linked[a][:, None] != linked[b]) & ((side[a] == 0)[:, None] | (side[a][:, None] != side[b]))
            i, j = ok.any(axis=1), ok.any(axis=0)
            if not i.any():
                continue
            a, b, ok = a[i], b[j], ok[i][:, j]
            values = np.intersect1d(windows[a], windows[b])
            values = values[values < none]
            of_a, of_b = (np.where(np.isin(w, values), np.searchsorted(values, w), len(values)) for w in (windows[a], windows[b]))
            inter = _held(of_a, len(values)) @ _held(of_b, len(values)).T
            near = (100 + PERCENT) * inter >= PERCENT * (size[a].astype(np.int64)[:, None] + size[b])
            x, y = _spanning(near & ok)
            if len(x):
                x, y = a[x], b[y]
                linked[:] = _roots(linked[x], linked[y], len(linked))[linked]
                yield x, y


def _held(of: np.ndarray, n: int) -> np.ndarray:
    """A row of 0 and 1 for each row of numbers below ``n``; ``n`` itself stands for none."""
    out = np.zeros((len(of), n + 1), np.float32)
    out[np.arange(len(of))[:, None], of] = 1
    return out[:, :n]


def _spanning(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some (row, column) of a matrix's true places that connect its rows and columns as all of them do."""
    r, c = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    near = near[r][:, c]
    if not near.size:
        return r, c
    n = len(r)
    p, q = np.concatenate([np.arange(n), near.argmax(axis=0)]), np.concatenate([near.argmax(axis=1), np.arange(len(c))])
    root = _roots(p, n + q, n + len(c))
    x, y = np.nonzero(near & (root[:n][:, None] != root[n:]))
    return r[np.concatenate([p, x])], c[np.concatenate([q, y])]


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node of every node's component."""
    root = np.arange(n)
    while True:
        p, q = root[a], root[b]
        if (p == q).all():
            return root
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (root[root] != root).any():
            root = root[root]


def _by_group(rows: DataFrame, key: str, run: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``run`` over whole groups of a key, many small ones or one large one at a time."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = [], 0
        for pdf in batches:
            while len(pdf):
                room, pdf = pdf.iloc[: max(1, BATCH_FRAMES - count)], pdf.iloc[max(1, BATCH_FRAMES - count) :]
                held.append(room)
                count += len(room)
                if count < BATCH_FRAMES:
                    break
                rows = pd.concat(held)
                last = rows[key] == rows[key].iloc[-1]
                if not last.all():
                    yield run(rows[~last])
                held = [rows[last]]
                count = len(held[0]) % BATCH_FRAMES if last.all() else len(held[0])
        if held:
            yield run(pd.concat(held))

    return rows.repartition(n, key).sortWithinPartitions(key).mapInPandas(walk, schema)


def _frames_of(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["frame"]), dtype=np.uint32).reshape(len(rows), FRAME)


def _partial(framed: DataFrame) -> DataFrame:
    """The classes (CLASSES) of groups that fit a task."""
    columns = ("value", "value", "run", "doc", "last", "at", "lo", "hi")
    return _by_group(framed, "value", lambda rows: solve(*(rows[c].to_numpy() for c in columns), _frames_of(rows)), CLASSES)


def _nodes(value: np.ndarray, frame: np.ndarray) -> np.ndarray:
    """The class of every place f of a frame: its group, f and the shingles from there on, as a hash."""
    key = mix(value.astype(np.int64).view(np.uint64))[:, None] + np.arange(WIDTH, dtype=np.uint64)
    return mix(_bodies(frame) ^ mix(key)).view(np.int64)


def _alike(value: np.ndarray, frame: np.ndarray) -> np.ndarray:
    """Of every place f of a frame: its group, f and the set of shingles from there on, as a hash."""
    h = mix(frame.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    earlier = _earlier(frame)
    total = np.stack([np.where(earlier[:, f : f + WIDTH] < f, h[:, f : f + WIDTH], np.uint64(0)).sum(axis=1) for f in range(WIDTH)], axis=1)
    key = mix(value.astype(np.int64).view(np.uint64))[:, None] + np.arange(WIDTH, dtype=np.uint64)
    return mix(mix(total) ^ mix(key)).view(np.int64)


def _places_of(places: np.ndarray) -> np.ndarray:
    return (places[:, None] >> np.arange(WIDTH) & 1).astype(bool)


def _hot(framed: DataFrame) -> DataFrame:
    """The classes of groups too large for a task, by the rules of ``solve``; ``framed`` is stored."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = _owned(*(pdf[c].to_numpy() for c in ("at", "lo", "hi")))
            x, k = np.nonzero(own)
            held = {c: pdf[c].to_numpy()[x] for c in ("value", "run", "doc", "last", "at", "lo")}
            begin = k + held["at"] - (WIDTH - 1) - held["lo"]
            value, frame = pdf["value"].to_numpy(), _frames_of(pdf)
            yield pd.DataFrame({"node": _nodes(value, frame)[x, k], "alike": _alike(value, frame)[x, k], **held, "begin": begin, "place": k})

    windows = materialise(
        framed.mapInPandas(
            spread, "node long, alike long, value long, run long, doc long, last long, at long, lo long, begin long, place int"
        ).withColumn("x", F.xxhash64("value", "run")),
        "hot-windows",
    )
    classes = windows.groupBy("node").agg(
        F.min("doc").alias("least"), F.max("last").alias("most"), F.min(F.struct("doc", "at", "x")).alias("label"),
        F.first("alike").alias("alike"), F.first("place").alias("place"),
    )
    classes = materialise(classes.select("node", "least", "most", F.col("label.x").alias("x"), "alike", "place"), "hot-classes")
    # one of the classes of equal sets stands for them, by its first frame
    one = classes.groupBy("alike").agg(F.min(F.struct("node", "x", "place")).alias("one"))
    equal = classes.join(one, "alike").filter("node <> one.node").select(F.col("one.node").alias("a"), F.col("node").alias("b"))
    firsts = one.groupBy(F.col("one.x").alias("x")).agg(F.bit_or(F.expr("shiftleft(1L, one.place)")).alias("places"))
    reps = framed.withColumn("x", F.xxhash64("value", "run")).join(firsts, "x").drop("x")
    near = _hot_near(_hot_shared(materialise(reps, "hot-reps"))).union(equal)
    roots = materialise(connected_components(near, "hot-near"), "hot-roots")
    united = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    spans = united.groupBy("root").agg(F.min("least").alias("first"), F.max("most").alias("end")).filter("first <> end")
    found = united.join(spans, "root").select("node", "first", (F.col("least") != F.col("most")).alias("exact"))
    return windows.join(found, "node").select(
        "value", "run", "doc", "lo", "begin", F.col("begin").alias("end"), "first", "exact"
    )


def _hot_shared(reps: DataFrame) -> DataFrame:
    """The frames less the places whose windows hold too many shingles of no other frame of their group to be near to one.

    Shingles of two frames or more are known by a bitmap of SEEN_BITS, which takes some others for such.
    """

    def bits_of(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        frame, own = _frames_of(pdf), _places_of(pdf["places"].to_numpy())
        h = mix(mix(pdf["value"].to_numpy().astype(np.int64).view(np.uint64))[:, None] ^ frame.astype(np.uint64))
        return (h % np.uint64(SEEN_BITS)).astype(np.int64), frame, own, _covered(own)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bit, _, _, held = bits_of(pdf)
            row = np.broadcast_to(np.arange(len(pdf))[:, None], held.shape)
            yield pd.DataFrame({"bit": np.unique(row[held] * SEEN_BITS + bit[held]) % SEEN_BITS})

    seen = reps.mapInPandas(spread, "bit int").groupBy("bit").count().filter("count > 1")
    seen = seen.groupBy(F.expr("bit div 32768").alias("bucket")).agg(F.bitmap_construct_agg((F.col("bit") % 32768).cast("long")).alias("bits"))
    known = np.zeros((SEEN_BITS // 32768, 4096), np.uint8)
    for r in seen.collect():
        known[r.bucket] = np.frombuffer(r.bits, np.uint8)
    known = reps.sparkSession.sparkContext.broadcast(known.reshape(-1))

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bit, frame, own, held = bits_of(pdf)
            alone = held & (known.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 0)
            earlier = _earlier(frame)
            size = _count(held, earlier)
            own &= size - _count(alone, earlier) >= _fewest_shared(size, np.zeros(1, np.int64))
            places = (own.astype(np.int64) << np.arange(WIDTH)).sum(axis=1)
            yield pdf.assign(places=places)[places != 0]

    return reps.mapInPandas(thin, reps.schema)


def _hot_near(reps: DataFrame) -> DataFrame:
    """(a, b): near classes. Each piece of a group's frames that stand for classes meets itself and every other."""
    pieces = reps.groupBy("value").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    own = F.pmod(F.xxhash64("run", "doc"), F.col("pieces")).cast("int")
    dealt = reps.join(pieces, "value").withColumn("own", own).withColumn("other", other)
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    cell = F.xxhash64("value", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.select(cell.alias("cell"), side.alias("side"), "value", "places", "frame")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        cell, side, value, places = (rows[c].to_numpy() for c in rows.columns[:-1])
        frame, number = _frames_of(rows), np.arange(len(rows))
        x, y, k = _near_pairs(cell, side, number, number, number, frame, _places_of(places))
        node = _nodes(value, frame)
        return pd.DataFrame({"a": node[x, k], "b": node[y, k]})

    return _by_group(dealt, "cell", run, "a long, b long")


def passages(docs: DataFrame) -> DataFrame:
    """(doc_id, start_word, end_word, first_doc_id, exact): maximal repeated passages."""
    texts = _texts(docs)
    rows = materialise(classed(located(texts)), "compact-windows")
    classes = _partial(frames(texts, rows, hot=False))
    if not rows.filter(F.col("differ") > HOT_RUNS).isEmpty():
        classes = classes.union(_hot(materialise(frames(texts, rows, hot=True), "hot")))
    classes = materialise(classes, "classes")
    own = classes.select("doc", (F.col("lo") + F.col("begin")).alias("lo"), (F.col("lo") + F.col("end")).alias("hi"), "first", "exact")
    found = _whole(rows).union(own).union(_carried(rows, classes))
    # unite overlapping starts of a document into maximal passages, those of one class only: a place may link to several
    before = W.partitionBy("doc", "first").orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("doc", "first").orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, 0)
    spans = (
        found.groupBy("doc", "first", "lo", "hi").agg(F.max("exact").alias("exact"))
        .withColumn("opens", (F.coalesce(F.max("hi").over(before), F.lit(-WIDTH - 2)) + WIDTH < F.col("lo")).cast("int"))
        .withColumn("passage", F.sum("opens").over(upto))
        .groupBy("doc", "first", "passage")
        .agg(
            F.min("lo").alias("start_word"), (F.max("hi") + WIDTH + SHINGLE - 1).alias("end_word"),
            F.max("exact").alias("exact"),
        )
    )
    ids = texts.select(F.col("doc").alias("n"), "id")
    spans = spans.join(ids, F.col("doc") == F.col("n")).select("first", F.col("id").alias("doc_id"), "start_word", "end_word", "exact")
    return spans.join(ids, F.col("first") == F.col("n")).select(
        "doc_id", "start_word", "end_word", F.col("id").alias("first_doc_id"), "exact"
    )
