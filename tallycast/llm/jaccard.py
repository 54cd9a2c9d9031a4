"""Exact Jaccard similarity join in metric space: pivots, Voronoi cells, triangle windows.

1 - Jaccard is a metric over sets of word shingles. Sampled documents are useless as first pivots
here: nearly every pair of documents lies at distance 1. The first pivots are therefore the
one-shingle sets: a document x lies at distance 1 - 1/|x| from the pivots of its own
shingles and at 1 from all others, so its nearest cells are its shingles' cells, ties going
to the rarer shingle first (a count sketch of the whole corpus orders shingles, then their
hash). By the triangle inequality two linked sets differ in at most
(1 - t) / (1 + t) * (|x| + |y|) shingles, so they meet within the first
|x| - ceil(t |x|) + 1 cells of each: those are the windows into which boundary documents are
replicated.

Cells join recursively. One set of each cell becomes its document pivot, and every
member's distance to it is computed exactly: members within the threshold are linked and
settled. A cell that still holds several components falls into regions: one around its largest
component, in pieces of REGION members, and the rest in pieces of REGION. Members of different components
meet wherever their pieces do, never inside the largest component. Two members of a region are
only measured if the metric allows a link: the Hamming distance of their parity bitmaps (a bit
per shingle hash, added modulo 2) is at most the size of their symmetric difference, which
for linked sets has the bound above. Of the pairs of a region the closest that span its components are measured first,
a few times over, so their number follows the components, not the pairs of components; links make the others
needless. Otherwise the next round takes sixteen times as many, rounds after FORESTS as many of each two
components, until none is left. So near copies cost a few comparisons per member, pairs of unlike sets never leave
the task that met them, and no pair that might link is left out. No cell is held in one task.

Documents with equal sets are one node. Null and empty texts have no shingles and are linked
with nothing. Repeated rows are equal sets. Words are hashed by XXH3 with a key, and words, shingles and sets have
64 bits; equality is decided on them. Columns of the caller may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.llm.common import Scratch, connected_components, lean, materialise, text_of
from tallycast.llm.hashing import shingles, word_hashes

SHINGLE = 4
PERCENT = 85  # link when 100 * intersection >= PERCENT * union
SKETCH_BITS = 20
SKETCH_PARTS = 64
SKETCH_STEPS = (4096, 64, 1)  # partial sketches are added in groups of so many, then fewer
SLICES = 4      # pairs fetch their sets in this many steps at most, so that a step's shuffle holds a part of them
SLICE_PAIRS = 50_000  # fewer pairs need no further step
FILTER_BITS = 1 << 26  # wanted texts are found through a bitmap of 8 MB before they are shuffled
BITMAP = 1024   # bits, at least; larger sets have a bit for every one or two shingles
REGION = 2048   # members of a cell that meet in one piece
CLOSEST = 4     # how many times over the closest pairs span the components of a region in the first round
FORESTS = 64    # the most; rounds after that take so many pairs of each two components
BATCH_ROWS = 20_000


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, A-Z lower-cased."""
    s = np.sort(shingles(word_hashes(text.encode("utf-8", "surrogatepass").lower()), size))
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def node_of(hashes: np.ndarray) -> int:
    """The set's identity: 64 bits of a digest, 0 for the empty set."""
    if not len(hashes):
        return 0
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True) or 1


def parity(hashes: np.ndarray) -> bytes:
    """The bitmap of a set: each shingle flips one bit. Exclusive or of its halves gives the smaller bitmap."""
    size = max(BITMAP, 1 << (max(1, len(hashes) // 2) - 1).bit_length())
    return np.packbits(np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1).tobytes()


def _texts(docs: DataFrame) -> DataFrame:
    text = text_of("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))


NODES = "doc_id long, tie long, node long, n_shingles long, bits binary, part int, counts binary"


def nodes(docs: DataFrame, size: int = SHINGLE, bits: int = SKETCH_BITS) -> DataFrame:
    """(doc_id, tie, node, n_shingles, bits) for every row, ``tie`` a hash of the text; and in rows with a
    ``part`` the sketch of each task: shingles counted by their first ``bits`` bits, in SKETCH_PARTS parts."""
    width = (1 << bits) // SKETCH_PARTS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for pdf in batches:
            sets = [shingle_set(t, size) for t in pdf["text"]]
            for s in sets:
                np.add.at(total, (s >> np.uint64(64 - bits)).astype(np.int64), 1)
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"].astype("Int64"), "tie": pdf["tie"],
                    "node": [node_of(s) for s in sets], "n_shingles": [len(s) for s in sets],
                    "bits": [parity(s) for s in sets], "part": None, "counts": None,
                }
            )
        for i in range(SKETCH_PARTS):
            piece = total[i * width : (i + 1) * width]
            if piece.any():
                yield pd.DataFrame(
                    {
                        "doc_id": [None], "tie": [None], "node": [None], "n_shingles": [None], "bits": [None],
                        "part": [i], "counts": [piece.tobytes()],
                    }
                )

    return _texts(docs).mapInPandas(lean(run), NODES)


def heat(sketches: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """A level per hash bucket: 0 for ordinary counts, more for buckets with far more shingles than the mean.

    The sketch counts every document; its size is fixed. Partial sketches (part, counts) are added in steps, so no
    task sees them all.
    """
    width = (1 << bits) // SKETCH_PARTS

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, dtype=np.int64)
        for raw in pdf["counts"]:
            total += np.frombuffer(raw, dtype=np.int64)
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "counts": [total.tobytes()]})

    rows = sketches.select("part", "counts")
    for groups in SKETCH_STEPS:
        dealt = F.pmod(F.monotonically_increasing_id(), F.lit(groups)) if groups > 1 else F.lit(0)
        rows = rows.withColumn("g", dealt).groupBy("part", "g").applyInPandas(lambda pdf: add(pdf), "part int, counts binary")
    total = np.zeros(1 << bits, dtype=np.int64)
    for r in rows.collect():  # SKETCH_PARTS rows of fixed size
        total[r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(r["counts"], dtype=np.int64)
    mean = max(1.0, total.mean())
    z = (total - mean) / (6 * np.sqrt(mean))
    return np.where(z < 1, 0, 1 + np.floor(np.log2(np.maximum(z, 1)))).astype(np.uint8)


def window(n: int, percent: int) -> int:
    """How many of its cells a set of n shingles enters."""
    return n - -(-percent * n // 100) + 1


def cells(docs: DataFrame, levels: np.ndarray, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(cell, node, n, pos): each distinct set in its nearest cells, rarer shingles first."""
    bits = int(np.log2(len(levels)))
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # 2**SKETCH_BITS bytes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for pdf in batches:
            out = []
            for t in pdf["text"]:
                s = shingle_set(t, size)
                node = node_of(s)
                if not len(s) or node in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(node)
                order = np.lexsort((s, shared.value[(s >> np.uint64(64 - bits)).astype(np.int64)]))
                k = window(len(s), percent)
                out.append((s[order[:k]].view(np.int64), node, len(s), k))
            if out:
                ks = [o[3] for o in out]
                yield pd.DataFrame(
                    {
                        "cell": np.concatenate([o[0] for o in out]),
                        "node": np.repeat(np.array([o[1] for o in out], dtype=np.int64), ks),
                        "n": np.repeat(np.array([o[2] for o in out], dtype=np.int32), ks),
                        "pos": np.concatenate([np.arange(k, dtype=np.int32) for k in ks]),
                    }
                )

    return _texts(docs).select("text").mapInPandas(lean(run), "cell long, node long, n int, pos int")


def need(n1: Column, n2: Column, percent: int) -> Column:
    """The least intersection with which sets of these sizes link."""
    return F.ceil(percent * (n1 + n2) / F.lit(100 + percent))


def _plausible(a: str, b: str, percent: int) -> Column:
    """Size and place allow a link: the larger set is not too large, and enough shingles follow in both."""
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    rest = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    return (100 * small >= percent * large) & (rest >= need(F.col(f"{a}.n"), F.col(f"{b}.n"), percent))


def members(cell_rows: DataFrame) -> DataFrame:
    """(cell, k, m, p): the rows of cells with two sets or more, beside the cell's size and first pivot."""
    rows = cell_rows.select("cell", F.struct("node", "n", "pos").alias("m"))
    pivots = rows.groupBy("cell").agg(
        F.min("m").alias("p"), F.max("m").alias("q"), F.count(F.lit(1)).alias("k")
    ).filter("p.node <> q.node")
    return rows.join(pivots.drop("q"), "cell").distinct()


def _probed(texts: DataFrame, one: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose (doc_id, tie) sets a bit that a (d, z) of ``one`` sets too.

    A bitmap of FILTER_BITS, so its broadcast has a fixed size; with more than that many wanted rows it
    lets most through. The join that follows is exact.
    """
    def place(*key: str) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(FILTER_BITS)) + 1

    held = one.select(place("d", "z").alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("held")
    )
    probe = texts.withColumn("at", place("doc_id", "tie")).withColumn("bucket", F.bitmap_bucket_number("at"))
    probe = probe.withColumn("at", F.bitmap_bit_position("at").cast("int"))
    byte = F.conv(F.hex(F.substring("held", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return probe.join(F.broadcast(held), "bucket").filter(F.getbit(byte, F.col("at") % 8) == 1).select(*texts.columns)


def sets_of(docs: DataFrame, known: DataFrame, wanted: DataFrame, scratch: Scratch, size: int = SHINGLE) -> DataFrame:
    """(node, hashes) of the wanted nodes, from one document each, found by its id and text hash."""
    one = scratch.replace(
        known.join(wanted, "node", "left_semi")
        .groupBy("node")
        .agg(F.min(F.struct("doc_id", "tie")).alias("one"))
        .select(F.col("one.doc_id").alias("d"), F.col("one.tie").alias("z"), "node"),
        "one",
    )
    met = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("z"))
    texts = _probed(_texts(docs), one).join(one, met).select("node", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(t, size) for t in pdf["text"]]
            yield pd.DataFrame({"node": pdf["node"], "hashes": [s.tobytes() for s in sets]})

    # repeated rows have the same id and text
    return texts.dropDuplicates(["node"]).mapInPandas(lean(run), "node long, hashes binary")


def differs(n1: np.ndarray, n2: np.ndarray, percent: int) -> np.ndarray:
    """The most shingles in which linked sets of these sizes differ."""
    return n1 + n2 - 2 * -(-percent * (n1 + n2) // (100 + percent))


def hamming(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)


def _bitmaps(raw, size: int = BITMAP // 8) -> np.ndarray:
    """Bitmaps of that many bytes, a row each; larger ones are folded."""
    if all(len(r) == size for r in raw):
        return np.frombuffer(b"".join(raw), dtype=np.uint64).reshape(len(raw), size // 8)
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(r, dtype=np.uint64).reshape(-1, size // 8), axis=0) for r in raw])


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hamming distance of pairs of bitmaps (object arrays of bytes), at the smaller size of the two."""
    size = np.minimum(np.array([len(r) for r in x], np.int64), np.array([len(r) for r in y], np.int64))
    out = np.zeros(len(x), np.int64)
    for n in np.unique(size).tolist():
        some = np.flatnonzero(size == n)
        out[some] = hamming(_bitmaps(x[some], n), _bitmaps(y[some], n))
    return out


def allowed(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs whose bitmaps allow a link; ``bits`` has (node, n, bits)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n1, n2 = pdf["n1"].to_numpy(np.int64), pdf["n2"].to_numpy(np.int64)
            near = apart(pdf["x"].to_numpy(), pdf["y"].to_numpy()) <= differs(n1, n2, percent)
            yield pdf.loc[near, ["a", "b"]]

    x = bits.select(F.col("node").alias("a"), F.col("bits").alias("x"), F.col("n").alias("n1"))
    y = bits.select(F.col("node").alias("b"), F.col("bits").alias("y"), F.col("n").alias("n2"))
    met = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", "n1", "n2")
    return met.mapInPandas(lean(run), "a long, b long")


def measure(pairs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, inter, total) of (a, b) pairs: intersection and union size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            inter, total = [], []
            for x, y in zip(pdf["x"], pdf["y"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                inter.append(same)
                total.append(len(both) - same)
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "inter": inter, "total": total})

    x = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    out, slices = None, max(1, min(SLICES, -(-pairs.count() // SLICE_PAIRS)))
    for i in range(slices):
        mine = F.pmod(F.xxhash64("a"), F.lit(slices)) == i
        met = pairs.filter(mine).join(y, "b").join(x.filter(mine), "a").select("a", "b", "x", "y")
        part = scratch.store(met.mapInPandas(lean(run), "a long, b long, inter long, total long"), "measured")
        out = part if out is None else out.unionByName(part)
    return out


def _pairs(rows: DataFrame, left: str, right: str, percent: int) -> DataFrame:
    return (
        rows.filter(f"{left}.node <> {right}.node")
        .filter(_plausible(left, right, percent))
        .select(F.least(f"{left}.node", f"{right}.node").alias("a"), F.greatest(f"{left}.node", f"{right}.node").alias("b"))
        .distinct()
    )


def link(docs: DataFrame, known: DataFrame, levels: np.ndarray, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(node, root) of the components of linked nodes.

    Round 0 measures every member against its cell's pivot. Later rounds measure pairs of different
    components in the cells that hold several; they end when no region left a pair out.
    """
    scratch = Scratch(docs.sparkSession)
    # members reads them twice
    rows = scratch.store(members(scratch.store(cells(docs, levels, size, percent), "all-cells")), "cells")
    scratch.drop("all-cells")
    bits = scratch.store(
        known.filter("node <> 0").groupBy("node").agg(F.first("bits").alias("bits"), F.first("n_shingles").cast("int").alias("n")), "bits"
    )
    linked = 100 * F.col("inter") >= percent * F.col("total")
    wanted, measured, parts, closest, left = _pairs(rows, "m", "p", percent), None, None, CLOSEST, True
    while True:
        # regions have compared the bitmaps of their pairs
        pairs = scratch.replace(allowed(wanted, bits, percent) if measured is None else wanted, "pairs")
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = scratch.replace(sets_of(docs, known, ends, scratch, size), "sets")
        now = measure(pairs, sets, scratch)
        measured = now.select("a", "b") if measured is None else measured.unionByName(now.select("a", "b"))
        fresh = now.filter(linked).select("a", "b")
        # what was connected before is as well connected by its roots
        edges = fresh if parts is None else fresh.unionByName(parts.select(F.col("node").alias("a"), F.col("root").alias("b")))
        parts = scratch.replace(connected_components(edges, "parts-of", scratch), "parts")
        if not left:
            break
        rows = scratch.replace(_unsettled(rows, parts), "cells")
        found = scratch.replace(_meet(rows, bits, closest, percent), "met")
        left = not found.filter("more").isEmpty()
        wanted = found.filter("NOT more").select("a", "b").distinct().join(measured, ["a", "b"], "left_anti")
        closest *= 16
        if not left and wanted.isEmpty():
            break
    roots = materialise(parts, "roots")
    scratch.release()
    return roots


def _unsettled(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows, with their components, of cells that hold several components, once for cells with the same members."""
    roots = parts.select(F.col("node").alias("x"), F.col("root").alias("y"))
    rows = (
        rows.drop("r").join(roots, F.col("m.node") == F.col("x"), "left")
        .select("cell", "k", "m", "p", F.coalesce("y", "m.node").alias("r"))
    )
    node = F.col("m.node")
    several = rows.groupBy("cell").agg(
        F.min("r").alias("lo"), F.max("r").alias("hi"), F.sum("m.pos").alias("places"),
        F.struct(F.count(F.lit(1)), F.min(node), F.max(node), F.bit_xor(F.xxhash64(node)), F.bit_xor(F.xxhash64(node, F.lit(1)))).alias("held"),
    ).filter("lo <> hi")
    # of cells with the same members the first in the order of shingles has their pairs at the least places
    first = several.groupBy("held").agg(F.min(F.struct("places", "cell")).alias("first")).select("first.cell")
    return rows.join(first, "cell", "left_semi")


def _meet(rows: DataFrame, bits: DataFrame, closest: int, percent: int) -> DataFrame:
    """(a, b, more): pairs of different components that may link, the closest of each region.

    They span its components ``closest`` times over; above FORESTS, they are so many of each two components. A row with ``more`` says that a region has further ones.
    """
    sizes = rows.groupBy("cell", "r").agg(F.count(F.lit(1)).alias("c"))
    big = sizes.groupBy("cell").agg(F.max(F.struct("c", "r")).alias("big"), F.sum("c").alias("all"))
    big = big.select(
        "cell", F.col("big.r").alias("big"), F.ceil(F.col("big.c") / REGION).cast("int").alias("nl"),
        F.ceil((F.col("all") - F.col("big.c")) / REGION).cast("int").alias("nr"),
    )
    own = F.col("r") == F.col("big")
    piece = F.pmod(F.xxhash64("m.node"), F.when(own, F.col("nl")).otherwise(F.col("nr"))).cast("int")
    # every piece of the largest component meets every piece of the rest; those also meet each other
    among = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("nr") - 1), lambda j: j != F.col("i")),
        lambda j: F.struct(F.lit(1).alias("kind"), F.least(j, F.col("i")).alias("u"), F.greatest(j, F.col("i")).alias("v")),
    )
    with_big = F.transform(F.sequence(F.lit(0), F.col("nl") - 1), lambda j: F.struct(F.lit(0).alias("kind"), j.alias("u"), F.col("i").alias("v")))
    with_rest = F.transform(F.sequence(F.lit(0), F.col("nr") - 1), lambda j: F.struct(F.lit(0).alias("kind"), F.col("i").alias("u"), j.alias("v")))
    dealt = rows.join(big, "cell").withColumn("i", piece).withColumn("own", own)
    dealt = dealt.withColumn("at", F.explode(F.when(F.col("own"), with_rest).otherwise(F.concat(with_big, among))))
    region = F.xxhash64("cell", "at.kind", "at.u", "at.v")
    dealt = dealt.select(region.alias("region"), F.col("m.node").alias("node"), F.col("m.pos").alias("pos"), "r")
    dealt = dealt.join(bits, "node").select("region", "node", "n", "pos", "r", "bits")
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) < BATCH_ROWS:
                continue
            whole = pd.concat(held, ignore_index=True)
            last = whole["region"] == whole["region"].iloc[-1]  # may go on; a region has at most a few REGION rows
            if not last.all():
                yield _region_pairs(whole[~last], closest, percent)
            held = [whole[last]]
        if held:
            yield _region_pairs(pd.concat(held, ignore_index=True), closest, percent)

    return dealt.repartition(n, "region").sortWithinPartitions("region").mapInPandas(lean(walk), "a long, b long, more boolean")


def _region_pairs(rows: pd.DataFrame, closest: int, percent: int) -> pd.DataFrame:
    """The pairs of ``_meet`` among whole regions, in numpy; rows are sorted by region."""
    region, node, n, pos, r = (rows[c].to_numpy(np.int64) for c in ("region", "node", "n", "pos", "r"))
    whole = rows["bits"].to_numpy()
    bits = _bitmaps(whole) if len(whole) else np.zeros((0, BITMAP // 64), np.uint64)
    large_set = np.array([len(r) > BITMAP // 8 for r in whole], bool)
    edges = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1], [True]]))
    of_region = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    found, more = [np.zeros((5, 0), np.int64)], False
    pick = _forests if closest <= FORESTS else _nearest
    for d in range(1, int(np.diff(edges).max(initial=0))):  # members d places apart in their region
        x = np.flatnonzero(region[:-d] == region[d:])
        y = x + d
        small, large = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
        need = -(-percent * (n[x] + n[y]) // (100 + percent))
        rest = np.minimum(n[x] - pos[x], n[y] - pos[y])
        ok = (r[x] != r[y]) & (node[x] != node[y]) & (100 * small >= percent * large) & (rest >= need)
        x, y = x[ok], y[ok]
        far = hamming(bits[x], bits[y])
        ok = far <= differs(n[x], n[y], percent)
        x, y, far = x[ok], y[ok], far[ok]
        both = np.flatnonzero(large_set[x] & large_set[y])
        far[both] = apart(whole[x[both]], whole[y[both]])
        ok = far <= differs(n[x], n[y], percent)
        x, y, far = x[ok], y[ok], far[ok]
        found.append(np.stack([of_region[x], np.minimum(r[x], r[y]), np.maximum(r[x], r[y]), far, x * len(rows) + y]))
        if sum(f.shape[1] for f in found) > 4 * BATCH_ROWS:
            met = np.concatenate(found, axis=1)
            found = [pick(met, closest)]
            more |= found[0].shape[1] < met.shape[1]
    met = np.concatenate(found, axis=1)
    kept = pick(met, closest)
    more |= kept.shape[1] < met.shape[1]
    x, y = kept[4] // max(1, len(rows)), kept[4] % max(1, len(rows))
    out = pd.DataFrame({"a": np.minimum(node[x], node[y]), "b": np.maximum(node[x], node[y]), "more": False})
    return pd.concat([out, pd.DataFrame({"a": [0], "b": [0], "more": [True]})]) if more else out


def _nearest(found: np.ndarray, most: int) -> np.ndarray:
    """Of (region, component, component, distance, pair) columns the first ``most`` by distance of each two components."""
    found = found[:, np.lexsort(found[::-1])]
    same = (found[:3, 1:] == found[:3, :-1]).all(axis=0)
    start = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]) if found.shape[1] else np.zeros(0, bool), np.arange(found.shape[1]), 0))
    return found[:, np.arange(found.shape[1]) - start < most]


def _forests(found: np.ndarray, most: int) -> np.ndarray:
    """Of (region, component, component, distance, pair) columns those of the first ``most`` spanning forests, by distance.

    The components of each region are the nodes; a forest takes its closest pairs among those that earlier ones left.
    """
    found = found[:, np.lexsort((found[4], found[3]))]
    n = found.shape[1]
    ends, at = np.unique(np.concatenate([found[[0, 1]], found[[0, 2]]], axis=1), axis=1, return_inverse=True)
    u, v = at.reshape(-1)[:n], at.reshape(-1)[n:]
    kept, rest = np.zeros(n, bool), np.arange(n)
    for _ in range(most):
        if not len(rest):
            break
        tree = _spanning(u[rest], v[rest], ends.shape[1])
        kept[rest[tree]] = True
        rest = rest[~tree]
    return found[:, kept]


def _spanning(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Which of the edges (u, v) make the least spanning forest of n nodes; edges come in ascending weight."""
    root, tree, live = np.arange(n), np.zeros(len(u), bool), np.arange(len(u))
    while True:
        live = live[root[u[live]] != root[v[live]]]
        if not len(live):
            return tree
        least = np.full(n, len(u))  # of each tree so far, its first edge to another
        np.minimum.at(least, root[u[live]], live)
        np.minimum.at(least, root[v[live]], live)
        own = np.flatnonzero(least < len(u))
        edge = least[own]
        tree[edge] = True
        up = np.arange(n)
        up[own] = np.where(root[u[edge]] == own, root[v[edge]], root[u[edge]])
        both = own[(up[up[own]] == own) & (own < up[own])]  # two that chose the same edge
        up[both] = both
        while (up[up] != up).any():
            up = up[up]
        root = up[root]


def components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, tie, node, part) for every row; ``part`` names the component by a node."""
    stored = materialise(nodes(docs, size), "nodes")
    known = stored.filter("part IS NULL").drop("part", "counts")
    roots = link(docs, known, heat(stored.filter("part IS NOT NULL")), size, percent)
    joined = known.join(roots, "node", "left").withColumn("part", F.coalesce("root", "node"))
    least = joined.filter("node <> 0").groupBy("part").agg(F.min("doc_id").alias("least"))
    return joined.join(least, "part", "left").select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"),
        F.when(F.col("node") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), "tie", "node", "part",
    )


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` per component of ``found``, the one with the smallest id, then text hash; texts without words all stay.

    The caller's row travels as one struct, so its column names may be any.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = found.select(key.alias("k"), "tie", "node", "part")
    best = rows.filter("node <> 0").groupBy("part").agg(F.min(F.struct("k", "tie")).alias("b")).select(
        "b.k", "b.tie", F.lit(False).alias("whole")
    )
    kept = best.union(rows.filter("node = 0").select("k", "tie", F.lit(True)).distinct())
    nth = F.row_number().over(W.partitionBy("k", "tie").orderBy(F.lit(0)))
    held = docs.select(
        key.alias("k"), F.xxhash64(text_of("text")).alias("tie"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    )
    return held.join(kept, ["k", "tie"]).withColumn("nth", nth).filter("whole OR nth = 1").select("row.*")
