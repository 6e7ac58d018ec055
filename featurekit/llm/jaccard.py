"""N-gram Jaccard join by parity sketches, and the groups of linked documents.

Sets: distinct 4-word shingles, as 64-bit hashes.  Two sets link when 100 |A & B| >= 85 |A | B|, so their
symmetric difference is at most D = 6/37 of the larger size (3/37 of the sum of both).

* Sketch: every shingle flips one bit of a virtual bit sketch; bits that two shingles flip cancel out.
  The Hamming distance of two sketches is at most the symmetric difference.  The sketch is cut into
  blocks, kept as the XOR of a random word per set bit (equal blocks give equal words).
* Size bands: a set takes part in the band of its size, and in the next one as a smaller partner.  All sets
  of a band use the same number of blocks, D + 1 plus a slack of S >= 1, so a linked pair agrees on S + 1
  blocks at least.  Blocks without a set bit say nothing and are left out; a set with more than S such
  blocks also joins on its prefix (the first n - ceil(0.85 n) + 1 shingles in hash order), and as both sets
  of a pair that agrees on empty blocks only have more than S of them, no linked pair is lost.
* Links: copies (equal sets) are one node from the start.  Nodes that share fewer blocks with all others than
  any link needs are dropped.  The rest are each compared with two centers (of each block, the node that shares
  most is a center; of a node's centers, that of most of its blocks and that which shares most), not with each
  other; the links found merge them.
  Only blocks that still hold different groups are looked at further: shingles found in no other open node, and
  the distances to a common center, rule out most pairs; what is left is compared across groups.
  Comparisons count exact intersections of the shingle sets, so no link between groups is lost and none is
  false; pairs inside a group are never listed.

Texts of the nodes compared are read again by the smallest ``doc_id`` of each node.  Memory per task is a
batch of texts.  NULL and empty texts have no set, no links and are their own group.  A document without
``doc_id`` belongs to the group of its copies, which is NULL if none of them has an id.  Repeated rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featurekit.llm.common import durable, maybe_broadcast, table

SHINGLE = 4
PERCENT = 85
BAND_RATIO = 1.38
#: Bits of a block of the sketch.
BLOCK_BITS = 1 << 16
#: Texts whose sets a task holds at a time.
TEXTS = 500
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x + _MIX
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word: polynomial over its bytes, all words of a text at once."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size)
    chars = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    place = np.arange(len(chars), dtype=np.int64) - np.repeat(ends - size, size)
    terms = _mix(chars + (place.astype(np.uint64) << np.uint64(9)))      # a random word per (byte, place)
    return _mix(np.add.reduceat(terms, ends - size) + size.astype(np.uint64) * _MIX)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (lower-case A-Z, words between white space)."""
    words = (text or "").encode().translate(_LOWER).split()      # bytes.split() knows x20 and x09-x0D only
    if not words:
        return np.empty(0, np.uint64)
    h = _word_hashes(words)
    k = min(SHINGLE, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = _mix(out * np.uint64(3) + h[i:len(h) - k + 1 + i])
    return np.unique(_mix(out + np.uint64(k)))


def set_hash(s: np.ndarray) -> int:
    return int(_mix(np.array([np.add.reduce(_mix(s)) + np.uint64(len(s))], np.uint64)).view(np.int64)[0]) if len(s) else 0


def _band(n: int) -> int:
    return int(np.floor(np.log(n) / np.log(BAND_RATIO) + 1e-9))


def _largest(band: int) -> int:
    """The largest size of a band."""
    n = int(BAND_RATIO ** (band + 1)) + 2
    while _band(n) > band:
        n -= 1
    return n


def _smallest(band: int) -> int:
    n = max(1, int(BAND_RATIO ** band) - 2)
    while _band(n) < band:
        n += 1
    return n


def _layout(band: int) -> tuple[int, int]:
    """Blocks of a band, and the slack."""
    most = (100 - PERCENT) * 2 * _largest(band) // (100 + PERCENT)       # symmetric difference of a linked pair
    slack = 0 if most == 0 else 1 + most // 10
    return most + 1 + slack, slack


def sketch_keys(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The join keys of a set, and with each the blocks it must share at least to link with anyone.

    Keys are its blocks' words in its own band and, as a smaller partner, in the next.  A linked pair agrees
    on all blocks but as many as its symmetric difference, which the sizes bound, so a set shares at least
    ``blocks - difference - empty blocks`` used blocks.  That number is returned doubled, plus 1 for the next band.
    """
    n, keys, needs = len(s), [], []
    own = _band(n)
    for band in (own, own + 1):
        if band > own and 100 * n < PERCENT * _smallest(band):
            continue
        blocks, slack = _layout(band)
        bit = _mix(s + np.uint64(band)) % np.uint64(blocks * BLOCK_BITS)
        block = (bit // np.uint64(BLOCK_BITS)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        block, zobrist = block[order], _mix(bit[order] ^ _MIX)
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        word, block = np.bitwise_xor.reduceat(zobrist, first), block[first]
        used = word != 0
        word, block = word[used], block[used]
        partner = min(100 * n // PERCENT, _largest(band))                # the largest set it can link with
        need = blocks - (100 - PERCENT) * (n + partner) // (100 + PERCENT) - (blocks - len(word))
        found = _mix(word + _mix((block + (band << 32)).astype(np.uint64)))
        if blocks - len(word) > slack:
            prefix = np.sort(_mix(s))[:n - (PERCENT * n + 99) // 100 + 1]
            found, need = np.concatenate([found, _mix(prefix + np.uint64(band + 1000))]), 1
        keys.append(found)
        needs.append(np.full(len(found), 2 * max(need, 1) + (band > own), np.int32))
    return np.concatenate(keys), np.concatenate(needs)


def _map(df: DataFrame, fn, schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of TEXTS rows at most, so that a task holds the sets of few texts at a time."""
    for b in batches:
        for i in range(0, b.num_rows, TEXTS):
            yield b.slice(i, TEXTS)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _slices(batches):
        sets = [shingle_set(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                                          pa.array([set_hash(s) for s in sets], pa.int64()), b.column(2)], ["id", "n", "h", "x"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = lambda *cols: pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], ["k", "h", "q"])
    seen: set[int] = set()         # copies in the same task give their keys once; forgetting them is harmless
    for b in _slices(batches):
        keys, nodes, needs, rows = [], [], [], 0
        for t in b.column(0).to_pylist():
            s = shingle_set(t)
            if not len(s) or (h := set_hash(s)) in seen:
                continue
            seen = seen if len(seen) < 100_000 else set()
            seen.add(h)
            k, need = sketch_keys(s)
            keys.append(k.view(np.int64))
            nodes.append(np.full(len(k), h, np.int64))
            needs.append(need)
            rows += len(k)
            if rows > 200_000:
                yield pack(keys, nodes, needs)
                keys, nodes, needs, rows = [], [], [], 0
        if rows:
            yield pack(keys, nodes, needs)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _slices(batches):
        h, sets = b.column(0), [shingle_set(t) for t in b.column(1).to_pylist()]
        own = pa.array([set_hash(s) == k for s, k in zip(sets, h.to_pylist(), strict=True)], pa.bool_())   # not another text under that id
        yield pa.RecordBatch.from_arrays([h, pa.array([s.tobytes() for s in sets], pa.binary())], ["h", "set"]).filter(own)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, set of a, set of b) -> a, b, the size of the symmetric difference, and whether they link."""
    for batch in _slices(batches):
        x, y, apart, linked = batch.column(2), batch.column(3), [], []
        for i in range(batch.num_rows):
            p, q = np.frombuffer(x[i].as_py(), np.uint64), np.frombuffer(y[i].as_py(), np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            apart.append(len(p) + len(q) - 2 * both)
            linked.append(100 * both >= PERCENT * (len(p) + len(q) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(apart, pa.int64()), pa.array(linked, pa.bool_())],
                                         ["a", "b", "apart", "linked"])


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) by exact comparison: ``apart`` and ``linked``."""
    with_b = pairs.join(sets.select(F.col("h").alias("b"), F.col("set").alias("sb")), "b")
    both = with_b.join(sets.select(F.col("h").alias("a"), F.col("set").alias("sa")), "a")
    return _map(both.select("a", "b", "sa", "sb"), _verify, "a long, b long, apart long, linked boolean")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the least node of each connected component, by alternating star operations.

    Every round points nodes at smaller neighbours (large star, then small star) until nothing changes; the
    edges are cut from their lineage each round.  Only nodes with an edge are returned.
    """
    e = durable(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct())
    before = None
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: each larger neighbour points at the least one
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        # small star: a node and its smaller neighbours point at the least of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v")).where("u < v").distinct()
        e = durable(small)
        now = tuple(e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())
        if now == before:
            break
        before = now
    return e.groupBy("v").agg(F.min("u").alias("label")).select(F.col("v").alias("node"), "label")


def _relabel(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    return nodes.join(labels, nodes["h"] == labels["node"], "left").select(
        *[nodes[c] for c in nodes.columns], F.coalesce("label", "h").alias("label"))


def _enough(shared: DataFrame) -> DataFrame:
    """The rows of nodes that share enough blocks of a band."""
    count = shared.groupBy("h", (F.col("q") % 2).alias("next")).agg(F.count("*").alias("c"), F.max("q").alias("q"))
    enough = count.where(F.col("c") >= F.floor(F.col("q") / 2)).select("h", "next")
    return shared.join(enough, (shared["h"] == enough["h"]) & (shared["q"] % 2 == enough["next"]), "left_semi")


def link_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``__id, __n`` (set size), ``__component`` (least id reachable by links); ``__text`` and ``__set``
    (hashes of the text and its set) and ``__group`` (the same for linked documents, with ids or without; NULL for empty sets)."""
    rows = durable(_map(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("t"), F.xxhash64("text").alias("x")), _summaries,
                        "id long, n long, h long, x long"))
    node = durable(rows.where("n > 0").groupBy("h").agg(F.min("id").alias("id"), F.max("n").alias("n")))
    # 1. blocks that two nodes or more share, of nodes that share as many as a link needs
    over = Window.partitionBy("k")
    keys = _map(docs.select("text"), _keys, "k long, h long, q int")
    keys = keys.repartition(F.col("k")).groupBy("k", "h").agg(F.max("q").alias("q"))
    shared = _enough(durable(keys.withColumn("g", F.count("*").over(over)).where("g > 1").select("k", "h", "q")))
    shared = _enough(durable(shared.join(shared.groupBy("k").agg(F.count("*").alias("g")).where("g > 1"), "k")))
    shared = durable(shared)
    central = shared.groupBy("h").agg(F.sum("g").alias("c"))
    members = durable(central.join(node.withColumnRenamed("id", "doc"), "h").select("h", "c", "n", "doc"))
    # 2. their sets, from the texts of one document each
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").alias("t"))
    wanted = members.select("h", "doc").where(F.col("doc").isNotNull())
    held = texts.join(maybe_broadcast(wanted, 32), "doc")
    sets = durable(_map(held.select("h", "t"), _sets, "h long, set binary").where(F.octet_length("set") > 0))
    # 3. every node against the center of each of its blocks
    best = shared.join(members.select("h", "c"), "h").groupBy("k").agg(F.max(F.struct("c", "h")).alias("m"))
    most = (shared.join(best.select("k", "m"), "k").where(F.col("h") != F.col("m.h"))
            .groupBy("h", "m").agg(F.count("*").alias("blocks"))
            .groupBy("h").agg(F.max(F.struct("blocks", F.col("m.h"))).alias("near"), F.max("m").alias("hub")))
    star = durable(most.select("h", F.col("near.h").alias("near"), F.col("hub.h").alias("hub")))
    pairs = star.select(F.col("near").alias("a"), F.col("h").alias("b")).union(star.select("hub", "h")).distinct()
    seen = durable(_compared(pairs, sets))
    found = seen.where("linked").select("a", "b")
    centers = (seen.join(star.select(F.col("h").alias("b"), F.col("hub").alias("a")), ["a", "b"])
               .groupBy("b").agg(F.max("a").alias("center"), F.max("apart").alias("apart")).withColumnRenamed("b", "h"))
    labelled = durable(_relabel(members, components(found)))
    # 4. blocks that still hold different groups, without the nodes and pairs that can't link
    spread = shared.join(labelled.select("h", "label"), "h")
    mixed = spread.groupBy("k").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("k")
    still = durable(spread.join(mixed, "k", "left_semi").select("k", "h", "q", "label"))
    opened = durable(still.select("h").distinct())
    around = opened.union(opened.join(centers, "h").select("center")).distinct()
    own = (_map(sets.join(around, "h", "left_semi"), _explode_sets, "h long, x long")
           .groupBy("x").agg(F.min("h").alias("h"), F.count("*").alias("c")).where("c = 1").groupBy("h").agg(F.count("*").alias("own")))
    facts = durable(opened.join(members.select("h", "n"), "h").join(own, "h", "left").join(centers, "h", "left")
                    .select("h", "n", F.coalesce("own", F.lit(0)).alias("own"), "center", "apart"))
    able = still.join(facts.where(100 * (F.col("n") - F.col("own")) >= PERCENT * F.col("n")), "h")
    # A link needs so many common blocks that the most frequent ones, but for the last needed, can be left out.
    able = able.join(able.groupBy("k").agg(F.count("*").alias("g")).where("g > 1"), "k")
    rank = F.row_number().over(Window.partitionBy("h", F.col("q") % 2).orderBy(F.col("g").desc(), "k"))
    able = durable(able.withColumn("rank", rank).where(F.col("rank") >= F.floor(F.col("q") / 2)).drop("rank", "g"))
    x, y = able.alias("x"), able.alias("y")
    both = F.least(F.col("x.n") - F.col("x.own"), F.col("y.n") - F.col("y.own"))          # the most they can have in common
    limit = F.floor((100 - PERCENT) * (F.col("x.n") + F.col("y.n")) / (100 + PERCENT))    # the most they may be apart
    # Of one center c: |x ^ y| = |x ^ c| + |y ^ c| - 2 |(x ^ c) & (y ^ c)|, and own shingles are in one of the differences only.
    shared_apart = F.least(F.col("x.apart") - F.col("x.own"), F.col("y.apart") - F.col("y.own"))
    near = F.coalesce((F.col("x.center") != F.col("y.center")) | (F.col("x.apart") + F.col("y.apart") - 2 * shared_apart <= limit), F.lit(True))
    known = F.coalesce(F.col("x.center") == F.col("y.h"), F.lit(False)) | F.coalesce(F.col("y.center") == F.col("x.h"), F.lit(False))
    pairs = (x.join(y, (F.col("x.k") == F.col("y.k")) & (F.col("x.label") < F.col("y.label"))
                    & ((100 + PERCENT) * both >= PERCENT * (F.col("x.n") + F.col("y.n"))) & near & ~known)
             .select(F.col("x.h").alias("a"), F.col("y.h").alias("b")).distinct())
    more = durable(_compared(pairs, sets).where("linked").select("a", "b"))
    # 5. groups, by least document id
    final = _relabel(node, components(found.unionByName(more)))
    least = durable(final.join(final.groupBy("label").agg(F.min("id").alias("least")), "label").select("h", "least", "label"))
    return rows.join(maybe_broadcast(least, 32), "h", "left").select(
        F.col("id").alias("__id"), F.col("n").alias("__n"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("__component"),
        F.col("x").alias("__text"), F.col("h").alias("__set"), F.when(F.col("n") > 0, F.col("label")).alias("__group"))


def _explode_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            s = np.frombuffer(b.column(1)[i].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), b.column(0)[i].as_py(), np.int64)), pa.array(s)], ["h", "x"])


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``."""
    return link_groups(docs.select("doc_id", "text")).select(
        F.col("__id").alias("doc_id"), F.col("__n").alias("n_shingles"), F.col("__component").alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each group: that with the least id, then the least hashes of set and text; the columns of ``docs``.

    Rows without an id are compared by text only and come last.  Of rows with the same id and text one stays.  Documents
    without words link to nothing, so they all stay.
    """
    rows = link_groups(docs.select("doc_id", "text")).where(F.col("__group").isNotNull())
    kinds = durable(rows.groupBy("__group", F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__set").alias("h"),
                                                     F.col("__text").alias("x")).alias("__key")).agg(F.count("*").alias("rows")))
    first = kinds.groupBy("__group").agg(F.min("__key").alias("least"))
    # rows to look at: all but those that stand alone
    verdict = durable(kinds.join(first, "__group").withColumn("stays", F.col("__key") == F.col("least")).where(~F.col("stays") | (F.col("rows") > 1))
                      .select(F.col("__key.id").alias("__id"), F.col("__key.x").alias("__x"), "stays"))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*cols).alias("__own"), F.col("doc_id").cast("long").alias("__i"), F.xxhash64("text").alias("__t"))
    judged = keyed.join(maybe_broadcast(verdict, 24), (F.col("__t") == F.col("__x")) & F.col("__i").eqNullSafe(F.col("__id")), "left")
    alone = judged.where(F.col("stays").isNull()).select("__own.*")
    return alone.unionByName(judged.where("stays").dropDuplicates(["__i", "__t"]).select("__own.*"))


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
