"""Conversation prefix trie: which conversations begin alike, and what sharing their beginnings saves.

A conversation is its turns in order of ``turn`` (NULL first, ties by the turn's digest).  NULL role or text is the
empty string, a turn's identity is the SHA-256 of both, and rows without a ``conv_id`` belong to no conversation.  A
node is a distinct sequence of first turns; the root is the empty one.  No conversations: no nodes.

Equal conversations are merged first, so a group of copies is one weighted sequence, whatever its size; its ids are
joined in chunks of ``2 ** CHUNK_BITS`` and hashed as a stream, in one pass and constant memory.  The distinct sequences are cut
into shards of about ``SHARD_TURNS`` turns by *range* of their order: a common beginning, however hot, is then spread over as many shards as it
fills, and two shards share only nodes on the paths of their first and last sequences.  A task gives its shard's
turns dense ids, packs a double-array trie (child of ``s`` by turn ``c``: ``t = BASE[s] + c`` with ``CHECK[t] = s``),
and walks its sequences through the arrays, all of one depth at once.  Nodes off the two outer paths are complete in
their shard.  Those on them, at most two per shard and depth, are merged by their identity (a chain of hashes), and
sums over their subtrees are made by pointer doubling, in log2(depth) joins.

A conversation is one array in one task: 36 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import durable, maybe_broadcast, table, words
from featurekit.session import written

SHARD_TURNS = 200_000
CHUNK_BITS = 8               # conv_ids that differ in this many low bits are joined into one string
FAMILY, HEADS = 20, 4        # of the query's rebuilt conversations
_TRIES = 64                  # free slots tried per node before its children go to the end of the arrays
_OUT = ("key binary, up binary, turn binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, words long, ends_sha256 string")
_ROWS = pa.schema({"seq": pa.list_(pa.binary()), "words": pa.list_(pa.int32()), "conv_id": pa.int64(), "n": pa.int64(), "ends": pa.string()})
_EMPTY = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- sequences

def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, words`` of every turn: texts end here, 32 bytes stand for them."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return (conversations.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.size(words(text)).alias("words")))


def _ordered(rows: DataFrame, by: list[str]) -> DataFrame:
    one = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "digest", "words")
    return rows.groupBy(*by).agg(F.sort_array(F.collect_list(one)).alias("own"))


def _sequences(own: Column) -> list[Column]:
    return [F.transform(own, lambda t: t["digest"]).alias("seq"), F.transform(own, lambda t: t["words"]).alias("words")]


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, seq, words``: digests and word counts of each conversation's turns, in order."""
    return _ordered(turns(conversations), ["conv_id"]).select("conv_id", *_sequences(F.col("own")))


def rebuilt(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """As :func:`sequences`, with the first h = crc32(conv_id) % heads turns taken from conversation conv_id - conv_id % family."""
    c = F.col("conv_id")
    own = _ordered(turns(conversations).withColumn("base", c - c % family).repartition("base"), ["base", "conv_id"])
    first = own.where(c == F.col("base")).select("base", F.slice("own", 1, heads - 1).alias("first"))
    h = (F.crc32(c.cast("string")) % heads).cast("int")
    none = F.slice("own", 1, 0)
    return (own.join(first, "base", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("first", none), F.lit(1), h),
                                        F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0)))).alias("own"))
            .select("conv_id", *_sequences(F.col("own"))))


# ---------------------------------------------------------------- double array

def pack(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BASE and CHECK of the trie of sequences ``codes[start:start + size]`` of dense ids; state 0 is the root.

    Depth by depth: nodes with many children are placed first, each at the first of some free slots where all its
    children fit (at the end of the arrays otherwise); only children then fill the holes.
    """
    width = int(codes.max()) + 1 if len(codes) else 1
    base, check = np.zeros(width + 1, np.int64), np.full(width + 1, -1, np.int64)
    check[0] = 0
    end = 1                                                     # slots from here on are free

    def grow(to: int) -> None:
        nonlocal base, check
        if to > len(check):
            more = max(to, len(check) * 3 // 2) - len(check)
            base, check = np.concatenate([base, np.zeros(more, np.int64)]), np.concatenate([check, np.full(more, -1, np.int64)])

    state, live = np.zeros(len(sizes), np.int64), np.flatnonzero(sizes > 0)
    depth = 0
    while len(live):
        pairs, own = np.unique(state[live] * width + codes[starts[live] + depth], return_inverse=True)
        parent, code = pairs // width, pairs % width
        first = np.flatnonzero(np.diff(parent, prepend=-1))
        count = np.diff(first, append=len(parent))
        slot = np.empty(len(pairs), np.int64)
        free = np.flatnonzero(check[:end] < 0)
        for i in sorted(np.flatnonzero(count > 1), key=lambda i: -count[i]):
            mine = slice(first[i], first[i] + count[i])
            step = code[mine] - code[mine.start]
            free = free[check[free] < 0] if len(free) and check[free[0]] >= 0 else free
            for at in free[:_TRIES]:
                grow(at + step[-1] + 1)
                if (check[at + step] < 0).all():
                    break
            else:
                at = end
                grow(at + step[-1] + 1)
            slot[mine] = at + step
            check[at + step] = parent[mine]
            end = max(end, int(at + step[-1]) + 1)
        single = first[count == 1]
        holes = np.flatnonzero(check[:end] < 0)[:len(single)]
        rest = len(single) - len(holes)
        grow(end + rest)
        slot[single] = np.concatenate([holes, np.arange(end, end + rest)])
        check[slot[single]] = parent[single]
        end += rest
        base[parent] = slot - code
        state[live] = slot[own]
        depth += 1
        live = live[sizes[live] > depth]
    return base[:end], check[:end]


def walk(base: np.ndarray, check: np.ndarray, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sequences longer than 0, 1, ... and their states after that many turns and one; -1 where the trie has no such child."""
    state, live, depth = np.zeros(len(sizes), np.int64), np.flatnonzero(sizes > 0), 0
    while len(live):
        to = base[state[live]] + codes[starts[live] + depth]
        inside = (to > 0) & (to < len(check))
        to = np.where(inside & (check[np.where(inside, to, 0)] == state[live]), to, -1)
        state[live] = to
        yield live, to
        depth += 1
        live = live[(sizes[live] > depth) & (to >= 0)]


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one shard of distinct sequences (seq, words, conv_id, n, ends)."""
    rows = pa.Table.from_batches(list(batches), _ROWS)
    if not len(rows):
        return
    seq = rows["seq"].combine_chunks()
    turn = seq.flatten().dictionary_encode()                    # dense turn ids of this shard
    codes, word = turn.indices.to_numpy(zero_copy_only=False).astype(np.int64), rows["words"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(seq.offsets.to_numpy()).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    weight, conv = rows["n"].to_numpy(), rows["conv_id"].to_numpy()
    base, check = pack(codes, starts, sizes)

    size = len(check)
    n, w, code = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1, np.int64)
    least, depth, last = np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64), np.zeros(len(sizes), np.int64)
    n[0], least[0] = weight.sum(), conv.min()
    paths = {int(i): [0] for i in _outer(seq)}
    levels = [np.zeros(1, np.int64)]
    for live, to in walk(base, check, codes, starts, sizes):
        at = starts[live] + len(levels) - 1
        np.add.at(n, to, weight[live])
        np.minimum.at(least, to, conv[live])
        w[to], code[to], depth[to], last[live] = word[at], codes[at], len(levels), to
        levels.append(np.unique(to))
        for i, path in paths.items():
            if sizes[i] >= len(levels) - 1:
                path.append(int(to[np.searchsorted(live, i)]))

    keys: dict[int, bytes] = {}                                 # nodes that other shards may hold as well
    for path in paths.values():
        for k, s in enumerate(path):
            keys[s] = hashlib.sha256(keys[path[k - 1]] + turn.dictionary[int(code[s])].as_py()).digest() if k else hashlib.sha256(b"").digest()
    outer = np.zeros(size, bool)
    outer[list(keys)] = True
    children, leaves, saved = np.zeros((3, size), np.int64)
    for nodes in reversed(levels[1:]):
        t = nodes[~outer[nodes]]
        leaves[t] += children[t] == 0
        saved[t] += (n[t] - 1) * w[t]
        for total, value in ((children, 1), (leaves, leaves[t]), (saved, saved[t])):
            np.add.at(total, check[t], value)

    ends = np.full(size, _EMPTY, object)
    ends[last] = rows["ends"].to_pylist()
    nodes = np.concatenate(levels)
    up = check[nodes]
    for a in range(0, len(nodes), 10_000):
        t, p = nodes[a:a + 10_000], up[a:a + 10_000]
        known = pa.array([keys.get(int(x)) if x or y == 0 else None for x, y in zip(t, p, strict=True)], pa.binary())
        above = pa.array([keys.get(int(y)) if x else None for x, y in zip(t, p, strict=True)], pa.binary())
        own = turn.dictionary.take(pa.array(np.where(code[t] < 0, 0, code[t]), mask=code[t] < 0))
        yield pa.RecordBatch.from_arrays(
            [known, above, own, *(pa.array(x) for x in (least[t], depth[t])), pa.array(least[p], mask=outer[p]),
             *(pa.array(x[t]) for x in (n, children, leaves, saved, w)), pa.array(ends[t], pa.string())],
            [x.split()[0] for x in _OUT.split(", ")])


def _outer(seq: pa.Array) -> tuple[int, int]:
    """Index of the first and of the last sequence in Spark's order of binary arrays."""
    all_of = seq.to_pylist()
    order = range(len(all_of))
    return min(order, key=all_of.__getitem__), max(order, key=all_of.__getitem__)


# ---------------------------------------------------------------- whole trie

def _ends(rows: DataFrame) -> DataFrame:
    """``seq_key, ends``: SHA-256 of the conv_ids of each distinct sequence, ascending, comma-joined."""
    chunks = (rows.groupBy("seq_key", F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            keys, ends = [], []
            for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if k == key:
                    sha.update(b"," + ids.encode())
                    continue
                if sha:
                    keys.append(key)
                    ends.append(sha.hexdigest())
                key, sha = k, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())], ["seq_key", "ends"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], ["seq_key", "ends"])

    return chunks.repartition("seq_key").sortWithinPartitions("seq_key", "chunk").mapInArrow(hashed, "seq_key binary, ends string")


def _subtree_sums(upper: DataFrame) -> DataFrame:
    """``key, n_leaves, saved_tokens`` summed over each merged node's subtree, by pointer doubling."""
    acc = upper.select("key", F.col("up").alias("jump"), "n_leaves", "saved_tokens")
    deepest, step = upper.agg(F.max("depth")).first()[0] or 0, 1
    while step <= deepest:
        below = acc.groupBy("jump").agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")).withColumnRenamed("jump", "key")
        above = acc.select(F.col("key").alias("jump"), F.col("jump").alias("next"))
        acc = durable(acc.join(below, "key", "left").join(above, "jump", "left").select(
            "key", F.col("next").alias("jump"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens")))
        step *= 2
    return acc.select("key", "n_leaves", "saved_tokens")


def prefix_trie(seqs: DataFrame, shards: int | None = None) -> DataFrame:
    """Nodes of the trie of (conv_id, seq, words) rows, one conversation each: ``conv_id`` (the least member), ``depth``,
    ``parent_conv_id``, ``n_convs, n_children, n_leaves, saved_tokens, ends_sha256``, and ``turn``, the last turn's digest (root: NULL)."""
    spark = seqs.sparkSession
    joined = F.array_join(F.transform("seq", lambda x: F.hex(x)), "")
    rows = written(seqs.select("conv_id", "seq", "words", F.unhex(F.sha2(joined, 256)).alias("seq_key")))
    distinct = (rows.groupBy("seq_key").agg(F.first("seq").alias("seq"), F.first("words").alias("words"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
                .join(_ends(rows), "seq_key").select("seq", "words", "conv_id", "n", "ends"))
    distinct = written(distinct)
    turn_count = distinct.agg(F.sum(F.size("seq") + 1)).first()[0] or 0
    shards = shards or max(spark.sparkContext.defaultParallelism, -(-turn_count // SHARD_TURNS))
    nodes = written(distinct.repartitionByRange(shards, "seq").mapInArrow(_shard, _OUT))

    merged = nodes.where("key is not null").groupBy("key").agg(
        F.max("up").alias("up"), F.max("turn").alias("turn"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max(F.when(F.col("ends_sha256") != _EMPTY, F.col("ends_sha256"))), F.lit(_EMPTY)).alias("ends_sha256"))
    merged = durable(merged)
    kids = merged.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.count("*").alias("kids"))
    children = F.col("n_children") + F.coalesce("kids", F.lit(0))
    upper = durable(merged.join(kids, "key", "left").withColumns({
        "n_children": children, "n_leaves": F.col("n_leaves") + (children == 0).cast("long"),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")}).drop("kids"))
    names = upper.select(F.col("key").alias("up"), F.col("conv_id").alias("above"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn"]
    shared = (upper.drop("n_leaves", "saved_tokens").join(_subtree_sums(upper), "key").join(names, "up", "left")
              .withColumn("parent_conv_id", F.col("above")).select(*out))
    own = nodes.where("key is null")
    below = (own.where("up is not null").drop("parent_conv_id").join(maybe_broadcast(names, 64), "up", "left")
             .withColumnRenamed("above", "parent_conv_id").select(*out))
    return own.where("up is null").select(*out).unionByName(below).unionByName(shared)


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    nodes = prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))
    return nodes.drop("turn")
