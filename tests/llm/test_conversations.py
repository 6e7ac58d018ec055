"""Chat windows against a plain windower; the prefix trie against a plain trie."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurekit.llm import chat, trie
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, w int, window string, own string, __doc int"


def said(t):
    return len(re.findall(r"[^\W_]+|[^\w\s]|_", t))


def plain_windows(turns, budget, history):
    """(context turns, new turns) of each window, turns as (role, text)."""
    system, rest = (turns[:1], turns[1:]) if turns and turns[0][0] == "system" else ([], turns)
    s, out, new, room = sum(said(t) for _, t in system), [], [], 0
    groups = []
    for i, (_, t) in enumerate(rest):
        room = budget - s - (history if len(groups) > 1 else 0)
        if groups and sum(said(rest[j][1]) for j in groups[-1]) + said(t) <= room:
            groups[-1].append(i)
        else:
            groups.append([i])
    for k, g in enumerate(groups or [[]]):
        allowed = max(0, min(history, budget - s - sum(said(rest[j][1]) for j in g)))
        back = [j for j in range(g[0] if g else 0) if sum(said(rest[i][1]) for i in range(j, g[0])) <= allowed]
        out.append(((system if k else []) + [rest[j] for j in back], ([] if k else system) + [rest[j] for j in g]))
    return out


def test_windows_stay_within_the_budget(spark):
    rng = random.Random(3)
    convs = {c: [("system" if i == 0 and c % 3 == 0 else ("user", "assistant")[i % 2], " ".join("w" * rng.randint(1, 3) for _ in range(
        rng.choice([0, 1, 5, 20, 45, 70])))) for i in range(rng.randint(1, 14))] for c in range(60)}
    rows = [(c, i, *t, 7, "x", "y", 1) for c, own in convs.items() for i, t in enumerate(own)]
    windows = chat.format_windows(spark.createDataFrame(rows, SCHEMA).repartition(3), budget=60, history=15)
    got = defaultdict(list)
    for r in windows.orderBy("conv_id", "window").collect():
        got[r.conv_id].append(r)
    for c, own in convs.items():
        want = plain_windows(own, 60, 15)
        assert len(got[c]) == len(want)
        for r, (context, new) in zip(got[c], want, strict=True):
            write = lambda ts: "".join(f"{chat.START}{role}\n{t}{chat.END}" for role, t in ts)
            assert r.formatted == write(context + new) and r.n_context == len(context)
            assert r.tokens == sum(said(t) for _, t in context + new)
            assert r.tokens <= 60 or len([t for t in new if t[0] != "system"]) <= 1
            assert [r.formatted[x.s:x.e] for x in r.loss] == [t for role, t in new if role == "assistant"]


def plain_trie(rows, family=20, heads=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, role or "", text or ""))
    own = {c: [x[3:] for x in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        built[c] = tuple(own.get(c - int(np.fmod(c, family)), [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    words = lambda k: len(re.findall(r"[^\x20\x09-\x0d]+", k[-1][1])) if k else 0
    out = []
    for k, ms in members.items():
        below = [x for x in members if x[:len(k)] == k]
        kids = [x for x in below if len(x) == len(k) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in below)]
        ends = ",".join(str(c) for c in sorted(ms) if built[c] == k)
        out.append((min(ms), len(k), min(members[k[:-1]]) if k else None, len(ms), len(kids), len(leaves),
                    sum((len(members[x]) - 1) * words(x) for x in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


AWKWARD = [(None, 1, "user", "lost", 1, "a", "b", 1), (5, None, None, None, 1, "a", "b", 1), (5, None, None, None, 1, "a", "b", 1), (5, 2, "user", "", 1, "a", "b", 1),
           (0, 1, "user", "one two", 1, "a", "b", 1), (0, 1, "user", "another first", 1, "a", "b", 1), (0, 2, "assistant", "ok", 1, "a", "b", 1),
           (-7, 1, "user", "one two", 1, "a", "b", 1), (40, 1, "user", "w " * 5000, 1, "a", "b", 1), (41, 9, "user", "w " * 5000, 1, "a", "b", 1)]


def _conversations():
    rng = random.Random(11)
    rows = list(AWKWARD)
    for c in range(100, 340):
        text = rng.choice(["shared beginning of all", "shared beginning of all", "another one"])
        for i in range(rng.randint(1, 6)):
            rows.append((c, i, ("user", "assistant")[i % 2], text if i < 2 else rng.choice("a b,b c d,e".split(",")), 1, "a", "b", 1))
    rows += [(c, i, "user", f"copy {i}", 1, "a", "b", 1) for c in range(1000, 1700) for i in range(4)]
    return rows


@pytest.mark.parametrize("shards", [1, 7])
def test_trie_equals_a_plain_one(spark, shards):
    rows = _conversations()
    nodes = trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, SCHEMA).repartition(5)), shards)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = sorted((tuple(r) for r in nodes.select(*columns).collect()), key=repr)
    assert got == plain_trie([r[:4] for r in rows])


def test_trie_of_nothing_and_of_whole_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(trie.rebuilt(empty)).count() == 0
    rows = spark.createDataFrame([(1, 1, "user", "a", 1, "", "", 1), (2, 1, "user", "a", 1, "", "", 1), (2, 2, "user", "b", 1, "", "", 1)], SCHEMA)
    nodes = {r.depth: r for r in trie.prefix_trie(trie.sequences(rows)).collect()}
    assert [nodes[d].n_convs for d in (0, 1, 2)] == [2, 2, 1] and nodes[0].turn is None and len(nodes[2].turn) == 32


def test_double_array():
    rng = np.random.default_rng(2)
    seqs = sorted({tuple(rng.integers(0, 30, rng.integers(0, 7)).tolist()) for _ in range(400)})
    sizes = np.array([len(s) for s in seqs])
    starts, codes = np.cumsum(sizes) - sizes, np.array([c for s in seqs for c in s])
    base, check = trie.pack(codes, starts, sizes)
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    at = {(): 0}
    for s in sorted(prefixes, key=len):
        if s:
            at[s] = int(base[at[s[:-1]]] + s[-1])
            assert check[at[s]] == at[s[:-1]]
    assert len(set(at.values())) == len(prefixes) == (check >= 0).sum()     # one slot each, and none besides
    for s in prefixes:
        for c in range(30):
            t = int(base[at[s]] + c)
            assert (0 < t < len(check) and check[t] == at[s]) == ((*s, c) in prefixes)
    state = np.zeros(len(seqs), int)
    for live, to in trie.walk(base, check, codes, starts, sizes):
        state[live] = to
    assert state.tolist() == [at[s] for s in seqs]


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = trie.op13_prefix_trie(spark, SF_SMALL)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_trie(rows)
    assert got.agg(F.max("n_convs")).first()[0] == len({r[0] for r in rows})
