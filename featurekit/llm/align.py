"""Cross-tokenizer alignment: which tokens of two vocabularies end together, and which pairs do so most often.

A is a byte-level BPE (of the ``tokenizers`` library), B a sentencepiece model with byte fallback.  All of a text is
tokenised first: A takes space + text, B the text, before which it puts a space itself; strings of special tokens are
plain text.  Neither joins anything across a single space between two other characters (checked for B's pieces when they
are loaded; otherwise texts go in whole), so the ids of what stands between such spaces are memoised too.  A NULL or empty text, or one whose joined A or B bytes aren't space + text (U+2581 reads as a space, so a
text that holds it is such a one), has no tokens.

Anchors are byte offsets where a token of A and one of B both begin, both marked by a space; what precedes them ends
together, checked by the byte lengths of all tokens.  They cut a document into windows, of a word or so.  A window is a
pair of id tuples, and its alignment depends on nothing else: common ends cut it into groups, the tokens that end there
are linked.  Alignments are memoised by the id tuples.  Memos that hold over ``MEMO`` entries or ``MEMO_TOKENS`` tokens
begin anew, so nothing depends on them but the time.

Spark adds up the pairs of all documents and looks every document's pairs up again.  The ids come from tiktoken, which gets
A's vocabulary and merge order, wherever the pattern that precedes the merges can't depend on a library's Unicode
version or its limits (``plain``); all other texts go through ``tokenizers`` itself.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import durable, maybe_broadcast, table
from featurekit.session import written

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
MEMO, MEMO_TOKENS = 150_000, 2_000_000
PIECE = 1 << 20              # characters tokenised at a time

#: The pattern that splits text before the merges of byte-level BPE (fixed value of the vocabulary).
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Latin letters, common punctuation, Kana and ideographs, as every Unicode version has them; anything else isn't plain, nor are endless runs.
_OTHER = re.compile(r"[^\x00-ɏ‐-‧€ぁ-ゖァ-ヺ一-龥]")
_RUN = 2000
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_BLANKS = re.compile(r"\s{%d}" % _RUN)


def plain(text: str) -> bool:
    return not _OTHER.search(text) and (len(text) < _RUN or not _BLANKS.search(text) and max(map(len, text.split()), default=0) < _RUN)


def byte_letters() -> dict[str, int]:
    """Byte-level BPE's letters: printable bytes stand for themselves, the others for the letters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers of a task, and the bytes of their tokens."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import sentencepiece
        import tiktoken
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_str(a.decode())
        self.whole.encode_special_tokens = True
        model, letters = json.loads(a)["model"], byte_letters()
        self.a = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items()}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        ordered = merged == sorted(merged)                      # ranks and merges mean the same
        self.quick = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks={t: i for i, t in self.a.items()}, special_tokens={}) if ordered else None
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=b)
        piece = [self.pieces.id_to_piece(i) for i in range(self.pieces.vocab_size())]
        fallback = re.compile("<0x([0-9A-F]{2})>")
        self.b = {i: bytes([int(m[1], 16)]) if (m := fallback.fullmatch(p)) else p.replace("▁", " ").encode() for i, p in enumerate(piece)}
        # No piece of B crosses a space that stands between two other characters, and A's pattern always begins a word there.
        self.apart = all(set(p[1:]) == {"▁"} == {p[0]} for p in piece if "▁" in p[1:])
        self.a_size, self.a_mark = self._table(self.a)
        self.b_size, self.b_mark = self._table(self.b)
        self.b_mark &= np.array([p.startswith("▁") for p in piece])

    @staticmethod
    def _table(tokens: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        size, mark = np.zeros(max(tokens) + 1, np.int64), np.zeros(max(tokens) + 1, bool)
        for i, t in tokens.items():
            size[i], mark[i] = len(t), t.startswith(b" ")
        return size, mark

    def _a(self, text: str) -> list[int]:
        return self.quick.encode_ordinary(" " + text) if self.quick and plain(text) else self.whole.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A end to end, how many each part has, those of B, how many, and whether both have the bytes of space + part."""
        if (found := self._together(parts)) is not None:
            return found
        a, b = [self._a(t) for t in parts], self.pieces.encode(parts, num_threads=1)
        same = [b"".join(map(self.a.__getitem__, x)) == b" " + t.encode() == b"".join(map(self.b.__getitem__, y)) for t, x, y in zip(parts, a, b, strict=True)]
        flat = [np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b)]
        size = [np.fromiter(map(len, x), np.int64, len(parts)) for x in (a, b)]
        return flat[0], size[0], flat[1], size[1], np.array(same, bool)

    def _together(self, parts: list[str]) -> tuple | None:
        """As :meth:`encode`, all parts in one text; None where that might not be the same."""
        if not (self.apart and self.quick and all(parts)) or any(t[0].isspace() or t[-1].isspace() for t in parts) or not plain(text := " ".join(parts)):
            return None
        raw, out = b" " + text.encode(), []
        cuts = np.cumsum(np.fromiter((len(t.encode()) + 1 for t in parts), np.int64, len(parts)))
        for ids, tokens, size in ((self.quick.encode_ordinary(" " + text), self.a, self.a_size), (self.pieces.encode(text), self.b, self.b_size)):
            if b"".join(map(tokens.__getitem__, ids)) != raw:
                return None
            ids = np.array(ids, np.int64)
            ends = np.cumsum(size[ids])
            at = np.searchsorted(ends, cuts)
            if (ends[at] != cuts).any():
                return None
            out += [ids, np.diff(at, prepend=-1)]
        return *out, np.ones(len(parts), bool)


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for size[0] numbers, then those of begin[1], ..."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Aligner:
    """Aligns documents window by window, with memos of the ids of parts and of the alignments of windows."""

    def __init__(self, tokenizers: Tokenizers):
        t = self.t = tokenizers
        self.words = [np.array([f"{i}{end}" for i in range(len(size))], object) for size, ends in ((t.a_size, ",|"), (t.b_size, ",;")) for end in ends]
        self._clear()

    def _clear(self) -> None:
        none = np.zeros(0, np.int64)
        self.parts: dict[str, int] = {}
        self.a = self.a_count = self.b = self.b_count = self.window = none
        self.same = self.edge = np.zeros(0, bool)
        self.memo: dict[tuple[bytes, bytes], int] = {}
        self.groups: list[str] = []
        self.links = self.link_count = none

    def _look_up(self, flat: list[str]) -> np.ndarray:
        own = list(map(self.parts.get, flat))
        if None in own:
            new = list(dict.fromkeys(t for t, x in zip(flat, own, strict=True) if x is None))
            self.parts |= zip(new, range(len(self.parts), len(self.parts) + len(new)), strict=True)
            for name, more in zip(("a", "a_count", "b", "b_count", "same"), self.t.encode(new), strict=True):
                setattr(self, name, np.concatenate([getattr(self, name), more]))
            self.window = np.concatenate([self.window, np.full(len(new), -1)])
            self.edge = np.concatenate([self.edge, np.fromiter((not t or t[0].isspace() or t[-1].isspace() for t in new), bool, len(new))])
            own = map(self.parts.__getitem__, flat)
        return np.fromiter(own, np.int64, len(flat))

    def _parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the parts of all texts, and how many each text has.

        Parts are what stands between single spaces that have other characters on both sides; the whole text if B doesn't allow it.
        """
        cut = [t.split(" ") for t in texts] if self.t.apart else [[t] for t in texts]
        count = np.fromiter(map(len, cut), np.int64, len(cut))
        own = self._look_up(list(chain.from_iterable(cut)))
        if self.t.apart and self.edge[own].any():
            near = set(np.repeat(np.arange(len(cut)), count)[self.edge[own]].tolist())
            cut = [_BETWEEN.split(texts[k]) if k in near else c for k, c in enumerate(cut)]
            count = np.fromiter(map(len, cut), np.int64, len(cut))
            own = self._look_up(list(chain.from_iterable(cut)))
        return own, count

    def _align(self, a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> None:
        """Adds the alignments of new windows, given their ids end to end and how many each has."""
        a_ends, b_ends = np.cumsum(self.t.a_size[a]), np.cumsum(self.t.b_size[b])
        at = np.minimum(np.searchsorted(b_ends, a_ends), len(b_ends) - 1)
        last_a = np.flatnonzero(b_ends[at] == a_ends)
        last_b = at[last_a]
        # A token of A comes after the tokens of B of earlier groups, one of B after those of A up to its group's end.
        a_at = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[np.searchsorted(last_a, np.arange(len(a)))]
        b_at = np.arange(len(b)) + (last_a + 1)[np.searchsorted(last_b, np.arange(len(b)))]
        out = np.empty(len(a) + len(b), object)
        out[a_at], out[b_at] = self.words[0][a], self.words[2][b]
        out[a_at[last_a]], out[b_at[last_b]] = self.words[1][a[last_a]], self.words[3][b[last_b]]
        text, to = out.tolist(), np.cumsum(n + m).tolist()
        self.groups += ["".join(text[i:j])[:-1] for i, j in zip([0, *to], to, strict=False)]
        self.links = np.concatenate([self.links, b[last_b] << 32 | a[last_a]])
        self.link_count = np.concatenate([self.link_count, np.diff(np.searchsorted(last_a, np.cumsum(n)), prepend=0)])

    def _windows(self, a: np.ndarray, i: np.ndarray, n: np.ndarray, b: np.ndarray, j: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Indexes of the windows of ids a[i:i + n] and b[j:j + m], which are aligned if they're new."""
        a_raw, b_raw = a.astype(np.int32).tobytes(), b.astype(np.int32).tobytes()
        keys = [(a_raw[p:q], b_raw[r:s]) for p, q, r, s in zip(*((4 * x).tolist() for x in (i, i + n, j, j + m)), strict=True)]
        found = list(map(self.memo.get, keys))
        if None in found:
            new = {k: at for at, (k, x) in enumerate(zip(keys, found, strict=True)) if x is None}
            at = np.fromiter(new.values(), np.int64, len(new))
            self.memo |= zip(new, range(len(self.groups), len(self.groups) + len(new)), strict=True)
            self._align(a[_ragged(i[at], n[at])], n[at], b[_ragged(j[at], m[at])], m[at])
            found = map(self.memo.__getitem__, keys)
        return np.fromiter(found, np.int64, len(keys))

    def align(self, texts: list[str]) -> list[tuple[int, int, str, np.ndarray] | None]:
        """For each text: its number of tokens of A and of B, its groups ``a1,a2|b1;a3|b2,b3``, its linked pairs ``b << 32 | a``.  None without tokens."""
        if len(self.parts) > MEMO or len(self.groups) > MEMO or len(self.a) > MEMO_TOKENS:
            self._clear()
        t = self.t
        part, count = self._parts(texts)
        good = np.fromiter(map(bool, texts), bool, len(texts)) & np.logical_and.reduceat(self.same[part], np.cumsum(count) - count) if len(texts) else np.zeros(0, bool)
        part = part[np.repeat(good, count)]
        n, m = self.a_count[part], self.b_count[part]
        a, b = (flat[_ragged((np.cumsum(size) - size)[part], size[part])] for flat, size in ((self.a, self.a_count), (self.b, self.b_count)))
        # All tokens, good texts end to end; anchors:
        a_from, b_from = np.cumsum(t.a_size[a]) - t.a_size[a], np.cumsum(t.b_size[b]) - t.b_size[b]
        a_mark, b_mark = np.flatnonzero(t.a_mark[a]), np.flatnonzero(t.b_mark[b])
        at = np.searchsorted(b_from[b_mark], a_from[a_mark])
        hit = at < len(b_mark)
        hit[hit] = b_from[b_mark[at[hit]]] == a_from[a_mark[hit]]
        i, j = a_mark[hit], b_mark[at[hit]]
        wide, high = np.diff(i, append=len(a)), np.diff(j, append=len(b))
        # A window that is a part has that part's ids: its alignment is kept with the part as well.
        begin = np.cumsum(n) - n
        own = np.searchsorted(begin, i, "right") - 1
        is_part = (begin[own] == i) & (n[own] == wide)
        window = np.where(is_part, self.window[part[own]], -1)
        todo = np.flatnonzero(window < 0)
        name = np.where(is_part[todo], part[own[todo]], len(self.parts) + np.arange(len(todo)))
        first, like = np.unique(name, return_index=True, return_inverse=True)[1:]
        some = todo[first]
        found = self._windows(a, i[some], wide[some], b, j[some], high[some])
        window[todo] = found[like]
        self.window[part[own[todo[is_part[todo]]]]] = window[todo[is_part[todo]]]

        size = self.link_count[window]
        links = self.links[_ragged((np.cumsum(self.link_count) - self.link_count)[window], size)]
        doc = np.repeat(np.arange(len(texts))[good], count[good])
        n_a, n_b = np.bincount(doc, n, len(texts)).astype(int), np.bincount(doc, m, len(texts)).astype(int)
        to = np.searchsorted(i, np.cumsum(n_a)).tolist()
        link_to = np.concatenate([[0], np.cumsum(size)])
        out = []
        for k, (p, q) in enumerate(zip([0, *to], to, strict=False)):
            out.append((int(n_a[k]), int(n_b[k]), ";".join(map(self.groups.__getitem__, window[p:q].tolist())), links[link_to[p]:link_to[q]]) if good[k] else None)
        return out


_OUT = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def token_links(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """Every document's counts, the hash of its groups, and its linked pairs with how often it holds them.

    The tokenizer files are read by the driver and sent to the tasks (a few MB, whatever the documents).
    """
    files = []
    for name in (A_FILE, B_FILE):
        with open(os.path.join(folder, name), "rb") as f:
            files.append(f.read())
    sent = docs.sparkSession.sparkContext.broadcast(files)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(Tokenizers(*sent.value))
            texts = batch.column(2).to_pylist()
            begin = 0
            while begin < len(texts):
                end, held = begin, 0
                while end < len(texts) and (held < PIECE or end == begin):
                    held += len(texts[end] or "")
                    end += 1
                cols: list[list] = [[] for _ in range(6)]
                for x in aligner.align([x or "" for x in texts[begin:end]]):
                    n_a, n_b, groups, links = x or (0, 0, "", np.zeros(0, np.int64))
                    pairs, times = np.unique(links, return_counts=True)
                    for col, value in zip(cols, (n_a, n_b, len(links), hashlib.sha256(groups.encode()).hexdigest() if x else "", pairs, times), strict=True):
                        col.append(value)
                n_a, n_b, n, sha, pairs, times = cols
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin), *(pa.array(c, pa.int64()) for c in (n_a, n_b, n, n)),
                     pa.array(sha, pa.string()), *(pa.array(c, pa.list_(pa.int64())) for c in (pairs, times))], [x.split()[0] for x in _OUT.split(", ")])
                begin = end

    return (docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(rows, _OUT))


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair, a, b, n, best``: corpus-wide links of each id pair, and whether no pair with its B id has more."""
    one = links.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    pairs = durable(one.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n")))
    pairs = pairs.withColumns({"b": F.shiftright("pair", 32), "a": F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))})
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    return pairs.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    links = written(token_links(docs, folder))
    counts = durable(pair_counts(links).select("pair", "n", "best"))
    own = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    each = links.select(*own, F.explode_outer(F.arrays_zip("pairs", "times")).alias("x")).select(*own, F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    return (each.join(maybe_broadcast(counts, 40), "pair", "left").groupBy(*own)
            .agg(total(F.when(F.col("best"), F.col("times"))).alias("n_best"), total(F.col("times") * F.col("n")).alias("count_sum"))
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"))
