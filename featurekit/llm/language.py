"""Language identification by partial matching (PPM).

One context tree per language, over bytes (ASCII letters in lower case, other ASCII as a space): counts of
each byte after its last ``ORDER`` bytes, added up for shorter contexts.  The code length of a byte is
``-log2(n / (C + D))`` if the longest context has seen it, else the escape ``-log2(D / (C + D))`` and the
next shorter context's (C: count of the context, D: distinct bytes after it; a context never seen costs
nothing; below order 0 all bytes are alike).  Counts are frozen after training.  A text's language is the one
whose tree codes all its bytes in the fewest bits; the score is that language's posterior.

Counts cover all training documents and all their byte strings: tasks count the strings of their texts, Spark
adds them up.  Where the tables of all known strings and languages take ``MODEL_BYTES`` at most, code lengths are worked
out once and sent to the tasks, and scoring looks strings up, in pieces of ``PIECE`` bytes.  Beyond that (many languages,
large alphabets) the counts stay in Spark, and the code lengths of the strings asked for come by joins: the same doubles, added in
another order, so scores agree to about 1e-9.  No string is dropped either way.

NULL texts, and texts without a letter, are ``und`` with score 0.  Ties go to the first language by code
point.  Without training rows everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import durable, table

ORDER = 3
MODEL_BYTES = 256 << 20      # of the tables made on the driver and sent to the tasks
PIECE = 1 << 20
_TABLES = 6                    # doubles per string and language held at once while the tables are made
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")          # Unicode category L: no digits, no letter-like numbers
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The last ORDER + 1 bytes at each byte, as one number, and where each text's begin; texts start after zeros."""
    pad = bytes(ORDER)
    buf = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), np.uint8)
    code = np.zeros(len(buf) - ORDER, np.uint32)
    for i in range(ORDER + 1):
        code = (code << np.uint32(8)) | buf[i:len(buf) - ORDER + i]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(size + ORDER) - size - ORDER          # of a text's first byte, in code
    marks = np.zeros(len(code) + 1, np.int32)
    np.add.at(marks, start, 1)
    np.add.at(marks, start + size, -1)
    inside = np.cumsum(marks[:-1]) > 0
    return code[inside], np.cumsum(size) - size


def _pieces(texts: list[bytes]) -> Iterator[list[int]]:
    """Indexes of texts, in groups of about PIECE bytes."""
    group, held = [], 0
    for i, t in enumerate(texts):
        group.append(i)
        held += len(t)
        if held >= PIECE:
            yield group
            group, held = [], 0
    if group:
        yield group


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text.encode().translate(_BYTES))
        for lang, texts in by_lang.items():
            for part in _pieces(texts):
                code, n = np.unique(_codes([texts[i] for i in part])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code)), pa.array(code.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])


def train(docs: DataFrame) -> dict | DataFrame:
    """The counts of (lang, text) rows: frozen (known byte strings and their code length in every language) if they may be broadcast."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    grams = durable(rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    size = grams.agg(F.count("*").alias("n"), F.count_distinct("lang").alias("langs"), F.count_distinct("gram").alias("grams")).first()
    return freeze(grams.toArrow()) if size.n * 32 + _TABLES * size.grams * (8 * size.langs + 8) <= MODEL_BYTES else grams


def freeze(counts: pa.Table) -> dict:
    langs = sorted(set(counts["lang"].to_pylist()), key=lambda x: x.encode())
    lang = np.array([langs.index(x) for x in counts["lang"].to_pylist()], np.int64)
    gram, n = counts["gram"].to_numpy().astype(np.int64), counts["n"].to_numpy().astype(np.float64)
    known, bits, escapes = [], [], []
    below = np.full((256, len(langs)), 8.0)                      # order -1: all bytes alike
    below_known = np.arange(256)
    for order in range(ORDER + 1):
        strings = gram & ((1 << 8 * (order + 1)) - 1)            # the context of this order and the byte
        known_k = np.arange(256) if order == 0 else np.unique(strings)
        contexts = np.unique(known_k >> 8)
        at = np.searchsorted(known_k, strings)
        count = np.zeros((len(known_k), len(langs)))
        np.add.at(count, (at, lang), n)
        ctx = np.searchsorted(contexts, known_k >> 8)
        total, distinct = np.zeros((2, len(contexts), len(langs)))
        np.add.at(total, ctx, count)
        np.add.at(distinct, ctx, count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.log2((total + distinct)[ctx] / count)
            escape = np.where(total > 0, np.log2((total + distinct) / distinct), 0.0)
        lower = below[known_k & 255 if order == 0 else np.searchsorted(below_known, known_k & ((1 << 8 * order) - 1))]
        cost = np.where(count > 0, seen, escape[ctx] + lower)
        known.append(known_k.astype(np.uint32))
        bits.append(cost)
        escapes.append((contexts.astype(np.uint32), escape))
        below, below_known = cost, known_k
    return {"langs": langs, "known": known, "bits": bits, "escapes": escapes}


def code_lengths(model: dict, code: np.ndarray) -> np.ndarray:
    """Bits of each coded byte in each language."""
    out = np.zeros((len(code), len(model["langs"])))
    todo = np.arange(len(code))
    for order in range(ORDER, -1, -1):
        part = code[todo] & np.uint32((1 << 8 * (order + 1)) - 1)
        known = model["known"][order]
        at = np.minimum(np.searchsorted(known, part), len(known) - 1)
        hit = known[at] == part
        out[todo[hit]] += model["bits"][order][at[hit]]
        todo, part = todo[~hit], part[~hit]
        if not len(todo):
            break
        contexts, escape = model["escapes"][order]
        at = np.minimum(np.searchsorted(contexts, part >> np.uint32(8)), len(contexts) - 1)
        hit = contexts[at] == part >> np.uint32(8)
        out[todo[hit]] += escape[at[hit]]
    return out


def _bits_of(model: dict, texts: list[bytes]) -> np.ndarray:
    """Bits of each text in each language.  Texts longer than a piece are added up piece by piece."""
    total = np.zeros((len(texts), len(model["langs"])))
    for part in _pieces(texts):
        code, start = _codes([texts[i] for i in part])
        if len(code):
            size = np.fromiter((len(texts[i]) for i in part), np.int64, len(part))
            own = np.flatnonzero(size)
            for a in range(0, len(code), PIECE):
                b = min(a + PIECE, len(code))
                rows = own[(start[own] < b) & (start[own] + size[own] > a)]
                cuts = np.maximum(start[rows], a) - a
                total[[part[r] for r in rows]] += np.add.reduceat(code_lengths(model, code[a:b]), cuts, axis=0, dtype=np.float64)
    return total


def _prices(asked: DataFrame, counts: DataFrame, langs: list[str]) -> DataFrame:
    """``code, bits``: code lengths of the strings ``code`` in every language, by joins with the counts of each order."""
    index = F.create_map(*[x for i, lang in enumerate(langs) for x in (F.lit(lang), F.lit(i))])[F.col("lang")]
    counts = counts.select(index.alias("l"), "gram", "n")
    out, last = asked, F.transform(F.sequence(F.lit(0), F.lit(len(langs) - 1)), lambda _: F.lit(8.0))
    for k in range(ORDER + 1):
        strings = counts.groupBy("l", F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("s")).agg(F.sum("n").alias("n"))
        contexts = strings.groupBy("l", F.shiftright("s", 8).alias("c")).agg(F.sum("n").alias("total"), F.count("*").alias("distinct"))
        seen = strings.groupBy("s").agg(F.map_from_entries(F.collect_list(F.struct("l", "n"))).alias("seen"))      # a row has as many entries as languages
        around = contexts.groupBy("c").agg(F.map_from_entries(F.collect_list(F.struct("l", F.struct("total", "distinct")))).alias("around"))
        # at most 2 ** 16 rows are broadcast
        out = (out.withColumn("s", F.col("code").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))).withColumn("c", F.shiftright("s", 8))
               .join(F.broadcast(seen) if k < 2 else seen, "s", "left").join(F.broadcast(around) if k < 3 else around, "c", "left"))

        def cost(below: Column, i: Column) -> Column:
            n, at = F.col("seen")[i], F.col("around")[i]
            return (F.when(n.isNotNull(), F.log2((at["total"] + at["distinct"]) / n))
                    .when(at.isNotNull(), F.log2((at["total"] + at["distinct"]) / at["distinct"]) + below).otherwise(below))

        out = out.select("code", F.transform(last if k == 0 else F.col("bits"), cost).alias("bits"))
    return out


def _identify_by_join(docs: DataFrame, counts: DataFrame) -> DataFrame:
    langs = sorted((r[0] for r in counts.select("lang").distinct().collect()), key=lambda x: x.encode())

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in enumerate(b.column(3).to_pylist()):
                code, n = (np.unique(_codes([t.encode().translate(_BYTES)])[0], return_counts=True) if t and _LETTER.search(t)
                           else (np.zeros(0, np.int64),) * 2)
                own = pa.array(np.full(max(len(code), 1), i))
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(own) for k in range(3)), pa.array(code.astype(np.int64) if len(code) else [None], pa.int64()),
                                                  pa.array(n if len(code) else [0], pa.int64())], ["row", "doc_id", "held_out", "code", "n"])

    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    found = durable(rows.mapInArrow(strings, f"row long, doc_id {kind}, held_out boolean, code long, n long"))
    priced = found.join(_prices(found.where("code is not null").select("code").distinct(), counts, langs), "code", "left")
    total = priced.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"),
                                      F.array(*[F.sum(F.col("n") * F.get("bits", F.lit(i))) for i in range(len(langs))]).alias("bits"))
    least = F.array_min("bits")
    score = F.when(least.isNotNull(), 1 / F.aggregate("bits", F.lit(0.0), lambda a, x: a + F.pow(F.lit(2.0), -F.least(x - least, F.lit(1000.0)))))
    names = F.array(*[F.lit(x) for x in langs])
    return total.select("doc_id", "held_out", F.coalesce(F.get(names, (F.array_position("bits", least) - 1).cast("int")), F.lit(UNKNOWN)).alias("lang_pred"),
                        F.coalesce(score, F.lit(0.0)).alias("score"))


def identify(docs: DataFrame, model: dict | DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    if isinstance(model, DataFrame):
        return _identify_by_join(docs, model)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            texts = [t if t and _LETTER.search(t) else "" for t in b.column(2).to_pylist()]
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if m["langs"]:
                bits = _bits_of(m, [t.encode().translate(_BYTES) for t in texts])
                best = bits.argmin(axis=1)
                more = bits - bits.min(axis=1, keepdims=True)
                sure = 1 / np.exp2(-np.minimum(more, 1000)).sum(axis=1)
                for i, t in enumerate(texts):
                    if t:
                        lang[i], score[i] = m["langs"][best[i]], float(sure[i])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame) -> DataFrame:
    """Train on the documents that aren't held out, predict all."""
    return identify(docs, train(docs.where(~held_out(F.col("doc_id")))))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))
