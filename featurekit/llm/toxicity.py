"""Toxicity by compression distance: two zstandard dictionaries, one of ordinary and one of toxic text.

A text (lower-cased, UTF-8) is cut into windows of ``WINDOW`` bytes or a little more, at blanks; a run without blanks is
cut at twice that.  Every window is compressed with either dictionary, and its distance is the length with the ordinary
dictionary less that with the toxic one, clipped to ``CLIP`` bytes.

* The ordinary dictionary is trained (COVER) on the words of ordinary labelled text, the toxic one on those words of toxic
  text whose rate there is higher than in ordinary text by a likelihood ratio of ``EVIDENCE``.  The toxic dictionary is followed by
  the ordinary one, and both are used as raw content: windows without toxic words then compress to about the same length
  with both, which leaves little noise in the distance.
* Thresholds are calibrated on other labelled documents than the dictionaries': every distance from -CLIP to CLIP gets the
  log ratio of its rates in windows of toxic and of ordinary documents; a logistic regression over their sum's
  mean, their sum's root-scaled form, the largest of them and the share of telling windows gives the document's score.

The fit is bounded: ``MAX_DOCS`` labelled documents a class, chosen by a hash of doc_id, and of these ``MAX_BYTES`` of windows a class,
chosen by a hash as well; the regression weighs the classes as all labels have them.  A document is labelled 1 if any of its labels is; NULL labels don't count.  Scoring reads
every whole text, and nothing but the text.

NULL and empty texts, and texts of white space, score 0.  Without labelled rows, or with one class only, all other texts score the share
of label 1 (0 without any).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import table

WINDOW = 128
LEVEL = 9
ORDINARY_BYTES, TOXIC_BYTES = 65_536, 8_192
SEGMENT, LETTERS = 16, 6      # of the dictionaries' training: bytes per segment, bytes that count as one feature
EVIDENCE = 24.0               # about one chance in a million for a word of equal rates
CLIP = 8
MAX_DOCS, MAX_BYTES = 10_000, 6 << 20
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def windows(text: str | None) -> list[bytes]:
    raw, out, at = (text or "").strip().lower().encode(), [], 0
    while at < len(raw):
        end = raw.find(b" ", at + WINDOW, at + 2 * WINDOW) if at + WINDOW < len(raw) else len(raw)
        end = end if end >= 0 else min(at + 2 * WINDOW, len(raw))
        out.append(raw[at:end])
        at = end
    return out


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """Trained on the samples; if they are too few or too short to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=SEGMENT, d=LETTERS).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


def train(ordinary: list[bytes], toxic: list[bytes]) -> tuple[bytes, bytes]:
    """The two dictionaries, from windows of either class."""
    by_class = [[b" " + w + b" " for x in own for w in x.split()] for own in (ordinary, toxic)]
    told = telling_words(*map(Counter, by_class))
    telling = [w for w in by_class[1] if w in told]
    base = _dictionary(ORDINARY_BYTES, by_class[0])
    return base, _dictionary(TOXIC_BYTES, telling) + base


def telling_words(ordinary: Counter, toxic: Counter) -> set[bytes]:
    """Words whose rate in toxic text is the higher one by a log-likelihood statistic (Dunning's) of EVIDENCE or more."""
    n = np.array([ordinary.total(), toxic.total()], float)
    if not n.all():
        return set(toxic)
    words = list(toxic)
    k = np.array([[ordinary[w], toxic[w]] for w in words], float).reshape(-1, 2)
    rate = k.sum(axis=1, keepdims=True) / n.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(k > 0, k * np.log(k / (n * rate)), 0) + np.where(n > k, (n - k) * np.log((n - k) / (n * (1 - rate))), 0)).sum(axis=1)
    higher = k[:, 1] / n[1] > k[:, 0] / n[0]
    return {words[i] for i in np.flatnonzero(higher & (g >= EVIDENCE))}


class Distance:
    """Counts of the distances of a text's windows, -CLIP to CLIP."""

    def __init__(self, dictionaries: tuple[bytes, bytes]):
        self.compress = []
        for content in dictionaries:
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def counts(self, text: str | None) -> np.ndarray:
        own = windows(text)
        plain, toxic = (np.fromiter(map(len, map(c, own)), np.int64, len(own)) for c in self.compress)
        return np.bincount(np.clip(plain - toxic, -CLIP, CLIP) + CLIP, minlength=2 * CLIP + 1)


def features(counts: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Of each row of counts: mean log ratio, sum over the root of the windows, largest log ratio seen, share above 1, constant."""
    n = np.maximum(counts.sum(axis=1), 1)
    total = counts @ ratio
    most = np.where(counts > 0, ratio, -np.inf).max(axis=1)
    return np.column_stack([total / n, np.clip(total / np.sqrt(n), -20, 20), np.where(np.isfinite(most), most, 0), counts[:, ratio > 1].sum(axis=1) / n, np.ones(len(n))])


def calibrate(counts: np.ndarray, toxic: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Log ratio of each distance, and the weights of the logistic regression (Newton steps, small ridge).  Rows are weighed so that label 1 has ``share``."""
    rate = [counts[toxic == k].sum(axis=0) + 1.0 for k in (0, 1)]
    ratio = np.log(rate[1] / rate[1].sum()) - np.log(rate[0] / rate[0].sum())
    x = features(counts, ratio)
    of_row = np.where(toxic == 1, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    weight, ridge = np.zeros(x.shape[1]), np.diag([0.1] * (x.shape[1] - 1) + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        slope = x.T @ (of_row * (toxic - p)) - ridge @ weight
        weight = weight + np.linalg.solve((x * (of_row * p * (1 - p))[:, None]).T @ x + ridge, slope)
    return ratio, weight


def _cut(rows: DataFrame, amount: float, bound: int, *by: str) -> DataFrame:
    """About ``bound`` of the ``amount`` that ``rows`` hold, chosen by a hash of ``by``."""
    if amount <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(*by, F.lit("toxicity")), F.lit(1 << 30)) < int(bound / amount * (1 << 30)))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Dictionaries, log ratios and weights from the labelled documents that aren't held out; ``share`` alone without two classes."""
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    own = own.where(~held_out(F.col("doc_id")))
    n, ones = own.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < ones < n:
        return {"share": ones / n if n else 0.0}
    chosen = [_cut(own.where(F.col("toxic") == k), size, MAX_DOCS, "doc_id") for k, size in ((0, n - ones), (1, ones))]
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")      # about 2 * MAX_DOCS rows
    rows = rows.select("doc_id", "toxic", "text", (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(3)) == 0).alias("calibrates"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, toxic, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if own := windows(text):
                    yield pa.RecordBatch.from_arrays([pa.array([doc] * len(own), pa.int64()), pa.array([toxic] * len(own), pa.int32()),
                                                      pa.array(range(len(own)), pa.int32()), pa.array(own, pa.binary())], ["doc_id", "toxic", "at", "piece"])

    pieces = rows.where(~F.col("calibrates")).select(F.col("doc_id").cast("long"), "toxic", "text").mapInArrow(cut, "doc_id long, toxic int, at int, piece binary")
    size = {r["toxic"]: r["size"] for r in pieces.groupBy("toxic").agg(F.sum(F.length("piece")).alias("size")).collect()}
    chosen = {}
    for k in (0, 1):
        some = _cut(pieces.where(F.col("toxic") == k), size.get(k, 0), MAX_BYTES, "doc_id", "at")
        chosen[k] = some.orderBy("doc_id", "at").select("piece").toArrow()["piece"].to_pylist()
    dictionaries = train(chosen[0], chosen[1])
    counts = distances(rows.where("calibrates").select("toxic", "text"), dictionaries).toArrow()
    found, toxic = np.array(counts["counts"].to_pylist(), np.int64).reshape(-1, 2 * CLIP + 1), counts["toxic"].to_numpy()
    if len(set(toxic.tolist())) < 2:
        return {"share": ones / n}
    ratio, weight = calibrate(found, toxic, ones / n)
    return {"share": ones / n, "dictionaries": dictionaries, "ratio": ratio, "weight": weight}


def distances(rows: DataFrame, dictionaries: tuple[bytes, bytes]) -> DataFrame:
    """(toxic, text) rows: ``toxic, counts`` of the distances of the windows of every text."""
    sent = rows.sparkSession.sparkContext.broadcast(dictionaries)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Distance(sent.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([by.counts(t) for t in b.column(1).to_pylist()], pa.list_(pa.int64()))], ["toxic", "counts"])

    return rows.mapInArrow(measure, "toxic int, counts array<long>")


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        by = Distance(m["dictionaries"]) if "weight" in m else None
        for b in batches:
            texts = b.column(2).to_pylist()
            empty = np.array([not (t and t.strip()) for t in texts], bool)
            p = np.full(len(texts), m["share"])
            if by and texts:
                x = features(np.array([by.counts(t) for t in texts]), m["ratio"])
                p = 1 / (1 + np.exp(-np.clip(x @ m["weight"], -30, 30)))
            p[empty] = 0.0
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(judge, f"doc_id {kind}, held_out boolean, score double, predicted int"))


def op11_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
