"""Very long texts in linear time, and callers' columns of any name."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from featurekit.llm import common, decontaminate, html, mixing, pii, secrets, warc
from tests.conftest import SF_SMALL


def test_array_scan_in_stretches(spark):
    row = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(5000)), lambda x: x.cast("long")).alias("x"))
    got = row.select(common.scan_array(F.col("x"), F.lit(0).cast("long"), lambda a, x: a + x, lambda a, x: a * 2, "bigint").alias("y")).first().y
    assert got == [i * (i + 1) for i in range(5000)]
    assert spark.range(1).select(common.scan_array(F.array().cast("array<bigint>"), F.lit(0).cast("long"), lambda a, x: a + x, lambda a, x: a, "bigint").alias("y")).first().y == []


def _pii(docs):
    model = pii.PiiModel(thresholds=dict.fromkeys(range(pii.BASE, pii.BASE + len(pii.GENERATORS)), 0.9))     # adds nothing: without trees all score 0.5
    return pii.with_spans(docs, model).select(pii._text(F.col("__spans")).alias("spans"))


@pytest.mark.parametrize("piece,operator,kind", [("a@b.co ", _pii, "email:{}:{}"), ("token=abcdef ", secrets.scan_secrets, "assign:{}:{}")])
def test_many_matches_in_one_text(spark, piece, operator, kind):
    n = 64_000
    docs = spark.createDataFrame([(1, piece * n)], "doc_id long, text string")
    began = time.time()
    row = operator(docs).first()
    took = time.time() - began
    size = len(piece)
    assert row.spans == ",".join(kind.format(i * size, (i + 1) * size - 1) for i in range(n))
    assert took < 100            # quadratic work takes hours


def test_spans_apart(spark):
    spans = lambda xs: F.array(*[F.struct(F.lit(a).alias("s"), F.lit(b).alias("e")) for a, b in xs]) if xs else F.array().cast("array<struct<s:int,e:int>>")
    cases = [([(0, 5), (5, 9), (3, 4), (20, 30), (40, 41)], [(4, 5), (9, 20), (25, 26), (41, 50)]), ([(1, 2)], []), ([], [(1, 2)]), ([(2, 9)], [(2, 9)])]
    for own, others in cases:
        got = spark.range(1).select(common.apart_from(spans(own), spans(others)).alias("x")).first().x
        assert sorted((r.s, r.e) for r in got) == sorted(x for x in own if not any(o[0] < x[1] and x[0] < o[1] for o in others))


def test_many_secrets_are_masked(spark):
    docs = spark.createDataFrame([(1, "token=abcdef " * 20_000, 5)], "doc_id long, text string, n_chars long")
    row = secrets.redact_secrets(docs).first()
    assert row.text == "<SECRET> " * 20_000 and row.n_chars == len(row.text)


NAMES = ["__doc", "__n", "__w", "__spans", "__base", "__t", "__row", "__new", "__words", "__ids", "__token", "taken", "copies", "size", "n_words", "h", "win", "w"]


@pytest.fixture(scope="module")
def named(spark):
    texts = [None, "", "plain words of a text that stays as it is", "token=abcdef1234 and more words to read here", "AKIA" + "B" * 20 + " x y z"]
    rows = [(i, t, "en", "s", len(t or "")) + tuple(f"{c}-{i}" for c in NAMES) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in NAMES)
    return spark.createDataFrame(rows, schema)


def _own(df):
    return {r.doc_id: tuple(r[c] for c in NAMES) for r in df.collect()}


def test_values_of_clashing_columns(spark, named):
    want = _own(named)
    bench = spark.createDataFrame([(1, "words that no text holds")], "item_id long, text string")
    for out in (secrets.redact_secrets(named), decontaminate.drop_contaminated(named, bench), mixing.mix_documents(named)):
        kept = _own(out)
        assert kept and all(want[i] == v for i, v in kept.items())
        assert len(set(out.columns)) == len(out.columns) and all(out.schema[c].dataType.simpleString() == "string" for c in NAMES)
    assert {"mix_taken", "mix_copies"} < set(mixing.mix_documents(named).columns)
    for _, stage in corpus_pipeline.STAGES:
        kept = _own(stage(spark, named, SF_SMALL))
        assert all(want[i] == v for i, v in kept.items())


def test_pages_with_more_columns(spark):
    pages = spark.createDataFrame([(1, "http://a/b", "<p>text one</p>", "x", "y", 3)], "page_id long, url string, html string, host string, tokens string, classes int")
    assert [tuple(r) for r in html.extract_text(pages).collect()] == [(1, "http://a/b", "text one", 8)]
    assert warc.archive_pages(pages).first().page_id == 1
