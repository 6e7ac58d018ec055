"""Token alignment against tokens and byte offsets worked out plainly."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from featurekit.llm import align, common

FILES = [open(f"{align.TOKENIZERS}/{f}", "rb").read() for f in (align.A_FILE, align.B_FILE)]
ODD = ["", None, "  two  spaces ", "\n lead", "x▁y", "<|endoftext|> <s> a <unk>", "日本語 テキスト です", " ", "\t", "a\x00b c", "é́ ñ ﬁ ² ½", "👍🏽 x 👍", "a" * 5000 + " b",
       "word " * 3000, "   " * 1500 + "x", "don't we'll  they 've", "　 x", "a b   c", "the same", "the same", "x͸y ٣٤ ①", "- -- --- ..."]


@pytest.fixture(scope="module")
def tokenizers():
    return align.Tokenizers(*FILES)


def plain(t, text):
    """(n_a, n_b, groups, linked pairs), or None without tokens."""
    a, b = t.whole.encode(" " + (text or ""), add_special_tokens=False).ids, t.pieces.encode(text or "")
    ab, bb, raw = [t.a[i] for i in a], [t.b[i] for i in b], b" " + (text or "").encode()
    if not text or b"".join(ab) != raw or b"".join(bb) != raw:
        return None
    ends = [np.cumsum([len(x) for x in part]).tolist() for part in (ab, bb)]
    groups, pairs, i, j = [], [], 0, 0
    for e in sorted(set(ends[0]) & set(ends[1])):
        x, y = ends[0].index(e), ends[1].index(e)
        groups.append(",".join(map(str, a[i:x + 1])) + "|" + ",".join(map(str, b[j:y + 1])))
        pairs.append((a[x], b[y]))
        i, j = x + 1, y + 1
    return len(a), len(b), ";".join(groups), pairs


def test_windows_equal_whole_documents(tokenizers, documents_text, monkeypatch):
    texts = [t for t in ODD if t is not None] + documents_text
    for memo in (align.MEMO, 3):
        monkeypatch.setattr(align, "MEMO", memo)
        aligner = align.Aligner(tokenizers)
        got = [x for k in range(0, len(texts), 40) for x in aligner.align(texts[k:k + 40])]
        for text, found in zip(texts, got, strict=True):
            want = plain(tokenizers, text)
            assert (found is None) == (want is None), text[:40]
            if want:
                assert found[:3] == want[:3] and [(p & 0xFFFFFFFF, p >> 32) for p in found[3].tolist()] == want[3], text[:40]


def test_whole_texts_where_pieces_cross_spaces(tokenizers):
    texts = [t for t in ODD if t]
    apart = align.Aligner(tokenizers).align(texts)
    tokenizers.apart = False
    try:
        whole = align.Aligner(tokenizers).align(texts)
    finally:
        tokenizers.apart = True
    assert [x and x[:3] for x in apart] == [x and x[:3] for x in whole]


def test_quick_ids_are_those_of_the_file(tokenizers):
    plain_letters = [*range(1, 0x250), *range(0x2010, 0x2028), 0x20AC, 0x3041, 0x30FA, 0x4E00]
    for c in map(chr, plain_letters):
        for text in (c, f"a{c}b", f"1 {c}{c} x", f" {c}\n{c}'s"):
            if align.plain(text):
                assert tokenizers.quick.encode_ordinary(" " + text) == tokenizers.whole.encode(" " + text, add_special_tokens=False).ids
    assert not align.plain("x͸y") and not align.plain("a" * 3000) and align.plain("a " * 3000)


@pytest.fixture(scope="module")
def documents_text(spark):
    from tests.conftest import SF_SMALL

    return [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect() if r.text]


@pytest.mark.parametrize("sent", [common.BROADCAST_BYTES, 0])      # 0: the pair counts come by a shuffle
def test_counts_of_the_corpus(spark, tokenizers, monkeypatch, sent):
    monkeypatch.setattr(common, "BROADCAST_BYTES", sent)
    rows = [(i if i != 3 else None, t, 1, "x", "y") for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pair int, row string, n string").repartition(3)
    want = [plain(tokenizers, t) for t in ODD]
    count = Counter(p for w in want if w for p in w[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    expected = []
    for (i, *_), w in zip(rows, want, strict=True):
        n_a, n_b, groups, pairs = w or (0, 0, None, [])
        expected.append((i, n_a, n_b, len(pairs), len(pairs), sum(count[p] == most[p[1]] for p in pairs), sum(count[p] for p in pairs),
                         hashlib.sha256(groups.encode()).hexdigest() if w else ""))
    assert Counter(map(tuple, align.align_tokens(docs).collect())) == Counter(expected)
    assert align.align_tokens(docs.limit(0)).count() == 0
