"""Text operators against brute force on the smallest tables, and on awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from featurekit.llm import chat, decontaminate, html, jaccard, language, mixing, pii, quality, secrets, warc
from featurekit.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, __w string, n_words int"
LONG = " ".join(f"w{i % 977}" for i in range(30000))
AWKWARD = [
    (1, None, None, None, None, "x", "y", 1), (2, "", "en", "", 0, None, None, None), (None, "a b c d e", "en", "s", 9, "x", "y", 1),
    (3, "one two three", "en", "s", 13, "x", "y", 1), (3, "one two three", "en", "s", 13, "x", "y", 1), (4, "one TWO three", None, "s", 13, "x", "y", 1),
    (5, LONG, "de", "t", len(LONG), "x", "y", 1), (6, LONG + " z", "de", "t", None, "x", "y", 1), (7, "...\n\n \t", "fr", "u", 7, "x", "y", 1),
    (8, "token: abcdef1 AKIA" + "A" * 16 + " " + "0a" * 12 + " a@b.c_d@e.f 1.2.3.4.5 4111 1111-1111 1111 +1 (555) 123-4567", "en", "s", 90, "x", "y", 1),
    (9, "9" * 20000 + " +" + "1-" * 9000 + " " + "a" * 20000 + "@", "es", "v", 1, "x", "y", 1)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT * FROM '{SF_SMALL}/documents.parquet'").fetchall()


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def spans_text(names, spans):
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans))


def base_secrets(t):
    assign = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    return ([(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
            + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
            + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])


def luhn(d):
    return sum((v * 2 - 9 if v > 4 else v * 2) if i % 2 else v for i, v in enumerate(map(int, reversed(d)))) % 10 == 0


def base_pii(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)] if len(t) < 50_000 else []
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if len(t) < 50_000 and all(int(x) < 256 for x in m[0].split("."))]
    for k, rx, least, most in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(rx, t):
            d = re.sub("[^0-9]", "", m[0])
            if least <= len(d) <= most and (k == 3 or luhn(d)):
                out.append((m.start(), k, m.end()))
    return out


@pytest.mark.parametrize("operator,base,names", [(secrets.scan_secrets, base_secrets, secrets.KINDS), (pii.find_pii, base_pii, pii.KINDS)])
def test_base_spans(spark, awkward, documents, operator, base, names):
    for df, texts in ((awkward, [r[:2] for r in AWKWARD]), (spark.read.parquet(f"{SF_SMALL}/documents.parquet"), [r[:2] for r in documents])):
        rows = operator(df).collect()
        want = Counter((i, sha(spans_text(names, base(t or "")))) for i, t in texts)
        assert Counter((r.doc_id, r.base_sha256) for r in rows) == want
        text = dict(texts)
        for r in rows:     # base spans stay among all spans
            assert set(filter(None, spans_text(names, base(text[r.doc_id] or "")).split(","))) <= set(r.spans.split(","))


def test_obfuscated_personal_data(spark):
    rng = random.Random(5)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    hexes = lambda n: ":".join("".join(rng.choices("0123456789abcdef", k=n)) for _ in range(8))
    forms = [lambda: (f"ann{digits(2)} (at) mail (dot) org", "address"), lambda: (f"bob{digits(3)}[at]host{digits(1)}.example[dot]net", "address"),
             lambda: (f"eve @ mail{digits(2)} . com", "address"), lambda: (f"+49/30/{digits(7)}", "digits"),
             lambda: (hexes(4), "dotted"), lambda: (f"x{digits(2)}@mail.org", None), lambda: (f"1{digits(2)}.2.{digits(2)}.9.{digits(1)}.7", None),
             lambda: (f"{digits(6)}", None), lambda: (f"see you @ home{digits(1)}", None)]
    rows, want = [], {}
    for i in range(900):
        text, kind = forms[i % len(forms)]()
        rows.append((i, f"please write to {text}. Then wait"))
        if kind:
            want[i] = f"{kind}:16:{16 + len(text)}"
    got = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    found = sum(w in got[i].split(",") for i, w in want.items())
    wrong = [i for i, x in got.items() if i not in want and any(s.split(":")[0] in pii.KINDS[pii.BASE:] for s in x.split(",") if s)]
    assert found >= 0.95 * len(want) and len(wrong) <= 0.05 * len(rows)
    # candidates of one label alone
    only = spark.createDataFrame([r for r in rows if r[0] % len(forms) == 0], "doc_id long, text string")
    assert all(r.spans == want[r.doc_id] for r in pii.find_pii(only).collect())


def test_entropy_spans(spark):
    rows = [(1, "key Zx9Qw7Er5Ty3Ui1Op0As2Df4Gh6Jk8Lz5Xc3 end"), (2, "550e8400-e29b-41d4-a716-446655440000"), (3, "a" * 40 + "1"), (4, "some_snake_case_identifier_2024")]
    got = {r.doc_id: r.spans for r in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got == {1: "entropy_base64:4:40", 2: "", 3: "hex:0:41", 4: ""}
    # the incremental counts against entropies from scratch
    tok = "0123abcdAB+/xyzXYZ987654qwertyQWERTY==" * 3
    w, (_, alphabet, least) = secrets.WINDOW, secrets.CLASSES[1]
    hot = [i for i in range(len(tok) - w + 1) if -sum(c / w * math.log2(c / w) for c in Counter(tok[i:i + w]).values()) >= least]
    found = spark.createDataFrame([(tok,)], "t string").select(secrets._entropy_spans(F.col("t"), alphabet, least).alias("x")).first().x
    assert {p for s, e in found for p in range(s, e)} == {p for i in hot for p in range(i, i + w)}


def test_secrets_beside_base_spans_and_placeholders(spark):
    key = "Zx9Qw7Er5Ty3Ui1Op0As2Df4Gh6Jk8LzVcBnMqWe"
    texts = {1: f"see /hooks/{'0a1b2c3d4e5f6789' * 2}/{key} now", 2: f"see /example/{key} now", 3: f"see {key}AAAAAAAA{key[::-1]} now",
             4: f"see {key[:20]}AAAAAAAA{key[20:]} now", 5: "see your-Key9Qw7Er5Ty3-example-Zx8 now",
             6: "see ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/ now", 7: f"token={key} now"}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    spans = {r.doc_id: r.spans for r in secrets.scan_secrets(df).collect()}
    masked = {r.doc_id: r.text for r in secrets.redact_secrets(df).collect()}
    pieces = [p for k in (key, key[::-1]) for p in (k[i:i + 8] for i in range(len(k) - 7))]
    assert all("entropy_base64" in spans[i] and not any(p in masked[i] for p in pieces) for i in (1, 2, 3, 4))
    assert spans[5] == spans[6] == "" and spans[7] == f"assign:0:{6 + len(key)}"


def test_redaction_keeps_columns(awkward):
    out = secrets.redact_secrets(awkward)
    assert out.columns == awkward.columns
    row = out.where("doc_id = 8").first()
    assert "AKIA" not in row.text and "abcdef1" not in row.text and row.n_chars == len(row.text)


def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in sets}
    changed = True
    pairs = [(a, b) for x, (a, s) in enumerate(sets) for b, t in sets[:x] if s and t and 100 * len(s & t) >= 85 * len(s | t)]
    while changed:
        changed = False
        for a, b in pairs:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    return {i: (len(s), label[i]) for i, s in sets}


def test_jaccard_components(spark, documents):
    base = [f"w{i * 7 % 90}" for i in range(90)]
    rows = [r[:2] for r in documents] + [(10_000, None), (10_001, ""), (10_002, "x y"), (10_003, "X  y"), (10_004, LONG), (10_005, LONG + " tail")]
    # near copies around the threshold, and short sets, where one shingle decides
    for e in range(40):
        w = list(base)
        for k in range(e % 6):
            w[(e * 11 + k * 17) % 90] = f"new{e}_{k}"
        rows.append((20_000 + e, " ".join(w)))
    rows += [(30_000 + n, " ".join(f"t{i}" for i in range(n))) for n in range(1, 40)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_near_copies_go_once(awkward):
    out = jaccard.drop_near_copies(awkward)
    assert out.columns == awkward.columns
    ids = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert ids[4] == 0 and ids[6] == 0 and ids[1] == ids[2] == ids[None] == 1 and ids[5] == 1


def test_one_row_of_each_group(spark, awkward):
    assert Counter(r.doc_id for r in jaccard.drop_near_copies(awkward).collect())[3] == 1
    long = " ".join(f"v{i}" for i in range(60))
    rows = [(1, "p q r s t"), (1, "p q r s t"), (None, "p Q r s t"), (None, "a b c"), (None, "A b c"), (None, "a b c"), (None, "d e f"),
            (7, long), (8, long + " x"), (8, "its own text"), (9, ""), (9, ""), (None, None)]
    out = jaccard.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = Counter((r.doc_id, (r.text or "").lower()) for r in out)
    assert got == {(1, "p q r s t"): 1, (None, "a b c"): 1, (None, "d e f"): 1, (7, long): 1, (8, "its own text"): 1, (9, ""): 2, (None, ""): 1}


def test_quality(spark, awkward, documents):
    for df, texts in ((awkward, [r[:2] for r in AWKWARD]), (spark.read.parquet(f"{SF_SMALL}/documents.parquet"), [r[:2] for r in documents])):
        want = []
        for i, t in texts:
            t = t or ""
            w = WORD.findall(t)
            wins = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
            often = Counter(wins)
            cover = {p for k, x in enumerate(wins) if often[x] > 1 for p in range(k, k + 8)}
            lines = [x for x in t.split("\n") if WORD.search(x)]
            want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover),
                         len(w) < 20 or 100 * len(cover) > 30 * len(w)))
        got = quality.quality_report(df).collect()
        assert Counter(tuple(r)[:7] for r in got) == Counter(want)
        assert all(not r.kept for r in got if r.base_failed)


def test_boilerplate_lines_and_copies(spark):
    own = lambda i: " ".join(f"u{i}x{k}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(30))
    rows = [(i, f"{own(i)}\nShared  LINE {i % 3}", "a") for i in range(15)]            # boilerplate: digits folded
    rows += [(100 + i, "copied text " + own(0), "b") for i in range(30)]                # copies: not boilerplate
    rows += [(200, own(200) + "\nshared line 1", "c")]                                  # another host
    rows += [(300 + i, "menu one two\n" * 1 + "shared line 0 and much more of the same thing", "d") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text").cast("long"))
    out = {r.doc_id: r for r in quality.quality_filter(df).collect()}
    assert all("line" not in out[i].text.lower() and out[i].n_chars == len(out[i].text) for i in range(15))
    assert all(100 + i in out for i in range(30)) and "shared line" in out[200].text
    common = [f"common line {chr(97 + k)} with so many words that it weighs" for k in range(26)]
    depleted = spark.createDataFrame([(i, "\n".join(random.Random(i).sample(common, 5)) + f"\nonly {own(i)[:5]}", "e")
                                      for i in range(300)], "doc_id long, text string, source string")
    assert quality.quality_report(depleted).where("kept").count() == 0


def test_templates_of_any_size_and_near_copies(spark):
    rng = random.Random(3)
    line = lambda n=12: " ".join("".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(n))
    rows, templates, copies = [], {}, {}
    for t, o in ((5, 1), (8, 2), (20, 3), (30, 2)):                     # t template lines and o own lines
        shared = [line() for _ in range(t)]
        for k in range(60):
            own = [line() for _ in range(o)]
            templates[len(rows)] = own
            rows.append((len(rows), "\n".join(shared[:t // 2] + own + shared[t // 2:]), f"t{t}"))
    for size in (3, 4, 5):                                              # near copies: one word of one line is another
        page = [line().split() for _ in range(size)]
        for fixed in (False, True):                                     # of any line, or always of the second
            for k in range(60):
                edited = [list(x) for x in page]
                edited[1 if fixed else rng.randrange(size)][rng.randrange(12)] = f"new{line(1)}"
                copies[len(rows)] = text = "\n".join(" ".join(x) for x in edited)
                rows.append((len(rows), text, f"c{size}{fixed}"))
    mixed = line()                                                      # a boilerplate line, also on a page copied nearly many times
    page = [line().split() for _ in range(4)]
    for k in range(75):
        edited = [list(x) for x in page]
        edited[rng.randrange(4)][rng.randrange(12)] = f"new{line(1)}"
        text = line(30) if k < 15 else "\n".join(" ".join(x) for x in edited)
        copies[len(rows)] = text
        rows.append((len(rows), f"{text}\n{mixed}", "m"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    gone = {r.h for r in quality.boilerplate_lines(df).collect()}
    by_line = df.select("doc_id", F.posexplode(F.split("text", "\n"))).join(df.select(
        "doc_id", F.posexplode(quality._hashes(F.col("text"), F.col("source"))).alias("pos", "h")), ["doc_id", "pos"]).collect()
    left = {i: [] for i, _, _ in rows}
    for r in sorted(by_line, key=lambda r: r.pos):
        if r.h not in gone:
            left[r.doc_id].append(r["col"])
    assert all(left[i] == own for i, own in templates.items())
    assert all(left[i] == text.split("\n") for i, text in copies.items())
    kept = {r.doc_id for r in quality.quality_report(df).where("kept").collect()}
    assert set(copies) <= kept and not kept & {i for i, own in templates.items() if rows[i][2] in ("t20", "t30")}


def test_decontamination(spark, awkward):
    items = spark.createDataFrame([(1, "one two three"), (2, " ".join(LONG.split()[500:540])), (2, None), (None, "a b c d e"), (4, "")], "item_id long, text string")
    got = Counter(tuple(r) for r in decontaminate.contamination(awkward, items).select("doc_id", "n_hit", "n_items", "contaminated").collect())
    assert got[(3, 3, 1, True)] == 2 and got[(4, 3, 1, True)] == 1 and got[(None, 5, 0, True)] == 1 and got[(1, 0, 0, False)] == 1
    wins = LONG.split()[500:540]
    w = LONG.split()
    cover = {p for k in range(28) for i in range(len(w) - 12) if w[i:i + 13] == wins[k:k + 13] for p in range(i, i + 13)}
    assert got[(5, len(cover), 1, 20 * len(cover) >= len(w))] == 1
    out = decontaminate.drop_contaminated(awkward, items)
    assert out.columns == awkward.columns and {r.doc_id for r in out.collect()} >= {1, 2, 7}


def test_mix(awkward):
    rows = mixing.mix_report(awkward).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert math.isclose(sum(t for _, t in {(r.source_size, r.target) for r in rows}),
                        sum(r.size for r in rows), rel_tol=1e-6)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_report(awkward.repartition(7)).collect()))
    assert set(mixing.mix_documents(awkward).columns) == {*awkward.columns, "taken", "copies"}


def test_chat_round_trip(spark):
    rows = [(1, 0, "system", "S \\ <| x"), (1, 1, "us\ner", "a\\<\\|b <|im_end|>\n"), (1, 2, "assistant", None), (1, 2, "assistant", ""), (None, None, None, None),
            (1, 3, "assistant", "tail " * 300), (1, 4, "user", "q"), (1, 5, "assistant", "end <|im_start|>")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    for budget, history in ((5, 2), (20, 5), (10_000, 0)):
        got = sorted(chat.read_windows(chat.format_windows(df, budget, history)).where("conv_id = 1").collect(), key=lambda r: r.window)
        want = sorted((t, r or "", x or "") for c, t, r, x in rows if c == 1)
        assert [(t.role, t.text) for w in got for t in w.turns] == [(r, x) for _, r, x in want]
        assert "".join(a for w in got for a in w.answers) == "".join(x for _, r, x in want if r == "assistant")
    many = chat.format_windows(df, 5, 2).where("conv_id = 1").orderBy("window").collect()
    assert len(many) > 1 and all(w.formatted.startswith("<|im_start|>system") for w in many) and all(w.n_context >= 1 for w in many[1:])


def test_warc(spark):
    body = "x" * 120 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, None, None), (2, "http://a b/", body), (3, "", body), (3, "u", body), (None, "u", "é" * 60), (9, "u", ""), (10, "u", "short"), (11, "u", "short")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = Counter(tuple(r) for r in warc.archive_pages(df).collect())
    row = lambda i, h, kind, to: (i, len((h or "").encode()), sha(h or ""), kind, to)
    assert got == Counter([row(1, "", "response", None), row(2, body, "response", None), row(3, body, "revisit", 2), row(3, body, "revisit", 2),
                           row(None, "é" * 60, "response", None), row(9, "", "response", None), row(10, "short", "response", None), row(11, "short", "response", None)])


def test_arc_versions_and_lengths():
    import gzip
    data = warc._version_block(1).encode() + b"http://a/ 1.2.3.4 20200101000000 text/html 5\nab\ncd\n" + warc._version_block(2).encode()
    data += b"http://b/ 1.2.3.4 20200101000000 text/html 200 - - 0 f.arc 3\nxyz\n"
    assert [(v, x["URL"], b) for _, v, x, b in warc._arc_records(gzip.compress(data))] == [(1, "http://a/", b"ab\ncd"), (2, "http://b/", b"xyz")]
    with pytest.raises(ValueError):
        list(warc._arc_records(gzip.compress(data[:-3])))


def test_html(spark):
    page = ('<html><head><title>t</title></head><body><header>Top</header><nav><ul><li>m</ul></nav><div class="cookie-notice">We</div><main><h1>T&amp;t</h1>'
            '<p>a&nbsp; b<br>c<script>var x="</p>";</script></p><ul><li>x<li>y</ul><div class="ad">buy</div><form>q</form>'
            '<section class="comments"><article class="comment">c1</article></section></main><aside>s</aside><footer>f</footer>')
    rows = [(1, "http://h/1", page), (2, None, None), (3, "", ""), (3, "", ""), (4, "x", "plain &lt;b&gt; <b>t</b>")]
    rows += [(10 + i, f"http://k/{i}", f"<body><div>Site menu text</div><div>Body number {'abcdefgh'[i]} of text</div></body>") for i in range(8)]
    got = {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "T&t\na b c\nx\ny" and got[2] == got[3] == "" and got[4] == "plain <b> t"
    assert all(got[10 + i] == f"Body number {'abcdefgh'[i]} of text" for i in range(8))       # the template's text is no slot


def test_language(spark, awkward, documents):
    rows = language.identify_languages(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    lang = {r[0]: r[2] for r in documents}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in rows)
    odd = {r.doc_id: r for r in language.identify_languages(awkward).collect()}
    assert len(odd) == 10 and all(odd[i].lang_pred == "und" for i in (1, 2, 7))


def test_language_beyond_the_broadcast_bound(spark, awkward, monkeypatch):
    for df in (spark.read.parquet(f"{SF_SMALL}/documents.parquet"), awkward):
        key = lambda r: (str(r.doc_id), r.held_out, r.lang_pred, r.score)
        want = sorted(language.identify_languages(df).collect(), key=key)
        with monkeypatch.context() as m:
            m.setattr(language, "MODEL_BYTES", 50)
            got = sorted(language.identify_languages(df).collect(), key=key)
        assert [tuple(r)[:3] for r in got] == [tuple(r)[:3] for r in want]
        assert [r.score for r in got] == pytest.approx([r.score for r in want], abs=1e-3)


def test_code_lengths():
    import pyarrow as pa
    texts = [("en", "the cat that"), ("de", "der die das hat"), ("fr", "le la les ça")]
    batch = pa.RecordBatch.from_arrays([pa.array([a for a, _ in texts]), pa.array([b for _, b in texts])], ["l", "t"])
    model = language.freeze(pa.Table.from_batches(list(language._count(iter([batch])))))
    seen = {a: defaultdict(Counter) for a, _ in texts}
    coded = lambda t: bytes(3) + t.encode().translate(language._BYTES)
    for a, t in texts:
        b = coded(t)
        for i in range(3, len(b)):
            for k in range(4):
                seen[a][b[i - k:i]][b[i]] += 1

    def bits(a, t):
        b, total = coded(t), 0.0
        for i in range(3, len(b)):
            for k in (3, 2, 1, 0):
                if c := seen[a].get(b[i - k:i]):
                    n, d = sum(c.values()), len(c)
                    if b[i] in c:
                        total += math.log2((n + d) / c[b[i]])
                        break
                    total += math.log2((n + d) / d)
            else:
                total += 8
        return total

    asked = ["the hat", "", "das ist ça", "zz xyz the"]
    got = language._bits_of(model, [t.encode().translate(language._BYTES) for t in asked])
    assert [[pytest.approx(bits(a, t), abs=1e-3) for a in model["langs"]] for t in asked] == got.tolist()


EMPTY = [secrets.scan_secrets, jaccard.jaccard_components, quality.quality_report, pii.find_pii, mixing.mix_report, language.identify_languages]


@pytest.mark.parametrize("operator", EMPTY, ids=lambda f: f.__name__)
def test_empty_tables(awkward, operator):
    assert operator(awkward.limit(0)).collect() == []


def test_empty_pages_and_stages(spark, awkward):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.extract_text(pages).collect() == [] and warc.archive_pages(pages).collect() == []
    assert chat.chat_report(spark.createDataFrame([], "conv_id int, turn int, role string, text string")).collect() == []
    assert decontaminate.contamination(awkward.limit(0), awkward.limit(0).withColumnRenamed("doc_id", "item_id")).collect() == []


def test_stages(spark, awkward):
    for df in (awkward, awkward.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, df, SF_SMALL).columns == df.columns


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "taken", "copies"]
    assert 0 < out.count() == out.select("doc_id").distinct().count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    norm = lambda cols, rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for _, v in sorted(zip(cols, r, strict=True))) for r in rows), key=repr)
    df, res = QUERIES[name](spark, SF_SMALL), con.sql(ORACLES[name])
    assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(res.columns, res.fetchall())
