"""Secret scans: sliding-window Shannon entropy per character class over candidate strings.

Base patterns (assignments, access keys, long hex runs) are regular expressions.  Besides them, every
maximal run of token characters is a candidate.  A window slides over the candidate's characters; the
counts of its characters are kept up as one enters and one leaves, so the entropy
``log2(W) - sum(c * log2(c)) / W`` costs one update per position (the counts are packed into a few numbers).  Hot windows of a candidate are joined
into spans.  Candidates on the allow list (identifiers, words) add nothing, nor do spans that base spans
already cover whole.  Placeholders and sequences cut a span: it stays if a piece between them, without repeats
of one character, is as long as the window.

One pass, no shuffle: spans are computed inside each row.  NULL and empty texts have no spans.  Rows are
treated one by one, so repeated rows come out repeated, and other columns are passed on.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import let, match_spans, scan_array, whole_row

KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base64"]
BASE = 3

_VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
          r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?(" + _VALUE + "+)")
ACCESS = "AKIA[A-Z0-9]+"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}+"        # the maximal runs of [0-9a-f]+ that are long enough

#: Candidates: maximal runs of token characters, no shorter than the window.
_TOKEN = "[A-Za-z0-9+/_=-]"
#: (kind, alphabet, least entropy in bits for a full window)
CLASSES = [("entropy_hex", "0123456789abcdef", 3.0),
           ("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=", 3.9)]
WINDOW = 24

#: Candidates that are no secrets: UUIDs, runs of one kind of character, snake or kebab words, paths of words.
ALLOW = ["^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", "^[A-Za-z_/=+-]+$", "^[0-9_/=+-]+$",
         "^[A-Za-z]*([_/-][A-Za-z]+)*[_/-]?[0-9]{0,4}$"]
#: Parts of spans that are no secrets: placeholders, alphabet or digit sequences; repeats of one character.
CUTS, REPEAT = "(?i)example|placeholder|changeme|your[_-]|abcdefgh|0123456789|1234567890", r"(.)\1{7,}"


_SPANS = "array<struct<s:int,e:int>>"


#: A window's counts are packed: SLOTS characters of 5 bits in a number (exact as a double), so a step writes few numbers.
SLOTS, BITS = 10, 32
_POWERS = [BITS ** k for k in range(SLOTS)]


def _entropy_spans(token: Column, alphabet: str, least: float, window: int = WINDOW) -> Column:
    """Spans within ``token`` whose windows reach ``least`` bits of entropy, joined where they touch."""
    if window >= BITS:
        raise ValueError(f"windows of fewer than {BITS} characters")
    powers, none = F.array(*[F.lit(p).cast("long") for p in _POWERS]), F.array().cast(_SPANS)

    def clogc(c: Column) -> Column:
        return F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))

    def number(c: Column) -> Column:
        return F.floor(c / SLOTS).cast("int")

    def power(c: Column) -> Column:
        return F.get(powers, F.pmod(c, F.lit(SLOTS)).cast("int"))

    def scan(chars: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            enter = F.get(chars, i)
            leave = F.when(i >= window, F.get(chars, i - window))            # NULL while the window fills
            count = lambda c: F.pmod(F.floor(F.get(a["n"], number(c)) / power(c)), F.lit(BITS))
            c_in, c_out = count(enter), count(leave)
            delta = clogc(c_in + 1) - clogc(c_in) + F.coalesce(clogc(c_out - 1) - clogc(c_out), F.lit(0.0))
            same = F.coalesce(enter == leave, F.lit(False))
            total = F.when(same, a["s"]).otherwise(a["s"] + delta)
            counts = F.when(same, a["n"]).otherwise(F.transform(a["n"], lambda v, k: (
                v + F.when(k == number(enter), power(enter)).otherwise(0) - F.coalesce(F.when(k == number(leave), power(leave)), F.lit(0)))))
            hot = (i >= window - 1) & (F.lit(math.log2(window)) - total / window >= least)
            start, end = i - (window - 1), i + 1
            goes_on = hot & (a["to"] >= start)
            ends = hot & ~goes_on & (a["to"] >= 0)                         # the array is copied once a span, not once a character
            return F.struct(counts.alias("n"), total.alias("s"),
                            F.when(hot & ~goes_on, start).otherwise(a["from"]).alias("from"), F.when(hot, end).otherwise(a["to"]).alias("to"),
                            F.when(ends, F.concat(a["out"], F.array(F.struct(a["from"].alias("s"), a["to"].alias("e")))))
                            .otherwise(a["out"]).cast(_SPANS).alias("out"))

        return F.aggregate(
            F.sequence(F.lit(0), F.size(chars) - 1),
            F.struct(F.array_repeat(F.lit(0).cast("long"), -(-len(alphabet) // SLOTS)).alias("n"), F.lit(0.0).alias("s"), F.lit(-1).alias("from"),
                     F.lit(-1).alias("to"), none.alias("out")),
            step, lambda a: F.when(a["to"] >= 0, F.concat(a["out"], F.array(F.struct(a["from"].alias("s"), a["to"].alias("e"))))).otherwise(a["out"]))

    return let(F.transform(F.split(token, ""), lambda ch: F.instr(F.lit(alphabet), ch) - 1), scan)


def _entropy(text: Column, base: Column) -> Column:
    """``array<struct<s,k,e>>`` of the method's spans: candidates, allow list, windows; without those that base spans cover."""
    candidate = f"(?<!{_TOKEN}){_TOKEN}{{{WINDOW},}}+"
    kept = lambda m: (m.rlike("[0-9]") & m.rlike("[A-Za-z]") & ~m.rlike("|".join(f"(?:{p})" for p in ALLOW)))
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")

    def spans(c: Column) -> Column:
        token = F.substring(text, c["s"] + 1, c["e"] - c["s"])
        is_hex = token.rlike("^[0-9a-fA-F]+$")
        (_, hex_alphabet, hex_least), (_, alphabet, least) = CLASSES
        found = (F.when(is_hex, _entropy_spans(F.lower(token), hex_alphabet, hex_least))
                 .otherwise(_entropy_spans(token, alphabet, least)))
        return F.transform(found, lambda f: F.struct(
            (c["s"] + f["s"]).alias("s"), F.when(is_hex, F.lit(BASE)).otherwise(F.lit(BASE + 1)).alias("k"),
            (c["s"] + f["e"]).alias("e")))

    def all_of(cands: Column) -> Column:
        found = F.flatten(F.transform(cands, spans))
        secret = lambda f: F.exists(F.split(F.substring(text, f["s"] + 1, f["e"] - f["s"]), CUTS),
                                    lambda x: F.length(F.regexp_replace(x, REPEAT, "")) >= WINDOW)
        # base spans are sorted by start: how far they cover the span from its start on
        covered = lambda f: F.aggregate(base, f["s"], lambda at, b: F.when(b["s"] <= at, F.greatest(at, b["e"])).otherwise(at)) >= f["e"]
        return F.filter(found, lambda f: secret(f) & ~covered(f))

    return let(match_spans(text, candidate, kept), lambda c: F.when(F.size(c) > 0, all_of(c)).otherwise(none))


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``__doc`` (the row), ``__base`` and ``__spans``: ``array<struct<s,k,e>>`` by start, then kind."""
    t = F.coalesce(F.col("__t"), F.lit(""))
    tag = lambda spans, k: F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))
    long_enough = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6
    base = F.array_sort(F.concat(tag(match_spans(t, ASSIGN, long_enough), 0),
                                 tag(match_spans(t, ACCESS, lambda m: F.length(m) >= 20), 1),
                                 tag(match_spans(t, HEX), 2)))
    return (docs.select(whole_row(docs), F.col(text).alias("__t")).withColumn("__base", base)
            .withColumn("__spans", F.array_sort(F.concat(F.col("__base"), _entropy(t, F.col("__base"))))))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans as text."""
    count = lambda k: F.size(F.filter("__base", lambda x: x["k"] == k)).cast("long")
    return with_spans(docs.select("doc_id", "text")).select(
        "__doc.doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_text(F.col("__base")), 256).alias("base_sha256"), _text(F.col("__spans")).alias("spans"))


def redact_secrets(docs: DataFrame, mask: str = "<SECRET>") -> DataFrame:
    """``docs`` with every span (overlapping ones joined) replaced by ``mask``; ``n_chars`` follows the text."""
    t, spans = F.col("__t"), F.col("__spans")

    def piece(at: Column, x: Column) -> Column:     # what stands before the span, then the mask; spans by start
        return F.when(x["s"] < at, F.lit("")).otherwise(F.concat(F.substring(t, at + 1, x["s"] - at), F.lit(mask)))

    pieces = scan_array(spans, F.lit(0), lambda at, x: F.greatest(at, x["e"]), piece, "string")
    masked = F.concat(F.array_join(pieces, ""), F.substring(t, F.array_max(F.transform(spans, lambda x: x["e"])) + 1, F.length(t)))
    found = F.size("__spans") > 0
    out = with_spans(docs).withColumn("__new", F.when(found, masked).otherwise(t))
    changed = {"text": F.col("__new"), "n_chars": F.when(found, F.length("__new").cast("long")).otherwise(F.col("__doc.n_chars"))}
    return out.select(*[changed[c].alias(c) if c in changed else F.col(f"__doc.`{c}`") for c in docs.columns])


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    from featurekit.llm.common import table

    return scan_secrets(table(spark, sf_dir, "documents"))
