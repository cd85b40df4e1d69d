"""Secrets in texts: fixed patterns and a battery of randomness tests, in DataFrame functions only.

Tokens that look encoded are tested against their null, an ordinary token of the same length in the same alphabet:
words for mixed alphabets, numbers for hexadecimal. Three tests are made of each: chi-squared for a uniform alphabet,
runs of characters of one kind, and serial correlation. Their p-values are combined by Fisher's method, and within each
band of lengths the Benjamini-Hochberg procedure picks the tokens that are too random to be ordinary. Short tokens carry
less evidence, so bands of their own keep them from borrowing it from long ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.llm.text import fresh, let
from comanda.session import cut_lineage

# Base patterns, fixed values.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_CHARS = 6
KINDS = ["assign", "access", "hex", "random"]

# Tokens for the battery: runs of at least so many characters, with base64 padding.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"


@dataclass(frozen=True)
class Encoding:
    """An alphabet, and the ordinary tokens written in it: sum of squares and of cubes of their letter shares."""

    name: str
    pattern: str
    alphabet: str
    squares: float
    cubes: float


# In the order in which they are tried. Letter shares: ten equal digits; English text.
ENCODINGS = [
    Encoding("hex", "^[0-9a-f]+$", "0123456789abcdef", 0.1, 0.01),
    Encoding("hex_upper", "^[0-9A-F]+$", "0123456789ABCDEF", 0.1, 0.01),
    Encoding("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.066, 0.0055),
    Encoding("base64", "^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.066, 0.0055),
]
SWITCH = 0.12  # how often the kind of character changes within ordinary tokens
DRIFT = 0.35  # serial correlation of counters, sorted and padded tokens
FALSE_DISCOVERIES = 0.01
BIN = 0.05  # width of a bin of -ln p
BINS = 4000


def _starts(lengths: Column, block: int = 256) -> Column:
    """Running sums before each element. In blocks, so that a text with very many matches stays near linear."""
    def run(values: Column, first: Column) -> Column:
        return F.aggregate(
            values, F.struct(first.cast("long").alias("at"), F.array().cast("array<bigint>").alias("out")),
            lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
            lambda a: a["out"])

    total = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block).cast("int")),
                         lambda i: F.slice(lengths, i * block + 1, F.lit(block)))
    return let(blocks, lambda b: let(run(F.transform(b, total), F.lit(0)), lambda first: F.flatten(
        F.zip_with(b, first, run))))


def _places(text: Column, found: Column, pattern: str, keep: Column | None = None) -> Column:
    """Array of (start, end) in code points of the matches ``found``, from the lengths of the gaps between them."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    sizes = F.transform(found, lambda x: F.length(x))
    spans = let(gaps, lambda g: let(sizes, lambda s: let(
        _starts(F.zip_with(F.slice(g, 1, F.size(s)), s, lambda a, b: a + b)),
        lambda at: F.transform(at, lambda a, i: F.struct(
            (a + F.get(g, i)).alias("start"), (a + F.get(g, i) + F.get(s, i)).alias("end"))))))
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))


def _log_upper(z: Column) -> Column:
    """ln P(Z > z) of the standard normal; Abramowitz and Stegun 26.2.17, whose factor keeps the far tail."""
    size = F.abs(z)
    t = 1 / (1 + 0.2316419 * size)
    poly = reduce(lambda a, b: (a * t) + b, [1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530], F.lit(0.0)) * t
    tail = -size * size / 2 - 0.5 * math.log(2 * math.pi) + F.log(poly)
    return F.when(z >= 0, tail).otherwise(F.log1p(-F.exp(tail)))


def _evidence(token: Column, e: Column) -> Column:
    """-ln of the combined p-value of a token in an encoding: how unlike an ordinary token it is."""
    n = F.length(token).cast("double")
    counts = F.aggregate(F.split(e["alphabet"], ""), F.lit(0.0), lambda a, c: a + F.pow(
        (F.length(token) - F.length(F.replace(token, c, F.lit("")))).cast("double"), F.lit(2.0)))
    usual = e["size"] * ((n - 1) * e["squares"] + 1) - n
    spread = e["size"] / n * F.sqrt(
        4 * n * (n - 1) * (n - 2) * F.greatest(e["cubes"] - e["squares"] * e["squares"], F.lit(0.0))
        + 2 * n * (n - 1) * (e["squares"] - e["squares"] * e["squares"]))
    uniform = (usual - (counts * e["size"] / n - n)) / spread

    kinds = F.regexp_count(token, F.lit("[A-Z]+|[a-z]+|[0-9]+|[+/]+")) - 1
    runs = (kinds - 0.5 - (n - 1) * SWITCH) / F.sqrt((n - 1) * SWITCH * (1 - SWITCH))

    codes = F.transform(F.split(token, ""), lambda c: F.instr(e["alphabet"], c).cast("double"))
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v)

    def drift(x: Column) -> Column:
        return let(total(x) / F.size(x), lambda mean: let(F.transform(x, lambda v: v - mean), lambda d: F.try_divide(
            total(F.zip_with(F.slice(d, 1, F.size(d) - 1), F.slice(d, F.lit(2), F.size(d) - 1), lambda a, b: a * b)),
            total(F.transform(d, lambda v: v * v)))))

    serial = (DRIFT - F.abs(F.coalesce(let(codes, drift), F.lit(1.0)))) * F.sqrt(n)
    y = -total(F.transform(F.array(uniform, runs, serial), _log_upper))
    return let(y, lambda v: v - F.log(1 + v + v * v / 2))  # Fisher: chi-squared with six degrees of freedom


def _battery(token: Column) -> Column:
    """(encoding, evidence) of a token by the first alphabet that fits; null for a token without letters."""
    plain = F.translate(F.regexp_replace(token, "=+$", ""), "-_", "+/")
    listed = F.array(*(F.struct(
        F.lit(e.name).alias("name"), F.lit(e.alphabet).alias("alphabet"), F.lit(float(len(e.alphabet))).alias("size"),
        F.lit(e.squares).alias("squares"), F.lit(e.cubes).alias("cubes")) for e in ENCODINGS))

    def choose(t: Column) -> Column:
        first = reduce(lambda a, i: F.when(t.rlike(ENCODINGS[i].pattern), i).otherwise(a), reversed(range(len(ENCODINGS))), F.lit(None))
        return F.when(t.rlike("[A-Za-z]"), let(F.get(listed, first), lambda e: F.when(e.isNotNull(), F.struct(
            e["name"].alias("encoding"), _evidence(t, e).alias("evidence")))))

    return let(plain, choose)


def scan(docs: DataFrame, text_col: str = "text", false_discoveries: float = FALSE_DISCOVERIES,
         keep_text: bool = False, spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans_col``: array of (start, kind, end, encoding) in code points, by start and kind.

    Without the text, what each row's tests gave is stored between the two passes; with it, nothing is stored and the
    tests run again, so that no text is written.
    ``kind`` is an index into ``KINDS``. Null and empty texts have no spans; every row is scanned on its own, so
    repeated rows, null ids and other columns don't matter. Tokens that a base pattern covers are not reported again.
    """
    names = {k: fresh(docs, f"m_{k}") for k in ("assign", "value", "access", "hex", "token")}
    body = fresh(docs, "body")
    col = {k: F.col(n) for k, n in names.items()}
    text = F.col(body)
    keep = [F.col(f"`{c}`") for c in docs.columns if keep_text or c != text_col]
    found = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias(body))
    all_of = lambda pattern, group=0: F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    found = found.withColumns({
        names["assign"]: all_of(ASSIGN), names["access"]: all_of(ACCESS), names["hex"]: all_of(HEX),
        names["token"]: all_of(TOKEN),
    })
    found = found.withColumn(names["value"], F.when(F.size(col["assign"]) > 0, all_of(ASSIGN, 2)))

    def spans(kind: str, pattern: str) -> Column:
        return F.transform(_places(text, col[kind], pattern), lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"),
            F.lit(None).cast("string").alias("encoding")))

    long_enough = F.when(F.size(col["assign"]) > 0, let(spans("assign", ASSIGN), lambda s: F.filter(
        s, lambda x, i: F.length(F.get(col["value"], i)) >= ASSIGN_CHARS))).otherwise(spans("assign", ASSIGN))
    base = F.sort_array(F.concat(long_enough, spans("access", ACCESS), spans("hex", HEX)))
    tested = F.when(F.size(col["token"]) > 0, let(F.transform(col["token"], _battery), lambda b: F.zip_with(
        _places(text, col["token"], TOKEN), b, lambda s, x: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), x["encoding"].alias("encoding"),
            x["evidence"].alias("evidence")))))
    out_base, out_tested = fresh(docs, "base_spans"), fresh(docs, "tested")
    narrow = found.select(*keep, base.alias(out_base), F.filter(
        F.coalesce(tested, F.array().cast("array<struct<start:bigint,end:bigint,encoding:string,evidence:double>>")),
        lambda x: x["evidence"].isNotNull()).alias(out_tested))
    if not keep_text:
        narrow = cut_lineage(narrow)

    band = lambda s: F.floor(F.log2(s["end"] - s["start"])).cast("int")
    limits = dict(_limits(narrow.select(F.explode(out_tested).alias("s")).select(
        band(F.col("s")).alias("band"), F.col("s.evidence").alias("evidence")), false_discoveries))
    needed = F.create_map(*(F.lit(x) for kv in limits.items() for x in kv)) if limits else None

    def discovered(s: Column) -> Column:
        enough = F.lit(False) if needed is None else F.coalesce(
            s["evidence"] >= F.element_at(needed, band(s)), F.lit(False))
        return enough & ~F.exists(F.col(out_base), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    added = F.transform(F.filter(F.col(out_tested), discovered), lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), s["end"].alias("end"),
        s["encoding"].alias("encoding")))
    return narrow.select(*keep, F.sort_array(F.concat(F.col(out_base), added)).alias(spans_col))


def _limits(tested: DataFrame, false_discoveries: float) -> list[tuple[int, float]]:
    """For each band of lengths the evidence from which a token is a discovery.

    Benjamini-Hochberg over all tested tokens, on counts by bins of evidence: few numbers for each band (a band is a
    power of two of the length), whatever the number of tokens. Rounding down to bins is on the safe side.
    """
    bins = tested.groupBy("band", F.least(F.floor(F.col("evidence") / BIN), F.lit(BINS)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"))
    above = F.sum("rows").over(W.partitionBy("band").orderBy(F.desc("bin")))
    every = F.sum("rows").over(W.partitionBy("band"))
    good = bins.withColumns({"above": above, "every": every}).filter(
        (F.col("bin") > 0) & (F.col("every") * F.exp(-F.col("bin") * BIN) <= false_discoveries * F.col("above")))
    return [(r["band"], r["bin"] * BIN) for r in good.groupBy("band").agg(F.min("bin").alias("bin")).collect()]


def span_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(docs: DataFrame, text_col: str = "text", by: str = "<secret>") -> DataFrame:
    """``docs`` with every secret in its text replaced; overlapping spans become one. Other rows stay as they are."""
    spans_col = fresh(docs, "spans")
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def merge(a: Column, s: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        joined = F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(a) > 0) & (s["start"] < F.try_element_at(a, F.lit(-1))["end"]), joined).otherwise(
            F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    text = F.col(text_col)

    def cut(merged: Column) -> Column:
        pieces = F.transform(merged, lambda s, i: F.concat(
            text.substr((F.coalesce(F.get(merged, i - 1)["end"], F.lit(0)) + 1).cast("int"),
                        (s["start"] - F.coalesce(F.get(merged, i - 1)["end"], F.lit(0))).cast("int")),
            F.lit(by)))
        rest = text.substr((F.element_at(merged, -1)["end"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(pieces, ""), rest)

    masked = F.when(F.size(spans_col) > 0, let(F.aggregate(F.col(spans_col), empty, merge), cut)).otherwise(text)
    return scan(docs, text_col, keep_text=True, spans_col=spans_col).select(
        *(masked.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
