"""Quality rules whose cutoffs carry a risk guarantee, in DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.llm.text import fresh, let, remainder, small, words
from comanda.session import cut_lineage

# Base rule, fixed values.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"
NOT_SPACE = r"[^\x20\x09-\x0D]"

#: The signals that get a cutoff, and whether large or small values are bad.
SIGNALS = {
    "symbol_rate": "high",      # symbols per character of a word
    "dup_line_rate": "high",    # repeated lines per line with a word
    "repeat_rate": "high",      # words in repeated 3-word windows, per word
    "upper_rate": "high",       # capital letters per character of a word
}


@dataclass(frozen=True)
class Risk:
    """Of the good documents of a stratum, all rules together reject more than ``false_rejects`` with a
    probability of at most ``doubt``, over all strata and cutoffs tried."""

    false_rejects: float = 0.03
    doubt: float = 0.05
    quantiles: tuple[float, ...] = (0.95, 0.98, 0.99, 0.995, 0.998, 1.0)
    min_gain: float = 0.02  # a rule must reject this share of the bad rows at least


def signals(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with the counts of the base rule and the signals, in one pass and without a shuffle.

    Null and empty texts have no words and all counts 0. Words in repeated windows are found by sorting the windows'
    64-bit hashes with their places, and adding up how far each repeated window reaches beyond the one before.
    """
    w, lines, seen = (fresh(docs, c) for c in ("w", "lines", "repeated"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(F.col(w), i), F.get(F.col(w), i + 1), F.get(F.col(w), i + 2)),
    )

    def repeated_places(hashes: Column) -> Column:
        """Places, in order, of the windows found twice or more."""
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda s: F.sort_array(F.transform(
            F.filter(
                F.transform(s, lambda x, i: F.struct(
                    x["i"].alias("i"),
                    (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
                lambda x: x["twice"]),
            lambda x: x["i"])))

    places = F.when(F.size(w) >= 3, let(windows, lambda h: F.when(
        F.size(h) > F.size(F.array_distinct(h)), repeated_places(h))))
    covered = F.aggregate(
        F.col(seen), F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"])
    out = (
        docs.withColumn(w, words(F.col(text_col)))
        .withColumn(lines, F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE)))
        .withColumn(seen, places)
    )
    keep = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    counts = out.select(
        *keep,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
    )
    rate = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return counts.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "symbol_rate": rate("n_symbols", "word_chars"),
        "dup_line_rate": rate("n_dup_lines", "n_lines"),
        "repeat_rate": rate("n_repeat_words", "n_words"),
        "upper_rate": rate("n_upper", "word_chars"),
    })


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series shifted by eight (error below 1e-13)."""
    x = n.cast("double") + 9.0
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    shift = reduce(lambda a, i: a * (n.cast("double") + i), range(2, 9), n.cast("double") + 1.0)
    return series - F.log(shift)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exact; 1 where k >= n * p, which no test here asks about.

    Summed downwards from k: below the mean the terms shrink, and the sum ends within some standard deviations.
    """
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
                + k * math.log(p) + (n - k) * math.log1p(-p))
    terms = F.least(k, F.ceil(40 * F.sqrt(n)) + 40).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(0), terms), F.struct(top.alias("term"), F.lit(0.0).alias("sum")),
        lambda a, j: F.struct(
            (a["term"] * (k - j) * (1 - p) / ((n - k + j + 1) * p)).alias("term"), (a["sum"] + a["term"]).alias("sum")),
        lambda a: a["sum"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), total))


def cutoffs(measured: DataFrame, labels: DataFrame, id_col: str, stratum_col: str, risk: Risk = Risk()) -> DataFrame:
    """(stratum, signal, cutoff) of the certified rules.

    Labelled documents that the base rule passes are split by their fold. One part proposes cutoffs: quantiles of the
    good rows' signals, by stratum. The other, the holdout, certifies them: a cutoff passes if so few of its n good
    rows are rejected that, were the true rate above the rule's share of ``false_rejects``, this would happen with
    probability at most ``doubt`` / (number of rules tried) (exact binomial bound; Bonferroni over signals and strata).
    The cutoffs of one rule are tested from the loosest to the strictest until one fails, a fixed sequence that needs
    no further correction. The rules' shares add up, so the guarantee holds for all rules of a stratum together. Of
    the certified cutoffs of a rule the one that rejects most bad rows of the proposing part is taken. A stratum with
    too few labels gets no rule.
    """
    marks = labels.filter("quality is not null").groupBy(F.col(id_col).alias("_label_id")).agg(
        F.max("quality").alias("_good"), F.min("quality").alias("_least")).filter("_good = _least")
    known = measured.filter("not base_failed").join(marks, F.col(id_col) == F.col("_label_id")).select(
        F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
        (F.col("_good") == 1).alias("good"), (remainder(F.col(id_col)) >= 2).alias("holdout"),
        F.explode(F.array(*(F.struct(
            F.lit(name).alias("signal"), (F.col(name) if bad == "high" else -F.col(name)).alias("value"))
            for name, bad in SIGNALS.items()))).alias("s"),
    ).select("stratum", "good", "holdout", "s.*")
    proposed = known.filter("good and not holdout").groupBy("stratum", "signal").agg(
        F.percentile_approx("value", list(risk.quantiles), 10_000).alias("cuts")).select(
        "stratum", "signal", F.explode(F.array_distinct("cuts")).alias("cutoff"))
    proposed = cut_lineage(proposed)  # strata x signals x quantiles
    rows = proposed.count()
    tests = proposed.select("stratum", "signal").distinct().count()
    share = risk.false_rejects / len(SIGNALS)
    tried = known.join(small(proposed, rows), ["stratum", "signal"]).groupBy("stratum", "signal", "cutoff").agg(
        F.count_if(F.expr("good and holdout")).alias("n"),
        F.count_if(F.expr("good and holdout and value > cutoff")).alias("k"),
        F.count_if(F.expr("not good and not holdout")).alias("bad"),
        F.count_if(F.expr("not good and not holdout and value > cutoff")).alias("caught"))
    passes = binomial_tail(F.col("k"), F.col("n"), share) <= risk.doubt / max(tests, 1)
    loosest_first = W.partitionBy("stratum", "signal").orderBy(F.desc("cutoff"))
    certified = tried.withColumn("passed", F.min(passes).over(loosest_first)).filter(
        F.col("passed") & (F.col("caught") > 0) & (F.col("caught") >= risk.min_gain * F.col("bad")))
    return certified.groupBy("stratum", "signal").agg(F.max_by("cutoff", F.struct("caught", "cutoff")).alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", risk: Risk = Risk(), carry: tuple[str, ...] = ()) -> DataFrame:
    """Id, stratum and ``carry`` of each row of ``docs``, with counts, signals, ``base_failed``, ``rejected_by``, ``kept``.

    Repeated rows are judged each on their own; rows labelled both good and bad, or not at all, teach nothing; with an
    empty label table only the base rule rejects. A null stratum is the stratum ''.
    """
    measured = cut_lineage(signals(docs.select(id_col, text_col, stratum_col, *carry), text_col))
    rules = cut_lineage(cutoffs(measured, labels, id_col, stratum_col, risk).groupBy(
        F.col("stratum").alias("_stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("signal", "cutoff"))).alias("_cutoffs")))
    value = {name: F.col(name) if bad == "high" else -F.col(name) for name, bad in SIGNALS.items()}
    broken = F.filter(F.array(*(
        F.when(value[name] > F.element_at(F.col("_cutoffs"), name), F.lit(name)) for name in SIGNALS)),
        lambda x: x.isNotNull())
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit(""))
    return (
        measured.join(small(rules, rules.count()), stratum == F.col("_stratum"), "left")
        .withColumn("rejected_by", F.coalesce(broken, F.array().cast("array<string>")))
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
        .drop("_stratum", "_cutoffs")
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              stratum_col: str = "lang", risk: Risk = Risk()) -> DataFrame:
    """The documents that ``judge`` keeps, with their own columns. Rows are matched by id, stratum and a hash of the
    text, on which the verdict rests, so rows that only share an id, or have none, are kept or rejected each on their own."""
    text_hash = fresh(docs, "text_hash")
    mark = {c: fresh(docs, f"rejected_{c}") for c in ("id", "stratum", "text")}
    hashed = docs.withColumn(text_hash, F.xxhash64(text_col))
    rejected = judge(hashed, labels, id_col, text_col, stratum_col, risk, (text_hash,)).filter("not kept").select(
        F.col(id_col).alias(mark["id"]), F.col(stratum_col).alias(mark["stratum"]), F.col(text_hash).alias(mark["text"])).distinct()
    return docs.join(
        rejected, F.col(id_col).eqNullSafe(F.col(mark["id"])) & F.col(stratum_col).eqNullSafe(F.col(mark["stratum"]))
        & (F.xxhash64(text_col) == F.col(mark["text"])), "left_anti")
