"""Quality rules with risk-controlled thresholds (operator 6), DataFrame
functions only.

Each rule rejects a document when a measure of its text exceeds a cutoff.
Every rule has a ladder of cutoffs, lenient to strict, and the rules go down their
ladders together: step by step, in one order fixed before any label is
seen, the whole set of rules becomes stricter. Per stratum the labelled
good documents are a holdout: a step may be used if the exact binomial
test at the allowed rate of false rejections passes, i.e. if so few good
documents were rejected by any rule that a true rate above the limit is refuted.
The tests run along the order and stop at the first failure, which needs no
correction; the strata split the error probability (Bonferroni). So with
probability ``1 - delta`` every stratum loses at most ``alpha`` of its good
documents. Of the steps allowed, the most lenient one that rejects the most
labelled bad documents is chosen.

The test counts independent documents: rows and labels that repeat a text count
once, and a text labelled both ways is good.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import SPACE, staged

ALPHA = 0.02
DELTA = 0.05
STEPS = 40
SYMBOLS = "#*$%&|<>"  # fixed value: characters counted as symbols
BLANKS = " \t\n\x0b\f\r"

# rule -> ladder of cutoffs, lenient to strict; rejected if the measure is above
LADDERS = {
    "symbol_share": [1 - (i + 1) / STEPS for i in range(STEPS)],
    "dup_line_share": [1 - (i + 1) / STEPS for i in range(STEPS)],
    "repeat_share": [1 - (i + 1) / STEPS for i in range(STEPS)],
    "mean_word": [24 - i / 2 for i in range(STEPS)],
}


def measures(documents: DataFrame, stratum: Column) -> DataFrame:
    """Counts of every whole text: ``doc_id, stratum, text_key, n_words, word_chars,
    n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed``.

    NULL and word-less texts have no words, lines or symbols to count but
    the symbols themselves. Windows of three words are told apart by a
    64-bit hash of the words.
    """
    text = F.coalesce("text", F.lit(""))
    none = F.lit(0).cast("bigint")
    rows = documents.select(
        "doc_id", stratum.alias("stratum"), F.md5(text).alias("text_key"),
        F.length(F.translate(text, BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, SPACE), lambda w: w != "").alias("w"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0).alias("lines"))
    rows = rows.withColumn("n_words", F.size("w").cast("bigint"))
    # one hash per window; the three slices are built once per text
    n = F.greatest(F.size("w") - 2, F.lit(0))
    windows = F.when(n > 0, F.transform(
        F.arrays_zip(F.slice("w", 1, n).alias("a"), F.slice("w", 2, n).alias("b"), F.slice("w", 3, n).alias("c")),
        lambda x: F.xxhash64(x["a"], x["b"], x["c"]))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select("doc_id", "stratum", "text_key", "word_chars", "n_symbols", "n_words",
                       F.size("lines").cast("bigint").alias("n_lines"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
                       windows.alias("h"))
    # most texts repeat no window and need no sort
    some = F.size("h") > F.size(F.array_distinct("h"))
    ordered = F.when(some, F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    rows = rows.withColumn("s", ordered).drop("h")
    m = F.size("s") - 1
    neighbours = F.zip_with(F.slice("s", 1, m), F.slice("s", 2, m), lambda a, b: F.when(
        a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("at", F.array_sort(F.array_distinct(F.flatten(neighbours)))).drop("s")
    # windows at sorted places p cover min(3, p - previous p) words more each
    covered = F.aggregate(
        "at", F.struct(F.lit(-3).alias("last"), none.alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"])
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, none)).drop("at")
    return rows.withColumn("base_failed", (F.col("n_words") < 50)
                           | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def values() -> dict[str, Column]:
    """The measure of each rule; 0 where there is nothing to measure."""
    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {"symbol_share": share("n_symbols", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"), "mean_word": share("word_chars", "n_words")}


def _lgamma(x: Column) -> Column:
    """log Gamma for x >= 1: Stirling's series eight places further up."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) \
        + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    return series - reduce(lambda a, b: a + b, [F.log(x + i) for i in range(8)])


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) where that is below a half (k < n p), else 1.0.

    The terms are added from k downwards; there they fall at least like a
    normal tail, so ``40 sqrt(n p)`` of them are all that a double can hold.
    """
    log_top = (_lgamma(n + 1.0) - _lgamma(k + 1.0) - _lgamma(n - k + 1.0)
               + k * math.log(p) + (n - k) * math.log1p(-p))
    many = F.least(k, F.ceil(40 * F.sqrt(n * p)) + 50).cast("int")
    odds = (1 - p) / p
    total = F.aggregate(
        F.sequence(F.lit(0), many), F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda a, i: F.struct((a["sum"] + a["term"]).alias("sum"),
                              (a["term"] * (k - i) / (n - k + i + 1) * odds).alias("term")),
        lambda a: a["sum"])
    return F.when(k < n * p, F.exp(log_top) * total).otherwise(F.lit(1.0))


def first_step() -> Column:
    """The first step at which any rule rejects the document; ``STEPS`` if none does."""
    def passed(rule: str, value: Column) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, LADDERS[rule])), lambda c: c >= value))

    return F.least(*[passed(r, v) for r, v in values().items()])


def holdout(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``stratum, good, step`` of every distinct labelled text that passes the base rules. ``labels`` has
    ``doc_id, quality`` (above 0 is good; NULL labels and ids are left out)."""
    lab = (labels.filter("doc_id is not null and quality is not null")
           .groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("quality") > 0).alias("good")))
    held = (rows.filter(~F.col("base_failed")).withColumn("step", first_step())
            .join(lab, F.col("doc_id") == F.col("_id")))
    return held.groupBy("stratum", "text_key").agg(F.max("good").alias("good"), F.first("step").alias("step"))


def cutoffs(rows: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum`` and the chosen cutoff of each rule; strata of which no step is safe are left out.
    ``rows`` are measures. All labelled documents that pass the base rules are used."""
    tally = (holdout(rows, labels).groupBy("stratum", "step", "good").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("stratum").agg(F.collect_list(F.struct("step", "good", "n")).alias("t")))

    def count(keep):
        return F.aggregate(F.filter("t", keep), F.lit(0).cast("bigint"), lambda a, x: a + x["n"])

    tally = staged(tally.withColumn("n_good", count(lambda x: x["good"])), "risk-tally")
    tests = max(tally.count(), 1)
    i = F.col("i")
    ladder = tally.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1)))).select(
        "stratum", "i", "n_good",
        count(lambda x: x["good"] & (x["step"] <= i)).alias("lost"),
        count(lambda x: ~x["good"] & (x["step"] <= i)).alias("caught"))
    p = binomial_cdf(F.col("lost").cast("double"), F.col("n_good").cast("double"), alpha)
    # stricter steps lose no fewer good documents, so the steps that pass come first
    safe = ladder.filter("n_good > 0").filter(p <= delta / tests).filter("caught > 0")
    # most caught, then most lenient
    best = safe.groupBy("stratum").agg((-F.max(F.struct("caught", (-i).alias("m")))["m"]).alias("i"))
    pick = [F.element_at(F.array(*map(F.lit, c)), (i + 1).cast("int")).alias(f"cut_{r}") for r, c in LADDERS.items()]
    return staged(best.select("stratum", *pick), "risk-cutoffs")


def judge(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Add ``kept`` to measures: base rules passed, and no measure above its
    stratum's cutoff."""
    c = chosen.withColumnRenamed("stratum", "_stratum")
    joined = rows.join(c, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    over = reduce(lambda a, b: a | b,
                  [F.coalesce(v > F.col(f"cut_{r}"), F.lit(False)) for r, v in values().items()])
    return joined.withColumn("kept", ~F.col("base_failed") & ~over).drop("_stratum", *[f"cut_{r}" for r in LADDERS])


def report(documents: DataFrame, labels: DataFrame, stratum: Column | None = None,
           alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per document: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept``; strata are languages
    unless given, NULL a stratum of its own. With too few labels to show a
    cutoff safe, none is used."""
    rows = staged(measures(documents, F.col("lang") if stratum is None else stratum), "risk-measures")
    return judge(rows, cutoffs(rows, labels, alpha, delta)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
