"""Quality rules with risk-controlled thresholds.

Base statistics of each text feed a few signals (symbol share, repeats, ...).
A rule of one level rejects a text if any signal is above its cutoff of that
level; the levels tighten all signals together, from the mildest to the
strictest.  For every stratum (language) and level the labelled good documents
are a holdout: of n good ones the rule rejects k.  The levels of a stratum are
tested from the mildest on, up to the first that fails (fixed sequence: no
correction among them): one passes if the exact binomial tail
P[Bin(n, RISK) <= k] is at most DELTA / strata.  With probability 1 - DELTA the
rule of every stratum rejects at most RISK of its good documents.  About
ln(strata / DELTA) / RISK good labels (86 for four strata) are enough for a rule that
rejects none of them.  Among certified levels the one that separates best is used: the
largest share of the bad documents less the share of the good ones, if above
zero, however rare bad documents are; of equal ones the mildest.  A stratum with
too few labels gets no rule and keeps its documents.

All labelled documents are used.  Only DataFrame functions are used.

Defined cases: a null text has no words and fails the base rule; a null
language is a stratum; labels of unknown ids are ignored, of conflicting labels
of one id the lower quality counts; repeated rows give repeated result rows;
without labels only the base rule decides; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, stage_table, text_of, words_of

RISK, DELTA = 0.05, 0.05
LEAST_WORDS, MOST_REPEATED = 50, 50
#: signal -> (statistic, per statistic, cutoffs): a text is rejected above the cutoff.
SIGNALS = {
    "symbols": ("n_symbols", "word_chars", (0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3)),
    "capitals": ("n_capitals", "word_chars", (0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7)),
    "repeats": ("n_repeat_words", "n_words", (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.45)),
    "exclamations": ("n_exclamations", "n_words", (0.05, 0.1, 0.2, 0.3, 0.5, 0.8, 1.2, 1.6)),
    "duplicate_lines": ("n_dup_lines", "n_lines", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)),
}


def statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """The base statistics (and those of further signals) of every whole text."""
    rows = docs.select(*keep, text_of(text_col).alias("_t")).select("*", words_of(F.col("_t")).alias("_w"))

    def only(chars: str) -> Column:
        return F.char_length(F.regexp_replace("_t", f"[^{chars}]+", "")).cast("long")

    lines = F.filter(F.split("_t", "\n", -1), lambda x: F.trim(x, F.lit(WS)) != "")
    starts = F.when(F.size("_w") >= 3, F.sequence(F.lit(1), F.size("_w") - 2)).otherwise(F.array().cast("array<int>"))
    rows = rows.select(
        *keep, "_w", F.size("_w").cast("long").alias("n_words"), F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        only("#*$%&|<>").alias("n_symbols"), only("A-Z").alias("n_capitals"), only("!").alias("n_exclamations"), lines.alias("_l"), starts.alias("_s"),
        F.transform(starts, lambda i: F.xxhash64(F.get("_w", i - 1), F.get("_w", i), F.get("_w", i + 1))).alias("_h"))
    # Texts in which no two windows share a hash have no repeated window; the others sort their windows whole.
    windows = F.sort_array(F.transform("_s", lambda i: F.struct(
        F.struct(F.get("_w", i - 1).alias("a"), F.get("_w", i).alias("b"), F.get("_w", i + 1).alias("c")).alias("w"), i.alias("i"))))
    rows = rows.withColumn("_z", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), windows)).drop("_h", "_w", "_s")
    again = F.filter("_z", lambda x, j: F.coalesce(x["w"] == F.get("_z", j + 1)["w"], F.lit(False))
                     | F.coalesce(x["w"] == F.get("_z", j - 1)["w"], F.lit(False)))
    covered = F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    return rows.select(*keep, "n_words", "word_chars", "n_symbols", "n_capitals", "n_exclamations", F.size("_l").cast("long").alias("n_lines"),
                       (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                       F.when(F.col("_z").isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def signal(name: str) -> Column:
    part, whole, _ = SIGNALS[name]
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))


def log_gamma(x: Column) -> Column:
    """Stirling's series after a shift by eight (x >= 1); relative error about 1e-14."""
    y, shift = x + 8, None
    for i in range(8):
        shift = F.log(x + i) if shift is None else shift + F.log(x + i)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P[Bin(n, p) <= k] for k < n p (about the median or more beyond: 1 there).  The terms fall
    off from k downwards, faster than a normal tail; those left out add less than 1e-15 of the sum."""
    k, n = k.cast("double"), n.cast("double")
    first = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    terms = F.least(k, F.ceil(12 * F.sqrt(k)) + 60).cast("int")
    odds = (1 - p) / p
    total = F.aggregate(F.sequence(F.lit(0), terms), F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")),
                        lambda acc, j: F.struct((acc["t"] * ((k - j) / (n - k + j + 1)) * odds).alias("t"), (acc["s"] + acc["t"]).alias("s")))["s"]
    return F.when((n > 0) & (k < n * p), F.exp(first) * total).otherwise(F.lit(1.0))


LEVELS = len(SIGNALS["symbols"][2])


def above_level(level: int) -> Column:
    """Whether any signal is above its cutoff; level 0 is the mildest."""
    over = None
    for name, (_, _, grid) in SIGNALS.items():
        hit = signal(name) > grid[LEVELS - 1 - level]
        over = hit if over is None else over | hit
    return over


def cutoffs(labelled: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, level, max_<signal>...): the cutoffs of each stratum that has a certified level.
    ``labelled``: lang, good (boolean) and the statistics, of documents that pass the base rule."""
    rows = labelled.select("lang", "good", *[above_level(i).alias(f"above{i}") for i in range(LEVELS)])
    # One row per stratum: counts of good and bad documents above each level.
    tests = [F.struct(F.lit(i).alias("level"), F.count_if(F.col("good") & F.col(f"above{i}")).alias("k"),
                      F.count_if(~F.col("good") & F.col(f"above{i}")).alias("caught")) for i in range(LEVELS)]
    per = rows.groupBy(F.col("lang").alias("stratum")).agg(F.count_if("good").alias("n"), F.count_if(~F.col("good")).alias("bad"), F.array(*tests).alias("tests"))
    per = stage_table(per, "cutoff-counts")
    strata = max(1, per.count())
    each = per.select("stratum", "n", "bad", F.inline("tests"))
    # A stricter level rejects no fewer good documents, so the levels that pass are the start of their sequence.
    certified = each.where(binomial_tail(F.col("k"), F.col("n"), risk) <= delta / strata)
    gain = F.try_divide("caught", "bad") - F.try_divide("k", "n")
    certified = certified.withColumn("gain", gain).where("gain > 0")
    best = certified.groupBy("stratum").agg(F.max(F.struct("gain", -F.col("level")))["col2"].alias("level")).withColumn("level", -F.col("level"))
    return best.select("stratum", "level", *[F.get(F.array(*[F.lit(c) for c in reversed(grid)]), F.col("level")).alias(f"max_{name}")
                                             for name, (_, _, grid) in SIGNALS.items()])


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per input row: doc_id, the base statistics, base_failed, kept."""
    stats = stage_table(statistics(docs), "text-statistics").withColumn("base_failed", base_failed())
    quality = labels.groupBy(F.col("doc_id").alias("l_id")).agg(F.min("quality").alias("quality")).where(F.col("quality").isNotNull())
    labelled = (stats.where(~F.col("base_failed")).join(quality, F.col("doc_id") == F.col("l_id"))
                .withColumn("good", F.col("quality") > 0))
    limits = stage_table(cutoffs(labelled, risk, delta), "cutoffs")  # one row per stratum
    out = stats.join(limits, F.col("lang").eqNullSafe(F.col("stratum")), "left")
    bad = None
    for s in SIGNALS:
        over = F.coalesce(signal(s) > F.col(f"max_{s}"), F.lit(False))
        bad = over if bad is None else bad | over
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~bad).alias("kept"))
