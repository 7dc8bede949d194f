"""Quality rules with adaptive thresholds (DataFrame functions only).

Per document, whole text: words, characters in words, symbols, repeated lines
and words inside repeated three-word windows.  Two base rules are fixed
(``MIN_WORDS`` and ``MAX_REPEAT_PERCENT``).  The other limits adapt to where a
document comes from:

1. Four ratios of every document that passes the base rules are laid into
   log-linear bins (exact below 64, then 32 bins per doubling, so a relative
   error below 1/32) and counted per language and source.  These bin counts
   are the quantile sketch: of bounded size, merged by addition, the same in
   whatever order rows arrive, combined on the map side, so a hot source sends
   a few hundred counts per task.
2. A (language, source) with fewer than ``MIN_GROUP`` documents takes the
   merged sketch of its language, and below that the merge of all.
3. Every limit comes from quantiles of a sketch (``LIMITS``).  The upper limit of
   a ratio is its median plus a factor times the distance to an upper quantile;
   the lower limit of the word length mirrors it with the lower quantile.  A
   quantile is known up to the width of its bin, so the far end of the bin
   counts: a group whose documents do not differ still has a tolerance, that of
   its sketch.  Ratios that most clean documents spread over (symbols, word
   length) take the quartile, which junk reaches only where it is a quarter of
   a group; rare ones, zero in most documents, take the 95 % or 99 % quantile.
4. The thin table of ratios is joined with the limits and filtered.

Ratios are integers: symbols per 10,000 word characters, repeated lines per
10,000 lines, repeated words per 10,000 words, hundredths of a character per
word.

Defined results: null or blank text has no words and fails the base rules;
null language or source is a value of its own; repeated rows are judged alike
and each is returned; an empty table gives an empty result.  Only the named
columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retally.llm.shared import WHITE, materialise, without_white, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 30
SYMBOLS = "#*$%&|<>"

# Ratio -> (upper quantile in percent, how many times its distance from the median a document may be away).
LIMITS = {"symbol_rate": (75, 6), "dup_line_rate": (90, 6), "repeat_rate": (95, 3), "word_length": (75, 6)}
LEAST = {"dup_line_rate": 4000}       # least distance from the median, in the ratio's unit
TWO_SIDED = ("word_length",)          # limited below as well, by the mirrored quantile


def base_metrics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns plus the counts of every row's whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    first = docs.select(*[F.col(c) for c in keep], text.alias("_t"))
    words = first.select(
        *keep, words_of(F.col("_t")).alias("_w"),
        F.char_length(without_white(F.col("_t"))).cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("_t", "\n"), lambda x: F.translate(x, WHITE, "") != "").alias("_lines"))
    last = F.size("_w") - 3          # start of the last window

    def windows(make):
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), make))

    hashed = words.select(
        *keep, "word_chars", "n_symbols", "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows(lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))).alias("_h"))
    # Different hashes mean different windows, so only texts with an equal pair go on, and of these only the windows
    # whose hash comes again; those compare the words.
    alike = F.size(F.array_distinct("_h")) < F.size("_h")
    hashes = hashed.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "_w",
        F.when(alike, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))
    again = F.filter("_s", lambda x, k: F.get("_s", k + 1)["h"].eqNullSafe(x["h"]) | F.get("_s", k - 1)["h"].eqNullSafe(x["h"]))
    ordered = hashes.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "_w", again.alias("_a")).select(
        *keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.sort_array(F.transform("_a", lambda x: F.struct(
            F.concat_ws(" ", F.get("_w", x["i"]), F.get("_w", x["i"] + 1), F.get("_w", x["i"] + 2)).alias("s"), x["i"].alias("i"))))
        .alias("_o"))
    twice = F.filter("_o", lambda x, k: F.get("_o", k + 1)["s"].eqNullSafe(x["s"])
                     | F.get("_o", k - 1)["s"].eqNullSafe(x["s"]))
    placed = ordered.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.sort_array(F.transform(twice, lambda x: x["i"])).alias("_p"))
    # A window covers three words; the next repeated window may start inside it.
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_p", k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    return placed.select(*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                         F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def with_ratios(metrics: DataFrame) -> DataFrame:
    def per(a: str, b: str, scale: int) -> Column:
        return F.coalesce(F.expr(f"({a} * {scale}) div nullif({b}, 0)"), F.lit(0).cast("long"))

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return metrics.select(
        "*", failed.alias("base_failed"),
        per("n_symbols", "word_chars", 10000).alias("symbol_rate"),
        per("n_dup_lines", "n_lines", 10000).alias("dup_line_rate"),
        per("n_repeat_words", "n_words", 10000).alias("repeat_rate"),
        per("word_chars", "n_words", 100).alias("word_length"))


def _step(value: Column) -> Column:
    return F.pow(F.lit(2.0), F.greatest(F.length(F.bin(value)) - 6, F.lit(0))).cast("long")


def bin_of(value: Column) -> Column:
    """The lower end of a value's log-linear bin: its six leading binary digits."""
    return value - value % _step(value)


def upper_end(lower: Column) -> Column:
    """The upper end of the bin that begins at ``lower``."""
    return lower + _step(lower)


def sketches(ratios: DataFrame, lang: str, source: str) -> DataFrame:
    """Bin counts per (lang, source, ratio): the mergeable sketch."""
    long = ratios.where(~F.col("base_failed")).select(
        F.col(lang).alias("lang"), F.col(source).alias("source"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("ratio"), bin_of(F.col(m)).alias("bin")) for m in LIMITS])).alias("x"))
    return long.groupBy("lang", "source", F.col("x.ratio").alias("ratio"), F.col("x.bin").alias("bin")).agg(F.count("*").alias("n"))


def limits_of(bins: DataFrame, keys: list[str]) -> DataFrame:
    """Size of each merged sketch and its limits per ratio, one row per ``keys`` value."""
    merged = bins.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys, "ratio")
    placed = merged.select("*", F.sum("n").over(whole.orderBy("bin")).alias("upto"), F.sum("n").over(whole).alias("docs"))
    # a quantile in percent: the first bin at which upto * 100 >= percent * docs
    percents = sorted({50} | {q for p, _ in LIMITS.values() for q in (p, 100 - p)})
    found = placed.groupBy(*keys, "ratio").agg(F.max("docs").alias("docs"), *[
        F.min(F.when(F.col("upto") * 100 >= p * F.col("docs"), F.col("bin"))).alias(f"q{p}") for p in percents])

    def by_ratio(make, ratios=LIMITS) -> Column:
        return F.coalesce(*[F.when(F.col("ratio") == m, make(*LIMITS[m], F.lit(LEAST.get(m, 0)))) for m in ratios])

    middle, above = F.col("q50"), upper_end(F.col("q50"))
    limits = found.select(
        *keys, "ratio", "docs",
        by_ratio(lambda p, k, least: middle + F.greatest(k * (upper_end(F.col(f"q{p}")) - middle), least)).alias("high"),
        by_ratio(lambda p, k, least: above - F.greatest(k * (above - F.col(f"q{100 - p}")), least), TWO_SIDED).alias("low"))
    return limits.groupBy(*keys).agg(
        F.max("docs").alias("docs"),
        *[F.max(F.when(F.col("ratio") == m, F.col("high"))).alias(f"{m}_max") for m in LIMITS],
        *[F.max(F.when(F.col("ratio") == m, F.col("low"))).alias(f"{m}_min") for m in TWO_SIDED])


def thresholds(bins: DataFrame) -> DataFrame:
    """Limits for every (lang, source), from its own sketch, its language's or the merge of all.

    One row per (lang, source) seen; every level is a sum of the bin counts.
    """
    names = [f"{m}_max" for m in LIMITS] + [f"{m}_min" for m in TWO_SIDED]
    own = limits_of(bins, ["lang", "source"])
    by_lang = limits_of(bins, ["lang"]).select(
        F.col("lang").alias("_lang"), F.col("docs").alias("_l_docs"), *[F.col(n).alias(f"_l_{n}") for n in names])
    # one row, joined on a computed zero (n mod 1, which Catalyst does not fold): an equality join, not a nested loop
    overall = limits_of(bins.select(F.pmod(F.col("n"), F.lit(1)).alias("_all"), "ratio", "bin", "n"), ["_all"]).select(
        F.col("_all"), *[F.col(n).alias(f"_a_{n}") for n in names])
    joined = (own.withColumn("_zero", F.pmod(F.col("docs"), F.lit(1))).join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")))
              .join(overall, F.col("_zero") == F.col("_all")))
    return joined.select("lang", "source", *[
        F.when(F.col("docs") >= MIN_GROUP, F.col(n)).when(F.col("_l_docs") >= MIN_GROUP, F.col(f"_l_{n}"))
        .otherwise(F.col(f"_a_{n}")).alias(n) for n in names])


def _judged(docs: DataFrame, keep: list[str], text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` per row; the ``keep`` columns as ``k0``, ``k1``, ...

    Two tables go through the shared folder: the counts per row (so that texts
    are read once) and the limits (so that Spark knows their size when it
    chooses how to join them).
    """
    names = [f"k{i}" for i in range(len(keep))]
    metrics = base_metrics(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col(lang_col).alias("g_lang"),
                                       F.col(source_col).alias("g_source"), F.col(text_col).alias("g_text")),
                           [*names, "g_lang", "g_source"], "g_text")
    rows = materialise(with_ratios(metrics), "quality-rows")
    limits = materialise(thresholds(sketches(rows, "g_lang", "g_source")), "quality-limits")
    within = F.lit(True)
    for m in LIMITS:
        within = within & (F.col(m) <= F.col(f"{m}_max"))
    for m in TWO_SIDED:
        within = within & (F.col(m) >= F.col(f"{m}_min"))
    joined = rows.join(limits, F.col("g_lang").eqNullSafe(F.col("lang")) & F.col("g_source").eqNullSafe(F.col("source")), "left")
    return joined.select(*names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", (~F.col("base_failed") & F.coalesce(within, F.lit(True))).alias("kept"))


def judge(docs: DataFrame, keep: list[str], text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """The ``keep`` columns of every row with its counts, ``base_failed`` and the verdict ``kept``."""
    judged = _judged(docs, keep, text_col, lang_col, source_col)
    return judged.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *judged.columns[len(keep):])


def good_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows that pass, with all columns of ``docs``; the rows travel with their counts, so nothing is joined back."""
    kept = _judged(docs, docs.columns, text_col, lang_col, source_col).where("kept")
    return kept.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
