"""Quality rules whose cutoffs are chosen under risk control, in DataFrame functions alone.

Two rules are fixed: a text needs ten words, and at most a fifth of its words may lie in
five-word windows that it repeats. What passes them is judged by measures whose cutoffs
are learnt, stratum by stratum, from labelled good texts. The labelled texts are split in
two by their digest. One part proposes: level j of a measure is the lowest value that
at most RUNGS[j] thousandths of the part exceed. The other part, the holdout, decides: of
its n texts the cutoffs of a level reject k, and the level is certified if a share of
false rejections above `risk` would give k or fewer of n with a probability of at most
miss / strata, which is where the exact (Clopper-Pearson) upper bound on the share meets
`risk`. Levels are tried from the loosest on and the first failure ends the stratum, so
they need no further correction (fixed-sequence testing); strata are corrected by
Bonferroni. So with a probability of 1 - miss no stratum rejects more than `risk` of the
good texts that pass the fixed rules, whatever the texts look like. A stratum without
enough labels to certify its loosest level rejects nothing beyond the fixed rules.

The guarantee is for texts drawn like the labelled ones. Copies aren't independent
draws, so equal texts count once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm._runtime import fresh, small_side, text_of, written

#: Share of good texts that a stratum may lose, and the chance that some stratum loses more.
RISK, MISS = 0.05, 0.1
#: Thousandths of the proposing good texts above the cutoff of each level, loosest first.
RUNGS = (0, 1, 2, 5)
#: Values of measures end here: 10 symbols a word, words of 100 letters. Shares end at 1000.
TOP = 10_000
#: Fixed rules: fewest words, and most words in repeated windows, in hundredths.
FEWEST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5

_WORD, _SYMBOLS = r"[^\x20\x09-\x0D]+", "#*$%&|<>"
MEASURES = ("symbols", "long_words", "short_words", "dup_lines", "repeats")


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _repeated(words: Column) -> Column:
    """How many words lie in a window of WINDOW words that occurs twice or more in the text."""

    def shared(rows: Column, name: str) -> Column:  # of sorted rows, those with a neighbour of the same value
        equal = lambda x, j: F.coalesce(F.get(rows, j)[name] == x[name], F.lit(False))
        return F.filter(rows, lambda x, j: equal(x, j - 1) | equal(x, j + 1))

    def count(hashes: Column) -> Column:
        by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        likely = _with(by_hash, lambda rows: shared(rows, "h"))
        by_text = F.sort_array(F.transform(likely, lambda x: F.struct(F.array_join(F.slice(words, x["i"] + 1, WINDOW), " ").alias("w"), x["i"].alias("i"))))
        places = F.sort_array(F.transform(_with(by_text, lambda rows: shared(rows, "w")), lambda x: x["i"]))
        new = lambda at: F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))))
        total = F.aggregate(_with(places, new), F.lit(0), lambda a, x: a + x)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(total)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)]))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(_with(windows, count)).cast("long")


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """row_id, stratum, digest (of the text), n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed.

    n_lines counts the lines with a word; a line equal to an earlier one is a dup line.
    Null and empty texts have zeros and fail. Each row has its row, repeated rows too; a
    null id or stratum stays null. Other columns of docs aren't read, whatever their names.
    """
    text = text_of(F.col(text_col))
    stratum = F.col(stratum_col).cast("string") if stratum_col else F.lit(None).cast("string")
    held = docs.select(F.col(id_col).alias("row_id"), stratum.alias("stratum"), text.alias("t"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(_WORD))
    counts = _with(
        F.regexp_extract_all("t", F.lit(_WORD), F.lit(0)),
        lambda words: F.struct(F.size(words).cast("long").alias("n_words"), _repeated(words).alias("n_repeat_words")),
    )
    shape = _with(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    length = lambda x: F.length(x).cast("long")
    row = held.select(
        "row_id", "stratum", F.md5("t").alias("digest"), counts.alias("c"), shape.alias("s"),
        length(F.translate("t", " \t\n\x0b\f\r", "")).alias("word_chars"), (length(F.col("t")) - length(F.translate("t", _SYMBOLS, ""))).alias("n_symbols"),
    )
    told = row.select("row_id", "stratum", "digest", "c.n_words", "word_chars", "n_symbols", F.col("s.n").alias("n_lines"), F.col("s.dup").alias("n_dup_lines"), "c.n_repeat_words")
    return told.withColumn("base_failed", (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def measures() -> Column:
    """The values of MEASURES of a row of text_counts that passes the fixed rules, as an array of longs."""
    share = lambda x, of, scale: F.least(F.floor(scale * F.col(x) / F.greatest(F.col(of), F.lit(1))), F.lit(TOP)).cast("long")
    long_words = share("word_chars", "n_words", 100)
    return F.array(share("n_symbols", "n_words", 1000), long_words, TOP - long_words, share("n_dup_lines", "n_lines", 1000), share("n_repeat_words", "n_words", 1000))


def log_factorial(n: Column) -> Column:
    """ln n!, from Stirling's series at n + 10, where its next term is below 1e-15."""
    x = n.cast("double") + 11
    series = (x - 0.5) * F.ln(x) - x + 0.9189385332046728 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7) + 1 / (1188 * x**9)
    return series - reduce(lambda a, b: a + b, [F.ln(n.cast("double") + i) for i in range(1, 11)])


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """The chance of k or fewer of n at probability p each.

    Up to the mean the terms are summed from k downwards, beyond it those above k are
    taken off 1; either way they fall from the first on. Left out are terms 12 standard deviations
    and more further on, which are under 1e-30 of the first.
    """
    odds = p / (1 - p)
    below = k <= n * p
    first = F.when(below, k).otherwise(k + 1)
    term = F.when(first > n, 0.0).otherwise(F.exp(log_factorial(n) - log_factorial(first) - log_factorial(F.greatest(n - first, F.lit(0))) + first * F.ln(F.lit(p)) + (n - first) * F.ln(F.lit(1 - p))))
    reach = F.least(F.when(below, k).otherwise(F.greatest(n - first, F.lit(0))), F.ceil(12 * F.sqrt(n * p * (1 - p))) + 20).cast("int")

    def further(a: Column, j: Column) -> Column:
        down, up = first - j + 1, first + j  # the number of the term gone from, and gone to
        t = a["t"] * F.when(below, down / ((n - down + 1) * odds)).otherwise((n - up + 1) * odds / up)
        return F.struct(t.alias("t"), (a["sum"] + t).alias("sum"))

    steps = F.when(reach > 0, F.sequence(F.lit(1), reach)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(steps, F.struct(term.alias("t"), term.alias("sum")), further)["sum"]
    return F.when(below, total).otherwise(1 - total)


def _proposed(good: DataFrame, rungs: tuple[int, ...]) -> DataFrame:
    """stratum, cuts: for each measure its cutoffs by level, which never rise, from counts by value (TOP + 1 values at most)."""
    values = good.select("stratum", F.posexplode("values").alias("measure", "value")).groupBy("stratum", "measure", "value").agg(F.count("*").alias("n"))
    upwards = Window.partitionBy("stratum", "measure").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = values.select("stratum", "measure", "value", F.coalesce(F.sum("n").over(upwards), F.lit(0)).alias("above"), F.sum("n").over(Window.partitionBy("stratum", "measure")).alias("all"))
    levels = F.array(*[F.min(F.when(1000 * F.col("above") <= rung * F.col("all"), F.col("value"))) for rung in rungs])
    each = ranked.groupBy("stratum", "measure").agg(levels.alias("c"))
    return each.groupBy("stratum").agg(F.transform(F.sort_array(F.collect_list(F.struct("measure", "c"))), lambda x: x["c"]).alias("cuts"))  # one of each measure


def first_level(values: Column, cuts: Column, levels: int) -> Column:
    """The first level that rejects the values: one of a measure above its cutoff; `levels` if none does."""
    return F.array_min(F.transform(cuts, lambda c, r: F.size(F.filter(c, lambda x: F.get(values, r) <= x)))) if levels else F.lit(0)


def certified_cutoffs(counts: DataFrame, labels: DataFrame, risk: float = RISK, miss: float = MISS, rungs: tuple[int, ...] = RUNGS, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """One row a stratum of text_counts rows: stratum, n (holdout texts), rejected (by level), tails (by level), level, cutoffs.

    level is the strictest certified one, -1 if none is, and then cutoffs is null; else it
    has a cutoff for each of MEASURES, and a text is rejected if a value is above its
    cutoff. A text is good if all labels of its id that aren't null are 1; ids without
    labels, null ids and texts that fail the fixed rules take no part. Strata that only
    one part of the labelled texts knows are certified nothing. No labels: no rows.
    """
    good = labels.select(F.col(id_col).alias("row_id"), F.col(label_col).alias("label")).groupBy("row_id").agg(F.min("label").alias("least")).where("least = 1").select("row_id")
    texts = counts.where("not base_failed").join(good, "row_id").select("stratum", "digest", measures().alias("values")).dropDuplicates(["stratum", "digest"])
    texts = written(texts)
    proposes = F.substring("digest", 1, 1) < "8"
    cuts = small_side(_proposed(texts.where(proposes), rungs), rows=20_000)
    held = texts.where(~proposes).alias("t").join(cuts.alias("c"), F.col("t.stratum").eqNullSafe(F.col("c.stratum")))
    judged = held.select("t.stratum", first_level(F.col("values"), F.col("cuts"), len(rungs)).alias("first"))
    hits = judged.groupBy("stratum").agg(F.count("*").alias("n"), F.array(*[F.sum((F.col("first") <= j).cast("long")) for j in range(len(rungs))]).alias("rejected"))
    tails = F.array(*[binomial_tail(F.get("rejected", F.lit(j)), F.col("n"), risk) for j in range(len(rungs))])
    strata = F.count("*").over(Window.partitionBy())
    tested = hits.withColumn("tails", tails).withColumn("bound", F.lit(miss) / strata)
    passed = F.aggregate("tails", F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, t: F.struct((a["n"] + (a["on"] & (t <= F.col("bound"))).cast("int")).alias("n"), (a["on"] & (t <= F.col("bound"))).alias("on")))["n"]
    level = tested.withColumn("level", passed - 1).alias("h").join(cuts.alias("c"), F.col("h.stratum").eqNullSafe(F.col("c.stratum")))
    return level.select("h.stratum", "n", "rejected", "tails", "level", F.when(F.col("level") >= 0, F.transform("cuts", lambda c: F.get(c, F.col("level")))).alias("cutoffs"))


def judge(counts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The rows of text_counts with failed (names of the learnt measures that reject) and kept.

    A row that fails the fixed rules is never kept and has no learnt verdict (failed is
    empty), nor has one of a stratum without certified cutoffs.
    """
    known = small_side(cutoffs.where("cutoffs is not null").select(F.col("stratum").alias(s := fresh(counts, "s")), "cutoffs"), rows=20_000)
    failed = F.filter(F.array(*[F.when(F.get(measures(), F.lit(i)) > F.get("cutoffs", F.lit(i)), name) for i, name in enumerate(MEASURES)]), lambda x: x.isNotNull())
    failed = F.when(F.col("cutoffs").isNull() | F.col("base_failed"), F.array().cast("array<string>")).otherwise(failed)
    told = counts.join(known, counts["stratum"].eqNullSafe(F.col(s)), "left").withColumn("failed", failed)
    return told.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).drop(s, "cutoffs")


def apply_quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang", risk: float = RISK, miss: float = MISS) -> DataFrame:
    """Every row of docs as text_counts gives it, with failed and kept; cutoffs are learnt from the labels of these very docs.

    stratum_col None makes one stratum of all. See text_counts, certified_cutoffs and judge
    for nulls, empty texts, repeated rows, ties and empty tables.
    """
    counts = written(text_counts(docs, id_col, text_col, stratum_col))
    return judge(counts, certified_cutoffs(counts, labels, risk, miss, id_col=id_col))
