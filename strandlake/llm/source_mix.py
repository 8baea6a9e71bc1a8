"""Mixing sources to target weights, by nested hash thresholds.

Every document has a 60-bit hash of its id and text. A source whose target is r
whole passes and a rest takes each document r times, and once more those whose
hash lies below a threshold at which the rest is used up. The threshold is
found by histograms: words are summed by source and hash bucket, the bucket in
which the budget runs out is cut into finer buckets, and so on until it holds
one hash value. Documents are never sorted or moved; what is shuffled is one
row for each source, bucket and task. Sets of smaller budgets are contained in
those of larger ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm._runtime import BROADCAST_ROWS, fresh, text_of, written

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
#: Bits of the hash that one histogram resolves: 4096 buckets a source.
LEVEL_BITS = 12
MAX_PASSES = 3
ANY_SIZE = 1 << 62


def word_count(text: Column) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def mix_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id and the MD5 of the text."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(" "), F.md5(text_of(text)))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def share_targets(sources: DataFrame, max_passes: int = MAX_PASSES) -> DataFrame:
    """Add `target` to (source, source_size, weight): shares of the whole by weight, none above max_passes sizes.

    The excess of a source that is stopped goes to the others by weight, again and again. It
    ends where each target is min(max_passes * size, level * weight) with one level for all:
    from the level at which none is stopped, each round stops the sources beyond their limit
    and raises the level for the rest. A round is one sum over the sources; few are needed, as
    the level only rises.
    """
    cap = (F.col("source_size") * F.lit(max_passes)).cast("double")
    shares = sources.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    level = None
    while True:
        stopped = F.lit(False) if level is None else F.col("ratio") <= level
        total, capped, free = shares.agg(F.sum("source_size").cast("double"), F.coalesce(F.sum(F.when(stopped, F.col("cap"))), F.lit(0.0)), F.sum(F.when(~stopped, F.col("weight")))).first()
        if not free or (level is not None and (total - capped) / free <= level):
            break
        level = (total - capped) / free
    return shares.withColumn("target", F.least("cap", F.lit(level or 0.0) * F.col("weight"))).select("source", "source_size", "weight", "target")


def _numbered(sources: DataFrame) -> DataFrame:
    """sources with `rank` from 0 in code point order, null last: sorted in ranges, and the counts of the ranges added up."""
    placed = written(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    before, starts = 0, {}
    for r in sorted(placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()):  # one row a partition
        starts[r.part], before = before, before + r.n
    if not starts:
        return placed.withColumn("rank", F.col("at")).drop("at")
    first = F.create_map(*[F.lit(x) for k, n in starts.items() for x in (k, n)])
    return placed.withColumn("rank", first[part] + F.col("at") - F.shiftleft(part, 33)).drop("at")


def _crossing(rows: Column, before: Column, budget: Column) -> Column:
    """Of an array of structs with `words`, in order, the first with which the sum reaches the budget, or the last; and the sum up to it."""
    start = F.struct(before.alias("upto"), F.lit(-1).alias("at"), F.lit(False).alias("done"))
    step = lambda s, x: F.when(s["done"], s).otherwise(F.struct((s["upto"] + x["words"]).alias("upto"), (s["at"] + 1).alias("at"), (s["upto"] + x["words"] >= budget).alias("done")))
    return F.aggregate(rows, start, step, lambda s: F.struct(s["upto"].alias("upto"), rows[s["at"]].alias("row")))


def _thresholds(sized: DataFrame, budgets: DataFrame, few: bool) -> DataFrame:
    """For each source the hash `edge` at which its budget runs out, and the words `below` and `at` it.

    budgets: source, budget, floor_h, most; only documents with a hash over floor_h and
    a size of at most `most` count. A source whose words all fit has its largest hash as
    edge; one without such documents has no row. few: budgets may be broadcast. A source's
    buckets are first folded into groups of neighbours, so that its at most 64 groups, not its
    4096 buckets, come together in one task.
    """
    side = F.broadcast if few else lambda table: table
    start = {"lo": F.lit(0).cast("long"), "bits": F.lit(HASH_BITS), "before": F.lit(0).cast("long")}
    state, found = budgets.withColumnRenamed("source", "s").withColumns(start), None
    of = ["s", "budget", "floor_h", "most", "before", "bits"]
    while True:
        one = sized.where("size > 0").join(side(state), F.col("source").eqNullSafe(F.col("s")))
        one = one.where("h > floor_h and size <= most and shiftright(h, bits) = shiftright(lo, bits)")
        finer = F.greatest(F.col("bits") - LEVEL_BITS, F.lit(0))
        one = one.withColumns({"bits": finer, "bucket": F.expr(f"shiftright(h, greatest(bits - {LEVEL_BITS}, 0))")})
        summed = one.groupBy(*of, "bucket").agg(F.sum("size").alias("words"), F.min("h").alias("h_min"), F.max("h").alias("h_max"))
        folded = summed.groupBy(*of, F.shiftright("bucket", LEVEL_BITS // 2).alias("group")).agg(F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("bucket", "words", "h_min", "h_max"))).alias("buckets"))
        groups = folded.groupBy(*of).agg(F.sort_array(F.collect_list(F.struct("group", "words", "buckets"))).alias("groups"))
        met = groups.withColumn("g", _crossing(F.col("groups"), F.col("before"), F.col("budget")))
        met = met.withColumn("b", _crossing(F.col("g.row.buckets"), F.col("g.upto") - F.col("g.row.words"), F.col("budget")))
        hit = written(met.select("s", "budget", "floor_h", "most", "bits", "b.row.*", "b.upto").withColumn("before", F.col("upto") - F.col("words")))
        done = hit.where("h_min = h_max").select("s", F.col("h_min").alias("edge"), F.col("before").alias("below"), F.col("words").alias("at"))
        found = done if found is None else found.union(done)
        state = hit.where("h_min < h_max").select("s", "budget", "floor_h", "most", F.expr("shiftleft(bucket, bits)").alias("lo"), "bits", "before")
        if not state.take(1):
            return found


def _plan(docs: DataFrame, weights: DataFrame | None, id_col: str, text_col: str, source_col: str, max_passes: int, fill_rounds: int) -> tuple[DataFrame, DataFrame]:
    """The sizes and hashes of all documents, and for each source its target, whole passes and hash rules."""
    sized = written(docs.select(F.col(id_col).alias("row_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), mix_hash(F.col(id_col), F.col(text_col)).alias("h")))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        sources = _numbered(sources).withColumn("weight", (F.pmod("rank", F.lit(3)) + 1).cast("double")).drop("rank")
    else:
        given = weights.select(F.col("source").alias("s"), F.col("weight").cast("double").alias("weight"))
        sources = written(sources.join(given, F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    plan = share_targets(sources, max_passes)
    whole = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("left", (F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    none = F.lit(None).cast("long")
    plan = written(plan.withColumns({"floor_h": F.lit(-1).cast("long"), "edge_a": none, "at_a": none, "rules": F.array().cast("array<struct<after:bigint,upto:bigint,most:bigint>>")}))
    few = plan.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    side = F.broadcast if few else lambda table: table
    for n in range(fill_rounds + 1):
        most = F.col("left") if n else F.lit(ANY_SIZE)
        budgets = plan.where("left > 0").select("source", F.col("left").alias("budget"), "floor_h", most.cast("long").alias("most"))
        if not budgets.take(1):
            break
        joined = plan.join(_thresholds(sized, budgets, few), F.col("source").eqNullSafe(F.col("s")), "left")
        found, fits = F.col("edge").isNotNull(), F.col("below") + F.col("at") <= F.col("left")
        rule = F.struct(F.col("floor_h").alias("after"), F.when(fits, F.col("edge")).otherwise(F.col("edge") - 1).alias("upto"), most.cast("long").alias("most"))
        change = {
            "rules": F.when(found, F.concat("rules", F.array(rule))).otherwise(F.col("rules")),
            "left": F.when(found, F.col("left") - F.col("below") - F.when(fits, F.col("at")).otherwise(0)).otherwise(F.col("left")),
            "floor_h": F.coalesce("edge", "floor_h"),
        }
        if n == 0:
            change |= {"edge_a": F.when(~fits, F.col("edge")), "at_a": F.when(~fits, F.col("at"))}
        plan = written(joined.withColumns(change).select(*plan.columns))
    edge_rule = F.array(F.struct((F.col("edge_a") - 1).alias("after"), F.col("edge_a").alias("upto"), F.lit(ANY_SIZE).cast("long").alias("most")))
    rules = F.when(F.coalesce(F.col("at_a") < 2 * F.col("left"), F.lit(False)), F.concat("rules", edge_rule)).otherwise(F.col("rules"))
    plan = plan.select(F.col("source").alias("_mix_source"), F.col("source_size").alias("_mix_size"), F.col("target").alias("_mix_target"), F.col("whole").alias("_mix_whole"), rules.alias("_mix_rules"))
    return sized, side(plan)


def _passes(rows: DataFrame, plan: DataFrame, source: str, size: str, h: str) -> tuple[DataFrame, str]:
    """rows with their plan (its five columns in order) and a column, whose name is given too: how often each is taken."""
    key, _, _, whole, rules = plan.columns
    met = rows.join(plan, F.col(source).eqNullSafe(F.col(key)), "left")
    extra = F.exists(rules, lambda r: (F.col(h) > r["after"]) & (F.col(h) <= r["upto"]) & (F.col(size) <= r["most"]))
    name = fresh(met, "passes_")
    return met.withColumn(name, F.when(F.col(size) > 0, F.coalesce(F.col(whole) + extra.cast("long"), F.lit(0))).otherwise(0)), name


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_passes: int = MAX_PASSES, fill_rounds: int = 2) -> DataFrame:
    """Every document with the words the mix takes of it: row_id, source, size, source_size, target, taken.

    weights: (source, weight) with weight > 0, one row a source; a source it lacks gets none.
    Without it, sources in code point order (null last) weigh 1, 2, 3, repeating. The sources
    that have a weight share the sum of their own sizes; what the others hold is left out. Documents are taken whole: `taken` is a multiple of
    `size`, at most max_passes times it. A source first takes all documents below the hash at
    which its budget would be passed; fill_rounds more thresholds then pass over the documents
    above that fit into what is left; last, the document on the first edge is added if that
    ends nearer to the target. A null or empty text has size 0 and takes 0. Rows with the same
    id and text have one hash, so they are taken together or not at all. An empty table gives
    an empty result; columns beside the three named are ignored.
    """
    sized, plan = _plan(docs, weights, id_col, text_col, source_col, max_passes, fill_rounds)
    rows, passes = _passes(sized, plan, "source", "size", "h")
    whole = {"source_size": F.coalesce("_mix_size", F.lit(0)).cast("long"), "target": F.coalesce("_mix_target", F.lit(0.0)), "taken": F.col("size") * F.col(passes)}
    return rows.select("row_id", "source", "size", *[c.alias(k) for k, c in whole.items()])


def mixed_documents(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_passes: int = MAX_PASSES, fill_rounds: int = 2) -> DataFrame:
    """docs themselves, each row as many times as mix_sources takes it, with all their columns.

    The thresholds are applied to the rows where they lie: no text is shuffled.
    """
    _, plan = _plan(docs, weights, id_col, text_col, source_col, max_passes, fill_rounds)
    words, h, number = (fresh(docs, c) for c in ("words_", "h_", "pass_"))
    plan = plan.withColumnsRenamed({c: fresh(docs, c) for c in plan.columns})
    rows = docs.withColumns({words: word_count(F.col(text_col)), h: mix_hash(F.col(id_col), F.col(text_col))})
    rows, passes = _passes(rows, plan, source_col, words, h)
    rows = rows.where(F.col(passes) > 0).withColumn(number, F.explode(F.sequence(F.lit(1), F.col(passes))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
