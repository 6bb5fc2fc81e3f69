"""Mixing sources to target weights by Pareto order sampling.

Each source gets its share of all words by weight, at most ``repeats`` times its size; what a full source leaves goes to the
others by weight. Inside a source of target T, a document of weight w is to be there min(repeats, a * w) times on average, with
the one a for which that makes T words. The whole copies of that number are certain. Its fraction is the document's probability
of one more copy: documents are ranked by random odds divided by the odds of that probability, and taken in that order until T
is full. Documents larger than T have no copies, of the others only those that fit what the sample has to fill are ranked, and in
the end the one document that fits the remaining gap best comes in if it brings the source nearer T; so probabilities are kept
up to a document or two for each source.

Ranks need no sort of a source: words are summed in bins of the rank, and only the bin in which the target falls is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talus.llm.common import staged, word_count

REPEATS, BINS, SEED = 3, 4096, "mix-1"
WEIGHTS = (1, 2, 3)


def targets(sizes: DataFrame, repeats: int = REPEATS, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Of _key, _source, source_size (a row each source): target. Sources by code point, null last, get the weights in turn."""
    one = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn(
        "_w",
        F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]),
            (F.pmod(F.row_number().over(one.orderBy(F.col("_source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int")
        )
    )
    order = one.orderBy(F.col("source_size") / F.col("_w"), "_key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(one) - repeats * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (F.sum("_w").over(one) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    filled = ranked.withColumn("_level", level).withColumn("_n", F.row_number().over(order))
    filled = filled.withColumn("_at", F.when(F.col("_level") * F.col("_w") <= repeats * F.col("source_size"), F.struct("_n", "_level")))
    return filled.withColumn(
        "target", F.least(F.col("source_size") * F.lit(float(repeats)), F.col("_w") * F.min("_at").over(one)["_level"])
    ).select("_key", "source_size", "target")


def uniform(*parts: Column) -> Column:
    """A number between 0 and 1 that depends on the parts only; nulls are skipped."""
    return (F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def binary_digits(size: Column) -> Column:
    return F.length(F.bin(size)).cast("double")


def _class_weight(weight: Column) -> Column:
    """Weights rounded to eighths of a doubling, so that they fall in a bounded number of classes; null, and what is no positive number, counts as 1."""
    w = weight.cast("double")
    fine = (w > 0) & (w < float("inf"))
    return F.when(F.coalesce(fine, F.lit(False)), F.pow(F.lit(2.0), F.round(F.log2(w) * 8) / 8)).otherwise(1.0)


def shares(classes: DataFrame, repeats: int) -> DataFrame:
    """Of _key, target, _w and _words (a row for each class of weight): _sure, whole copies, and _share, the probability of one more."""
    heavy = Window.partitionBy("_key").orderBy(F.col("_w").desc())
    full = repeats * F.coalesce(F.sum("_words").over(heavy.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    mass = F.sum(F.col("_words") * F.col("_w")).over(heavy.rowsBetween(0, Window.unboundedFollowing))
    classes = classes.withColumn("_level", F.when(mass > 0, (F.col("target") - full) / mass))
    heaviest = F.max(F.when(F.col("_level") * F.col("_w") <= repeats, F.struct("_w", "_level"))).over(Window.partitionBy("_key"))  # of those that aren't full
    times = F.least(F.lit(float(repeats)), F.coalesce(heaviest["_level"] * F.col("_w"), F.lit(float(repeats))))
    classes = classes.withColumn("_times", times).withColumn("_sure", F.floor(F.col("_times") + 1e-9))
    part = F.col("_times") - F.col("_sure")
    return classes.select("_key", "_w", "_words", "_sure", F.when(part < 1e-9, 0.0).otherwise(F.least(F.lit(0.999999), part)).alias("_share"))


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weight: str | None = None, keep: tuple[str, ...] = (),
    repeats: int = REPEATS, weights: tuple[float, ...] = WEIGHTS, seed: str = SEED,
) -> DataFrame:
    """doc_id, the columns in keep, size, source_size, target, taken (words, repeats counted) and copies for every row.

    weight: a column of positive numbers that a document's copies are proportional to, as far as repeats allows, rounded to
    eighths of a doubling; null counts as 1. By default the number of binary digits of the size, so that longer documents come
    more often. A null text has size 0; documents of size 0 take no words. A null source is a source of its own, the last one.
    Repeated rows are documents of their own. Sources without words have target 0. Reruns take the same words. An empty table
    gives an empty result.
    """
    if clash := {"doc_id", "size", "source_size", "target", "taken", "copies"} & set(keep):
        raise ValueError(f"keep names columns of the result: {sorted(clash)}")
    each = docs.select(
        docs[doc_id].alias("doc_id"), docs[source].alias("_source"), word_count(docs[text]).alias("size"),
        (_class_weight(docs[weight]) if weight else F.lit(None).cast("double")).alias("_w"),
        uniform(F.lit(seed), docs[doc_id].cast("string"), F.md5(docs[text].cast("binary"))).alias("_u"),
        F.monotonically_increasing_id().alias("_row"), *[docs[c].alias(f"_keep_{c}") for c in keep],
    ).withColumn("_key", F.when(F.col("_source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("_source"))))
    each = staged(each if weight else each.withColumn("_w", binary_digits(F.col("size"))), "sizes")
    sizes = each.groupBy("_key").agg(F.first("_source").alias("_source"), F.sum("size").alias("source_size"))
    goal = staged(targets(sizes, repeats, weights), "targets")
    classes = each.join(goal, "_key").filter("size <= target").groupBy("_key", "_w").agg(F.sum("size").alias("_words"), F.first("target").alias("target"))
    parts = staged(shares(classes, repeats), "shares")
    sure = parts.groupBy("_key").agg(F.sum(F.col("_sure") * F.col("_words")).alias("_n"))
    goal = goal.join(sure, "_key", "left").withColumn("_rest", F.greatest(F.lit(0.0), F.col("target") - F.coalesce("_n", F.lit(0)))).drop("_n")
    goal = staged(goal, "goal")  # a row for each source, and Spark knows that, so that rows of a large one needn't meet in one task

    few = each.select("_key", "size", "_w", "_u", "_row")
    narrow = _ranked(few, goal, parts)
    live = narrow.filter("_live")
    bins = live.groupBy("_key", "_bin").agg(F.sum("size").alias("_sum"), F.first("_rest").alias("_rest"), F.max("_place").alias("_top"))
    by_bin = Window.partitionBy("_key").orderBy("_bin")
    before = by_bin.rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(
        "_key", "_bin", "_sum", "_rest", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"), F.max("_top").over(before).alias("_top")
    )
    cut = staged(bins.filter("_before <= _rest and _before + _sum > _rest").select("_key", F.col("_bin").alias("_cut"), "_before", "_top"), "cuts")
    inside = live.join(cut.select("_key", "_cut", "_before"), "_key").filter("_bin = _cut")
    inside = inside.withColumn(
        "_upto", F.col("_before") + F.sum("size").over(Window.partitionBy("_key", "_bin").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0))
    )
    reached = inside.filter("_upto <= _rest").groupBy("_key").agg(F.max("_upto").alias("_upto"), F.max("_place").alias("_found"))
    every = bins.groupBy("_key").agg(F.sum("_sum").alias("_all"))
    gaps = every.join(cut.select("_key", F.lit(True).alias("_cut"), "_before", "_top"), "_key", "left").join(reached, "_key", "left")
    gaps = gaps.select("_key", "_cut", F.coalesce("_upto", "_before", "_all").alias("_done"), F.coalesce("_found", "_top").alias("_top"))
    plan = staged(goal.join(gaps, "_key", "left"), "plan")

    gap = F.col("_rest") - F.coalesce("_done", F.lit(0))
    more = (F.col("_share") > 0) | (F.col("size") > F.col("target"))
    spare = _ranked(few, plan, parts).filter(more & (F.col("size") > 0) & ~_taken() & (F.abs(gap - F.col("size")) < gap))
    last = spare.groupBy("_key").agg(F.min(F.struct(F.abs(gap - F.col("size")), F.coalesce("_q", F.lit(-1.0)), "_row"))["_row"].alias("_last"))
    out = _ranked(each, staged(plan.join(last, "_key", "left"), "plan"), parts)
    copies = F.col("_sure") + (_taken() | F.coalesce(F.col("_row") == F.col("_last"), F.lit(False))).cast("long")
    kept = [F.col(f"_keep_{c}").alias(c) for c in keep]
    return out.select(
        "doc_id", *kept, "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"), copies.cast("long").alias("copies")
    )


def _ranked(rows: DataFrame, goal: DataFrame, parts: DataFrame) -> DataFrame:
    """_sure and _share of rows; _q, random odds over the odds of the probability; _place, q with a tie-break; _bin of the rank; _live: whether the row can be sampled and fits at all."""
    rows = rows.join(goal, "_key").join(parts.select("_key", "_w", "_sure", "_share"), ["_key", "_w"], "left")
    fit = lambda c: F.when(F.col("size") <= F.col("target"), F.coalesce(c, F.lit(0))).otherwise(0)
    rows = rows.withColumns({"_sure": fit("_sure"), "_share": fit("_share")})
    q = F.col("_u") / (1 - F.col("_u")) / (F.col("_share") / (1 - F.col("_share")))
    rows = rows.withColumn("_q", F.when(F.col("_share") > 0, q))
    bin_ = F.least(F.lit(BINS - 1), F.floor(F.col("_q") / (1 + F.col("_q")) * BINS))  # the cut is near q = 1
    rows = rows.withColumn("_bin", F.when(F.col("_q").isNull(), BINS).otherwise(bin_).cast("int"))
    live = F.col("_q").isNotNull() & (F.col("size") > 0) & (F.col("size") <= F.col("_rest"))
    return rows.withColumn("_place", F.struct("_q", "_row")).withColumn("_live", live)


def _taken() -> Column:
    """Whether the order reaches the row: all live rows of a source whose target no row crosses, else those up to the last that fits."""
    return F.coalesce(F.col("_live") & (~F.coalesce("_cut", F.lit(False)) | (F.col("_place") <= F.col("_top"))), F.lit(False))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, size, length(bin(size))::DOUBLE AS w, u FROM (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
      (('0x' || substr(md5(concat_ws(':', 'mix-1', doc_id::VARCHAR, md5(text))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
    FROM documents)),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
v AS (SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS v FROM s),
l AS (SELECT *, row_number() OVER o AS n,
    (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(v) OVER () - coalesce(sum(v) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM v WINDOW o AS (ORDER BY source_size / v, source NULLS FIRST)),
t AS (SELECT source, source_size, least(source_size * 3.0::DOUBLE, v * (SELECT arg_min(level, n) FROM l WHERE level * v <= 3 * source_size)) AS target FROM l),
c AS (SELECT d.source, w, sum(size)::DOUBLE AS words, any_value(target) AS target FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source WHERE size
  <= target GROUP BY d.source, w),
a AS (SELECT *, (target - 3 * coalesce(sum(words) OVER (PARTITION BY source ORDER BY w DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / nullif(sum(words * w) OVER (PARTITION BY source ORDER BY w DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS level FROM c),
b AS (SELECT *, least(3.0::DOUBLE, coalesce(arg_max(level, w) FILTER (level * w <= 3) OVER (PARTITION BY source) * w, 3.0::DOUBLE)) AS times FROM a),
g AS (SELECT *, floor(times + 1e-9::DOUBLE)::BIGINT AS sure FROM b),
p AS (SELECT source, w, sure, words, CASE WHEN times - sure < 1e-9::DOUBLE THEN 0 ELSE least(0.999999::DOUBLE, times - sure) END AS share FROM g),
z AS (SELECT t.*, greatest(0.0::DOUBLE, target - coalesce((SELECT sum(sure * words) FROM p WHERE p.source IS NOT DISTINCT FROM t.source), 0)) AS rest FROM t),
q AS (SELECT d.*, z.source_size, z.target, z.rest, size > target AS large, CASE WHEN size <= target THEN coalesce(p.sure, 0) ELSE 0 END AS sure,
    CASE WHEN size <= target AND share > 0 THEN u / (1 - u) / (share / (1 - share)) END AS q
  FROM d JOIN z ON d.source IS NOT DISTINCT FROM z.source LEFT JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.w = p.w),
r AS (SELECT *, q IS NOT NULL AND size <= rest AS live, sum(size) FILTER (q IS NOT NULL AND size <= rest) OVER (PARTITION BY source ORDER BY q, doc_id
  ROWS UNBOUNDED PRECEDING) AS upto
  FROM q WHERE size > 0 AND (q IS NOT NULL OR large)),
k AS (SELECT *, live AND upto <= rest AS taken_in, coalesce(max(CASE WHEN live AND upto <= rest THEN upto END) OVER (PARTITION BY source), 0) AS done FROM r),
f AS (SELECT *, row_number() OVER (PARTITION BY source, taken_in OR abs(rest - done - size) >= rest - done ORDER BY abs(rest - done - size),
  coalesce(q, -1)) AS n FROM k)
SELECT q.doc_id, q.size, q.source_size, q.target,
  (q.size * (q.sure + CASE WHEN f.taken_in OR (f.n = 1 AND NOT f.taken_in AND abs(f.rest - f.done - f.size) < f.rest - f.done) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM q LEFT JOIN f ON q.doc_id = f.doc_id
"""
