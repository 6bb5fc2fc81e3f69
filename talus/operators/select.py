"""Users: first-wins rows, aggregates, thresholds, weighted percentile scores and the ranking.

Items are rows with user_id, item_id, category or tags, ts_ms, text, title, source_index and, where a source has them,
verified and score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talus.functions.text import has_text, loose_double, shard
from talus.operators.order import first_of, percentiles
from talus.plans.specs import SourceSpec

DAY_MS = 86_400_000
#: Steps of the score in which users are counted.
STEPS = 1 << 14
#: What a user's items are grouped by, where it isn't their category.
GROUPS = {"qa": "tags", "forum": "thread"}


def ingest_filter(items: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rows with a user and, unless the source keeps undated rows, a time; within the years as a range of milliseconds that scans can use."""
    kept = items.filter(F.coalesce("user_id", F.lit("")).cast("string") != "")
    if not spec.keep_undated:
        kept = kept.filter(F.col("ts_ms").isNotNull())
    if spec.years:
        start, end = (F.unix_date(F.make_date(F.lit(y), F.lit(1), F.lit(1))).cast("long") * DAY_MS for y in (spec.years[0], spec.years[1] + 1))
        kept = kept.filter((F.col("ts_ms") >= start) & (F.col("ts_ms") < end))
    return kept


def with_shard(items: DataFrame, spec: SourceSpec) -> DataFrame:
    return items.withColumn("shard", shard(F.col("user_id"), spec.shards))


def distinct_items(items: DataFrame, spec: SourceSpec) -> DataFrame:
    """The first row of each item id within a shard."""
    return first_of(with_shard(items, spec), ["shard", "item_id"], F.col("source_index"))


def measured(items: DataFrame, spec: SourceSpec) -> DataFrame:
    """items with what user_metrics takes of each row in place of its texts; made before rows are dealt anew, so that no text moves."""
    columns, text = set(items.columns), F.coalesce("text", F.lit(""))
    chars = F.length(text) + (F.length(F.coalesce("title", F.lit(""))) if spec.cascade == "qa" else 0)
    sums = {
        "_items": F.lit(1).cast("long"), "_text_items": has_text(text).cast("long"), "_text_chars": chars.cast("long"),
        "_verified": F.col("verified").cast("long") if "verified" in columns else F.lit(0).cast("long"),
        "_score": loose_double(F.col("score"), 0.0) if "score" in columns else F.lit(0.0),
    }
    own = [c for c in ("user_id", "item_id", "shard", "source_index", "ts_ms", GROUPS.get(spec.cascade, "category")) if c in columns]
    return items.select(*own, *[c.alias(n) for n, c in sums.items()])


def user_metrics(items: DataFrame, spec: SourceSpec) -> DataFrame:
    """One row per user: items, categories, text_items, text_chars, history_days, verified_share, score_sum and first_seen. items may be measured.

    Scores of posts are added in the order of source_index, since sums of fractions depend on theirs and ordinal places on the last digit.
    """
    rows = items if "_text_chars" in items.columns else measured(items, spec)
    sums = {"items": "_items", "text_items": "_text_items", "text_chars": "_text_chars", "_verified": "_verified"}
    ends = [F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.min("first_seen").alias("first_seen")]
    own = [F.col("ts_ms").alias("_from"), F.col("ts_ms").alias("_to"), F.col("source_index").alias("first_seen"), *[F.col(c).alias(n) for n, c in sums.items()]]
    total = [F.sum(n).alias(n) for n in sums]
    if spec.cascade == "qa":
        upto = Window.partitionBy("user_id").orderBy("source_index").rowsBetween(Window.unboundedPreceding, 0)
        rows, own = rows.withColumn("_upto", F.sum("_score").over(upto)), [*own, F.struct(F.col("source_index").alias("at"), F.col("_upto").alias("sum")).alias("_last")]
        ends.append(F.max("_last").alias("_last"))
        # a row for each tag of an item, the item's numbers beside the first; each tag of a user becomes one row, so no list of tags is gathered
        each = rows.select("user_id", *own, F.posexplode_outer("tags").alias("_pos", "_tag"))
        each = each.withColumns({n: F.when(F.coalesce("_pos", F.lit(0)) == 0, F.col(n)) for n in sums})
        by_tag = each.groupBy("user_id", "_tag").agg(*total, *ends)
        users = by_tag.groupBy("user_id").agg(*total, *ends, F.count("_tag").alias("categories"))
        users = users.withColumn("score_sum", F.col("_last.sum")).drop("_last")
    else:
        group = GROUPS.get(spec.cascade, "category")
        score = F.sum("_score").alias("score_sum")
        users = rows.select("user_id", group, "_score", *own).groupBy("user_id").agg(*total, *ends, score, F.count_distinct(group).alias("categories"))
    days = F.coalesce((F.col("_to") - F.col("_from")) / F.lit(float(DAY_MS)), F.lit(0.0))
    return users.withColumn("history_days", days).withColumn("verified_share", F.col("_verified") / F.col("items")).drop("_from", "_to", "_verified")


def metrics_of(items: DataFrame, spec: SourceSpec) -> DataFrame:
    """user_metrics of the first row of each item id; only measures of items are dealt."""
    return user_metrics(distinct_items(measured(items, spec), spec), spec)


def eligible(users: DataFrame, spec: SourceSpec) -> DataFrame:
    kept = users.filter((F.col("items") >= spec.min_count) & (F.col("text_chars") >= spec.min_chars))
    return kept.filter(F.col("verified_share") >= spec.min_verified) if spec.min_verified is not None else kept


def score_users(users: DataFrame, spec: SourceSpec) -> DataFrame:
    """users with score, the weighted sum of the metrics' percentiles, added in the order of the weights."""
    shares = percentiles(users, "user_id", list(spec.weights), "first_seen" if spec.ordinal else None)
    found = F.map_from_entries(F.collect_list(F.struct("metric", "share")))
    scores = shares.groupBy("user_id").agg(found.alias("_p"))
    score = sum((F.lit(w) * F.col("_p")[m] for m, w in spec.weights.items()), F.lit(0.0))
    return users.join(scores.select("user_id", score.alias("score")), "user_id")


def rank_users(scored: DataFrame, spec: SourceSpec) -> DataFrame:
    """The top_k users by score, then the tie-breaks downwards, then the id; rank from 1. Scores are compared to 12 digits, so that the order of sums can't decide.

    Scores lie between 0 and 1. Users are counted in STEPS steps of it; those steps that the top_k reaches are ranked, each by
    itself, so no task gets the candidates of all.
    """
    order = [F.round("score", 12).desc(), *[F.col(t).desc() for t in spec.ties], F.col("user_id").cast("string").asc()]
    stepped = scored.withColumn("_step", F.floor(F.round("score", 12) * STEPS).cast("int"))
    steps = stepped.groupBy("_step").agg(F.count("*").alias("_n"))
    above = F.sum("_n").over(Window.orderBy(F.col("_step").desc()).rowsBetween(Window.unboundedPreceding, -1))
    reached = steps.select("_step", F.coalesce(above, F.lit(0)).alias("_above")).filter(F.col("_above") < spec.top_k)
    placed = stepped.withColumn("_place", F.row_number().over(Window.partitionBy("_step").orderBy(*order))).filter(F.col("_place") <= spec.top_k)
    ranked = placed.join(F.broadcast(reached), "_step").withColumn("rank", (F.col("_above") + F.col("_place")).cast("int"))  # STEPS + 1 rows at most
    return ranked.filter(F.col("rank") <= spec.top_k).drop("_step", "_above", "_place")


def select_users(items: DataFrame, spec: SourceSpec) -> DataFrame:
    return rank_users(score_users(eligible(metrics_of(items, spec), spec), spec), spec)
