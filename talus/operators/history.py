"""Histories: removal reasons in order, duplicates, metadata, temporal splits and per-category statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talus.functions.text import collapse, has_text, rating_text, valid_rating
from talus.operators.order import first_of
from talus.plans.specs import TEMPLATE_CHARS, SourceSpec

# Reasons of removal, in the order in which they are tried.
NO_TIME, NO_RATING, NO_EVIDENCE, DUPLICATE, TEMPLATE = "missing_or_invalid_timestamp", "missing_or_invalid_rating", "insufficient_text_evidence", "duplicate_review", "fulfillment_or_template:"
EMPTY_POST, DUPLICATE_POST = "empty_title_and_text", "duplicate_post"


def _text(name: str, columns: set[str]) -> Column:
    return collapse(F.col(name)) if name in columns else F.lit("")


def template_match(title: Column, text: Column, patterns: tuple[str, ...]) -> Column:
    """The first pattern that a short remark contains, regardless of case; else null."""
    both = F.trim(F.concat_ws(" ", F.when(title != "", title), F.when(text != "", text)))
    found = F.coalesce(*[F.when(both.rlike(f"(?iU){p}"), F.lit(p)) for p in patterns], F.lit(None).cast("string")) if patterns else F.lit(None).cast("string")
    return F.when((both != "") & (F.length(both) <= TEMPLATE_CHARS), found)


_CLEAN = ("title", "text", "product_title", "product_main", "product_url")


def with_clean(items: DataFrame) -> DataFrame:
    """items with cleaned texts as ``_c_`` columns: made once, in a step of their own, however often they are used."""
    has = set(items.columns)
    return items.withColumns({f"_c_{n}": _text(n, has) for n in _CLEAN})


def content_key(items: DataFrame, spec: SourceSpec) -> list[Column]:
    """What makes two rows of a user the same; items with cleaned texts."""
    has = set(items.columns)
    plain = lambda n: F.coalesce(F.col(n).cast("string"), F.lit("")) if n in has else F.lit("")
    low = lambda n: F.lower(F.col(f"_c_{n}"))
    return {
        "review": lambda: [plain("category"), plain("parent_id"), plain("product_id"), plain("ts_ms"), low("title"), low("text"), low("product_title")],
        "shop": lambda: [plain("category"), plain("rating"), plain("ts_ms"), low("text"), low("product_title"), low("product_url")],
        "qa": lambda: [plain("post_type"), plain("ts_ms"), low("title"), low("text")],
        "forum": lambda: [plain("item_id"), plain("text_hash"), plain("thread"), plain("ts_ms"), low("text")],
    }[spec.cascade]()


def removal_reasons(items: DataFrame, spec: SourceSpec) -> DataFrame:
    """items with reason, null for rows that stay.

    Rows alike in content agree on every reason but ``duplicate``, so that one is settled last, by the first of the rows that
    no other reason removes: the result is that of trying reasons row by row.
    """
    has, items = set(items.columns), with_clean(items)
    title, text, product, main = (F.col(f"_c_{n}") for n in ("title", "text", "product_title", "product_main"))
    reason = F.lit(None).cast("string")
    if spec.cascade in ("review", "shop"):
        bare = (product == "") & (F.length(text) < spec.min_text)
        if spec.cascade == "review":
            path = F.size(F.coalesce("product_path", F.array().cast("array<string>"))) == 0 if "product_path" in has else F.lit(True)
            bare = bare & (main == "") & path & (title == "")
        reason = F.when(F.col("ts_ms").isNull(), NO_TIME).when(~valid_rating(F.col("rating")), NO_RATING).when(bare, NO_EVIDENCE)
        if spec.filter_templates:
            reason = F.coalesce(reason, F.concat(F.lit(TEMPLATE), template_match(title, text, spec.templates)))
    elif spec.cascade == "qa":
        reason = F.when((title == "") & (text == ""), EMPTY_POST)
    elif spec.cascade == "forum":
        reason = F.when(F.col("ts_ms").isNull(), NO_TIME).when(F.length(text) < spec.min_text, NO_EVIDENCE)
    keyed = items.select(
        *sorted(has, key=items.columns.index), reason.alias("_reason"), F.sha2(F.concat_ws("\u0001", *content_key(items, spec)), 256).alias("_same")
    )
    w = Window.partitionBy("user_id", "_same", F.col("_reason").isNull()).orderBy("source_index")
    repeated = F.when(F.col("_reason").isNull() & (F.row_number().over(w) > 1), DUPLICATE_POST if spec.cascade == "qa" else DUPLICATE)
    return keyed.withColumn("reason", F.coalesce("_reason", repeated)).drop("_reason", "_same")


def kept_items(judged: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rows that stay, of users with enough of them."""
    stay = judged.filter("reason is null").drop("reason")
    n = F.count("*").over(Window.partitionBy("user_id"))
    return stay.withColumn("_rows", n).filter(F.col("_rows") >= spec.min_rows).drop("_rows")


def removal_summary(judged: DataFrame) -> DataFrame:
    """Per user: rows put in, kept and removed, and maps of the removed by reason and by category."""
    counts = judged.groupBy("user_id").agg(F.count("*").alias("input_rows"), F.count_if(F.col("reason").isNull()).alias("kept_rows"))
    gone = judged.filter("reason is not null")

    def by(column: Column, out: str) -> DataFrame:
        each = gone.groupBy("user_id", column.alias("k")).agg(F.count("*").alias("n"))
        return each.groupBy("user_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias(out))

    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    out = counts.join(by(F.col("reason"), "removed_by_reason"), "user_id", "left").join(
        by(F.coalesce(F.nullif("category", F.lit("")), F.lit("Unknown")), "removed_by_category"), "user_id", "left"
    )
    return out.withColumn("removed_rows", F.col("input_rows") - F.col("kept_rows")).withColumns({
        c: F.coalesce(c, none) for c in ("removed_by_reason", "removed_by_category")
    })


def metadata_last(meta: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key."""
    return first_of(meta, keys, *[c.desc() for c in order])


def wanted_metadata(meta: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    """Metadata of keys that items have; Spark picks the way of the semi join by size."""
    return meta.join(items.select(*keys).distinct(), keys, "left_semi")


def with_metadata(items: DataFrame, meta: DataFrame, keys: list[str]) -> DataFrame:
    return items.join(meta, keys, "left")


def only_selected(items: DataFrame, selected: DataFrame) -> DataFrame:
    """Items of selected users, with their rank."""
    return items.join(selected.select("user_id", "rank"), "user_id")


def not_done(users: DataFrame, done: DataFrame) -> DataFrame:
    return users.join(done.select("user_id").distinct(), "user_id", "left_anti")


def history_order(spec: SourceSpec, newest_first: bool = False) -> list[Column]:
    if spec.cascade == "review":
        order = [F.col("ts_ms"), F.coalesce(F.col("product_id").cast("string"), F.lit("")), F.col("source_index")]
        return [c.desc() for c in order] if newest_first else order
    if newest_first:
        return [F.col("ts_ms").desc_nulls_first(), F.col("source_index").desc()]
    return [F.col("ts_ms").asc_nulls_last(), F.col("source_index")]


def temporal_split(kept: DataFrame, spec: SourceSpec) -> DataFrame:
    """Items with place (from 1), rows, and part: construction or validation. At least one row lies on each side."""
    user = Window.partitionBy("user_id")
    placed = kept.withColumn("place", F.row_number().over(user.orderBy(*history_order(spec)))).withColumn("rows", F.count("*").over(user))
    if spec.split is None:
        return placed.withColumn("part", F.lit("construction"))
    cut = F.greatest(F.lit(1), F.least(F.floor(F.col("rows") * F.lit(spec.split)).cast("int"), (F.col("rows") - 1).cast("int")))
    return placed.withColumn("part", F.when(F.col("place") <= cut, "construction").otherwise("validation"))


def with_has_text(items: DataFrame) -> DataFrame:
    """items with has_text: where only that is asked of texts later on, no text need move through the steps between."""
    return items.withColumn("has_text", has_text(F.col("text")))


def split_summary(split: DataFrame) -> DataFrame:
    """Per user: rows, rows with text and rated rows of either part, and the times at the cut. A column has_text stands for texts."""
    split = split if "has_text" in split.columns else with_has_text(split)
    filled, rated = F.col("has_text"), valid_rating(F.col("rating")) if "rating" in split.columns else F.lit(False)
    out = []
    for part in ("construction", "validation"):
        here = F.col("part") == part
        out += [
            F.count_if(here).alias(f"{part}_rows"), F.count_if(here & filled).alias(f"{part}_text_rows"),
            F.count_if(here & rated).alias(f"{part}_rated_rows")
        ]
    last = F.max_by("ts_ms", F.when(F.col("part") == "construction", F.col("place"))).alias("construction_last")
    first = F.min_by("ts_ms", F.when(F.col("part") == "validation", F.col("place"))).alias("validation_first")
    return split.groupBy("user_id").agg(*out, last, first)


def category_stats(kept: DataFrame) -> DataFrame:
    """Per user and category: rows, rows with text, bare ratings, characters, rated rows and the mean rating."""
    kept = with_clean(kept)
    title, text, rated = F.col("_c_title"), F.col("_c_text"), valid_rating(F.col("rating"))
    score = F.when(rated, F.col("rating").cast("double"))
    each = kept.groupBy("user_id", F.coalesce(F.nullif("category", F.lit("")), F.lit("Unknown")).alias("category"))
    return each.agg(
        F.count("*").alias("items"), F.count_if(text != "").alias("text_items"), F.count_if((text == "") & (title == "")).alias("rating_only"),
        F.sum(F.length(text)).alias("text_chars"), F.count(score).alias("rated"), F.round(F.avg(score), 3).alias("mean_rating")
    )


def counters(kept: DataFrame, value: Column, out: str = "value") -> DataFrame:
    """Per user, category and value: how often; null values don't count."""
    each = kept.withColumn(out, value).filter(F.col(out).isNotNull())
    return each.groupBy("user_id", F.coalesce(F.nullif("category", F.lit("")), F.lit("Unknown")).alias("category"), out).agg(F.count("*").alias("n"))


def rating_value(rating: Column) -> Column:
    return F.when(valid_rating(rating), rating_text(rating.cast("double")))


def top_counters(counted: DataFrame, most: int, value: str = "value") -> DataFrame:
    """The most frequent values of each user and category, ties by value."""
    w = Window.partitionBy("user_id", "category").orderBy(F.col("n").desc(), value)
    return counted.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)
