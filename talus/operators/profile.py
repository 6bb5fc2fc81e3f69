"""Profiles: items as text, summaries, and the whole fitted to a number of characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talus.functions.text import collapse, truncate
from talus.operators.history import history_order
from talus.plans.specs import SourceSpec

TOP_CATEGORIES, SUMMARY_CHARS = 12, 4_000


def _line(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}: "), value)


def _or(value: Column, instead: str) -> Column:
    return F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit(instead))


def _if(value: Column, line: Column) -> Column:
    return F.when(F.coalesce(value, F.lit("")) != "", line)


def shown_text(spec: SourceSpec) -> Column:
    """An item's text as its profile shows it."""
    return truncate(F.col("text"), spec.text_chars) if not spec.whole_items else collapse(F.col("text"))


def render_item(spec: SourceSpec, place: Column, has: set[str]) -> Column:
    """One item's lines; lines without a value are left out where the source leaves them out. A column _shown stands for shown_text."""
    c = lambda n: F.col(n) if n in has else F.lit(None).cast("string")
    text = F.col("_shown") if "_shown" in has else shown_text(spec)
    product = truncate(c("product_title"), 220)
    if spec.cascade == "review":
        path = F.transform(
            F.coalesce(c("product_path") if "product_path" in has else F.array().cast("array<string>"), F.array().cast("array<string>")),
            lambda x: truncate(x, 80)
        )
        lines = [
            F.concat(F.lit("[review "), place.cast("string"), F.lit("]")), _line("date", _or(c("ts_ms"), "unknown")),
            _line("category", _or(c("category"), "Unknown")),
            _line("parent", _or(F.coalesce(c("parent_id").cast("string"), c("product_id").cast("string")), "")),
            _line("rating", _or(c("rating"), "unknown")), _line("review_title", _or(collapse(c("title")), "(untitled)")),
            _if(product, _line("product_title", product)), _if(c("product_main"), _line("product_main_category", truncate(c("product_main"), 120))),
            F.when(F.size(path) > 0, _line("product_category_path", F.array_join(path, " > "))),
            _line("verified", _or(c("verified"), "unknown")), _line("helpful_vote", _or(c("helpful"), "0")), _line("text", text),
        ]
    elif spec.cascade == "shop":
        lines = [
            F.concat(F.lit("[review "), place.cast("string"), F.lit("]")), _line("timestamp", _or(c("timestamp"), "unknown")),
            _line("category", _or(c("category"), "Unknown")), _line("rating", _or(c("rating"), "unknown")),
            _if(product, _line("product_title", product)), _if(c("product_url"), _line("product_url", collapse(c("product_url")))),
            _line("text", text)
        ]
    elif spec.cascade == "qa":
        tags = F.array_join(F.col("tags"), ", ") if "tags" in has else F.lit("")
        lines = [
            F.concat(F.lit("[post p"), F.lpad(place.cast("string"), 4, "0"), F.lit("]")), _line("date", _or(c("date"), "unknown")),
            _line("type", _or(c("post_type"), "post")), _line("tags", _or(tags, "(none)")),
            _line("title", _or(c("title"), "(untitled)")), _line("score", _or(c("score"), "unknown")), _line("accepted", _or(c("accepted"), "n/a")),
            _line("text", text),
        ]
    else:
        lines = [
            F.concat(F.lit("[post "), place.cast("string"), F.lit("]")), _line("timestamp", _or(c("timestamp"), "unknown")),
            _line("thread_id", _or(c("thread"), "unknown")), _line("text", text)
        ]
    return F.concat_ws("\n", *lines)


def newest(items: DataFrame, most: int, order: list[Column]) -> DataFrame:
    """The first ``most`` items of each user by an order that has the newest first, with place from 1 for the oldest of them; 0: all.

    Each task keeps no more than ``most`` of a user before the shuffle.
    """
    user = Window.partitionBy("user_id")
    placed = items.withColumn("_from_end", F.row_number().over(user.orderBy(*order)))
    kept = placed.filter(F.col("_from_end") <= most) if most else placed
    return kept.withColumn("place", (F.count("*").over(user) - F.col("_from_end") + 1).cast("int")).drop("_from_end")


def _chars(rendered: DataFrame) -> Column:
    return F.col("_chars") if "_chars" in rendered.columns else F.length("rendered")


def suffix_fit(rendered: DataFrame, most: int, joint: int = 2) -> DataFrame:
    """The newest rendered items of each user that, joined, have no more than ``most`` characters; lengths only add up, so one running sum finds them."""
    w = Window.partitionBy("user_id").orderBy(F.col("place").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return rendered.withColumn("_upto", F.sum(_chars(rendered) + joint).over(w) - joint).filter(F.col("_upto") <= most).drop("_upto")


def prefix_fit(rendered: DataFrame, most: int, joint: int = 2) -> DataFrame:
    """The oldest rendered items of each user that begin within ``most`` characters of the joined text, and _items, how many there are in all."""
    user = Window.partitionBy("user_id").orderBy("place")
    before = F.coalesce(F.sum(_chars(rendered) + joint).over(user.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = rendered.withColumn("_before", before).withColumn("_items", F.count("*").over(Window.partitionBy("user_id")))
    return counted.filter(F.col("_before") < most).drop("_before")


def joined(rendered: DataFrame) -> DataFrame:
    """Per user the items' text in order, parted by blank lines. What comes in is cut to a number of characters by ``prefix_fit`` or ``suffix_fit``, so the list is bounded."""
    # rows that windows have sorted by user are put together one user at a time; a hash of lists would sort all texts again, and spill them
    rendered.sparkSession.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")
    ordered = F.array_sort(F.collect_list(F.struct("place", "rendered")))
    count = F.max("_items") if "_items" in rendered.columns else F.count("*")
    return rendered.groupBy("user_id").agg(F.array_join(F.transform(ordered, lambda x: x["rendered"]), "\n\n").alias("body"), count.alias("profile_items"))


def two_decimals(x: Column) -> Column:
    """A number from 0 to 20 to two decimals, halves to even, by the number's exact binary value as printf does."""
    exact = (x * F.lit(float(1 << 52))).cast("bigint") * 100
    low = F.shiftright(exact, 52)
    rest, half = exact - F.shiftleft(low, 52), F.lit(1 << 51)
    n = low + ((rest > half) | ((rest == half) & (low % 2 == 1))).cast("bigint")
    return F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0"))


def format_counts(entries: Column, most: int) -> Column:
    """'a=2, b=1' of an array of (value, n), most frequent first, ties by value."""
    keyed = F.array_sort(F.transform(entries, lambda e: F.struct((-e["n"]).alias("neg"), e["value"].alias("value"))))
    return F.array_join(F.transform(F.slice(keyed, 1, most), lambda e: F.concat(e["value"], F.lit("="), (-e["neg"]).cast("string"))), ", ")


def summary(stats: DataFrame, spec: SourceSpec, parts: DataFrame | None = None) -> DataFrame:
    """Per user one line: counts of the split (where there is one) and of the twelve largest categories.

    stats: as category_stats gives, with optional arrays ratings, products and bare_products of (value, n).
    """
    mean = F.coalesce(two_decimals(F.col("mean_rating")), F.lit("unknown"))
    if spec.cascade == "review":
        fields = [
            ("category", F.col("category")), ("rows", F.col("items")), ("text_reviews", F.col("text_items")), ("rating_only", F.col("rating_only")),
            ("mean_rating", mean)
        ]
        fields += [
            (label, F.nullif(format_counts(F.col(c), n), F.lit("")))
            for label, c, n in (("ratings", "ratings", 5), ("product_categories", "products", 4), ("rating_only_products", "bare_products", 3))
            if c in stats.columns
        ]
        head = "=== Summary Stats ==="
    else:
        fields = [
            ("category", F.col("category")), ("review_count", F.col("items")), ("text_chars", F.col("text_chars")), ("rating_count", F.col("rated")),
            ("mean_rating", mean)
        ]
        head = "=== Category Summary ==="
    line = F.concat_ws("; ", *[F.concat(F.lit(f"{label}="), v.cast("string")) for label, v in fields])
    w = Window.partitionBy("user_id").orderBy(F.col("items").desc(), "category")
    top = stats.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= TOP_CATEGORIES).withColumn("line", line)
    lines = top.groupBy("user_id").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "\n"
    ).alias("lines"))
    first = F.lit(head)
    if parts is not None:
        lines = lines.join(parts, "user_id", "left")
        n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
        first = F.concat(
            first, F.lit("\nconstruction_rows: "), n("construction_rows"), F.lit("; validation_rows: "), n("validation_rows"),
            F.lit("; construction_text_reviews: "), n("construction_text_rows"), F.lit("; construction_ratings: "), n("construction_rated_rows")
        )
    return lines.select("user_id", truncate(F.concat_ws("\n", first, "lines"), SUMMARY_CHARS).alias("summary"))


def _fitted(items: DataFrame, spec: SourceSpec, texts: DataFrame | None) -> DataFrame:
    """user_id, place and rendered of the items that a profile shows, and _items where some are cut at the end."""
    fit = suffix_fit if spec.whole_items else prefix_fit
    if texts is None:
        items = items.withColumn("_shown", shown_text(spec)).drop("text")
    placed = newest(items, spec.newest, history_order(spec, newest_first=True))
    if texts is None:
        return fit(placed.select("user_id", "place", render_item(spec, F.col("place"), set(placed.columns)).alias("rendered")), spec.profile_chars)
    # an item's text ends it, so what stands before it and the text's length tell which items are shown; texts of these alone move to their users
    bare = render_item(spec, F.col("place"), {*placed.columns, "_shown"})
    rendered = placed.withColumn("_shown", F.lit("")).withColumn("rendered", bare)
    kept = fit(rendered.select("user_id", "place", "rendered", "text_key", (F.length("rendered") + F.col("shown_chars")).alias("_chars")), spec.profile_chars)
    whole = kept.drop("_chars").join(texts.select("text_key", shown_text(spec).alias("_shown")), "text_key").drop("text_key")
    return whole.repartition("user_id").withColumn("rendered", F.concat("rendered", "_shown")).drop("_shown")  # else lists are made before texts move, and again behind


def profiles(items: DataFrame, spec: SourceSpec, summaries: DataFrame | None = None, texts: DataFrame | None = None) -> DataFrame:
    """user_id, profile_items, profile_text of the construction items. Texts are cut to what is shown before they move.

    With texts (text_key, text; a row for each key) items have text_key and shown_chars, the length of ``shown_text``, in place of text.
    """
    body = joined(_fitted(items, spec, texts))
    if spec.whole_items:
        users = items.select("user_id").distinct().join(body, "user_id", "left")
        return users.select("user_id", F.coalesce("profile_items", F.lit(0)).alias("profile_items"), F.coalesce("body", F.lit("")).alias("profile_text"))
    head = F.lit(f"{spec.title}.")
    if spec.cascade == "review":
        groups = items.groupBy("user_id").agg(F.count_distinct(F.coalesce("category", F.lit("Unknown"))).alias("_groups"))
        body = body.join(groups, "user_id")
        head = F.concat(
            F.lit(f"{spec.title} - construction split: "), F.col("profile_items").cast("string"), F.lit(" reviews across "),
            F.col("_groups").cast("string"), F.lit(" categories.")
        )
    if summaries is not None:
        body = body.join(summaries, "user_id", "left")
    whole = F.concat_ws("\n\n", head, *(["summary"] if summaries is not None else []), "body")
    return body.select("user_id", "profile_items", F.substring(whole, 1, spec.profile_chars).alias("profile_text"))
