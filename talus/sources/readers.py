"""Readers of the raw formats: JSON lines, JSON arrays, CSV and Stata, in the order of files and rows."""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talus.functions import loose
from talus.functions.text import (
    SECONDS_BELOW, category_of_file, category_path, collapse, has_text, iso_ms, iso_plus7, post_type, strip, strip_html, surrogate_id, utc_date,
)
from talus.sources.blocks import Arrays, Csv, file_path, numbered_blocks, records
from talus.sources.shared import staged

# Names under which question-and-answer dumps hold a field; the first that is there and not null counts.
ALIASES = {
    "user_id": ("user_id", "owner_user_id", "OwnerUserId", "account_id"), "post_id": ("post_id", "Id", "id"),
    "post_type": ("post_type", "PostTypeId", "post_type_id"),
    "timestamp": ("timestamp", "creation_date", "CreationDate"), "tags": ("tags", "Tags"), "title": ("title", "Title"), "text": ("text", "body", "Body"),
    "score": ("score", "Score"), "accepted": ("accepted", "is_accepted", "accepted_answer"),
}
#: Category of posts that name none.
FORUM = "forum"


def files(spark: SparkSession, root: str, *globs: str) -> list[str]:
    """Paths below root that fit one of the globs, sorted, each once. FileNotFoundError if there are none."""
    jvm, found = spark._jvm, set()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        every = fs.listFiles(path, True)
        names = [jvm.org.apache.hadoop.fs.GlobPattern(g) for g in globs]
        while every.hasNext():
            one = every.next().getPath()
            if any(g.matches(one.getName()) for g in names):
                found.add(one.toString())
    if not found:
        raise FileNotFoundError(f"no input below {root} for {', '.join(globs)}")
    return sorted(found)


def require(spark: SparkSession, path: str, hint: str) -> str:
    """The path; FileNotFoundError with a hint if it isn't there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        raise FileNotFoundError(f"{path} is missing: {hint}")
    return path


#: Order of rows: their file by name, the place in it where their block begins, and their number within the block.
POSITION = "struct<file: string, block: bigint, row: bigint>"


def _placed(rows: DataFrame, *columns: Column | str) -> DataFrame:
    """columns, file and pos of a scan. Rows of a block are in one partition, in order."""
    pos = F.struct(file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return rows.select(*columns, file_path().alias("file"), pos.alias("pos"))


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines that aren't white space alone, with file and pos, whose order is theirs over the sorted files. One scan; large plain files are split, gzip can't be."""
    rows = _placed(spark.read.text(paths), "value")
    return rows.filter(has_text(F.col("value")))


def limit_per_file(rows: DataFrame, most: int) -> DataFrame:
    """The first rows of each file; 0: all."""
    if not most:
        return rows
    if "in_file" in rows.columns:
        return rows.filter(F.col("in_file") < most)
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy("pos"))).filter(F.col("_n") <= most).drop("_n")


def json_lines(spark: SparkSession, paths: list[str], only_objects: bool = False) -> DataFrame:
    """file, pos and v, a variant, so that an absent key can be told from null. A bad line fails the job and is named; rows that are no objects go if only_objects."""
    return parsed(lines(spark, paths), only_objects)


def parsed(rows: DataFrame, only_objects: bool = False) -> DataFrame:
    """file, pos and v of lines, as ``json_lines`` gives them."""
    rows = rows.withColumn("v", F.try_parse_json("value"))
    checked = rows.withColumn(
        "v",
        F.when(
            F.col("v").isNull(), F.raise_error(F.concat(F.lit("bad JSON in "), "file", F.lit(": "), F.substring("value", 1, 80))).cast("variant")
        ).otherwise(F.col("v"))
    )
    out = checked.select("file", "pos", "v")
    return out.filter(F.schema_of_variant("v").startswith("OBJECT")) if only_objects else out


def bad_line(spark: SparkSession, paths: list[str]) -> tuple[str, int, str] | None:
    """File, line number from 1 and beginning of the first line that isn't JSON, over the sorted files."""
    rows = _placed(spark.read.text(paths), "value")
    bad = F.when(has_text(F.col("value")) & F.try_parse_json("value").isNull(), F.struct(F.col("pos.row"), F.substring("value", 1, 80).alias("text")))
    counts = rows.groupBy("pos.file", "pos.block").agg(F.count("*").alias("n"), F.min("pos.row").alias("first"), F.min(bad).alias("bad"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a block
    at = (before + F.col("bad.row") - F.col("first") + 1).alias("line")
    found = counts.select("file", at, "bad").filter("bad is not null").orderBy("file", "line").first()
    return found and (found["file"], found["line"], found["bad"]["text"])


def numbered(items: DataFrame, paths: list[str] | None = None, start: int = 0) -> DataFrame:
    """items with source_index as one number, dense from start over the sorted files, in place of a position.

    items come from a scan by selections, filters and unfolding alone, so that the rows of a file's block are together and in order; it is
    an error if they aren't. They are written to the shared folder once: a block's number of rows and the numbers before it are of the
    rows that are read again. Where the readers number rows themselves, their order is kept. If a line isn't JSON, paths let the error
    name file and line.
    """
    if not items.schema["source_index"].dataType.typeName().startswith("struct"):
        return items.withColumn("source_index", F.col("source_index") + start)
    nested = "pos" in items.schema["source_index"].dataType.fieldNames()
    pos = F.col("source_index.pos" if nested else "source_index")
    try:
        rows = staged(items.withColumn("_at", F.monotonically_increasing_id()), "items")
    except PySparkException as error:
        found = bad_line(items.sparkSession, paths) if paths else None
        if not found:
            raise
        raise ValueError(f"bad JSON at {found[0]}:{found[1]}: {found[2]}") from error
    keyed = rows.withColumns({"_file": pos["file"], "_block": pos["block"]})
    counts = keyed.groupBy(F.col("_file").alias("file"), F.col("_block").alias("block")).agg(
        F.count("*").alias("n"), F.min("_at").alias("first"), F.max("_at").alias("last")
    )
    apart = F.raise_error(F.concat(F.lit("rows of a block aren't together: "), F.col("file"))).cast("long")
    counts = counts.withColumn("first", F.when(F.col("last") - F.col("first") + 1 == F.col("n"), F.col("first")).otherwise(apart))
    places = numbered_blocks(counts).join(counts.select("file", "block", "first"), ["file", "block"])
    # a row for each block of a file, of which the driver holds as many in its listing of files
    places = F.broadcast(places.select(F.col("file").alias("_file"), F.col("block").alias("_block"), (F.col("before") - F.col("first") + start).alias("_add")))
    return keyed.join(places, ["_file", "_block"]).withColumn("source_index", F.col("_at") + F.col("_add")).drop("_file", "_block", "_at", "_add")


def json_array(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, pos, number and v of the objects of files that hold one JSON array each; a byte order mark is skipped, cut-off files fail.

    number is dense from 0 over the sorted files, in_file the same in each. A file is read by as many tasks as it has blocks, twice.
    """
    rows = records(spark, paths, Arrays)
    bad = F.raise_error(F.concat(F.lit("bad JSON in "), "file", F.lit(": "), F.substring("value", 1, 80))).cast("variant")
    v = F.coalesce(F.try_parse_json("value"), bad)
    return rows.select("file", "pos", "number", "in_file", v.alias("v"))


def csv_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All columns as text, with file, pos, number and in_file; quotes, line breaks in fields and a byte order mark are read as they should be.

    number is dense from 0 over the sorted files, header lines not counted. A file is read by as many tasks as it has blocks, twice.
    Header lines may differ: columns that a file lacks are null.
    """
    rows = records(spark, paths, Csv)
    heads = sorted((r["file"], r["value"]) for r in rows.filter("in_file = 0").select("file", "value").collect())  # a row for each file
    if not heads:
        return spark.createDataFrame([], f"file string, pos {POSITION}, number bigint, in_file bigint")
    kinds = {head: next(csv.reader(io.StringIO(head, newline=""))) for _, head in heads}
    order = {head: i for i, head in enumerate(kinds)}
    files = spark.createDataFrame([(file, order[head], n + 1) for n, (file, head) in enumerate(heads)], "file string, _kind int, _heads long")
    width = max(map(len, kinds.values()))
    schema = ", ".join(f"_{i} string" for i in range(width))
    one = F.from_csv("value", schema, {"quote": '"', "escape": '"', "multiLine": "true"})
    data = rows.filter("in_file > 0").join(F.broadcast(files), "file").withColumn("_c", one)  # the driver holds the list of files
    names = dict.fromkeys(name or f"_c{i}" for columns in kinds.values() for i, name in enumerate(columns))
    places = {name: [(order[h], max(i for i, c in enumerate(columns) if (c or f"_c{i}") == name)) for h, columns in kinds.items() if name in columns or name.startswith("_c")] for name in names}

    def of(name: str) -> Column:
        return F.coalesce(*[F.when(F.col("_kind") == kind, F.col(f"_c._{i}")) for kind, i in places[name]]).alias(name)

    number = (F.col("number") - F.col("_heads")).alias("number")
    return data.select(*[of(name) for name in names], "file", "pos", number, (F.col("in_file") - 1).alias("in_file"))


def stata(spark: SparkSession, path: str, columns: tuple[str, ...], most: int = 0) -> DataFrame:
    """Some columns of a Stata file as decoded text, with source_row from 0; missing is null. most: only the first rows are read, 0: all.

    Spark has no reader for it: pandas reads the chosen columns here, slice by slice.
    """
    frames, at = [], 0
    with pd.read_stata(path, columns=list(columns), convert_categoricals=True, chunksize=min(most or 200_000, 200_000)) as slices:
        for part in slices:
            if most and at >= most:
                break
            part = part.head(most - at) if most else part
            part = part.astype(object).where(part.notna(), None)
            part = part.map(lambda x: None if x is None else (f"{x:.1f}" if isinstance(x, (int, float)) and not isinstance(x, bool) and float(x).is_integer() else str(x)))
            part.insert(0, "source_row", range(at, at + len(part)))
            at += len(part)
            frames.append(spark.createDataFrame(part, "source_row long, " + ", ".join(f"`{c}` string" for c in columns)))
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def _fields(raw: DataFrame, *names: str) -> DataFrame:
    """file, source_index and the values under the names, each taken out of its row once, as columns that begin with an underscore."""
    return raw.select("file", _order(raw), *[loose.field(n).alias(f"_{n}") for n in names])


def _text(*names: str) -> Column:
    """The text of the first of some values that isn't empty, zero or null; else ''."""
    return F.coalesce(*[F.nullif(loose.text(F.col(f"_{n}")), F.lit("")) for n in names], F.lit(""))


def _either(name: str, other: str) -> Column:
    """The value under a name, null included; the other's where the name isn't there at all."""
    return F.coalesce(F.col(f"_{name}"), F.col(f"_{other}"))


def _falsy(x: Column) -> Column:
    """'' in place of null and of numbers that are 0."""
    return F.when(x.try_cast("double") == 0, "").otherwise(F.coalesce(x.cast("string"), F.lit("")))


def _order(raw: DataFrame) -> Column:
    """The number of a row where its reader gives one, else its position."""
    return F.col("number" if "number" in raw.columns else "pos").alias("source_index")


def product_reviews(raw: DataFrame) -> DataFrame:
    """Items of JSON-line reviews. A key that is there with null hides its alternative; category falls back on the file's name.

    Values may be of other types than expected: times and votes lose their fraction, and only true makes a purchase verified.
    """
    name = F.element_at(F.split("file", "/"), -1)
    category = F.coalesce(F.nullif(_text("category"), F.lit("")), F.nullif(category_of_file(name), F.lit("")), F.lit("Unknown"))
    parts = ("u", "parent_id", "product_id", "t", "r", "x")
    each = _fields(
        raw, "user_id", "category", "parent_asin", "asin", "timestamp", "sort_timestamp", "rating", "title", "review_title", "text", "review_text",
        "verified_purchase", "helpful_vote", "helpful_votes", "review_id"
    )
    rows = each.select(
        strip(_text("user_id")).alias("user_id"), category.alias("category"), _text("parent_asin").alias("parent_id"), _text("asin").alias("product_id"),
        loose.epoch_ms(_either("timestamp", "sort_timestamp"), SECONDS_BELOW).alias("ts_ms"), loose.real(F.col("_rating")).alias("rating"),
        _text("title", "review_title").alias("title"), _text("text", "review_text").alias("text"),
        F.coalesce(loose.flag(F.col("_verified_purchase")), F.lit(False)).alias("verified"),
        F.coalesce(loose.whole(_either("helpful_vote", "helpful_votes")), F.lit(0)).alias("helpful"), "source_index",
        _text("review_id").alias("i"), _text("user_id").alias("u"), _text("timestamp").alias("t"), _text("rating").alias("r"), _text("text").alias("x"),
    )
    own_id = surrogate_id(F.col("category"), *map(F.col, parts))
    return rows.withColumn("item_id", F.coalesce(F.nullif("i", F.lit("")), own_id)).drop("i", "u", "t", "r", "x")


def product_metadata(raw: DataFrame) -> DataFrame:
    """category, parent_id, product_title, product_main, product_path and pos of JSON-line metadata; category falls back on the file's name."""
    name = F.element_at(F.split("file", "/"), -1)
    category = F.coalesce(F.nullif(_text("category"), F.lit("")), F.nullif(category_of_file(name), F.lit("")), F.lit("Unknown"))
    each = raw.select("file", "pos", *[loose.field(n).alias(f"_{n}") for n in ("category", "parent_asin", "title", "main_category", "categories")])
    return each.select(
        category.alias("category"), _text("parent_asin").alias("parent_id"), F.substring(collapse(_text("title")), 1, 500).alias("product_title"),
        F.substring(collapse(_text("main_category")), 1, 200).alias("product_main"),
        category_path(F.try_variant_get("_categories", "$", "string")).alias("product_path"), "pos",
    )


def shop_reviews(raw: DataFrame) -> DataFrame:
    """Items of JSON-array reviews with ISO dates."""
    stem = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.json$", "")
    category = collapse(F.coalesce(F.nullif(_text("SubCategory"), F.lit("")), F.nullif(stem, F.lit("")), F.lit("Unknown")))
    each = _fields(raw, "UserId", "SubCategory", "Rating", "Comment", "ProductName", "ProductUrl", "CommentDate")
    rows = each.select(
        strip(_text("UserId")).alias("user_id"), category.alias("category"), loose.real(F.col("_Rating")).alias("rating"), _text("Comment").alias("text"),
        _text("ProductName").alias("product_title"), _text("ProductUrl").alias("product_url"), iso_ms(_text("CommentDate")).alias("ts_ms"),
        "source_index", _text("Rating").alias("r"),
    )
    own_id = surrogate_id(*[
        _falsy(F.col(c)) if c == "ts_ms" else F.col(c)
        for c in ("category", "user_id", "ts_ms", "r", "text", "product_title", "product_url", "category")
    ])
    return rows.withColumn("timestamp", iso_plus7(F.col("ts_ms"))).withColumn("item_id", own_id).drop("r")


def qa_posts(raw: DataFrame) -> DataFrame:
    """Items of posts, flat or nested under ``posts`` of a user's row; names vary. Their order is that of rows, then of posts in a row.

    Values may be of other types than expected: an id or user that is 0 or empty is none, tags are a list or a text, accepted is true,
    false or unknown, and a time is a whole number (fractions are cut) or an ISO text.
    """
    posts = loose.field("posts")
    nested = F.when(loose.kind(posts).startswith("ARRAY"), F.try_variant_get(posts, "$", "array<variant>"))
    each = raw.withColumn("outer_user", F.nullif(strip(loose.text(loose.field("user_id"))), F.lit(""))).select(
        "pos", "outer_user", F.posexplode(F.coalesce(nested, F.array("v"))).alias("i", "p")
    )
    each = each.filter(F.schema_of_variant("p").startswith("OBJECT"))
    each = each.select("pos", "i", "outer_user", *[loose.first_given(names, "p").alias(f"_{name}") for name, names in ALIASES.items()])
    get = lambda name: loose.text(F.col(f"_{name}"))
    time = F.coalesce(
        loose.epoch_ms(F.col("_timestamp"), SECONDS_BELOW), F.when(loose.whole(F.col("_timestamp")).isNull(), iso_ms(get("timestamp")))
    )
    rows = each.select(
        F.coalesce("outer_user", strip(get("user_id"))).alias("user_id"), get("post_id").alias("_id"), post_type(get("post_type")).alias("post_type"),
        time.alias("ts_ms"), loose.tags(F.col("_tags")).alias("tags"), collapse(get("title")).alias("title"), strip_html(get("text")).alias("text"),
        F.try_variant_get("_score", "$", "string").alias("score"), loose.flag(F.col("_accepted")).alias("accepted"),
        F.struct(F.col("pos"), F.col("i").alias("item")).alias("source_index"),
    )
    own_id = surrogate_id(*[_falsy(F.col(c)) if c == "ts_ms" else F.col(c) for c in ("user_id", "post_type", "ts_ms", "title", "text")])
    return rows.withColumn("date", utc_date(F.col("ts_ms"))).withColumn("item_id", F.coalesce(F.nullif("_id", F.lit("")), own_id)).drop("_id")


def forum_posts(raw: DataFrame) -> DataFrame:
    """Items of CSV rows. Without a label the source names the category; without both it is the plain name of the forum."""
    has = set(raw.columns)
    c = lambda n: F.coalesce(F.col(n), F.lit("")) if n in has else F.lit("")
    category = collapse(F.coalesce(F.nullif(c("label"), F.lit("")), F.nullif(c("source"), F.lit("")), F.lit(FORUM)))
    rows = raw.select(
        collapse(c("author")).alias("user_id"), category.alias("category"),
        collapse(F.coalesce(F.nullif(c("source"), F.lit("")), F.lit(FORUM))).alias("source"), collapse(c("thread_id")).alias("thread"),
        collapse(c("text_hash")).alias("text_hash"), c("text").alias("text"), iso_ms(c("created_at")).alias("ts_ms"),
        collapse(c("post_id")).alias("_id"), _order(raw),
        c("thread_id").alias("_thread"), c("text_hash").alias("_hash"),
    )
    own_id = surrogate_id(*[_falsy(F.col(n)) if n == "ts_ms" else F.col(n) for n in ("category", "user_id", "ts_ms", "_thread", "_hash", "text")])
    return rows.withColumn("timestamp", iso_plus7(F.col("ts_ms"))).withColumn("item_id", F.coalesce(F.nullif("_id", F.lit("")), own_id)).drop("_id", "_thread", "_hash")
