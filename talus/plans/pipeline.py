"""Runs of a source's stages, each alone or all in order; stages talk through files in a work folder.

ingest -> prepare (selection and histories) -> compact -> extract -> stats. ``survey`` turns a Stata file into profiles.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talus.functions.survey import SURVEY_COLUMNS
from talus.functions.text import collapse
from talus.operators import bloom, crosswalk, extract, history, profile, prompts, sanitize, select, stats
from talus.operators.gate import Gate
from talus.plans.specs import SourceSpec
from talus.sources import readers, sinks
from talus.sources.shared import staged

STAGES = ("ingest", "prepare", "compact", "extract", "stats")
GLOBS = {"review": ("*.jsonl", "*.jsonl.gz"), "shop": ("*.json",), "qa": ("*.jsonl", "*.jsonl.gz"), "forum": ("*.csv",)}


@dataclass(frozen=True)
class Run:
    """One source's inputs and outputs. metadata: folder of product metadata; mapping: evidence mapping that narrows the schema; rows_per_file: 0 for all.

    users_at_once: users whose answers are written before the next users' calls begin. calls_per_second: of all tasks together, 0: no bound;
    tasks ask the driver for their turns at gate_port, 0: any free one.
    """

    spec: SourceSpec
    source: str
    work: str
    schema: str
    metadata: str | None = None
    mapping: str | None = None
    rows_per_file: int = 0
    make_client: Callable[[], Callable[[str], str]] = lambda: extract.stub
    tasks: int | None = None
    log_prompts: bool = False
    chart: str | None = None
    users_at_once: int = 10_000
    calls_per_second: float = 0.0
    gate_port: int = 0

    def at(self, name: str) -> str:
        return f"{self.work.rstrip('/')}/{name}"


def read_items(spark: SparkSession, run: Run) -> DataFrame:
    """Items with a dense source_index over the sorted files; a run of some rows of each file of lines keeps positions instead."""
    paths = readers.files(spark, run.source, *GLOBS[run.spec.cascade])
    raw = {"review": readers.json_lines, "shop": readers.json_array, "forum": readers.csv_rows}.get(run.spec.cascade)
    rows = raw(spark, paths) if raw else readers.json_lines(spark, paths, only_objects=True)
    rows = readers.limit_per_file(rows, run.rows_per_file)
    items = {"review": readers.product_reviews, "shop": readers.shop_reviews, "qa": readers.qa_posts, "forum": readers.forum_posts}[run.spec.cascade](rows)
    return items if run.rows_per_file and "in_file" not in rows.columns else readers.numbered(items.filter("user_id <> ''"), paths)


def read_metadata(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """category, parent_id, product_title, product_main and product_path of product metadata, the last row of each wanted key.

    wanted: category and parent_id, each pair once, as a table that can be read twice. Lines whose parent_id can't be wanted aren't parsed.
    """
    rows = readers.lines(spark, readers.files(spark, folder, "*.jsonl", "*.jsonl.gz"))
    raw = F.get_json_object("value", "$.parent_asin")
    rows = bloom.maybe(rows, bloom.key_filter(wanted.select("parent_id"), wanted.count()), raw, F.coalesce(raw.rlike(bloom.WRITTEN_OTHERWISE), F.lit(True)))
    meta = readers.product_metadata(readers.parsed(rows, only_objects=True))
    keys = ["category", "parent_id"]
    return history.metadata_last(history.wanted_metadata(meta, wanted, keys), keys, F.col("pos")).drop("pos")


def ingest(spark: SparkSession, run: Run) -> str:
    return sinks.write_shards(select.ingest_filter(read_items(spark, run), run.spec), run.at("items"), run.spec.shards)


def prepare(spark: SparkSession, run: Run) -> str:
    items = sinks.read_shards(spark, readers.require(spark, run.at("items"), "run the ingest stage first")).drop("shard")
    sinks.write_json_lines(select.select_users(items, run.spec), run.at("selected_users"))
    chosen = spark.read.schema("user_id string, rank int").json(run.at("selected_users"))
    own = history.only_selected(items.withColumn("user_id", F.col("user_id").cast("string")), chosen)
    if run.metadata:
        keys = ["category", "parent_id"]
        wanted = staged(own.filter("parent_id <> ''").select(*keys).distinct(), "wanted")
        own = history.with_metadata(own, read_metadata(spark, run.metadata, wanted), keys)
    elif run.spec.cascade == "review":
        own = own.withColumns({
            "product_title": F.lit(None).cast("string"), "product_main": F.lit(None).cast("string"), "product_path": F.array().cast("array<string>")
        })
    judged = history.removal_reasons(own, run.spec)
    judged = judged if "category" in judged.columns else judged.withColumn("category", F.lit(None).cast("string"))
    sinks.write_json_lines(history.removal_summary(judged), run.at("removed"))
    history.temporal_split(history.kept_items(judged, run.spec), run.spec).write.mode("overwrite").parquet(run.at("histories"))
    return run.at("histories")


def compact(spark: SparkSession, run: Run) -> str:
    rows = spark.read.parquet(readers.require(spark, run.at("histories"), "run the prepare stage first"))
    shown = rows.filter("part = 'construction'").drop("part", "place", "rows")
    summaries = None
    if run.spec.cascade in ("review", "shop"):
        stat = history.category_stats(shown)
        if run.spec.cascade == "review":
            def pairs(value: Column, out: str, most: int, of: DataFrame = shown) -> DataFrame:
                """The most frequent values only: a hot user may have millions."""
                top = history.top_counters(history.counters(of, value), most)
                return top.groupBy("user_id", "category").agg(F.collect_list(F.struct("value", "n")).alias(out))

            bare = F.when((collapse(F.col("title")) == "") & (collapse(F.col("text")) == ""), F.nullif(collapse(F.col("product_title")), F.lit("")))
            stat = stat.join(
                pairs(history.rating_value(F.col("rating")), "ratings", 5), ["user_id", "category"], "left"
            ).join(pairs(bare, "bare_products", 3), ["user_id", "category"], "left")
            named = shown.select("user_id", "category", F.explode("product_path").alias("p"))
            stat = stat.join(pairs(F.col("p"), "products", 4, named), ["user_id", "category"], "left")
        summaries = profile.summary(stat, run.spec, history.split_summary(rows) if run.spec.cascade == "review" else None)
    out = profile.profiles(shown, run.spec, summaries).join(rows.groupBy("user_id").agg(F.first("rank").alias("rank")), "user_id")
    out.withColumn("source", F.lit(run.spec.name)).withColumn("profile_chars", F.length("profile_text")).write.mode("overwrite").parquet(run.at("profiles"))
    return run.at("profiles")


def dimensions(spark: SparkSession, run: Run) -> DataFrame:
    dims = prompts.load_dimensions(spark, run.schema)
    if run.mapping:
        dims = prompts.schema_subset(dims, *prompts.load_mapping(spark, run.mapping))
    return prompts.chunked(dims, run.spec.chunk)


PERSONA = "user_id string, source string, fields array<struct<field_id string, value string, confidence double, evidence string, description string, assignment_type string>>"


def _there(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


ANSWERS = "user_id string, chunk int, response string, error string"


def _hand_out(spark: SparkSession, run: Run) -> DataFrame:
    """Puts the profiles of users that have no persona yet, the first max_users of them by rank (0: all), into numbered turns of users_at_once.

    Profiles of a turn lie below ``due``, and a small file in ``turns`` stands for each turn. What an earlier run handed out isn't handed
    out again; if it died before it wrote the files of its turns, they are written now. Returns the profiles that are left to do.
    """
    left = spark.read.parquet(readers.require(spark, run.at("profiles"), "run the compact stage first"))
    if _there(spark, run.at("personas")):
        left = history.not_done(left, spark.read.schema(PERSONA).json(run.at("personas")))
    order, first = Window.orderBy("rank", "user_id"), 0  # ranks and ids of top_k users at most
    places = left.select("user_id", "rank").withColumn("place", F.row_number().over(order) - 1)
    places = places.filter(F.col("place") < run.spec.max_users) if run.spec.max_users else places
    chosen = left.join(places.select("user_id"), "user_id", "left_semi")
    if _there(spark, run.at("due")):
        known = spark.read.parquet(run.at("due")).select("user_id", "turn")
        first, places = known.agg(F.max("turn")).first()[0] + 1, history.not_done(places, known)
    turn = (F.floor((F.row_number().over(order) - 1) / run.users_at_once) + first).cast("int").alias("turn")
    new = left.join(places.select("user_id", turn), "user_id")
    if not new.isEmpty():
        new.repartition("turn").sortWithinPartitions("turn").write.mode("append").partitionBy("turn").parquet(run.at("due"))
    if _there(spark, run.at("due")):
        for r in spark.read.parquet(run.at("due")).select("turn").distinct().orderBy("turn").collect():  # a row for each users_at_once
            if not _there(spark, name := f"{run.at('turns')}/{r['turn']:06d}.json"):
                sinks.write_json(spark, {"turn": r["turn"]}, name)
    return chosen


def extract_personas(spark: SparkSession, run: Run) -> str:
    """Adds the personas of users that have none yet, turn by turn, as a stream whose checkpoint knows which turns are done.

    A run that starts again goes on with the turn that was broken off. Calls are dear: answers are written before anything is made of
    them, and those that a broken turn left behind are used by the next. A turn's personas are one folder, which a repeated turn
    replaces, so no persona is there twice.
    """
    left, dims = _hand_out(spark, run), dimensions(spark, run)
    n = dims.count()
    if run.log_prompts:
        sinks.write_prompt_log(prompts.prompts(left, dims), run.at("prompt_log"))
    if not _there(spark, run.at("turns")):
        return run.at("personas")

    def one(turn: int) -> None:
        users = spark.read.parquet(run.at("due")).filter(F.col("turn") == turn).drop("turn")
        path = f"{run.at('answers')}/turn={turn}"
        due = users.select("user_id").crossJoin(F.broadcast(dims.select("chunk").distinct()))  # ids and numbers of chunks
        if _there(spark, path):
            known = spark.read.schema(ANSWERS).parquet(path).filter("response is not null")
            due = due.join(known.select("user_id", "chunk"), ["user_id", "chunk"], "left_anti")
        due = users.join(due.groupBy("user_id").agg(F.array_sort(F.collect_set("chunk")).alias("chunks")), "user_id")
        grid = prompts.prompts(due.repartition(run.tasks) if run.tasks else due, dims)
        with Gate(spark, run.calls_per_second, run.gate_port) as gate:
            found = extract.call_model(grid, run.make_client, run.spec.concurrency, door=gate.door)
            found.select("user_id", F.col("chunk").cast("int").alias("chunk"), "response", "error").write.mode("append").parquet(path)
        answers = spark.read.schema(ANSWERS).parquet(path)
        best = sanitize.best_answers(sanitize.judged(sanitize.parse_answers(answers), dims, users, run.spec.coerce))
        out = sanitize.personas(best, users, dims)
        whole = F.when(F.size("fields") == n, F.col("fields")).otherwise(F.raise_error(F.lit("a persona lacks dimensions")).cast(out.schema["fields"].dataType))
        sinks.write_json_lines(out.select("user_id", F.lit(run.spec.name).alias("source"), whole.alias("fields")), f"{run.at('personas')}/turn={turn}")

    def batch(turns: DataFrame, _: int) -> None:
        for r in turns.collect():  # one turn
            one(r["turn"])

    turns = spark.readStream.schema("turn int").option("multiLine", True).option("maxFilesPerTrigger", 1).json(run.at("turns"))
    query = turns.writeStream.option("checkpointLocation", run.at("extract_state")).trigger(availableNow=True).foreachBatch(batch).start()
    query.awaitTermination()
    return run.at("personas")


def read_personas(spark: SparkSession, path: str) -> DataFrame:
    """Personas with ord, the order in which they were written: files by their time, then rows in them."""
    rows = spark.read.schema(PERSONA).json(path)
    place = [F.col(f"_metadata.{c}") for c in ("file_modification_time", "file_name", "file_block_start")]
    return rows.select("*", F.struct(*place, F.monotonically_increasing_id().alias("row")).alias("ord"))


def write_stats(spark: SparkSession, run: Run) -> str:
    people = stats.distinct_personas(
        read_personas(spark, readers.require(spark, run.at("personas"), "run the extract stage first")), stripped=run.spec.cascade != "qa"
    )
    dims, fields = dimensions(spark, run), stats.supported(people)
    listed = F.struct((-F.col("supported_dimension_count")).alias("_o"), "category", "supported_dimension_count")
    by = stats.supported_by_category(fields, dims).agg(F.array_sort(F.collect_list(listed)).alias("c"))  # a row for each category
    categories = F.transform("c", lambda x: F.struct(x["category"].alias("category"), x["supported_dimension_count"].alias("supported_dimension_count")))
    counts = ("persona_count", "schema_dimension_count", "supported_dimension_count", "average_supported_dimensions_per_persona")
    row = stats.persona_stats(people, fields, dims).crossJoin(by).select(*counts, categories.alias("categories"))
    if run.chart:
        stats.coverage_chart(stats.coverage(people, fields, dims), run.chart)
    return sinks.write_document(row, run.at("stats.json"))


def run(spark: SparkSession, plan: Run, stage: str = "all") -> list[str]:
    """Runs one stage, or all; returns what was written."""
    steps = dict(zip(STAGES, (ingest, prepare, compact, extract_personas, write_stats), strict=True))
    if stage != "all" and stage not in steps:
        raise ValueError(f"stage must be one of {', '.join(STAGES)} or all")
    return [step(spark, plan) for name, step in steps.items() if stage in (name, "all")]


def survey(spark: SparkSession, source: str, schema: str, out: str, limit: int = 0, source_name: str = "survey") -> dict:
    """Profiles of a Stata file as gzipped JSON lines, checked, with a manifest beside them; returns the manifest."""
    dims = prompts.load_dimensions(spark, schema)
    crosswalk.check_targets(dims)
    rows = readers.stata(spark, source, SURVEY_COLUMNS, limit)
    seen = crosswalk.surrogate_users(crosswalk.crosswalk(rows), "source_row")
    full = crosswalk.full_fields(seen, dims).select(
        "user_id", F.lit(source_name).alias("source"), F.col("source_row").cast("string").alias("source_row_index"), "fields", "observed"
    )
    sinks.write_json_lines(full, out, gzip=True)
    n = rows.count()
    crosswalk.validated(spark.read.schema(PERSONA).json(out), dims, n)
    digest = lambda path: sinks.file_sha256(spark, path).orderBy("path").first()["sha256"]
    histogram = {
        str(r["grounded"]): r["respondents"] for r in crosswalk.grounded_histogram(seen).orderBy("grounded").collect()
    }  # at most one row for each dimension
    digests = [r["sha256"] for r in sinks.file_sha256(spark, f"{out}/*.gz").orderBy("path").collect()]  # a row for each file written
    manifest = {
        "source": source, "source_sha256": digest(source), "schema": schema, "schema_sha256": digest(schema), "output": out, "output_sha256": digests,
        "rows": n, "fields_per_row": dims.count(), "grounded_dimension_histogram": histogram,
        "top_unmapped_values": [[r["value"], r["n"]] for r in crosswalk.top_unmapped(seen, "source_row").collect()],
    }
    sinks.write_json(spark, manifest, f"{out}.manifest.json")
    return manifest
