"""Model answers: parsing, checking against the schema and the profile, and the best answer for each dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talus.functions.text import coerce_value, collapse, confidence, quote_found, strip
from talus.plans.specs import ASSIGNMENTS

PARTS = ("field_id", "value", "confidence", "evidence", "description", "assignment_type")


def parse_answers(answers: DataFrame) -> DataFrame:
    """Of user_id, chunk, response: a row for each object in its ``fields``, with pos and all parts as text. Anything that doesn't parse has none."""
    inner = F.nullif(F.regexp_extract(F.coalesce("response", F.lit("")), r"(?s)\{.*\}", 0), F.lit(""))
    fields = answers.withColumn("_v", F.try_parse_json(inner)).withColumn("_f", F.try_variant_get("_v", "$.fields", "array<variant>"))
    each = fields.select("user_id", "chunk", F.posexplode("_f").alias("pos", "_o")).filter(F.schema_of_variant("_o").startswith("OBJECT"))
    return each.select("user_id", "chunk", "pos", *[F.try_variant_get("_o", f"$.{p}", "string").alias(p) for p in PARTS])


def judged(raw: DataFrame, dims: DataFrame, profiles: DataFrame, how: str = "dash") -> DataFrame:
    """raw answers of known dimensions, with value, confidence and evidence cleaned and ``supported``; what isn't is blank."""
    text = lambda c: strip(F.coalesce(c, F.lit("")))
    named = raw.withColumn("field_id", text("field_id")).join(
        F.broadcast(dims.select(F.col("id").alias("field_id"), "values")), "field_id"
    )  # a schema has few rows
    # a profile meets all quotes of its user at once, and is made plain once; only the quotes that it holds go on to the answers
    quotes = named.groupBy("user_id").agg(F.collect_set(text("evidence")).alias("_quotes"))  # some for each dimension of a schema
    holds = lambda plain: F.filter("_quotes", lambda q: quote_found(q, F.col("profile_text"), plain))
    held = F.transform(F.array(collapse(F.col("profile_text"))), holds)[0].alias("_held")
    clean = named.join(profiles.join(quotes, "user_id").select("user_id", held), "user_id").withColumns({
        "value": coerce_value(F.col("value"), F.col("values"), how), "confidence": confidence(F.col("confidence")), "evidence": text("evidence"),
        "description": text("description"), "assignment_type": text("assignment_type")
    })
    good = F.col("value").isNotNull() & F.col("assignment_type").isin(*ASSIGNMENTS) & F.array_contains("_held", F.col("evidence"))
    out = clean.withColumn("supported", F.coalesce(good, F.lit(False))).drop("_held", "values")
    blank = {
        "value": F.lit(None).cast("string"), "confidence": F.lit(0.0), "evidence": F.lit(""), "description": F.lit(""),
        "assignment_type": F.lit("unsupported")
    }
    return out.withColumns({c: F.when(F.col("supported"), F.col(c)).otherwise(b) for c, b in blank.items()})


def best_answers(answers: DataFrame) -> DataFrame:
    """One row for each user and dimension: supported first, then the higher confidence, then the earlier."""
    w = Window.partitionBy("user_id", "field_id").orderBy(F.col("supported").desc(), F.col("confidence").desc(), "chunk", "pos")
    return answers.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def personas(best: DataFrame, users: DataFrame, dims: DataFrame) -> DataFrame:
    """user_id and fields: every dimension in the order of its rank, unsupported where there is no answer."""
    grid = users.select("user_id").crossJoin(F.broadcast(dims.select(F.col("id").alias("field_id"), "rank")))
    full = grid.join(best.select("user_id", *PARTS), ["user_id", "field_id"], "left")
    defaults = {"confidence": F.lit(0.0), "evidence": F.lit(""), "description": F.lit(""), "assignment_type": F.lit("unsupported")}
    full = full.withColumns({c: F.coalesce(c, d) for c, d in defaults.items()})
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.struct(*PARTS).alias("f"))))
    return full.groupBy("user_id").agg(F.transform(ordered, lambda x: x["f"]).alias("fields"))
