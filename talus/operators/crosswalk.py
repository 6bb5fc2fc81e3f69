"""Survey answers to profile values: maps and rules, audit, full fields, validation and manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.functions.survey import COMPUTED_FROM, VALUE_MAPS, answer_key, computed

EVIDENCE = "Direct GSS survey response"  # fixed value
Maps = dict[str, tuple[str, dict[str, str | None]]]


def _lookup(mapping: dict[str, str | None], key: Column) -> Column:
    return F.create_map(*[x for k, v in mapping.items() if v is not None for x in (F.lit(k), F.lit(v))])[key]


def _key(column: str) -> str:
    return f"_key_{column}"


def with_keys(answers: DataFrame, maps: Maps = VALUE_MAPS, rules: dict[str, Column] | None = None) -> DataFrame:
    """answers with the keys that ``statuses`` looks up: made once, in a step of their own, however often they are used."""
    columns = dict.fromkeys([*(source for source, _ in maps.values()), *(COMPUTED_FROM if rules is None else ())])
    return answers.withColumns({_key(c): answer_key(F.col(c)) for c in columns})


def statuses(maps: Maps = VALUE_MAPS, rules: dict[str, Column] | None = None) -> list[Column]:
    """For each target a struct of dimension_id, source_column, raw_value, normalized_value, result and status; of answers ``with_keys``."""
    out = []
    for target, (source, mapping) in maps.items():
        raw, key = F.col(source).cast("string"), F.col(_key(source))
        known, null_on_purpose = key.isin(*mapping), key.isin(*[k for k, v in mapping.items() if v is None]) if None in mapping.values() else F.lit(False)
        status = F.when(raw.isNull(), "missing").when(~known, "unmapped").when(null_on_purpose, "deliberately_null").otherwise("mapped")
        out.append(F.struct(
            F.lit(target).alias("dimension_id"), F.lit(source).alias("source_column"), raw.alias("raw_value"), key.alias("normalized_value"),
            _lookup(mapping, key).alias("result"), status.alias("status")
        ))
    for target, value in (computed(lambda c: F.col(_key(c))) if rules is None else rules).items():
        null = F.lit(None).cast("string")
        out.append(F.struct(
            F.lit(target).alias("dimension_id"), F.lit("compute").alias("source_column"), null.alias("raw_value"), null.alias("normalized_value"),
            value.cast("string").alias("result"), F.when(value.isNotNull(), "mapped").otherwise("unsupported").alias("status")
        ))
    return out


def audit(answers: DataFrame, maps: Maps = VALUE_MAPS, rules: dict[str, Column] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each answer row and target."""
    keyed = with_keys(answers, maps, rules)
    return keyed.select(*keep, F.explode(F.array(*statuses(maps, rules))).alias("s")).select(*keep, "s.*")


def crosswalk(answers: DataFrame, maps: Maps = VALUE_MAPS, rules: dict[str, Column] | None = None) -> DataFrame:
    """answers with observed and unmapped, maps of dimension to value and to the raw answer without a rule."""
    each = F.array(*statuses(maps, rules))
    pairs = lambda keep, value: F.map_from_entries(F.transform(F.filter(F.col("_s"), keep), lambda s: F.struct(s["dimension_id"], s[value])))
    keyed = with_keys(answers, maps, rules)
    out = keyed.withColumn("_s", each).drop(*[c for c in keyed.columns if c not in answers.columns])
    return out.withColumn("observed", pairs(lambda s: s["result"].isNotNull(), "result")).withColumn(
        "unmapped", pairs(lambda s: s["status"] == "unmapped", "raw_value")
    ).drop("_s")


def check_targets(dims: DataFrame, maps: Maps = VALUE_MAPS, rules: dict[str, Column] | None = None) -> None:
    """Targets must be dimensions, and mapped values allowed there."""
    allowed = {r["id"]: set(r["values"] or ()) for r in dims.select("id", "values").collect()}  # a schema has few rows
    for target in [*maps, *(computed() if rules is None else rules)]:
        if target not in allowed:
            raise KeyError(f"no dimension {target}")
    for target, (_, mapping) in maps.items():
        if wrong := {v for v in mapping.values() if v is not None} - allowed[target]:
            raise ValueError(f"{target}: values that the schema doesn't allow: {sorted(wrong)}")


def full_fields(observed: DataFrame, dims: DataFrame) -> DataFrame:
    """observed with fields: every dimension in schema order, direct where there is a value."""
    order = F.broadcast(dims.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("_order")))  # one row
    value = lambda d: F.try_element_at("observed", d)
    field = lambda d: F.struct(
        d.alias("field_id"), value(d).alias("value"), F.when(value(d).isNotNull(), 1.0).otherwise(0.0).alias("confidence"),
        F.when(value(d).isNotNull(), EVIDENCE).otherwise("").alias("evidence"),
        F.lit("").alias("description"), F.when(value(d).isNotNull(), "direct").otherwise("unsupported").alias("assignment_type"),
    )
    return observed.crossJoin(order).withColumn("fields", F.transform("_order", field)).drop("_order")


def surrogate_users(answers: DataFrame, index: str, prefix: str = "gss-") -> DataFrame:
    """user_id from a row index that counts from 0."""
    return answers.withColumn("user_id", F.format_string(f"{prefix}%06d", F.col(index).cast("long")))


def grounded_histogram(observed: DataFrame) -> DataFrame:
    return observed.groupBy(F.size("observed").alias("grounded")).agg(F.count("*").alias("respondents"))


def top_unmapped(observed: DataFrame, index: str, most: int = 100) -> DataFrame:
    """'dimension=answer' of answers without a rule, the most frequent first, ties by the first row."""
    each = observed.select(index, F.explode("unmapped").alias("d", "raw")).select(index, F.concat("d", F.lit("="), "raw").alias("value"))
    return each.groupBy("value").agg(F.count("*").alias("n"), F.min(index).alias("first_seen")).orderBy(F.col("n").desc(), "first_seen", "value").limit(most)


def validation(personas: DataFrame, dims: DataFrame, expected: int | None = None) -> DataFrame:
    """One row: rows, unique_users and errors (wrong field lists, users that repeat, values not allowed, assignments that don't fit, a wrong number of rows)."""
    schema = F.broadcast(dims.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("_order"),
        F.map_from_entries(F.collect_list(F.struct("id", F.coalesce("values", F.array().cast("array<string>"))))).alias("_allowed")
    ))
    each = personas.crossJoin(schema)  # one row
    listed = F.coalesce(F.transform("fields", lambda f: f["field_id"]) == F.col("_order"), F.lit(False))
    wrong = F.size(F.filter(
        "fields", lambda f: f["value"].isNotNull() & ~F.coalesce(F.array_contains(F.col("_allowed")[f["field_id"]], f["value"]), F.lit(False))
    )) + F.size(F.filter("fields", lambda f: ~f["assignment_type"].eqNullSafe(F.when(f["value"].isNotNull(), "direct").otherwise("unsupported"))))
    marks = each.select("user_id", F.when(listed, wrong).otherwise(1).alias("_e"), listed.alias("_ok"))
    users = marks.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if("_ok").alias("good"), F.sum("_e").alias("e"))
    total = users.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("good") > 0).alias("unique_users"),
        F.coalesce(F.sum(F.col("e") + F.greatest(F.col("good") - 1, F.lit(0))), F.lit(0)).alias("errors")
    )
    return total if expected is None else total.withColumn("errors", F.col("errors") + (F.col("rows") != expected).cast("long"))


def validated(personas: DataFrame, dims: DataFrame, expected: int | None = None) -> dict[str, int]:
    """The report; ValueError if it counts errors."""
    report = validation(personas, dims, expected).first().asDict()
    if report["errors"]:
        raise ValueError(f"validation failed: {report}")
    return report
