"""Statistics of personas: supported dimensions overall, by category, and as coverage."""

from __future__ import annotations

from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talus.functions.text import strip
from talus.operators.order import first_of

#: Categories of fields that the schema doesn't know, and of its dimensions that name none.
UNKNOWN_CATEGORY, NO_CATEGORY = "Unknown field category", "Uncategorized"
#: Where a chart's scale ends.
TOP_PCT = 105


def distinct_personas(personas: DataFrame, stripped: bool = True) -> DataFrame:
    """The first persona of each non-empty user id, by the column ord where there is one, else by its fields' text."""
    user = F.col("user_id").cast("string")
    user = strip(user) if stripped else user
    named = personas.withColumn("user_id", F.coalesce(user, F.lit(""))).filter("user_id <> ''")
    return first_of(named, ["user_id"], F.col("ord") if "ord" in personas.columns else F.to_json(F.struct("fields")))


def supported(personas: DataFrame) -> DataFrame:
    """user_id and id of each field with a value. Best answers hold the same rows before they are put into personas."""
    return personas.select("user_id", F.explode("fields").alias("f")).filter("f.value is not null").select("user_id", F.col("f.field_id").alias("id"))


def _categories(dims: DataFrame) -> DataFrame:
    return dims.select("id", F.coalesce(F.nullif("category", F.lit("")), F.lit(NO_CATEGORY)).alias("category"))


def supported_by_category(fields: DataFrame, dims: DataFrame) -> DataFrame:
    """category and supported_dimension_count, the largest first, ties by name."""
    counted = fields.groupBy("id").agg(F.count("*").alias("n")).join(F.broadcast(_categories(dims)), "id", "left")  # a schema has few rows
    out = counted.groupBy(F.coalesce("category", F.lit(UNKNOWN_CATEGORY)).alias("category")).agg(F.sum("n").alias("supported_dimension_count"))
    return out.orderBy(F.col("supported_dimension_count").desc(), "category")


def persona_stats(users: DataFrame, fields: DataFrame, dims: DataFrame) -> DataFrame:
    """One row: personas, dimensions, supported ones, and their average for each persona."""
    counts = users.agg(F.count("*").alias("persona_count")).crossJoin(F.broadcast(fields.agg(F.count("*").alias("supported_dimension_count"))))  # one row each
    schema = dims.agg(F.count("*").alias("schema_dimension_count"))
    average = F.when(F.col("persona_count") > 0, F.round(F.col("supported_dimension_count") / F.col("persona_count"), 4)).otherwise(0.0)
    return counts.crossJoin(F.broadcast(schema)).withColumn("average_supported_dimensions_per_persona", average)


def coverage(users: DataFrame, fields: DataFrame, dims: DataFrame) -> DataFrame:
    """category and coverage_pct of all schema categories: supported of possible, the largest first."""
    possible = _categories(dims).groupBy("category").agg(F.count("*").alias("dimensions"))
    each = possible.join(supported_by_category(fields, dims), "category", "left").crossJoin(F.broadcast(users.agg(F.count("*").alias("persona_count"))))  # one row
    total = F.col("persona_count") * F.col("dimensions")
    pct = F.when(total > 0, 100.0 * F.coalesce("supported_dimension_count", F.lit(0)) / total).otherwise(0.0)
    return each.select("category", pct.alias("coverage_pct")).orderBy(F.col("coverage_pct").desc(), "category")


def coverage_chart(rows: DataFrame, path: str, title: str = "Coverage by category") -> str:
    """A bar chart of coverage rows; as many bars as categories. A path that ends in .svg, and any where matplotlib is missing, gets a drawing of plain shapes; returns where it is."""
    data = [(r["category"], r["coverage_pct"]) for r in rows.collect()]  # a row for each category of a schema
    try:
        if path.endswith(".svg"):
            raise ImportError
        import matplotlib
    except ImportError:
        path = path if path.endswith(".svg") else f"{path}.svg"
        with open(path, "w", encoding="utf-8") as f:
            f.write(_drawing(data, title))
        return path
    matplotlib.use("Agg")
    import matplotlib.pyplot as plt

    figure, axes = plt.subplots(figsize=(max(8, 0.48 * len(data)), 6))
    axes.bar([c for c, _ in data], [p for _, p in data])
    axes.set(ylim=(0, TOP_PCT), ylabel="%", title=title)
    axes.tick_params(axis="x", rotation=90)
    figure.tight_layout()
    figure.savefig(path)
    plt.close(figure)
    return path


def _drawing(data: list[tuple[str, float]], title: str) -> str:
    width, height, below = max(800, 48 * len(data)), 400, 200
    out = [f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height + below}"><title>{escape(title)}</title>']
    for i, (category, pct) in enumerate(data):
        x, tall = 48 * i + 8, height * pct / TOP_PCT
        out.append(f'<rect x="{x}" y="{height - tall:.2f}" width="32" height="{tall:.2f}"><title>{pct:.2f} %</title></rect>')
        out.append(f'<text transform="translate({x + 20} {height + 8}) rotate(90)">{escape(category)}</text>')
    return "\n".join([*out, "</svg>", ""])
