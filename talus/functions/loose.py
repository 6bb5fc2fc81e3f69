"""Loose values of JSON: what a variant of any type stands for as a text, a number, a flag or tags.

Rules, by the type that the JSON has: an empty or zero value is no text; numbers lose their fraction where whole ones are wanted, but
texts of numbers with a fraction are none; only true and false are flags.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talus.functions.text import clean_tags, parse_tags, strip


#: JSON of values that stand for no text.
EMPTY = r"^(null|false|\[\]|\{\}|-?0(\.0*)?([eE][+-]?\d+)?)$"


def field(name: str, of: Column | str = "v") -> Column:
    """The value under a name; null if there is none, while a JSON null is a value."""
    return F.try_variant_get(of, f"$.{name}", "variant")


def given(x: Column) -> Column:
    """null in place of a JSON null."""
    return F.when(~F.is_variant_null(x), x)


def first_given(names: tuple[str, ...], of: Column | str = "v") -> Column:
    return F.coalesce(*[given(field(n, of)) for n in names])


def kind(x: Column) -> Column:
    """The type's name: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID, OBJECT<..>, ARRAY<..>."""
    return F.schema_of_variant(x)


def _as(x: Column, to: str) -> Column:
    return F.try_variant_get(x, "$", to)


def text(x: Column) -> Column:
    """The value as a text; '' for null, false, 0 and what is empty. Lists and objects are their JSON."""
    written = F.to_json(x)
    other = F.when(written == "true", "True").when(~written.rlike(EMPTY), written)
    return F.coalesce(F.when(kind(x) == "STRING", _as(x, "string")).otherwise(other), F.lit(""))


def whole(x: Column) -> Column:
    """A whole number: numbers without their fraction, true and false as 1 and 0, texts of whole numbers; else null."""
    real = _as(x, "double")
    digits = strip(_as(x, "string"))
    return (
        F.when(kind(x) == "BIGINT", _as(x, "bigint"))
        .when(kind(x) == "STRING", F.when(digits.rlike(r"^[+-]?\d+(_\d+)*$"), F.replace(digits, F.lit("_"), F.lit("")).try_cast("bigint")))
        .when(kind(x) == "BOOLEAN", _as(x, "boolean").cast("bigint"))
        .when(F.abs(real) < 9.2e18, F.when(real < 0, F.ceil(real)).otherwise(F.floor(real)))
    )


def real(x: Column) -> Column:
    """A number, also of a text or a flag; else null."""
    return F.when(kind(x) == "BOOLEAN", _as(x, "boolean").cast("double")).otherwise(_as(x, "string").try_cast("double"))


def flag(x: Column) -> Column:
    """true or false where the value is one of these, else null."""
    return F.when(kind(x) == "BOOLEAN", _as(x, "boolean"))


def tags(x: Column) -> Column:
    """Distinct tags of a list, or of a text of tags; none of anything else."""
    of_list = clean_tags(F.transform(_as(x, "array<variant>"), text))
    return F.when(kind(x).startswith("ARRAY"), of_list).when(kind(x) == "STRING", parse_tags(_as(x, "string"))).otherwise(F.array().cast("array<string>"))


def epoch_ms(x: Column, seconds_below: int) -> Column:
    """Milliseconds of a whole number of seconds or milliseconds; negative ones are null."""
    n = whole(x)
    return F.when(n >= 0, F.when(n < seconds_below, n * 1000).otherwise(n))
