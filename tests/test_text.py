from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from talus.functions import survey
from talus.functions import text as fn
from talus.functions.survey import answer_key


def one(spark, column, **values):
    types = {int: "bigint", float: "double", list: "array<string>"}
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {types.get(type(v), 'string')}" for k, v in values.items()))
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize("x, out", [("9999999999", 9999999999000), ("10000000000", 10000000000), ("-1", None), ("12.7", None), (None, None)])
def test_epoch(spark, x, out):
    assert one(spark, fn.epoch_ms(F.col("x")), x=x) == out


@pytest.mark.parametrize("x, out", [(" a \t\n b c ", "a b c"), ("a  b\x1c", "a b"), (None, "")])
def test_collapse(spark, x, out):
    assert one(spark, fn.collapse(F.col("x")), x=x) == out


def test_truncation_adds_one_to_the_limit(spark):
    assert one(spark, fn.truncate(F.col("x"), 20), x="x" * 30) == "xxxxx ... [truncated]"
    assert one(spark, fn.truncate(F.col("x"), 20), x="x" * 20) == "x" * 20


def test_html_and_tags(spark):
    assert one(spark, fn.strip_html(F.col("x")), x='<p>Hi</p><pre><CODE class="x">a\n<b></CODE></pre> z') == "Hi [CODE] z"
    assert one(spark, fn.parse_tags(F.col("x")), x="<a><b><a>") == ["a", "b"]
    assert one(spark, fn.clean_tags(F.col("x")), x=["x", "x", " y "]) == ["x", "y"]
    assert one(spark, fn.parse_tags(F.col("x")), x=None) == []


@pytest.mark.parametrize(
    "x, out",
    [('["a","b","a"]', ["a", "b"]), ('[["a","b"],["c"]]', ["a", "b", "c"]), ("plain", ["plain"]), ('["1","2","3","4","5","6","7"]', list("123456")), (None, [])]
)
def test_category_path(spark, x, out):
    assert one(spark, fn.category_path(F.col("x")), x=x) == out


@pytest.mark.parametrize(
    "x, out",
    [
        ("2024-01-02T03:04:05+0700", 1704139445000), ("2024-01-02", 1704153600000), ("2024-01-02T03:04:05Z", 1704164645000),
        ("2024-01-02 03:04:05", 1704164645000), ("2024", None), ("x", None), (None, None)
    ]
)
def test_iso(spark, x, out):
    assert one(spark, fn.iso_ms(F.col("x")), x=x) == out


def test_iso_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, fn.iso_plus7(F.col("x")), x=1704139445000) == "2024-01-02T03:04:05+07:00"
        assert one(spark, fn.iso_ms(F.col("x")), x="2024-01-02T03:04:05") == 1704164645000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_dates(spark):
    assert one(spark, fn.utc_date(F.col("x")), x=1704139445000) == "2024-01-01"
    assert one(spark, fn.utc_date(F.col("x")), x=0) is None
    assert one(spark, fn.utc_year(F.col("x")), x=-1) == 1969


@pytest.mark.parametrize("x, out", [("5", True), ("0.5", False), ("5.1", False), ("x", False), (None, False), ("1", True)])
def test_rating(spark, x, out):
    assert one(spark, fn.valid_rating(F.col("x")), x=x) is out


@pytest.mark.parametrize("x, out", [("0.8", 0.8), ("7", 1.0), ("-1", 0.0), ("x", 0.0), (None, 0.0), ("nan", 0.0)])
def test_confidence(spark, x, out):
    assert one(spark, fn.confidence(F.col("x")), x=x) == out


def test_coercion(spark):
    allowed = ["18–24", "None", "a b"]
    go = lambda x, how="dash": one(spark, fn.coerce_value(F.col("x"), F.col("v"), how), x=x, v=allowed)
    assert go("18-24") == "18–24" and go("18-24", "exact") is None and go("18-24", "hyphen") == "18–24"
    assert go("A  B") == "a b" and go("None") is None and go("zz") is None
    assert one(spark, fn.coerce_value(F.col("x"), F.col("v")), x=" free ", v=[]) == "free"


def test_quotes_globs_and_names(spark):
    assert one(spark, fn.quote_found(F.col("q"), F.col("p")), q="a  b", p="x a\nb y") is True
    assert one(spark, fn.quote_found(F.col("q"), F.col("p")), q="", p="x") is False
    assert one(spark, fn.glob_match(F.col("v"), F.col("p")), v="Health: Sleep", p="Health:*") is True
    assert one(spark, fn.glob_match(F.col("v"), F.col("p")), v="Health: Sleep", p="Health") is False
    assert one(spark, fn.category_of_file(F.col("x")), x="meta_Books_part_000.jsonl.gz") == "Books"
    assert one(spark, fn.post_type(F.col("x")), x=" 2 ") == "answer"


@pytest.mark.parametrize("x, out", [("17", None), ("18", "18-24"), ("84", "75-84"), ("84.5", None), ("85", "85+"), ("89 or older", "85+"), (None, None)])
def test_age(spark, x, out):
    assert one(spark, survey.age_bracket(F.col("x")), x=x) == out


def test_survey_rules(spark):
    assert one(spark, survey.education(F.col("d"), F.col("e")), d="Graduate", e="8 or more years of college") == "Doctorate"
    assert one(spark, survey.education(F.col("d"), F.col("e")), d="less than high school", e="7th grade") == "Primary"
    assert one(spark, survey.ethnicity(F.col("h"), F.col("r")), h="not hispanic", r="White") == "White / European"
    assert one(spark, survey.religiosity(F.col("r"), F.col("i")), r="None", i=None) == "Secular"


@pytest.mark.parametrize("x", [
    "2024-01-02", "20240102", "2024-W01-2", "2024W012", "2024-W01", "2024-01-02T03", "2024-01-02 03:04", "20240102T030405", "2024-01-02T03:04:05,5", "2024-01-02T03:04:05.123456+07:00",
    "2024-01-02T03:04:05-0130", "2024-01-02T03:04+01", " 2024-01-02T03:04:05Z ", "2024-02-30", "2024-W53-1", "2020-W53-7", "2024-1-2", "2024-01-02T25", "2024-01-02T03:60", "", "x", "2024-01-02T", "2024-01-0203",
])
def test_iso_forms_as_python_reads_them(spark, x):
    try:
        told = datetime.fromisoformat(x.strip().replace("Z", "+00:00"))
        told = int((told if told.tzinfo else told.replace(tzinfo=UTC)).timestamp() * 1000)
    except ValueError:
        told = None
    assert one(spark, fn.iso_ms(F.col("x")), x=x) == told


def test_white_space_and_case(spark):
    assert one(spark, fn.strip(F.col("x")), x="\t\u3000 a \n b \x1f") == "a \n b"
    assert one(spark, fn.folded(F.col("x")), x="Straße ΣΟΦΟΣ ſ") == "straße σοφος s".replace("ß", "ss").replace("ς", "σ")
    assert [one(spark, fn.has_text(F.col("x")), x=x) for x in ("\u2003\t", " a", "")] == [False, True, False]
    assert one(spark, fn.is_nullish(F.col("x")), x="\tNone\n") is True


def test_answers_are_looked_up_in_one_form(spark):
    assert one(spark, answer_key(F.col("x")), x="\tMale  or\nother ") == "male or other"
    assert one(spark, answer_key(F.col("x")), x="Can’t") == "can't" and one(spark, answer_key(F.col("x").cast("int")), x="1") == "1.0"
    assert one(spark, answer_key(F.col("x").cast("double")), x="2.5") == "2.5" and one(spark, answer_key(F.col("x").cast("bigint")), x="12000000") == "12000000.0"
    assert one(spark, answer_key(F.col("x")), x="1") == "1"


def test_every_code_point_folds_as_casefold(spark):
    points = [c for c in map(chr, range(1, 0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    rows = ["".join(points[i : i + 4000]) for i in range(0, len(points), 4000)]
    found = {r["x"]: r["y"] for r in spark.createDataFrame([(x,) for x in rows], "x string").select("x", fn.folded(F.col("x")).alias("y")).collect()}
    assert all(found[x] == x.casefold() for x in rows)
    assert spark.range(1).select(fn.is_nullish(F.lit(" UN\u212aNOWN "))).first()[0]  # the sign of the kelvin
