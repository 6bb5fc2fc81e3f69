import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from talus.operators import crosswalk, history, order, profile, sanitize, select, stats
from talus.plans.specs import FORUM_POSTS, QA_POSTS, REVIEWS_INTL, REVIEWS_VN, SPECS, SourceSpec


def test_mid_ranks(spark):
    values = [5, 1, 3, 3, 3, 9, 1, 2]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v int")
    found = {r["k"]: r["share"] for r in order.percentiles(df, "k", ["v"]).collect()}
    assert [found[i] for i in range(8)] == [0.875, 0.1875, 0.625, 0.625, 0.625, 1.0, 0.1875, 0.375]


def test_ordinal_ranks(spark):
    df = spark.createDataFrame([(0, 3, 10), (1, 1, 11), (2, 3, 12)], "k int, v int, seen long")
    found = {r["k"]: r["share"] for r in order.percentiles(df, "k", ["v"], "seen").collect()}
    assert [found[i] for i in range(3)] == pytest.approx([2 / 3, 1 / 3, 1])


def test_ranks_of_negative_and_fractional_values(spark):
    rng = random.Random(4)
    values = [round(rng.uniform(-50, 50), 1) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    found = {r["k"]: r["share"] for r in order.percentiles(df, "k", ["v"]).collect()}
    for i, v in enumerate(values):
        low, same = sum(x < v for x in values), values.count(v)
        assert found[i] == pytest.approx((2 * low + same + 1) / 2 / len(values))


def test_ids_collide_within_a_shard_only(spark):
    users = [f"u{i}" for i in range(40)]
    items = spark.createDataFrame([(u, "same", i) for i, u in enumerate(users)], "user_id string, item_id string, source_index long")
    spec = REVIEWS_VN.but(shards=4)
    assert select.distinct_items(items, spec).count() == len({r["shard"] for r in select.with_shard(items, spec).collect()})


def _cascade(rows, spec):
    """Reasons tried row by row, as a reference for the declarative form."""
    import re

    seen, out = set(), {}
    for r in rows:
        text = " ".join(r["text"].split())
        key = (r["category"], r["ts_ms"], text.lower())
        match = next((p for p in spec.templates if re.search(p, text, re.I)), None) if text and len(text) <= 220 else None
        if r["ts_ms"] is None:
            reason = "missing_or_invalid_timestamp"
        elif r["rating"] is None or not 1 <= r["rating"] <= 5:
            reason = "missing_or_invalid_rating"
        elif len(text) < spec.min_text:
            reason = "insufficient_text_evidence"
        elif key in seen:
            reason = "duplicate_review"
        elif match:
            reason = f"fulfillment_or_template:{match}"
        else:
            reason = None
            seen.add(key)
        out[r["source_index"]] = reason
    return out


@pytest.mark.parametrize("seed", range(3))
def test_cascade_equals_row_by_row(spark, seed):
    rng = random.Random(seed)
    texts = [
        "Great product, works as expected", "great  PRODUCT, works as expected", "A long enough remark about it", "a LONG enough remark about it",
        "short", "", "Another remark that is long enough"
    ]
    rows = [
        {
            "user_id": "u", "source_index": i, "category": rng.choice("ab"), "ts_ms": rng.choice([None, 1, 2]),
            "rating": rng.choice([None, 0.0, 3.0, 5.0]), "text": rng.choice(texts), "title": "", "product_id": None
        }
        for i in range(150)
    ]
    df = spark.createDataFrame(
        [tuple(r.values()) for r in rows],
        "user_id string, source_index long, category string, ts_ms long, rating double, text string, title string, product_id string"
    )
    found = {r["source_index"]: r["reason"] for r in history.removal_reasons(df, REVIEWS_INTL).collect()}
    assert found == _cascade(rows, REVIEWS_INTL)
    summary = history.removal_summary(history.removal_reasons(df, REVIEWS_INTL)).first()
    assert summary["removed_by_reason"] == dict(Counter(r for r in found.values() if r))
    assert summary["input_rows"] == 150 and summary["removed_rows"] == sum(r is not None for r in found.values())


def test_vietnamese_templates(spark):
    df = spark.createDataFrame([("Giao hàng NHANH, rất thích",), ("Sản phẩm tốt",), ("Không có gì",)], "t string")
    found = [r["m"] for r in df.select(history.template_match(F.lit(""), F.col("t"), REVIEWS_VN.templates).alias("m")).collect()]
    assert [m is not None for m in found] == [True, True, False]


@pytest.mark.parametrize("n, cut", [(2, 1), (3, 2), (5, 4), (10, 8)])
def test_split(spark, n, cut):
    df = spark.createDataFrame([("u", i, i, "t") for i in range(n)], "user_id string, source_index long, ts_ms long, text string")
    split = history.temporal_split(df, QA_POSTS)
    assert split.filter("part = 'construction'").count() == cut
    row = history.split_summary(split).first()
    assert (row["construction_last"], row["validation_first"]) == (cut - 1, cut)


@pytest.mark.parametrize("cap, kept", [(9, [2, 3]), (2, []), (100, [1, 2, 3]), (3, [3])])
def test_suffix_fit(spark, cap, kept):
    df = spark.createDataFrame([("u", 1, "xxxxx"), ("u", 2, "xxxx"), ("u", 3, "xxx")], "user_id string, place int, rendered string")
    assert sorted(r["place"] for r in profile.suffix_fit(df, cap).collect()) == kept


def test_two_decimals_as_printf(spark):
    values = [k / 1000 for k in range(1000, 5001)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r["t"] for r in df.select(profile.two_decimals(F.col("v")).alias("t")).collect()] == [f"{v:.2f}" for v in values]


def test_profiles_of_all_sources(spark):
    rows = [("u", i, 1_700_000_000_000 + i, f"text {i}", "", "c", 4.0, ["a"], "th") for i in range(3)]
    items = spark.createDataFrame(
        rows,
        "user_id string, source_index long, ts_ms long, text string, title string, category string, rating double, tags array<string>, thread string"
    ).withColumn("product_id", F.lit("p")).withColumn("score", F.lit("2"))
    for spec in SPECS.values():
        text = profile.profiles(items, spec, profile.summary(history.category_stats(items), spec)).first()["profile_text"]
        assert all(f"text: text {i}" in text for i in range(3)), spec.name
    assert profile.profiles(items, QA_POSTS.but(profile_chars=3)).first()["profile_text"] == ""


def test_specs_check_themselves():
    for wrong in ({"shards": 0}, {"split": 1.0}, {"years": (2, 1)}, {"top_k": 0}):
        with pytest.raises(ValueError):
            SourceSpec("x", **wrong)
    assert FORUM_POSTS.top_k == 100 and REVIEWS_INTL.years == (2018, 2023)


DIMS = "pos int, id string, label string, category string, description string, values array<string>, rank int"


def test_sanitize_prefers_support_then_confidence_then_order(spark):
    dims = spark.createDataFrame([(0, "d", "D", "c", "", ["a", "b", "None"], 1), (1, "e", "E", "c", "", [], 2)], DIMS)
    prof = spark.createDataFrame([("u", "he said a  b today")], "user_id string, profile_text string")
    text = 'x {"fields": [{"field_id":"d","value":"a","confidence":0.6,"evidence":"said a b","assignment_type":"direct"}, 5, {"field_id":"d","value":"b","confidence":0.9,"evidence":"no","assignment_type":"direct"}, {"field_id":"d","value":"b","confidence":"0.7","evidence":"today","assignment_type":"direct"}, {"field_id":"q"}]} y'
    answers = spark.createDataFrame([("u", 0, text), ("u", 1, "}{"), ("u", 2, '{"fields":"x"}'), ("u", 3, None)], "user_id string, chunk int, response string")
    best = sanitize.best_answers(sanitize.judged(sanitize.parse_answers(answers), dims, prof))
    row = sanitize.personas(best, prof, dims).first()
    assert [
        (f["field_id"], f["value"], f["confidence"], f["assignment_type"]) for f in row["fields"]
    ] == [("d", "b", 0.7, "direct"), ("e", None, 0.0, "unsupported")]


def test_stats_take_the_first_persona_of_a_user(spark):
    field = "fields array<struct<field_id string, value string>>"
    people = spark.createDataFrame([("u", 0, [("d", "a"), ("z", "q")]), (" u ", 1, [("d", "a")]), ("", 2, [("d", "a")])], f"user_id string, ord int, {field}")
    dims = spark.createDataFrame([("d", "c1"), ("e", "c2")], "id string, category string")
    own = stats.distinct_personas(people)
    row = stats.persona_stats(own, stats.supported(own), dims).first()
    assert (row["persona_count"], row["supported_dimension_count"], row["average_supported_dimensions_per_persona"]) == (1, 2, 2.0)
    assert {r["category"]: r["coverage_pct"] for r in stats.coverage(own, stats.supported(own), dims).collect()} == {"c1": 100.0, "c2": 0.0}
    assert stats.persona_stats(own.limit(0), stats.supported(own.limit(0)), dims).first()["average_supported_dimensions_per_persona"] == 0.0


def test_crosswalk_statuses(spark):
    from talus.functions.survey import SURVEY_COLUMNS

    row = dict.fromkeys(SURVEY_COLUMNS) | {"born": "no", "sex": " Female ", "childs": "3.0", "marital": "maybe", "age": "40", "trust": "Can’t be too careful"}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"`{c}` string" for c in row))
    status = {r["dimension_id"]: (r["status"], r["result"]) for r in crosswalk.audit(df).collect()}
    assert status["demo_citizenship_status"] == ("deliberately_null", None) and status["demo_marital_status"] == ("unmapped", None)
    assert status["gender_identity"] == ("mapped", "Woman") and status["trust_level"] == ("mapped", "Skeptical") and status["political_lean"] == ("missing", None)
    out = crosswalk.crosswalk(df).first()
    assert out["observed"] == {
        "gender_identity": "Woman", "demo_children_count": "3+ children", "trust_level": "Skeptical", "age_bracket": "35-44"
    } and out["unmapped"] == {"demo_marital_status": "maybe"}


def test_validation_counts_and_raises(spark):
    dims = spark.createDataFrame([(0, "d", ["a"]), (1, "e", ["x"])], "pos int, id string, values array<string>")
    good = crosswalk.full_fields(spark.createDataFrame([("u1", {"d": "a"}), ("u2", {})], "user_id string, observed map<string,string>"), dims)
    assert crosswalk.validated(good, dims, 2) == {"rows": 2, "unique_users": 2, "errors": 0}
    with pytest.raises(ValueError):
        crosswalk.validated(good.unionByName(good), dims)
    with pytest.raises(ValueError):
        crosswalk.validated(good, dims, 3)
    with pytest.raises(KeyError):
        crosswalk.check_targets(dims, {"nosuch": ("s", {})}, {})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_that_scale(spark):
    items = spark.createDataFrame([("u", i, f"text {i}") for i in range(9)], "user_id string, n long, text string")
    found = profile.newest(items, 3, [F.col("n").desc()])
    assert "WindowGroupLimit" in plan_of(found) and [(r["n"], r["place"]) for r in found.orderBy("n").collect()] == [(6, 1), (7, 2), (8, 3)]
    # the profile meets the quotes of its user, not each answer: its text isn't in a shuffle of answers, and is made plain once
    raw = spark.createDataFrame([("u", 0, i, "d", "v", "0.5", f"text {i}", "", "direct") for i in range(4)], "user_id string, chunk int, pos int, field_id string, value string, confidence string, evidence string, description string, assignment_type string")
    dims = spark.createDataFrame([("d", ["v"])], "id string, values array<string>")
    people = spark.createDataFrame([("u", "text 0\n and  text   1")], "user_id string, profile_text string")
    out = sanitize.judged(raw, dims, people)
    assert sorted((r["pos"], r["supported"]) for r in out.collect()) == [(0, True), (1, True), (2, False), (3, False)]
    shuffles = [line for line in plan_of(out).splitlines() if "Exchange" in line]
    assert sum("profile_text" in line for line in shuffles) <= 1


def moved_each(df):
    """Names of the columns that each exchange gets."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    told = df._jdf.queryExecution().explainString(mode)
    return [{c.split("#")[0].strip() for c in x.split(",")} for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", told)]


def moved(df):
    return set().union(*moved_each(df))


def test_scores_of_posts_are_added_in_their_order(spark):
    rows = [("u", str(i), i, i, "text", "", float(v), [t]) for i, (v, t) in enumerate([(1e16, "a"), (1.0, "b"), (-1e16, "a"), (0.5, "c")])]
    items = spark.createDataFrame(rows, "user_id string, item_id string, source_index long, ts_ms long, text string, title string, score double, tags array<string>")
    for n in (1, 3):
        found = select.user_metrics(items.repartition(n, "item_id"), QA_POSTS).first()
        assert found["score_sum"] == 1e16 + 1.0 - 1e16 + 0.5 and (found["items"], found["categories"], found["text_chars"]) == (4, 3, 16)


@pytest.mark.parametrize("spec", SPECS.values(), ids=SPECS)
def test_ranking_moves_no_texts(spark, spec):
    columns = "user_id string, item_id string, source_index long, ts_ms long, text string, title string, score double, tags array<string>, category string, thread string"
    items = spark.createDataFrame([("u", str(i), i, i, "some text", "", 1.0, ["a"], "c", "t") for i in range(3)], columns)
    ranked = select.select_users(items, spec.but(min_count=1, min_chars=1, min_verified=None))
    assert ranked.first()["text_chars"] == 27
    assert "user_id" in moved(ranked) and "text" not in moved(ranked)


def test_split_summary_moves_no_texts(spark):
    from talus.plans import queries
    from tests.conftest import SMALL

    # the documents' own join is the one place where texts are dealt
    assert [c for c in moved_each(queries.split_summary(spark, SMALL)) if "text" in c and "doc_id" not in c] == []


def test_profiles_move_only_what_is_shown(spark):
    rows = [("u", i, i, "t", "x" * 3000) for i in range(2)]
    items = spark.createDataFrame(rows, "user_id string, source_index long, ts_ms long, thread string, text string")
    found = profile.profiles(items, FORUM_POSTS)
    assert "... [truncated]" in found.first()["profile_text"] and "_shown" in moved(found) and "text" not in moved(found)


@pytest.mark.parametrize("name", ["profile_whole_items", "profile_assemble"])
def test_texts_move_once_it_is_settled_which_are_shown(spark, name):
    from talus.plans import queries
    from tests.conftest import SMALL

    each = moved_each(queries.QUERIES[name](spark, SMALL))
    placed = [c for c in each if "ts_ms" in c]
    assert placed and all("shown_chars" in c and not c & {"_shown", "text"} for c in placed)


@pytest.mark.parametrize("spec", [s.but(profile_chars=n) for s in SPECS.values() for n in (0, 150, 320, 5000)], ids=lambda s: f"{s.name}-{s.profile_chars}")
def test_profiles_by_key_are_those_of_texts(spark, spec):
    texts = [None, "", " a  b ", "ü你 \U0001f600\t　x", "y" * 3000, "plain words"]
    rows = [(u, i, None if i == 3 else i, texts[(i + k) % 6], "t", "c", 4.0, ["a"], "th") for k, u in enumerate(("u", "v", None)) for i in range(9 - 4 * k)]
    items = spark.createDataFrame(
        rows, "user_id string, source_index long, ts_ms long, text string, title string, category string, rating double, tags array<string>, thread string"
    ).withColumn("product_id", F.lit("p"))
    key = F.xxhash64("text").alias("text_key")
    keyed = items.select("*", key, F.length(profile.shown_text(spec)).alias("shown_chars")).drop("text")
    by_key = profile.profiles(keyed, spec, texts=items.select(key, "text").distinct())
    assert sorted(map(repr, by_key.collect())) == sorted(map(repr, profile.profiles(items, spec).collect()))


def test_survey_rules_make_each_key_once_and_in_many_tasks(spark):
    from talus.plans import io_queries
    from tests.conftest import SMALL

    found = io_queries.survey_rules(spark, SMALL)
    most = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        told = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", most)
    assert 17 <= told.count("translate(") <= 2 * 17  # 17 of 18 answers have keys, and a plan may be told twice
    assert found.select(F.spark_partition_id()).distinct().count() == 4


def test_keys_made_apart_give_what_computed_rules_give(spark):
    from talus.functions.survey import SURVEY_COLUMNS, computed

    odd = [None, "", " None ", "Graduate", "less  than high school", "7th grade", "8 or more years", "White", "not hispanic", "retired", "Strong", "89 or older"]
    rows = [tuple(odd[(i * (2 * k + 1) + k) % len(odd)] for k in range(len(SURVEY_COLUMNS))) for i in range(40)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"n int, {', '.join(f'`{c}` string' for c in SURVEY_COLUMNS)}")
    plain = {(r["n"], t): r[t] for r in df.select("n", *[v.alias(t) for t, v in computed().items()]).collect() for t in computed()}
    found = {(r["n"], r["dimension_id"]): r["result"] for r in crosswalk.audit(df, keep=("n",)).filter("source_column = 'compute'").collect()}
    assert found == plain and len({v for v in plain.values()}) > 4
    assert set(crosswalk.crosswalk(df).columns) == {*df.columns, "observed", "unmapped"}


def test_profiles_are_put_together_in_the_order_of_their_windows(spark):
    from talus.plans import queries
    from tests.conftest import SMALL

    plan = queries.profile_whole_items(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and "ObjectHashAggregate" not in plan
