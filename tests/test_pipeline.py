import dataclasses
import json

import pandas as pd
import pytest

from talus.__main__ import main
from talus.functions.survey import SURVEY_COLUMNS, VALUE_MAPS, computed
from talus.operators import extract
from talus.plans import pipeline
from talus.plans.specs import FORUM_POSTS, QA_POSTS, REVIEWS_INTL, REVIEWS_VN

DIMS = {"dimensions": [
    {"id": "mood", "label": "Mood", "category": "A: x", "description": "d", "values": ["good", "bad"]},
    {"id": "place", "label": "Place", "category": "B", "description": "d", "values": []}
]}


def answer(prompt):
    return json.dumps({"fields": [{
        "field_id": "mood", "value": "GOOD", "confidence": 0.9, "evidence": "remark number", "description": "x", "assignment_type": "direct"
    }]})


def write_inputs(folder, kind):
    folder.mkdir()
    texts = [f"A rather long remark number {i} about the thing itself" for i in range(8)]
    day = lambda i: f"2020-01-{i + 1:02d}T00:00:00+0700"
    if kind == "review":
        rows = [
            {
                "user_id": u, "timestamp": 1577836800 + 86400 * i, "rating": 4, "title": "T", "text": t, "parent_asin": "P1", "asin": f"A{i}",
                "verified_purchase": True
            }
            for u in ("u1", "u2") for i, t in enumerate(texts)
        ]
        (folder / "Toys.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    elif kind == "shop":
        (folder / "Books.json").write_text(json.dumps([
            {"UserId": u, "CommentDate": day(i), "Rating": 5, "Comment": t, "ProductName": "N"} for u in ("u1", "u2") for i, t in enumerate(texts)
        ]))
    elif kind == "qa":
        (folder / "p.jsonl").write_text("".join(
            json.dumps({
                "user_id": u, "posts": [{"Id": f"{u}{i}", "CreationDate": day(i), "Tags": "<a>", "Body": t, "Score": i} for i, t in enumerate(texts)]
            }) + "\n"
            for u in ("u1", "u2")
        ))
    else:
        frame = pd.DataFrame([
            {"author": u, "created_at": day(i), "text": t, "thread_id": "t", "post_id": f"{u}{i}"} for u in ("u1", "u2") for i, t in enumerate(texts)
        ])
        frame.to_csv(folder / "f.csv", index=False)


@pytest.mark.parametrize("spec", [REVIEWS_INTL, REVIEWS_VN, QA_POSTS, FORUM_POSTS], ids=lambda s: s.name)
def test_all_stages_and_resume(spark, tmp_path, spec):
    write_inputs(tmp_path / "in", spec.cascade)
    (tmp_path / "schema.json").write_text(json.dumps(DIMS))
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta" / "meta_Toys.jsonl").write_text("".join(
        json.dumps({"parent_asin": "P1", "title": t, "categories": ["X", "Y"]}) + "\n" for t in ("Old", "New")
    ))
    small = spec.but(min_count=2, min_chars=10, shards=2, max_users=1)
    plan = pipeline.Run(
        small, str(tmp_path / "in"), str(tmp_path / "work"), str(tmp_path / "schema.json"), str(tmp_path / "meta") if spec is REVIEWS_INTL else None,
        make_client=lambda: answer, log_prompts=True
    )
    with pytest.raises(FileNotFoundError, match="ingest"):
        pipeline.run(spark, plan, "prepare")
    pipeline.run(spark, plan)
    texts = {r["user_id"]: r["profile_text"] for r in spark.read.parquet(plan.at("profiles")).collect()}
    assert set(texts) == {"u1", "u2"} and "remark number 0" in texts["u1"] and ("remark number 7" in texts["u1"]) == (spec.split is None)
    if spec is REVIEWS_INTL:
        assert "product_title: New" in texts["u1"] and "X > Y" in texts["u1"] and "construction_rows: 6; validation_rows: 2" in texts["u1"]
    stats = json.loads((tmp_path / "work" / "stats.json").read_text())
    fits = spec.coerce != "exact"
    assert (stats["persona_count"], stats["supported_dimension_count"]) == (1, int(fits))
    assert spark.read.parquet(plan.at("prompt_log")).filter("length(prompt) > 50").count() > 0
    pipeline.run(spark, plan, "extract")
    pipeline.run(spark, plan, "extract")
    assert spark.read.schema(pipeline.PERSONA).json(plan.at("personas")).select("user_id").distinct().count() == 2
    assert spark.read.schema(pipeline.PERSONA).json(plan.at("personas")).count() == 2
    with pytest.raises(ValueError):
        pipeline.run(spark, plan, "nosuch")


def test_answers_outlive_a_job_that_dies(spark, tmp_path):
    write_inputs(tmp_path / "in", "forum")
    (tmp_path / "schema.json").write_text(json.dumps(DIMS))
    calls = tmp_path / "calls"
    calls.mkdir()

    def make(dies):  # a user has two chunks of the schema, so two calls
        def client(prompt):
            if dies and len(list(calls.iterdir())) == 2:
                raise extract.Unauthorized("no more")
            (calls / str(len(list(calls.iterdir())))).write_text(prompt)
            return answer(prompt)

        return client

    plan = pipeline.Run(
        FORUM_POSTS.but(min_count=2, min_chars=10, shards=2), str(tmp_path / "in"), str(tmp_path / "work"), str(tmp_path / "schema.json"),
        make_client=lambda: make(True), users_at_once=1, tasks=1
    )
    for stage in ("ingest", "prepare", "compact"):
        pipeline.run(spark, plan, stage)
    with pytest.raises(Exception, match="no more"):
        pipeline.run(spark, plan, "extract")
    assert spark.read.schema(pipeline.PERSONA).json(plan.at("personas")).count() == 1 and len(list(calls.iterdir())) == 2
    pipeline.run(spark, dataclasses.replace(plan, make_client=lambda: make(False)), "extract")
    people = pipeline.read_personas(spark, plan.at("personas"))
    assert sorted(r["user_id"] for r in people.collect()) == ["u1", "u2"] and len(list(calls.iterdir())) == 4
    assert [r["user_id"] for r in people.orderBy("ord").collect()] == ["u1", "u2"]
    # killed after a turn's personas were written and before the stream knew: the turn comes again, without calls and without second personas
    last = max((p for p in (tmp_path / "work" / "extract_state" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    pipeline.run(spark, plan, "extract")
    assert pipeline.read_personas(spark, plan.at("personas")).count() == 2 and len(list(calls.iterdir())) == 4


def test_survey(spark, tmp_path):
    rows = pd.DataFrame([
        dict.fromkeys(SURVEY_COLUMNS, "x") | {"sex": "female", "age": "40", "marital": "maybe"},
        dict.fromkeys(SURVEY_COLUMNS, "y") | {"trust": "depends"}
    ])
    rows.rename(columns={"class": "clas5"}).to_stata(tmp_path / "s.dta", write_index=False)  # pandas won't write that name, files have it
    (tmp_path / "s.dta").write_bytes((tmp_path / "s.dta").read_bytes().replace(b"clas5", b"class"))
    values = {t: sorted({v for v in m.values() if v}) for t, (_, m) in VALUE_MAPS.items()} | {
        t: ["18-24", "35-44", "North America", "Hispanic / Latino"] for t in computed()
    }
    (tmp_path / "schema.json").write_text(json.dumps({"dimensions": [{"id": t, "category": "c", "values": v} for t, v in values.items()]}))
    told = pipeline.survey(spark, str(tmp_path / "s.dta"), str(tmp_path / "schema.json"), str(tmp_path / "out"))
    assert told["rows"] == 2 and told["fields_per_row"] == 18 and ["demo_marital_status=maybe", 1] in told["top_unmapped_values"]
    assert json.loads((tmp_path / "out.manifest.json").read_text())["rows"] == 2
    first = spark.read.json(str(tmp_path / "out")).orderBy("user_id").first()
    assert first["user_id"] == "gss-000000" and first["observed"]["age_bracket"] == "35-44"


def test_command_line(spark, tmp_path, capsys):
    write_inputs(tmp_path / "in", "forum")
    (tmp_path / "schema.json").write_text(json.dumps(DIMS))
    main(["forum_posts", "ingest", "--input", str(tmp_path / "in"), "--work", str(tmp_path / "w"), "--schema", str(tmp_path / "schema.json"), "--shards", "2"])
    assert capsys.readouterr().out.strip().endswith("items")
