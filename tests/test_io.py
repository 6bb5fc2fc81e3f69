import csv
import dataclasses
import gzip
import json
import random
import time
from contextlib import contextmanager

import pandas as pd
import pytest
from pyspark.sql import functions as F

from talus.operators import bloom, extract, prompts, select, stats
from talus.operators.gate import Gate
from talus.plans import pipeline
from talus.plans.specs import QA_POSTS, REVIEWS_INTL
from talus.sources import readers, sinks
from talus.streaming import ingest


def test_json_lines_keep_order_and_tell_absent_from_null(spark, tmp_path):
    (tmp_path / "Toys_part_001.jsonl").write_text('{"user_id":"u1","timestamp":1546300800,"rating":"4","title":"Solid","text":"Used it","parent_asin":"P1","verified_purchase":true,"helpful_vote":2}\n\n{"user_id":"u2","timestamp":null,"sort_timestamp":5}\n')
    with gzip.open(tmp_path / "Zoo.jsonl.gz", "wt") as f:
        f.write('{"user_id":"u3","sort_timestamp":5,"category":"Own"}\n[1]\n')
    paths = readers.files(spark, str(tmp_path), "*.jsonl", "*.jsonl.gz")
    rows = readers.product_reviews(readers.json_lines(spark, paths, only_objects=True)).orderBy("source_index").collect()
    assert [(r["user_id"], r["category"], r["ts_ms"]) for r in rows] == [("u1", "Toys", 1546300800000), ("u2", "Toys", None), ("u3", "Own", 5000)]
    assert rows[0]["verified"] is True and rows[0]["helpful"] == 2 and rows[0]["rating"] == 4.0
    assert readers.limit_per_file(readers.json_lines(spark, paths), 1).count() == 2


def test_bad_json_and_no_files_are_named(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("{oops\n")
    with pytest.raises(Exception, match="bad JSON in"):
        readers.json_lines(spark, readers.files(spark, str(tmp_path), "*.jsonl")).collect()
    with pytest.raises(FileNotFoundError):
        readers.files(spark, str(tmp_path / "none"), "*.jsonl")
    with pytest.raises(FileNotFoundError, match="ingest first"):
        readers.require(spark, str(tmp_path / "x"), "ingest first")


def test_json_array(spark, tmp_path):
    (tmp_path / "Books.json").write_text('﻿[{"UserId":"k1","CommentDate":"2023-05-01T00:00:00+07:00","Rating":5,"Comment":"Rất hay"}, 3]', encoding="utf-8")
    row = readers.shop_reviews(readers.json_array(spark, readers.files(spark, str(tmp_path), "*.json"))).collect()
    assert len(row) == 1 and row[0]["category"] == "Books" and row[0]["timestamp"] == "2023-05-01T00:00:00+07:00"
    (tmp_path / "Cut.json").write_text('[{"a":1},')
    with pytest.raises(Exception, match="no whole JSON array"):
        readers.json_array(spark, readers.files(spark, str(tmp_path), "Cut.json")).collect()


def test_nested_posts(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text(json.dumps({
        "user_id": "u2",
        "posts": [{
            "Id": 7, "PostTypeId": "1", "CreationDate": "2020-01-02T03:04:05Z", "Tags": "<spark><sql><spark>", "Title": "Why?",
            "Body": "<p>See <code>a<b</code> &amp; x</p>", "Score": 3
        }]
    }) + "\n" + json.dumps({"OwnerUserId": 9, "timestamp": 5, "tags": ["x", "x"], "text": "t"}) + "\n")
    rows = readers.qa_posts(readers.json_lines(spark, readers.files(spark, str(tmp_path), "*.jsonl"))).orderBy("source_index").collect()
    assert rows[0]["text"] == "See [CODE] &amp; x" and rows[0]["tags"] == ["spark", "sql"] and rows[0]["post_type"] == "question" and rows[0]["date"] == "2020-01-02" and rows[0]["item_id"] == "7"
    assert rows[1]["user_id"] == "9" and rows[1]["tags"] == ["x"] and rows[1]["ts_ms"] == 5000 and len(rows[1]["item_id"]) == 40


def test_posts_of_many_files_keep_their_order(spark, tmp_path):
    for n in range(12):
        posts = [{"Id": 100 * n + k + 1, "Body": f"text {n} {k}"} for k in range(3)]
        (tmp_path / f"p{n:02d} +.jsonl").write_text("\t \n" + json.dumps({"user_id": " u ", "posts": posts}) + "\n" + json.dumps({"OwnerUserId": 7, "Id": 100 * n + 50}) + "\n")
    rows = readers.qa_posts(readers.json_lines(spark, readers.files(spark, str(tmp_path), "*.jsonl"))).orderBy("source_index").collect()
    assert [int(r["item_id"]) for r in rows] == [100 * n + k for n in range(12) for k in (1, 2, 3, 50)] and {r["user_id"] for r in rows} == {"u", "7"}
    items = readers.qa_posts(readers.json_lines(spark, readers.files(spark, str(tmp_path), "*.jsonl")))
    top = select.select_users(items, QA_POSTS.but(min_count=1, min_chars=0))
    assert [(r["user_id"], r["rank"]) for r in top.orderBy("rank").collect()] == [("u", 1), ("7", 2)]


@pytest.mark.parametrize("size", [1 << 27, 40])
def test_json_arrays_in_parts(spark, tmp_path, size):
    rows = [{"a": i, "t": "}{][ \\ \" é" * (i % 3), "in": {"x": [i, {"y": "}"}]}} for i in range(20)]
    (tmp_path / "one.json").write_text(
        "\ufeff[" + ", ".join(json.dumps(r) + (', [1, {"n": 1}], "}", null' if r["a"] % 5 == 0 else "") for r in rows) + " ]\n", encoding="utf-8"
    )
    (tmp_path / "two.json").write_text(json.dumps([{"a": 100}], indent=1))
    (tmp_path / "zero.json").write_text(" [ ]")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        found = readers.json_array(spark, readers.files(spark, str(tmp_path), "*.json")).orderBy("pos").select(F.to_json("v").alias("v")).collect()
        assert [json.loads(r["v"]) for r in found] == [*rows, {"a": 100}]
        for bad in ('[{"a": 1}', '{"a": 1}', '[{"a": 1}] x', "", '[{"a": "}]'):
            (tmp_path / "bad.json").write_text(bad)
            if bad:
                with pytest.raises(Exception, match="no whole JSON array"):
                    readers.json_array(spark, [str(tmp_path / "bad.json")]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_files_with_other_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("author,text,thread_id\nx,1,t\n")
    (tmp_path / "b.csv").write_text("text,author,label\n2,y,L\n3,z,\n")
    (tmp_path / "c.csv").write_text("")
    rows = readers.forum_posts(readers.csv_rows(spark, readers.files(spark, str(tmp_path), "*.csv"))).orderBy("source_index").collect()
    assert [(r["user_id"], r["text"], r["category"], r["thread"]) for r in rows] == [("x", "1", "forum", "t"), ("y", "2", "L", ""), ("z", "3", "forum", "")]


@contextmanager
def blocks_of(spark, size):
    """Files are cut into blocks of a few bytes."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_in_blocks_equals_the_whole_file_reader(spark, tmp_path):
    rng = random.Random(2)
    cell = lambda: "".join(rng.choice(['a', "é", ",", '"', "\n", "\r\n", " "]) for _ in range(rng.randrange(6)))
    for name in ("a", "b"):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8-sig") as f:
            out = csv.writer(f, lineterminator="\n" if name == "a" else "\r\n")
            out.writerow(["n", "x", 'y "z"'])
            out.writerows([f"{name}{i}", cell(), cell()] for i in range(60))
    paths = readers.files(spark, str(tmp_path), "*.csv")
    told = []
    for path in ("a", "b"):
        with open(tmp_path / f"{path}.csv", newline="", encoding="utf-8-sig") as f:
            told += [tuple(x or None for x in r) for r in list(csv.reader(f))[1:]]
    for size in (1 << 27, 400):
        with blocks_of(spark, size):
            rows = readers.csv_rows(spark, paths)
            found = [tuple(r) for r in rows.orderBy("number").select("n", "x", "`y \"z\"`", "number", "in_file").collect()]
        assert found == [(*r, i, i % 60) for i, r in enumerate(told)]
    whole = spark.read.csv(paths, header=True, multiLine=True, quote='"', escape='"').collect()
    plain = lambda rows: sorted(tuple(x and x.replace("\r\n", "\n") for x in r[:3]) for r in rows)  # noqa: E731 (that reader makes line breaks alike)
    assert plain(found) == plain(whole)
    assert readers.limit_per_file(readers.csv_rows(spark, paths), 2).count() == 4


def test_numbers_are_dense_over_sorted_files(spark, tmp_path):
    for n in range(3):
        lines = [json.dumps({"user_id": "u", "posts": [{"Id": 1000 * n + 10 * i + k + 1} for k in range(i % 4)]}) + "\n" + " \n" * (i % 2) for i in range(40)]
        (tmp_path / f"{n}.jsonl").write_text("".join(lines))
    (tmp_path / "3.jsonl").write_text("[]\n")
    paths = readers.files(spark, str(tmp_path), "*.jsonl")
    with blocks_of(spark, 300):
        items = readers.numbered(readers.qa_posts(readers.json_lines(spark, paths, only_objects=True)), paths, start=1)
        found = [(r["source_index"], int(r["item_id"])) for r in items.orderBy("source_index").collect()]
        told = [1000 * n + 10 * i + k + 1 for n in range(3) for i in range(40) for k in range(i % 4)]
        assert found == list(enumerate(told, 1))
        (tmp_path / "3.jsonl").write_text("[]\n\n{}\n" * 30 + "{oops\n{worse\n")
        with pytest.raises(ValueError, match=r"3\.jsonl:91: \{oops"):
            readers.numbered(readers.qa_posts(readers.json_lines(spark, paths)), paths)
    mixed = readers.qa_posts(readers.json_lines(spark, paths[:3])).repartition(7)
    with pytest.raises(Exception, match="aren't together"):
        readers.numbered(mixed).collect()
    assert readers.numbered(readers.qa_posts(readers.json_lines(spark, paths[:3])).filter("false")).count() == 0


def as_whole(x):
    """A number without its fraction, a text of a whole number; None for others."""
    try:
        return int(x)
    except (TypeError, ValueError):
        return None


LOOSE = (1546300800, 1546300800.5, "1546300800", "12.7", " 12 ", "1_0", True, False, None, 0, "", "0", [], {}, -3, -1.5, "x", "2019-01-01T00:00:00Z")


def test_loose_values(spark, tmp_path):
    with open(tmp_path / "a.jsonl", "w") as f:
        f.writelines(json.dumps({"user_id": "u", "timestamp": x, "helpful_vote": x, "verified_purchase": x, "title": x, "review_id": i}) + "\n" for i, x in enumerate(LOOSE, 1))
    rows = readers.product_reviews(readers.json_lines(spark, readers.files(spark, str(tmp_path), "*.jsonl"))).collect()
    for r, x in zip(sorted(rows, key=lambda r: int(r["item_id"])), LOOSE, strict=True):
        n = as_whole(x)
        assert r["ts_ms"] == (None if n is None or n < 0 else n * 1000), x
        assert (r["verified"], r["helpful"]) == (x is True, n or 0) and r["title"] == str(x or ""), x
    with open(tmp_path / "a.jsonl", "w") as f:
        f.writelines(json.dumps({"user_id": "u", "CreationDate": x, "Tags": x, "accepted": x, "Title": i, "Id": x}) + "\n" for i, x in enumerate(LOOSE, 1))
    rows = readers.qa_posts(readers.json_lines(spark, readers.files(spark, str(tmp_path), "*.jsonl"))).collect()
    for r, x in zip(sorted(rows, key=lambda r: int(r["title"])), LOOSE, strict=True):
        n = as_whole(x)
        assert r["ts_ms"] == (1546300800000 if isinstance(x, str) and "T" in x else None if n is None or n < 0 else n * 1000), x
        assert r["accepted"] == (x if isinstance(x, bool) else None) and r["tags"] == (x.split() if isinstance(x, str) else []), x
        assert (r["item_id"] == str(x)) == bool(x) and (x or len(r["item_id"]) == 40)


def test_dimensions_without_a_category(spark):
    dims = spark.createDataFrame([("a", None), ("b", ""), ("c", "C")], "id string, category string")
    users, fields = spark.createDataFrame([("u",)], "user_id string"), spark.createDataFrame([("u", "a"), ("u", "b"), ("u", "other")], "user_id string, id string")
    assert [tuple(r) for r in stats.coverage(users, fields, dims).collect()] == [("Uncategorized", 100.0), ("C", 0.0)]
    assert dict(map(tuple, stats.supported_by_category(fields, dims).collect())) == {"Uncategorized": 2, "Unknown field category": 1}


def test_chart_without_a_drawing_library(spark, tmp_path):
    rows = spark.createDataFrame([("A & b", 50.0), ("C", 0.0)], "category string, coverage_pct double")
    drawn = open(stats.coverage_chart(rows, str(tmp_path / "c.svg"))).read()
    assert drawn.count("<rect") == 2 and "A &amp; b" in drawn and f'height="{400 * 50 / 105:.2f}"' in drawn


def test_csv_and_stata(spark, tmp_path):
    (tmp_path / "f.csv").write_text('﻿author,created_at,text,thread_id\nan,2024-01-02T03:04:05+0700,"two\nlines, ""q""",t1\n', encoding="utf-8")
    row = readers.forum_posts(readers.csv_rows(spark, readers.files(spark, str(tmp_path), "*.csv"))).first()
    assert row["text"] == 'two\nlines, "q"' and row["ts_ms"] == 1704139445000 and row["thread"] == "t1"
    pd.DataFrame({"age": [30.0, None], "sex": pd.Categorical(["male", "female"]), "other": [1, 2]}).to_stata(tmp_path / "s.dta", write_index=False)
    rows = readers.stata(spark, str(tmp_path / "s.dta"), ("age", "sex")).orderBy("source_row").collect()
    assert [(r["age"], r["sex"]) for r in rows] == [("30.0", "male"), (None, "female")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("u1", None), ("u2", "é")], "user_id string, v string")
    text = "".join(p.read_text() for p in sorted((tmp_path / "j").glob("part*"))) if sinks.write_json_lines(df.coalesce(1), str(tmp_path / "j")) else ""
    assert [json.loads(x) for x in text.splitlines()] == [{"user_id": "u1", "v": None}, {"user_id": "u2", "v": "é"}] and "é" in text
    assert sinks.read_shards(spark, sinks.write_shards(df, str(tmp_path / "s"), 8)).count() == 2
    sinks.write_document(spark.range(1).select(F.lit(1).alias("rows")), str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text()) == {"rows": 1}
    assert sinks.file_sha256(spark, str(tmp_path / "m.json")).first()["sha256"].isalnum()
    zipped = sinks.write_json_lines(df, str(tmp_path / "z"), gzip=True)
    assert spark.read.json(zipped).count() == 2


def test_a_hot_shard_is_many_files(spark, tmp_path):
    rows = spark.range(200_000).select(F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("hot").alias("user_id"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        path = sinks.write_shards(rows.repartition(8), str(tmp_path / "s"), 4)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = sorted(len(list(d.glob("*.parquet"))) for d in (tmp_path / "s").glob("shard=*"))
    assert len(files) == 4 and files[-1] >= 4 and files[0] <= 2 and sinks.read_shards(spark, path).count() == 200_000


def test_schema_documents(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"dimensions": [{"id": "a", "category": "X: y", "values": ["1"]}, {"id": "b", "category": "Z"}]}))
    dims = prompts.load_dimensions(spark, str(path))
    assert [r["id"] for r in dims.orderBy("pos").collect()] == ["a", "b"]
    mapping = tmp_path / "m.json"
    mapping.write_text(json.dumps({"evidence_categories": [{"id": "e", "schema_categories": ["X:*"]}], "skip_by_default_schema_categories": ["Z"]}))
    assert [r["id"] for r in prompts.schema_subset(dims, *prompts.load_mapping(spark, str(mapping))).collect()] == ["a"]
    path.write_text(json.dumps({"dimensions": [{"id": "a"}, {"id": "a"}]}))
    with pytest.raises(ValueError):
        prompts.load_dimensions(spark, str(path))


def test_calls_fail_alone_and_refusals_fail_the_job(spark):
    grid = spark.createDataFrame([("u", 0, "ok"), ("u", 1, "bad")], "user_id string, chunk int, prompt string")

    def make():
        def call(prompt):
            if prompt == "bad":
                raise ValueError("no")
            return prompt.upper()

        return call

    rows = {r["chunk"]: (r["response"], r["error"]) for r in extract.call_model(grid, make, threads=2, tasks=1).collect()}
    assert rows[0] == ("OK", None) and rows[1][0] is None and "no" in rows[1][1]

    def refuse():
        def call(prompt):
            raise extract.Unauthorized("401")

        return call

    with pytest.raises(Exception, match="401"):
        extract.call_model(grid, refuse).collect()


def test_client_waits_and_gives_up():
    answers = [(500, {}, b""), (429, {"Retry-After": "7"}, b""), (200, {}, json.dumps({"choices": [{"message": {"content": "hi"}}]}).encode())]
    waits = []
    client = extract.HttpClient(extract.ClientConfig("http://localhost:1", "m"), lambda body: answers.pop(0), waits.append)
    assert client("p") == "hi" and waits == [1, 7.0]
    client = extract.HttpClient(extract.ClientConfig("http://localhost:1", "m", provider="openrouter"), lambda body: (401, {}, b""), waits.append)
    with pytest.raises(extract.Unauthorized):
        client("p")
    with pytest.raises(extract.Cancelled):
        client("p")
    waits.clear()
    client = extract.HttpClient(extract.ClientConfig("http://localhost:1", "m"), lambda body: (503, {}, b""), waits.append)
    with pytest.raises(RuntimeError):
        client("p")
    assert waits == [1, 2, 4, 8, 16, 32, 60, 60, 60, 60]
    with pytest.raises(ValueError):
        extract.ClientConfig("http://localhost:1", "m", provider="other")


def test_stream_takes_each_item_once(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    schema, spec = "user_id string, item_id string, ts_ms long, source_index long", REVIEWS_INTL.but(years=None, shards=4)
    for n, items in enumerate(([("u", "a"), ("u", "b"), ("", "c")], [("u", "b"), ("v", "d")])):
        (tmp_path / "in" / f"{n}.json").write_text("".join(json.dumps({"user_id": u, "item_id": i, "ts_ms": 1, "source_index": k}) + "\n" for k, (u,
  i) in enumerate(items)))
        ingest.ingest_stream(spark, source, schema, target, check, spec).awaitTermination()
    assert sorted((r["user_id"], r["item_id"]) for r in spark.read.parquet(target).collect()) == [("u", "a"), ("u", "b"), ("v", "d")]


def test_gate_stops_all_tasks_at_the_first_refusal(spark, tmp_path):
    def make():
        def client(prompt):
            (tmp_path / f"{prompt}-{time.time_ns()}").touch()
            if prompt == "p0":
                time.sleep(1)
                raise extract.Unauthorized("no such key")
            time.sleep(0.3)
            return "x"

        return client

    grid = spark.range(0, 80, 1, 4).selectExpr("id as user_id", "0 as chunk", "concat('p', id) as prompt")
    with pytest.raises(extract.Unauthorized, match="no such key"), Gate(spark) as gate:
        extract.call_model(grid, make, door=gate.door).write.format("noop").mode("overwrite").save()
    calls = sorted((int(f.name.split("-")[1]), f.name.split("-")[0]) for f in tmp_path.iterdir())
    refused = next(at for at, name in calls if name == "p0") + 10**9
    late = [name for at, name in calls if at > refused + 2 * 10**8]
    assert not late and sum(name == "p0" for _, name in calls) == 1 and len(calls) < 25
    assert not spark.sparkContext.getJobTags()


def test_gate_keeps_one_rate_and_its_secret(spark, tmp_path):
    def make():
        return lambda prompt: str(time.time())

    grid = spark.range(0, 40, 1, 4).selectExpr("id as user_id", "0 as chunk", "'p' as prompt")
    with Gate(spark, per_second=20) as gate:
        times = sorted(float(r["response"]) for r in extract.call_model(grid, make, threads=3, door=gate.door).collect())
        assert times[-1] - times[0] > 0.9 * 39 / 20 and len(times) == 40
        with pytest.raises(ValueError):
            dataclasses.replace(gate.door, secret="other").refuse("x")
        assert gate.why is None
    with pytest.raises(ValueError):
        Gate(spark, -1)


def test_gate_without_a_rate_is_asked_once_a_worker(spark):
    class Counting(Gate):
        turns = 0

        def turn(self):
            self.turns += 1
            return super().turn()

    class Client:
        door = None

        def __call__(self, prompt):
            self.door.enter()
            return prompt

    grid = spark.range(0, 4000, 1, 4).selectExpr("id as user_id", "0 as chunk", "'p' as prompt")
    with Counting(spark) as gate:
        found = extract.call_model(grid, Client, threads=3, door=gate.door).filter("response = 'p' and error is null").count()
        assert found == 4000 and 1 <= gate.turns <= 4 * 3  # threads may ask at the same time, before the first is told
        gone = gate.door
    with pytest.raises(OSError):
        gone.enter()
    failing = extract.call_model(grid.limit(1), Client, door=gone)
    with pytest.raises(Exception, match="doesn't answer"):  # not an answer of its own
        failing.collect()


def test_client_asks_before_each_attempt():
    class Door:
        asked = 0

        def enter(self):
            self.asked += 1
            if self.asked == 3:
                raise extract.Cancelled("stop")

    client = extract.HttpClient(extract.ClientConfig("http://localhost:1", "m"), lambda body: (503, {}, b""), lambda s: None)
    client.door = Door()
    with pytest.raises(extract.Cancelled):
        client("x")
    assert client.door.asked == 3


@pytest.mark.parametrize("n", [0, 1, 3000, 40_000])
def test_key_filter_loses_no_key(spark, n):
    keys = spark.range(n).selectExpr("concat('B0', id * 7) as k")
    among = bloom.key_filter(keys, n)
    rows = spark.range(200_000).selectExpr("concat('B0', id) as k", "id as other")
    found = {r["other"] for r in bloom.maybe(rows, among, F.col("k")).collect()}
    told = {7 * i for i in range(n) if 7 * i < 200_000}
    assert told <= found and len(found - told) < 0.03 * 200_000
    odd = spark.createDataFrame([(None,), ("no",), ("B00",)], "k string")
    assert {r["k"] for r in bloom.maybe(odd, among, F.col("k"), F.col("k").isNull()).collect()} >= {None}
    assert bloom.key_filter(keys, 1 << 40) is None and bloom.maybe(rows, None, F.col("k")).columns == ["k", "other"]


def test_metadata_of_unwanted_keys_is_not_parsed(spark, tmp_path):
    rows = [
        '{"parent_asin": "P1", "title": " a  b ", "categories": ["x"]}', '{"parent_asin": "P1", "title": "late", "category": ""}',
        '{"parent_asin": 12345678901234567890123, "title": "n"}', '{"parent_asin": true, "title": "t", "category": 0}', '{"parent_asin": "", "title": "none"}',
        '{"title": "none"}', "[1]", '{"parent_asin": "P1", "category": "Other"}', '{"parent_asin": "P2"}', '{"x": {"parent_asin": "P3"}, "parent_asin": "P9"}',
        '{"parent_asin": "gone"} and more'
    ]
    (tmp_path / "meta_Toys.jsonl").write_text("\n".join(rows) + "\n")
    wanted = spark.createDataFrame([("Toys", k) for k in ("P1", "P3", "True", "12345678901234567890123")], "category string, parent_id string")
    found = {(r["category"], r["parent_id"]): r["product_title"] for r in pipeline.read_metadata(spark, str(tmp_path), wanted).collect()}
    assert found == {("Toys", "P1"): "late", ("Toys", "True"): "t", ("Toys", "12345678901234567890123"): "n"}
    (tmp_path / "meta_Toys.jsonl").write_text('{"parent_asin": "P1", \n')
    with pytest.raises(Exception, match="bad JSON"):
        pipeline.read_metadata(spark, str(tmp_path), wanted).collect()


def test_made_files_have_a_task_each(spark):
    from talus.plans.io_queries import dealt

    rows = dealt(spark.range(0, 1000, 1, 3).selectExpr("id % 16 as part"), 16)
    tasks = rows.select("part", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) == 16 and {r["part"] for r in tasks} == {r["task"] for r in tasks} == set(range(16))
