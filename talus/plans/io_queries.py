"""Registered queries of sources, sinks and the survey: tables are written in the raw formats, read back, and held against SQL over the tables."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talus.functions import text as fn
from talus.functions.survey import SURVEY_COLUMNS, VALUE_MAPS, computed
from talus.operators import crosswalk as cw
from talus.operators import extract, history, prompts, select, stats
from talus.operators.gate import Gate
from talus.plans import pipeline
from talus.plans.queries import CHUNK_SQL, DIMS, HIST, PART_DIM_SQL, clean, dims, hist, micros, part_dims, query, spread, table
from talus.plans.specs import REVIEWS_INTL, REVIEWS_VN
from talus.sources import readers, sinks
from talus.sources.shared import new_path, staged


#: Least number of files that a table is written as, and the most rows of one.
FILES, FILE_ROWS = 8, 1_000_000
#: Bytes of a file, where rows are texts of any length.
FILE_BYTES = 64 << 20
#: The same in SQL: the number of a row's file, of its key and the table's number of rows and largest key.
_PART = f"k * greatest({FILES}, n // {FILE_ROWS}) // (m + 1)"


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """rows with the part of each, a number below n, as a task of its own: by a hash some tasks would get several."""
    return rows.repartitionById(n, F.col("part").cast("int"))


def put(rows: DataFrame, folder: str, name: str, kind: str = "text", array: bool = False, size: Column | None = None, **options: str) -> None:
    """Files by ranges of the key k, in its order, each written by a task of its own; their numbers stand in the name at {}.

    A text file has the column value, as whole JSON arrays whose last element is no object if array; other kinds all columns but k.
    size: bytes of a row, where they and not only rows are to bound a file.
    """
    spark, made = rows.sparkSession, new_path(rows.sparkSession, "made")
    most, count, total = rows.agg(F.max("k"), F.count("*"), F.sum(F.lit(0) if size is None else size)).first()
    n = max(FILES, count // FILE_ROWS, (total or 0) // FILE_BYTES)
    rows = rows.withColumn("part", F.expr(f"k * {n} div ({most or 0} + 1)"))
    if array:
        rows = rows.withColumn("value", F.concat("value", F.lit(",")))
        for k, text in ((-1, "["), (1 << 62, "null]")):
            rows = rows.unionByName(spark.range(n).select(F.lit(k).cast("long").alias("k"), F.lit(text).alias("value"), F.col("id").alias("part")))
    rows = dealt(rows, n).sortWithinPartitions("part", "k")
    (rows.select("part", "value") if kind == "text" else rows.drop("k")).write.partitionBy("part").format(kind).options(**options).save(made)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.globStatus(path(f"{made}/part=*/part-*")):
        to = path(f"{folder}/{name.format(f.getPath().getParent().getName().removeprefix('part=').zfill(5))}")
        fs.mkdirs(to.getParent())
        if not fs.rename(f.getPath(), to):
            raise OSError(f"{to.toString()} couldn't be made")


def as_json(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).cast("long").alias("k"), F.to_json(F.struct("*")).alias("value"))


def get(name: str, kind: str = "string") -> Column:
    return F.try_variant_get("v", f"$.{name}", kind)


def _customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    folder, rows = new_path(spark, "lines"), as_json(table(spark, sf_dir, "customer"), "c_custkey")
    odd = F.explode(F.array(*[F.lit(x) for x in (" \t ", "[1]", "3", '"{}"')])).alias("value")
    others = rows.filter("k % 5 = 0").select("k", odd)
    put(rows.filter("k % 2 = 0").unionByName(others), folder, "a b+c/{}.jsonl")
    put(rows.filter("k % 2 = 1"), folder, "d-{}.jsonl.gz", compression="gzip")
    paths = readers.files(spark, folder, "*.jsonl", "*.jsonl.gz")
    return readers.json_lines(spark, paths, only_objects=True), paths


@query("SELECT c_custkey, c_name, c_acctbal, row_number() OVER (ORDER BY c_custkey % 2, c_custkey) - 1 AS source_index FROM customer")
def scan_json_lines(spark, sf_dir):
    """Rows are numbered over all sorted files; blank lines and lines that are no objects don't count."""
    rows, paths = _customers(spark, sf_dir)
    rows = rows.select(
        get("c_custkey", "bigint").alias("c_custkey"), get("c_name").alias("c_name"), get("c_acctbal", "double").alias("c_acctbal"),
        F.col("pos").alias("source_index")
    )
    return readers.numbered(rows, paths)


@query(f"""SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (PARTITION BY half, {_PART} ORDER BY c_custkey) AS place FROM (SELECT c_custkey,
  c_custkey AS k, c_custkey % 2 AS half, count(*) OVER (PARTITION BY c_custkey % 2) + CASE WHEN c_custkey % 2 = 0 THEN 4 * (SELECT count(*) FROM
  customer WHERE c_custkey % 5 = 0) ELSE 0 END AS n, CASE WHEN c_custkey % 2 = 0 THEN (SELECT max(c_custkey) FROM customer WHERE c_custkey % 2 = 0
  OR c_custkey % 5 = 0) ELSE max(c_custkey) OVER (PARTITION BY c_custkey % 2) END AS m FROM customer)) WHERE place <= 50""")
def rows_per_file(spark, sf_dir):
    return readers.limit_per_file(_customers(spark, sf_dir)[0], 50).select(get("c_custkey", "bigint").alias("c_custkey"))


@query("SELECT p_partkey, p_name, p_brand, p_size, row_number() OVER (ORDER BY p_partkey % 2, p_partkey) - 1 AS number FROM part")
def scan_json_array(spark, sf_dir):
    folder, rows = new_path(spark, "arrays"), as_json(table(spark, sf_dir, "part").withColumn("odd", F.lit('}{"][')), "p_partkey")
    for n in range(2):
        put(rows.filter(F.col("k") % 2 == n), folder, f"{n}-{{}}.json", array=True)
    found = readers.json_array(spark, readers.files(spark, folder, "*.json"))
    return found.select(
        get("p_partkey", "bigint").alias("p_partkey"), get("p_name").alias("p_name"), get("p_brand").alias("p_brand"),
        get("p_size", "int").alias("p_size"), "number"
    )


@query("""SELECT doc_id, md5(coalesce(text, '')) AS text_md5, lang, source, row_number() OVER (ORDER BY doc_id % 2, doc_id) - 1 AS number
  FROM documents""")
def scan_csv(spark, sf_dir):
    folder, docs = new_path(spark, "csv"), table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", F.col("doc_id").alias("k"))
    kind = {"kind": "csv", "header": "true", "quote": '"', "escape": '"'}
    size = F.octet_length(F.coalesce("text", F.lit("")))
    put(docs.filter("doc_id % 2 = 0"), folder, "a-{}.csv", size=size, **kind)
    put(docs.filter("doc_id % 2 = 1").select("source", "lang", "text", "doc_id", "k"), folder, "b-{}.csv", size=size, **kind)
    rows = readers.csv_rows(spark, readers.files(spark, folder, "*.csv"))
    text_md5 = F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), text_md5, "lang", "source", "number")


def _stata(spark: SparkSession, frame: pd.DataFrame) -> str:
    """A Stata file in the shared folder."""
    import io

    data, path = io.BytesIO(), f"{new_path(spark, 'stata')}.dta"
    frame.to_stata(data, write_index=False)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(data.getvalue().replace(b"clas5", b"class")))  # pandas won't write that name, files have it
    out.close()
    return path.removeprefix("file://")


@query("SELECT n_nationkey AS source_row, n_name, n_regionkey || '.0' AS n_regionkey FROM nation WHERE n_nationkey < 20")
def scan_stata(spark, sf_dir):
    frame = table(spark, sf_dir, "nation").orderBy("n_nationkey").toPandas()  # 25 rows at every scale
    return readers.stata(spark, _stata(spark, frame), ("n_name", "n_regionkey"), 20).select(
        F.col("source_row").cast("int").alias("source_row"), "n_name", "n_regionkey"
    )


@query("""WITH e AS (SELECT *, ' u' || user_id || ' ' AS raw_user, 'P' || event_id % 5 AS parent, 'A' || event_id % 3 AS asin, epoch_us(ts) // 1000000
  AS secs, CASE WHEN event_id % 3 = 0 THEN event_type || ' x' END AS raw_text FROM events)
SELECT trim(raw_user) AS user_id, 'Toys' AS category, secs * 1000 AS ts_ms, value AS rating, event_type AS title, coalesce(raw_text, props) AS text,
  event_id % 4 = 1 AS verified, event_id % 6 AS helpful,
  sha1('Toys|' || raw_user || '|' || parent || '|' || asin || '|' || CASE WHEN event_id % 2 = 0 THEN secs || CASE WHEN event_id % 10 = 0 THEN '.5'
    ELSE '' END ELSE '' END || '|' || CASE WHEN value = 0 THEN '' WHEN value = floor(value) THEN value::BIGINT::VARCHAR ELSE value::VARCHAR END ||
    '|' || coalesce(raw_text, '')) AS item_id,
  row_number() OVER (ORDER BY event_id) - 1 AS source_index
FROM e WHERE year(ts) = 2024""")
def ingest_products(spark, sf_dir):
    """Times are numbers, numbers with a fraction and texts, votes have fractions or are texts, and words stand where a flag should."""
    events = table(spark, sf_dir, "events")
    n, secs = F.col("event_id"), F.floor(micros(events, "ts") / 1_000_000)
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    time = F.when(n % 10 == 0, F.concat(secs.cast("string"), F.lit(".5"))).when(n % 10 == 2, quoted(secs.cast("string"))).otherwise(secs.cast("string"))
    votes = F.when(n % 5 == 0, F.concat((n % 6).cast("string"), F.lit(".7"))).when(n % 5 == 1, quoted((n % 6).cast("string"))).otherwise((n % 6).cast("string"))
    flag = F.element_at(F.array(*[F.lit(x) for x in ('"yes"', "true", "1", "false")]), (n % 4 + 1).cast("int"))
    rows = events.filter("year(ts) = 2024 or event_id % 7 = 0").select(
        F.concat(F.lit(" u"), "user_id", F.lit(" ")).alias("user_id"), F.concat(F.lit("P"), n % 5).alias("parent_asin"),
        F.concat(F.lit("A"), n % 3).alias("asin"), F.when(n % 2 == 1, secs * 1000).alias("sort_timestamp"), F.col("value").alias("rating"),
        F.col("event_type").alias("review_title"), F.when(n % 3 == 0, F.concat("event_type", F.lit(" x"))).alias("text"), F.col("props").alias("review_text"),
        n.alias("_n"), time.alias("_time"), votes.alias("_votes"), flag.alias("_flag"),
    )
    body = F.to_json(F.struct("user_id", "parent_asin", "asin", "sort_timestamp", "rating", "review_title", "text", "review_text"))
    raw = F.concat(
        F.lit('{"verified_purchase": '), "_flag", F.lit(', "helpful_vote": '), "_votes", F.when(F.col("_n") % 2 == 0, F.concat(F.lit(', "timestamp": '), "_time"))
        .otherwise(""), F.lit(", "), F.substring(body, 2, 1 << 30)
    )
    folder = new_path(spark, "products")
    put(rows.select(F.col("_n").alias("k"), raw.alias("value")), folder, "{}/meta_Toys_part_1.jsonl")
    paths = readers.files(spark, folder, "*.jsonl")
    items = select.ingest_filter(readers.product_reviews(readers.json_lines(spark, paths)), REVIEWS_INTL.but(years=(2024, 2024)))
    return readers.numbered(items, paths).select(
        "user_id", "category", "ts_ms", "rating", "title", "text", "verified", "helpful", "item_id", "source_index"
    )


@query(f"""SELECT conv_id::VARCHAR AS user_id, CASE WHEN turn % 4 = 3 OR conv_id + turn = 0 THEN sha1(conv_id || '|' || kind || '|' || ms || '|' ||
  coalesce(role, '') || '|' || plain) ELSE (conv_id + turn)::VARCHAR END AS item_id, kind AS post_type, ms AS ts_ms, '2017-07-14' AS date,
  CASE turn % 5 WHEN 0 THEN '' WHEN 1 THEN 'a,5' ELSE coalesce(role || ',', '') || 'a' END AS tags, md5(plain) AS text_md5,
  CASE turn % 3 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS accepted, row_number() OVER (ORDER BY conv_id, turn) - 1 AS source_index
FROM (SELECT *, (1500000000 + turn) * 1000 AS ms, CASE turn % 3 WHEN 1 THEN 'question' WHEN 2 THEN 'answer' ELSE 'post' END AS kind,
  {clean("regexp_replace(coalesce(text, ''), '<.*?>', ' ', 'gs')")} AS plain FROM conversations)""")
def ingest_posts(spark, sf_dir):
    """Posts of users in one row each. Ids may be 0, times have fractions, tags are texts, lists or a number, and accepted is a flag or a word."""
    turn, raw = F.col("turn"), lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    body = F.to_json(F.struct(
        (turn % 3).alias("PostTypeId"), F.col("role").alias("Title"), F.concat(F.lit("<p>"), F.coalesce("text", F.lit("")), F.lit("</p>")).alias("Body")
    ))
    tag_text = raw('"', F.coalesce(F.concat(F.lit("<"), "role", F.lit(">")), F.lit("")), '<a><a>"')
    tags = F.when(turn % 5 == 0, "5").when(turn % 5 == 1, '["a", 5, " a ", 0, null, ""]').otherwise(tag_text)
    own_id = F.when(turn % 4 != 3, raw('"Id": ', (F.col("conv_id") + turn).cast("string"), ", ")).otherwise("")
    accepted = F.when(turn % 3 == 0, "true").when(turn % 3 == 1, '"true"').otherwise("false")
    post = raw(
        "{", own_id, '"CreationDate": ', (turn + 1_500_000_000).cast("string"), F.when(turn % 2 == 1, ".25").otherwise(""), ', "Tags": ', tags,
        ', "accepted": ', accepted, ", ", F.substring(body, 2, 1 << 30)
    )
    posts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", post.alias("p")))), lambda x: x["p"]), ", ")
    users = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("k")).agg(posts.alias("posts"))
    folder = new_path(spark, "posts")
    put(users.select("k", raw('{"user_id": " ', F.col("k").cast("string"), '", "posts": [', F.col("posts"), ', 7, "x"]}').alias("value")), folder, "{}.jsonl")
    paths = readers.files(spark, folder, "*.jsonl")
    items = readers.numbered(readers.qa_posts(readers.json_lines(spark, paths, only_objects=True)), paths)
    return items.select(
        "user_id", "item_id", "post_type", "ts_ms", "date", F.array_join("tags", ",").alias("tags"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"), "accepted", "source_index"
    )


_DATES = ("yyyy-MM-dd", "yyyyMMdd", "yyyy-MM-dd'T'HH", "yyyy-MM-dd'T'HH:mm:ss'+0700'")


def _dated(orders: DataFrame) -> Column:
    """A date in one of four ISO forms, the last with an offset."""
    k = F.col("o_orderkey") % 4
    return F.coalesce(*[F.when(k == i, F.date_format("o_orderdate", p)) for i, p in enumerate(_DATES)])


_TS = "epoch_us(o_orderdate) // 1000 - CASE WHEN o_orderkey % 4 = 3 THEN 25200000 ELSE 0 END"
_AT = "strftime(to_timestamp(ts_ms // 1000 + 25200) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S+07:00')"


@query(f"""SELECT user_id, category, rating, text, product_title, ts_ms, {_AT} AS timestamp, sha1(category || '|' || user_id || '|' || ts_ms || '|' ||
  CASE WHEN rating = 0 THEN '' ELSE rating::INT::VARCHAR END || '|' || text || '|' || product_title || '||' || category) AS item_id
FROM (SELECT o_custkey::VARCHAR AS user_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Cat ' || o_orderstatus ELSE 'Books' END AS category, (o_orderkey %
  7)::DOUBLE AS rating, o_orderpriority AS text, 'N' || o_orderkey AS product_title, {_TS} AS ts_ms FROM orders)""")
def ingest_shop(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("UserId"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" Cat \t"), "o_orderstatus")).alias("SubCategory"),
        (F.col("o_orderkey") % 7).alias("Rating"),
        F.col("o_orderpriority").alias("Comment"), F.concat(F.lit("N"), "o_orderkey").alias("ProductName"), _dated(orders).alias("CommentDate"), "o_orderkey",
    )
    folder = new_path(spark, "shop")
    put(as_json(rows, "o_orderkey"), folder, "{}/Books.json", array=True)
    items = readers.shop_reviews(readers.json_array(spark, readers.files(spark, folder, "*.json")))
    return items.select("user_id", "category", "rating", "text", "product_title", "ts_ms", "timestamp", "item_id")


@query(f"""SELECT user_id, category, source, thread, text, ts_ms, {_AT} AS timestamp, CASE WHEN explicit THEN 'id ' || thread ELSE sha1(category ||
  '|' || user_id || '|' || ts_ms || '|' || thread || '||' || text) END AS item_id
FROM (SELECT 'c ' || o_custkey AS user_id, CASE WHEN o_orderkey % 3 = 0 THEN 'forum' ELSE o_orderstatus END AS category, CASE WHEN o_orderkey % 3 = 2
  THEN o_orderstatus ELSE 'forum' END AS source, o_orderkey::VARCHAR AS thread,
  o_orderpriority || ', "x"' || chr(10) || 'y' AS text, o_orderkey % 5 = 0 AS explicit, {_TS} AS ts_ms FROM orders)""")
def ingest_forum(spark, sf_dir):
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    rows = orders.select(
        F.concat(F.lit("c   "), "o_custkey").alias("author"), _dated(orders).alias("created_at"),
        F.when(k % 3 == 1, F.col("o_orderstatus")).alias("label"), F.when(k % 3 == 2, F.col("o_orderstatus")).alias("source"),
        k.alias("thread_id"), F.concat("o_orderpriority", F.lit(', "x"\ny')).alias("text"), F.when(k % 5 == 0, F.concat(F.lit("id  "), k)).alias("post_id"),
    )
    folder = new_path(spark, "forum")
    put(rows.withColumn("k", F.col("thread_id")), folder, "f-{}.csv", kind="csv", header="true", quote='"', escape='"')
    items = readers.forum_posts(readers.csv_rows(spark, readers.files(spark, folder, "*.csv")))
    return items.select("user_id", "category", "source", "thread", "text", "ts_ms", "timestamp", "item_id")


@query("""WITH wanted AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity >= 49 AND l_partkey % 4 <> 3)
SELECT CASE WHEN p_partkey % 3 = 0 THEN 'Books' ELSE 'Toys' END AS category, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'P' END || p_partkey AS parent_id,
  p_name || ' 2' AS product_title, p_brand AS product_main, p_type || ',x' AS product_path FROM part JOIN wanted ON p_partkey = k WHERE p_partkey <> 0""")
def metadata_of_wanted(spark, sf_dir):
    """Metadata lines of parts, two for each, some with keys that are numbers, of which 0 is no key; lines of parts that no item names aren't parsed."""
    k = F.col("p_partkey")
    key = F.when(k % 5 == 0, k.cast("string")).otherwise(F.concat(F.lit('"P'), k.cast("string"), F.lit('"')))
    parts = table(spark, sf_dir, "part").withColumn("run", F.explode(F.array(F.lit(1), F.lit(2))))
    body = F.to_json(F.struct(
        F.when(k % 3 == 0, "Books").alias("category"), F.concat("p_name", F.lit(" "), "run").alias("title"), F.col("p_brand").alias("main_category"),
        F.array("p_type", F.lit("x")).alias("categories"),
    ))
    folder = new_path(spark, "metadata")
    put(parts.select((k * 2 + F.col("run")).alias("k"), F.concat(F.lit('{"parent_asin": '), key, F.lit(", "), F.substring(body, 2, 1 << 30)).alias("value")),
        folder, "{}/meta_Toys.jsonl")
    own = F.when(F.col("l_partkey") % 5 == 0, F.col("l_partkey").cast("string")).otherwise(F.concat(F.lit("P"), "l_partkey"))
    items = table(spark, sf_dir, "lineitem").filter("l_quantity >= 49 and l_partkey % 4 <> 3").select(
        F.when(F.col("l_partkey") % 3 == 0, "Books").otherwise("Toys").alias("category"), own.alias("parent_id")
    )
    rows = pipeline.read_metadata(spark, folder, staged(items.distinct(), "wanted"))
    return rows.withColumn("product_path", F.array_join("product_path", ","))


class Endpoint:
    """A model behind HTTP, made up: what it says follows from the request. Some prompts are put off once, some never answered."""

    def __init__(self):
        self.seen = set()

    def __call__(self, body: bytes) -> tuple[int, dict, bytes]:
        asked = json.loads(body)
        first, last = asked["messages"][0]["content"], asked["messages"][-1]["content"]
        n = int(first.split("#")[1])
        if n % 5 == 1:
            return 500, {}, b""
        if n % 5 == 2 and body not in self.seen:
            self.seen.add(body)
            return 429, {"Retry-After": "0"}, b""
        said = f"{last} {'local' if asked.get('max_tokens') else 'router'}"
        if len(asked["messages"]) > 1:
            said = f"{asked['messages'][1]['reasoning_details']} {said}"
        return 200, {}, json.dumps({"choices": [{"message": {"role": "assistant", "content": said, "reasoning_details": f"r{n}"}}]}).encode()


def _client(provider: str, turns: int) -> extract.HttpClient | object:
    http = extract.HttpClient(extract.ClientConfig("http://nowhere", "m", provider=provider, repeats=2), Endpoint(), lambda seconds: None)
    return http if turns == 1 else lambda prompt: http.follow_up(prompt, http.chat([{"role": "user", "content": prompt}]), "and?")["content"]


@query("""SELECT c_custkey AS user_id, way, CASE WHEN c_custkey % 5 <> 1 THEN CASE way WHEN 0 THEN c_name WHEN 1 THEN c_name ELSE 'r' || split_part(c_name, '#',
  2)::BIGINT || ' and?' END || CASE way WHEN 0 THEN ' local' ELSE ' router' END END AS response, c_custkey % 5 = 1 AS failed
FROM customer, (VALUES (0), (1), (2)) w(way)""")
def model_calls(spark, sf_dir):
    """One call of each provider and two turns for each customer, behind a gate; an endpoint in the task puts off some calls and fails others."""
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.lit(0).alias("chunk"), F.col("c_name").alias("prompt"))
    asked = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))  # few input files shouldn't mean few tasks
    path = new_path(spark, "calls")
    with Gate(spark) as gate:
        for way, (provider, turns) in enumerate((("local", 1), ("router", 1), ("openrouter", 2))):
            found = extract.call_model(asked, lambda p=provider, t=turns: _client(p, t), threads=2, door=gate.door)
            found.withColumn("way", F.lit(way)).write.mode("append").parquet(path)
    return spark.read.parquet(path).select("user_id", "way", "response", F.col("error").isNotNull().alias("failed"))


@query("""SELECT (('0x' || substr(sha1(user_id::VARCHAR), 1, 8))::BIGINT % 16)::INT AS shard, count(*) AS events, count(DISTINCT user_id) AS users
  FROM events GROUP BY ALL""")
def shard_files(spark, sf_dir):
    path = sinks.write_shards(table(spark, sf_dir, "events").select("event_id", "user_id"), new_path(spark, "shards"), 16)
    return sinks.read_shards(spark, path).groupBy("shard").agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))


@query(f"""SELECT lpad(part::VARCHAR, 5, '0') AS name, sha256(string_agg(c_name || chr(10), '' ORDER BY k)) AS sha256
  FROM (SELECT *, {_PART} AS part FROM (SELECT c_name, c_custkey AS k, count(*) OVER () AS n, max(c_custkey) OVER () AS m FROM customer)) GROUP BY part""")
def file_digests(spark, sf_dir):
    folder = new_path(spark, "digests")
    put(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("value")), folder, "{}.txt")
    return sinks.file_sha256(spark, f"{folder}/*.txt").select(F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("name"), "sha256")


@query("SELECT count(*) AS rows, count(DISTINCT c_mktsegment) AS segments, max(c_custkey) AS last, 'é' AS sign FROM customer")
def json_document(spark, sf_dir):
    row = table(spark, sf_dir, "customer").agg(
        F.count("*").alias("rows"), F.count_distinct("c_mktsegment").alias("segments"), F.max("c_custkey").alias("last"), F.lit("é").alias("sign")
    )
    path = readers.require(spark, sinks.write_document(row, f"{new_path(spark, 'document')}.json"), "written just now")
    return spark.read.schema("rows long, segments long, last long, sign string").option("multiLine", True).json(path)


_LINES = ", ".join(
    "({}, '- {} | {} | What the {} is. | [{}]')".format(p, i, label, label.lower(), " | ".join(v) or "(free value)") for p, i, label, _, v in DIMS
)


@query(f"""WITH {CHUNK_SQL}, l(pos, line) AS (VALUES {_LINES}), t AS (SELECT chunk, string_agg(line, chr(10) ORDER BY rank) AS body FROM chunks JOIN l
  ON chunks.pos = l.pos GROUP BY chunk)
SELECT c_custkey AS user_id, chunk, md5('Answer.' || chr(10) || chr(10) || 'ATTRIBUTES:' || chr(10) || body || chr(10) || chr(10) || 'HISTORY:' ||
  chr(10) || c_name) AS prompt_md5 FROM customer, t""")
def prompt_log(spark, sf_dir):
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("profile_text"))
    path = sinks.write_prompt_log(prompts.prompts(users, prompts.chunked(dims(spark), 2), rules=("Answer.",)), new_path(spark, "prompts"), 4)
    return spark.read.parquet(path).select("user_id", "chunk", F.md5(F.col("prompt").cast("binary")).alias("prompt_md5"))


@query("SELECT c_custkey::VARCHAR AS user_id, 1::BIGINT AS personas, CASE WHEN c_custkey % 3 = 0 THEN 'first' ELSE 'second' END AS run FROM customer")
def append_personas(spark, sf_dir):
    """Two runs; the second skips the users of the first."""
    users, path = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("user_id")), new_path(spark, "personas")
    schema = "user_id string, run string"
    sinks.append_personas(users.filter("cast(user_id as int) % 3 = 0").withColumn("run", F.lit("first")), path)
    done = spark.read.schema(schema).json(path)
    sinks.append_personas(history.not_done(users, done).withColumn("run", F.lit("second")), path)
    return spark.read.schema(schema).json(path).groupBy("user_id").agg(F.count("*").alias("personas"), F.min("run").alias("run"))


@query("""SELECT trim(role_user) AS user_id, first_text AS value
FROM (SELECT conv_id::VARCHAR AS role_user, md5(coalesce(text, '')) AS first_text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) WHERE n = 1""")
def personas_first_wins(spark, sf_dir):
    fields = F.array(F.struct(F.lit("t").alias("field_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("value")))
    user = F.concat(F.when(F.col("turn") % 2 == 1, " ").otherwise(""), F.col("conv_id").cast("string"))
    rows = table(spark, sf_dir, "conversations").select(user.alias("user_id"), fields.alias("fields"), F.col("turn").alias("ord"))
    nobody = spark.createDataFrame([(" ", None, 0)], "user_id string, fields array<struct<field_id string, value string>>, ord long")
    return stats.distinct_personas(rows.unionByName(nobody)).select("user_id", F.col("fields")[0]["value"].alias("value"))


@query(f"""WITH {PART_DIM_SQL}
SELECT pos, id, category, allowed::INT AS allowed, category LIKE 'SMALL:%' OR category = 'PROMO' AS fits FROM dims""")
def schema_document(spark, sf_dir):
    """A schema and a mapping are written as documents and loaded; the mapping's patterns meet the schema's categories."""
    found = [r.asDict() for r in part_dims(spark, sf_dir).orderBy("pos").select("id", "category", "values").collect()]  # some hundred rows
    folder = new_path(spark, "schema")
    dims = prompts.load_dimensions(spark, sinks.write_json(spark, {"dimensions": found}, f"{folder}/schema.json"))
    mapping = {"evidence_categories": [{"id": "a", "schema_categories": ["SMALL:*", "E*"]}, {"id": "b", "schema_categories": ["PROMO"]}]}
    mapping["skip_by_default_schema_categories"] = ["E*"]
    patterns = prompts.load_mapping(spark, sinks.write_json(spark, mapping, f"{folder}/mapping.json"))
    fit = prompts.schema_subset(dims, *patterns).select("id", F.lit(True).alias("fits"))
    return dims.join(fit, "id", "left").select("pos", "id", "category", F.size("values").alias("allowed"), F.coalesce("fits", F.lit(False)).alias("fits"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type || ',B' WHEN 1 THEN event_type || ',B,c d' WHEN 2 THEN event_type ELSE '1,2,3,4,5,6' END AS path,
  CASE event_id % 3 WHEN 0 THEN 'Toys' WHEN 1 THEN 'Books' ELSE 'Home_part' END AS category FROM events""")
def category_paths(spark, sf_dir):
    k, t = F.col("event_id") % 4, F.col("event_type")
    raw = F.when(
        k == 0, F.concat(F.lit('["'), t, F.lit('", "B", "'), t, F.lit('", ""]'))
    ).when(k == 1, F.concat(F.lit('[["'), t, F.lit('"], ["B", " c  d "]]'))).when(k == 2, t).otherwise('["1","2","3","4","5","6","7"]')
    name = F.when(F.col("event_id") % 3 == 0, "meta_Toys_part_002.jsonl.gz").when(F.col("event_id") % 3 == 1, "Books_sample_9.jsonl").otherwise("Home_part.jsonl")
    return table(spark, sf_dir, "events").select(
        "event_id", F.array_join(fn.category_path(raw), ",").alias("path"), fn.category_of_file(name).alias("category")
    )


# Answers of a made-up survey: each column goes through its labels, one that no rule knows, and a missing one.
ANSWERS: dict[str, tuple[str, ...]] = {source: tuple(mapping) for source, mapping in VALUE_MAPS.values()} | {
    "age": ("17", "18", "30.0", "44", "50", "64.5", "70", "84", "85", "89 or older"), "race": ("white", "black", "other"),
    "hispanic": ("not hispanic", "mexican", ""), "region": ("pacific", ""),
    "degree": ("graduate", "bachelor's", "associate/junior college", "high school", "less than high school"),
    "educ": ("7 years of college", "8 or more years of college", "6th grade", "12th grade", "no formal schooling"),
    "reliten": ("strong", "somewhat strong (vol.)", "not very strong", "no religion"),
}


def _answer_list(column: str) -> tuple[str | None, ...]:
    return (*ANSWERS[column], "odd one", None)


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with white space and capitals as files have them."""
    pick = lambda c, i: F.element_at(
        F.array(*[F.concat(F.lit("\t"), F.initcap(F.lit(x)), F.lit(" ")) for x in _answer_list(c)]),  # a constant: made once
        (F.pmod(F.col("c_custkey") * (2 * i + 1) + F.floor(F.col("c_custkey") / 7), F.lit(len(_answer_list(c)))) + 1).cast("int")
    )
    return spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select(
        F.col("c_custkey").alias("row_index"), *[pick(c, i).alias(c) for i, c in enumerate(SURVEY_COLUMNS)]
    )


def _quoted(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


def _rules_sql() -> str:
    pick = [
        f"list_extract([{', '.join(map(_quoted, _answer_list(c)))}], ((c_custkey * {2 * i + 1} + c_custkey // 7) % {len(_answer_list(c))} + 1)::INT) AS {c if c != 'class' else 'class_'}"
        for i, c in enumerate(SURVEY_COLUMNS)
    ]
    parts = []
    for target, (source, mapping) in VALUE_MAPS.items():
        c = "class_" if source == "class" else source
        cases = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in mapping.items())
        void = [k for k, v in mapping.items() if v is None]
        known = f"WHEN {c} NOT IN ({', '.join(map(_quoted, mapping))}) THEN 'unmapped'"
        known += f" WHEN {c} IN ({', '.join(map(_quoted, void))}) THEN 'deliberately_null'" if void else ""
        status = f"CASE WHEN {c} IS NULL THEN 'missing' {known} ELSE 'mapped' END"
        parts.append(f"SELECT row_index, '{target}' AS dimension_id, CASE {c} {cases} END AS result, {status} AS status FROM a")
    rules = {
        "age_bracket": (
            "CASE WHEN contains(age, 'older') THEN '85+' WHEN n BETWEEN 18 AND 24 THEN '18-24' WHEN n BETWEEN 25 AND 34 THEN '25-34'"
            " WHEN n BETWEEN 35 AND 44 THEN '35-44' WHEN n BETWEEN 45 AND 54 THEN '45-54' WHEN n BETWEEN 55 AND 64 THEN '55-64'"
            " WHEN n BETWEEN 65 AND 74 THEN '65-74' WHEN n BETWEEN 75 AND 84 THEN '75-84' WHEN n >= 85 THEN '85+' END"
        ),
        "demo_ethnicity_broad": (
            "CASE WHEN hispanic <> '' AND hispanic <> 'not hispanic' THEN 'Hispanic / Latino'"
            " WHEN race = 'white' THEN 'White / European' WHEN race = 'black' THEN 'Black / African' END"
        ),
        "highest_education": (
            "CASE degree WHEN 'graduate' THEN CASE"
            " WHEN contains(coalesce(educ, ''), '7 years') OR contains(coalesce(educ, ''), '8 or more years') THEN 'Doctorate' ELSE 'Master''s' END"
            " WHEN 'bachelor''s' THEN 'Bachelor''s' WHEN 'associate/junior college' THEN 'Associate''s'"
            " WHEN 'high school' THEN 'Secondary' WHEN 'less than high school' THEN CASE"
            " WHEN regexp_extract(educ, '^[0-9]+') <> '' AND regexp_extract(educ, '^[0-9]+')::INT <= 8 THEN 'Primary' ELSE 'Secondary' END END"
        ),
        "seniority": "CASE wrkstat WHEN 'retired' THEN 'Retired' WHEN 'in school' THEN 'Student / intern' END",
        "life_stage": "CASE wrkstat WHEN 'in school' THEN 'Student' WHEN 'retired' THEN 'Retirement' END",
        "religiosity": (
            "CASE WHEN relig = 'none' OR reliten = 'no religion' THEN 'Secular' WHEN reliten = 'strong' THEN 'Devout'"
            " WHEN reliten = 'somewhat strong (vol.)' THEN 'Observant' WHEN reliten = 'not very strong' THEN 'Spiritual' END"
        ),
        "region": "CASE WHEN region <> '' THEN 'North America' END",
    }
    parts += [f"SELECT row_index, '{t}', {sql}, CASE WHEN {sql} IS NULL THEN 'unsupported' ELSE 'mapped' END FROM a" for t, sql in rules.items()]
    return f"WITH p AS (SELECT c_custkey AS row_index, {', '.join(pick)} FROM customer), a AS (SELECT *, try_cast(age AS DOUBLE) AS n FROM p) " + " UNION ALL ".join(parts)


@query(_rules_sql())
def survey_rules(spark, sf_dir):
    return cw.audit(_answers(spark, sf_dir), keep=("row_index",)).select("row_index", "dimension_id", "result", "status")


@query("""SELECT format('gss-{:06d}', n_nationkey) AS user_id, 18 AS fields, 4 AS direct, n_nationkey::VARCHAR AS source_row_index FROM nation WHERE
  n_nationkey < 20""")
def survey_file(spark, sf_dir):
    """A Stata file of a row for each nation, converted with its checks and manifest, and read back from its gzipped lines."""
    keys = [r["n_nationkey"] for r in table(spark, sf_dir, "nation").select("n_nationkey").orderBy("n_nationkey").collect()]  # 25 rows at every scale
    frame = pd.DataFrame([
        dict.fromkeys(SURVEY_COLUMNS, "x") | {"sex": ("female", "male")[k % 2], "age": str(20 + 3 * k % 60)} for k in keys
    ]).rename(columns={"class": "clas5"})
    values = {t: sorted({v for v in m.values() if v}) for t, (_, m) in VALUE_MAPS.items()} | {t: [] for t in computed()}
    values |= {
        "age_bracket": ["18-24", "25-34", "35-44", "45-54", "55-64", "65-74", "75-84", "85+"], "region": ["North America"],
        "demo_ethnicity_broad": ["Hispanic / Latino"]
    }
    schema = sinks.write_json(spark, {"dimensions": [{"id": t, "category": "c", "values": v} for t, v in values.items()]}, f"{new_path(spark, 'schema')}.json")
    out = new_path(spark, "survey")
    pipeline.survey(spark, _stata(spark, frame), schema, out, limit=20)
    rows = spark.read.schema(pipeline.PERSONA + ", source_row_index string").json(out)
    return rows.select(
        "user_id", F.size("fields").alias("fields"), F.size(F.filter("fields", lambda f: f["assignment_type"] == "direct")).alias("direct"),
        "source_row_index"
    )


_BARE = "CASE WHEN source_index % 3 = 0 THEN '' ELSE 'thing ' || source_index % 5 END"


@query(f"""WITH {HIST}, rem AS (SELECT * REPLACE (CASE source_index % 11 WHEN 0 THEN 'ok' WHEN 1 THEN '' ELSE text END AS text, ts_ms // 86400000 //
  30 AS ts_ms), {_BARE} AS product_title FROM hist),
pre AS (SELECT *, CASE WHEN rating IS NULL OR rating NOT BETWEEN 1 AND 5 THEN 'missing_or_invalid_rating' WHEN product_title = '' AND
  length({clean('text')}) < 20 THEN 'insufficient_text_evidence' END AS r FROM rem)
SELECT item_id, user_id, coalesce(r, CASE WHEN row_number() OVER (PARTITION BY user_id, category, rating, ts_ms, lower({clean('text')}),
  product_title, r IS NULL ORDER BY source_index) > 1 THEN 'duplicate_review' END) AS reason FROM pre""")
def shop_filter(spark, sf_dir):
    k = F.col("source_index")
    items = hist(spark, sf_dir).withColumn(
        "text", F.when(k % 11 == 0, "ok").when(k % 11 == 1, "").otherwise(F.col("text"))
    ).withColumn("ts_ms", F.floor(F.floor(F.col("ts_ms") / 86_400_000) / 30))
    items = items.withColumn("product_title", F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("thing "), k % 5)))
    return history.removal_reasons(items, REVIEWS_VN).select("item_id", "user_id", "reason")


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN epoch_us(day) // 1000 WHEN 1 THEN epoch_us(day) // 1000 + 9 * 3600000 WHEN 2 THEN
  epoch_us(day) // 1000 + (9 * 3600 + 30 * 60 + 15) * 1000 + 250 WHEN 3 THEN epoch_us(day) // 1000 WHEN 4 THEN epoch_us(day) // 1000 - 5400000 END AS ts_ms
FROM (SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS day FROM events)""")
def iso_forms(spark, sf_dir):
    day, k = F.date_trunc("day", F.col("ts").cast("timestamp_ntz")), F.col("event_id") % 6
    at = lambda p: F.date_format(day, p)
    week = F.concat(
        F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"), F.lit("-"),
        (F.weekday(day) + 1).cast("string")
    )
    text = F.when(k == 0, at("yyyyMMdd")).when(k == 1, at("yyyy-MM-dd'T09'")).when(k == 2, at("yyyy-MM-dd'T093015,25'"))
    text = text.when(k == 3, week).when(k == 4, at("yyyy-MM-dd'T00:00+01:30'")).otherwise("2024-13-01")
    return table(spark, sf_dir, "events").select("event_id", fn.iso_ms(text).alias("ts_ms"))
