"""The registered queries of the persona operators over the tables given, each with its SQL.

The base view ``hist`` joins events with documents into items: event_id is the item, its order and the document; users are the
events' users; ratings are derived from the event's number, so that some are invalid.
"""

from __future__ import annotations

import json

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talus.functions import text as fn
from talus.operators import crosswalk as cw
from talus.operators import extract, history, profile, prompts, sanitize, select, stats
from talus.operators.order import first_of
from talus.plans.specs import FORUM_POSTS, QA_POSTS, REVIEWS_INTL, REVIEWS_VN, TEMPLATES_EN, SourceSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(df: DataFrame, c: str) -> Column:
    """Microseconds since 1970 of a timestamp column, with or without a zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {c})") if df.schema[c].dataType.typeName() == "timestamp_ntz" else F.unix_micros(c)


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Narrow rows dealt anew by a key: few input files shouldn't mean few tasks for what follows."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def hist(spark: SparkSession, sf_dir: str, **of_text: Column) -> DataFrame:
    """Items; with columns made of a document where its text would stand, if any are given."""
    events, docs = table(spark, sf_dir, "events"), table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "source", "lang", *[c.alias(n) for n, c in of_text.items()]) if of_text else docs
    n = docs.agg(F.count("*").alias("n"))  # one row
    keyed = events.crossJoin(F.broadcast(n)).withColumn("k", F.col("event_id") % F.col("n")).withColumn("us", micros(events, "ts"))
    keyed = spread(keyed, "k")  # a join on k needs this anyway
    return keyed.join(docs, F.col("k") == F.col("doc_id")).select(
        F.col("event_id").alias("item_id"), "user_id", F.col("event_type").alias("category"), F.floor(F.col("us") / 1000).cast("long").alias("ts_ms"),
        F.when(F.col("event_id") % 13 == 0, F.lit(None)).otherwise(F.col("event_id") % 7).cast("double").alias("rating"),
        F.col("event_id").alias("source_index"), *(of_text or ["text"]), F.col("source").alias("thread"),
        F.array("lang", "source", "event_type").alias("tags"), F.lit("").alias("title"), (F.col("event_id") % 10 != 0).alias("verified"),
        F.col("value").cast("string").alias("score"), F.col("doc_id").alias("product_id"),
    )


# White space in DuckDB's regular expressions, and the text with its runs collapsed.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def clean(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{WS}', ' ', 'g'))"


HIST = """hist AS (
  SELECT event_id AS item_id, user_id, event_type AS category, epoch_us(ts) // 1000 AS ts_ms,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE (event_id % 7)::DOUBLE END AS rating, event_id AS source_index, text, source AS thread,
    [lang, source, event_type] AS tags, '' AS title, event_id % 10 <> 0 AS verified, value AS score, doc_id AS product_id
  FROM (SELECT *, event_id % (SELECT count(*) FROM documents) AS k FROM events) e JOIN documents d ON d.doc_id = e.k)"""


def _metric_sql(spec: SourceSpec) -> str:
    group = {
        "qa": "(SELECT count(DISTINCT t) FROM hist h2, unnest(h2.tags) AS u(t) WHERE h2.user_id = h.user_id)", "forum": "count(DISTINCT thread)"
    }.get(spec.cascade, "count(DISTINCT category)")
    return f"""SELECT user_id, count(*) AS items, count(*) FILTER (trim(text) <> '') AS text_items, sum(length(text))::BIGINT AS text_chars, {group} AS categories,
    (max(ts_ms) - min(ts_ms)) / 86400000.0::DOUBLE AS history_days, avg(verified::INT) AS verified_share, sum(score) AS score_sum, min(source_index)
  AS first_seen FROM hist h GROUP BY user_id"""


def _ranking_sql(spec: SourceSpec) -> str:
    verified = f" AND verified_share >= {spec.min_verified}" if spec.min_verified is not None else ""
    ordinal = lambda m: f"row_number() OVER (ORDER BY {m}, first_seen) / n::DOUBLE"
    rank = ordinal if spec.ordinal else (lambda m: f"(2 * rank() OVER (ORDER BY {m}) + count(*) OVER (PARTITION BY {m}) - 1) / 2.0::DOUBLE / n")
    score = " + ".join(f"{w}::DOUBLE * {rank(m)}" for m, w in spec.weights.items())
    order = f"round(score, 12) DESC, {', '.join(f'{t} DESC' for t in spec.ties)}, user_id::VARCHAR"
    return f"""WITH {HIST}, m AS ({_metric_sql(spec)}),
e AS (SELECT *, count(*) OVER () AS n FROM m WHERE items >= {spec.min_count} AND text_chars >= {spec.min_chars}{verified}),
s AS (SELECT *, {score} AS score FROM e),
r AS (SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM s)
SELECT user_id, rank::INT AS rank, round(score, 9) AS score, items, categories, text_chars, round(history_days, 6) AS history_days FROM r WHERE rank
  <= {spec.top_k}"""


def _ranking(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> DataFrame:
    top = select.select_users(hist(spark, sf_dir), spec)
    return top.select(
        "user_id", "rank", F.round("score", 9).alias("score"), "items", "categories", "text_chars", F.round("history_days", 6).alias("history_days")
    )


@query(_ranking_sql(REVIEWS_INTL))
def user_ranking(spark, sf_dir):
    return _ranking(spark, sf_dir, REVIEWS_INTL)


@query(_ranking_sql(REVIEWS_VN))
def user_ranking_shop(spark, sf_dir):
    return _ranking(spark, sf_dir, REVIEWS_VN)


@query(_ranking_sql(QA_POSTS))
def user_ranking_ordinal(spark, sf_dir):
    return _ranking(spark, sf_dir, QA_POSTS)


@query(_ranking_sql(FORUM_POSTS))
def user_ranking_forum(spark, sf_dir):
    return _ranking(spark, sf_dir, FORUM_POSTS)


@query(f"WITH {HIST} {_metric_sql(REVIEWS_INTL).replace('AS verified_share', 'AS v')}".replace(
    "SELECT user_id, count(*)",
    "SELECT user_id, items, text_items, text_chars, categories, round(history_days, 6) AS history_days, round(v, 9) AS verified_share FROM (SELECT user_id, count(*)",
    1
) + ")")
def user_metrics(spark, sf_dir):
    users = select.metrics_of(hist(spark, sf_dir), REVIEWS_INTL)
    return users.select(
        "user_id", "items", "text_items", "text_chars", "categories", F.round("history_days", 6).alias("history_days"),
        F.round("verified_share", 9).alias("verified_share")
    )


@query("""SELECT o_orderkey, o_custkey, epoch_us(o_orderdate) // 1000 AS ts_ms FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1996 AND o_custkey
  IS NOT NULL""")
def ingest_filter_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey", F.col("o_custkey").alias("user_id"), F.floor(micros(orders, "o_orderdate") / 1000).cast("long").alias("ts_ms"))
    return select.ingest_filter(rows, REVIEWS_INTL.but(years=(1994, 1996))).select("o_orderkey", F.col("user_id").alias("o_custkey"), "ts_ms")


@query("SELECT user_id, (('0x' || substr(sha1(user_id::VARCHAR), 1, 8))::BIGINT % 256)::INT AS shard, count(*) AS events FROM events GROUP BY user_id")
def shard_assign(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("events")).withColumn("shard", fn.shard(F.col("user_id"), 256))


@query("""SELECT doc_id, source, lang, md5(text) AS text_md5 FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM
  documents) WHERE n = 1""")
def dedupe_first_wins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.sha2("text", 256).alias("same"), F.md5(F.col("text").cast("binary")).alias("text_md5")
    )
    return first_of(docs, ["same"], F.col("doc_id")).drop("same")  # digests stand for texts in the shuffle


@query("""SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER
  BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC) AS n FROM lineitem) WHERE n = 1""")
def metadata_last_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return history.metadata_last(
        rows, ["l_partkey", "l_suppkey"], *map(F.col, ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"))
    ).select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")


# A short remark in place of some texts, so that templates and bare ratings occur.
def remarks(items: DataFrame) -> DataFrame:
    k = F.col("source_index") % 11
    return items.withColumn(
        "text", F.when(k == 0, "Great product, as expected").when(k == 1, "ok").when(k == 2, "Five stars!").when(k == 3, "").otherwise(F.col("text"))
    ).withColumn("ts_ms", F.when(F.col("source_index") % 97 == 0, F.lit(None)).otherwise(F.col("ts_ms") - F.col("ts_ms") % 86_400_000))


REMARKS = """rem AS (SELECT * REPLACE (CASE source_index % 11 WHEN 0 THEN 'Great product, as expected' WHEN 1 THEN 'ok' WHEN 2 THEN 'Five stars!' WHEN
  3 THEN '' ELSE text END AS text,
    CASE WHEN source_index % 97 = 0 THEN NULL ELSE ts_ms - ts_ms % 86400000 END AS ts_ms) FROM hist)"""
_T = [p.replace("'", "''") for p in TEMPLATES_EN]
_MATCH = " ".join(f"WHEN regexp_matches({clean('text')}, '{p}', 'i') THEN 'fulfillment_or_template:{p}'" for p in _T)
JUDGED = f"""pre AS (SELECT *, CASE WHEN ts_ms IS NULL THEN 'missing_or_invalid_timestamp' WHEN rating IS NULL OR rating NOT BETWEEN 1 AND 5 THEN
  'missing_or_invalid_rating'
    WHEN length({clean('text')}) < 20 THEN 'insufficient_text_evidence' WHEN {clean('text')} = '' OR length({clean('text')}) > 220 THEN NULL ELSE CASE
  {_MATCH} END END AS r FROM rem),
judged AS (SELECT *, coalesce(r, CASE WHEN row_number() OVER (PARTITION BY user_id, category, product_id, ts_ms, lower({clean('text')}), r IS NULL
  ORDER BY source_index) > 1 THEN 'duplicate_review' END) AS reason FROM pre)"""


def judged(spark, sf_dir) -> DataFrame:
    return history.removal_reasons(remarks(hist(spark, sf_dir)), REVIEWS_INTL)


@query(f"WITH {HIST}, {REMARKS}, {JUDGED} SELECT item_id, user_id, reason FROM judged")
def reason_cascade(spark, sf_dir):
    return judged(spark, sf_dir).select("item_id", "user_id", "reason")


@query(f"WITH {HIST}, {REMARKS}, {JUDGED} SELECT user_id, coalesce(reason, 'kept') AS reason, count(*) AS n FROM judged GROUP BY ALL")
def removed_by_reason(spark, sf_dir):
    per_user = history.removal_summary(judged(spark, sf_dir))
    both = F.map_concat("removed_by_reason", F.create_map(F.lit("kept"), "kept_rows"))
    return per_user.select("user_id", F.explode(both).alias("reason", "n")).filter("n > 0")


@query(f"""WITH {HIST}, pre AS (SELECT *, CASE WHEN ts_ms IS NULL THEN 'missing_or_invalid_timestamp' WHEN length({clean('text')}) < 20 THEN
  'insufficient_text_evidence' END AS r FROM hist),
d AS (SELECT *, row_number() OVER (PARTITION BY user_id, thread, lower({clean('text')}), r IS NULL ORDER BY source_index) AS n FROM pre)
SELECT user_id, count(*) FILTER (r IS NULL AND n = 1) AS kept, count(*) AS items FROM d GROUP BY user_id""")
def forum_filter(spark, sf_dir):
    items = hist(spark, sf_dir).withColumn("item_id", F.lit("")).withColumn("ts_ms", F.when(F.col("ts_ms").isNotNull(), F.lit(1)))
    return history.removal_reasons(items, FORUM_POSTS).groupBy("user_id").agg(F.count_if(F.col("reason").isNull()).alias("kept"), F.count("*").alias("items"))


@query(f"""WITH {HIST}, rem AS (SELECT * REPLACE (CASE WHEN source_index % 5 = 0 THEN '' ELSE text END AS text, ts_ms // 86400000 // 30 AS ts_ms) FROM hist),
d AS (SELECT *, {clean('text')} = '' AS bare, row_number() OVER (PARTITION BY user_id, ts_ms, lower({clean('text')}) ORDER BY source_index) AS n FROM rem)
SELECT item_id, user_id, CASE WHEN bare THEN 'empty_title_and_text' WHEN n > 1 THEN 'duplicate_post' END AS reason FROM d""")
def qa_filter(spark, sf_dir):
    items = hist(spark, sf_dir).withColumn(
        "text", F.when(F.col("source_index") % 5 == 0, "").otherwise(F.col("text"))
    ).withColumn("ts_ms", F.floor(F.floor(F.col("ts_ms") / 86_400_000) / 30))
    return history.removal_reasons(items, QA_POSTS).select("item_id", "user_id", "reason")


@query("""WITH s AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer)
SELECT o_orderkey, o_custkey, s.rank::INT AS rank FROM orders JOIN s ON o_custkey = c_custkey WHERE s.rank <= 100""")
def selected_inner(spark, sf_dir):
    order = [F.col("c_acctbal").desc(), F.col("c_custkey")]
    top = table(spark, sf_dir, "customer").orderBy(*order).limit(100)
    from pyspark.sql import Window

    top = top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).withColumnRenamed("c_custkey", "user_id")
    return history.only_selected(
        table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "user_id"), top
    ).select("o_orderkey", F.col("user_id").alias("o_custkey"), "rank")


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)")
def wanted_semi(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").filter("l_quantity >= 45").select(F.col("l_partkey").alias("p_partkey"))
    return history.wanted_metadata(table(spark, sf_dir, "part"), items, ["p_partkey"]).select("p_partkey", "p_name")


@query("SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_brand FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) ON l_partkey = p_partkey")
def metadata_left(spark, sf_dir):
    meta = table(spark, sf_dir, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return history.with_metadata(table(spark, sf_dir, "lineitem"), meta, ["l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_brand")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice >= 400000)")
def resume_anti(spark, sf_dir):
    done = table(spark, sf_dir, "orders").filter("o_totalprice >= 400000").select(F.col("o_custkey").alias("user_id"))
    return history.not_done(
        table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "user_id"), done
    ).select(F.col("user_id").alias("c_custkey"), "c_name")


def kept(spark, sf_dir) -> DataFrame:
    return history.kept_items(judged(spark, sf_dir), REVIEWS_INTL)


KEPT = f"{HIST}, {REMARKS}, {JUDGED}, kept AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS c FROM judged WHERE reason IS NULL) WHERE c >= 2)"
SPLIT = f"""{KEPT}, placed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, product_id::VARCHAR, source_index) AS place, count(*)
  OVER (PARTITION BY user_id) AS rows FROM kept),
split AS (SELECT *, CASE WHEN place <= greatest(1, least(floor(rows * 0.8::DOUBLE)::INT, rows - 1)) THEN 'construction' ELSE 'validation' END AS part FROM placed)"""


@query(f"WITH {SPLIT} SELECT item_id, user_id, place::INT AS place, part FROM split")
def temporal_split(spark, sf_dir):
    return history.temporal_split(kept(spark, sf_dir), REVIEWS_INTL).select("item_id", "user_id", "place", "part")


@query(f"""WITH {SPLIT} SELECT user_id, count(*) FILTER (part = 'construction') AS construction_rows, count(*) FILTER (part = 'construction' AND
  {clean('text')} <> '') AS construction_text_rows,
  count(*) FILTER (part = 'construction' AND rating BETWEEN 1 AND 5) AS construction_rated_rows, count(*) FILTER (part = 'validation') AS validation_rows,
  count(*) FILTER (part = 'validation' AND {clean('text')} <> '') AS validation_text_rows, count(*) FILTER (part = 'validation' AND rating BETWEEN 1
  AND 5) AS validation_rated_rows,
  max(ts_ms) FILTER (part = 'construction') AS construction_last, min(ts_ms) FILTER (part = 'validation') AS validation_first FROM split GROUP BY user_id""")
def split_summary(spark, sf_dir):
    items = history.removal_reasons(history.with_has_text(remarks(hist(spark, sf_dir))), REVIEWS_INTL)
    return history.split_summary(history.temporal_split(history.kept_items(items, REVIEWS_INTL), REVIEWS_INTL))


@query(f"""WITH {HIST} SELECT user_id, category, count(*) AS items, count(*) FILTER ({clean('text')} <> '') AS text_items, count(*) FILTER
  ({clean('text')} = '') AS rating_only,
  sum(length({clean('text')}))::BIGINT AS text_chars, count(*) FILTER (rating BETWEEN 1 AND 5) AS rated, round(avg(rating) FILTER (rating BETWEEN 1
  AND 5), 3) AS mean_rating FROM hist GROUP BY user_id, category""")
def category_stats(spark, sf_dir):
    return history.category_stats(hist(spark, sf_dir))


COUNTED = f"{HIST}, counted AS (SELECT user_id, category, rating::INT::VARCHAR AS value, count(*) AS n FROM hist WHERE rating BETWEEN 1 AND 5 GROUP BY ALL)"


@query(f"WITH {COUNTED} SELECT * FROM counted")
def rating_counters(spark, sf_dir):
    return history.counters(hist(spark, sf_dir), history.rating_value(F.col("rating")))


@query(f"""WITH {COUNTED} SELECT user_id, category, value, n, place FROM (SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY n DESC,
  value)::INT AS place FROM counted) WHERE place <= 3""")
def top_counters(spark, sf_dir):
    return history.top_counters(history.counters(hist(spark, sf_dir), history.rating_value(F.col("rating"))), 3)


@query(f"SELECT doc_id, md5({clean('text')}) AS clean_md5, length({clean('text')}) AS n FROM documents")
def compact_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", fn.collapse(F.col("text")).alias("c")).select(
        "doc_id", F.md5(F.col("c").cast("binary")).alias("clean_md5"), F.length("c").cast("long").alias("n")
    )


@query(f"""SELECT doc_id, CASE WHEN length(c) > 220 THEN rtrim(left(c, 205)) || ' ... [truncated]' ELSE c END AS cut FROM (SELECT doc_id,
  {clean('text')} AS c FROM documents)""")
def truncate_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", fn.truncate(F.col("text"), 220).alias("cut"))


_CODED = "html || '<pre><CODE class=\"x\">a' || chr(10) || '<b></CODE></pre> z&amp;' || page_id"


@query(f"""SELECT page_id, {clean(f'''regexp_replace(regexp_replace({_CODED}, '<code.*?>.*?</code>', ' [CODE] ', 'gis'), '<.*?>', ' ', 'gs')''')} AS
  plain FROM pages""")
def html_strip(spark, sf_dir):
    html = F.concat("html", F.lit('<pre><CODE class="x">a\n<b></CODE></pre> z&amp;'), F.col("page_id").cast("string"))
    return table(spark, sf_dir, "pages").select("page_id", fn.strip_html(html).alias("plain"))


@query("SELECT doc_id, array_to_string(CASE WHEN lang = source THEN [lang] ELSE [lang, source] END, ',') AS tags FROM documents")
def tag_parse(spark, sf_dir):
    tags = F.concat(F.lit("<"), "lang", F.lit("><"), "source", F.lit("><"), "lang", F.lit(">"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(fn.parse_tags(tags), ",").alias("tags"))


@query("""SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL WHEN event_id % 4 = 2 THEN epoch_us(ts) // 1000 ELSE epoch_us(ts) // 1000000 * 1000
  END AS ts_ms FROM events""")
def epoch_normalize(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    us, k = micros(events, "ts"), F.col("event_id") % 4
    raw = F.when(k == 3, "-5").when(k == 2, F.floor(us / 1000).cast("string")).otherwise(F.floor(us / 1_000_000).cast("string"))
    return events.select("event_id", fn.epoch_ms(raw).alias("ts_ms"))


@query("""SELECT event_id, epoch_us(ts) // 1000000 * 1000 AS ts_ms, strftime(to_timestamp(epoch_us(ts) // 1000000 + 25200) AT TIME ZONE 'UTC',
  '%Y-%m-%dT%H:%M:%S+07:00') AS iso FROM events""")
def iso_format_plus7(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    iso = fn.iso_plus7(F.floor(micros(events, "ts") / 1000))
    return events.select("event_id", iso.alias("iso")).withColumn("ts_ms", fn.iso_ms(F.col("iso")))


@query(f"SELECT md5(concat_ws('|', source, lang, lower({clean('text')}))) AS content_key, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1")
def content_key(spark, sf_dir):
    key = F.md5(F.concat_ws("|", "source", "lang", F.lower(fn.collapse(F.col("text")))).cast("binary"))
    return table(spark, sf_dir, "documents").groupBy(key.alias("content_key")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query("SELECT doc_id, sha1(concat_ws('|', source, lang, doc_id::VARCHAR, text)) AS surrogate FROM documents")
def sha1_id(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", fn.surrogate_id(*map(F.col, ("source", "lang", "doc_id", "text"))).alias("surrogate"))


@query("SELECT event_id, value BETWEEN 1 AND 5 AS valid, CASE WHEN value BETWEEN 1 AND 5 THEN (floor(value * 2) / 2) END AS half FROM events")
def rating_valid(spark, sf_dir):
    ok = fn.valid_rating(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", ok.alias("valid"), F.when(ok, F.floor(F.col("value") * 2) / 2).alias("half"))


_NEWEST = "SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations"


def turns(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("user_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


@query(f"SELECT conv_id AS user_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT AS place FROM ({_NEWEST}) WHERE back <= 5")
def newest_n(spark, sf_dir):
    return profile.newest(turns(spark, sf_dir), 5, [F.col("turn").desc()]).select("user_id", "turn", "place")


@query(f"""WITH r AS (SELECT conv_id AS user_id, turn, coalesce(role, '') || ': ' || coalesce(text, '') AS rendered, back FROM ({_NEWEST})),
f AS (SELECT *, sum(length(rendered) + 2) OVER (PARTITION BY user_id ORDER BY back) - 2 AS upto FROM r)
SELECT user_id, turn, length(rendered) AS n FROM f WHERE upto <= 600""")
def suffix_fit(spark, sf_dir):
    shown = profile.newest(turns(spark, sf_dir), 0, [F.col("turn").desc()]).withColumn("rendered", F.concat_ws(": ", "role", "text"))
    return profile.suffix_fit(shown, 600).select("user_id", "turn", F.length("rendered").cast("long").alias("n"))


def _profiles(spark, sf_dir, spec: SourceSpec, **fields: Column) -> DataFrame:
    """Profiles of hist, whose texts are found by key once it is settled which are shown; of documents that share id and text one is kept."""
    key = F.struct("doc_id", F.xxhash64("text"))
    items = hist(spark, sf_dir, text_key=key, shown_chars=F.length(profile.shown_text(spec))).withColumns(fields)
    texts = table(spark, sf_dir, "documents").select(key.alias("text_key"), "text").dropDuplicates(["text_key"])
    return profile.profiles(items, spec, texts=texts)


@query(f"""WITH {HIST}, r AS (SELECT user_id, source_index, '[post ' || row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, source_index) || ']'
  || chr(10) || 'timestamp: unknown' || chr(10) || 'thread_id: ' || thread || chr(10) || 'text: ' ||
  CASE WHEN length({clean('text')}) > 2000 THEN rtrim(left({clean('text')}, 1985)) || ' ... [truncated]' ELSE {clean('text')} END AS line,
  row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, source_index) AS place FROM hist)
SELECT user_id, count(*) AS profile_items, md5(left('Forum member profile.' || chr(10) || chr(10) || string_agg(line, chr(10) || chr(10) ORDER BY
  place), 35000)) AS profile_md5 FROM r GROUP BY user_id""")
def profile_assemble(spark, sf_dir):
    out = _profiles(spark, sf_dir, FORUM_POSTS)
    return out.select("user_id", "profile_items", F.md5(F.col("profile_text").cast("binary")).alias("profile_md5"))


@query(f"""WITH {HIST}, r AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, source_index) AS asc_, row_number() OVER
  (PARTITION BY user_id ORDER BY ts_ms DESC, source_index DESC) AS back, * EXCLUDE (user_id) FROM hist),
p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY asc_) AS place FROM r WHERE back <= 90),
l AS (SELECT user_id, place, '[post p' || lpad(place::VARCHAR, 4, '0') || ']' || chr(10) || 'date: unknown' || chr(10) || 'type: post' || chr(10) ||
  'tags: ' || array_to_string(tags, ', ') || chr(10) || 'title: (untitled)' || chr(10) || 'score: 1' || chr(10) || 'accepted: n/a' || chr(10) ||
  'text: ' || {clean('text')} AS line FROM p),
f AS (SELECT *, sum(length(line) + 2) OVER (PARTITION BY user_id ORDER BY place DESC) - 2 AS upto FROM l)
SELECT u.user_id, count(f.line) AS profile_items, md5(coalesce(string_agg(f.line, chr(10) || chr(10) ORDER BY f.place), '')) AS profile_md5 FROM
  (SELECT DISTINCT user_id FROM hist) u LEFT JOIN (SELECT * FROM f WHERE upto <= 70000) f ON u.user_id = f.user_id GROUP BY u.user_id""")
def profile_whole_items(spark, sf_dir):
    out = _profiles(spark, sf_dir, QA_POSTS, score=F.lit("1"))
    return out.select("user_id", "profile_items", F.md5(F.col("profile_text").cast("binary")).alias("profile_md5"))


@query(f"""WITH {HIST}, s AS (SELECT user_id, category, count(*) AS items, sum(length({clean('text')})) AS chars, count(*) FILTER (rating BETWEEN 1
  AND 5) AS rated, round(avg(rating) FILTER (rating BETWEEN 1 AND 5), 3) AS mean FROM hist GROUP BY ALL),
t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY items DESC, category) AS place FROM s)
SELECT user_id, '=== Category Summary === ' || string_agg('category=' || category || '; review_count=' || items || '; text_chars=' || chars ||
  '; rating_count=' || rated || '; mean_rating=' || coalesce(printf('%.2f', mean), 'unknown'), ' ' ORDER BY place) AS summary FROM t WHERE place <= 12
  GROUP BY user_id""")
def summary_line(spark, sf_dir):
    return profile.summary(history.category_stats(hist(spark, sf_dir)), REVIEWS_VN)


# A schema of eight dimensions in four categories, in SQL and as rows.
DIMS = [
    (0, "lang_pref", "Language", "Text: Form", ["en", "fr", "de", "es"]), (1, "length_band", "Length", "Text: Form", ["short", "mid–long", "long"]),
    (2, "source_kind", "Source", "Origin: Source", []),
    (3, "tone", "Tone", "Style", ["calm", "None"]), (4, "detail", "Detail", "Style", ["low", "high"]),
    (5, "place", "Place", "Origin: Region", ["north", "south"]), (6, "pace", "Pace", "Text: Form", ["slow", "fast"]),
    (7, "topic", "Topic", "Style", ["a", "b"]),
]
DIM_SQL = "dims(pos, id, category, allowed) AS (VALUES " + ", ".join(f"({p}, '{i}', '{c}', {v or '[]::VARCHAR[]'})" for p, i, _, c, v in DIMS) + ")"


def dims(spark) -> DataFrame:
    rows = [(p, i, label, c, f"What the {label.lower()} is.", v) for p, i, label, c, v in DIMS]
    return spark.createDataFrame(rows, "pos int, id string, label string, category string, description string, values array<string>")


CHUNK_SQL = f"""{DIM_SQL}, c AS (SELECT *, min(pos) OVER (PARTITION BY category) AS first, (row_number() OVER (PARTITION BY category ORDER BY pos) -
  1) // 2 AS part FROM dims),
chunks AS (SELECT *, (dense_rank() OVER (ORDER BY first, part) - 1)::INT AS chunk, row_number() OVER (ORDER BY first, pos)::INT AS rank FROM c)"""


PART_DIM_SQL = """d AS (SELECT p_type || '/' || p_brand AS id, CASE WHEN b % 3 = 0 THEN p_type ELSE p_type || ': b' || b % 3 END AS category,
  count(DISTINCT p_size) AS allowed FROM (SELECT *, replace(p_brand, 'Brand#', '')::INT AS b FROM part) GROUP BY ALL),
dims AS (SELECT (row_number() OVER (ORDER BY id) - 1)::INT AS pos, * FROM d)"""


def part_dims(spark, sf_dir) -> DataFrame:
    """A schema of a dimension for each type and brand of parts, whose values are their sizes: some hundred rows at every scale."""
    b = F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("int")
    category = F.when(b % 3 == 0, F.col("p_type")).otherwise(F.concat("p_type", F.lit(": b"), (b % 3).cast("string")))
    rows = table(spark, sf_dir, "part").groupBy(F.concat("p_type", F.lit("/"), "p_brand").alias("id"), category.alias("category")).agg(
        F.array_sort(F.collect_set(F.col("p_size").cast("string"))).alias("values")
    )
    return rows.withColumn("pos", F.row_number().over(Window.orderBy("id")) - 1)


@query(f"""WITH {PART_DIM_SQL}, c AS (SELECT *, min(pos) OVER (PARTITION BY category) AS first, (row_number() OVER (PARTITION BY category ORDER BY pos) -
  1) // 4 AS part FROM dims)
SELECT id, category, (dense_rank() OVER (ORDER BY first, part) - 1)::INT AS chunk, row_number() OVER (ORDER BY first, pos)::INT AS rank FROM c""")
def dim_chunks(spark, sf_dir):
    return prompts.chunked(part_dims(spark, sf_dir), 4).select("id", "category", "chunk", "rank")


@query(f"""WITH {PART_DIM_SQL} SELECT id, category, allowed::INT AS allowed FROM dims WHERE (category LIKE 'SMALL:%' OR category LIKE 'E%' OR category =
  'PROMO') AND NOT category LIKE 'ECONOMY: b2%'""")
def schema_subset(spark, sf_dir):
    pattern = lambda *p: spark.createDataFrame([(x,) for x in p], "pattern string")
    found = prompts.schema_subset(part_dims(spark, sf_dir), pattern("SMALL:*", "E*", "PROMO"), pattern("ECONOMY: b2*"))
    return found.select("id", "category", F.size("values").alias("allowed"))


@query(f"WITH {CHUNK_SQL} SELECT c_custkey AS user_id, chunk, count(*) AS dimensions FROM customer, chunks GROUP BY ALL")
def prompt_grid(spark, sf_dir):
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("profile_text"))
    grid = prompts.prompts(users, prompts.chunked(dims(spark), 2), rules=("Answer.",))
    return grid.select("user_id", "chunk", F.size(F.filter(F.split("prompt", "\n"), lambda x: x.startswith("- "))).cast("long").alias("dimensions"))


def answers(spark, sf_dir) -> DataFrame:
    """Answers that a model might give about documents, with words around the object; every seventh one is broken."""
    part = lambda **kw: F.struct(*[v.alias(k) for k, v in kw.items()])
    lit, d = F.lit, F.col("doc_id")
    fields = F.array(
        part(field_id=lit("lang_pref"), value=F.upper("lang"), confidence=lit("0.6"), evidence=F.substring("text", 1, 12), assignment_type=lit("direct")),
        part(field_id=lit("lang_pref"), value=F.col("lang"), confidence=lit("0.9"), evidence=lit("@@ nowhere @@"), assignment_type=lit("direct")),
        part(
            field_id=lit("lang_pref"), value=lit("fr"), confidence=F.when(d % 2 == 0, "0.7").otherwise("x"), evidence=F.substring("text", 1, 5),
            assignment_type=lit("summary_inference")
        ),
        part(
            field_id=lit("length_band"), value=F.when(F.col("n_chars") < 500, "short").otherwise("Mid-Long"), confidence=lit("7"),
            evidence=F.substring("text", 1, 4), assignment_type=F.when(d % 3 == 0, "guess").otherwise("structured_claim")
        ),
        part(field_id=lit("source_kind"), value=F.col("source"), confidence=lit("-1"), evidence=F.substring("text", 2, 6), assignment_type=lit("direct")),
        part(field_id=lit("tone"), value=lit(" None "), confidence=lit("1"), evidence=F.substring("text", 1, 6), assignment_type=lit("direct")),
        part(field_id=lit("nosuch"), value=lit("a"), confidence=lit("1"), evidence=F.substring("text", 1, 6), assignment_type=lit("direct")),
    )
    body = F.to_json(F.struct(fields.alias("fields")))
    text = F.when(d % 7 == 0, "}{ no").otherwise(F.concat(F.lit("Sure: "), body, F.lit(" done")))
    return table(spark, sf_dir, "documents").select(d.alias("user_id"), F.lit(0).alias("chunk"), text.alias("response"))


def profiles_of(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("user_id"), F.coalesce("text", F.lit("")).alias("profile_text"))


RAW_SQL = """raw AS (SELECT doc_id AS user_id, text, unnest([
  {'pos': 0, 'field_id': 'lang_pref', 'value': upper(lang), 'confidence': '0.6', 'evidence': left(text, 12), 'assignment_type': 'direct'},
  {'pos': 1, 'field_id': 'lang_pref', 'value': lang, 'confidence': '0.9', 'evidence': '@@ nowhere @@', 'assignment_type': 'direct'},
  {'pos': 2, 'field_id': 'lang_pref', 'value': 'fr', 'confidence': CASE WHEN doc_id % 2 = 0 THEN '0.7' ELSE 'x' END, 'evidence': left(text, 5), 'assignment_type': 'summary_inference'},
  {'pos': 3, 'field_id': 'length_band', 'value': CASE WHEN n_chars < 500 THEN 'short' ELSE 'Mid-Long' END,
    'confidence': '7', 'evidence': left(text, 4), 'assignment_type': CASE WHEN doc_id % 3 = 0 THEN 'guess' ELSE 'structured_claim' END},
  {'pos': 4, 'field_id': 'source_kind', 'value': source, 'confidence': '-1', 'evidence': substr(text, 2, 6), 'assignment_type': 'direct'},
  {'pos': 5, 'field_id': 'tone', 'value': ' None ', 'confidence': '1', 'evidence': left(text, 6), 'assignment_type': 'direct'},
  {'pos': 6, 'field_id': 'nosuch', 'value': 'a', 'confidence': '1', 'evidence': left(text, 6), 'assignment_type': 'direct'}], recursive := true) FROM
  documents WHERE doc_id % 7 <> 0)"""


@query(f"WITH {RAW_SQL} SELECT user_id, pos::INT AS pos, field_id, value, confidence, md5(evidence) AS evidence_md5, assignment_type FROM raw")
def parse_fields(spark, sf_dir):
    return sanitize.parse_answers(answers(spark, sf_dir)).select(
        "user_id", "pos", "field_id", "value", "confidence", F.md5(F.col("evidence").cast("binary")).alias("evidence_md5"), "assignment_type"
    )


_DASH = lambda x: f"lower(trim(regexp_replace(replace({x}, '-', '–'), '{WS}', ' ', 'g')))"
JUDGE_SQL = f"""{DIM_SQL}, {RAW_SQL}, j0 AS (SELECT r.*, trim(r.evidence) AS ev, greatest(0, least(1, coalesce(try_cast(confidence AS DOUBLE), 0)))::DOUBLE AS conf,
    CASE WHEN lower(trim(value)) IN ('', 'null', 'none', 'n/a', 'na', 'unknown', 'unsupported', 'not applicable') THEN NULL WHEN len(allowed) = 0 THEN
  trim(value) WHEN list_contains(allowed, trim(value)) THEN trim(value)
      ELSE list_filter(allowed, lambda a: {_DASH('a')} = {_DASH('trim(value)')})[-1] END AS val FROM raw r JOIN dims d ON r.field_id = d.id),
j AS (SELECT *, coalesce(val IS NOT NULL AND assignment_type IN ('direct', 'structured_claim', 'summary_inference') AND ev <> '' AND (contains(text,
  ev) OR contains({clean('text')}, {clean('ev')})), false) AS supported FROM j0)"""


@query(f"""WITH {JUDGE_SQL} SELECT user_id, pos::INT AS pos, field_id, supported, CASE WHEN supported THEN val END AS value, CASE WHEN supported THEN
  conf ELSE 0 END AS confidence FROM j""")
def quote_check(spark, sf_dir):
    return sanitize.judged(
        sanitize.parse_answers(answers(spark, sf_dir)), dims(spark), profiles_of(spark, sf_dir)
    ).select("user_id", "pos", "field_id", "supported", "value", "confidence")


BEST_SQL = f"""{JUDGE_SQL}, best AS (SELECT user_id, field_id, CASE WHEN supported THEN val END AS value, CASE WHEN supported THEN conf ELSE 0 END AS
  confidence, CASE WHEN supported THEN assignment_type ELSE 'unsupported' END AS assignment_type,
    row_number() OVER (PARTITION BY user_id, field_id ORDER BY supported DESC, CASE WHEN supported THEN conf ELSE 0 END DESC, pos) AS n FROM j)"""


@query(f"WITH {BEST_SQL} SELECT user_id, field_id, value, confidence, assignment_type FROM best WHERE n = 1")
def sanitize_best(spark, sf_dir):
    return best(spark, sf_dir).select("user_id", "field_id", "value", "confidence", "assignment_type")


def best(spark, sf_dir) -> DataFrame:
    return sanitize.best_answers(sanitize.judged(sanitize.parse_answers(answers(spark, sf_dir)), dims(spark), profiles_of(spark, sf_dir)))


def supported(spark, sf_dir) -> DataFrame:
    """Fields with a value, counted before they are put into personas."""
    return best(spark, sf_dir).filter("value is not null").select("user_id", F.col("field_id").alias("id"))


def personas(spark, sf_dir) -> DataFrame:
    return sanitize.personas(best(spark, sf_dir), profiles_of(spark, sf_dir), prompts.chunked(dims(spark), 2))


@query(f"""WITH {BEST_SQL}, g AS (SELECT d.doc_id AS user_id, x.id FROM documents d, dims x) SELECT g.user_id, g.id AS field_id, b.value,
  coalesce(b.confidence, 0) AS confidence, coalesce(b.assignment_type, 'unsupported') AS assignment_type
  FROM g LEFT JOIN (SELECT * FROM best WHERE n = 1) b ON g.user_id = b.user_id AND g.id = b.field_id""")
def persona_fields(spark, sf_dir):
    return personas(spark, sf_dir).select("user_id", F.explode("fields").alias("f")).select(
        "user_id", "f.field_id", "f.value", "f.confidence", "f.assignment_type"
    )


@query(f"""WITH {BEST_SQL}, n AS (SELECT count(*) AS persona_count FROM documents), s AS (SELECT count(*) AS supported FROM best WHERE n = 1 AND value IS NOT NULL)
SELECT persona_count, supported AS supported_dimension_count, 8::BIGINT AS schema_dimension_count, round(supported / persona_count::DOUBLE, 4) AS
  average_supported_dimensions_per_persona FROM n, s""")
def persona_stats(spark, sf_dir):
    return stats.persona_stats(profiles_of(spark, sf_dir), supported(spark, sf_dir), dims(spark))


@query(f"""WITH {BEST_SQL} SELECT category, count(*) AS supported_dimension_count FROM best JOIN dims ON field_id = id WHERE n = 1 AND value IS NOT
  NULL GROUP BY category""")
def supported_by_category(spark, sf_dir):
    return stats.supported_by_category(supported(spark, sf_dir), dims(spark))


@query(f"""WITH {BEST_SQL}, s AS (SELECT category, count(*) AS k FROM best JOIN dims ON field_id = id WHERE n = 1 AND value IS NOT NULL GROUP BY category)
SELECT d.category, round(100.0::DOUBLE * coalesce(any_value(k), 0) / ((SELECT count(*) FROM documents) * count(*)), 9) AS coverage_pct FROM dims d
  LEFT JOIN s ON d.category = s.category GROUP BY d.category""")
def coverage_pct(spark, sf_dir):
    return stats.coverage(profiles_of(spark, sf_dir), supported(spark, sf_dir), dims(spark)).withColumn("coverage_pct", F.round("coverage_pct", 9))


# Market segments and priorities of orders stand for coded answers.
SURVEY_MAPS = {
    "segment_kind": ("segment", {"automobile": "Vehicle", "building": "Home", "furniture": "Home", "machinery": None}),
    "urgency": ("priority", {"1-urgent": "High", "2-high": "High", "5-low": "Low", "3-medium": "Middle"}),
}


def survey(spark, sf_dir) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("row_index"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise(F.concat(F.lit("  "), "o_orderpriority")).alias("priority"),
        F.floor(F.col("c_acctbal") / 100).alias("age")
    )


def survey_rules() -> dict[str, Column]:
    from talus.functions.survey import age_bracket

    return {"age_bracket": age_bracket(F.col("age"))}


SURVEY_SQL = """answers AS (SELECT o_orderkey AS row_index, lower(c_mktsegment) AS segment, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE
  lower(o_orderpriority) END AS priority,
    CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE '  ' || o_orderpriority END AS raw_priority, c_mktsegment AS raw_segment, floor(c_acctbal / 100) AS
  age FROM orders JOIN customer ON o_custkey = c_custkey),
audit AS (
  SELECT row_index, 'segment_kind' AS dimension_id, raw_segment AS raw_value, CASE segment WHEN 'automobile' THEN 'Vehicle' WHEN 'building' THEN
  'Home' WHEN 'furniture' THEN 'Home' END AS result,
    CASE WHEN segment IS NULL THEN 'missing' WHEN segment = 'machinery' THEN 'deliberately_null' WHEN segment IN ('automobile', 'building',
  'furniture') THEN 'mapped' ELSE 'unmapped' END AS status FROM answers
  UNION ALL SELECT row_index, 'urgency', raw_priority, CASE priority WHEN '1-urgent' THEN 'High' WHEN '2-high' THEN 'High' WHEN '5-low' THEN 'Low'
  WHEN '3-medium' THEN 'Middle' END,
    CASE WHEN priority IS NULL THEN 'missing' WHEN priority IN ('1-urgent', '2-high', '5-low', '3-medium') THEN 'mapped' ELSE 'unmapped' END FROM answers
  UNION ALL SELECT row_index, 'age_bracket', NULL, a, CASE WHEN a IS NULL THEN 'unsupported' ELSE 'mapped' END FROM (SELECT row_index, CASE WHEN age
  BETWEEN 18 AND 24 THEN '18-24' WHEN age BETWEEN 25 AND 34 THEN '25-34' WHEN age BETWEEN 35 AND 44 THEN '35-44'
    WHEN age BETWEEN 45 AND 54 THEN '45-54' WHEN age BETWEEN 55 AND 64 THEN '55-64' WHEN age BETWEEN 65 AND 74 THEN '65-74' WHEN age BETWEEN 75 AND 84
  THEN '75-84' WHEN age >= 85 THEN '85+' END AS a FROM answers))"""


@query(f"WITH {SURVEY_SQL} SELECT * FROM audit")
def crosswalk_map(spark, sf_dir):
    return cw.audit(
        survey(spark, sf_dir), SURVEY_MAPS, survey_rules(), keep=("row_index",)
    ).select("row_index", "dimension_id", "raw_value", "result", "status")


@query(f"""WITH {SURVEY_SQL} SELECT dimension_id || '=' || raw_value AS value, count(*) AS n, min(row_index) AS first_seen FROM audit WHERE status =
  'unmapped' GROUP BY 1 ORDER BY n DESC, first_seen LIMIT 100""")
def unmapped_top(spark, sf_dir):
    return cw.top_unmapped(cw.crosswalk(survey(spark, sf_dir), SURVEY_MAPS, survey_rules()), "row_index")


@query(f"""WITH {SURVEY_SQL} SELECT grounded, count(*) AS respondents FROM (SELECT row_index, count(result)::INT AS grounded FROM audit GROUP BY
  row_index) GROUP BY grounded""")
def grounded_histogram(spark, sf_dir):
    return cw.grounded_histogram(cw.crosswalk(survey(spark, sf_dir), SURVEY_MAPS, survey_rules()))


def survey_personas(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = [(0, "segment_kind", ["Vehicle", "Home"]), (1, "urgency", ["High", "Low"]), (2, "age_bracket", None), (3, "other", ["x"])]
    schema = spark.createDataFrame(rows, "pos int, id string, values array<string>")
    seen = cw.surrogate_users(cw.crosswalk(survey(spark, sf_dir), SURVEY_MAPS, survey_rules()), "row_index")
    return cw.full_fields(seen, schema), schema


@query(f"""WITH {SURVEY_SQL} SELECT (SELECT count(*) FROM answers) AS rows, (SELECT count(DISTINCT row_index) FROM answers) AS unique_users, count(*)
  FILTER (result = 'Middle' OR dimension_id = 'age_bracket' AND result IS NOT NULL) AS errors FROM audit""")
def validate_counts(spark, sf_dir):
    return cw.validation(*survey_personas(spark, sf_dir))


@query(f"WITH {SURVEY_SQL} SELECT format('gss-{{:06d}}', row_index) AS user_id, 4 AS fields, count(result)::INT AS direct FROM audit GROUP BY row_index")
def survey_fields(spark, sf_dir):
    full, _ = survey_personas(spark, sf_dir)
    return full.select("user_id", F.size("fields").alias("fields"), F.size(F.filter("fields", lambda f: f["assignment_type"] == "direct")).alias("direct"))


@query(f"""SELECT doc_id, CASE WHEN length(c) <= 220 AND c <> '' THEN CASE
  {' '.join(f'WHEN regexp_matches(c, {chr(39)}{p}{chr(39)}, {chr(39)}i{chr(39)}) THEN {i}' for i, p in enumerate(_T))} END END AS pattern FROM (SELECT
  doc_id, {clean('text')} || CASE WHEN doc_id % 3 = 0 THEN ' Would buy again!' ELSE '' END AS c FROM documents)""")
def template_match(spark, sf_dir):
    text = F.concat(fn.collapse(F.col("text")), F.when(F.col("doc_id") % 3 == 0, " Would buy again!").otherwise(""))
    found = history.template_match(F.lit(""), text, TEMPLATES_EN)
    return table(spark, sf_dir, "documents").select("doc_id", (F.array_position(F.array(*map(F.lit, TEMPLATES_EN)), found) - 1).cast("int").alias("pattern"))


def first_words(prompt: str) -> str:
    """A stand-in for a model: it answers from the history of its prompt, with words copied from it as evidence."""
    asked, _, told = prompt.partition("\nHISTORY:\n")
    words = told.split()
    found = {"length_band": "short" if len(told) < 500 else "mid-long", "source_kind": f"begins with {words[0]}"} if words else {}
    part = {"confidence": 0.5, "evidence": " ".join(words[:3]), "description": "", "assignment_type": "direct"}
    return json.dumps({"fields": [{"field_id": i, "value": v, **part} for i, v in found.items() if f"- {i} |" in asked]})


@query(f"""SELECT doc_id AS user_id, 8::INT AS fields, CASE WHEN t <> '' THEN CASE WHEN length(text) < 500 THEN 'short' ELSE 'mid–long' END END AS length_band,
  CASE WHEN t <> '' THEN 'begins with ' || split_part(t, ' ', 1) END AS source_kind, CASE WHEN t <> '' THEN 1.0 ELSE 0.0 END AS confidence
FROM (SELECT *, {clean('text')} AS t FROM documents)""")
def llm_extract_stub(spark, sf_dir):
    """Profiles with the chunks that are due, prompts made where they are used, calls, answers judged against the profiles."""
    chunks = prompts.chunked(dims(spark), 50)
    due = profiles_of(spark, sf_dir).crossJoin(F.broadcast(chunks.agg(F.array_sort(F.collect_set("chunk")).alias("chunks"))))  # one row
    found = extract.call_model(prompts.prompts(due, chunks), lambda: first_words)
    best = sanitize.best_answers(sanitize.judged(sanitize.parse_answers(found), dims(spark), profiles_of(spark, sf_dir)))
    people = sanitize.personas(best, profiles_of(spark, sf_dir), chunks)
    value = lambda i: F.filter("fields", lambda f: f["field_id"] == i)[0]["value"].alias(i)
    confidence = F.aggregate("fields", F.lit(0.0), lambda s, f: s + f["confidence"]).alias("confidence")
    return people.select("user_id", F.size("fields").alias("fields"), value("length_band"), value("source_kind"), confidence)
