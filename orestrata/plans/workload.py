"""The registered queries: each operator over the whole test tables, with the same question in SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orestrata.functions.digests import content_digest, object_id
from orestrata.functions.text import joined_label, prefixed_unless_missing
from orestrata.functions.urls import origin
from orestrata.operators.answers import align_left, best_period, latest_per_key, period_stats
from orestrata.operators.collapse import collapse_lookups, collapse_overlaps, duplicate_keys, universe
from orestrata.operators.compare import keyed_diff, row_diff
from orestrata.operators.conform import Cast, Missing, Text, conform, from_json
from orestrata.operators.enrich import Link, enrich_dimension, lookup_table, with_versions
from orestrata.operators.quality import Rule, keep_valid, measure, quarantine
from orestrata.plans import orders_medallion
from orestrata.plans.exports import export_csv, export_summary
from orestrata.plans.medallion import acceptance, refresh, report
from orestrata.plans.tables import Tables, read_table
from orestrata.plans.twins import parity, sql_answer
from orestrata.session import delete_folder, scratch, staged
from orestrata.sources.contracts import FileContract, PageContract
from orestrata.sources.delimited import number_rows, read_delimited, require_headers, require_lines
from orestrata.sources.inventory import content_inventory
from orestrata.sources.json_pages import page_documents, parse_pages, require_pages
from orestrata.sources.links import listing_of
from orestrata.sources.records import active_records, latest_inventory, read_manifests, read_records
from orestrata.sources.snapshots import diff_inventory, ingest, snapshot_records, write_once

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- typing and quality --------------------------------------------------------------------------

EVENT_RULES = (Rule("key_in_range", "k BETWEEN 10 AND 89"), Rule("positive_value", "value > 1"))


def _typed_events(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    typed = conform(
        events,
        [Text("k_text", key="k"), Cast("k", of="k_text", to="int"), Missing("k_missing", of="k_text")],
        cell=from_json("props"),
        keep=["event_id", "event_type", "value"],
    )
    return typed.withColumn("value", F.col("value").try_cast("decimal(24,6)"))


@query(
    """SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              CAST(value AS DECIMAL(24,6)) AS value, json_extract_string(props, '$.k') IS NULL AS k_missing
       FROM events"""
)
def typed_props(spark, sf_dir):
    return _typed_events(spark, sf_dir).select("event_id", "event_type", "k", "value", "k_missing")


_EVENT_CHECK = """WITH typed AS (
  SELECT event_id, event_type, CAST(value AS DECIMAL(24,6)) AS value,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""


@query(_EVENT_CHECK + "SELECT event_id, event_type, k, value FROM typed WHERE NOT coalesce(k BETWEEN 10 AND 89 AND value > 1, FALSE)")
def quarantine_events(spark, sf_dir):
    return quarantine(_typed_events(spark, sf_dir), EVENT_RULES).select("event_id", "event_type", "k", "value")


@query(_EVENT_CHECK + "SELECT event_id, event_type, k, value FROM typed WHERE k BETWEEN 10 AND 89 AND value > 1")
def valid_events(spark, sf_dir):
    return keep_valid(_typed_events(spark, sf_dir), EVENT_RULES).select("event_id", "event_type", "k", "value")


@query(
    _EVENT_CHECK
    + """SELECT 'events' AS dataset, 'key_in_range' AS rule, 'fail' AS action, count(*) AS total,
                CAST(count_if(NOT coalesce(k BETWEEN 10 AND 89, FALSE)) AS BIGINT) AS failed FROM typed
         UNION ALL
         SELECT 'events', 'positive_value', 'fail', count(*),
                CAST(count_if(NOT coalesce(value > 1, FALSE)) AS BIGINT) FROM typed"""
)
def expectation_metrics(spark, sf_dir):
    return measure(_typed_events(spark, sf_dir), EVENT_RULES, "events")


# --- collapse ------------------------------------------------------------------------------------


def _collapsed_lines(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem").withColumn("value", F.col("l_quantity").cast("decimal(24,6)"))
    return collapse_overlaps(
        lines,
        ["l_orderkey", "l_linenumber"],
        "value",
        evidence={"flags": "l_returnflag", "statuses": "l_linestatus"},
    )


@query(
    """SELECT l_orderkey, l_linenumber, CAST(max(CAST(l_quantity AS DECIMAL(24,6))) AS DECIMAL(24,6)) AS value,
              count(DISTINCT CAST(l_quantity AS DECIMAL(24,6))) AS value_versions,
              array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS flags,
              array_to_string(list_sort(list(DISTINCT l_linestatus)), ',') AS statuses
       FROM lineitem GROUP BY l_orderkey, l_linenumber"""
)
def collapsed_lines(spark, sf_dir):
    out = _collapsed_lines(spark, sf_dir)
    return out.withColumn("flags", F.array_join("flags", ",")).withColumn("statuses", F.array_join("statuses", ","))


@query(
    """SELECT value_versions, count(*) AS n_keys FROM (
         SELECT count(DISTINCT CAST(l_quantity AS DECIMAL(24,6))) AS value_versions
         FROM lineitem GROUP BY l_orderkey, l_linenumber) GROUP BY value_versions"""
)
def conflict_profile(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem").withColumn("value", F.col("l_quantity").cast("decimal(24,6)"))
    return collapse_overlaps(lines, ["l_orderkey", "l_linenumber"], "value").groupBy("value_versions").agg(F.count(F.lit(1)).alias("n_keys"))


@query(
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(max(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(14,2)) AS price,
              count(DISTINCT CAST(o_totalprice AS DECIMAL(14,2))) AS price_versions
       FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', '') GROUP BY 1"""
)
def entity_collapse(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_orderstatus").isin("F", "")
    )
    rows = orders.select(F.year("o_orderdate").alias("year"), F.col("o_totalprice").cast("decimal(14,2)").alias("price"))
    return collapse_overlaps(rows, ["year"], "price", versions="price_versions", null_is_version=False)


@query(
    """SELECT p_brand, max(p_type) AS p_type, count(*) AS label_versions
       FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY p_brand"""
)
def lookup_collapse(spark, sf_dir):
    return collapse_lookups(_t(spark, sf_dir, "part"), ["p_brand"], "p_type")


LOOKUP_SOURCES = {"nation": ("n_key", "n_text"), "region": ("r_key", "r_text"), "brand": ("b_key", "b_text")}


def _lookup_records(spark, sf_dir):
    def fields(table, kind, code, label):
        code_key, label_key = LOOKUP_SOURCES[kind]
        cells = F.create_map(F.lit(code_key), F.col(code).cast("string"), F.lit(label_key), F.col(label))
        return _t(spark, sf_dir, table).select(F.lit(kind).alias("kind"), cells.alias("fields"))

    return (
        fields("nation", "nation", "n_nationkey", "n_name")
        .unionByName(fields("region", "region", "r_regionkey", "r_name"))
        .unionByName(fields("part", "brand", "p_brand", "p_type"))
    )


@query(
    """WITH entries AS (
         SELECT 'nation' AS kind, CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation
         UNION SELECT 'region', CAST(r_regionkey AS VARCHAR), r_name FROM region
         UNION SELECT 'brand', p_brand, p_type FROM part)
       SELECT kind, code, max(label) AS label, count(*) AS label_versions FROM entries GROUP BY kind, code"""
)
def lookup_kinds(spark, sf_dir):
    return lookup_table(_lookup_records(spark, sf_dir), LOOKUP_SOURCES)


@query("SELECT p_brand, p_type, count(*) OVER (PARTITION BY p_brand) AS versions FROM (SELECT DISTINCT p_brand, p_type FROM part)")
def dimension_versions(spark, sf_dir):
    return with_versions(_t(spark, sf_dir, "part").select("p_brand", "p_type"), "p_brand", "versions")


@query(
    """SELECT s_suppkey, s_name, n_name, r_name, CAST(1 AS BIGINT) AS nation_versions, CAST(1 AS BIGINT) AS region_versions,
              concat_ws(' | ', r_name, n_name, CASE WHEN s_acctbal < 0 THEN 'Balance: debit' END) AS supplier_label
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
)
def supplier_dimension(spark, sf_dir):
    records = staged(spark, lookup_table(_lookup_records(spark, sf_dir), LOOKUP_SOURCES), "lookups")
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    suppliers = (
        _t(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            "s_suppkey",
            "s_name",
            F.col("s_nationkey").cast("string").alias("nation_code"),
            F.col("n_regionkey").cast("string").alias("region_code"),
            F.when(F.col("s_acctbal") < 0, F.lit("debit")).otherwise(F.lit("-")).alias("balance"),
        )
    )
    label = joined_label(["r_name", "n_name"], suffix=prefixed_unless_missing("balance", "Balance: "))
    links = [Link("nation", "nation_code", "n_name"), Link("region", "region_code", "r_name")]
    return enrich_dimension(suppliers, records, links, label, "supplier_label").drop(
        "nation_code", "region_code", "balance"
    )


# --- answers -------------------------------------------------------------------------------------


@query(
    """SELECT count(*) AS year_count, CAST(min(year) AS INTEGER) AS start_year, CAST(max(year) AS INTEGER) AS end_year,
              round(avg(n), 6) AS mean_orders, round(stddev_pop(n), 6) AS stddev_orders, round(stddev_samp(n), 6) AS stddev_sample
       FROM (SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1) WHERE year BETWEEN 1996 AND 2000"""
)
def yearly_stats(spark, sf_dir):
    years = _t(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    out = period_stats(years, "year", "n", 1996, 2000, prefix="orders")
    rounded = {c: F.round(c, 6) for c in ("mean_orders", "stddev_orders", "stddev_sample")}
    return out.withColumns(rounded)


def _order_points(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("Q0"), F.quarter("o_orderdate")).alias("period"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("price"),
        "o_orderstatus",
        "o_orderpriority",
    )


def _customers(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"))


_BEST = """WITH yearly AS (
  SELECT o_custkey, year(o_orderdate) AS year, sum(CAST(o_totalprice AS DECIMAL(14,2))) AS total, count(*) AS n
  FROM orders WHERE {where} GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY total DESC, year) AS r FROM yearly),
ids AS (SELECT o_custkey AS custkey FROM orders UNION SELECT c_custkey FROM customer)
SELECT ids.custkey, c_name AS name, CAST(year AS INTEGER) AS best_year, CAST(total AS DECIMAL(24,2)) AS summed_price,
       n AS orders_counted, CASE WHEN year IS NULL THEN 'none' ELSE 'ok' END AS status
FROM ids LEFT JOIN customer ON c_custkey = ids.custkey LEFT JOIN ranked ON o_custkey = ids.custkey AND r = 1"""


def _best(facts, customers, periods):
    out = best_period(
        facts,
        customers,
        key="custkey",
        time="year",
        period="period",
        value="price",
        periods=periods,
        label="name",
        counted="orders_counted",
        empty_status="none",
    )
    return out.withColumn("summed_price", F.col("summed_price").cast("decimal(24,2)"))


@query(_BEST.format(where="TRUE"))
def best_year(spark, sf_dir):
    return _best(_order_points(spark, sf_dir), _customers(spark, sf_dir), ["Q01", "Q02", "Q03", "Q04"])


@query(_BEST.format(where="quarter(o_orderdate) = 1 AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"))
def best_year_universe(spark, sf_dir):
    points = _order_points(spark, sf_dir)
    scope = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    facts = points.withColumn("price", F.when(scope, F.col("price")))
    return _best(facts, _customers(spark, sf_dir), ["Q01"])


@query(
    """SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE lang = 'en'"""
)
def aligned_labels(spark, sf_dir):
    return align_left(
        _t(spark, sf_dir, "documents"),
        _t(spark, sf_dir, "labels"),
        "doc_id",
        F.col("lang") == "en",
        ["doc_id", "lang", "n_chars"],
        ["quality", "toxic"],
    )


@query(
    """SELECT user_id, event_id, ts, event_type FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"""
)
def latest_event(spark, sf_dir):
    events = _t(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


# --- sets and checks -------------------------------------------------------------------------------


@query("SELECT doc_id FROM documents UNION SELECT doc_id FROM labels")
def document_universe(spark, sf_dir):
    return universe("doc_id", _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_lines(spark, sf_dir):
    return duplicate_keys(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """WITH v AS (
         SELECT 'covered_years' AS "check", (SELECT count(DISTINCT year(o_orderdate)) FROM orders
            WHERE year(o_orderdate) BETWEEN 1996 AND 2000) AS observed, 5 AS expected
         UNION ALL SELECT 'repeated_order_keys',
            (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)), 0
         UNION ALL SELECT 'repeated_line_keys',
            (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), 0
         UNION ALL SELECT 'complete_universe', (SELECT count(*) FROM customer),
            (SELECT count(*) FROM (SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders))
         UNION ALL SELECT 'quarantined_orders', (SELECT count(*) FROM orders WHERE NOT coalesce(o_totalprice > 0, FALSE)), 0
         UNION ALL SELECT 'aligned_rows', (SELECT count(*) FROM documents LEFT JOIN labels USING (doc_id)),
            (SELECT count(*) FROM documents))
       SELECT "check", CAST(observed AS BIGINT) AS observed, CAST(expected AS BIGINT) AS expected, observed = expected AS passed FROM v"""
)
def acceptance_report(spark, sf_dir):
    def rows(df):
        return df.agg(F.count(F.lit(1)).alias("n"))

    orders, customer = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")
    documents, lineitem = _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "lineitem")
    year = F.year("o_orderdate").alias("year")
    covered = orders.select(year).filter(F.col("year").between(1996, 2000)).distinct()
    buyers = orders.select(F.col("o_custkey").alias("c_custkey"))
    aligned = documents.select("doc_id").join(_t(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left")
    return report(
        [
            ("covered_years", rows(covered), F.lit(5)),
            ("repeated_order_keys", rows(duplicate_keys(orders, ["o_orderkey"])), F.lit(0)),
            ("repeated_line_keys", rows(duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"])), F.lit(0)),
            ("complete_universe", rows(customer), rows(universe("c_custkey", customer, buyers))),
            ("quarantined_orders", rows(quarantine(orders, [Rule("price", "o_totalprice > 0")])), F.lit(0)),
            ("aligned_rows", rows(aligned), rows(documents)),
        ]
    )


@query(
    """SELECT coalesce(l.k, o.k) AS orderkey, coalesce(l.n, 0) - coalesce(o.n, 0) AS surplus
       FROM (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) l
       FULL JOIN (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1) o ON l.k = o.k
       WHERE coalesce(l.n, 0) <> coalesce(o.n, 0)"""
)
def line_surplus(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"))
    return row_diff(lines, _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey")))


@query(
    """WITH a AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS size FROM documents),
            b AS (SELECT doc_id, CAST(length(text) AS DOUBLE) + CASE WHEN quality = 1 THEN 1 ELSE 0 END AS size
                  FROM documents JOIN labels USING (doc_id))
       SELECT doc_id, CASE WHEN b.doc_id IS NULL THEN 'only_left' ELSE 'values' END AS problem
       FROM a LEFT JOIN b USING (doc_id) WHERE b.doc_id IS NULL OR a.size <> b.size"""
)
def keyed_differences(spark, sf_dir):
    documents, labels = _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels")
    stated = documents.select("doc_id", F.col("n_chars").cast("double").alias("size"))
    counted = documents.join(labels, "doc_id").select(
        "doc_id", (F.length("text") + F.when(F.col("quality") == 1, 1).otherwise(0)).cast("double").alias("size")
    )
    return keyed_diff(stated, counted, ["doc_id"])


# --- identities, inventories, snapshots --------------------------------------------------------------


@query(
    """SELECT doc_id, sha256(text) AS sha256,
              sha256(encode(source) || '\\x00'::BLOB || encode(text)) AS object_id FROM documents"""
)
def document_digests(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select(
        "doc_id", content_digest(F.col("text")).alias("sha256"), object_id(F.col("source"), F.col("text")).alias("object_id")
    )


@query(
    """WITH d AS (SELECT doc_id, source || '/' || sha256(text) AS key, sha256(text) AS digest FROM documents)
       SELECT DISTINCT key, digest FROM d WHERE key NOT IN (SELECT key FROM d JOIN labels USING (doc_id))"""
)
def unstored_documents(spark, sf_dir):
    digest = content_digest(F.col("text"))
    objects = _t(spark, sf_dir, "documents").select(
        "doc_id", F.concat("source", F.lit("/"), digest).alias("key"), digest.alias("digest")
    )
    stored = objects.join(_t(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    columns = ["key", "digest"]
    return write_once(objects.select(*columns), stored.select(*columns), "key", "digest")


@query(
    """WITH newer AS (SELECT 'documents/' || doc_id AS source_name, sha256(text) AS h FROM documents),
            older AS (SELECT 'documents/' || doc_id AS source_name,
                             sha256(CASE WHEN quality = 1 THEN text ELSE upper(text) END) AS h
                      FROM documents JOIN labels USING (doc_id)
                      UNION ALL SELECT 'benchmark/' || item_id, sha256(text) FROM benchmark)
       SELECT coalesce(n.source_name, o.source_name) AS source_name,
              CASE WHEN o.h IS NULL THEN 'added' WHEN n.h IS NULL THEN 'deleted'
                   WHEN o.h = n.h THEN 'unchanged' ELSE 'changed' END AS status
       FROM newer n FULL JOIN older o ON n.source_name = o.source_name"""
)
def inventory_diff(spark, sf_dir):
    def entry(folder, key, text):
        name = F.concat(F.lit(f"{folder}/"), F.col(key).cast("string")).alias("source_name")
        return name, content_digest(text).alias("sha256")

    documents = _t(spark, sf_dir, "documents")
    text = F.col("text")
    before = F.when(F.col("quality") == 1, text).otherwise(F.upper("text"))
    older = documents.join(_t(spark, sf_dir, "labels"), "doc_id").select(*entry("documents", "doc_id", before))
    older = older.unionByName(_t(spark, sf_dir, "benchmark").select(*entry("benchmark", "item_id", text)))
    return diff_inventory(older, documents.select(*entry("documents", "doc_id", text)))


@query(
    """WITH m AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents WHERE doc_id = (SELECT max(doc_id) FROM documents))
       SELECT doc_id, lang, CAST(i AS INTEGER) AS position, words[i] AS word
       FROM m JOIN documents USING (doc_id), range(1, len(words) + 1) t(i)"""
)
def newest_manifest(spark, sf_dir):
    words = F.transform(
        F.split("text", " ", -1), lambda w, i: F.struct((i + 1).alias("position"), w.alias("word"))
    )
    manifests = _t(spark, sf_dir, "documents").select("doc_id", "lang", words.alias("files"))
    return latest_inventory(manifests, order="doc_id", keep=["lang"])


@query(
    """SELECT DISTINCT 'run-' || (SELECT max(year(o_orderdate)) FROM orders) AS snapshot_id, 'orders/' || o_custkey AS source_name,
              sha256(CAST(o_custkey AS VARCHAR)) AS object_id
       FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)"""
)
def manifest_scan(spark, sf_dir):
    """A manifest per year, listing the customers with orders, through the JSON format."""
    folder = scratch(spark, "manifests")
    customer = F.col("o_custkey").cast("string")
    entry = F.struct(
        F.concat(F.lit("orders/"), customer).alias("source_name"),
        F.sha2(customer, 256).alias("object_id"),
        F.lit("orders").alias("kind"),
    )
    buyers = _t(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_custkey").distinct()
    # manifests are bounded here as well: a share of the customers per document
    share = F.pmod(F.xxhash64("o_custkey"), F.lit(1 << 20)).alias("share")
    manifests = buyers.groupBy("year", share).agg(F.collect_list(entry).alias("files"))
    manifests.select(
        F.concat(F.lit("run-"), F.col("year")).alias("snapshot_id"), F.lit("").alias("committed_at"), "files"
    ).write.json(folder)
    return latest_inventory(read_manifests(spark, folder)).select("snapshot_id", "source_name", "object_id")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')")
def active_lines(spark, sf_dir):
    open_orders = _t(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "O")
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return active_records(lines, open_orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
# Spark's first task writes a file even if it has no rows
ORDER_FILES = (FileContract("orders", r"part-.*\.csv", ORDER_COLUMNS, in_parts=True),)
_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice,
                    o_orderdate, o_orderpriority FROM orders"""


def _landed_orders(spark, sf_dir, numbered=False):
    """The order table as headed tab-separated files, padded as agencies pad them; ``numbered`` adds each row's place in
    its file."""
    folder = scratch(spark, "landing")
    orders = _t(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, " ").alias("O_ORDERKEY "),
        "o_custkey",
        "o_orderstatus",
        F.lpad(F.col("o_totalprice").cast("decimal(14,2)").cast("string"), 14, " ").alias("o_totalprice"),
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
        "o_orderpriority",
        F.lit("").alias("note"),
    )
    if numbered:
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
        orders = orders.select(*orders.columns[:-1], place.alias("nth"), "note")
    orders.write.option("header", "true").option("sep", "\t").option("ignoreLeadingWhiteSpace", "false").option(
        "ignoreTrailingWhiteSpace", "false"
    ).option("emptyValue", "").csv(folder)
    return folder


def _typed_orders(records):
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "decimal(14,2)", "o_orderdate": "timestamp_ntz"}
    spec = [Text(c) for c in ORDER_COLUMNS] + [Cast(c, of=c, to=kind) for c, kind in types.items()]
    return conform(records, spec)


@query(_ORDERS)
def delimited_orders(spark, sf_dir):
    folder = _landed_orders(spark, sf_dir)
    inventory = staged(spark, content_inventory(spark, folder), "inventory")
    read = read_delimited(spark, folder, inventory, ORDER_FILES)
    require_headers(read.headers)
    lines = staged(spark, read.lines, "lines")
    require_lines(lines)
    return _typed_orders(lines)


@query("SELECT o_orderkey, TRUE AS numbered FROM orders")
def numbered_orders(spark, sf_dir):
    """Each order with whether its row number is the one it was written with (the file's rows are sorted by number)."""
    folder = _landed_orders(spark, sf_dir, numbered=True)
    inventory = staged(spark, content_inventory(spark, folder), "inventory")
    files = (FileContract("orders", r"part-.*\.csv", (*ORDER_COLUMNS, "nth")),)
    lines = staged(spark, read_delimited(spark, folder, inventory, files).lines, "lines")
    require_lines(lines)
    rows = number_rows(lines)
    return rows.select(
        F.trim(F.col("fields")["o_orderkey"]).cast("bigint").alias("o_orderkey"),
        (F.col("fields")["nth"].cast("bigint") == F.col("row_number")).alias("numbered"),
    )


@query(_ORDERS)
def ingested_orders(spark, sf_dir):
    store = scratch(spark, "store")
    ingest(spark, _landed_orders(spark, sf_dir), store, ORDER_FILES)
    return _typed_orders(snapshot_records(spark, store))


def _land(orders, folder):
    orders.select(*ORDER_COLUMNS).withColumn("o_orderdate", F.col("o_orderdate").cast("string")).write.option(
        "header", "true"
    ).option("sep", "\t").mode("overwrite").csv(folder)


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(14,2)) +
              CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS DECIMAL(14,2)) AS o_totalprice, o_orderdate, o_orderpriority
       FROM orders WHERE o_orderstatus <> 'P'"""
)
def revised_orders(spark, sf_dir):
    """Two publications: closed orders stay, open ones are revised, pending ones are withdrawn."""
    landing, store = scratch(spark, "landing"), scratch(spark, "store")
    files = (FileContract("orders", r"part-.*\.csv", ORDER_COLUMNS, may_be_empty=True),)
    price = F.col("o_totalprice").cast("decimal(14,2)")
    orders = _t(spark, sf_dir, "orders").withColumn("o_totalprice", price)
    status = F.col("o_orderstatus")
    for name in ("F", "O", "P"):
        _land(orders.filter(status == name), f"{landing}/{name}")
    ingest(spark, landing, store, files)
    # overwriting replaces the files: new names are added, the old ones deleted
    _land(orders.filter(status == "O").withColumn("o_totalprice", price + 1), f"{landing}/O")
    _land(orders.limit(0), f"{landing}/P")
    ingest(spark, landing, store, files)
    return _typed_orders(snapshot_records(spark, store))


@query(
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || chr(10) || chr(10) || '"' || o_orderstatus || '"' || chr(9) || o_comment
              WHEN o_orderkey % 3 = 1 THEN o_comment ELSE o_orderpriority END AS note
       FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 'of ' || o_orderdate AS o_comment FROM orders)"""
)
def quoted_orders(spark, sf_dir):
    """Orders landed with notes that hold line breaks, blank lines, quotes and separators, taken in by one ingest."""
    landing, store = scratch(spark, "landing"), scratch(spark, "store")
    comment = F.concat(F.lit("of "), F.col("o_orderdate").cast("string"))
    broken = F.concat("o_orderpriority", F.lit('\n\n"'), "o_orderstatus", F.lit('"\t'), comment)
    note = F.when(F.col("o_orderkey") % 3 == 0, broken).when(F.col("o_orderkey") % 3 == 1, comment).otherwise(F.col("o_orderpriority"))
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", note.alias("note"))
    orders.write.option("header", "true").option("sep", "\t").option("escape", '"').csv(landing)
    files = (FileContract("orders", r"part-.*\.csv", ("o_orderkey", "o_custkey", "note"), in_parts=True),)
    ingest(spark, landing, store, files)
    types = {"o_orderkey": "bigint", "o_custkey": "bigint"}
    spec = [Text(c) for c in (*types, "note")] + [Cast(c, of=c, to=kind) for c, kind in types.items()]
    return conform(snapshot_records(spark, store), spec)


def _damage(spark, store):
    """Lose one part file of the store's records, and put another one there twice."""
    records = spark.read.parquet(f"{store}/records").select(F.col("_metadata.file_path").alias("path"), F.length("object_id"))
    lost, doubled = (r.path for r in records.groupBy("path").count().orderBy("path").limit(2).collect())
    folder = doubled.rsplit("/", 1)[0]
    spark.read.parquet(doubled).write.mode("append").parquet(folder)
    delete_folder(spark, lost)


@query(_ORDERS)
def repaired_orders(spark, sf_dir):
    """Orders taken in, a part of the store lost and another doubled, and taken in again: unchanged files, mended rows."""
    landing, store = scratch(spark, "landing"), scratch(spark, "store")
    orders = _t(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(14,2)"))
    _land(orders.repartition(6, "o_orderkey"), landing)
    ingest(spark, landing, store, ORDER_FILES)
    _damage(spark, store)
    again = ingest(spark, landing, store, ORDER_FILES)
    if again.changed or not again.repaired:
        raise AssertionError("the damage went unnoticed")
    return _typed_orders(snapshot_records(spark, store))


ORDER_PAGES = PageContract(
    "orders",
    r".*",
    required=("Key", "Customer", "Price"),
    columns=(("o_orderkey", ("Key",)), ("o_custkey", ("Buyer", "Customer")), ("o_totalprice", ("Price",)), ("channel", ("Channel",))),
    defaults=(("channel", ""),),
)


@query(
    """SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice, '' AS channel FROM orders"""
)
def paged_orders(spark, sf_dir):
    folder = scratch(spark, "pages")
    row = F.struct(
        F.col("o_orderkey").alias("Key"),
        F.col("o_custkey").alias("Customer"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("Price"),
    )
    # rows are dealt to pages by a number no two of them share, so a page holds at most 500 whatever the keys
    dealt = _t(spark, sf_dir, "orders").withColumn("_page", F.floor(F.monotonically_increasing_id() / 500))
    pages = dealt.groupBy("_page").agg(F.collect_list(row).alias("data"))
    total = F.struct(F.size("data").cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("offset"))
    pages.select(total.alias("page"), "data").write.json(folder)
    read = parse_pages(page_documents(spark, folder, per_line=True), ORDER_PAGES)
    require_pages(read.pages)
    spec = [
        Text("o_orderkey"),
        Text("o_custkey"),
        Text("o_totalprice"),
        Text("channel"),
        Cast("o_orderkey", of="o_orderkey", to="bigint"),
        Cast("o_custkey", of="o_custkey", to="bigint"),
        Cast("o_totalprice", of="o_totalprice", to="decimal(14,2)"),
    ]
    return conform(read.rows, spec)


@query(
    """SELECT 'orders' AS kind, o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice FROM orders
       UNION ALL SELECT 'paged', o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(14,2)) FROM orders"""
)
def ingested_pages(spark, sf_dir):
    """Orders landed as delimited files and as JSON pages, taken in by one ingest."""
    landing, store = scratch(spark, "landing"), scratch(spark, "store")
    orders = _t(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(14,2)"))
    _land(orders, f"{landing}/lines")
    row = F.struct(
        F.col("o_orderkey").alias("Key"), F.col("o_custkey").alias("Customer"), F.col("o_totalprice").alias("Price")
    )
    # a page per file: as many rows as the rows' running number puts together
    dealt = orders.withColumn("_page", F.floor(F.monotonically_increasing_id() / 20_000))
    pages = dealt.groupBy("_page").agg(F.collect_list(row).alias("data"))
    total = F.struct(F.size("data").cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("offset"))
    pages.select("_page", total.alias("page"), "data").write.option("maxRecordsPerFile", 1).json(f"{landing}/pages")
    paged = PageContract("paged", r"part-.*\.json", ORDER_PAGES.required, ORDER_PAGES.columns, ORDER_PAGES.defaults, in_parts=True)
    ingest(spark, landing, store, ORDER_FILES, (paged,))
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "decimal(14,2)"}
    spec = [Text(c) for c in types] + [Cast(c, of=c, to=kind) for c, kind in types.items()]
    return conform(snapshot_records(spark, store), spec, keep=["kind"])


@query(
    """SELECT 'large' AS kind, o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice,
              CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || '}]"' END AS remark,
              row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey, o_custkey, o_totalprice) AS row_number FROM orders"""
)
def split_orders(spark, sf_dir):
    """All orders of a status in one JSON document, with nested cells, taken in by an ingest that reads documents in splits."""
    landing, store = scratch(spark, "landing"), scratch(spark, "store")
    orders = _t(spark, sf_dir, "orders")
    note = F.struct(F.concat("o_orderpriority", F.lit('}]"')).alias("remark"), F.array(F.lit("{")).alias("tags"))
    element = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("Key"),
            F.col("o_custkey").alias("Customer"),
            F.when(F.col("o_orderkey") % 3 == 0, note).alias("Note"),
            F.col("o_totalprice").cast("decimal(14,2)").alias("Price"),
        )
    )
    listed = Window.partitionBy("o_orderstatus").orderBy("o_orderkey", "o_custkey", "o_totalprice")
    place, is_last = F.row_number().over(listed), F.lead(F.lit(False), 1, True).over(listed)
    end = F.concat(F.lit('], "page": {"offset": 0, "total": '), F.col("place"), F.lit("}}"))
    line = F.concat(
        F.when(F.col("place") == 1, F.lit('{"data": [')).otherwise(F.lit(", ")), "element", F.when(F.col("is_last"), end).otherwise(F.lit(""))
    )
    # the windows leave each status in one task and in order
    lines = orders.select("o_orderstatus", place.alias("place"), is_last.alias("is_last"), element.alias("element"))
    lines.select("o_orderstatus", line).write.partitionBy("o_orderstatus").text(landing)
    columns = (*ORDER_PAGES.columns, ("note", ("Note",)))
    contract = PageContract("large", r"part-.*\.txt", ORDER_PAGES.required, columns, (*ORDER_PAGES.defaults, ("note", None)), in_splits=True)
    ingest(spark, landing, store, (), (contract,))
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "decimal(14,2)"}
    spec = [Text(c) for c in (*types, "note")] + [Cast(c, of=c, to=kind) for c, kind in types.items()]
    read = conform(snapshot_records(spark, store), spec, keep=["kind", "row_number"])
    return read.withColumn("remark", F.get_json_object("note", "$.remark")).drop("note")


@query("SELECT 'orders/' || o_custkey AS source_name, CAST(o_orderkey AS VARCHAR) AS okey, o_orderstatus AS status, o_orderkey AS row_number FROM orders")
def record_scan(spark, sf_dir):
    folder = scratch(spark, "records")
    name = F.concat(F.lit("orders/"), F.col("o_custkey").cast("string"))
    _t(spark, sf_dir, "orders").select(
        F.sha2(name, 256).alias("object_id"),
        name.alias("source_name"),
        F.lit("orders").alias("kind"),
        F.col("o_orderkey").alias("row_number"),
        F.create_map(F.lit("okey"), F.col("o_orderkey").cast("string"), F.lit("status"), F.col("o_orderstatus")).alias("fields"),
    ).write.json(folder)
    records = read_records(spark, folder)
    return conform(records, [Text("okey"), Text("status")], keep=["source_name", "row_number"])


@query(
    """WITH parts AS (
         SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS origin,
                unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
       SELECT *, CAST(row_number() OVER (PARTITION BY page_id ORDER BY name) AS INTEGER) AS place FROM (
       SELECT DISTINCT page_id, substr(href, 2) AS name, origin || href AS url FROM parts
       WHERE href LIKE '/%' AND substr(href, 2) <> '' AND substr(href, 2) NOT LIKE '%/%' AND substr(href, 2) NOT LIKE '.%'
         AND href NOT LIKE '%?%' AND href NOT LIKE '%#%' AND href NOT LIKE '%\\%')"""
)
def discovered_links(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    return listing_of(pages, origin(F.col("url")), "page_id")


# --- exports and the whole graph ---------------------------------------------------------------------


@query(_BEST.format(where="TRUE"))
def exported_best_year(spark, sf_dir):
    answer = best_year(spark, sf_dir)
    folder = scratch(spark, "csv")
    export_csv(answer, folder, ["custkey"])
    return spark.read.schema(answer.schema).option("header", "true").csv(folder)


@query(
    """SELECT c_custkey, c_nationkey, c_mktsegment, row_number() OVER (ORDER BY c_mktsegment DESC, c_nationkey, c_custkey) AS row_number FROM customer
       WHERE c_custkey IS NOT NULL AND c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL"""
)
def exported_order(spark, sf_dir):
    """Customers exported in order, and each row's place over all files of the export, by their names."""
    folder = f"{scratch(spark, 'export')}/customers"
    kept = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").na.drop()
    # the exchange cuts ranges by the key; one file for each
    export_csv(kept, folder, [F.desc("c_mktsegment"), "c_nationkey", "c_custkey"])
    rows = spark.read.option("header", "true").schema("c_custkey BIGINT, c_nationkey BIGINT, c_mktsegment STRING").csv(folder)
    at = F.concat("_metadata.file_name", F.lit("/"), F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"))
    placed = rows.select(
        "c_custkey", F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_mktsegment",
        F.lit("customers").alias("export"), at.alias("block"), F.monotonically_increasing_id().alias("seq"),
    )
    return number_rows(staged(spark, placed, "export"), "export").drop("export")


@query(
    """SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS lineitem,
              (SELECT count(*) FROM documents) AS documents, 'tables' AS scope"""
)
def run_summary(spark, sf_dir):
    folder = scratch(spark, "summary")
    export_summary([(n, _t(spark, sf_dir, n)) for n in ("orders", "lineitem", "documents")], {"scope": "tables"}, folder)
    return spark.read.schema("orders BIGINT, lineitem BIGINT, documents BIGINT, scope STRING").json(folder)


_MEDALLION_BEST = """WITH yearly AS (
  SELECT o_custkey, year(o_orderdate) AS year, sum(CAST(o_totalprice AS DECIMAL(14,2))) AS total,
         count(DISTINCT quarter(o_orderdate)) AS n FROM orders GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY total DESC, year) AS r FROM yearly)
SELECT CAST(c_custkey AS VARCHAR) AS series_id,
       concat_ws(' | ', n_name, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'Credit since: 1995' END) AS series_label,
       CAST(year AS INTEGER) AS best_year, CAST(total AS DECIMAL(24,2)) AS summed_value, n AS quarters_available,
       CASE WHEN year IS NULL THEN 'no_quarterly_observations' ELSE 'ok' END AS status
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN ranked ON o_custkey = c_custkey AND r = 1"""


def _order_release(spark, sf_dir):
    out = scratch(spark, "medallion")
    refresh(spark, orders_medallion.order_records(spark, sf_dir), orders_medallion.SPEC, out)
    return out


def _rounded_value(df):
    return df.withColumn("summed_value", F.col("summed_value").cast("decimal(24,2)"))


@query(_MEDALLION_BEST)
def medallion(spark, sf_dir):
    return _rounded_value(read_table(spark, _order_release(spark, sf_dir), "gold_best_year"))


@query(_MEDALLION_BEST)
def best_year_sql(spark, sf_dir):
    Tables(spark, _order_release(spark, sf_dir)).register(["silver_observations", "silver_population", "silver_series"])
    return _rounded_value(sql_answer(spark, "gold_best_year", orders_medallion.SPEC))


@query(
    """SELECT 'gold_best_year' AS answer, 'compared' AS measure, (SELECT count(*) FROM customer) AS n
       UNION ALL SELECT 'gold_best_year', 'different', 0
       UNION ALL SELECT 'gold_population_stats', 'compared', 1 UNION ALL SELECT 'gold_population_stats', 'different', 0
       UNION ALL SELECT 'gold_series_population', 'compared',
         (SELECT count(DISTINCT year(o_orderdate)) FROM orders WHERE o_custkey = 1 AND quarter(o_orderdate) = 1)
       UNION ALL SELECT 'gold_series_population', 'different', 0"""
)
def answer_parity(spark, sf_dir):
    tables = Tables(spark, _order_release(spark, sf_dir))
    tables.register(["silver_observations", "silver_population", "silver_series"])
    lines = None
    for name in ("gold_best_year", "gold_population_stats", "gold_series_population"):
        stored = tables.read(name)
        for measure_name, df in (("compared", stored), ("different", parity(spark, name, orders_medallion.SPEC, stored))):
            line = df.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(name).alias("answer"), F.lit(measure_name).alias("measure"), "n"
            )
            lines = line if lines is None else lines.unionByName(line)
    return lines


@query(
    """SELECT *, TRUE AS passed FROM (VALUES
         ('aligned_rows', (SELECT count(DISTINCT year(o_orderdate)) FROM orders WHERE o_custkey = 1 AND quarter(o_orderdate) = 1)),
         ('complete_universe', (SELECT count(*) FROM customer)), ('covered_years', 5), ('quarantined_observations', 0),
         ('quarantined_population', 0), ('repeated_observation_keys', 0), ('repeated_population_keys', 0)) v("check", observed)"""
)
def medallion_acceptance(spark, sf_dir):
    tables = Tables(spark, _order_release(spark, sf_dir))
    return acceptance(tables, orders_medallion.SPEC).select("check", "observed", "passed")


@query(
    """SELECT count(*) AS year_count, CAST(min(year) AS INTEGER) AS start_year, CAST(max(year) AS INTEGER) AS end_year,
              round(avg(n), 6) AS mean_population, round(stddev_pop(n), 6) AS stddev_population, round(stddev_samp(n), 6) AS stddev_sample
       FROM (SELECT year, count(*) AS n FROM (
               SELECT DISTINCT year(o_orderdate) AS year, o_orderkey, row_number() OVER () AS r FROM orders) GROUP BY year)
       WHERE year BETWEEN 1996 AND 2000"""
)
def gold_statistics(spark, sf_dir):
    stats = read_table(spark, _order_release(spark, sf_dir), "gold_population_stats")
    return stats.withColumns({c: F.round(c, 6) for c in ("mean_population", "stddev_population", "stddev_sample")})


@query(
    """SELECT '1' AS series_id, CAST(year AS INTEGER) AS year, 'Q01' AS period, CAST(value AS DECIMAL(24,6)) AS value, population
       FROM (SELECT year(o_orderdate) AS year, sum(CAST(o_totalprice AS DECIMAL(14,2))) AS value FROM orders
             WHERE o_custkey = 1 AND quarter(o_orderdate) = 1 GROUP BY 1)
       LEFT JOIN (SELECT year(o_orderdate) AS year, count(*) AS population FROM orders GROUP BY 1) USING (year)"""
)
def gold_alignment(spark, sf_dir):
    return read_table(spark, _order_release(spark, sf_dir), "gold_series_population")


_DAMAGED = """WITH sales AS (
  SELECT o_custkey AS s, year(o_orderdate) AS y, 'Q0' || quarter(o_orderdate) AS p, CAST(o_totalprice AS DECIMAL(14,2)) AS v FROM orders),
quarterly AS (SELECT s, y, p, sum(v) AS v FROM sales GROUP BY ALL),
points AS (SELECT * FROM quarterly UNION ALL SELECT s, y, 'Q05', sum(v) FROM quarterly GROUP BY s, y),
sourced AS (SELECT *, 'orders.1.All' AS source FROM points UNION ALL SELECT *, 'orders.0.Current' FROM points WHERE y >= 1999),
typed AS (
  SELECT source, s || CASE WHEN s % 10 = 5 AND p = 'Q04' THEN 'X' ELSE '' END AS series_id,
         CAST(CASE WHEN s % 10 = 4 AND y = 1997 THEN 19970 ELSE y END AS INTEGER) AS year,
         CASE WHEN s % 10 = 3 AND p = 'Q03' THEN 'Q13' ELSE p END AS period,
         CASE WHEN s % 10 = 1 AND p = 'Q02' THEN NULL WHEN s % 10 = 2 AND source = 'orders.0.Current' THEN v + 1 ELSE v END AS value
  FROM sourced),
judged AS (
  SELECT *, NOT regexp_full_match(series_id, '[0-9]+') AS b1, NOT year BETWEEN 1900 AND 2200 AS b2,
         period NOT IN ('Q01', 'Q02', 'Q03', 'Q04', 'Q05') AS b3, value IS NULL AS b4 FROM typed),
valid AS (SELECT * FROM judged WHERE NOT (b1 OR b2 OR b3 OR b4)),
silver AS (SELECT series_id, year, period, max(value) AS value, count(DISTINCT value) AS versions FROM valid GROUP BY ALL),
population AS (SELECT y AS year, count(*) AS n FROM sales GROUP BY y),
dimension AS (
  SELECT DISTINCT c_custkey || CASE WHEN c_custkey % 10 = 9 THEN 'S' ELSE '' END AS id, CASE WHEN c_custkey % 10 = 8 THEN -1 ELSE c_nationkey END AS nation,
         c_mktsegment, (CASE WHEN again = 1 THEN -c_acctbal ELSE c_acctbal END) < 0 AS owes
  FROM (SELECT *, unnest(CASE WHEN c_custkey % 10 = 6 THEN [0, 1] WHEN c_custkey % 10 = 7 THEN [] ELSE [0] END) AS again FROM customer)),
described AS (SELECT *, count(*) OVER (PARTITION BY id) AS versions FROM dimension)
"""


def _damaged_release(spark, sf_dir):
    out = scratch(spark, "medallion")
    records = orders_medallion.order_records(spark, sf_dir, damaged=True)
    # a manifest that names no object for every fifth entry
    entry = F.col("n_nationkey")
    manifest = _t(spark, sf_dir, "nation").select(
        F.lit("run").alias("snapshot_id"), F.when(entry % 5 != 0, F.sha2(entry.cast("string"), 256)).alias("object_id")
    )
    refresh(spark, records, orders_medallion.SPEC, out, manifest, enforced=False)
    return out


@query(
    _DAMAGED
    + """SELECT source AS source_name, series_id, year, period, CAST(value AS DECIMAL(24,6)) AS value,
                concat_ws(',', CASE WHEN b1 THEN 'series_key' END, CASE WHEN b2 THEN 'year_in_range' END,
                          CASE WHEN b3 THEN 'known_period' END, CASE WHEN b4 THEN 'value_or_marker' END) AS broken_rules
         FROM judged WHERE b1 OR b2 OR b3 OR b4"""
)
def quarantined_observations(spark, sf_dir):
    bad = read_table(spark, _damaged_release(spark, sf_dir), "quarantine_observations")
    return bad.select("source_name", "series_id", "year", "period", "value", F.array_join("broken_rules", ",").alias("broken_rules"))


@query(
    _DAMAGED
    + """, bad_population AS (
  SELECT count(*) + count_if(year = 1998) AS n, count_if(year = 1997) AS bad, count_if(year = 1998) AS twice FROM population),
ids AS (SELECT id FROM described UNION SELECT series_id FROM silver),
counted AS (
  SELECT 'typed_observations' AS dataset, 'drop' AS action, count(*) AS total,
         {'series_key': count_if(b1), 'year_in_range': count_if(b2), 'known_period': count_if(b3), 'value_or_marker': count_if(b4)} AS f FROM judged),
lines AS (
  SELECT dataset, action, total, unnest(map_entries(MAP {
    'series_key': f.series_key, 'year_in_range': f.year_in_range, 'known_period': f.known_period, 'value_or_marker': f.value_or_marker})) AS e FROM counted)
SELECT dataset, e.key AS rule, action, total, CAST(e.value AS BIGINT) AS failed FROM lines
UNION ALL SELECT 'typed_population', rule, 'drop', n, CASE WHEN rule = 'whole_number' THEN CAST(bad AS BIGINT) ELSE 0 END
  FROM bad_population, (VALUES ('nation_named'), ('year_in_range'), ('people_counted'), ('whole_number')) r(rule)
UNION ALL SELECT 'silver_observations', 'non_null_keys', 'fail', count(*), 0 FROM silver
UNION ALL SELECT 'silver_observations', 'consistent_overlap', 'fail', count(*), CAST(count_if(versions <> 1) AS BIGINT) FROM silver
UNION ALL SELECT 'silver_population', rule, 'fail', n - bad - twice, CASE WHEN rule = 'consistent_population' THEN CAST(twice AS BIGINT) ELSE 0 END
  FROM bad_population, (VALUES ('population_keys'), ('consistent_population')) r(rule)
UNION ALL SELECT 'silver_series', 'series_keys', 'fail', count(*), CAST(count_if(NOT regexp_full_match(id, '[0-9]+')) AS BIGINT) FROM described
UNION ALL SELECT 'silver_series', 'unique_series', 'fail', count(*), CAST(count_if(versions <> 1) AS BIGINT) FROM described
UNION ALL SELECT 'silver_series', 'complete_labels', 'fail', count(*), CAST(count_if(nation = -1) AS BIGINT) FROM described
UNION ALL SELECT 'silver_series', 'unique_lookups', 'fail', count(*), CAST(count_if(nation IN (-1, 3)) AS BIGINT) FROM described
UNION ALL SELECT 'gold_population_stats', 'full_coverage', 'fail', 1, CAST(count(*) <> 5 AS BIGINT)
  FROM population WHERE year BETWEEN 1996 AND 2000 AND year <> 1997
UNION ALL SELECT 'gold_best_year', 'human_readable_series', 'fail', count(*), CAST(count_if(id NOT IN (SELECT id FROM described)) AS BIGINT)
  FROM (SELECT ids.id FROM ids LEFT JOIN described USING (id))
UNION ALL SELECT 'bronze_records', 'record_envelope', 'fail',
  (SELECT count(*) FROM sourced) + (SELECT count(*) FROM customer) + (SELECT count_if(c_custkey % 10 = 6) - count_if(c_custkey % 10 = 7) FROM customer)
  + (SELECT count(*) + count_if(n_nationkey = 3) FROM nation) + (SELECT count(DISTINCT c_mktsegment) FROM customer) + (SELECT n FROM bad_population),
  (SELECT CAST(count_if(n_nationkey % 7 = 0) AS BIGINT) FROM nation)
UNION ALL SELECT 'bronze_manifest', 'manifest_keys', 'fail', count(*), CAST(count_if(n_nationkey % 5 = 0) AS BIGINT) FROM nation"""
)
def medallion_metrics(spark, sf_dir):
    """Every rule over records with damaged cells: how many rows it saw and how many broke it."""
    return read_table(spark, _damaged_release(spark, sf_dir), "quality_metrics")
