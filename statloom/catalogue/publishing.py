"""Queries that write and read back: parquet, CSV, external tables, keyed tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.catalogue.common import Query, r, rounded, table
from statloom.operators.features import vectors_from_array
from statloom.session import scratch_path
from statloom.sinks.external import publish_csv, use_database
from statloom.sinks.files import save_csv, save_parquet
from statloom.sinks.keyed import (change_keyed, create_keyed, delete, drop_table, find_keyed, insert, merge_keyed, read_keyed, update,
                                  upsert)
from statloom.sources.tables import read_csv, read_parquet, zipped


def _name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:12]}"


def _parquet(spark, folder):
    path = scratch_path(spark, "orders")
    save_parquet(table(spark, folder, "orders"), path, ["o_orderkey"])
    return read_parquet(spark, path)


def _csv(spark, folder):
    """A result table as one CSV file with a header."""
    per = (table(spark, folder, "customer", "c_mktsegment", "c_acctbal").groupBy("c_mktsegment")
           .agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("c_acctbal"), 6).alias("balance")))
    path = scratch_path(spark, "segments")
    save_csv(per, path, files=1)
    return read_csv(spark, path, per.schema)


def _external(spark, folder):
    database = "statloom_publish"
    use_database(spark, database, location=scratch_path(spark, database))
    return publish_csv(table(spark, folder, "customer"), f"{database}.{_name('customer')}",
                       scratch_path(spark, "customer"))


def _published(name, *columns):
    def run(spark, folder):
        """Free text with line breaks through an external text table."""
        return publish_csv(table(spark, folder, name, *columns), _name(name), scratch_path(spark, name))
    return run


def _csv_text(spark, folder):
    """Text files of documents and of hard values made from them: empty, null, quotes, both line breaks, backslashes."""
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    hard = docs.select("doc_id", F.element_at(F.array(*[F.lit(x) for x in HARD]), (F.col("doc_id") % len(HARD) + 1).cast("int"))
                       .alias("text"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("lang"))
    path = scratch_path(spark, "texts")
    both = docs.unionByName(hard)
    save_csv(both, path)
    return read_csv(spark, path, both.schema)


def _external_plain(spark, folder):
    """Array, vector and reserved columns stay behind."""
    df = vectors_from_array(table(spark, folder, "embeddings"), "embedding").withColumn("location", F.lit("here"))
    return publish_csv(df, _name("embeddings"), scratch_path(spark, "embeddings"), reserved=["location"])


def _all_customers(spark, folder):
    return table(spark, folder, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")


HARD = ["", " x ", '"', 'a "b", c', "line\r\nbreak", "\r", "\n", "\\", "\\N", "\\n", "\\s\\", ",", "'", "tab\t"]
KEPT = ["c_custkey", "c_name", "c_acctbal"]


def _customers(spark, folder):
    return _all_customers(spark, folder).select(*KEPT)


def _changes(spark, folder):
    """One market segment changed twice (the larger balance counts), and another one copied under new keys."""
    segment = F.col("c_mktsegment")
    customers = _all_customers(spark, folder)
    changed = customers.filter(segment == "BUILDING").select(*KEPT)
    more = changed.withColumn("c_acctbal", F.expr("c_acctbal + 500"))
    return changed.unionByName(more).unionByName(_new(customers.filter(segment == "MACHINERY")))


def _new(customers):
    return customers.select(*KEPT).withColumn("c_custkey", F.expr("c_custkey + 100000000000"))


def _upsert(spark, folder):
    return rounded(upsert(_customers(spark, folder), _changes(spark, folder), ["c_custkey"], ["c_acctbal"]),
                   {"c_acctbal": 2})


def _update(spark, folder):
    return rounded(update(_customers(spark, folder), _changes(spark, folder), ["c_custkey"], ["c_acctbal"]),
                   {"c_acctbal": 2})


def _insert(spark, folder):
    return insert(_customers(spark, folder), _new(_all_customers(spark, folder)), ["c_custkey"])


def _delete(spark, folder):
    return delete(_customers(spark, folder), _changes(spark, folder), ["c_custkey"])


def _stored(spark, folder):
    """The four changes in a row on a stored table."""
    name = _name("keyed")
    drop_table(spark, name)
    create_keyed(_customers(spark, folder), name, ["c_custkey"], scratch_path(spark, name), buckets=8)
    customers, nation = _all_customers(spark, folder), F.col("c_nationkey")
    change_keyed(spark, name, _changes(spark, folder), "upsert", ["c_acctbal"])
    change_keyed(spark, name, customers.filter(nation < 12), "delete")
    change_keyed(spark, name, customers.filter(nation < 5).select(*KEPT), "insert")
    change_keyed(spark, name, customers.filter(nation < 8).select(*KEPT).withColumn("c_acctbal", F.lit(1.0)), "update")
    return rounded(read_keyed(spark, name), {"c_acctbal": 2})


def _orders(spark, folder):
    return table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


def _lookup(spark, folder):
    """Rows of a table of 64 buckets by key: those of listed keys, and those that line items ask for."""
    name, orders = _name("lookup"), _orders(spark, folder)
    create_keyed(orders, name, ["o_orderkey"], scratch_path(spark, name), buckets=64)
    listed = [r[0] for r in orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).select(F.explode(F.array("min(o_orderkey)", "max(o_orderkey)"))).collect()]
    asked = table(spark, folder, "lineitem", "l_orderkey", "l_quantity").where("l_quantity = 50").withColumnRenamed("l_orderkey", "o_orderkey")
    return (read_keyed(spark, name, {"o_orderkey": [*listed, -1]}).withColumn("by", F.lit("listed"))
            .unionByName(find_keyed(spark, name, asked).withColumn("by", F.lit("asked"))))


def _delta(spark, folder):
    """Small changes beside the stored rows, before and after they are merged into them, and the table as it was at first."""
    name, orders = _name("delta"), _orders(spark, folder)
    create_keyed(orders, name, ["o_orderkey"], scratch_path(spark, name), buckets=16)
    dear = orders.where("o_totalprice > 400000")
    change_keyed(spark, name, dear.withColumn("o_orderstatus", F.lit("dear")), merge=False)
    change_keyed(spark, name, dear.where("o_custkey % 2 = 0").withColumn("o_orderstatus", F.lit("even")), "update", merge=False)
    change_keyed(spark, name, dear.where("o_custkey % 3 = 0"), "delete", merge=False)
    change_keyed(spark, name, dear.where("o_custkey % 6 = 0").withColumn("o_orderstatus", F.lit("back")), "insert", merge=False)
    before = read_keyed(spark, name)
    merge_keyed(spark, name, ratio=0)
    states = (("first", read_keyed(spark, name, version=1)), ("before", before), ("after", read_keyed(spark, name)))
    return reduce(DataFrame.unionByName, [df.withColumn("state", F.lit(s)) for s, df in states])


def _dropped(spark, folder):
    """A keyed table before and after it is dropped, with what the drop says, and what is left of its database."""
    name, path = _name("dropped"), scratch_path(spark, "dropped")
    create_keyed(_customers(spark, folder), name, ["c_custkey"], path)
    rows = read_keyed(spark, name).count()
    told = (drop_table(spark, name, purge=True), drop_table(spark, name))
    listed = use_database(spark, "statloom_listed", location=scratch_path(spark, "listed"))
    return (table(spark, folder, "customer").limit(1)
            .select(F.lit(rows).cast("long").alias("rows"), F.lit(told[0]).alias("first"), F.lit(told[1]).alias("second"),
                    F.lit(spark.catalog.tableExists(name)).alias("exists"),
                    F.lit("statloom_listed" in listed and "default" in listed).alias("listed")))


def _zipped(spark, folder):
    """Column names and their means: two lists on the driver made a table."""
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    found = table(spark, folder, "lineitem", *names).agg(*[F.round(F.avg(c), 6).alias(c) for c in names]).head()
    return zipped(spark, names, [found[c] for c in names], "name string, mean double")


# -- SQL -------------------------------------------------------------------------------------------------------

_CHANGED = """(SELECT c_custkey, c_name, c_acctbal + 500 AS c_acctbal, c_nationkey FROM customer
                WHERE c_mktsegment = 'BUILDING')"""
_COPIED = """(SELECT c_custkey + 100000000000 AS c_custkey, c_name, c_acctbal, c_mktsegment FROM customer)"""
_NEW = f"(SELECT c_custkey, c_name, c_acctbal FROM {_COPIED} WHERE c_mktsegment = 'MACHINERY')"
_KEPT = "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'"
_BALANCE = r("c_acctbal", 2, "c_acctbal")

_HARD = "[" + ", ".join(" || ".join(["''"] + [f"chr({ord(c)})" for c in x]) for x in HARD) + "]"

QUERIES: dict[str, Query] = {
    "parquet_roundtrip": (_parquet, "SELECT * FROM orders"),
    "csv_one_file": (_csv, """SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS rows, round(avg(c_acctbal), 6) AS balance
                              FROM customer GROUP BY c_mktsegment"""),
    "csv_external_roundtrip": (_external, "SELECT * FROM customer"),
    "csv_documents": (_published("documents"), "SELECT * FROM documents"),
    "csv_pages": (_published("pages"), "SELECT * FROM pages"),
    "csv_text": (_csv_text, f"""SELECT doc_id, text, lang FROM documents UNION ALL
        SELECT doc_id, {_HARD}[doc_id % {len(HARD)} + 1], CASE WHEN doc_id % 2 = 0 THEN lang END FROM documents"""),
    "csv_external_plain": (_external_plain, "SELECT vec_id, label FROM embeddings"),
    "keyed_upsert": (_upsert, f"""SELECT c_custkey, c_name, {_BALANCE} FROM ({_KEPT} UNION ALL SELECT * EXCLUDE
                                  c_nationkey FROM {_CHANGED} UNION ALL SELECT * FROM {_NEW})"""),
    "keyed_update": (_update, f"""SELECT c_custkey, c_name, {_BALANCE} FROM
                                  ({_KEPT} UNION ALL SELECT * EXCLUDE c_nationkey FROM {_CHANGED})"""),
    "keyed_insert": (_insert, f"""SELECT c_custkey, c_name, c_acctbal FROM customer
                                  UNION ALL SELECT c_custkey, c_name, c_acctbal FROM {_COPIED}"""),
    "keyed_delete": (_delete, _KEPT),
    "keyed_stored": (_stored, f"""SELECT c_custkey, c_name, {_BALANCE} FROM (
        {_KEPT} AND c_nationkey >= 12
        UNION ALL SELECT * EXCLUDE c_nationkey FROM {_CHANGED} WHERE c_nationkey >= 12
        UNION ALL SELECT c_custkey, c_name, 1.0 FROM customer WHERE c_nationkey < 5
        UNION ALL SELECT * FROM {_NEW})"""),
    "keyed_lookup": (_lookup, """
        WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders)
        SELECT *, 'listed' AS by FROM o WHERE o_orderkey IN (SELECT min(o_orderkey) FROM o UNION ALL SELECT max(o_orderkey) FROM o)
        UNION ALL SELECT *, 'asked' FROM o WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)"""),
    "keyed_delta": (_delta, """
        WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders),
        changed AS (
          SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_totalprice <= 400000 THEN o_orderstatus
            WHEN o_custkey % 6 = 0 THEN 'back' WHEN o_custkey % 2 = 0 THEN 'even' ELSE 'dear' END AS o_orderstatus
          FROM o WHERE o_totalprice <= 400000 OR o_custkey % 3 <> 0 OR o_custkey % 6 = 0)
        SELECT *, 'first' AS state FROM o UNION ALL SELECT *, 'before' FROM changed UNION ALL SELECT *, 'after' FROM changed"""),
    "keyed_drop": (_dropped, """SELECT CAST(count(*) AS BIGINT) AS rows, true AS first, false AS second, false AS exists,
                                       true AS listed FROM customer"""),
    "zipped_lists": (_zipped, " UNION ALL ".join(
        f"SELECT '{c}' AS name, round(avg({c}), 6) AS mean FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))),
}
