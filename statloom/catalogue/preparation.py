"""Queries on joins, filters, derived columns, scaling, keys and order."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.catalogue.common import Query, r, rounded, table
from statloom.functions.columns import (array_to_columns, cast_columns, col, null_to, pick, ratio, rename, rounded as
                                        round_to, to_number, verdict, with_row_id)
from statloom.operators.cluster import cluster_profile
from statloom.operators.features import normalize_l1, standardize
from statloom.operators.prepare import (Detail, duplicate_keys, inside, join_on, keep, keep_latest, one_of, present,
                                        regimes, sorted_by, top, wide_join)
from statloom.operators.subsets import equal_to_extreme
from statloom.plans.ingest import ingest, wide_clean
from statloom.session import scratch_path
from statloom.sources.tables import query, read_parquet, register, row_count, schema_rows


def _details(spark, folder):
    return [Detail(table(spark, folder, "customer"), "o_custkey", "c_custkey"),
            Detail(table(spark, folder, "nation"), "c_nationkey", "n_nationkey")]


def _conditions():
    return [present("o_orderpriority", "o_totalprice"), F.expr("c_mktsegment = 'BUILDING'"),
            one_of("o_orderstatus", ["F", "O"]), inside("c_acctbal", 0), inside("o_totalprice", 0, 400_000)]


def _derived():
    return [("c_acctbal", col("c_acctbal").cast("double")), ("n_regionkey", col("n_regionkey").cast("int")),
            ("thousands", col("c_acctbal") * 1000),
            ("per_region", round_to(ratio(col("thousands"), col("n_regionkey")))),
            ("price_or_zero", null_to(col("o_totalprice"), 0.0))]


_WIDE_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "c_name", "c_acctbal", "n_name", "n_regionkey",
                 "thousands", "per_region", "price_or_zero"]


def _wide_prepare(spark, folder):
    wide = wide_clean(table(spark, folder, "orders"), _details(spark, folder), _conditions(), _derived())
    return rounded(sorted_by(wide, "o_orderkey").select(*_WIDE_COLUMNS), {"thousands": 2})


def _ingest_counts(spark, folder):
    path = scratch_path(spark, "clean")
    counts = ingest(table(spark, folder, "orders"), _details(spark, folder), _conditions(), _derived(), path,
                    ["o_orderkey"])
    written = read_parquet(spark, path)
    return written.agg(F.lit(counts["raw_rows"]).alias("raw_rows"), F.lit(counts["clean_rows"]).alias("clean_rows"),
                       F.count(F.lit(1)).alias("read_rows"), F.min("o_orderkey").alias("first_key"))


def _sql_text(spark, folder):
    register({f"raw_{n}": table(spark, folder, n) for n in ("orders", "customer", "nation")})
    return query(spark, _SQL_TEXT.format(prefix="raw_"))


_SQL_TEXT = """
SELECT a.o_orderkey, a.o_orderdate, a.o_totalprice, b.c_custkey, b.c_mktsegment, c.n_nationkey, c.n_name
FROM {prefix}orders a LEFT JOIN {prefix}customer b ON a.o_custkey = b.c_custkey
LEFT JOIN {prefix}nation c ON b.c_nationkey = c.n_nationkey"""


def _repeated(spark, folder):
    customers = table(spark, folder, "customer", "c_custkey", "c_acctbal", "c_nationkey")
    later = customers.filter("c_nationkey < 9").withColumn("c_acctbal", F.expr("c_acctbal + 1000"))
    return customers.unionByName(later)


def _unique_key(spark, folder):
    detail = Detail(_repeated(spark, folder), "o_custkey", "c_custkey", "latest", ("c_acctbal",))
    wide = wide_join(table(spark, folder, "orders", "o_orderkey", "o_custkey"), [detail])
    return rounded(wide, {"c_acctbal": 2})


def _duplicates(spark, folder):
    return duplicate_keys(_repeated(spark, folder), ["c_custkey"])


def _latest(spark, folder):
    orders = table(spark, folder, "orders", "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return keep_latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def _regimes(spark, folder):
    df = table(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    price = col("o_totalprice")
    changed = regimes(df, [
        (col("o_orderstatus") == "F", {"o_totalprice": price * 1.5, "rule": F.lit("status")}),
        ((col("o_orderpriority") == "1-URGENT") & (price < 150_000), {"o_totalprice": price + 100.0,
                                                                      "rule": F.lit("urgent")})])
    return rounded(changed.select("o_orderkey", "o_totalprice", "rule"), {"o_totalprice": 4})


def _z(spark, folder):
    df = standardize(table(spark, folder, "part", "p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    return rounded(df.select("p_partkey", "p_size_z", "p_retailprice_z"), {"p_size_z": 9, "p_retailprice_z": 9})


def _sd(spark, folder):
    df = standardize(table(spark, folder, "part", "p_partkey", "p_size", "p_retailprice"),
                     ["p_size", "p_retailprice"], center=False, suffix="_sd")
    return rounded(df.select("p_partkey", "p_size_sd", "p_retailprice_sd"), {"p_size_sd": 9, "p_retailprice_sd": 8})


def _l1(spark, folder):
    df = table(spark, folder, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    scaled = normalize_l1(df, ["c_nationkey", "c_acctbal"])
    return rounded(scaled.select("c_custkey", "c_nationkey_l1", "c_acctbal_l1"),
                   {"c_nationkey_l1": 9, "c_acctbal_l1": 9})


def _scalars(spark, folder):
    df = table(spark, folder, "part", "p_partkey", "p_size", "p_retailprice", "p_brand")
    size, price = col("p_size"), col("p_retailprice")
    return df.select("p_partkey", F.round(F.pow(size, F.lit(2.0)), 4).alias("squared"),
                     F.round(F.sqrt(price), 8).alias("root"), F.abs(size - 25).alias("distance"),
                     verdict(price > 950, "high", "low").alias("band"),
                     F.round(ratio(price, size - 25), 6).alias("per_unit"),
                     to_number(F.substring("p_brand", 7, 5), "int").alias("brand_number"),
                     to_number(col("p_brand"), "int").alias("not_a_number"),
                     F.when((size > 40) | (size < 3), null_to(F.lit(None).cast("int"), 0)).alias("zero_or_null"))


def _columns(spark, folder):
    df = rename(table(spark, folder, "part"), {"p_retailprice": "price.list", "p_partkey": "part"})
    df = cast_columns(pick(df, ["part", "price.list", "p_size", "p_type"]), {"p_size": "double"}).drop("p_type")
    return with_row_id(df, "id").select("part", col("price.list").alias("list_price"), "p_size",
                                        (col("id") >= 0).alias("has_id"))


def _array_columns(spark, folder):
    df = table(spark, folder, "embeddings", "vec_id", "embedding")
    return rounded(array_to_columns(df, "embedding", [f"v{i}" for i in range(64)]), {f"v{i}": 9 for i in range(64)})


def _schema(spark, folder):
    """The schemas of two tables as rows."""
    return schema_rows(table(spark, folder, "part")).unionByName(schema_rows(table(spark, folder, "events")))


def _join_using(spark, folder):
    orders = rename(table(spark, folder, "orders", "o_orderkey", "o_custkey"), {"o_custkey": "custkey"})
    customers = rename(table(spark, folder, "customer", "c_custkey", "c_name"), {"c_custkey": "custkey"})
    return join_on(orders, customers, ["custkey"])


def _rows(spark, folder):
    names = ("lineitem", "orders", "customer", "part")
    counts = [row_count(table(spark, folder, n)).select(F.lit(n).alias("name"), "rows") for n in names]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def _top(spark, folder):
    return top(table(spark, folder, "orders", "o_orderkey", "o_totalprice"), 20, "o_totalprice", "o_orderkey")


def _ties(spark, folder):
    return equal_to_extreme(table(spark, folder, "part", "p_partkey", "p_size"), "p_size")


def _filters(spark, folder):
    df = table(spark, folder, "lineitem", "l_orderkey", "l_quantity", "l_returnflag", "l_linestatus", "l_discount")
    return keep(df, col("l_returnflag") == "N", col("l_linestatus") == "O", inside("l_quantity", 10, 40),
                one_of("l_discount", [0.01, 0.05])).groupBy("l_discount").agg(
        F.count(F.lit(1)).alias("rows"), F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"))


def _profile(spark, folder):
    df = table(spark, folder, "lineitem", "l_linenumber", "l_orderkey", "l_quantity", "l_discount", "l_tax")
    return rounded(cluster_profile(df, "l_orderkey", ["l_quantity", "l_discount", "l_tax"], "l_linenumber"),
                   {"l_quantity": 8, "l_discount": 9, "l_tax": 9})


# -- SQL -------------------------------------------------------------------------------------------------------

_JOINED = """FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"""
_CLEAN = f"""{_JOINED} WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL AND c_mktsegment = 'BUILDING'
AND o_orderstatus IN ('F', 'O') AND c_acctbal > 0 AND o_totalprice > 0 AND o_totalprice < 400000"""
_REPEATED = """(SELECT c_custkey, c_acctbal, c_nationkey FROM customer UNION ALL
               SELECT c_custkey, c_acctbal + 1000, c_nationkey FROM customer WHERE c_nationkey < 9)"""


def _scaled_sql(a: str, b: str, tag: str, digits: tuple[int, int]) -> str:
    return (f"SELECT p_partkey, {r(a, digits[0], 'p_size_' + tag)}, {r(b, digits[1], 'p_retailprice_' + tag)} FROM part, "
            "(SELECT avg(p_size) AS m1, stddev_samp(p_size) AS d1, avg(p_retailprice) AS m2, "
            "stddev_samp(p_retailprice) AS d2 FROM part)")


QUERIES: dict[str, Query] = {
    "wide_prepare": (_wide_prepare, f"""
        SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_acctbal, n_name, n_regionkey,
               {r('c_acctbal * 1000', 2, 'thousands')}, round(c_acctbal * 1000 / nullif(n_regionkey, 0)) AS per_region,
               coalesce(o_totalprice, 0.0) AS price_or_zero {_CLEAN} ORDER BY o_orderkey"""),
    "ingest_counts": (_ingest_counts, f"""
        SELECT (SELECT CAST(count(*) AS BIGINT) {_JOINED}) AS raw_rows, CAST(count(*) AS BIGINT) AS clean_rows,
               CAST(count(*) AS BIGINT) AS read_rows, min(o_orderkey) AS first_key {_CLEAN}"""),
    "sql_text": (_sql_text, _SQL_TEXT.format(prefix="")),
    "wide_unique_key": (_unique_key, f"""
        SELECT o_orderkey, o_custkey, c_custkey, {r('c_acctbal', 2, 'c_acctbal')}, c_nationkey FROM orders LEFT JOIN
        (SELECT c_custkey, max(c_acctbal) AS c_acctbal, max(c_nationkey) AS c_nationkey FROM {_REPEATED}
         GROUP BY c_custkey) ON o_custkey = c_custkey"""),
    "duplicate_keys": (_duplicates, f"SELECT c_custkey, CAST(count(*) AS BIGINT) AS rows FROM {_REPEATED} "
                                    f"GROUP BY c_custkey HAVING count(*) > 1"),
    "latest_per_key": (_latest, """
        SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""),
    "regime_branch": (_regimes, f"""
        SELECT o_orderkey, {r('''CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 1.5
            WHEN o_orderpriority = '1-URGENT' AND o_totalprice < 150000 THEN o_totalprice + 100
            ELSE o_totalprice END''', 4, 'o_totalprice')},
            CASE WHEN o_orderstatus = 'F' THEN 'status'
                 WHEN o_orderpriority = '1-URGENT' AND o_totalprice < 150000 THEN 'urgent' END AS rule FROM orders"""),
    "standardize_z": (_z, _scaled_sql("(p_size - m1) / d1", "(p_retailprice - m2) / d2", "z", (9, 9))),
    "standardize_sd": (_sd, _scaled_sql("p_size / d1", "p_retailprice / d2", "sd", (9, 8))),
    "normalize_l1": (_l1, f"""
        SELECT c_custkey, {r('c_nationkey / (abs(c_nationkey) + abs(c_acctbal))', 9, 'c_nationkey_l1')},
               {r('c_acctbal / (abs(c_nationkey) + abs(c_acctbal))', 9, 'c_acctbal_l1')} FROM customer"""),
    "scalar_expressions": (_scalars, """
        SELECT p_partkey, round(pow(p_size, 2), 4) AS squared, round(sqrt(p_retailprice), 8) AS root,
               abs(p_size - 25) AS distance, CASE WHEN p_retailprice > 950 THEN 'high' ELSE 'low' END AS band,
               round(p_retailprice / nullif(p_size - 25, 0), 6) AS per_unit,
               TRY_CAST(substr(p_brand, 7, 5) AS INTEGER) AS brand_number,
               TRY_CAST(p_brand AS INTEGER) AS not_a_number,
               CASE WHEN p_size > 40 OR p_size < 3 THEN 0 END AS zero_or_null FROM part"""),
    "project_rename_drop": (_columns, """
        SELECT p_partkey AS part, p_retailprice AS list_price, CAST(p_size AS DOUBLE) AS p_size, true AS has_id
        FROM part"""),
    "array_to_columns": (_array_columns, "SELECT vec_id, " + ", ".join(
        r(f"CAST(embedding[{i + 1}] AS DOUBLE)", 9, f"v{i}") for i in range(64)) + " FROM embeddings"),
    "schema_rows": (_schema, """
        SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS name, CASE data_type
               WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
               WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type, true AS nullable
        FROM information_schema.columns WHERE table_name IN ('part', 'events')"""),
    "join_using": (_join_using, """
        SELECT custkey, o_orderkey, c_name FROM (SELECT o_custkey AS custkey, o_orderkey FROM orders)
        JOIN (SELECT c_custkey AS custkey, c_name FROM customer) USING (custkey)"""),
    "row_counts": (_rows, " UNION ALL ".join(f"SELECT '{n}' AS name, CAST(count(*) AS BIGINT) AS rows FROM {n}"
                                             for n in ("lineitem", "orders", "customer", "part"))),
    "topk_metric": (_top, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"),
    "extreme_ties": (_ties, "SELECT p_partkey, p_size FROM part WHERE p_size = (SELECT max(p_size) FROM part)"),
    "slice_filters": (_filters, """
        SELECT l_discount, CAST(count(*) AS BIGINT) AS rows, min(l_quantity) AS least, max(l_quantity) AS most
        FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O' AND l_quantity > 10 AND l_quantity < 40
        AND l_discount IN (0.01, 0.05) GROUP BY l_discount"""),
    "group_profile": (_profile, f"""
        SELECT l_linenumber, CAST(count(l_orderkey) AS BIGINT) AS l_orderkey, {r('avg(l_quantity)', 8, 'l_quantity')},
               {r('avg(l_discount)', 9, 'l_discount')}, {r('avg(l_tax)', 9, 'l_tax')} FROM lineitem
        GROUP BY l_linenumber"""),
}
