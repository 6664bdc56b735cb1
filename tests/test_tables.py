import pytest
from pyspark.sql import functions as F

from statloom.functions import columns as c
from statloom.operators.features import vectors_from_array
from statloom.operators.prepare import (Detail, duplicate_keys, inside, keep, keep_latest, one_of, present, regimes,
                                        sorted_by, top, wide_join)
from statloom.plans.ingest import ingest
from statloom.session import scratch_path, shared_folder
from statloom.sinks.external import create_external_csv, publish_csv, publishable, use_database, write_external_csv
from statloom.sinks.files import save_csv, save_parquet, written_rows
from statloom.sinks.keyed import (Conflict, Store, change_keyed, clean_keyed, create_keyed, delete, drop_table, due, find_keyed, insert,
                                  key_of, merge_keyed, open_keyed, read_keyed, update, upsert)
from statloom.sources.tables import (literal_rows, query, read_csv, read_parquet, read_source, register, row_count, schema_ddl,
                                     schema_rows, zipped)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def base(spark):
    return spark.createDataFrame([(1, "x", 5.0), (2, "y", None), (3, None, 7.0), (4, "x", 0.0)],
                                 "id int, kind string, amount double")


@pytest.fixture()
def detail(spark):
    return spark.createDataFrame([(1, 10), (3, 30), (9, 90)], "key int, size int")


def test_filters(base):
    assert rows(keep(base, present("kind", "amount")).select("id")) == [(1,), (4,)]
    assert rows(keep(base, one_of("kind", ["x", "y"]), inside("amount", 0)).select("id")) == [(1,)]
    assert rows(keep(base, inside("amount", 0, 7)).select("id")) == [(1,)]


def test_wide_join_keeps_base_rows(base, detail):
    wide = wide_join(base, [Detail(detail, "id", "key")])
    assert rows(wide.select("id", "size")) == sorted([(1, 10), (2, None), (3, 30), (4, None)])
    same_name = wide_join(base, [Detail(detail.withColumnRenamed("key", "id"), "id", "id")])
    assert same_name.columns == ["id", "kind", "amount", "size"]


def test_duplicate_detail_keys(spark, base, detail):
    twice = detail.unionByName(spark.createDataFrame([(1, 11)], "key int, size int"))
    assert rows(duplicate_keys(twice, ["key"])) == [(1, 2)]
    with pytest.raises(Exception, match="not unique: 1"):
        wide_join(base, [Detail(twice, "id", "key")]).collect()
    latest = wide_join(base, [Detail(twice, "id", "key", "latest", ("size",))])
    assert rows(latest.filter("id = 1").select("size")) == [(11,)]
    assert wide_join(base, [Detail(twice, "id", "key", "trust")]).count() == 5
    with pytest.raises(ValueError):
        wide_join(base, [Detail(twice, "id", "key", "maybe")])
    with pytest.raises(ValueError, match="both tables"):
        wide_join(base, [Detail(detail.withColumn("amount", F.lit(1)), "id", "key")])


def test_keep_latest_with_ties_and_maps(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "n")], "k int, t int, v string")
    assert keep_latest(df, ["k"], ["t"]).columns == df.columns
    assert sorted(map(tuple, keep_latest(df.repartition(4), ["k"], ["t"]).collect())) == [(1, 5, "b"), (2, None, "n")]
    mapped = df.withColumn("m", F.create_map(F.lit("v"), "v")).drop("v")
    assert {r["t"] for r in keep_latest(mapped, ["k"], ["t"]).collect()} == {5, None}


def test_regimes_first_match_wins(base):
    out = regimes(base, [(F.col("kind") == "x", {"amount": F.col("amount") + 1, "tag": F.lit("one")}),
                         (F.col("id") > 3, {"amount": F.lit(-1.0), "tag": F.lit("two")}),
                         (F.col("amount") > 6, {"tag": F.lit("three")})])
    assert {r["id"]: (r["amount"], r["tag"]) for r in out.collect()} == {
        1: (6.0, "one"), 2: (None, None), 3: (7.0, "three"), 4: (1.0, "one")}


def test_order(base):
    assert [r["id"] for r in sorted_by(base, "id", descending=True).collect()] == [4, 3, 2, 1]
    assert [r["id"] for r in top(base, 2, "amount", "id").collect()] == [3, 1]


def test_column_helpers(spark):
    df = spark.createDataFrame([("7", 10.0, 0.0, [1.5, 2.5])], "t string, `a.b` double, z double, arr array<double>")
    out = df.select(c.ratio(c.col("a.b"), c.col("z")).alias("none"), c.rounded(c.col("a.b") / 4).alias("up"),
                    c.to_number(c.col("t"), "int").alias("seven"), c.to_number(F.lit("x")).alias("bad"),
                    c.null_to(F.lit(None).cast("int"), 0).alias("zero"),
                    c.verdict(c.col("z") > 0, "yes", "no").alias("v")).head()
    assert tuple(out) == (None, 3.0, 7, None, 0, "no")
    wide = c.array_to_columns(df, "arr", ["p", "q", "r"], positions=[1, 0, 2])
    assert tuple(wide.select("p", "q", "r").head()) == (2.5, 1.5, None) and "arr" not in wide.columns
    assert tuple(c.array_to_columns(df, "arr", ["p", "q"]).select("p", "q").head()) == (1.5, 2.5)
    with pytest.raises(Exception, match="has 2 elements, not 1"):
        c.array_to_columns(df, "arr", ["p"]).collect()
    with pytest.raises(ValueError):
        c.array_to_columns(df, "arr", ["p"], positions=[0, 1])
    chained = c.add_in_order(df, [("one", F.lit(1)), ("two", F.col("one") + 1)]).head()
    assert chained["two"] == 2
    assert c.rename(df, {"t": "text"}).columns[0] == "text"
    assert c.with_row_id(df).head()["id"] >= 0
    assert c.pick(df, ["a.b"]).columns == ["a.b"]


def test_sources(spark, base, tmp_path):
    register({"things": base})
    assert query(spark, "SELECT count(*) FROM things").head()[0] == 4
    assert query(spark, "SELECT count(*) FROM {t} WHERE id > 2", t=base).head()[0] == 2
    assert schema_ddl(base) == "`id` int, `kind` string, `amount` double"
    assert schema_rows(base).count() == 3
    assert rows(zipped(spark, [1.5, 2.5], [5, 6], "cost double, k int")) == [(1.5, 5), (2.5, 6)]
    with pytest.raises(ValueError):
        zipped(spark, [1], [1, 2], "a int, b int")
    assert literal_rows(spark, [], "a int, b string").count() == 0
    assert "LocalTableScan" in literal_rows(spark, [(1, None)], "a int, b string")._jdf.queryExecution().toString()
    assert row_count(base).head()["rows"] == 4
    save_parquet(base, str(tmp_path / "p"), ["id"], files=2)
    assert written_rows(spark, str(tmp_path / "p")) == 4
    assert read_parquet(spark, str(tmp_path / "p"), ["id"]).columns == ["id"]
    assert read_source(spark, "parquet", path=str(tmp_path / "p")).count() == 4
    save_csv(base, str(tmp_path / "c"), files=1)
    assert len(list((tmp_path / "c").glob("part-*"))) == 1
    assert rows(read_csv(spark, str(tmp_path / "c"), base.schema).select("id")) == [(1,), (2,), (3,), (4,)]


def test_a_frequent_sort_key_is_spread(spark, tmp_path):
    df = spark.range(20_000).select(F.when(F.col("id") < 18_000, 5).otherwise(F.col("id") % 10).alias("k"), "id")
    save_parquet(df, str(tmp_path / "s"), ["k"], files=8)
    sizes = [r["n"] for r in spark.read.parquet(str(tmp_path / "s")).groupBy(F.input_file_name()).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 6_000
    for f in sorted((tmp_path / "s").glob("part-*")):
        keys = [r["k"] for r in spark.read.parquet(str(f)).collect()]
        assert keys == sorted(keys)


def test_ingest_counts(spark, base, detail, tmp_path):
    counts = ingest(base, [Detail(detail, "id", "key")], [present("size")], [("double_size", F.col("size") * 2)],
                    str(tmp_path / "clean"), ["id"])
    assert counts == {"raw_rows": 4, "clean_rows": 2}
    trusted = ingest(base, [Detail(detail, "id", "key", "trust")], [present("size")], [], str(tmp_path / "t"))
    assert trusted == {"raw_rows": 4, "clean_rows": 2}


def test_external_csv_is_lossless(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", 0.1), (2, 'say "hi"', None), (3, None, -2.5), (4, "", 1e300), (5, "x\\N", 3.0)],
                               "id int, text string, value double")
    assert "default" in use_database(spark, "publish_test")
    back = publish_csv(df, "publish_test.odd_text", str(tmp_path / "odd"))
    assert {r["id"]: tuple(r)[1:] for r in back.collect()} == {r["id"]: tuple(r)[1:] for r in df.collect()}
    with pytest.raises(ValueError, match="do not match"):
        write_external_csv(df.drop("text"), "publish_test.odd_text", str(tmp_path / "odd"))
    write_external_csv(df.select("value", "text", "id").limit(2), "publish_test.odd_text", str(tmp_path / "odd"))
    assert spark.table("publish_test.odd_text").count() == 2
    with pytest.raises(Exception):
        create_external_csv(df, "publish_test.odd_text", str(tmp_path / "odd"))
    spark.sql("DROP DATABASE publish_test CASCADE")


def test_publishable_drops_what_text_cannot_hold(spark):
    df = spark.createDataFrame([(1, [1.0], "x", "y")], "id int, arr array<double>, location string, ok string")
    full = vectors_from_array(df, "arr").withColumn("m", F.create_map("id", "ok")).withColumn("s", F.struct("id"))
    assert publishable(full, reserved=["LOCATION"]).columns == ["id", "ok"]


def test_keyed_frames(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    changes = spark.createDataFrame([(2, "B1"), (2, "B2"), (9, "new")], "k int, v string")
    assert rows(upsert(target, changes, ["k"], ["v"])) == [(1, "a"), (2, "B2"), (3, "c"), (9, "new")]
    assert rows(update(target, changes, ["k"], ["v"])) == [(1, "a"), (2, "B2"), (3, "c")]
    assert rows(delete(target, changes, ["k"])) == [(1, "a"), (3, "c")]
    assert rows(insert(target, changes.filter("k = 9"), ["k"]))[-1] == (9, "new")
    with pytest.raises(ValueError, match="exists"):
        insert(target, changes.filter("v = 'B1'"), ["k"])
    with pytest.raises(ValueError, match="duplicate"):
        insert(target, changes, ["k"])


def test_keyed_table(spark, tmp_path):
    df = spark.range(100).selectExpr("id as k", "cast(id as string) as v")
    drop_table(spark, "keyed_test")
    create_keyed(df, "keyed_test", ["k"], str(tmp_path / "t"), buckets=4)
    assert key_of(spark, "keyed_test") == (["k"], 4)
    changes = spark.range(95, 105).selectExpr("id as k", "'new' as v")
    change_keyed(spark, "keyed_test", changes)
    change_keyed(spark, "keyed_test", spark.range(10).selectExpr("id as k"), "delete")
    change_keyed(spark, "keyed_test", spark.range(3).selectExpr("id as k", "'again' as v"), "insert")
    with pytest.raises(ValueError):
        change_keyed(spark, "keyed_test", spark.range(3).selectExpr("id as k", "'again' as v"), "insert")
    with pytest.raises(ValueError):
        change_keyed(spark, "keyed_test", changes, "merge")
    found = dict((r["k"], r["v"]) for r in read_keyed(spark, "keyed_test").collect())
    assert found == {**{k: "again" for k in range(3)}, **{k: str(k) for k in range(10, 95)},
                     **{k: "new" for k in range(95, 105)}}
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("keyed_test")] == ["keyed_test"]
    with pytest.raises(ValueError, match="duplicate"):
        create_keyed(df.unionByName(df), "keyed_twice", ["k"], str(tmp_path / "twice"))
    change_keyed(spark, "keyed_test", spark.range(200).selectExpr("id as k"), "delete")
    assert read_keyed(spark, "keyed_test").count() == 0
    change_keyed(spark, "keyed_test", changes)
    assert read_keyed(spark, "keyed_test").count() == 10
    assert drop_table(spark, "keyed_test", purge=True) and not drop_table(spark, "keyed_test")
    assert not (tmp_path / "t").exists()


def test_null_keys_are_refused(spark, tmp_path):
    good = spark.range(5).selectExpr("id as k", "'v' as v")
    bad = spark.createDataFrame([(None, "x"), (7, "y")], "k long, v string")
    for change in (upsert, update, insert):
        with pytest.raises(Exception, match="null in the key k"):
            change(good, bad, ["k"]).collect()
    with pytest.raises(Exception, match="null in the key k"):
        create_keyed(bad, "keyed_null", ["k"], str(tmp_path / "null"))
    create_keyed(good, "keyed_good", ["k"], str(tmp_path / "good"))
    with pytest.raises(Exception, match="null in the key k"):
        change_keyed(spark, "keyed_good", bad)
    assert read_keyed(spark, "keyed_good").count() == 5
    drop_table(spark, "keyed_good", purge=True)


@pytest.fixture()
def stored(spark, tmp_path):
    """1,000 rows in 16 buckets; the name of the table and its folder."""
    name, folder = f"keyed_{tmp_path.name.replace('-', '_')}", tmp_path / "t"
    drop_table(spark, name)
    create_keyed(spark.range(1000).selectExpr("id as k", "cast(id as string) as v"), name, ["k"], str(folder), buckets=16)
    yield name, folder
    drop_table(spark, name, purge=True)


def as_dict(df):
    found = df.collect()
    assert len({r["k"] for r in found}) == len(found)
    return {r["k"]: r["v"] for r in found}


def row_counts(files):
    import pyarrow.parquet as pq
    return sum(pq.read_metadata(f).num_rows for f in files)


def test_a_small_change_writes_small_parts(spark, stored):
    name, folder = stored
    before = set(folder.rglob("*.parquet"))
    touched = change_keyed(spark, name, spark.range(10).selectExpr("id as k", "'x' as v"), merge=False)
    after = set(folder.rglob("*.parquet"))
    assert before < after and 1 <= len(touched) <= 10 and len(after - before) == len(touched) and row_counts(after - before) == 10
    assert as_dict(read_keyed(spark, name)) == {k: "x" if k < 10 else str(k) for k in range(1000)}


def test_merging_by_size_and_number(spark, stored):
    name, folder = stored
    change_keyed(spark, name, spark.range(700).selectExpr("id as k", "'most' as v"), merge=False)
    wanted = as_dict(read_keyed(spark, name))
    merged = merge_keyed(spark, name)  # a few small buckets may have too little change
    assert len(merged) > 12 and as_dict(read_keyed(spark, name)) == wanted and merge_keyed(spark, name) == []
    assert len(merged) + len(merge_keyed(spark, name, ratio=0)) == 16 and merge_keyed(spark, name, ratio=0) == []
    for i in range(10):  # one row each time: merged for the number of parts only
        change_keyed(spark, name, spark.createDataFrame([(7, str(i))], "k long, v string"), merge=False)
    assert len(merge_keyed(spark, name)) == 1
    wanted[7] = "9"
    assert as_dict(read_keyed(spark, name)) == wanted
    change_keyed(spark, name, spark.range(1000).selectExpr("id as k"), "delete")
    assert read_keyed(spark, name).isEmpty()
    assert clean_keyed(spark, name) > 2 and not list(folder.rglob("*.parquet"))


def test_a_lookup_reads_one_bucket(spark, stored):
    name, _ = stored
    change_keyed(spark, name, spark.createDataFrame([(77, "new"), (78, "new")], "k long, v string"), merge=False)
    change_keyed(spark, name, spark.createDataFrame([(78,)], "k long"), "delete", merge=False)
    found = read_keyed(spark, name, {"k": [77]})
    assert as_dict(found) == {77: "new"} and as_dict(read_keyed(spark, name, {"k": [78, 5000]})) == {}
    assert {f.rsplit("__bucket=", 1)[1].split("/")[0] for f in found.inputFiles()} == {str(found_bucket(spark, 77))}
    plan = read_keyed(spark, name, {"k": [5]})._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,5)" in plan or "In(k, [5])" in plan
    assert as_dict(find_keyed(spark, name, spark.createDataFrame([(77,), (3,), (3,), (-1,)], "k int"))) == {77: "new", 3: "3"}
    assert as_dict(read_keyed(spark, name, {"k": []})) == {}
    with pytest.raises(ValueError, match="needed"):
        read_keyed(spark, name, {"v": ["x"]})


def found_bucket(spark, key):
    return spark.sql(f"SELECT pmod(xxhash64(cast({key} as bigint)), 16)").head()[0]


def test_two_part_keys(spark, tmp_path):
    df = spark.range(60).selectExpr("id % 6 as a", "cast(id div 6 as string) as b", "id as v")
    drop_table(spark, "keyed_pair")
    create_keyed(df, "keyed_pair", ["a", "b"], str(tmp_path / "t"), buckets=7)
    found = read_keyed(spark, "keyed_pair", {"a": [1, 2], "b": ["3", "9"]}).collect()
    assert sorted((r["a"], r["b"], r["v"]) for r in found) == [(1, "3", 19), (1, "9", 55), (2, "3", 20), (2, "9", 56)]
    drop_table(spark, "keyed_pair", purge=True)


def test_a_reader_stays_at_its_version(spark, stored):
    name, _ = stored
    first = read_keyed(spark, name)
    change_keyed(spark, name, spark.range(1000).selectExpr("id as k", "'new' as v"))
    assert set(as_dict(first).values()) == {str(k) for k in range(1000)} == set(as_dict(read_keyed(spark, name, version=1)).values())
    assert set(as_dict(read_keyed(spark, name)).values()) == {"new"}
    with pytest.raises(ValueError, match="no version"):
        read_keyed(spark, name, version=99)


def test_concurrent_changes(spark, stored):
    """Upserts of one bucket end one after the other; of two inserts of one key one is refused, whichever comes second."""
    from multiprocessing.pool import ThreadPool

    def attempt(args):
        how, key, value = args
        try:
            change_keyed(spark, name, spark.createDataFrame([(key, value)], "k long, v string"), how, merge=how == "upsert")
            return True
        except (Conflict, ValueError):
            return False

    name, folder = stored
    with ThreadPool(6) as pool:
        assert all(pool.map(attempt, [("upsert", 5, f"u{i}") for i in range(6)], chunksize=1))
        assert as_dict(read_keyed(spark, name))[5] in {f"u{i}" for i in range(6)}
        done = pool.map(attempt, [("insert", 5000, f"i{i}") for i in range(4)], chunksize=1)
    rows = as_dict(read_keyed(spark, name))
    assert sum(done) == 1 and rows[5000] == f"i{done.index(True)}" and len(rows) == 1001
    versions = open_keyed(spark, name).versions()
    assert versions == list(range(1, len(versions) + 1)) and not list((folder / "log").glob("_*"))


def test_a_strict_change_is_refused_after_another(spark, stored):
    name, _ = stored
    store = open_keyed(spark, name)
    seen, state = store.state()
    bucket = found_bucket(spark, 5)
    change_keyed(spark, name, spark.createDataFrame([(5, "x")], "k long, v string"), merge=False)
    late = {"part": "pnone", "rows": {bucket: 1}, "base": False, "merged": None}
    with pytest.raises(Conflict):
        store.commit(seen, late, strict=True)
    merge_keyed(spark, name, ratio=0)
    seen, _ = store.state()
    assert store.commit(seen, {**late, "rows": {}}, strict=True) == seen + 1


def test_a_merge_keeps_what_is_committed_meanwhile(spark, stored, monkeypatch):
    name, _ = stored
    change_keyed(spark, name, spark.range(900).selectExpr("id as k", "'a' as v"), merge=False)
    assert len(due(open_keyed(spark, name).state()[1])) == 16
    write = Store.write

    def late(self, *args, **named):
        counts = write(self, *args, **named)
        monkeypatch.setattr(Store, "write", write)
        change_keyed(spark, name, spark.createDataFrame([(5, "late"), (950, "late")], "k long, v string"), merge=False)
        return counts

    monkeypatch.setattr(Store, "write", late)
    assert len(merge_keyed(spark, name)) == 16
    assert as_dict(read_keyed(spark, name)) == {k: "late" if k in (5, 950) else "a" if k < 900 else str(k) for k in range(1000)}


def test_many_commits_use_the_written_state(spark, stored):
    name, folder = stored
    for i in range(20):
        change_keyed(spark, name, spark.createDataFrame([(i % 3, f"c{i}")], "k long, v string"))
    assert list((folder / "log").glob("*-full.json"))
    rows = as_dict(read_keyed(spark, name))
    assert (rows[0], rows[1], rows[2], len(rows)) == ("c18", "c19", "c17", 1000)


def test_a_failed_change_leaves_nothing(spark, stored):
    name, folder = stored
    before = set(folder.rglob("*"))
    bad = spark.range(3).selectExpr("id as k", "raise_error('no') as v")
    with pytest.raises(Exception, match="no"):
        change_keyed(spark, name, bad)
    assert {f for f in folder.rglob("*") if not f.name.endswith(".crc")} == {f for f in before if not f.name.endswith(".crc")}
    with pytest.raises(Exception, match="read_keyed"):
        spark.table(name).collect()


def test_scratch_folder_is_the_checkpoint_folder(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(shared_folder(spark))


class _Session:
    """Stands in for a session on a cluster."""

    def __init__(self, named):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master = "yarn"

    def getCheckpointDir(self):
        return None


def test_scratch_folder_on_a_cluster():
    assert shared_folder(_Session("/shared/place/")) == "/shared/place"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session(None))


HARD_TEXT = ["", " x ", '"', 'a "b", c', "line\r\nbreak", "\r", "\n", "\\", "\\N", "\\n", "\\s\\", "\\\\n", ",", "tab\t", None]


def test_text_files_keep_every_value(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(HARD_TEXT)), "id int, text string")
    want = dict(enumerate(HARD_TEXT))
    save_csv(df, str(tmp_path / "c"))
    assert {r["id"]: r["text"] for r in read_csv(spark, str(tmp_path / "c"), df.schema).collect()} == want
    back = publish_csv(df, "hard_text", str(tmp_path / "t"))
    assert {r["id"]: r["text"] for r in back.collect()} == want
    # one record is one line, so the files can be split anywhere
    folder = next((tmp_path / "t").glob("v-*"))
    assert sum(len(f.read_bytes().splitlines()) for f in folder.glob("part-*")) == len(HARD_TEXT)
    spark.sql("DROP VIEW hard_text_text")
    spark.sql("DROP TABLE hard_text")


def test_publishing_again(spark, tmp_path):
    """A table may be published from itself, and a failed publish leaves it as it was."""
    place = str(tmp_path / "again")
    publish_csv(spark.range(5), "again", place)
    back = publish_csv(spark.table("again_text").selectExpr("id + 10 AS id"), "again", place)
    assert sorted(r["id"] for r in back.collect()) == [10, 11, 12, 13, 14]
    with pytest.raises(Exception):
        publish_csv(spark.range(3).selectExpr("id DIV (id - 1) AS id"), "again", place)
    assert sorted(r["id"] for r in spark.table("again_text").collect()) == [10, 11, 12, 13, 14]
    with pytest.raises(Exception):
        publish_csv(spark.range(3).selectExpr("CAST(id DIV (id - 1) AS STRING) AS other"), "again", place)
    assert spark.table("again_text").columns == ["id"]
    assert publish_csv(spark.range(2).selectExpr("CAST(id AS STRING) AS other"), "again", place).columns == ["other"]
    spark.sql("DROP VIEW again_text")
    spark.sql("DROP TABLE again")
