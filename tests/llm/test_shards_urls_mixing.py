import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from statloom.llm.mixing import inclusion, mix, mix_counts, source_targets
from statloom.llm.shards import hash_bits, op4_shards, shard_map, write_shards
from statloom.llm.text import word_count
from statloom.llm.urls import RULES, judge_urls, rule_table

from .conftest import ROWS


def test_hash_bits(spark):
    df = spark.createDataFrame([(5,), (None,)], "id long")
    want = [int(hashlib.md5(x).hexdigest()[:15], 16) for x in (b"5", b"null")]
    assert [r[0] for r in df.select(hash_bits(df["id"])).collect()] == want


@pytest.mark.parametrize("limit", [1, 64, 200, 10 ** 9])
def test_shards(odd, limit):
    rows, leaves = shard_map(odd, limit=limit)
    rows, leaves = rows.collect(), {r["shard"]: r for r in leaves.collect()}
    bits = lambda id: int(hashlib.md5(str(id if id is not None else "null").encode()).hexdigest()[:15], 16)
    size = lambda text: len((text or "").encode())
    sums = defaultdict(int)
    for id, text, _ in ROWS:
        for depth in range(61):
            sums[depth, bits(id) >> (60 - depth)] += size(text)
    want = Counter()
    for id, text, _ in ROWS:
        depth = next(d for d in range(61) if sums[d, bits(id) >> (60 - d)] <= limit or d == 60)
        name = f"{bits(id) >> (60 - depth):0{depth}b}" if depth else ""
        want[(id, size(text), name)] += 1
    assert Counter((r["doc_id"], r["bytes"], r["shard"]) for r in rows) == want
    assert sum(r["bytes"] for r in leaves.values()) == sum(size(t) for _, t, _ in ROWS)
    assert set(leaves) == {r["shard"] for r in rows}


def test_shards_empty_and_written(spark, none, odd, tmp_path):
    assert shard_map(none)[0].count() == 0
    docs = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    write_shards(docs, str(tmp_path / "out"), limit=100)
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()
    with pytest.raises(ValueError):
        shard_map(odd, limit=0)


def test_shards_read_back_by_name(spark, odd, tmp_path):
    """Folder names stay text; a repeated id keeps each row once; a small table has one named shard."""
    for limit in (100, 10 ** 9):
        path = str(tmp_path / f"out{limit}")
        write_shards(odd, path, limit=limit)
        back = spark.read.parquet(path)
        assert sorted(map(repr, (r["doc_id"] for r in back.collect()))) == sorted(repr(r[0]) for r in ROWS)
        assert {r[0] for r in back.select("shard").distinct().collect()} == {
            "s" + r["shard"] for r in shard_map(odd, limit=limit)[1].collect() if r["docs"]}
        assert set(back.columns) == set(odd.columns)


def test_judged_pages_with_clashing_names(spark, odd):
    pages = odd.withColumn("url", F.lit("http://www.example.net/en/a"))
    found = judge_urls(pages, rule_table(spark, RULES))
    assert found.columns == [c for c in pages.columns if c != "host"] + ["host", "path", "rule", "verdict"]
    assert {tuple(r) for r in found.select("host", "path", "rule", "verdict", "_host", "made_host").collect()} == {
        ("www.example.net", "/en/a", "example.net/en/", "allow", "x", "x")}
    assert found.count() == len(ROWS)


def test_write_a_whole_table(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    limit, path = 1 << 18, str(tmp_path / "out")
    write_shards(docs, path, limit=limit)
    back = spark.read.option("recursiveFileLookup", "true").parquet(path)
    assert back.columns == docs.columns and back.count() == docs.count()
    assert back.exceptAll(docs).isEmpty() and docs.exceptAll(back).isEmpty()
    place = F.regexp_extract(F.input_file_name(), "/shard=s([^/]*)/", 1)
    found = {(r["doc_id"], r["shard"]) for r in back.select("doc_id", place.alias("shard")).collect()}
    rows, leaves = shard_map(docs, limit=limit)
    placed = {(r["doc_id"], r["shard"]) for r in rows.collect()}
    assert found == placed and len({s for _, s in placed}) == leaves.count() > 1
    assert all(r["bytes"] <= limit for r in leaves.collect())


def test_registered_query_splits(spark):
    rows = op4_shards(spark, "/root/testdata/sf0.01").select("shard", "depth", "shard_bytes").distinct().collect()
    assert len(rows) > 1 and all(r["shard_bytes"] <= 1 << 20 and r["depth"] == len(r["shard"]) > 0 for r in rows)


URLS = [(1, "http://a.example.net/en/1"), (2, "https://EXAMPLE.com/de/x?y#z"), (3, "http://x.org/fr/"), (4, None),
        (5, "no scheme"), (6, "http://net"), (7, "http://net/"), (8, "ftp://notexample.net/en/"), (9, ""),
        (10, "http://a.b.c.net?q"), (11, "http://u.example.net/EN/"), (1, "http://a.example.net/en/1"), (None, "x://org/fr/a"),
        (12, "a://b://net/"), (13, "http://.net/x"), (14, "http://example.com/de"), (15, "http://" + "a." * 40 + "net/" + "p" * 5000)]


def judged(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, default, None)
    return host, path, best[3], best[2]


@pytest.mark.parametrize("rules", [RULES, RULES + [("", "", "block"), ("c.net", "", "allow"), ("org", "/f", "block")], []])
def test_urls(spark, rules):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in URLS], "page_id long, url string, host string, rule string")
    found = judge_urls(pages, rule_table(spark, rules) if rules else rule_table(spark, RULES).limit(0))
    got = Counter((r["page_id"], r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect())
    # a url without a host has the empty label, which only a rule for the empty host fits
    assert got == Counter((i, u, *judged(u, rules)) for i, u in URLS)
    assert judge_urls(pages.limit(0), rule_table(spark, RULES)).count() == 0


def test_urls_stay_native(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    plan = judge_urls(pages, rule_table(spark, RULES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_mix_odd(odd, none):
    rows = mix_counts(odd).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r["copies"] <= 3 for r in rows)
    assert rows and Counter(map(tuple, rows)) == Counter(map(tuple, mix_counts(odd.repartition(5)).collect()))
    assert mix_counts(none).count() == mix(none).count() == 0
    mixed = mix(odd)
    assert mixed.columns == odd.columns
    want = Counter()
    for r in rows:
        want[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == +want


def test_mix_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mix_counts(docs).collect()
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    size, target, taken, biggest = Counter(), {}, Counter(), Counter()
    for r in rows:
        s = sources[r["doc_id"]]
        size[s] += r["size"]
        taken[s] += r["size"] * r["copies"]
        target[s] = r["target"]
        biggest[s] = max(biggest[s], r["size"])
    names, weights, total = sorted(size), (5, 2, 1), sum(size.values())
    want, capped = {}, set()
    while True:
        left = total - sum(3 * size[s] for s in capped)
        w = {s: weights[i % 3] for i, s in enumerate(names) if s not in capped}
        want = {s: 3.0 * size[s] if s in capped else left * w[s] / sum(w.values()) for s in names}
        over = {s for s in names if want[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    for s in names:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= biggest[s] / 2 + 1e-6


def test_inclusion_follows_p(spark):
    """Three sources whose documents have 1 to 200 words: over seeds, the share of documents that get one copy more than
    the certain ones is that of their size class, and the words of every source meet its target."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.element_at(F.array(*map(F.lit, ("a", "b", "b", "b", "c"))),
                                    (F.col("id") % 5 + 1).cast("int")).alias("source"),
                                    F.repeat(F.lit("w "), (F.col("id") * 7919 % 200 + 1).cast("int")).alias("text"))
    size = {i: i * 7919 % 200 + 1 for i in range(6000)}
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    wanted = {(r["source"], r["class"]): r for r in inclusion(sizes, source_targets(sizes)).collect()}
    for name in "abc":  # expected words are the target
        total = sum((r["certain"] + r["p"]) * sum(size[i] for i in size if "abbbc"[i % 5] == s and size[i].bit_length() == k)
                    for (s, k), r in wanted.items() if s == name)
        assert total == pytest.approx(next(r["target"] for (s, _), r in wanted.items() if s == name))
    assert len({round(r["p"], 6) for (s, _), r in wanted.items() if s == "b"}) > 3  # not one number per source
    more, seen = Counter(), Counter()
    for seed in range(6):
        for r in mix_counts(docs, seed=seed).collect():
            key = ("abbbc"[r["doc_id"] % 5], size[r["doc_id"]].bit_length())
            more[key] += r["copies"] - wanted[key]["certain"]
            seen[key] += 1
            assert r["copies"] - wanted[key]["certain"] in (0, 1)
    for key, n in seen.items():
        p = wanted[key]["p"]
        assert abs(more[key] / n - p) <= 4.5 * (p * (1 - p) / n) ** 0.5 + 1e-9, key
