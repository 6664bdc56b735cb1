import hashlib
import re

import xxhash

from statloom.llm.fingerprints import (BYTES, GRAM, SPAN, WINDOW, edited_fingerprints, fingerprints, neighbours, op2_winnow,
                                       winnow_bytes)

from .conftest import ROWS


def h64(value, seed=42):
    n = xxhash.xxh64_intdigest(value, seed)
    return n - (1 << 64) if n >> 63 else n


def winnowed(text, gram=GRAM, window=WINDOW):
    """(hash, position) of the selected k-grams, straight from the definition."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    hashed = [h64("".join(c.lower() if "A" <= c <= "Z" else c for c in w).encode()) for w in words]
    if not hashed:
        return []
    grams = []
    for i in range(max(len(hashed) - gram, 0) + 1):
        seed = 42
        for h in hashed[i:i + gram]:
            seed = xxhash.xxh64_intdigest((h % (1 << 64)).to_bytes(8, "little"), seed)
        grams.append(seed >> 32)
    selected = []
    for i in range(max(len(grams) - window, 0) + 1):
        part = grams[i:i + window]
        at = i + max(j for j, x in enumerate(part) if x == min(part))
        if (grams[at], at) not in selected[-1:]:
            selected.append((grams[at], at))
    return selected


def text_of(selected):
    return " ".join(f"{h:08x}@{p}" for h, p in selected)


def alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    rows = sorted(rows)
    out = {}
    for k, (id, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(text) // 4
        edited = text[:len(text) - q] + after[:q]
        own, changed = winnowed(text), winnowed(edited)
        out[id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), text_of(own), text_of(changed),
                   alike(own, changed), alike(own, winnowed(after)))
    return out


def check(docs, rows):
    found = {r[0]: tuple(r)[1:] for r in edited_fingerprints(docs).collect()}
    want = expected(rows)
    assert found.keys() == want.keys()
    for id in want:
        assert found[id][:4] == want[id][:4]
        assert abs(found[id][4] - want[id][4]) < 1e-12 and abs(found[id][5] - want[id][5]) < 1e-12


def test_against_the_definition(spark, texts):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), texts)


def test_small_tables(spark):
    for rows in ([(5, "one two")], [(1, None), (2, "a b c d e f g h"), (3, ""), (9, "x " * 50)]):
        check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_odd_rows(odd, none):
    assert edited_fingerprints(odd).count() == len(ROWS) and edited_fingerprints(none).count() == 0
    found = fingerprints(odd).collect()
    assert len(found) == len(ROWS)
    same = {tuple(r["hashes"]) for r in found if r["doc_id"] in (6, 7)}
    assert len(same) == 1
    assert all(r["hashes"] == [] for r in found if r["doc_id"] in (3, 4, 5))


def test_neighbours_cross_partitions(spark):
    from pyspark.sql import functions as F
    keys = spark.range(0, 5000, 7).repartition(13).select(F.col("id").cast("string").alias("key"), "id", F.col("id").alias("ask"))
    found = {int(r["key"]): (int(r["before"]), r["before_ask"]) for r in neighbours(keys).collect()}
    ids = list(range(0, 5000, 7))
    assert found == {x: (ids[i - 1], ids[i - 1]) for i, x in enumerate(ids)}


def test_match_guarantee(spark):
    shared = " ".join(f"s{i}" for i in range(GRAM + WINDOW - 1))
    docs = spark.createDataFrame([(i, " ".join(f"d{i}w{j}" for j in range(40 * i)) + f" {shared} " +
                                   " ".join(f"e{i}w{j}" for j in range(30))) for i in range(4)], "doc_id long, text string")
    sets = [set(r["hashes"]) for r in fingerprints(docs).collect()]
    assert set.intersection(*sets)


def test_native(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = edited_fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def winnowed_bytes(text, gram=BYTES, window=SPAN):
    data = re.sub(r"[\x20\x09-\x0D]", "", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")).encode()
    grams = [(h64(data[i:i + gram]) >> 31) & 0xFFFFFFFF for i in range(max(len(data) - gram, 0) + 1)] if data else []
    selected = []
    for i in range(max(len(grams) - window, 0) + 1) if grams else ():
        part = grams[i:i + window]
        at = i + max(j for j, x in enumerate(part) if x == min(part))
        if (grams[at], at) not in selected[-1:]:
            selected.append((grams[at], at))
    return selected


def test_bytes_against_the_definition(spark, texts, monkeypatch):
    monkeypatch.setitem(globals(), "winnowed", winnowed_bytes)
    want = expected(texts)
    found = {r[0]: tuple(r)[1:] for r in op2_winnow(spark, "/root/testdata/sf0.001").collect()}
    assert found.keys() == want.keys()
    for id in want:
        assert found[id][:4] == want[id][:4]
        assert abs(found[id][4] - want[id][4]) < 1e-12 and abs(found[id][5] - want[id][5]) < 1e-12


def test_odd_texts_in_bytes(spark, odd, none):
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "a"), (4, "İſK ünïcödé 😀"), (5, "AAAA" * 40), (6, "abcdefgh"), (7, "A b C d E f G h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for gram, window in ((BYTES, SPAN), (3, 1), (1, 2), (5, 13)):
        found = {r["doc_id"]: list(zip(r["hashes"], r["positions"])) for r in
                 fingerprints(docs, gram=gram, window=window, select=winnow_bytes).collect()}
        assert found == {i: winnowed_bytes(t, gram, window) for i, t in rows}
    assert edited_fingerprints(odd, select=winnow_bytes).count() == len(ROWS)
    assert edited_fingerprints(none, select=winnow_bytes).count() == 0
    plan = edited_fingerprints(docs, select=winnow_bytes)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_and_unspaced_texts_stay_alike(spark, tmp_path):
    short = [f"the {w} sat quietly on this old mat" for w in ("cat", "dog", "hen", "fox")]
    unspaced = ["".join(chr(0x4E00 + (i * 7919 + j * 104729) % 20000) for j in range(200)) for i in range(3)]
    rows = list(enumerate(short + unspaced + ["red green blue", "one two three four"]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in op2_winnow(spark, str(tmp_path)).collect()}
    assert all(found[i]["near_edited"] > 0 for i in range(7)) and all(found[i]["near_next"] > 0 for i in range(3))
    assert all(len(found[i]["fingerprint"].split()) > 20 for i in (4, 5, 6))


def test_shared_grams_change_nothing(spark):
    """Texts of every length with every cut: the edited text's fingerprint is that of the text written out."""
    from pyspark.sql import functions as F

    from statloom.llm.fingerprints import both_byte_fingerprints, winnow_bytes
    texts = ["", " ", "a", "ab cd", "abcdef", "The quick brown fox jumps", "aaaaaaaaaaaaaaaaaaaa", "ü😀 Ä b c d e f", "x" * 11, "y z" * 9]
    rows = [(t, t[:len(t) - cut], t[len(t) - cut:], more) for t in texts for cut in range(len(t) + 1) for more in ("", " ", "Q", "new Text", "aaaaaaa")]
    df = spark.createDataFrame(rows, "text string, kept string, dropped string, added string")
    found = both_byte_fingerprints(df, F.col("text"), F.col("dropped"), F.col("added"))
    wrong = found.where((F.col("own") != winnow_bytes(F.col("text"))) | (F.col("changed") != winnow_bytes(F.concat("kept", "added"))))
    assert wrong.isEmpty() and found.count() == len(rows)


def test_texts_are_shuffled_and_winnowed_once(spark):
    """The hashes of the next document come from its own row: no text is joined to another, nor shuffled again."""
    plan = op2_winnow(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_blocks_of_every_size(spark):
    """The next document is found within a block, across blocks and behind the last one; ids may repeat or be null."""
    words = [f"Text {i} of the {'odd' if i % 2 else 'even'} ones: {'word ' * (i % 9)}end {i * i}" for i in range(30)]
    rows = [(i * 3, t) for i, t in enumerate(words)] + [(9, "another nine"), (9, "another nine"), (12, None), (87, "a last one again")]
    for extra in ([], [(None, "no id at all"), (None, "nor here")]):
        every = rows + extra
        ids = sorted({i for i, _ in every}, key=lambda i: (i is not None, i))
        stands = {i: min((t or "" for j, t in every if j == i), key=lambda t: h64(t.encode())) for i in ids}
        want = []
        for i, t in every:
            t, after = t or "", stands[ids[(ids.index(i) + 1) % len(ids)]]
            edited = t[:len(t) - len(t) // 4] + after[:len(t) // 4]
            own, changed = winnowed_bytes(t), winnowed_bytes(edited)
            want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text_of(own), text_of(changed),
                         round(alike(own, changed), 9), round(alike(own, winnowed_bytes(after)), 9)))
        docs = spark.createDataFrame(every, "doc_id long, text string").repartition(5)
        for block in (1, 500, 1 << 20):
            found = [tuple(r) for r in edited_fingerprints(docs, select=winnow_bytes, block=block).collect()]
            found = [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in found]
            assert sorted(found, key=repr) == sorted(want, key=repr)


def test_ids_of_other_types(spark):
    rows = [(f"k{i:02d}", f"some text number {i} and more of it") for i in range(25)]
    docs = spark.createDataFrame(rows, "name string, body string")
    want = {i: winnowed_bytes(t) for i, t in rows}
    for block in (1, 300):
        found = {r["name"]: r for r in edited_fingerprints(docs, "name", "body", select=winnow_bytes, block=block).collect()}
        for k, (i, _) in enumerate(rows):
            after = want[rows[(k + 1) % len(rows)][0]]
            assert found[i]["fingerprint"] == text_of(want[i]) and abs(found[i]["near_next"] - alike(want[i], after)) < 1e-12


def test_windows_of_every_size(spark):
    rows = list(enumerate(["", "a", "abc", "A\x00b  c\x00d", "İ\x00 Kelvin K ſ", "the quick brown fox jumps over the lazy dog", "ab" * 40]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (2, 3, 4, 7, 10, 17):
        found = {r["doc_id"]: list(zip(r["hashes"], r["positions"])) for r in
                 fingerprints(docs, gram=2, window=window, select=winnow_bytes).collect()}
        assert found == {i: winnowed_bytes(t, 2, window) for i, t in rows}
