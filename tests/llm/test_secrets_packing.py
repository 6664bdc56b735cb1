import math
import os
import random
import re
import subprocess
import sys
import time
from collections import Counter

import pytest

from statloom.llm import secrets as S
from statloom.llm.packing import optimal_boundaries, pack

from .conftest import ROWS


def entropy(window):
    return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())


def test_sliding_windows_equal_the_definition():
    """Every window on its own: its entropy, its kinds of characters and its common pairs counted anew."""
    random.seed(3)
    alphabets = ["0123456789abcdef", "abc1", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789", "etaoinshr", "thehein-1/",
                 "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"]
    hits = 0
    for _ in range(400):
        string = "".join("".join(random.choices(random.choice(alphabets), k=random.randint(3, 50))) for _ in range(3))
        marked = [False] * len(string)
        for i in range(len(string) - 19):
            w = string[i:i + 20]
            kinds = Counter(S.CHARACTERS[c] for c in w)
            pairs = sum(w[j:j + 2].lower() in S.PAIRS for j in range(19))
            if entropy(w) >= S.window_threshold([kinds[k] for k in range(8)], pairs) - 1e-9:
                marked[i:i + 20] = [True] * 20
        got = [False] * len(string)
        for start, end in S.random_windows(string):
            got[start:end] = [True] * (end - start)
        assert got == marked
        hits += any(got)
    assert 50 < hits < 400


def test_many_spans_in_one_text():
    """100,000 spans: linear but for a binary search, and none of the added ones touches a base one."""
    text = ("password=hunter2x key zK8x0Qp2Lm9Rt4Vw7YbN3cHd token:zK8x0Qp2Lm9Rt4Vw7YbN3cHd " + "0a" * 14 + "\n") * 25_000
    base_spans = S.base_spans(text)
    start = time.process_time()
    added = S.entropy_spans(text, base_spans, None)
    assert time.process_time() - start < 30
    assert len(base_spans) == 75_000 and len(added) == 25_000
    small = text[:2000]
    base_spans = S.base_spans(small)
    assert all(e <= s or b >= t for b, _, e in S.entropy_spans(small, base_spans, None) for s, _, t in base_spans)


SLOW = [("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)),
        ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+"))]


def base(text):
    found = []
    for k, (kind, pattern) in enumerate(SLOW):
        for m in pattern.finditer(text):
            if {"assign": lambda: len(m.group(2)) >= 6, "access": lambda: len(m.group()) >= 20,
                "hex": lambda: len(m.group()) >= 24}[kind]():
                found.append((m.start(), k, m.end()))
    return sorted(found)


HARD = ["token:token :abcdefgh", "PassWord = 'hunter2x'", "api_key:\"abc\" apikey=abcdef ſecret=abcdefg", "AKIA" + "A" * 15,
        "AKIA" + "A" * 16, "xAKIAKIA" + "B" * 20, "f" * 23, "f" * 24, "g" + "0" * 30 + "secret=" + "a" * 30, "İtoken=abcdefgh",
        "token==" + "x" * 6, "Kelvin apiKey=123456", "a😀secret:zzzzzz", "secret\u00a0=abcdef", "key zK8x0Qp2Lm9Rt4Vw7YbN3cHd rest",
        "123e4567-e89b-12d3-a456-426614174000", "www.example.com/some/long/path/with1digit.html", ""]


def test_base_spans(texts):
    for text in HARD + [t for _, t in texts]:
        assert S.base_spans(text) == base(text), text


def test_scan(spark, odd, none):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)] + [(99, None)], "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in S.scan_secrets(docs).collect()}
    assert found[99] == [] and len(found) == len(HARD) + 1
    for i, text in enumerate(HARD):
        assert [s for s in found[i] if s[0] != "entropy"] == [(S.KINDS[k], a, b) for a, k, b in base(text)]
    at = HARD.index("key zK8x0Qp2Lm9Rt4Vw7YbN3cHd rest")
    assert found[at] == [("entropy", 4, 28)]
    assert found[at + 1] == found[at + 2] == []  # a UUID and a path
    again = {r["doc_id"]: r["spans"] for r in S.scan_secrets(docs, allow=["zK8x.*"]).collect()}
    assert again[at] == []
    assert S.scan_secrets(odd).count() == len(ROWS) and S.scan_secrets(none).count() == 0
    clean = {r["doc_id"]: r["text"] for r in S.redact(docs).collect()}
    assert clean[1] == "[secret]'" and clean[99] is None and clean[7] == "[secret]"


def test_leaders_and_rulers_end_in_time():
    """In a process of its own: with nested quantifiers the matching never ended."""
    code = ("import re; from statloom.llm import secrets as S\n"
            "allow = re.compile('|'.join(f'(?:{p})' for p in S.ALLOW))\n"
            "for text in ('Introduction' + '.' * 200 + '12', '-' * 500 + ' 7', 'a' + '_-.' * 400 + '2024',\n"
            "             'a/' * 400 + '=7', 'a.' * 50_000 + '1', 'a=' * 50_000 + '1'):\n"
            "    assert S.entropy_spans(text, [], allow) == []\n")
    root = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..")
    subprocess.run([sys.executable, "-c", code], cwd=root, timeout=60, check=True)


@pytest.mark.parametrize("alphabet", ["0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
                                      "0123456789", "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"])
@pytest.mark.parametrize("name", ["", "sig="])
def test_random_keys_of_every_alphabet(alphabet, name):
    random.seed(11)
    keys = [name + "".join(random.choices(alphabet, k=32)) for _ in range(300)]
    found = [S.entropy_spans(k, [], None) for k in keys]
    assert sum(bool(f) for f in found) >= 0.98 * len(keys)
    assert all(start >= len(name) for f in found for start, _, _ in f)


def test_words_and_numbers_are_no_keys():
    for text in ("Bundesverfassungsgericht", "bundesverfassungsgerichtlich", "AbstractSingletonProxyFactoryBean", "INTERNATIONALIZATION",
                 "internationalstandardsorganization", "2024-11-30-12.15.59.123", "+49-170-123-45-67-89-0", "00000000000000000000000"):
        assert S.entropy_spans(text, [], None) == [], text


def test_allowed_parts_do_not_hide_the_rest():
    allow = re.compile("|".join(f"(?:{p})" for p in S.ALLOW))
    key, hard = "q7Zx0Lr9Kp2Vt8Wm4Yb6Nc1D", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzLx9PpLq2Ek7Y"
    for text in (f"https://hooks.slack.com/services/T0AB12CD3/B0EF45GH6/{key}", f"https://cdn.example.com/{key}", f"src/main/resources/{key}",
                 f"/home/user/{key}.json", f"abcdefghijklmnopqrstuvwxyz{key}", f"{key}/services/index.html", f"url=//a.example.org/{key}",
                 f"123e4567-e89b-12d3-a456-426614174000/{key}", "bqzxkvjwpyrtbnmhgfdslc", "keys/bqzxkvjwpyrtbnmhgfdslc"):
        key = "bqzxkvjwpyrtbnmhgfdslc" if key not in text else key
        spans = S.entropy_spans(text, [], allow)
        at = text.index(key)
        assert any(s <= at and at + len(key) <= e for s, _, e in spans), text
    assert S.entropy_spans(hard, [], allow)[0][1:] == (3, len(hard))  # short names between slashes are not cut out
    for text in ("https://www.example.com/some/long/path/with1digit.html", "/usr/share/common-licenses/GPL3",
                 "src/main/java/AbstractSingletonProxyFactoryBean.java", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
                 "123e4567-e89b-12d3-a456-426614174000", "0123456789abcdef"):
        assert S.entropy_spans(text, [], allow) == [], text


def padded(lengths, counts, ends):
    total, at = 0, 0
    for x, n in zip(lengths, counts):
        while ends[at] < x:
            at += 1
        total += n * ends[at]
    return total


def test_boundaries_are_optimal():
    from itertools import combinations
    random.seed(5)
    for _ in range(150):
        lengths = sorted(random.sample(range(0, 60), random.randint(1, 9)))
        counts = [random.randint(1, 20) for _ in lengths]
        k = random.randint(1, 5)
        ends = optimal_boundaries(lengths, counts, k)
        assert len(ends) == min(k, len(lengths)) and ends[-1] == lengths[-1] and ends == sorted(set(ends))
        best = min(padded(lengths, counts, [*c, lengths[-1]]) for c in combinations(lengths[:-1], len(ends) - 1))
        assert padded(lengths, counts, ends) == best
    assert optimal_boundaries([], [], 4) == []


def test_boundaries_of_a_long_histogram():
    lengths = list(range(0, 40_000))
    assert len(optimal_boundaries(lengths, [1] * len(lengths), 16)) == 16


@pytest.mark.parametrize("buckets, budget", [(1, 1), (3, 40), (16, 65536)])
def test_pack(odd, none, buckets, budget):
    rows = pack(odd, buckets=buckets, budget=budget).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == Counter((i, words(t)) for i, t, _ in ROWS)
    batches = Counter((r["bucket"], r["batch"]) for r in rows)
    for bucket in {r["bucket"] for r in rows}:
        mine = [r for r in rows if r["bucket"] == bucket]
        per = max(1, budget // max(1, mine[0]["bucket_len"]))
        assert sorted((r["batch"], r["slot"]) for r in mine) == [divmod(i, per) for i in range(len(mine))]
        assert max(r["n_tokens"] for r in mine) == mine[0]["bucket_len"]
    assert all(r["padding"] == r["bucket_len"] - r["n_tokens"] >= 0 for r in rows)
    assert all(n * max(r["bucket_len"] for r in rows if (r["bucket"], r["batch"]) == b) <= budget or n == 1
               for b, n in batches.items())
    assert pack(none).count() == 0
    with pytest.raises(ValueError):
        pack(odd, budget=0)
    by_length = pack(odd.selectExpr("doc_id", "text", "length(text) AS size"), length="size")
    assert {r["n_tokens"] for r in by_length.collect()} == {len(t or "") for _, t, _ in ROWS}
