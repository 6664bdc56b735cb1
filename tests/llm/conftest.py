import pytest

# Nulls everywhere, empty and blank texts, ties, repeated rows, a very long text, names that operators use themselves.
ROWS = [
    (1, "alpha beta gamma delta epsilon\nshared line of text\nend", "a"),
    (2, "shared line of text\nother words here\n\n", "b"),
    (3, None, "a"), (4, "", None), (5, "   \t\n", "b"),
    (6, "one two three four five six seven eight nine ten eleven twelve", "a"),
    (7, "one two three four five six seven eight nine ten eleven twelve", "c"),
    (7, "one two three four five six seven eight nine ten eleven twelve", "c"),
    (None, "one two three four five six seven eight nine ten eleven twelve", None),
    (None, "SHARED line of text  ", "b"),
    (8, "word " * 30_000, "c"), (9, "ünïcödé 😀 text " * 3, "a"),
]
NAMES = "doc_id long, text string, source string"
CLASHES = """id row digest size key n_lines bucket host seal label node toxic shard score weight words hits bytes place block
gone_id gone_seal dropped made stay_id stay_digest own_id own_digest own_seal kept_id kept_seal mix_id mix_seal copies copy
shard_id asked_url best_rule made_host made_path made_rule made_verdict picked _gone_id _dropped _done _stay_id _kept_id _mix_id
_copies _copy _url _host _path _rule _verdict _best _shard_id _label_id""".split()


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with extra columns that clash with names used inside."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ROWS, NAMES)
    return df.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def texts(spark):
    """All documents of the smallest folder as (doc_id, text), in order."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return sorted((r[0], r[1]) for r in rows)
