"""Exact dedup by block naming against a plain version: every awkward case,
block borders, colliding keys, large groups and empty tables."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wordloom.llm.common import lookup, text_keys
from wordloom.llm.exact_dedup import exact_dedup

WHITE = " \t\n\x0b\f\r"


def norm(text):
    return (text or "").translate({ord(c): None for c in WHITE})


def plain(rows):
    """Multiset of (id, keep_id, group_size, kept, sha) of (id, text) rows."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[norm(text)].append((-len(text or ""), i is None, i or 0, i))
    out = Counter()
    for t, members in groups.items():
        members.sort(key=lambda m: m[:3])
        sha = hashlib.sha256(t.encode()).hexdigest()
        for n, m in enumerate(members):
            out[m[3], members[0][3], len(members), n == 0, sha] += 1
    return out


def found(df, **options):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(df, **options).collect())


@pytest.mark.parametrize("block_bytes", [64, 1024])
def test_awkward(awkward, block_bytes):
    want = plain([(r.doc_id, r.text) for r in awkward.collect()])
    assert found(awkward, block_bytes=block_bytes) == want
    assert max(k[2] for k in want) > 2


def test_block_borders(spark):
    """Texts that differ in one byte, in length by one, in the place of a
    multi-byte character across a border, or in the order of blocks."""
    base = "abcdefgh" * 5
    texts = [base, base[:-1], base + "a", "b" + base[1:], base[:19] + "é" + base[20:], base[:20] + "é" + base[21:],
             base[8:16] + base[:8], base[:16] + " " + base[16:], " " + base + "\n\n", " " + base, base.upper(),
             "abcdefgh", "abcdefgha", "", None, "\x00", "abcdefgh" * 4, "abcdefgh" * 8]
    rows = [(i, t) for i, t in enumerate(texts * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df, block_bytes=8) == plain(rows)
    assert found(df, block_bytes=7) == plain(rows)


def test_colliding_keys(spark):
    """Keys that don't tell blocks apart are noticed and replaced."""
    tried = []

    def weak(col, salt):
        tried.append(salt)
        return text_keys(col, salt) if salt == 2 else [F.xxhash64(col) % 2, F.lit(salt).cast("long")]

    rows = [(i, f"text {i % 20} " * 10) for i in range(60)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=16, keys=weak) == plain(rows)
    assert set(tried) == {0, 1, 2}


def test_hot_group(spark):
    """A third of all rows are one text; ties go to the smallest id."""
    rows = [(i, ("the same text " * 50) if i % 3 == 0 else f"own text {i} " * (i % 40)) for i in range(3000)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), block_bytes=32) == plain(rows)


def test_columns(spark, nothing):
    df = spark.createDataFrame([(1, "a b", "x", 3), (2, "ab", "y", 4)],
                               "doc_id long, text string, `kept` string, `_row` long").withColumn("a.b", F.lit(1))
    out = exact_dedup(df)
    assert out.columns == ["doc_id", "text", "_row", "a.b", "keep_id", "group_size", "kept", "text_sha256"]
    assert {(r.doc_id, r.text, r._row, r.keep_id, r.kept) for r in out.collect()} == {(1, "a b", 3, 1, True), (2, "ab", 4, 1, False)}
    assert exact_dedup(nothing).count() == 0
    assert "text" not in exact_dedup(nothing, drop=("text",)).columns


def test_lookup_is_the_inner_join(spark):
    rows = spark.createDataFrame([(i, 0 if i % 2 else i % 50) for i in range(500)], "i long, k long")
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("top")).filter("k <> 4")
    want = rows.join(table.drop("n"), "k")
    for share in (1, 10, 10_000):
        got = lookup(rows, table, ["k"], "n", 500, share)
        assert Counter(got.select(*want.columns).collect()) == Counter(want.collect())


def test_native_plan(spark, awkward):
    plan = exact_dedup(awkward)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan
