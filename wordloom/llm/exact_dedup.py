"""Exact dedup by deterministic block naming, in built-in functions only.

Every text, without ASCII white space, is cut into blocks of a fixed number
of bytes.  The distinct blocks of the corpus are sorted (by a hash, which
deals them evenly, and their bytes) and named by their place, an integer; then adjacent names of a document are taken in pairs,
the distinct pairs are sorted and named the same way, and so on until every
document has one name.  Two documents have the same name after the same
number of rounds exactly if their normalised texts are equal: each round
names equal things equally and different things differently.

Plan: texts are shuffled twice, to find the distinct blocks (combined in the
tasks first, so that a block that a third of all documents hold leaves each
task once) and to sort them; afterwards only names move.  An occurrence
finds its block's name by a pair of 64-bit hashes, which are checked to be
different for all distinct blocks (another salt is taken if not), so no
collision is possible.  A document's names are rows, never one value; the
number of rounds is the logarithm of the longest document's blocks, and a
document leaves the rounds when one name is left.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.columns import explode_rows, posexplode_rows
from wordloom.llm.common import WHITE, lookup, text_keys, written

RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def without_white(text: Column) -> Column:
    """The text without ASCII white space; null is empty."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), WHITE, F.coalesce(text, F.lit("")))


def _cut(docs: DataFrame, text_col: str, block_bytes: int) -> DataFrame:
    """``docs`` with ``_body`` (normalised bytes) and ``_blocks`` (at least
    one; the last may be shorter, and is empty for an empty text)."""
    bodies = docs.withColumn("_body", without_white(F.col(text_col)).cast("binary"))
    starts = F.sequence(F.lit(1), F.greatest(F.octet_length("_body"), F.lit(1)), F.lit(block_bytes))
    return bodies.withColumn("_blocks", F.transform(starts, lambda at: F.col("_body").substr(at, F.lit(block_bytes))))


def _named(distinct: DataFrame, order: list[str], keep: list[str], ranges: int) -> DataFrame:
    """Distinct things sorted over the whole cluster and named by their place:
    the partition of the sort and the row in it.  The first ``ranges`` columns
    of the order deal the partitions (their sample goes to the driver)."""
    return written(distinct.repartitionByRange(*order[:ranges]).sortWithinPartitions(*order)
                   .select(*keep, "_count", F.monotonically_increasing_id().alias("_name")))


def name_blocks(docs: DataFrame, text_col: str, block_bytes: int,
                keys: Callable[[Column, int], list]) -> tuple[DataFrame, int]:
    """``(_k1, _k2, _count, _name)`` of every distinct block, and the salt
    whose keys tell them all apart."""
    for salt in count():
        blocks = explode_rows(_cut(docs.select(text_col), text_col, block_bytes), [], F.col("_blocks"), "_block")
        k1, k2 = keys(F.col("_block"), salt)
        distinct = blocks.groupBy(k1.alias("_k1"), k2.alias("_k2"), "_block").agg(F.count("*").alias("_count"))
        names = _named(distinct, ["_k1", "_block"], ["_k1", "_k2"], 1)
        if names.groupBy("_k1", "_k2").count().filter("count > 1").limit(1).count() == 0:
            return names, salt


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 1024,
                drop: tuple[str, ...] = (), keys: Callable[[Column, int], list] = text_keys) -> DataFrame:
    """One row per input row: its columns (but ``drop``) and ``keep_id``,
    ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are after deleting every ASCII white-space
    character; a null text is empty.  Of equal texts the row with the most
    code points in its original text stays, of these the smallest id (null
    last); rows that still tie (repeated rows) leave one of them.
    ``keep_id`` is the id of the row that stays, ``kept`` whether it is this
    row, ``text_sha256`` the digest of the normalised text in hexadecimal.
    Whole texts of any length are read.  An input column named like a result
    column is replaced.  An empty table gives an empty result.
    """
    names, salt = name_blocks(docs, text_col, block_bytes, keys)
    out = [c for c in docs.columns if c.lower() not in RESULT and c not in drop]
    cut = _cut(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in"), F.col(text_col).alias("_text")), "_text", block_bytes)
    rows = written(cut.select(
        F.monotonically_increasing_id().alias("_row"), F.struct(*[f"_in.`{c}`" for c in out]).alias("_in"),
        F.col(f"_in.`{id_col}`").alias("_id"), F.coalesce(F.length("_text"), F.lit(0)).alias("_points"),
        F.sha2("_body", 256).alias("text_sha256"),
        F.transform("_blocks", lambda b: F.struct(*[k.alias(f"_k{i}") for i, k in enumerate(keys(b, salt), 1)])).alias("_keys")))
    most, total = rows.agg(F.max(F.size("_keys")), F.sum(F.size("_keys"))).first()
    at = posexplode_rows(rows, ["_row", F.size("_keys").alias("_left")], F.col("_keys"), "_pos", "_key")
    named = lookup(at.select("_row", "_left", "_pos", "_key.*"), names, ["_k1", "_k2"], "_count", total or 0)
    done, level = [], 0
    while True:
        done.append(named.filter("_left = 1").select("_row", F.lit(level).alias("_level"), "_name"))
        if (most or 0) <= 1:
            break
        even = F.col("_pos") % 2 == 0
        pairs = written(named.filter("_left > 1").groupBy("_row", F.shiftright("_pos", 1).alias("_pos")).agg(
            F.shiftright(F.max("_left") + 1, 1).alias("_left"), F.max(F.when(even, F.col("_name"))).alias("_a"),
            F.coalesce(F.max(F.when(~even, F.col("_name"))), F.lit(-1)).alias("_b")))
        names = _named(pairs.groupBy("_a", "_b").agg(F.count("*").alias("_count")), ["_a", "_b"], ["_a", "_b"], 2)
        named = lookup(pairs, names, ["_a", "_b"], "_count", pairs.count())
        most, level = (most + 1) // 2, level + 1
    found = written(reduce(DataFrame.unionByName, done).join(rows.drop("_keys"), "_row"))
    first = F.min(F.struct(-F.col("_points"), F.col("_id").isNull(), "_id", "_row")).alias("_first")
    groups = written(found.groupBy("_level", "_name").agg(F.count("*").alias("_count"), first)
                     .select("_level", "_name", "_count", F.col("_count").alias("group_size"),
                             F.col("_first._id").alias("keep_id"), F.col("_first._row").alias("_keep")))
    return (lookup(found, groups, ["_level", "_name"], "_count", found.count())
            .select("_in.*", "keep_id", "group_size", (F.col("_row") == F.col("_keep")).alias("kept"), "text_sha256"))
