"""N-gram Jaccard self-join with token-combination prefixes.

Two documents link when the Jaccard similarity of their sets of word
shingles reaches a threshold; the operator returns the connected components.

Method.  Tokens (64-bit shingle hashes) are ordered: rare ones first, then
frequent ones, by hash inside both.  A set of n tokens needs an overlap of at
least ``need(n)`` with any partner, so at most n - need(n) of its tokens are
unshared.  A prefix normally has one token more than that and is indexed by
single tokens.  Frequent tokens would make long lists, so they are put into
classes and only pairs of tokens of one class are indexed; the prefix is
extended until sum(rare) + sum over classes of (tokens - 1) reaches the same
count, which still forces two similar sets to share an index key: either a
rare token, or two frequent tokens of one class (sets too small for that are
indexed by their single frequent tokens as well).  The number of classes grows
with the set's size (by powers of two; a set is indexed on every level that a
smaller partner could use), so the number of pairs stays proportional to it.
Keys carry how many tokens come before and must be unshared if the key is the
first that two sets share; that bounds the overlap, and most candidates end
there.

Plan.
1. Equal sets collapse to one node (map-side combined): a group of copies is
   one row from here on.
2. Each node keeps only a window of the first tokens by hash (some more than
   a tenth of the set at a threshold of 0.9), all that most nodes ever need.
   Tokens that more than ``frequent`` windows hold are frequent.  Nodes
   whose window has fewer rare tokens than a prefix are looked at whole, and tokens frequent
   among them are frequent too.
3. Per key, one node is the pivot and every other one is compared with it:
   one row per key and node, however large the list.  The linked nodes are
   contracted to components.
4. What is left are pairs in one list but in different components.  They
   must share a minimum of keys (all prefix tokens but those they may lose);
   all that do are compared, so no link between different texts is lost.
All tables are written to the shared folder; components are contracted with
the alternating star method, without collecting anything.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import broadcast_if_small, list_array, map_texts, written

#: Words a task remembers.
CACHE = 200_000


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE:
            self[word] = h
        return h


def shingles(text: str | None, k: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a text; of the
    whole sequence if there are fewer words; empty without words."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    width = min(k, len(h))
    m = len(h) - width + 1
    out = np.full(m, width, np.uint64)
    for i in range(width):
        out = (out ^ h[i:m + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out * np.uint64(0xD6E8FEB86659FD93))


class Rule:
    """Exact integer arithmetic for a Jaccard threshold a / b."""

    def __init__(self, threshold: float):
        f = Fraction(str(threshold))
        if not 0 < f <= 1:
            raise ValueError("the threshold must be above 0 and at most 1")
        self.a, self.b = f.numerator, f.denominator

    def prefix(self, n: int) -> int:
        """One more than the tokens that a set of n may leave unshared."""
        return n - -(-self.a * n // self.b) + 1

    def window(self, n: int) -> int:
        """Tokens kept of a set of n: the prefix and some to replace the
        frequent tokens in it."""
        p = self.prefix(n)
        return min(n, p + 8 + p // 8) if self.can_link(n) else 0

    def can_link(self, n: int) -> bool:
        """Whether a set of n tokens can link to a different set at all."""
        return self.a * (n + 1) <= self.b * n or self.a * n <= self.b * (n - 1)

    def smallest(self, n: int) -> int:
        """The size of the smallest possible partner."""
        return -(-self.a * n // self.b)


def level(n: int) -> int:
    return n.bit_length() - 1


def classes_of(lv: int) -> int:
    return max(1, (1 << lv) >> 4)


def keys_of(tokens: np.ndarray, is_frequent: np.ndarray, rule: Rule) -> list[tuple[int, int]]:
    """(key, place) of a set's index keys.  ``tokens`` are sorted by hash; the
    order is rare ones first.  If the key is the first that two sets share,
    ``place`` tokens of the set are certainly unshared."""
    import xxhash

    n = len(tokens)
    if not rule.can_link(n):
        return []
    rare, often = tokens[~is_frequent], tokens[is_frequent]
    want = rule.prefix(n)
    out = [(_signed(int(t)), i) for i, t in enumerate(rare[:want])]
    if len(rare) >= want:
        return out
    short = False
    for lv in sorted({level(m) for m in (rule.smallest(n), n)} | set(range(level(rule.smallest(n)), level(n)))):
        groups: dict[int, list[tuple[int, int]]] = {}
        count, c = len(rare), classes_of(lv)
        for i, t in enumerate(often):
            if count >= want:
                break
            group = groups.setdefault((int(t) >> 7) % c, [])
            count += bool(group)
            group.append((i, int(t)))
        short |= count < want
        for group in groups.values():
            for x, (before, t) in enumerate(group):
                # before t, each other class can hide one shared token that no pair shows
                place = len(rare) + max(0, before - (c - 1))
                for _, u in group[x + 1:]:
                    out.append((_signed(xxhash.xxh3_64_intdigest(b"%d %d %d" % (lv, t, u))), place))
    if short:  # so few tokens must be shared that no two of a class need be among them
        out += [(_signed(xxhash.xxh3_64_intdigest(b"%d" % int(t))), len(rare) + i) for i, t in enumerate(often)]
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b): root is
    the smallest node reachable.  Alternating large-star and small-star
    rounds; each only takes a minimum per node and joins it back."""
    now = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        # every edge hangs below its larger end: its neighbours move to the smallest of them
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(down, "b")
                 .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")),
                                           F.struct(F.col("m").alias("a"), F.col("b").alias("b")))).alias("e"))
                 .select("e.a", "e.b").filter("a < b").distinct())
        new = written(small)
        if new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() == now.agg(
                F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first():
            now = new
            break
        now = new
    else:
        raise RuntimeError("components did not settle")
    roots = now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                       threshold: float = 0.9, frequent: int = 32) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a document's
    set is its distinct k-word shingles, with fewer words the whole sequence
    as one shingle, without words or text nothing.  Documents link when
    intersection / union is at least ``threshold``, and ``component_id`` is
    the smallest id reachable by links, itself included.  Empty sets link
    with nothing.  Rows that share an id are one node: they share their
    links.  Rows with a null id link with nothing and get a null component.
    ``frequent`` only moves work between single and combined keys; the
    result doesn't depend on it.  Other columns are ignored.  Shingles are
    compared by 64-bit hashes.
    """
    rule = Rule(threshold)

    def sketch():
        words = WordHashes()

        def step(texts):
            sets = [shingles(t, k, words) for t in texts]
            sizes = [len(s) for s in sets]
            keep = [rule.window(n) for n in sizes]
            marks = [_digest(s) for s in sets]
            return [sizes, [m[0] for m in marks], [m[1] for m in marks],
                    list_array(np.concatenate([np.zeros(0, np.uint64), *(s[:w] for s, w in zip(sets, keep))]).view(np.int64),
                               keep, pa.int64())]
        return step

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    fields = [T.StructField("n", T.LongType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()),
              T.StructField("window", T.ArrayType(T.LongType()))]
    sketches = written(map_texts(slim, "text", fields, sketch, drop=("text",)))
    members = sketches.filter("n > 0 and id is not null").select("id", "n", "s1", "s2")
    if members.groupBy("id").count().filter("count > 1").limit(1).count():  # rows that share an id: each text once
        slim = slim.dropDuplicates(["id", "text"])
    nodes = written(members.groupBy("s1", "s2", "n").agg(F.min("id").alias("node")))
    # a node's window is read from the row of its smallest id; equal rows of that id collapse
    windows = (sketches.filter("size(window) > 0").join(nodes.withColumnRenamed("node", "id"), ["s1", "s2", "n", "id"])
               .select(F.col("id").alias("node"), "n", "s1", "s2", "window").dropDuplicates(["node", "s1", "s2"]))
    windows = written(windows)
    entries = windows.select("node", "s1", "n", F.posexplode("window").alias("place", "token"))
    want = (F.col("n") - F.ceil(F.col("n") * F.lit(rule.a) / F.lit(rule.b)) + 1).cast("long")
    spare = F.least(F.col("n") - want, 8 + F.floor(want / 8))  # more frequent tokens leave a window too few rare ones

    # step 2: frequent tokens
    lists = written(entries.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"))
    often = lists.filter(F.col("df") > frequent).select("token")
    hits = entries.join(broadcast_if_small(often, 200_000), "token").groupBy("node", "s1", "n").count()
    heavy = written(hits.filter(F.col("count") > spare).select("node").distinct())
    heavy_sets = written(_sets(slim, heavy, k))
    often2 = heavy_sets.select(F.explode("tokens").alias("token")).groupBy("token").count().filter(
        F.col("count") > frequent).select("token")
    often = written(often.unionByName(often2).distinct())
    often_side = broadcast_if_small(often, 200_000)
    skips = entries.join(often_side, "token").groupBy("node", "s1", "n").agg(F.sort_array(F.collect_list("place")).alias("skip"))
    skips = written(skips)  # at most a window's places per node
    whole = written(skips.filter(F.size("skip") > spare).select("node").distinct())
    more_sets = _sets(slim, written(whole.join(heavy, "node", "left_anti")), k)  # the heavy ones are there already
    whole_sets = heavy_sets.unionByName(written(more_sets))

    # index keys of the nodes looked at whole
    flags = (whole_sets.select("node", "s1", F.posexplode("tokens").alias("at", "token")).join(often_side, "token")
             .groupBy("node", "s1").agg(F.collect_list("at").alias("often")))
    whole_keys = written(_whole_keys(whole_sets.join(flags, ["node", "s1"], "left"), rule))
    # and of the others: the first rare tokens of the window, as far as another list can hold them
    shared_tokens = written(lists.select("token").join(often, "token", "left_anti")
                            .unionByName(whole_keys.select(F.col("key").alias("token"))).distinct())
    skipped = F.coalesce(F.size(F.filter("skip", lambda x: x < F.col("place"))), F.lit(0))
    plain = (windows.join(broadcast_if_small(whole, 200_000), "node", "left_anti")
             .join(broadcast_if_small(skips, 200_000), ["node", "s1", "n"], "left")
             .select("node", "n", "skip", F.posexplode("window").alias("place", "token"))
             .withColumn("place", F.col("place") - skipped).filter(F.col("place") < want)
             .select("token", "node", (F.shiftleft("n", 32) + F.col("place")).alias("np"))  # narrow rows: most end here
             .join(shared_tokens, "token")
             .select(F.col("token").alias("key"), "node", F.shiftright("np", 32).alias("n"),
                     F.col("np").bitwiseAND(F.lit((1 << 32) - 1)).alias("place"), F.lit(False).alias("whole")))
    index = written(plain.unionByName(whole_keys.select("key", "node", "n", "place", F.lit(True).alias("whole"))))

    # step 3: one pivot per key, the node with the earliest place (it has the fewest tokens of its own)
    pivots = written(index.groupBy("key").agg(F.count("*").alias("c"), F.min(F.struct("place", "node", "n")).alias("p"))
                     .filter("c > 1").select("key", "p"))
    stars = (index.join(pivots, "key").filter("node <> p.node")
             .select(F.col("p.node").alias("x"), F.col("p.n").alias("nx"), F.col("p.place").alias("px"),
                     F.col("node").alias("y"), F.col("n").alias("ny"), F.col("place").alias("py"))
             .filter(_sizes_fit(rule) & _places_fit(rule, F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))))
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a < b").distinct())
    first = written(_verified(slim, stars, k, rule))
    roots = components(first.filter("linked").select("a", "b"))

    # step 4: pairs in one list that are still in different components
    rooted = (index.join(pivots.select("key"), "key")
              .join(broadcast_if_small(roots, 200_000).withColumnRenamed("root", "r"), "node", "left")
              .withColumn("r", F.coalesce("r", "node")))
    rooted = written(rooted)
    mixed = rooted.groupBy("key").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).filter("lo < hi").select("key")
    open_ = rooted.join(mixed, "key")
    side = lambda x: open_.select("key", F.col("node").alias(x), F.col("n").alias(f"n{x}"),
                                  F.col("place").alias(f"p{x}"), F.col("r").alias(f"r{x}"), F.col("whole").alias(f"w{x}"))
    bound = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))
    combined = F.col("wx") | F.col("wy")
    # with a combined key one row that fits is enough; plain ones are counted first
    pairs = (side("x").join(side("y"), "key").filter("x < y and rx <> ry")
             .filter(_sizes_fit(rule) & (~combined | _places_fit(rule, bound)))
             .groupBy("x", "y", "nx", "ny").agg(
                 F.count("*").alias("shared"), F.max(combined).alias("combined"), F.max(bound).alias("most")))
    # two plain nodes must share all but the tokens they may lose of the shorter prefix
    need = F.ceil((F.col("nx") + F.col("ny")) * F.lit(rule.a) / F.lit(rule.a + rule.b))
    least = need - F.ceil(F.greatest("nx", "ny") * F.lit(rule.a) / F.lit(rule.b)) + 1
    rest = (pairs.filter(_places_fit(rule, F.col("most"))).filter(F.col("combined") | (F.col("shared") >= least))
            .select(F.col("x").alias("a"), F.col("y").alias("b")).join(first.select("a", "b"), ["a", "b"], "left_anti"))
    second = written(_verified(slim, rest, k, rule)).filter("linked").select("a", "b")
    final = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(second))
    return _answer(sketches, nodes, final, id_col)


def _digest(s: np.ndarray) -> tuple[int, int]:
    import xxhash

    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _sets(slim: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, s1, n, tokens): the whole sets of the given distinct nodes, from
    their texts."""
    def make():
        words = WordHashes()

        def step(texts):
            sets = [shingles(t, k, words) for t in texts]
            sizes = [len(s) for s in sets]
            return [[_digest(s)[0] for s in sets], sizes, list_array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64), sizes, pa.int64())]
        return step

    wanted = broadcast_if_small(nodes, 200_000)
    texts = slim.join(wanted, slim["id"] == wanted["node"]).select("node", "text")
    fields = [T.StructField("s1", T.LongType()), T.StructField("n", T.LongType()),
              T.StructField("tokens", T.ArrayType(T.LongType()))]
    return map_texts(texts, "text", fields, make, drop=("text",)).filter("n > 0")


def _whole_keys(sets: DataFrame, rule: Rule) -> DataFrame:
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                node, n, key, place = [], [], [], []
                for row in part.to_pylist():
                    tokens = np.array(row["tokens"], np.int64).view(np.uint64)
                    frequent = np.zeros(len(tokens), bool)
                    frequent[row["often"] or []] = True
                    for key_, place_ in keys_of(tokens, frequent, rule):
                        node.append(row["node"])
                        n.append(row["n"])
                        key.append(key_)
                        place.append(place_)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (node, n, key, place)],
                                                 names=["node", "n", "key", "place"])

    return sets.select("node", "n", "tokens", "often").mapInArrow(run, "node long, n long, key long, place long")


def _sizes_fit(rule: Rule):
    return F.lit(rule.a) * F.greatest("nx", "ny") <= F.lit(rule.b) * F.least("nx", "ny")


def _places_fit(rule: Rule, most):
    """Whether an overlap of at most ``most`` allows the threshold."""
    return F.lit(rule.a + rule.b) * most >= F.lit(rule.a) * (F.col("nx") + F.col("ny"))


def _verified(slim: DataFrame, pairs: DataFrame, k: int, rule: Rule) -> DataFrame:
    """(a, b, linked) by the exact similarity of the whole sets."""
    pairs = written(pairs)
    sets = written(_sets(slim, written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), k))
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                linked = []
                for x, y in zip(part.column("ta"), part.column("tb")):
                    u, v = x.values.to_numpy(), y.values.to_numpy()
                    both = len(np.intersect1d(u, v, assume_unique=True))
                    linked.append(rule.b * both >= rule.a * (len(u) + len(v) - both))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(linked, pa.bool_())],
                                                 names=["a", "b", "linked"])

    schema = T.StructType([pairs.schema["a"], pairs.schema["b"], T.StructField("linked", T.BooleanType())])
    return (pairs.join(right, "b").join(left, "a").mapInArrow(run, schema)
            .groupBy("a", "b").agg(F.max("linked").alias("linked")))


def _answer(sketches: DataFrame, nodes: DataFrame, roots: DataFrame, id_col: str) -> DataFrame:
    # rows that share an id but not the text tie their sets together as well
    ties = (sketches.filter("n > 0 and id is not null").select("id", "s1", "s2", "n").distinct()
            .join(nodes, ["s1", "s2", "n"]).select("id", "node"))
    twice = ties.groupBy("id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
    extra = written(twice.join(ties, "id").select(F.col("lo").alias("a"), F.col("node").alias("b")).filter("a < b"))
    if extra.limit(1).count():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(extra))
    by_set = nodes.join(roots, "node", "left").select("s1", "s2", "n", F.coalesce("root", "node").alias("root"))
    return (sketches.select("id", "n", "s1", "s2").join(by_set, ["s1", "s2", "n"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id")))
