"""Parse trees against the parser's output and plain enumeration; rule
coverage of the exercise grammar."""

import random
import time
from itertools import product

import pytest
from fixtures import GRAMMAR, LEXICON, SENTENCES, TREES
from pyspark.sql import functions as F

from wordloom.operators import grammar as G
from wordloom.operators.forest import Forest, Grammar


def _rules(spark, rules=GRAMMAR):
    return spark.createDataFrame([(a, b.split()) for a, b in rules], "lhs string, rhs array<string>")


def test_trees_of_the_parser_output(spark):
    sents = spark.createDataFrame([(i + 1, s) for i, s in enumerate(SENTENCES)], "sent_id long, text string")
    lex = spark.createDataFrame(LEXICON, "word string, cat string")
    got = {r.sent_id: r for r in G.parse_trees(sents, lex, _rules(spark)).collect()}
    assert {i: r.trees for i, r in got.items()} == TREES
    assert all(r.n_parses == len(r.trees) and r.n_words == len(SENTENCES[i - 1].split()) for i, r in got.items())
    one = {r.sent_id: r for r in G.parse_trees(sents, lex, _rules(spark), k=1).collect()}
    assert one[12].trees == TREES[12][:1] and one[12].n_parses == 2


def test_awkward_sentences(spark):
    rows = [(1, "  fans   like sports "), (2, ""), (3, None), (4, "zebra"), (5, "fans zebra"), (None, "fans like sports"), (1, "fans like sports")]
    sents = spark.createDataFrame(rows, "sent_id long, text string").withColumn("words", F.lit(1)).withColumn("w", F.lit("x"))
    lex = spark.createDataFrame([*LEXICON, *LEXICON, (None, "Noun"), ("fans", None)], "word string, cat string")
    got = {r.sent_id: (r.n_words, r.n_parses) for r in G.parse_trees(sents.filter("sent_id is null or sent_id > 1"), lex, _rules(spark)).collect()}
    assert got == {4: (1, 0), 5: (2, 0), None: (3, 1)}
    assert G.chart_parse(sents.limit(0), lex, _rules(spark)).count() == 0
    assert G.parse_trees(sents.filter("sent_id = 5"), lex.limit(0), _rules(spark)).first().trees == []
    assert G.chart_parse(sents.filter("sent_id = 4"), lex, _rules(spark, [("S", "S")]).limit(0)).first().n_parses == 0


def plain_trees(rules, words, sym, i, j):
    """[(cost, tree)] by plain recursion over all splits."""
    out = []
    for lhs, rhs, cost in rules:
        if lhs != sym:
            continue
        for cuts in product(range(i + 1, j), repeat=len(rhs) - 1):
            ends = [i, *cuts, j]
            if all(a < b for a, b in zip(ends, ends[1:])):
                for parts in product(*[plain_trees(rules, words, s, a, b) for s, a, b in zip(rhs, ends, ends[1:])]):
                    out.append((cost + sum(c for c, _ in parts), f"({sym} {' '.join(t for _, t in parts)})"))
    if j == i + 1 and sym in words[i][1]:
        out.append((0.0, f"({sym} {words[i][0]})"))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_forest_against_enumeration(seed):
    """Random grammars with one to three symbols a side and costs: the number
    of trees, all trees, their costs in order, and any k of them."""
    rng = random.Random(seed)
    names = "SABC"
    rules = {}
    for _ in range(9):
        lhs = rng.choice(names)
        size = rng.choice([1, 2, 2, 2, 3])
        low = [x for x in "ABCxy" if size > 1 or x > lhs]  # one-symbol rules only go down: no cycle
        rules[lhs, tuple(rng.choice(low if size == 1 else "ABCSxy") for _ in range(size))] = float(rng.randrange(3))
    rules = sorted((a, b, c) for (a, b), c in rules.items())
    words = [(f"w{i}", rng.sample(["x", "y", "A", "B"], rng.randrange(1, 4))) for i in range(6)]
    g = Grammar(rules, "S")
    want = sorted(plain_trees(rules, words, "S", 0, 6))
    n, trees = g.parse(words, 10**6)
    assert n == len(want) == len(trees) and sorted(trees) == sorted(t for _, t in want)
    cost = dict((t, c) for c, t in want)
    assert [cost[t] for t in trees] == [c for c, _ in want]
    for k in (0, 1, 3):
        assert g.parse(words, k) == (n, trees[:k])


def test_cycles_and_overflow():
    for cycle in ([("A", ("A",), 0.0)], [("A", ("B",), 0.0), ("B", ("C",), 0.0), ("C", ("A",), 0.0)]):
        with pytest.raises(ValueError):
            Grammar(cycle, "A")
    g = Grammar([("S", ("S", "S"), 0.0)], "S")
    assert g.parse([("w", ["S"])] * 30, 0)[0] == 1002242216651368  # Catalan number 29
    with pytest.raises(OverflowError):
        g.parse([("w", ["S"])] * 60, 0)


def test_long_sentences():
    """A sentence of 800 words is parsed whole; a right-branching one as deep as it is long."""
    g = Grammar(sorted([("S", ("W", "S"), 0.0), ("S", ("W",), 0.0)]), "S")
    t0 = time.time()
    n, trees = g.parse([("w", ["W"])] * 800, 2)
    assert n == 1 and trees[0].count("(W w)") == 800 and time.time() - t0 < 60
    assert len(Forest(g, [("w", ["W"])] * 300).row[0]["S"].to_bytes(64, "little")) == 64


def test_rule_coverage(spark):
    lex = spark.createDataFrame(LEXICON, "word string, cat string")
    rules = _rules(spark, [*GRAMMAR, ("X", "Noun Verb"), ("Y", "Y Noun"), ("S", "Y"), ("X", "X Noun"), ("Z", "X")])
    got = {(r.lhs, " ".join(r.rhs)): (r.productive, r.reachable, r.usable) for r in G.rule_coverage(rules, lex).collect()}
    assert got.pop(("S", "Aux NP VP")) == (False, True, False)  # no word is an auxiliary
    assert got.pop(("S", "Y")) == (False, True, False) and got.pop(("Y", "Y Noun")) == (False, False, False)
    for dead in (("X", "Noun Verb"), ("X", "X Noun"), ("Z", "X")):
        assert got.pop(dead) == (True, False, False)
    assert set(got.values()) == {(True, True, True)} and len(got) == len(GRAMMAR) - 1
    assert G.rule_coverage(rules.limit(0), lex).count() == 0
    assert {r.productive for r in G.rule_coverage(rules, lex.limit(0)).collect()} == {False}
