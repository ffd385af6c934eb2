"""Word vectors against numpy brute force; parse counts against the
reference's parser output."""

import numpy as np
import pytest
from fixtures import CNF_GRAMMAR, CNF_LEXICON, GRAMMAR, LEXICON, SENTENCES
from pyspark.sql import functions as F

from wordloom.operators import grammar as G
from wordloom.operators import vectors as VE


def _vectors(spark, n=60, d=8, seed=3):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d))
    rows = [(str(i), [float(x) for x in m[i]]) for i in range(n)]
    return m, spark.createDataFrame(rows, "word string, vector array<double>")


def test_nearest_words_blocks_match_brute_force(spark):
    m, vec = _vectors(spark)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    qs = [(i, [float(x) for x in (u[i + 1] + u[i + 2] - u[i]) / 3], [str(i), str(i + 1), str(i + 2)])
          for i in range(20)]
    q = spark.createDataFrame(qs, "qid long, qvec array<double>, exclude array<string>")
    got = VE.nearest_words(q, vec, k=3, query_block=4, candidate_block=7).toPandas()
    for qid, qv, ex in qs:
        qn = np.array(qv) / np.linalg.norm(qv)
        sims = u @ qn
        order = [j for j in np.argsort(-sims, kind="stable") if str(j) not in ex][:3]
        mine = got[got.qid == qid].sort_values("rank")
        assert list(mine.word) == [str(j) for j in order]
        assert np.allclose(mine.similarity.values, sims[order])


def test_analogies_and_accuracy(spark):
    m, vec = _vectors(spark, n=30)
    q = spark.createDataFrame([(i, "s" + str(i % 2), str(i), str(i + 1), str(i + 2), str(i + 3))
                               for i in range(10)] + [(99, "empty", "x", "y", "z", "w")],
                              "qid long, section string, a string, b string, c string, d string")
    res = VE.solve_analogies(q, vec)
    assert res.filter("qid = 99").count() == 0  # unknown words are skipped
    acc = {r.section: r for r in VE.analogy_accuracy(res).collect()}
    assert acc["Total"].n_correct + acc["Total"].n_incorrect == 10
    assert "empty" not in acc


def test_most_similar_and_pairs(spark):
    m, vec = _vectors(spark, n=40)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    top = VE.most_similar(vec, ["1", "2"], ["0"], 5).toPandas()
    qv = (u[1] + u[2] - u[0]) / 3
    sims = u @ (qv / np.linalg.norm(qv))
    order = [j for j in np.argsort(-sims) if j not in (0, 1, 2)][:5]
    assert list(top.word) == [str(j) for j in order]
    pairs = spark.createDataFrame([("0", "1", 1.0), ("2", "3", 2.0), ("4", "5", 3.0), ("6", "nope", 4.0)],
                                  "w1 string, w2 string, score double")
    ev = VE.word_pair_eval(pairs, vec).first()
    assert ev.n_pairs == 3 and ev.oov_ratio == 25.0
    cos = [float(u[a] @ u[b]) for a, b in ((0, 1), (2, 3), (4, 5))]
    assert abs(ev.pearson - np.corrcoef([1, 2, 3], cos)[0, 1]) < 1e-9


def test_word2vec_and_projection(spark):
    sents = spark.createDataFrame([(["a", "b", "c", "a", "b"],)] * 20, "tokens array<string>")
    v = VE.word2vec_fit(sents, vector_size=4, min_count=1, num_partitions=1)
    assert v.count() == 3 and all(len(r.vector) == 4 for r in v.collect())
    with pytest.raises(ValueError):
        VE.word2vec_fit(sents, sg=0)
    _, vec = _vectors(spark, n=12)
    p = VE.project_2d(vec)
    assert p.count() == 12 and set(p.columns) == {"word", "x", "y"}


def _grammar(spark, rules):
    return spark.createDataFrame([(a, b.split()) for a, b in rules], "lhs string, rhs array<string>")


def test_chart_parse_reproduces_parser_counts(spark):
    sents = spark.createDataFrame([(i + 1, s) for i, s in enumerate(SENTENCES)], "sent_id long, text string")
    lex = spark.createDataFrame(LEXICON, "word string, cat string")
    res = G.chart_parse(sents, lex, _grammar(spark, GRAMMAR))
    got = {r.sent_id: r.n_parses for r in res.collect()}
    assert got == {i: (2 if i in (1, 12) else 1) for i in range(1, 16)}
    stats = {r.n_parses: r.n_sentences for r in G.parse_statistics(res).collect()}
    assert stats == {1: 13, 2: 2}


def test_chart_parse_normal_form_example(spark):
    sents = spark.createDataFrame([(1, "students solve problems with AI")], "sent_id long, text string")
    lex = spark.createDataFrame(CNF_LEXICON, "word string, cat string")
    res = G.chart_parse(sents, lex, _grammar(spark, CNF_GRAMMAR)).first()
    assert res.n_parses == 2


def test_lexicon_sets_and_coverage(spark):
    lex = spark.createDataFrame(LEXICON, "word string, cat string")
    sets = {}
    for r in G.lexicon_sets(lex).orderBy("cat", "idx").collect():
        sets.setdefault(r.cat, []).append((r.idx, r.word))
    assert sets["Det"] == [(0, "a"), (1, "the")] and len(sets["Noun"]) == 12
    toks = spark.createDataFrame([("fans",), ("zebra",)], "term string")
    cov = {r.term: r.n_cats for r in G.lexicon_coverage(toks, lex).collect()}
    assert cov == {"fans": 2, "zebra": 0}
    assert [r.term for r in G.missing_words(toks, lex).collect()] == ["zebra"]


def test_word2vec_deterministic_with_seed_and_one_partition(spark):
    sents = spark.createDataFrame([(["warm", "sun", "cold", "snow", "warm", "fire"],),
                                   (["cold", "wind", "warm", "towel"],)] * 15, "tokens array<string>")
    a = {r.word: r.vector for r in VE.word2vec_fit(sents, vector_size=6, min_count=1, seed=7,
                                                   num_partitions=1).collect()}
    b = {r.word: r.vector for r in VE.word2vec_fit(sents, vector_size=6, min_count=1, seed=7,
                                                   num_partitions=1).collect()}
    assert a.keys() == {"warm", "sun", "cold", "snow", "fire", "wind", "towel"}
    assert all(np.allclose(a[w], b[w]) and np.all(np.isfinite(a[w])) for w in a)


def test_words_in_both_cases_count_once(spark):
    from wordloom.operators import vectors as VE
    rows = [("The", [1.0, 0.1]), ("the", [-1.0, 0.5]), ("cat", [0.2, 1.0]), ("Dog", [0.9, 0.3]), ("dog", [0.0, -1.0]), ("sun", [0.5, 0.5])]
    v = spark.createDataFrame(rows, "word string, vector array<double>")
    pairs = spark.createDataFrame([("the", "CAT", 1.0), ("dog", "sun", 2.0), ("Cat", "sun", 3.0), ("cat", "none", 4.0)],
                                  "w1 string, w2 string, score double")
    r = VE.word_pair_eval(pairs, v).first()
    assert r.n_pairs == 3 and r.oov_ratio == 25.0
    q = spark.createDataFrame([(1, "s", "the", "cat", "dog", "sun"), (2, None, "sun", "The", "cat", "dog")],
                              "qid long, section string, a string, b string, c string, d string")
    got = VE.solve_analogies(q, v).collect()
    assert len(got) == 2
    assert all(x.predicted not in (x.a, x.b, x.c) for x in got)
    acc = {x.section: x.n_correct + x.n_incorrect for x in VE.analogy_accuracy(VE.solve_analogies(q, v)).collect()}
    assert acc == {"s": 1, None: 1, "Total": 2}


def test_missing_input_word_is_an_error(spark):
    import pytest
    from wordloom.operators import vectors as VE
    v = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "word string, vector array<double>")
    with pytest.raises(KeyError):
        VE.most_similar(v, ["a", "zz"])


def test_long_unary_chains(spark):
    from wordloom.operators import grammar as G
    rules = spark.createDataFrame([(f"N{i}", [f"N{i + 1}"]) for i in range(40)] + [("S", ["N0"])], "lhs string, rhs array<string>")
    lex = spark.createDataFrame([("w", "N40")], "word string, cat string")
    sent = spark.createDataFrame([(1, "w")], "sent_id long, text string")
    assert G.chart_parse(sent, lex, rules).first().n_parses == 1


def test_projection_equals_principal_components(spark):
    import numpy as np
    from wordloom.operators import vectors as VE
    x = np.random.default_rng(0).normal(size=(40, 5)) * [5, 3, 1, 1, 1]
    v = spark.createDataFrame([(f"w{i:02d}", r.tolist()) for i, r in enumerate(x)], "word string, vector array<double>")
    got = np.array([(r.x, r.y) for r in VE.project_2d(v).orderBy("word").collect()])
    _, _, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    want = x @ vt[:2].T
    for j in range(2):
        assert np.allclose(got[:, j], want[:, j], atol=1e-6) or np.allclose(got[:, j], -want[:, j], atol=1e-6)
