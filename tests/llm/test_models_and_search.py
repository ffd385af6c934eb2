"""Toxicity chain, sentence pieces, URL filter, license scan and vector
search against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from llm_plain import plain_top_k, unigram_model
from wordloom.llm.license_scan import TEMPLATES, Index, scan_licenses, winnow
from wordloom.llm.sentence_pieces import MODEL, Pieces, decode_ids, encode_texts
from wordloom.llm.toxicity import Linear, Lookup, fit_chain, flat, predict_chain, text_features, word_features
from wordloom.llm.url_filter import filter_urls, host_of, link_graph, parent_links, propagate
from wordloom.llm.vector_file import exact_top_k


# ------------------------------------------------------------------ pieces
@pytest.fixture(scope="module")
def pieces():
    return Pieces(MODEL)


def test_pieces_against_library(pieces):
    """Each word on its own: the sum of scores of the library's best lattice
    path in unigram mode (single precision, so only where no piece has the
    placeholder score of -1e9)."""
    library = unigram_model(MODEL)
    rng = random.Random(4)
    syllables = "th er on an ing tion ément ció schaft ß ñ é the s ly ou 1 20 . , ! - _ ( é".split()
    words = ["".join(rng.choices(syllables, k=rng.randrange(1, 9))) for _ in range(600)]
    ids, counts = pieces.encode(words)
    ends = np.concatenate([[0], np.cumsum(counts)])
    score = lambda x: sum(library.get_score(int(i)) for i in x)
    compared = 0
    for i, w in enumerate(words):
        ours, theirs = ids[ends[i]:ends[i + 1]].tolist(), library.nbest_encode_as_ids(w, 2)[0]
        if score(ours) > -1e8:
            compared += 1
            assert score(ours) == score(theirs), w
    assert compared > 300


def plain_viterbi(pieces, word):
    by_text = {pieces.bytes_of[int(i)].decode(): (float(s), int(i)) for i, s in zip(pieces.ids, pieces.scores)}
    best = [(0.0, [])] + [(-np.inf, [])] * len(word)
    for e in range(1, len(word) + 1):
        for length in range(1, min(pieces.longest, e) + 1):
            part = word[e - length:e].replace("▁", " ")
            score, i = by_text.get(part, (pieces.miss, None) if length == 1 else (None, None))
            if score is not None and best[e - length][0] + score > best[e][0]:
                out = [i] if i is not None else [int(pieces.byte_ids[b]) for b in part.encode()]
                best[e] = (best[e - length][0] + score, best[e - length][1] + out)
    return best[-1][1]


@pytest.mark.parametrize("text", ["", "a", " a", "two  spaces", "tab\tnew\nline\r\n", "日本語 テキスト 😀", "Ａ\u0000b",
                                  " " * 40 + "z", "x" * 300, "the quick brown fox, 123!", "é" * 50 + "\n" * 5])
def test_viterbi_and_round_trip(pieces, text):
    ids, counts = pieces.encode([text, "other words", text])
    assert counts[0] == counts[2] and pieces.decode(ids, counts) == [text.encode(), b"other words", text.encode()]
    want = []
    for part in Pieces_segments(text):
        want += plain_viterbi(pieces, part)
    assert ids[:counts[0]].tolist() == want


def Pieces_segments(text):
    from wordloom.llm.sentence_pieces import SEGMENT
    return SEGMENT.findall("▁" + text.replace(" ", "▁")) if text else []


def test_long_words_and_small_blocks(pieces, monkeypatch):
    import wordloom.llm.sentence_pieces as S
    text = "".join(random.Random(1).choices("theraineß", k=3000))
    want = pieces.encode([text])[0].tolist()
    monkeypatch.setattr(S, "STEP", 64)
    monkeypatch.setattr(S, "CACHE", 8)
    small = Pieces(MODEL)
    assert small.encode([text])[0].tolist() == want
    many = [f"word{i} other{i % 7}" for i in range(50)]
    ids, counts = small.encode(many)
    assert small.decode(ids, counts) == [m.encode() for m in many]


def test_encode_texts(awkward, nothing):
    out = encode_texts(awkward)
    rows = out.collect()
    assert len(rows) == awkward.count() and all(r.round_trip for r in rows)
    assert all((r.piece_ids is None) == (r.text is None) for r in rows)
    back = decode_ids(out.drop("text"))
    assert Counter(r.text for r in back.collect()) == Counter(r.text for r in rows)
    assert encode_texts(nothing).count() == 0


# ---------------------------------------------------------------- toxicity
def test_linear_model_reaches_the_minimum():
    rng = np.random.default_rng(1)
    n, d = 400, 12
    x = rng.random((n, d)) < 0.3
    extra = rng.normal(size=(n, 1))
    y = (rng.random(n) < 1 / (1 + np.exp(-(3.0 * x[:, 0] - 2 * x[:, 1] + extra[:, 0])))).astype(float)
    rows, cols = np.nonzero(x)
    m = Linear.fit(rows, cols, n, d, extra, y, 1.0, steps=200)
    p = 1 / (1 + np.exp(-m.margin(rows, cols, n, extra)))
    grad = np.concatenate([x.T @ (p - y) + m.weights, extra.T @ (p - y) + m.dense, [(p - y).sum()]])
    assert np.abs(grad).max() < 1e-2


def test_lookup_equals_features():
    words = "Stupid stupid, lostraan lostraun. the 123 !!".split()
    feats = sorted({f for w in words for f in word_features(w)})
    look = Lookup(np.array(feats[::2]))
    want = sorted({feats[::2].index(f) for w in words for f in word_features(w) if f in feats[::2]})
    assert look.of(" ".join(words)) == want and look.of(None) == []
    assert flat([[1], [], [2, 3]])[0].tolist() == [0, 2, 2]


def test_chain(spark, nothing):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(900):
        words = [f"n{rng.randrange(200)}" for _ in range(rng.randrange(20, 200))]
        junk, toxic = rng.random() < 0.3, False
        if junk:
            words += ["junk%%%"] * 3
        toxic = rng.random() < (0.5 if junk else 0.1)
        if toxic:
            words.insert(rng.randrange(len(words)), "vile" + rng.choice(["st", "ness", "ly"]))
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(junk), int(toxic)))
    truth = {i: "vile" in t for i, t in rows}
    docs = spark.createDataFrame(rows + [(5000, None), (5001, ""), (None, "x")], "doc_id long, text string")
    labs = spark.createDataFrame(labels + [(None, 1, 1), (9999, 1, None)], "doc_id long, junk int, toxic int")
    chain = fit_chain(docs, labs, {"junk": "junk = 1", "toxic": "toxic = 1"})
    out = predict_chain(docs, chain)
    assert out.columns == ["doc_id", "text", "junk_prob", "junk", "toxic_prob", "toxic"]
    held = [r for r in out.collect() if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 3 == 0]
    assert np.mean([r.toxic == truth[r.doc_id] for r in held]) > 0.98
    assert len(chain.models[1].dense) == 1  # the earlier category feeds the later one
    assert predict_chain(nothing, chain).count() == 0
    none = fit_chain(nothing, labs.filter("doc_id < 0"), {"junk": "junk = 1", "toxic": "toxic = 1"})
    assert len({r.toxic_prob for r in predict_chain(docs, none).collect()}) == 1


def plain_chain(docs, labels, names, folds, l2, min_docs, max_features):
    """The chain over dense matrices: features chosen by chi-squared, every
    fold's model fitted without the fold, out-of-fold log-odds as the next
    category's input, the threshold of the best F1 among all cuts."""
    import zlib

    ids = sorted(i for i in labels if docs.get(i) is not None)
    of = {i: set(text_features(docs[i].split())) | {f for w in docs[i].split() for f in word_features(w)} for i in ids}
    y = np.array([labels[i] for i in ids], float)
    counts = Counter(f for i in ids for f in of[i])
    chosen = set()
    for c in range(len(names)):
        pos, n, scored = y[:, c].sum(), len(ids), []
        for f, k in counts.items():
            if min_docs <= k < n and 0 < pos < n:
                a = sum(y[r, c] for r, i in enumerate(ids) if f in of[i])
                table = np.array([[a, k - a], [pos - a, n - k - pos + a]])
                expected = np.outer(table.sum(1), table.sum(0)) / n
                chi = ((table - expected) ** 2 / expected).sum()
                if chi > 10.83:
                    scored.append((-chi, f))
        chosen |= {f for _, f in sorted(scored)[:max_features]}
    chosen = sorted(chosen)
    x = np.array([[f in of[i] for f in chosen] for i in ids], float).reshape(len(ids), len(chosen))
    fold = np.array([zlib.crc32(str(i).encode()) % folds for i in ids])

    def fitted(rows, extra, target):
        at = np.argwhere(x[rows])
        m = Linear.fit(at[:, 0], at[:, 1], len(rows), len(chosen), extra[rows], target[rows], l2)
        return lambda r, e: x[r] @ m.weights + e[r] @ m.dense + m.bias, m

    held_extra, models, cuts = np.zeros((len(ids), 0)), [], []
    for c in range(len(names)):
        held = np.zeros(len(ids))
        for k in range(folds):
            inside, out = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            held[out] = fitted(inside, held_extra, y[:, c])[0](out, held_extra)
        models.append(fitted(np.arange(len(ids)), held_extra, y[:, c])[1])
        held_extra = np.column_stack([held_extra, held])
        p = 1 / (1 + np.exp(-held))
        values = sorted(set(p.tolist()), reverse=True)
        f1 = [2 * (y[p >= v, c].sum()) / ((p >= v).sum() + y[:, c].sum()) for v in values]
        best = int(np.argmax(f1))
        cuts.append((values[best] + (values[best + 1] if best + 1 < len(values) else 0.0)) / 2)

    def predict(text):
        have, extra, out = set(text_features((text or "").split())) if text else set(), [], []
        have |= {f for w in (text or "").split() for f in word_features(w)}
        row = np.array([f in have for f in chosen], float)
        for m, cut in zip(models, cuts):
            margin = row @ m.weights + np.array(extra) @ m.dense + m.bias
            extra.append(margin)
            out += [1 / (1 + np.exp(-margin)), 1 / (1 + np.exp(-margin)) >= cut]
        return out

    return chosen, cuts, predict


def test_chain_against_a_plain_one(spark):
    """Features, thresholds and every probability of a three-category chain,
    with clashing columns, documents without a label and labels without one."""
    rng = random.Random(12)
    words = [f"word{i}" for i in range(40)]
    docs, labels = {}, {}
    for i in range(400):
        junk, rude = rng.random() < 0.4, rng.random() < 0.3
        toxic = rng.random() < (0.8 if rude and junk else 0.1)
        text = rng.choices(words, k=rng.randrange(5, 30))
        text += ["spamword!!!"] * (junk and rng.random() < 0.9) + ["rudeword"] * (rude and rng.random() < 0.8) + ["HATE"] * (toxic and rng.random() < 0.7)
        rng.shuffle(text)
        docs[i] = " ".join(text)
        if i % 4:
            labels[i] = (int(junk), int(rude), int(toxic))
    docs |= {500: None, 501: "", 502: "   "}
    labels |= {500: (1, 1, 1), 501: (0, 0, 0), 999: (1, 0, 1)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").selectExpr("*", "'x' AS toxic", "1 AS junk_prob", "2 AS y0")
    labs = spark.createDataFrame([(i, *v, None) for i, v in labels.items()], "doc_id long, junk int, rude int, toxic int, text string")
    names = ["junk", "rude", "toxic"]
    chosen, cuts, predict = plain_chain(docs, labels, names, 4, 0.1, 3, 30)
    chain = fit_chain(df, labs, {c: f"{c} = 1" for c in names}, folds=4, min_docs=3, max_features=30)
    assert chain.selected.tolist() == chosen and len(chosen) > 3
    assert np.allclose(chain.thresholds, cuts, atol=1e-6)
    out = predict_chain(df, chain)
    assert sorted(out.columns) == sorted(["doc_id", "text", "y0", *names, *[f"{c}_prob" for c in names]])
    for r in out.collect():
        want = predict(r.text)
        got = [v for c in names for v in (r[f"{c}_prob"], r[c])]
        assert np.allclose(got[::2], want[::2], atol=1e-6) and got[1::2] == want[1::2]


# --------------------------------------------------------------------- url
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "bad.org/")]
PAGES = [(1, "http://WWW.Example.com/en/1?x#y", ""), (2, "https://a.example.com/en/2", ""), (3, "http://example.com/enx", ""),
         (4, "http://x.net/es/1", '<a href="http://y.org/">'), (5, "no scheme", "x"), (6, None, None),
         (7, "http://good.org/a", '<a href="http://bad.org/1">'), (8, "http://fine.org/", "<a href='/local'><a href=//good.org/x>"),
         (9, "http://bad.org", ""), (10, "http://bad.org/q", ""), (11, "http://host?x", ""), (11, "http://host?x", ""),
         (12, "http://b.com/x", '<A HREF="http://fine.org/">'), (13, "a://b://c/d", ""), (14, "http://one.net/", ""), (15, "", "")]


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    for c in "?#":
        path = path.split(c)[0]
    return rest[:cut].lower(), path


def test_urls_and_rules(spark):
    out = filter_urls(spark.createDataFrame(PAGES, "page_id int, url string, html string").selectExpr("*", "1 AS host", "2 AS r"), RULES)
    rows = out.collect()
    assert len(rows) == len(PAGES)
    verdicts = {}
    for r in rows:
        url = next(p[1] for p in PAGES if p[0] == r.page_id)
        host, path = plain_url(url)
        fit = [(len(rule), a, rule) for a, rule in RULES
               for h, p in [rule.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        assert (r.host, r.path) == (host, path)
        assert r.rule == (max(fit)[2] if fit else None)
        if fit:
            assert r.verdict == max(fit)[1]
        verdicts[r.page_id] = r.verdict
    assert verdicts[10] == "block" and verdicts[11] == verdicts[6] == verdicts[5] == "allow"
    empty = spark.createDataFrame([], "page_id int, url string, html string")
    assert filter_urls(empty, RULES).count() == 0
    assert {r.verdict for r in filter_urls(spark.createDataFrame(PAGES, "page_id int, url string, html string"), []).collect()} == {"allow"}


def test_page_rank_against_numpy(spark):
    rng = random.Random(8)
    hosts = [f"h{i}" for i in range(12)]
    edges = {(a, b): rng.randrange(1, 4) for a in hosts for b in hosts if a != b and rng.random() < 0.25}
    seeds = [("h0", 0, 1.0), ("h1", 0, 0.5), ("h2", 1, 1.0)]
    got = {(r.host, r.kind): r.score for r in propagate(
        spark.createDataFrame(seeds, "host string, kind int, seed double"),
        spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, n long"),
        0.85, 400, 1e-9).collect()}
    for kind in (0, 1):
        m = np.zeros((12, 12))
        for (a, b), n in edges.items():
            i, j = hosts.index(a), hosts.index(b)
            m[(j, i) if kind == 0 else (i, j)] = n
        m = m / np.maximum(m.sum(0), 1e-12)
        s = np.zeros(12)
        for h, k, x in seeds:
            if k == kind:
                s[hosts.index(h)] += x
        want = 0.15 * np.linalg.solve(np.eye(12) - 0.85 * m, s)
        assert np.allclose([got.get((h, kind), 0.0) for h in hosts], want, atol=1e-4)


def test_link_graph(spark):
    pages = spark.createDataFrame([(plain_url(u)[0], h) for _, u, h in PAGES], "host string, html string")
    got = {(r.src, r.dst): r.n for r in link_graph(pages, parents=False).collect()}
    assert got == {("x.net", "y.org"): 1, ("good.org", "bad.org"): 1, ("fine.org", "good.org"): 1, ("b.com", "fine.org"): 1}
    both = lambda *x: {(a, b) for a, b in zip(x, x[1:])} | {(b, a) for a, b in zip(x, x[1:])}
    parents = {(r.src, r.dst) for r in link_graph(pages).collect()} - set(got)
    assert parents == both("www.example.com", "example.com", "a.example.com")


def test_parent_links(spark):
    hosts = ["a.b.example.org", "b.example.org", "example.org", "org", "", "10.0.0.1", "x.example.net", "x.example.net:80"]
    got = {(r.src, r.dst) for r in parent_links(spark.createDataFrame([(h,) for h in hosts], "host string")).collect()}
    up = {("a.b.example.org", "b.example.org"), ("b.example.org", "example.org"), ("x.example.net", "example.net"),
          ("x.example.net:80", "example.net:80")}
    assert got == up | {(b, a) for a, b in up}


def test_given_pages_have_a_graph(spark):
    """The graph of the driver's pages has edges, and pages that no rule
    covers are judged by what flows over it: at their own seeds alone, all
    of their hosts would be allowed."""
    from wordloom.llm.queries import URL_RULES
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert link_graph(pages.select(host_of(F.col("url")).alias("host"), "html")).count() > 0
    out = filter_urls(pages, URL_RULES).toPandas()
    free = out[out.rule.isna()]
    assert set(free.verdict) == {"allow", "block"}
    assert (free[free.host.str.endswith(".example.net")].distrust > 0).all()
    assert (free[free.host.str.endswith(".example.org")].distrust == 0).all()


def test_propagation_reaches_its_limit(spark):
    seeds = spark.createDataFrame([("a", 0, 1.0)], "host string, kind int, seed double")
    ring = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, n long")
    with pytest.raises(RuntimeError):
        propagate(seeds, ring, 0.99, 8, 1e-9)
    star = spark.createDataFrame([("hub", f"h{i}", 1) for i in range(3000)] + [(f"h{i}", "hub", 1) for i in range(3000)],
                                 "src string, dst string, n long")
    got = {r.host: r.score for r in propagate(spark.createDataFrame([("h7", 0, 1.0)], seeds.schema), star, 0.85, 400, 1e-9).collect()}
    hub = 0.85 * 0.15 / (1 - 0.85 ** 2)
    assert abs(got["hub"] - hub) < 1e-6 and abs(got["h7"] - 0.15 - 0.85 * hub / 3000) < 1e-6 and len(got) == 3001


def test_distrust_flows_backwards(spark):
    pages = [(i, f"http://spam{i}.org/", '<a href="http://evil.org/x">') for i in range(3)] + [(9, "http://evil.org/x", "")]
    out = filter_urls(spark.createDataFrame(pages, "page_id int, url string, html string"), [("block", "evil.org/")], limit=0.2)
    assert {r.verdict for r in out.collect()} == {"block"}
    clean = filter_urls(spark.createDataFrame(pages, "page_id int, url string, html string"), [("allow", "evil.org/")])
    assert {r.verdict for r in clean.collect()} == {"allow"}


# ----------------------------------------------------------------- license
def test_winnow_guarantee():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 50, 200).astype(np.uint64)
    at = winnow(h, 4)
    assert all(((at >= i) & (at < i + 4)).any() for i in range(len(h) - 3))
    assert winnow(h[:3], 4).tolist() == [int(np.flatnonzero(h[:3] == h[:3].min())[-1])] and len(winnow(h[:0], 4)) == 0


def plain_alignment(template, words):
    """Best local alignment score over the whole table (no band)."""
    best, prev = 0, [0] * (len(words) + 1)
    for t in template:
        row = [0]
        for j, w in enumerate(words, 1):
            row.append(max(0, prev[j - 1] + (2 if w == t else -1), prev[j] - 1, row[-1] - 1))
        best, prev = max(best, *row), row
    return best


def test_licenses(spark, nothing):
    rng = random.Random(6)
    filler = lambda n: " ".join(f"q{rng.randrange(999)}" for _ in range(n))
    rows, want = [], defaultdict(set)
    for i, (name, text) in enumerate(TEMPLATES):
        words = text.split(" ")
        edited = list(words)
        if len(words) > 12:
            edited[5] = "altered"
            del edited[9]
        rows += [(10 * i, f"{filler(30)}\n{text}\n{filler(20)}"), (10 * i + 1, f"{filler(9)} {' '.join(edited).upper()} {filler(3)}"),
                 (10 * i + 2, filler(80)), (10 * i + 3, text + "\n" + text)]
        want[10 * i].add(name)
        want[10 * i + 1].add(name)
        want[10 * i + 3].add(name)
    rows += [(990, None), (991, ""), (992, "licensed under"), (993, "İ" * 20 + " Released under the MIT License.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS license", "1 AS coverage")
    got = defaultdict(set)
    texts = dict(rows)
    for r in scan_licenses(docs).collect():
        got[r.doc_id].add(r.license)
        assert 0.8 <= r.coverage <= 1 and 0 <= r.first_char < r.end_char <= len(texts[r.doc_id])
        if r.doc_id % 10 == 0 and r.doc_id < 990:
            piece = texts[r.doc_id][r.first_char:r.end_char]
            assert r.license != TEMPLATES[r.doc_id // 10][0] or (piece in dict(TEMPLATES)[r.license] and r.coverage == 1)
    for i, names in want.items():
        assert names <= got[i]
    assert not any(got[10 * i + 2] for i in range(len(TEMPLATES))) and not (got[990] | got[991] | got[992])
    assert got[993] == {"MIT-notice"}
    assert scan_licenses(nothing).count() == 0
    assert scan_licenses(docs, []).count() == 0


def test_band_holds_the_best_alignment():
    rng = random.Random(9)
    index = Index([("t", " ".join(f"w{i}" for i in range(40)))])
    for _ in range(30):
        words = [f"w{i}" for i in range(40)]
        for _ in range(rng.randrange(6)):
            i = rng.randrange(len(words))
            words[i:i + 1] = rng.choice([[], ["zz"], [words[i], "zz"]])
        ids = np.array([index.vocab.get(w, 0) for w in ["a", "b", *words, "c"]], np.uint64)
        hits, first, end = index.align(0, ids, 2)
        found = 2 * hits - 1 * 0
        assert plain_alignment(index.words[0], ids.tolist()) <= found and 0 <= first < end <= len(ids)


def test_repeated_template(spark):
    text = "Released under the MIT License."
    out = scan_licenses(spark.createDataFrame([(1, f"{text} {'x ' * 30} {text}")], "doc_id long, text string")).collect()
    assert len([r for r in out if r.license == "MIT-notice"]) == 2


def plain_matches(template, words, least, lo=0, hi=None):
    """(first, end) of the best alignment over the whole table (no band) and
    of the best ones left and right of it."""
    hi = len(words) if hi is None else hi
    best, prev = (0, 0, 0, 0), {}
    for t in template:
        row = {}
        for j in range(lo, hi):
            score, hits, first = prev.get(j - 1, (0, 0, j))
            cell = (score + 2, hits + 1, first if score else j) if words[j] == t else (score - 1, hits, first)
            for other in (prev.get(j), row.get(j - 1)):
                if other and other[0] - 1 > cell[0]:
                    cell = (other[0] - 1, *other[1:])
            if cell[0] > 0:
                row[j] = cell
                if words[j] == t and cell[:2] > best[:2]:
                    best = (*cell, j + 1)
        prev = row
    _, hits, first, end = best
    if not hits:
        return []
    return (plain_matches(template, words, least, lo, first) + [(first, end)] * (hits / len(template) >= least)
            + plain_matches(template, words, least, end, hi))


@pytest.mark.parametrize("name", ["MIT-notice", "CC-BY-NC-4.0-notice", "Apache-2.0-notice", "GPL-3.0-header"])
@pytest.mark.parametrize("every", [0, 8, 12, 20])
@pytest.mark.parametrize("times", [2, 5])
def test_repeats_close_together(name, every, times):
    index = Index(TEMPLATES)
    t = index.names.index(name)
    words = re.findall(r"[^\W_]+", dict(TEMPLATES)[name].lower())
    damaged = list(words)
    damaged[0] = "altered"  # still as many words in a row as make a candidate
    text = ["before"] * 3
    for i in range(times):
        text += (damaged if i == 1 else words) + [f"q{i}"] * max(0, every - len(words))
    line = " ".join(text)
    got = [(len(line[:a].split()), len(line[:b].split())) for x, _, _, a, b in index.matches(line, 0.8) if x == t]
    assert got == plain_matches(words, text, 0.8) and len(got) == times


def test_adjacent_notices(spark):
    text = "Released under the MIT License."
    out = scan_licenses(spark.createDataFrame([(1, f"{text} {text}")], "doc_id long, text string")).collect()
    assert [(r.license, r.first_char, r.end_char) for r in out] == [("MIT-notice", 0, 30), ("MIT-notice", 32, 62)]


# ----------------------------------------------------------------- vectors
@pytest.mark.parametrize("block,query_block", [(16384, 1024), (13, 3)])
def test_top_k(spark, block, query_block):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8).round(1)]) for i in range(150)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + [(1100, rows[100][1])]
    rows += [(2000, None), (2100, [1.0, None]), (2200, [float("nan")] * 8), (2300, [float("inf")] * 8), (2400, []),
             (2500, [1.0, 2.0]), (None, [1.0] * 8), (100, [9.0] * 8), rows[5], (2600, [0.0] * 8), (2700, [-0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS rank", "2 AS v", "3 AS score")
    got = exact_top_k(df, df.filter("vec_id % 100 = 0"), block=block, query_block=query_block).collect()
    assert Counter(map(tuple, got)) == Counter(plain_top_k(rows))


def test_top_k_of_any_value_and_every_row(spark):
    """Large components, rows that share an id (with equal and different
    vectors), and a vector that a third of the queries share."""
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1e6, 1e6) for _ in range(3)]) for i in range(300)]
    rows += [(i, [1.0, 200_000.0, -1e6]) for i in range(10_000, 25_000, 100)]
    rows += [(1, [1.0, 2.0, 0.0]), (1, [5.0, 5.0, 1e6]), (100, [9e5] * 3), (100, [9e5] * 3), (101, [9e5] * 3), (100, rows[100][1])]
    rows += [(200, [9.5e5] * 3)] * 15 + [(201, [9.5e5] * 3)] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = exact_top_k(df, df.filter("vec_id % 100 = 0"), block=64, query_block=16).collect()
    assert Counter(map(tuple, got)) == Counter(plain_top_k(rows))
    pair = spark.createDataFrame([(0, [1.0, 200_000.0]), (1, [1.0, 200_000.0])], "vec_id long, embedding array<double>")
    assert exact_top_k(pair, pair.filter("vec_id = 0")).first().score == (1024 * 200_000) ** 2 + 1024 ** 2
    for x in (1e13, 5e6):
        big = spark.createDataFrame([(0, [x]), (1, [x])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception):
            exact_top_k(big, big.filter("vec_id = 0")).collect()


def test_top_k_small(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in exact_top_k(df, df.filter("vec_id = 0")).collect()] == [(0, 1, 1, 1024 * 2048)]
    empty = df.filter("vec_id > 9")
    assert exact_top_k(empty, empty).count() == 0 and exact_top_k(df, empty).count() == 0
    one = df.filter("vec_id = 0")
    assert exact_top_k(one, one).count() == 0
