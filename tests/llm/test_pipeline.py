"""The pipeline, stage by stage, against plain Python versions, over
documents with every awkward case; the stages' contract; empty input."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as CP
from test_ngram_join import plain_components, plain_links
from test_text_operators import plain_dedup_rows, plain_water

from wordloom.llm.language_id import gram_hashes
from wordloom.llm.sentence_pieces import Pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc_mod(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 4


def plain_language(rows):
    """Plain sets of frequent n-grams instead of the filter."""
    counts = defaultdict(Counter)
    for r in rows:
        if r.doc_id is not None and crc_mod(r.doc_id) != 2 and r.text is not None and r.lang is not None:
            counts[r.lang].update(gram_hashes([r.text])[0].tolist())
    sets = {lang: {g for g, n in c.items() if n >= 2e-5 * sum(c.values())} for lang, c in counts.items()}
    kept = []
    for r in rows:
        if r.text and any(ch.isalpha() for ch in r.text):
            h = gram_hashes([r.text])[0].tolist()
            if max(sum(x in s for x in h) for s in sets.values()) >= 0.3 * len(h):
                kept.append(r)
    return kept


def plain_mix(rows):
    size = lambda r: len(WORD.findall(r.text or ""))
    total = Counter()
    for r in rows:
        total[r.source] += size(r)
    order = sorted(total, key=lambda s: (s is None, s))
    targets = plain_water([2.0 * total[s] for s in order], [float([3, 1, 2][i % 3]) for i in range(len(order))],
                          1.5 * sum(total.values()))
    out = Counter()
    for s, target in zip(order, targets):
        whole = int(target // total[s]) if total[s] else 0
        need, start, open_ = target - whole * total[s], 0, True
        groups = defaultdict(list)
        for r in rows:
            if r.source == s:
                groups[hashlib.md5(f"mix:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest()].append(r)
        for key in sorted(groups):
            n = sum(map(size, groups[key]))
            open_ = open_ and need > 0 and start + n / 2 <= need
            start += n
            for r in groups[key]:
                if whole + open_:
                    out[r] += whole + open_
    return out


@pytest.fixture(scope="module")
def staged(spark, awkward):
    """Input and output rows of each stage."""
    docs, out = awkward, []
    for name, stage in CP.STAGES:
        result = CP.written(stage(spark, docs, None))
        out.append((name, docs, result))
        docs = result
    return {name: (a, b) for name, a, b in out}


def test_names_and_columns(staged, awkward):
    assert list(staged) == ["language_id", "line_dedup", "ngram_jaccard_join", "source_mixing", "sentence_pieces"]
    for name in list(staged)[:-1]:
        assert staged[name][1].columns == awkward.columns
        assert [f.dataType for f in staged[name][1].schema] == [f.dataType for f in awkward.schema]


def test_language_stage(staged):
    before, after = (x.collect() for x in staged["language_id"])
    assert Counter(after) == Counter(plain_language(before))
    assert 0 < len(after) < len(before)


def test_line_stage(staged):
    """Plain line dedup; a document goes if it loses a line and more than half, or all, of its words."""
    before, after = (x.collect() for x in staged["line_dedup"])
    want, gone = Counter(), 0
    for r, (i, _, dropped, text) in zip(before, plain_dedup_rows([(r.doc_id, r.text) for r in before])):
        n, m = len(WORD.findall(r.text or "")), len(WORD.findall(text))
        if dropped and (2 * m < n or m == 0):
            gone += 1
        else:
            want[i, text, len(text)] += 1
    assert Counter((r.doc_id, r.text, r.n_chars) for r in after) == want and gone >= 5


def test_no_stumps_of_near_copies(spark):
    """Near copies that meet line dedup first: nine in ten at least are gone
    after the two stages, clean documents with a shared passage stay whole
    but for it, and no document is a remnant of another."""
    rng = random.Random(7)
    text = lambda i, n=12: [" ".join(f"w{rng.randrange(4000)}x{i}" for _ in range(15)) for _ in range(n)]
    rows, copies = [], set()
    passage = " ".join(f"shared{i}" for i in range(60))
    for i in range(40):
        lines = text(i)
        rows.append((i, "\n".join(lines)))
        for j in range(3):
            near = list(lines)
            at = rng.randrange(len(near))
            near[at] = near[at].replace("w", "changed", 1)
            rows.append((1000 + 10 * i + j, "\n".join(near)))
            copies.add(1000 + 10 * i + j)
    clean = {5000 + i: [*text(9000 + i), passage] for i in range(30)}
    rows += [(i, "\n".join(x)) for i, x in clean.items()]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    left = CP.written(CP.dedup_lines(spark, docs, None))
    after = {r.doc_id: r.text for r in CP.near_duplicates(spark, left, None).collect()}
    assert len(copies & set(after)) <= 0.1 * len(copies)
    whole = dict(rows)
    assert all(2 * len(WORD.findall(t)) >= len(WORD.findall(whole[i])) for i, t in after.items())
    assert set(range(40)) <= set(after) and set(clean) <= set(after)
    assert sum(passage in t for t in after.values()) == 1


def test_near_duplicate_stage(staged):
    before, after = (x.collect() for x in staged["ngram_jaccard_join"])
    roots = defaultdict(set)
    for i, _, root in plain_components([(r.doc_id, r.text) for r in before]):
        roots[i].add(root)
    ids = Counter(r.doc_id for r in after)
    assert set(ids) - {None} == {i for i, c in roots.items() if i is not None and c == {i}}
    assert all(n == 1 for i, n in ids.items() if i is not None)
    assert ids[None] == sum(r.doc_id is None for r in before)
    assert set(after) <= set(before)


def test_mixing_stage(staged):
    before, after = (x.collect() for x in staged["source_mixing"])
    assert Counter(after) == plain_mix(before)


def test_piece_stage(staged):
    before, after = (x.collect() for x in staged["sentence_pieces"])
    pieces = Pieces()
    want = Counter((r.doc_id, tuple(pieces.encode([r.text])[0].tolist())) for r in before)
    assert Counter((r.doc_id, tuple(r.piece_ids)) for r in after) == want
    assert all(r.round_trip and r.n_pieces == len(r.piece_ids) for r in after)


def test_run_equals_the_stages(spark, awkward, staged, tmp_path):
    awkward.write.parquet(str(tmp_path / "documents.parquet"))
    got = CP.run(spark, str(tmp_path))
    assert Counter((r.doc_id, tuple(r.piece_ids)) for r in got.collect()) == Counter(
        (r.doc_id, tuple(r.piece_ids)) for r in staged["sentence_pieces"][1].collect())


def test_empty(spark, nothing):
    docs = nothing
    for _, stage in CP.STAGES:
        docs = CP.written(stage(spark, docs, None))
        assert docs.count() == 0


def test_near_copies_through_the_stage(spark):
    words = [f"word{i}" for i in range(200)]
    near = list(words)
    near[50] = "other"
    rows = [(3, " ".join(words), "en", "s", 1), (1, " ".join(near), "en", "s", 1), (2, " ".join(words[:120]), "en", "s", 1),
            (3, " ".join(words), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in CP.near_duplicates(spark, docs, None).collect()) == [1, 2]


def test_near_duplicates_at_five_words(spark, staged):
    """Against all pairs of five-word shingles at 0.8, with copies below 0.9 on three-word ones."""
    near = [f"word{i}" for i in range(150)]
    texts = [" ".join(near)]
    for at in (20, 70, 120):
        near[at] = "other"
        texts.append(" ".join(near))
    texts += [" ".join(f"w{i}" for i in range(9)), " ".join(f"w{i}" for i in range(8))]
    rows = [(1000 + i, t, "en", "s", 1) for i, t in enumerate(texts[:1] + texts[3:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(staged["ngram_jaccard_join"][0].filter("doc_id is not null").select(*docs.columns))
    roots = defaultdict(set)
    for i, _, root in plain_links([(r.doc_id, r.text) for r in docs.collect()], 5, 4, 5):
        roots[i].add(root)
    after = Counter(r.doc_id for r in CP.near_duplicates(spark, docs, None).collect())
    assert set(after) == {i for i, c in roots.items() if c == {i}} and set(after.values()) == {1}
    assert {1000, 1002} <= set(after) and not {1001, 1003} & set(after)
