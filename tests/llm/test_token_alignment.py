"""Token alignment against a plain version that uses both libraries directly
and loops over token pairs: special strings, unreproduced texts, large
groups, copies, clashing columns, empty tables; both encoders of A."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordloom.llm.token_alignment import BYTE_BPE, PIECES, Alignment, ByteLevel, Pieces, Side, byte_letters, token_alignment

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    letters = byte_letters()
    vocab = {i: bytes(letters[c] for c in t) for t, i in json.load(open(BYTE_BPE))["model"]["vocab"].items()}
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return a, vocab, b


def groups_of(text, libraries):
    """[(A ids, B ids)] of a text; [] if a side doesn't give it back."""
    a, vocab, b = libraries
    if not text:
        return []
    raw = (" " + text).encode()
    x = a.encode(" " + text, add_special_tokens=False).ids
    y = b.encode(text)
    xs = [vocab[i] for i in x]
    ys = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(y, b.id_to_piece(y))]
    if b"".join(xs) != raw or b"".join(ys) != raw:
        return []
    ends = {int(e) for e in np.cumsum([len(t) for t in xs])} & {int(e) for e in np.cumsum([len(t) for t in ys])}
    out, i, j, at_x, at_y = [], 0, 0, 0, 0
    for e in sorted(ends):
        left, right = [], []
        while at_x < e:
            left.append(x[i])
            at_x, i = at_x + len(xs[i]), i + 1
        while at_y < e:
            right.append(y[j])
            at_y, j = at_y + len(ys[j]), j + 1
        out.append((left, right))
    return out


def plain(rows, libraries):
    parted = {t: groups_of(t, libraries) for t in {t for _, t in rows}}
    links = {t: Counter((p, q) for x, y in g for p in x for q in y) for t, g in parted.items()}
    count = Counter()
    for _, t in rows:
        count.update(links[t].keys())
    best = defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = Counter()
    for i, t in rows:
        g, k = parted[t], links[t]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out[i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(k.values()),
            sum(n for p, n in k.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in k.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else ""] += 1
    return out


def found(df, **options):
    return Counter(tuple(r) for r in token_alignment(df, **options).select("doc_id", *COLUMNS).collect())


TEXTS = ["Hello world", "<|endoftext|> <s> </s> <unk> <0x0A> [CLS]", "a▁b", "▁", "\x00 nul", "  two  blanks ", "\n\n\t", " ",
         "naïve café İ    \U0001F600\U0001F469‍\U0001F680", "don't we'll THEY'RE", "日本語のテキスト", "é ‮",
         "x" * 3001, "ab" * 500 + "c", "!" * 77, "\r\n\r\n", "0123456789" * 9, "﻿bom", "\u0000", "퟿￿"]


def test_awkward(awkward, libraries):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(awkward, broadcast_pairs=50) == plain(rows, libraries)


@pytest.mark.parametrize("pairs", [1, 10, 250_000])
def test_strange_texts(spark, libraries, pairs):
    rng = random.Random(1)
    rows = [(i, t) for i, t in enumerate(TEXTS * 2 + [None, "", "Hello world"] + ["".join(rng.choices("ab é.\n", k=30)) for _ in range(30)])]
    want = plain(rows, libraries)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), broadcast_pairs=pairs) == want
    assert sum(1 for r in want if r[1] == 0) >= 4


def test_large_group():
    """A group of many tokens on both sides is linked without holding the pairs."""
    one = Alignment.__new__(Alignment)
    one.n, one.a, one.b = np.array([[7500, 20_000]]), np.full(7500, 2), np.full(20_000, 1)
    one.a_group, one.b_group, one.text = np.zeros(7500, int), np.zeros(20_000, int), np.zeros(1, int)
    one.a_count, one.b_count = np.array([7500]), np.array([20_000])
    assert one.links().tolist() == [150_000_000]
    assert [v.tolist() for v in one.pairs(10, 100)] == [[21], [150_000_000], [1]]


def test_no_texts():
    one = Alignment(Side(ByteLevel(open(BYTE_BPE, "rb").read())), Side(Pieces(open(PIECES, "rb").read())), [])
    assert one.n.shape == (0, 2) and one.groups().tolist() == one.links().tolist() == []


def test_spans_and_columns(spark, nothing, libraries):
    df = spark.createDataFrame([(1, "Hello world", "x"), (2, None, "y"), (3, "a▁b", "z")],
                               "doc_id long, text string, n_a string").withColumn("_k1", F.lit(5)).withColumn("a.b", F.lit(6))
    out = token_alignment(df, spans=True)
    assert out.columns == ["doc_id", "text", "_k1", "a.b", *COLUMNS, "a_ids", "b_ids", "cuts"]
    rows = {r.doc_id: r for r in out.collect()}
    groups = groups_of("Hello world", libraries)
    assert rows[1].a_ids == [i for x, _ in groups for i in x] and rows[1].b_ids == [i for _, y in groups for i in y]
    assert rows[1].cuts[-1] == len(" Hello world") and len(rows[1].cuts) == rows[1].n_groups == len(groups)
    for i in (2, 3):
        assert rows[i].n_a == rows[i].n_links == 0 and rows[i].cuts is None and rows[i].groups_sha256 == "" and rows[i]._k1 == 5
    assert token_alignment(nothing).count() == 0


def test_both_encoders_of_a(libraries):
    """The fast encoder gives the library's ids: whole vocabulary, all code
    points among others, random strings of tokens."""
    a, vocab, _ = libraries
    fast = ByteLevel(open(BYTE_BPE, "rb").read())
    spec = json.load(open(BYTE_BPE))
    slow = ByteLevel(json.dumps(spec | {"normalizer": {"type": "Sequence", "normalizers": []}}).encode())
    assert fast.tokens == slow.tokens and fast.tokens[50256] == b"<|endoftext|>"
    rng = random.Random(2)
    words = [v.decode("utf-8", "ignore") for v in vocab.values()]
    texts = [w for w in words if w] + ["".join(rng.choices(words, k=rng.randrange(1, 6))) for _ in range(20_000)]
    texts += [f"x{chr(c)}x {chr(c)} 1{chr(c)}" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000] + TEXTS[:-1]
    want = [e.ids for e in a.encode_batch(texts, add_special_tokens=False)]
    assert [fast.encode(t) for t in texts] == want
    assert [slow.encode(t) for t in texts[::97]] == want[::97]


def test_pieces_give_their_bytes():
    b = Pieces(open(PIECES, "rb").read())
    for t in ("Hello world", "日本\x00é\n\t"):
        assert b"".join(b.tokens[i] for i in b.encode(t)) == (" " + t).encode()
