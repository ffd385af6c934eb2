"""Plain versions used by the tests."""

import math


def plain_top_k(rows, k=10):
    """Top-k by brute force: every row with a valid vector is a candidate of
    every query row with another id."""
    valid = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in valid:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in valid if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return out


def _varint(b, i):
    r = s = 0
    while True:
        x = b[i]
        i += 1
        r |= (x & 127) << s
        s += 7
        if x < 128:
            return r, i


def _encoded(v):
    out = b""
    while v > 127:
        out += bytes([v & 127 | 128])
        v >>= 7
    return out + bytes([v])


def unigram_model(path):
    """The library's processor with the model type set to unigram (field 3
    of the trainer settings), so that it maximises the sum of scores."""
    import sentencepiece

    raw, out, i = open(path, "rb").read(), b"", 0
    while i < len(raw):
        tag, i = _varint(raw, i)
        size, i = _varint(raw, i)
        body, i = raw[i:i + size], i + size
        if tag >> 3 == 2:
            new, j = b"", 0
            while j < len(body):
                start = j
                t, j = _varint(body, j)
                if t & 7 == 0:
                    _, j = _varint(body, j)
                elif t & 7 == 2:
                    n, j = _varint(body, j)
                    j += n
                else:
                    j += {5: 4, 1: 8}[t & 7]
                new += _encoded(t) + _encoded(1) if t == 3 << 3 else body[start:j]
            body = new
        out += _encoded(tag) + _encoded(len(body)) + body
    return sentencepiece.SentencePieceProcessor(model_proto=out)
