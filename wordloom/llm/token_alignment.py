"""Alignment of two tokenizers over the same bytes, with corpus-wide counts.

Each distinct text is tokenised and aligned once: a shuffle by the full text
(combined in the tasks first, so that a text that a third of all documents
hold leaves each task once) leaves one row per text with its multiplicity.
Tokens of both sides are compared by byte offset; offsets where both end cut
the text into groups, and all token pairs of a group are linked.

Plan: a distinct text's linked id pairs are written beside its measures, as
two lists; pair counts are sums of multiplicities over texts.  The counts go
back to the links by ``lookup``: pairs with many links are broadcast (fewer
than ``broadcast_pairs`` by construction), the others meet in a shuffle join
without a hot key.  Measures join back to the documents by two hashes of the
text, which are checked to tell all distinct texts apart.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.functions.columns import explode_rows
from wordloom.llm.common import list_array, lookup, map_texts, text_keys, written
from wordloom.llm.sentence_pieces import MODEL as PIECES

#: The byte-level vocabulary file (read on the driver only).
BYTE_BPE = os.environ.get("WORDLOOM_BYTE_BPE", "/opt/tokenizers/byte_bpe_50k.json")

#: Fixed value: how byte-level vocabularies of this kind part a text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Groups with more token pairs are first reduced to their distinct ids.
DIRECT = 64

RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_letters() -> dict[str, int]:
    """The letter of every byte in a byte-level vocabulary: itself where it
    is a visible Latin-1 character, else the next free one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Encoder of a byte-level BPE file; special tokens are plain text.

    Files whose ids follow the merge order, without normaliser, with the
    usual word pattern, are encoded by ranks (same ids, several times
    faster); any other file by the tokenizer library itself."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        named = {t: bytes(letters[c] for c in t) for t in vocab if all(c in letters for c in t)}
        special = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *special]) + 1
        self.tokens = [special.get(i, b"") for i in range(size)]
        for t, b in named.items():
            self.tokens[vocab[t]] = b
        split = spec.get("pre_tokenizer") or {}
        order = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        plain = (spec.get("normalizer") is None and spec.get("post_processor") is None and split.get("type") == "ByteLevel"
                 and split.get("use_regex", True) and not split.get("add_prefix_space") and len(named) == len(vocab)
                 and order == list(range(256, 256 + len(order))) and not spec["model"].get("dropout"))
        if plain:
            import tiktoken
            ranks = {named[t]: i for t, i in vocab.items()}
            self.encode = tiktoken.Encoding("bytes", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer
            whole = Tokenizer.from_str(data.decode())
            whole.encode_special_tokens = True
            self.encode = lambda text: whole.encode(text, add_special_tokens=False).ids


class Pieces:
    """Encoder of a SentencePiece file, which puts a space before the text."""

    def __init__(self, data: bytes):
        import sentencepiece
        self._model = model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.tokens = []
        for i in range(model.piece_size()):
            piece = model.id_to_piece(i)
            self.tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i)
                               else b"" if model.is_control(i) else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> list[int]:
        return self._model.encode(text)


def digits(tokens: int) -> np.ndarray:
    """One row per id: its decimal digits, then zeros."""
    width = len(str(max(0, tokens - 1)))
    return np.array([str(i) for i in range(tokens)], f"S{width}").view(np.uint8).reshape(tokens, width)


class Alignment:
    """The aligned tokens of some texts, as flat arrays."""

    def __init__(self, a: "Side", b: "Side", texts: list[str]):
        both = []
        for text in texts:
            raw = (" " + text).encode()
            x, y = a.encode(" " + text), b.encode(text)
            ok = b"".join(map(a.tokens.__getitem__, x)) == raw == b"".join(map(b.tokens.__getitem__, y))
            both.append((x, y, len(raw)) if ok else ([], [], 0))
        self.n = np.array([[len(x), len(y)] for x, y, _ in both], np.int64).reshape(-1, 2)
        self.a = np.concatenate([np.zeros(0, np.int64), *[np.array(x, np.int64) for x, _, _ in both]])
        self.b = np.concatenate([np.zeros(0, np.int64), *[np.array(y, np.int64) for _, y, _ in both]])
        a_end, b_end = np.cumsum(a.sizes[self.a]), np.cumsum(b.sizes[self.b])
        size = np.array([s for _, _, s in both], np.int64)
        ends = np.zeros((2, int(size.sum()) + 1), bool)
        ends[0, a_end] = ends[1, b_end] = True
        self.a_last, self.b_last = ends[1, a_end], ends[0, b_end]
        self.cuts = a_end[self.a_last]
        self.a_group, self.b_group = np.cumsum(self.a_last) - self.a_last, np.cumsum(self.b_last) - self.b_last
        self.a_count = np.bincount(self.a_group, minlength=len(self.cuts))
        self.b_count = np.bincount(self.b_group, minlength=len(self.cuts))
        self.text_end = np.cumsum(size)
        self.text = np.searchsorted(self.text_end, self.cuts, "left")

    def groups(self) -> np.ndarray:
        return np.bincount(self.text, minlength=len(self.n))

    def links(self) -> np.ndarray:
        out = np.zeros(len(self.n), np.int64)
        np.add.at(out, self.text, self.a_count * self.b_count)
        return out

    def pairs(self, width: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked pairs ``a * width + b`` of every text, ascending,
        how often each is linked, and how many there are per text."""
        big = self.a_count * self.b_count > DIRECT
        times = np.where(big[self.a_group], 0, self.b_count[self.a_group])
        first = np.cumsum(self.b_count) - self.b_count
        left = np.repeat(np.arange(len(self.a)), times)
        right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + first[self.a_group[left]]
        keys = [self.text[self.a_group[left]] * span + self.a[left] * width + self.b[right]]
        weights = [np.ones(len(left), np.int64)]
        at = np.cumsum(self.a_count) - self.a_count
        for g in np.flatnonzero(big).tolist():
            x, nx = np.unique(self.a[at[g]:at[g] + self.a_count[g]], return_counts=True)
            y, ny = np.unique(self.b[first[g]:first[g] + self.b_count[g]], return_counts=True)
            keys.append((self.text[g] * span + x[:, None] * width + y).ravel())
            weights.append((nx[:, None] * ny).ravel())
        keys = np.concatenate(keys)
        if len(weights) == 1:
            keys, n = np.unique(keys, return_counts=True)
        else:
            keys, where = np.unique(keys, return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, where, np.concatenate(weights))
        return keys % span, n, np.bincount(keys // span, minlength=len(self.n))

    def digests(self, a_digits: np.ndarray, b_digits: np.ndarray) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per text; '' without tokens."""
        width = max(a_digits.shape[1], b_digits.shape[1])
        rows = np.zeros((len(self.a) + len(self.b), width + 1), np.uint8)
        a_at = np.arange(len(self.a)) + (np.cumsum(self.b_count) - self.b_count)[self.a_group]
        b_at = np.arange(len(self.b)) + np.cumsum(self.a_count)[self.b_group]
        rows[a_at, :a_digits.shape[1]], rows[b_at, :b_digits.shape[1]] = a_digits[self.a], b_digits[self.b]
        rows[a_at, width] = np.where(self.a_last, ord("|"), ord(","))
        rows[b_at, width] = np.where(self.b_last, ord(";"), ord(","))
        tokens = self.n.sum(axis=1)
        last = np.cumsum(tokens)
        rows[last[tokens > 0] - 1, width] = 0
        used = rows != 0
        flat = rows[used].tobytes()
        stops = np.concatenate([[0], np.cumsum(used.sum(axis=1))])[np.concatenate([[0], last])].tolist()
        return [hashlib.sha256(flat[x:y]).hexdigest() if y > x else "" for x, y in zip(stops, stops[1:])]


class Side:
    """One tokenizer with what the alignment needs of its vocabulary."""

    def __init__(self, encoder):
        self.encode, self.tokens = encoder.encode, encoder.tokens
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.digits = digits(len(self.tokens))


@lru_cache(maxsize=1)
def sides(byte_bpe: bytes, pieces: bytes) -> tuple[Side, Side]:
    return Side(ByteLevel(byte_bpe)), Side(Pieces(pieces))


def token_alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE,
                    pieces: str = PIECES, broadcast_pairs: int = 250_000, drop: tuple[str, ...] = (),
                    spans: bool = False) -> DataFrame:
    """``docs`` (without the columns ``drop``) with the measures of each row's
    text under the byte-level tokenizer A and the SentencePiece tokenizer B.

    A encodes a space and the text, B the text, whose encoder adds the space;
    strings of special tokens are ordinary text.  ``n_a`` and ``n_b`` are the
    tokens, ``n_groups`` the groups between byte offsets where both end,
    ``n_links`` all pairs of an A and a B token of one group.  An id pair
    counts the rows whose text has it linked.  ``n_best`` are the links whose
    count is the highest of their A id (ties included), ``count_sum`` the sum
    of counts over links, ``groups_sha256`` the digest of
    ``a1,a2|b1;a3|b2,b3``.  A text that is null, empty, or not reproduced
    byte by byte by both tokenizers has no tokens: zeros and ''.  With
    ``spans``, ``a_ids``, ``b_ids`` and ``cuts`` (byte offsets of the group
    ends in space + text) follow; null without tokens.

    Repeated rows count as often as they occur.  Texts of any length are
    read whole; a task's memory follows its longest text.  Input columns
    named like result columns are replaced.  An empty table gives an empty
    result.  Both files are read on the driver only.
    """
    spark = docs.sparkSession
    with open(byte_bpe, "rb") as f, open(pieces, "rb") as g:
        files = f.read(), g.read()
    a, b = sides(*files)
    width, span = len(b.tokens), len(a.tokens) * len(b.tokens)
    held = spark.sparkContext.broadcast(files)
    pair = T.IntegerType() if span < 1 << 31 else T.LongType()
    long, ids = T.LongType(), T.ArrayType(T.IntegerType())
    fields = [*[T.StructField(n, long) for n in RESULT[:4]], T.StructField("groups_sha256", T.StringType()),
              T.StructField("_pairs", T.ArrayType(pair)), T.StructField("_times", T.ArrayType(long))]
    if spans:
        fields += [T.StructField("a_ids", ids), T.StructField("b_ids", ids), T.StructField("cuts", T.ArrayType(long))]

    def measure():
        left, right = sides(*held.value)

        def step(texts):
            one = Alignment(left, right, texts)
            pairs, times, sizes = one.pairs(width, span)
            groups = one.groups()
            out = [one.n[:, 0], one.n[:, 1], groups, one.links(), one.digests(left.digits, right.digits),
                   list_array(pairs, sizes, pa.int32() if span < 1 << 31 else pa.int64()), list_array(times, sizes, pa.int64())]
            if spans:
                begin = np.concatenate([[0], one.text_end[:-1]])
                out += [list_array(one.a, one.n[:, 0], pa.int32()), list_array(one.b, one.n[:, 1], pa.int32()),
                        list_array(one.cuts - begin[one.text], groups, pa.int64())]
            return out
        return step

    names = (*RESULT, "a_ids", "b_ids", "cuts") if spans else RESULT
    keep = [c for c in docs.columns if c.lower() not in names and c not in drop]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_in"), F.col(text_col).alias("_text"))
    has_text = F.coalesce(F.length("_text") > 0, F.lit(False))
    for salt in count():
        keys = [k.alias(f"_k{i}") for i, k in enumerate(text_keys(F.col("_text"), salt), 1)]
        distinct = rows.filter(has_text).select("_text", *keys).groupBy("_k1", "_k2", "_text").agg(F.count("*").alias("_n"))
        texts = written(map_texts(distinct, "_text", fields, measure, drop=("_text",))
                        .withColumn("_text_id", F.monotonically_increasing_id()))
        if texts.groupBy("_k1", "_k2").count().filter("count > 1").limit(1).count() == 0:
            break
    counts = (explode_rows(texts, ["_n"], F.col("_pairs"), "_pair").groupBy("_pair")
              .agg(F.sum("_n").alias("_count"), F.count("*").alias("_uses")).withColumn("_a", F.expr(f"_pair div {width}")))
    counts = written(counts)
    best = counts.groupBy("_a").agg(F.max("_count").alias("_best"))  # at most one row per id of A
    counts = written(counts.join(F.broadcast(best), "_a")
                     .select("_pair", "_count", "_uses", (F.col("_count") == F.col("_best")).cast("long").alias("_is_best")))
    links = explode_rows(texts, ["_text_id"], F.arrays_zip("_pairs", "_times"), "_link")
    links = links.select("_text_id", F.col("_link._pairs").alias("_pair"), F.col("_link._times").alias("_times"))
    total = counts.agg(F.sum("_uses")).first()[0] or 0
    sums = (lookup(links, counts, ["_pair"], "_uses", total, broadcast_pairs).groupBy("_text_id")
            .agg(F.sum(F.col("_times") * F.col("_is_best")).alias("n_best"), F.sum(F.col("_times") * F.col("_count")).alias("count_sum")))
    measured = written(texts.drop("_pairs", "_times").join(sums, "_text_id", "left").drop("_text_id")
                       .fillna(0, ["n_best", "count_sum"]))
    keyed = rows.filter(has_text).select("_in", *keys)
    result = [*RESULT, *(["a_ids", "b_ids", "cuts"] if spans else [])]
    found = lookup(keyed, measured, ["_k1", "_k2"], "_n", measured.agg(F.sum("_n")).first()[0] or 0)
    if spans:
        for c in ("a_ids", "b_ids", "cuts"):
            found = found.withColumn(c, F.when(F.col("n_a") > 0, F.col(c)))
    empty = rows.filter(~has_text).select("_in.*", *[F.lit(0).cast("long").alias(c) for c in RESULT[:-1]], F.lit("").alias("groups_sha256"),
                                          *([F.lit(None).cast(t).alias(c) for c, t in (("a_ids", "array<int>"), ("b_ids", "array<int>"), ("cuts", "array<long>"))] if spans else []))
    return found.select("_in.*", *result).unionByName(empty)
