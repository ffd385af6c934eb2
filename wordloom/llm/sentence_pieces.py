"""SentencePiece encoding and decoding by a batched numpy Viterbi.

A text is cut into words (white space with the run of other characters that
follows), no piece reaches over such a cut, so each distinct word is
segmented once.  Words of equal length advance together: for every position
and every length the hash of the substring is probed in the sorted hashes of
the pieces, a vectorised maximum keeps the best score of each prefix and a
backpointer, and the pieces are read back from the end.  Characters that no
piece covers become byte pieces, so decoding gives the text back.

The vocabulary is a SentencePiece model file (a parameter, never copied);
its pieces and scores are used as they are: the segmentation with the
largest sum of scores wins.  No shuffle; each task keeps a bounded cache of
words already segmented.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wordloom.llm.common import list_array, map_texts

MODEL = os.environ.get("WORDLOOM_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
SPACE = "▁"
#: A run of spaces and the other characters after it: one segment for the Viterbi.
SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Cells of the probe table (words x positions x piece lengths) held at once.
STEP = 1 << 19
#: Words that a task remembers.
CACHE = 200_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _char_hash(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


class Pieces:
    """Pieces of a model file, with the encoder and the decoder."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.unknown = sp.unk_id()
        self.byte_ids = np.full(256, self.unknown, np.int32)
        self.bytes_of: list[bytes] = [b""] * n
        texts, ids, scores = [], [], []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
                texts.append(piece)
                ids.append(i)
                scores.append(sp.get_score(i))
        if any(SPACE in t.lstrip(SPACE) for t in texts):
            raise ValueError("a piece reaches over a word boundary")
        # Pieces that only merge rules could reach carry a score far below the others; they stay usable.
        scores = np.array(scores)
        self.longest = max(map(len, texts))
        self.miss = scores[scores > -1e8].min() - 10.0
        by_length: dict[int, list[int]] = {}
        for k, t in enumerate(texts):
            by_length.setdefault(len(t), []).append(k)
        hashes = np.zeros(len(texts), np.uint64)
        for length, at in by_length.items():
            codes = np.frombuffer("".join(texts[k] for k in at).encode("utf-32-le"), np.uint32).reshape(-1, length)
            hashes[at] = self._roll(codes)[length][:, 0]
        order = np.argsort(hashes)
        self.keys, self.ids, self.scores = hashes[order], np.array(ids, np.int32)[order], scores[order]
        self.occupied = np.zeros(1 << 20, bool)  # which leading 20 bits a key has: most substrings end here
        self.occupied[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces share a hash")
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.words: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.words.clear()
        self.tokens = np.zeros(0, np.int32)
        self.offsets = np.zeros(1, np.int64)

    def _roll(self, codes: np.ndarray) -> dict[int, np.ndarray]:
        """Per length, the hash of every substring of the rows of ``codes``."""
        h = _char_hash(codes)
        out, now = {1: h}, h
        for length in range(2, min(getattr(self, "longest", codes.shape[1]), codes.shape[1]) + 1):
            now = now[:, :-1] * _BASE + h[:, length - 1:]
            out[length] = now
        return out

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words x positions) codes of equally long words -> (length, id) of
        the best last piece of every prefix; id -1 stands for bytes.  The
        probe table covers a bounded block of positions at a time."""
        b, n = codes.shape
        m = self.longest
        best = np.full((m + n, b), -np.inf)  # row m - 1 + p: prefix of length p
        best[m - 1] = 0
        back = np.ones((n + 1, b), np.uint8)
        piece = np.full((n + 1, b), -1, np.int32)
        rows = np.arange(b)
        block = max(m, STEP // (b * m))
        for s in range(0, n, block):
            e, o = min(n, s + block), max(0, s - m + 1)
            score = np.full((e - s, b, m), -np.inf)  # by end and length
            ids = np.full((e - s, b, m), -1, np.int32)
            for length, h in self._roll(codes[:, o:e]).items():
                h = h[:, max(0, s + 1 - o - length):]
                row, col = np.nonzero(self.occupied[(h >> np.uint64(44)).astype(np.int64)])
                probe = h[row, col]
                at = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
                hit = self.keys[at] == probe
                row, col, at = row[hit], col[hit] + (e - s - h.shape[1]), at[hit]
                score[col, row, length - 1] = self.scores[at]
                ids[col, row, length - 1] = self.ids[at]
            single = score[:, :, 0]
            single[single == -np.inf] = self.miss
            for p in range(s + 1, e + 1):
                total = score[p - s - 1] + best[p - 1:p + m - 1][::-1].T  # column l - 1: a piece of length l
                last = total.argmax(1)
                best[p + m - 1] = total[rows, last]
                piece[p] = ids[p - s - 1, rows, last]
                back[p] = last + 1
        return back, piece

    def _segment(self, group: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a group of equally long words, one after another, and
        the number of ids of each."""
        n, b = len(group[0]), len(group)
        codes = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(b, n)
        length, piece = self.viterbi(codes)
        row, p = np.arange(b), np.full(b, n)
        rows, ids, ends = [], [], []
        while len(row):  # all words step back together
            rows.append(row)
            ids.append(piece[p, row])
            ends.append(p)
            p = p - length[p, row]
            row, p = row[p > 0], p[p > 0]
        rows, ids, ends = (np.concatenate(x[::-1]) for x in (rows, ids, ends))
        order = np.argsort(rows, kind="stable")
        rows, ids, ends = rows[order], ids[order], ends[order]
        missing = np.flatnonzero(ids < 0)
        if len(missing):  # characters without a piece, as their bytes
            chars = [chr(c).encode("utf-8", "surrogatepass") for c in codes[rows[missing], ends[missing] - 1].tolist()]
            size = np.ones(len(ids), np.int64)
            size[missing] = [len(c) for c in chars]
            wanted = np.repeat(ids, size)
            wanted[wanted < 0] = self.byte_ids[np.frombuffer(b"".join(chars), np.uint8)]
            ids, rows = wanted, np.repeat(rows, size)
        return ids, np.bincount(rows, minlength=b)

    def _learn(self, new: list[str]) -> None:
        """Segment the words that are not in the cache yet."""
        new.sort(key=len)
        ids, counts = [self.tokens], []
        a = 0
        while a < len(new):
            n, z = len(new[a]), a
            most = max(1, STEP // (n * self.longest))
            while z < len(new) and z - a < most and len(new[z]) == n:
                z += 1
            found, size = self._segment(new[a:z])
            ids.append(found)
            counts.append(size)
            a = z
        self.words.update(zip(new, range(len(self.words), len(self.words) + len(new))))
        self.tokens = np.concatenate(ids)
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(np.concatenate(counts))])

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids per text); a
        null or empty text has none."""
        split = [SEGMENT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        a = 0
        while a < len(split):  # as many texts as the cache can hold together
            seen: dict[str, None] = {}
            z = a
            while z < len(split) and (z == a or len(seen) < CACHE // 4):
                seen.update(dict.fromkeys(split[z]))
                z += 1
            new = [w for w in seen if w not in self.words]
            if len(self.words) + len(new) > CACHE:
                self._clear()
                new = list(seen)
            if new:
                self._learn(new)
            w = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split[a:z])), np.int64)
            start, size = self.offsets[w], self.offsets[w + 1] - self.offsets[w]
            ends = np.concatenate([[0], np.cumsum(size)])
            ids.append(self.tokens[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])])
            counts.append(np.diff(ends[np.concatenate([[0], np.cumsum([len(x) for x in split[a:z]])])]))
            a = z
        return np.concatenate(ids), np.concatenate(counts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 bytes of each text: the pieces' bytes without the space that
        encoding puts in front."""
        size = self.sizes[ids]
        total = int(size.sum())
        flat = self.flat[np.repeat(self.starts[ids] - (np.cumsum(size) - size), size) + np.arange(total)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
        return [flat[a + 1:b] if b - a and flat[a:a + 1] == b" " else flat[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]


_loaded: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """The vocabulary, loaded once per Python worker."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode_texts(df: DataFrame, text_col: str = "text", path: str = MODEL,
                 ids_col: str = "piece_ids", check: bool = True) -> DataFrame:
    """``df`` with ``piece_ids`` (array of int; null for a null text, empty
    for an empty one) and, with ``check``, ``round_trip`` (whether decoding
    gives the text back; true for null) added; input columns of these names
    are replaced.

    Ties between segmentations go to the shorter last piece.  The symbol
    U+2581, which SentencePiece uses for a space, is decoded as a space, so
    texts that hold it do not round-trip.  ``path`` must be readable on
    every executor.  Repeated rows get equal ids.
    """
    fields = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    if check:
        fields.append(T.StructField("round_trip", T.BooleanType()))

    def make():
        pieces = pieces_of(path)

        def step(texts):
            ids, counts = pieces.encode(texts)
            lists = list_array(ids, counts, pa.int32())
            if any(t is None for t in texts):
                lists = pa.ListArray.from_arrays(
                    pa.array(lists.offsets.to_numpy()[:-1].tolist() + [len(ids)], pa.int32()), lists.values,
                    mask=pa.array([t is None for t in texts]))
            if not check:
                return [lists]
            back = pieces.decode(ids, counts)
            return [lists, [t is None or b == t.encode("utf-8", "surrogatepass") for t, b in zip(texts, back)]]
        return step

    return map_texts(df, text_col, fields, make)


def decode_ids(df: DataFrame, ids_col: str = "piece_ids", text_col: str = "text", path: str = MODEL) -> DataFrame:
    """``df`` with ``text_col`` (replaced if it exists) decoded from the ids;
    null ids give a null text, ids outside the vocabulary are an error."""
    keep = [f for f in df.schema.fields if f.name.lower() != text_col.lower()]
    schema = T.StructType([*keep, T.StructField(text_col, T.StringType())])
    names = [f.name for f in keep]

    def run(batches):
        pieces = pieces_of(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                column = part.column(ids_col)
                counts = np.array([len(x) if x.is_valid else 0 for x in column], np.int64)
                texts = pieces.decode(column.flatten().to_numpy(zero_copy_only=False), counts)
                out = [t.decode("utf-8", "replace") if x.is_valid else None for t, x in zip(texts, column)]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(out, pa.string())],
                                                 names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)
