"""Line dedup: explode normalised lines, hash them, count the documents per
hash, drop the lines over the threshold and reassemble by position.

Plan: one Python pass emits the distinct 128-bit line keys of each document;
one aggregate per key (map-side combined, so a line that a third of all
documents hold leaves each task as one row) keeps the keys held by enough
documents, written as a table; a join with it (a broadcast only after its
rows are counted, else a shuffle whose hot keys AQE can split) finds, per
document, the keys it loses; one join by document brings that list to the
text, and the kept lines are put together in their order.  Only keys and document ids are shuffled by key,
texts move once, by document id.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import WHITE, broadcast_if_small, give_back, map_texts, pieces, written


def line_keys(text: str | None, min_chars: int) -> list[tuple[str, bytes | None]]:
    """(line, key) of each line; the key is None for lines too short to count."""
    import xxhash

    out = []
    for line in (text or "").split("\n"):
        core = line.strip(WHITE)
        out.append((line, xxhash.xxh3_128_digest(core.encode().lower()) if len(core) >= min_chars else None))
    return out


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 10, threshold: int = 2, min_share: float = 0.0) -> DataFrame:
    """Documents with every repeated line removed except in the smallest id
    that holds it; all columns kept, ``n_lines`` and ``n_dropped`` added.

    A line's key is the line stripped of ASCII white space with A-Z lowered.
    A key of at least ``min_chars`` code points found in at least
    ``threshold`` documents loses all its lines in all documents but the one
    with the smallest id; that one keeps all of its own.  Null and empty
    texts are one empty line and come back as "".  Rows that share an id are
    one document for the count and are each rewritten; rows with a null id
    are left as they are.  A document that loses lines and keeps less than
    ``min_share`` of its words is left out (none at 0).  An input column named ``n_lines`` or
    ``n_dropped`` is replaced.  Keys are 128-bit hashes.
    """
    def keys():
        def step(texts):
            sets = [{k for _, k in line_keys(t, min_chars) if k is not None} for t in texts]
            return [pa.array([list(s) for s in sets], pa.list_(pa.binary()))]
        return step

    ids = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter("_id is not null")
    held = (map_texts(ids, "_text", [T.StructField("_keys", T.ArrayType(T.BinaryType()))], keys, drop=("_text",))
            .select("_id", F.explode("_keys").alias("_k")))
    if threshold <= 2:  # two different ids: the smallest and the largest differ
        common = (held.groupBy("_k").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
                  .filter("_first < _last"))
    else:
        common = (held.groupBy("_k").agg(F.min("_id").alias("_first"), F.count_distinct("_id").alias("_n"))
                  .filter(F.col("_n") >= threshold))
    common = broadcast_if_small(written(common.select("_k", "_first")), 200_000)
    lost = (held.join(common, "_k").filter("_id <> _first")
            .groupBy(F.col("_id").alias("__ld_id")).agg(F.collect_set("_k").alias("__ld_lost")))  # at most the document's own lines
    return _reassemble(docs.join(lost, docs[id_col] == lost["__ld_id"], "left").drop("__ld_id"), text_col, min_chars, min_share)


def _reassemble(df: DataFrame, text_col: str, min_chars: int, min_share: float) -> DataFrame:
    names = [f.name for f in df.schema.fields if f.name not in ("__ld_lost",) and f.name.lower() not in ("n_lines", "n_dropped")]
    schema = T.StructType([df.schema[n] for n in names]
                          + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def run(batches):
        for batch in batches:
            for part in pieces(batch, text_col):
                texts, total, gone, stays = [], [], [], []
                for text, lost in zip(part.column(text_col).to_pylist(), part.column("__ld_lost").to_pylist()):
                    if not lost:
                        texts.append(text or "")
                        total.append((text or "").count("\n") + 1)
                        gone.append(0)
                        stays.append(True)
                        continue
                    lost = set(lost)
                    lines = line_keys(text, min_chars)
                    kept = [line for line, k in lines if k not in lost]
                    texts.append("\n".join(kept))
                    total.append(len(lines))
                    gone.append(len(lines) - len(kept))
                    stays.append(min_share <= 0 or len(texts[-1].encode().split()) >= min_share * len(text.encode().split()))
                cols = [pa.array(texts, part.schema.field(n).type) if n == text_col else part.column(n) for n in names]
                out = pa.RecordBatch.from_arrays(cols + [pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                                 names=[f.name for f in schema.fields])
                yield out if all(stays) else out.filter(pa.array(stays))
        give_back()

    return df.mapInArrow(run, schema)
