"""Operator 8, packing: cost-balanced assignment of document pieces to sequences.

Each document's ids (with an end id) are cut into pieces of the full capacity, which
are sequences of their own, and one rest. The rests of a group of documents get as many
sequences as their ids fill, and are assigned in descending length, each to the
sequence of lowest estimated cost ``linear * n + quadratic * n^2`` (summed over its
pieces, as attention stays within a document) that still has room for it. Where no
sequence has room for the whole rest, it is cut over those of lowest cost with any
room. So a group leaves less than one sequence's padding.

Documents are dealt to groups of about ``docs_per_group`` by a hash, whatever their source
or length; a row brings only its rest and a checksum for each full piece to its group.
Null text is empty (one end id). Repeated doc_ids are packed as separate documents; an
empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.llm.common import n_groups, read_table, text_of, tidied
from tunesmith.llm.tokens import encoder, tokenizer_path

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def assign(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(rest, first id in it, ids, sequence, place in the sequence) of every piece of the rests."""
    sequences = -(-int(lengths.sum()) // capacity)
    cost, room = np.zeros(sequences), np.full(sequences, capacity)
    pieces = []
    for i in np.argsort(-lengths, kind="stable"):
        first, left = 0, int(lengths[i])
        while left:
            fits = room >= left
            s = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
            n = min(left, int(room[s]))
            pieces.append((int(i), first, n, s, capacity - int(room[s])))
            cost[s] += linear * n + quadratic * n * n
            room[s] -= n
            first, left = first + n, left - n
    return pieces


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, linear: float = 1.0, quadratic: float = 1.0 / 1024, docs_per_group: int = 2048) -> DataFrame:
    """The pieces of all ``docs`` (doc_id, text) and where they go: the columns of ``PIECES``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for at, flat, offsets in enc.encode_column(batch.column("text")):
                rows = [np.concatenate([flat[a:b], end], dtype="<u4") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                full = [len(ids) // capacity for ids in rows]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(at, len(rows)),
                        "n": pa.array([len(ids) for ids in rows], pa.int64()),
                        "full": pa.array([[zlib.crc32(ids[k * capacity : (k + 1) * capacity].tobytes()) for k in range(n)] for ids, n in zip(rows, full, strict=True)], pa.list_(pa.int64())),
                        "rest": pa.array([ids[n * capacity :].astype(enc.dtype).tobytes() for ids, n in zip(rows, full, strict=True)], pa.binary()),
                        "wide": pa.array([enc.dtype.itemsize] * len(rows), pa.int32()),
                    }
                )

    def group(key: tuple, docs: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values(["null", "doc_id", "n", "rest"], ignore_index=True)
        out, top = [], int(key[0]) << 32
        ids_of = [None if null else d for d, null in zip(docs["doc_id"].tolist(), docs["null"], strict=True)]
        n_of = docs["n"].to_numpy()
        used = 0
        for d, n, sums in zip(ids_of, n_of, docs["full"], strict=True):
            for k, crc in enumerate(sums):
                out.append((d, k * capacity, capacity, crc, n, top + used, 0))
                used += 1
        rests = [np.frombuffer(r, dtype=f"<u{w}").astype("<u4") for r, w in zip(docs["rest"], docs["wide"], strict=True)]
        for i, first, n, s, place in assign(np.array([len(r) for r in rests], dtype=np.int64), capacity, linear, quadratic):
            out.append((ids_of[i], int(n_of[i]) - len(rests[i]) + first, n, zlib.crc32(rests[i][first : first + n].tobytes()), n_of[i], top + used + s, place))
        pieces = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"], dtype=object)
        return pieces.astype({c: "Int64" for c in pieces})  # null ids stay exact integers

    groups = n_groups(docs.count(), docs_per_group)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    pieces = rows.mapInArrow(tidied(cut), "doc_id long, n long, full array<long>, rest binary, wide int")
    dealt = pieces.withColumn("g", F.pmod(F.xxhash64("doc_id", "rest"), F.lit(groups)).cast("int"))
    dealt = dealt.withColumn("null", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
    return dealt.groupBy("g").applyInPandas(group, PIECES)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents with byte_bpe_50k.json and end id 0, in sequences of 1,024."""
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0)
