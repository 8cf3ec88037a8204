"""Operator 7, token-id output: bit-packed binary files of token ids, and their reader.

Every document is encoded whole, an end id is appended, and the ids are written in
ascending doc_id order to files of about ``ids_per_file`` ids. Each id takes the
minimum number of bits for the vocabulary. One file holds

    header     ``HEADER``: magic, bits of an id, ids in a block, part, number, documents, blocks, ids
    documents  ``DOC`` for each: doc_id, whether it is null, first id in this file, ids
    blocks     the byte offset of each block as uint64, counted from the first block
    payload    the blocks, each a little-endian bit stream padded to a whole uint32
    end        one newline

so ``ids_at`` unpacks any range with numpy after reading only the blocks that it
touches. Spark's own file writer commits the files (a task that is run again leaves no
second copy), so the folder may be in any store that Spark writes to.

Null text counts as empty (its only id is the end id); null doc_ids come first; repeated
doc_ids stay as separate rows; an empty table gives no documents. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunesmith.llm.common import read_table, stored, text_of, tidied
from tunesmith.llm.tokens import encoder, tokenizer_path
from tunesmith.session import shared_scratch

MAGIC = b"TKB1"
HEADER = struct.Struct("<4sIIIIIIIQ")  # magic, bits, ids in a block, part, number, documents, blocks, unused, ids
DOC = np.dtype([("doc_id", "<i8"), ("null", "<u8"), ("start", "<u8"), ("n", "<u8")])
IDS_PER_BLOCK = 4096
IDS_PER_FILE = 4_000_000


def bits_for(vocab_size: int) -> int:
    """The fewest bits that hold every id of the vocabulary."""
    return max(1, (vocab_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> np.ndarray:
    """A little-endian bit stream of ``bits`` bits for each id, as uint32 words.

    32 ids fill exactly ``bits`` words, so one numpy step handles the same position of
    all runs of 32 ids."""
    runs = -(-len(ids) // 32)
    x = np.zeros(runs * 32, dtype=np.uint64)
    x[: len(ids)] = ids
    x = x.reshape(runs, 32)
    words = np.zeros((runs, bits + 1), dtype=np.uint64)
    for j in range(32):
        word, shift = divmod(j * bits, 32)
        moved = x[:, j] << np.uint64(shift)
        words[:, word] |= moved & np.uint64(0xFFFFFFFF)
        words[:, word + 1] |= moved >> np.uint64(32)
    return words[:, :bits].astype("<u4").reshape(-1)[: -(-len(ids) * bits // 32)]


def unpack_bits(words: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of a bit stream."""
    runs = -(-n // 32)
    w = np.zeros((runs, bits + 1), dtype=np.uint64)
    flat = np.zeros(runs * bits, dtype=np.uint64)
    flat[: len(words)] = words[: runs * bits]
    w[:, :bits] = flat.reshape(runs, bits)
    out = np.empty((runs, 32), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(32):
        word, shift = divmod(j * bits, 32)
        out[:, j] = (((w[:, word] | (w[:, word + 1] << np.uint64(32))) >> np.uint64(shift)) & mask).astype(np.uint32)
    return out.reshape(-1)[:n]


def file_bytes(docs: list[tuple[int | None, np.ndarray]], bits: int, part: int, number: int) -> bytes:
    table = np.zeros(len(docs), dtype=DOC)
    sizes = np.array([len(ids) for _, ids in docs], dtype=np.uint64)
    table["doc_id"] = [0 if d is None else d for d, _ in docs]
    table["null"] = [d is None for d, _ in docs]
    table["n"] = sizes
    table["start"] = np.cumsum(sizes) - sizes
    ids = np.concatenate([i for _, i in docs])
    blocks = [pack_bits(ids[i : i + IDS_PER_BLOCK], bits).tobytes() for i in range(0, len(ids), IDS_PER_BLOCK)]
    lengths = np.array([len(b) for b in blocks], dtype=np.uint64)
    offsets = (np.cumsum(lengths) - lengths).astype("<u8")
    head = HEADER.pack(MAGIC, bits, IDS_PER_BLOCK, part, number, len(docs), len(blocks), 0, len(ids))
    return b"".join([head, table.tobytes(), offsets.tobytes(), *blocks])


class TokenFile:
    """A file of this format over its bytes (or a memory map of them)."""

    def __init__(self, content):
        magic, self.bits, self.per_block, self.part, self.number, n_docs, n_blocks, _, self.n_ids = HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEADER.size
        self.docs = np.frombuffer(content, DOC, n_docs, at)
        at += n_docs * DOC.itemsize
        self.offsets = np.frombuffer(content, "<u8", n_blocks, at)
        self.content, self.payload = content, at + n_blocks * 8

    def ids_at(self, start: int, n: int) -> np.ndarray:
        """ids [start, start + n): only the blocks that hold them are read."""
        first, last = start // self.per_block, -(-(start + n) // self.per_block)
        out = []
        for b in range(first, last):
            held = min(self.per_block, self.n_ids - b * self.per_block)
            words = np.frombuffer(self.content, "<u4", -(-held * self.bits // 32), self.payload + int(self.offsets[b]))
            out.append(unpack_bits(words, self.bits, held))
        every = np.concatenate(out) if out else np.empty(0, np.uint32)
        return every[start - first * self.per_block :][:n]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, ids_per_file: int = IDS_PER_FILE, partitions: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) and write the files below ``folder``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        bits, part, number = bits_for(max(enc.vocab_size, end_id + 1)), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype=np.uint32)
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def flush():
            return pa.RecordBatch.from_pydict({"content": pa.array([file_bytes(held, bits, part, number)], pa.binary())})

        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            for first, ids, offsets in enc.encode_column(batch.column("text")):
                for i, (at, to) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    held.append((ids_of[first + i], np.concatenate([ids[at:to], end], dtype=np.uint32)))
                    size += to - at + 1
                if size >= ids_per_file:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    dealt = rows.repartitionByRange(*([partitions] if partitions else []), "doc_id").sortWithinPartitions("doc_id")
    files = dealt.mapInArrow(tidied(encode), "content binary")
    files.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(folder)


def read_token_files(spark: SparkSession, folder: str, checksums: bool = False) -> DataFrame:
    """One row per document, from the files: doc_id, part, number, file_start (its first id in the
    file), file_ids (ids in the file, with its first document only), n_tokens, and its ids
    (array<int>) or, with ``checksums``, their ids_crc32 instead."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                f = TokenFile(content.as_buffer())
                step = 256
                for a in range(0, len(f.docs), step):
                    docs = f.docs[a : a + step]
                    first, sizes = int(docs["start"][0]), docs["n"].astype(np.int64)
                    ids = f.ids_at(first, int(sizes.sum()))
                    ends = np.cumsum(sizes)
                    n = len(docs)
                    rows = {
                        "doc_id": pa.array(docs["doc_id"], pa.int64(), mask=docs["null"].astype(bool)),
                        "part": pa.array(np.full(n, f.part, np.int32)),
                        "number": pa.array(np.full(n, f.number, np.int32)),
                        "file_start": pa.array(docs["start"].astype(np.int64)),
                        "file_ids": pa.array([f.n_ids if a + i == 0 else 0 for i in range(n)], pa.int64()),
                        "n_tokens": pa.array(sizes),
                    }
                    if checksums:
                        flat = ids.astype("<u4", copy=False)
                        rows["ids_crc32"] = pa.array([zlib.crc32(flat[e - s : e]) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)], pa.int64())
                    else:
                        rows["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32)))
                    yield pa.RecordBatch.from_pydict(rows)

    raw = spark.read.format("binaryFile").load(folder).select("content")
    return raw.mapInArrow(tidied(unpack), "doc_id long, part int, number int, file_start long, file_ids long, n_tokens long, " + ("ids_crc32 long" if checksums else "ids array<int>"))


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the files below ``folder``. The ids that stand
    before a file are summed over one row for each file."""
    rows = stored(read_token_files(spark, folder, checksums=True), "token-checksums")
    files = rows.filter("file_ids > 0").select("part", "number", "file_ids")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("part", "number", F.coalesce(F.sum("file_ids").over(before), F.lit(0)).alias("base"))
    return rows.join(base, ["part", "number"]).select("doc_id", (F.col("base") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32")


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents with byte_bpe_50k.json and end id 2, written and read back."""
    folder = shared_scratch(spark, "op7-files")
    write_token_files(read_table(spark, sf_dir, "documents"), folder, tokenizer_path(), end_id=2)
    return digest(spark, folder)
