r"""Operator 11, log probabilities of documents by prediction by partial matching.

A document is coded as its tokens: words (runs of ``[^\x20\x09-\x0D]``, A-Z lower-cased), each followed by a
space byte, and a newline byte for the end. The model is a trie of byte contexts: in the context
of up to ``order`` bytes before it (newlines before the first) a byte that followed the context c times in training gets
(2c - 1) / 2n, a byte that never did gets the escape probability q / 2n and is then
predicted in the context that is one byte shorter, down to the uniform distribution (n: all training bytes of the
context, q: distinct ones). Bytes seen in a longer context are excluded from the counts of the
shorter ones, so the probabilities of all bytes add up to 1. The code length of a document is the sum over its bytes.

The trie is never in one place. What identifies a leaf is a window: a byte and the ``order`` bytes
before it. Texts are put into chunks of some MB; a chunk's distinct windows, with their
training counts, go to shards by the two bytes before the predicted one, sorted and compressed. A shard therefore holds
the whole contexts of two bytes and more that end in these; at most 65,536 counts of
shorter contexts are summed and sent to all. Shards answer each chunk's windows with their log
probabilities, and a chunk's texts then look up their positions. Words meet their training counts the
same way, by a hash of the word, for ``base_score``. So each distinct window or word of a chunk moves,
not each occurrence; a context that is very frequent is one window of each chunk, and a document longer than a chunk
is scored in pieces that are added up.

Memory of a task: one chunk, or the distinct windows (words) of one shard, of which there are more for
more input (``shard_bytes``). Model and answers are stored or shuffled, so lost executors cost a recomputation only.

Defined results: null and empty texts are the end alone; a null doc_id is the row's id as any other, each row is scored
by itself; without training documents every byte is uniform and the base is log10(0.5 / 0.5) = 0 a token;
an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.llm.common import n_groups, read_table, stored, text_of, tidied
from tunesmith.llm.words import texts_of, words

ORDER = 5
CHUNK_BYTES = 8 << 20
#: Positions of a chunk that are looked up at a time.
STEP = 1 << 20
MOST_SHARDS = 4096
TEXTS, WINDOWS, WORDS = 2, 0, 1  # kinds of rows; a chunk's texts come after the answers


# ------------------------------------------------------------------ compressed columns


def _shrunk(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(raw)


def _grown(z: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(z)


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed."""
    size = values.dtype.itemsize
    return _shrunk(np.ascontiguousarray(values.view(np.uint8).reshape(-1, size).T).tobytes())


def unpack_numbers(z: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(_grown(z), np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack_numbers(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(z: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(z, np.uint64), dtype=np.uint64)


# ------------------------------------------------------------------ windows


def windows(data: np.ndarray, order: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """The windows of positions order + first to order + last: the byte before, the one before that, ..., and
    in the lowest byte the one to predict."""
    n = (len(data) - order if last is None else last) - first
    key = data[order - 1 + first : order - 1 + first + n].astype(np.uint64)
    for j in range(2, order + 1):
        key <<= np.uint64(8)
        key |= data[order - j + first : order - j + first + n]
    key <<= np.uint64(8)
    key |= data[order + first : order + first + n]
    return key


def shard_of(keys: np.ndarray, order: int, n_shards: int) -> np.ndarray:
    pair = (keys >> np.uint64(8 * (order - 1))).astype(np.uint32)
    mixed = (pair * np.uint32(2654435761)) ^ (pair >> np.uint32(3))
    return ((mixed >> np.uint32(8)) % np.uint32(n_shards)).astype(np.uint16)


def distinct(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of a sorted array."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)


class Pieces:
    """The texts of a chunk: pieces of documents, each after the ``order`` bytes that precede it."""

    def __init__(self, order: int):
        self.order, self.data, self.meta, self.size, self.ended = order, [], [], 0, 0
        self.trained: Counter = Counter()
        self.held: set = set()

    def add(self, left: bytes, body: bytes, some: list[bytes], row: int, doc_id: int | None, train: bool, ends: bool) -> None:
        self.data.append(left + body)
        self.size += len(self.data[-1])
        self.meta.append((row, len(self.data[-1]), doc_id or 0, doc_id is None, train, ends))
        if train:
            self.trained.update(some)
            self.ended += ends
        else:
            self.held.update(some)


def _bodies(starts: np.ndarray, order: int) -> np.ndarray:
    """The places in ``windows`` whose byte to predict is in the first ``order`` bytes of a piece, except the first piece's."""
    return (starts[1:, None] - order + np.arange(order)).ravel()


def sorted_bodies(keys: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """``keys`` without the places ``spread``, sorted; in place."""
    keys[spread] = np.uint64(0xFFFFFFFFFFFFFFFF)  # windows have fewer bits
    keys.sort()
    return keys[: len(keys) - len(spread)]


META = np.dtype([("row", "<i8"), ("n", "<i8"), ("doc_id", "<i8"), ("null", "?"), ("train", "?"), ("ends", "?")])


def chunks(docs: DataFrame, order: int, n_shards: int, chunk_bytes: int) -> DataFrame:
    """Rows (kind, chunk, shard, a, b, ended) of ``docs`` (doc_id, text, train): of each chunk its texts, and
    for each shard its distinct windows and words with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows_seen, made = TaskContext.get().partitionId() << 32, 0, 0

        def flush(p: Pieces) -> Iterator[pa.RecordBatch]:
            nonlocal made
            chunk, made = part + made, made + 1
            data = np.frombuffer(b"".join(p.data), np.uint8)
            meta = np.array(p.meta, META)
            out = [(TEXTS, -1, _shrunk(data.tobytes()), meta.tobytes(), p.ended)]
            ends = np.cumsum(meta["n"])
            keys = windows(data, order)
            keys <<= np.uint64(1)
            keys |= np.repeat(meta["train"], meta["n"])[order:]
            keys = sorted_bodies(keys, _bodies(np.concatenate([[0], ends[:-1]]), order))
            train = (keys & np.uint64(1)).astype(np.uint8)
            keys >>= np.uint64(1)
            at = distinct(keys)
            counts = np.add.reduceat(train, at, dtype=np.uint64)
            keys = keys[at]
            shard = shard_of(keys, order, n_shards)
            by = np.argsort(shard, kind="stable")
            cuts = np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=n_shards))])
            for s in range(n_shards):
                mine = by[cuts[s] : cuts[s + 1]]
                if len(mine):
                    out.append((WINDOWS, s, pack_sorted(keys[mine]), pack_numbers(counts[mine]), 0))
            groups: list[list[bytes]] = [[] for _ in range(n_shards)]
            for w in sorted(p.held.union(p.trained)):
                groups[zlib.crc32(w) % n_shards].append(w)
            for s, some in enumerate(groups):
                if some:
                    out.append((WORDS, s, _shrunk(b" ".join(some)), pack_numbers(np.array([p.trained.get(w, 0) for w in some], np.uint64)), 0))
            for first in range(0, len(out), 256):
                kind, shard_no, a, b, ended = zip(*out[first : first + 256], strict=True)
                yield pa.RecordBatch.from_pydict(
                    {"kind": pa.array(kind, pa.int32()), "chunk": pa.array([chunk] * len(kind), pa.int64()), "shard": pa.array(shard_no, pa.int32()), "a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "ended": pa.array(ended, pa.int64())}
                )

        held = Pieces(order)
        for batch in batches:
            for doc_id, train, text in zip(batch.column("doc_id").to_pylist(), batch.column("train").to_pylist(), texts_of(batch.column("text")), strict=True):
                row, left = part + rows_seen, b"\n" * order
                rows_seen += 1
                parts = [*words(text)] if len(text) < CHUNK_BYTES else words(text)
                before: list[bytes] | None = None
                for some in parts:
                    if before:
                        body = b" ".join(before) + b" "
                        held.add(left, body, before, row, doc_id, train, False)
                        left = (left + body)[-order:]
                        if held.size >= chunk_bytes:
                            yield from flush(held)
                            held = Pieces(order)
                    before = some
                held.add(left, b" ".join([*(before or []), b"\n"]), before or [], row, doc_id, train, True)
                if held.size >= chunk_bytes:
                    yield from flush(held)
                    held = Pieces(order)
        if held.data:
            yield from flush(held)

    return docs.mapInArrow(tidied(run), "kind int, chunk long, shard int, a binary, b binary, ended long")


# ------------------------------------------------------------------ model


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, n = np.concatenate([np.empty(0, np.uint64), *keys]), np.concatenate([np.empty(0, np.uint64), *counts])
    by = np.argsort(every, kind="stable")
    every, n = every[by], n[by]
    at = distinct(every)
    return every[at], np.add.reduceat(n, at) if len(at) else n


class Contexts:
    """One shard of the trie, with the counts of contexts of at most one byte."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int):
        self.order, self.levels = order, [None] * (order + 1)
        one = pairs.reshape(256, 256).astype(np.int64)
        zero = one.sum(axis=0)
        # By context: n, q and what a longer context's bytes hold here.
        self.one, self.zero = one, zero
        self.one_n, self.one_q, self.one_e = one.sum(axis=1), (one > 0).sum(axis=1), (one > 0) @ zero
        self.zero_n, self.zero_q = int(zero.sum()), int((zero > 0).sum())
        counts = counts.astype(np.int64)
        below = None
        for k in range(2, order + 1):
            gram = self._gram(keys, k)
            by = np.argsort(gram, kind="stable")
            gram, c = gram[by], counts[by]
            at = distinct(gram)
            gram, c = gram[at], np.add.reduceat(c, at) if len(at) else c
            context = gram >> np.uint64(8)
            start = distinct(context)
            if k == 2:
                shorter = one[(context >> np.uint64(8)).astype(np.int64), (gram & np.uint64(255)).astype(np.int64)]
            else:
                g, n = below
                shorter = n[np.searchsorted(g, ((context >> np.uint64(8)) << np.uint64(8)) | (gram & np.uint64(255)))]
            total = [np.add.reduceat(x, start) if len(start) else x for x in (c, shorter)]
            self.levels[k] = (gram, c, context[start], total[0], np.diff(np.append(start, len(gram))), total[1])
            below = (gram, c)

    def _gram(self, keys: np.ndarray, k: int) -> np.ndarray:
        """The k bytes before and the byte to predict."""
        return ((keys >> np.uint64(8 * (self.order - k + 1))) << np.uint64(8)) | (keys & np.uint64(255))

    @staticmethod
    def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sorted_keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
        return at, sorted_keys[at] == keys

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """The log probability of the byte of each window."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))  # those not found yet
        seen_n, seen_q = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)  # excluded from the next level
        for k in range(self.order, -1, -1):
            here = keys[left]
            byte = (here & np.uint64(255)).astype(np.int64)
            if k >= 2:
                gram, c, context, n, q, e = self.levels[k]
                wanted = self._gram(here, k)
                at, hit = self._find(context, wanted >> np.uint64(8))
                if not hit.any():
                    continue
                total, kinds, shorter = (np.where(hit, x[at], 0) for x in (n, q, e))
                at, hit = self._find(gram, wanted)
                count = np.where(hit, c[at], 0)
            elif k == 1:
                before = (here >> np.uint64(8 * self.order)).astype(np.int64)
                total, kinds, shorter, count = self.one_n[before], self.one_q[before], self.one_e[before], self.one[before, byte]
            else:
                total, kinds, shorter, count = np.full(len(here), self.zero_n), np.full(len(here), self.zero_q), 0, self.zero[byte]
            n_left, q_left = total - seen_n, kinds - seen_q
            some, found = n_left > 0, count > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                out[left] += np.where(some, np.log10(np.where(found, 2 * count - 1, q_left) / (2 * n_left)), 0.0)
            known = total > 0
            seen_n, seen_q = np.where(known, shorter, seen_n)[~found], np.where(known, kinds, seen_q)[~found]
            left = left[~found]
        out[left] -= np.log10(np.maximum(1, 256 - self.zero_q))
        return out


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[dict]]]:
    """Rows grouped by their shard, in the order in which they come."""
    from itertools import groupby

    rows = (r for batch in batches for r in batch.to_pylist())
    yield from groupby(rows, key=lambda r: r["shard"])


MERGE_AT = 1 << 21


def window_model(table: DataFrame, order: int, n_shards: int) -> DataFrame:
    """shard, a (windows seen in training), b (their counts), pairs (their counts by the byte before and the byte)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            keys: list[np.ndarray] = []
            counts: list[np.ndarray] = []
            waiting = 0
            for r in rows:
                n = unpack_numbers(r["b"], np.uint64)
                keys.append(unpack_sorted(r["a"])[n > 0])
                counts.append(n[n > 0])
                waiting += len(keys[-1])
                if waiting > MERGE_AT + 2 * len(keys[0]):
                    one, two = _merged(keys, counts)
                    keys, counts, waiting = [one], [two], 0
            every, n = _merged(keys, counts)
            pair = (every >> np.uint64(8 * order)).astype(np.int64) * 256 + (every & np.uint64(255)).astype(np.int64)
            held = np.bincount(pair, n, minlength=1 << 16).astype(np.int64)
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "a": pa.array([pack_sorted(every)], pa.binary()), "b": pa.array([pack_numbers(n)], pa.binary()), "pairs": pa.array([at.tolist()], pa.list_(pa.int64())), "pair_counts": pa.array([held[at].tolist()], pa.list_(pa.int64()))}
            )

    mine = table.filter(F.col("kind") == WINDOWS).select("shard", "a", "b")
    return mine.repartition(n_shards, "shard").sortWithinPartitions("shard").mapInArrow(tidied(run), "shard int, a binary, b binary, pairs array<long>, pair_counts array<long>")


def word_model(table: DataFrame, n_shards: int) -> DataFrame:
    """shard, a (words seen in training), b (their counts), distinct, total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            held: Counter = Counter()
            for r in rows:
                held.update({w: n for w, n in zip(_grown(r["a"]).split(b" "), unpack_numbers(r["b"], np.uint64).tolist(), strict=True) if n})
            some = sorted(held)
            counts = np.array([held[w] for w in some], np.uint64)
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "a": pa.array([_shrunk(b" ".join(some))], pa.binary()), "b": pa.array([pack_numbers(counts)], pa.binary()), "distinct": pa.array([len(some)], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64())}
            )

    mine = table.filter(F.col("kind") == WORDS).select("shard", "a", "b")
    return mine.repartition(n_shards, "shard").sortWithinPartitions("shard").mapInArrow(tidied(run), "shard int, a binary, b binary, distinct long, total long")


# ------------------------------------------------------------------ answers


def answers(table: DataFrame, model: DataFrame, kind: int, n_shards: int, make, reply) -> DataFrame:
    """kind, chunk, shard, a: what ``reply(make(model row), row)`` says to each chunk's row of this kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            held = None
            for r in rows:
                if r["chunk"] < 0:  # sorted before the chunks
                    held = make(r)
                    continue
                yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "chunk": pa.array([r["chunk"]], pa.int64()), "shard": pa.array([shard], pa.int32()), "a": pa.array([reply(held, r)], pa.binary())})

    asked = table.filter(F.col("kind") == kind).select("shard", "chunk", "a", F.lit(None).cast("binary").alias("b"))
    known = model.select("shard", F.lit(-1).cast("long").alias("chunk"), "a", "b")
    together = known.unionByName(asked).repartition(n_shards, "shard").sortWithinPartitions("shard", "chunk")
    return together.mapInArrow(tidied(run), "kind int, chunk long, shard int, a binary")


def finished(table: DataFrame, replies: DataFrame, order: int, n_shards: int, totals: tuple[int, int, int]) -> DataFrame:
    """doc_id, train, n_tokens, n_known, base_score, score of each row."""
    all_tokens, kinds, ends = totals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def base(counts: np.ndarray) -> np.ndarray:
            return np.log10((counts + 0.5) / (all_tokens + 0.5 * (kinds + 1)))

        end_base = float(base(np.array([ends]))[0])
        shards: dict[int, np.ndarray] = {}
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == WINDOWS:
                    shards[r["shard"]] = unpack_numbers(r["a"], np.float32)
                    continue
                if r["kind"] == WORDS:
                    found[r["shard"]] = unpack_numbers(r["a"], np.uint64)
                    continue
                data, meta = np.frombuffer(_grown(r["a"]), np.uint8), np.frombuffer(r["b"], META)
                starts = np.concatenate([[0], np.cumsum(meta["n"])])
                spread = _bodies(starts[:-1], order)
                keys = sorted_bodies(windows(data, order), spread)
                keys = keys[distinct(keys)]
                shard, logs = shard_of(keys, order, n_shards), np.empty(len(keys))
                for s, values in shards.items():
                    logs[shard == s] = values
                place, each = pd.Index(keys), np.zeros(len(data), np.float32)
                for a in range(0, len(data) - order, STEP):
                    b = min(a + STEP, len(data) - order)
                    each[order + a : order + b] = logs[place.get_indexer(windows(data, order, a, b))]
                each[order + spread] = 0.0
                scores = np.add.reduceat(each, starts[:-1], dtype=np.float64)
                del place, each, keys
                # The words in the order in which the chunk listed them.
                raw, distinct_words = data.tobytes(), set()
                bodies = [(s + order, s + n) for s, n in zip(starts[:-1].tolist(), meta["n"].tolist(), strict=True)]
                for s, e in bodies:
                    distinct_words.update(raw[s:e].split())
                groups: list[list[bytes]] = [[] for _ in range(n_shards)]
                for w in sorted(distinct_words):
                    groups[zlib.crc32(w) % n_shards].append(w)
                listed = [w for g in groups for w in g]
                counts = np.concatenate([np.empty(0, np.uint64), *(found[s] for s in sorted(found))])
                value = dict(zip(listed, base(counts.astype(np.float64)).tolist(), strict=True))
                new = {w for w, c in zip(listed, counts.tolist(), strict=True) if not c}
                n_tokens, n_known, sums = [], [], []
                for (s, e), last in zip(bodies, meta["ends"].tolist(), strict=True):
                    x = raw[s:e].split()
                    n_tokens.append(len(x) + last)
                    n_known.append(len(x) - sum(map(new.__contains__, x)) + (last and ends > 0))
                    sums.append(sum(map(value.__getitem__, x)) + (end_base if last else 0.0))
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(meta["row"]), "doc_id": pa.array(meta["doc_id"], mask=meta["null"].copy()), "train": pa.array(meta["train"].copy()),
                        "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(sums, pa.float64()), "score": pa.array(scores),
                    }
                )
                shards, found = {}, {}

    texts = table.filter(F.col("kind") == TEXTS).select("kind", "chunk", "shard", "a", "b")
    together = replies.withColumn("b", F.lit(None).cast("binary")).unionByName(texts).repartition("chunk").sortWithinPartitions("chunk", "kind", "shard")
    pieces = together.mapInArrow(tidied(run), "row long, doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    return pieces.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("train").alias("train"), *sums).drop("row")


def score_documents(docs: DataFrame, train: Column, order: int = ORDER, chunk_bytes: int = CHUNK_BYTES, shard_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs`` (doc_id,
    text), by the model of the rows for which ``train`` holds (null: it does)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.coalesce(train, F.lit(True)).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = min(MOST_SHARDS, n_groups(size, shard_bytes))
    table = stored(chunks(rows, order, n_shards, chunk_bytes), "ppm-chunks")
    model = stored(window_model(table, order, n_shards), "ppm-windows")
    counted = stored(word_model(table, n_shards), "ppm-words")
    pairs = np.zeros(1 << 16, np.int64)
    summed = model.select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("p")).groupBy("p.pairs").agg(F.sum("p.pair_counts").alias("n"))
    for r in summed.collect():  # at most 65,536 rows
        pairs[r.pairs] = r.n
    ends = table.agg(F.sum("ended")).first()[0] or 0
    known = counted.agg(F.sum("distinct").alias("distinct"), F.sum("total").alias("total")).first()
    totals = ((known.total or 0) + ends, (known.distinct or 0) + (ends > 0), ends)
    sent = spark.sparkContext.broadcast(pairs)

    def contexts(r: dict | None) -> Contexts:
        none = np.empty(0, np.uint64)
        return Contexts(unpack_sorted(r["a"]) if r else none, unpack_numbers(r["b"], np.uint64) if r else none, sent.value, order)

    def counts(r: dict) -> dict[bytes, int]:
        return dict(zip(_grown(r["a"]).split(b" "), unpack_numbers(r["b"], np.uint64).tolist(), strict=False))

    windows_said = answers(table, model, WINDOWS, n_shards, contexts, lambda held, r: pack_numbers((held or contexts(None)).log10(unpack_sorted(r["a"])).astype(np.float32)))
    words_said = answers(table, counted, WORDS, n_shards, counts, lambda held, r: pack_numbers(np.array([(held or {}).get(w, 0) for w in _grown(r["a"]).split(b" ")], np.uint64)))
    out = finished(table, windows_said.unionByName(words_said), order, n_shards, totals)
    return out.withColumn("train_tokens", F.lit(totals[0]).cast("long"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents by the model of those outside the held-out fold."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    out = score_documents(read_table(spark, sf_dir, "documents"), remainder != 1)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
