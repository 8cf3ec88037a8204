"""Operator 12, ranked lexical search over bit-sliced Bloom signatures.

Index (``build_index``), made once for all queries; three tables in the shared folder:

* ``signatures``: documents of similar size are put into blocks; each document has a Bloom filter of
  m bits over its (term, level) keys, level j being present if the term occurs at least
  2^j times. A block is stored by bit slices: row i holds bit i of all its documents, so that the
  documents that may hold a key are the AND of ``HASHES`` rows. False positives occur, false
  negatives don't: presence is overestimated.
* ``vocabulary``: in how many documents each term occurs (tasks pre-aggregate, Spark sums).
* ``store``: block, row, doc_id and text of every document, for rescoring.

Search, for blocks of items that hold about ``item_terms`` terms each (only a block's terms are sent
to the tasks):

1. In each block of documents, the levels that are set give each term a greatest
   possible number of occurrences and thereby a greatest possible part of the score; the parts, weighted by the
   items' terms, add up to an upper bound for each item and document. A task keeps the
   2 k highest bounds of each item, Spark the 2 k highest of all, and these documents are scored exactly: the k-th
   exact score of an item is a lower bound of its final k-th score.
2. The bounds are taken again, and every document whose upper bound reaches that of step 1 is scored
   exactly from its text, all items of a document at once. No candidate is dropped. A task keeps its k best of each item.

Results: items, then rank from 1, by score and smaller doc_id (null ids last, repeated ids in any order; each row
counts as a document). Null and empty texts and items have no terms and are never found or answered; empty
tables give no rows. A text of any length is read piece by piece; it is one row of its block, whose slices then hold few documents.
Items that share an item_id are answered each, under that id.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunesmith.llm.common import n_groups, read_table, stored, tidied
from tunesmith.llm.words import terms, texts_of
from tunesmith.session import shared_scratch

HASHES = 4
BITS_PER_KEY = 12
BLOCK_DOCS = 1024
#: Bits of a block (documents x filter size) while it is made, one byte each.
BLOCK_CELLS = 1 << 24
VOCABULARY_ROWS = 300_000
#: Terms x documents whose greatest parts a task holds at a time.
BOUND_CELLS = 1 << 21


def _positions(keys: np.ndarray, m: int) -> np.ndarray:
    """HASHES bit positions below m (a power of two) for 64-bit keys."""
    low, high = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + np.arange(HASHES, dtype=np.uint64) * high[:, None]) & np.uint64(m - 1)).astype(np.int64)


def _level_keys(hashes: np.ndarray, level) -> np.ndarray:
    """The key of a term's level: its hash, mixed with the level."""
    x = hashes ^ (np.asarray(level, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _hashes(some: list[bytes]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(t) for t in some], np.uint64)


class _Maker:
    """Collects a task's documents by the size of their filter and makes blocks of them."""

    def __init__(self, part: int):
        self.part, self.made = part, 0
        self.held: dict[int, list] = defaultdict(list)

    def add(self, n: int, hashes: np.ndarray, counts: np.ndarray) -> tuple[int, int, dict | None]:
        """-> the block and row of a document, and a block if it is full now."""
        levels = np.floor(np.log2(counts)).astype(np.int64) + 1 if len(counts) else np.empty(0, np.int64)
        which = np.repeat(np.arange(len(levels)), levels)
        level = np.arange(len(which)) - np.repeat(np.cumsum(levels) - levels, levels)
        keys = _level_keys(hashes[which], level)
        m = max(64, 1 << math.ceil(math.log2(max(1, BITS_PER_KEY * len(keys) * 0.75))))
        rows = self.held[m]
        if not rows:
            rows.append((self.part << 32) + self.made)
            self.made += 1
        block, row = rows[0], len(rows) - 1
        rows.append((n, int(levels.max()) if len(levels) else 0, keys))
        full = len(rows) > min(BLOCK_DOCS, max(8, BLOCK_CELLS // m))
        return block, row, self.close(m) if full else None

    def close(self, m: int) -> dict:
        block, *rows = self.held.pop(m)
        bits = np.zeros((m, -(-len(rows) // 8) * 8), np.uint8)
        for i, (_, _, keys) in enumerate(rows):
            bits[_positions(keys, m), i] = 1
        return {"block": block, "m": m, "n": [r[0] for r in rows], "levels": max(r[1] for r in rows), "slices": np.packbits(bits, axis=1).tobytes()}


INDEX = "kind int, block long, row int, doc_id long, text string, m long, n array<long>, levels int, slices binary, term binary, df long"


class Index:
    """The tables of an index, and N (documents with a term) and L (all their terms)."""

    def __init__(self, signatures: DataFrame, vocabulary: DataFrame, store: DataFrame):
        self.signatures, self.vocabulary, self.store = signatures, vocabulary, store
        found = signatures.select(F.explode("n").alias("n")).filter("n > 0").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("t")).first()
        self.n_docs, self.n_terms = found.d, found.t or 0


def build_index(docs: DataFrame) -> Index:
    """The index of ``docs`` (doc_id, text); one pass over the texts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("text", pa.string()), ("m", pa.int64()), ("n", pa.list_(pa.int64())), ("levels", pa.int32()), ("slices", pa.binary()), ("term", pa.binary()), ("df", pa.int64())])

        def rows(kind: int, **columns) -> pa.RecordBatch:
            size = len(next(iter(columns.values())))
            full = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema if f.name != "kind"]
            return pa.RecordBatch.from_arrays([pa.array([kind] * size, pa.int32()), *full], schema=schema)

        def blocks(made: list[dict]) -> pa.RecordBatch:
            return rows(0, **{k: [b[k] for b in made] for k in ("block", "m", "n", "levels", "slices")})

        maker = _Maker(TaskContext.get().partitionId())
        number: dict[bytes, int] = {}  # term -> its place in the two lists
        hashed, df = np.empty(1 << 16, np.uint64), np.zeros(1 << 16, np.int64)
        for batch in batches:
            at = []
            for t in texts_of(batch.column("text")):
                counts: Counter = Counter()
                for some in terms(t):
                    counts.update(some)
                new = [w for w in counts if w not in number]
                first = len(number)
                number.update(zip(new, range(first, first + len(new)), strict=True))
                if len(number) > len(df):
                    more = max(len(number), 2 * len(df))
                    hashed, df = np.resize(hashed, more), np.concatenate([df, np.zeros(more - len(df), np.int64)])
                if new:
                    hashed[first : first + len(new)] = _hashes(new)
                ids = np.fromiter(map(number.__getitem__, counts), np.int64, len(counts))
                df[ids] += 1
                tf = np.fromiter(counts.values(), np.int64, len(counts))
                block, row, full = maker.add(int(tf.sum()), hashed[ids], tf)
                at.append((block, row))
                if full:
                    yield blocks([full])
                if len(number) > VOCABULARY_ROWS:
                    yield rows(2, term=list(number), df=df[: len(number)])
                    number, df = {}, np.zeros(len(df), np.int64)
            yield rows(1, block=[b for b, _ in at], row=[r for _, r in at], doc_id=batch.column("doc_id"), text=batch.column("text"))
        for m in list(maker.held):
            yield blocks([maker.close(m)])
        if number:
            yield rows(2, term=list(number), df=df[: len(number)])

    spark = docs.sparkSession
    folder = shared_scratch(spark, "lexical-index")
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidied(make), INDEX)
    made.write.partitionBy("kind").option("compression", "zstd").parquet(folder)
    table = spark.read.schema(INDEX).parquet(folder)
    vocabulary = table.filter("kind = 2").groupBy("term").agg(F.sum("df").alias("df"))
    return Index(
        table.filter("kind = 0").select("block", "m", "n", "levels", "slices"),
        stored(vocabulary, "lexical-vocabulary"),
        table.filter("kind = 1").select("block", "row", "doc_id", "text"),
    )


class Items:
    """A block of items: their terms' hashes and weights, and which terms, how often, each item holds."""

    def __init__(self, items: list[tuple[int, list[bytes]]], df: dict[bytes, int], n_docs: int, n_terms: int):
        # A term that no document holds adds nothing to any score.
        counted = [(i, Counter(t for t in some if t in df)) for i, some in items]
        counted = [(i, c) for i, c in counted if c]
        self.ids = [i for i, _ in counted]
        self.terms = sorted({t for _, c in counted for t in c})
        place = {t: i for i, t in enumerate(self.terms)}
        self.hashes = _hashes(self.terms)
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in self.terms], np.int64)
        self.at = [np.array([place[t] for t in c], np.int64) for _, c in counted]
        self.times = [np.array(list(c.values()), np.int64) for _, c in counted]
        self.n_docs, self.n_terms = n_docs, n_terms

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """m of the score for documents of n terms."""
        return 75 + (25 * n * self.n_docs) // self.n_terms

    def bounds(self, m: int, n: np.ndarray, levels: int, slices: bytes) -> np.ndarray:
        """Upper bounds of the scores, items x documents of a block."""
        rows = np.frombuffer(slices, np.uint8).reshape(m, -1)
        length = self.lengths(n)
        out = np.zeros((len(self.ids), len(n)), np.int64)
        step = 8 * max(1, BOUND_CELLS // (8 * len(self.terms)))
        for a in range(0, len(n), step):
            part = self._parts(rows[:, a // 8 : (a + step) // 8], m, n[a : a + step], length[a : a + step], levels)
            for i, (at, times) in enumerate(zip(self.at, self.times, strict=True)):
                out[i, a : a + step] = times @ part[at]
        return out

    def _parts(self, rows: np.ndarray, m: int, n: np.ndarray, length: np.ndarray, levels: int) -> np.ndarray:
        """The greatest possible weighted part of each term in each document."""
        part = np.zeros((len(self.terms), len(n)), np.int64)
        here, below = np.arange(len(self.terms)), None
        for level in range(levels):
            # The levels of a term nest, so only terms that some document may hold at the level below go on.
            may = np.bitwise_and.reduce(rows[_positions(_level_keys(self.hashes[here], level), m)], axis=1)
            if below is not None:
                may &= below
            some = may.any(axis=1)
            here, below = here[some], may[some]
            if not len(here):
                break
            most = np.minimum(n, (2 << level) - 1)
            value = (1_000_000_000 * most) // (1000 * most + 12 * length)
            seen = np.unpackbits(below, axis=1, count=len(n)).astype(bool)
            part[here] = np.where(seen, value[None, :], part[here])
        return part * self.weights[:, None]

    def scores(self, which: list[int], counts: Counter, n: int) -> list[int]:
        """The exact scores of some items in a document."""
        length, found = int(self.lengths(np.array([n]))[0]), {}

        def part(t: int) -> int:
            if t not in found:
                tf = counts.get(self.terms[t], 0)
                found[t] = int(self.weights[t]) * ((1_000_000_000 * tf) // (1000 * tf + 12 * length))
            return found[t]

        return [sum(part(t) * q for t, q in zip(self.at[i].tolist(), self.times[i].tolist(), strict=True)) for i in which]


def _bounded(index: Index, sent, every: bool) -> DataFrame:
    """item, block, row, bound: all documents whose bound reaches the item's least score (``every``), or the
    highest bounds that a task has for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, least, k = sent.value
        best: list[list] = [[] for _ in items.ids]

        def out(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["item", "block", "row", "bound"])

        for batch in batches:
            for b in batch.to_pylist():
                n = np.array(b["n"], np.int64)
                bounds = items.bounds(b["m"], n, b["levels"], b["slices"])
                if every:
                    at, row = np.nonzero((bounds >= least[:, None]) & (bounds > 0))
                    if len(at):
                        yield out(list(zip(at.tolist(), [b["block"]] * len(at), row.tolist(), bounds[at, row].tolist(), strict=True)))
                    continue
                for i, line in enumerate(bounds):
                    limit = best[i][0][0] if len(best[i]) == k else 0
                    rows = np.flatnonzero(line > limit)
                    if len(rows) > k:
                        rows = rows[np.argpartition(-line[rows], k - 1)[:k]]
                    for r in rows.tolist():
                        entry = (int(line[r]), b["block"], r)
                        if len(best[i]) < k:
                            heapq.heappush(best[i], entry)
                        elif entry > best[i][0]:
                            heapq.heapreplace(best[i], entry)
        if not every:
            yield out([(i, b, r, s) for i, some in enumerate(best) for s, b, r in some])

    return index.signatures.mapInArrow(run, "item int, block long, row int, bound long")


def _rescored(index: Index, pairs: DataFrame, sent, k: int) -> DataFrame:
    """item, doc_id, score of the pairs (item, block, row), each task's k best of each item."""
    asked = pairs.groupBy("block", "row").agg(F.collect_list("item").alias("items"))  # at most the items of one block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value[0]
        best: dict[int, list] = defaultdict(list)
        for batch in batches:
            for doc_id, text, which in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), batch.column("items").to_pylist(), strict=True):
                counts: Counter = Counter()
                for some in terms(text):
                    counts.update(some)
                order = (doc_id is not None, -(doc_id or 0))
                for i, s in zip(which, items.scores(which, counts, counts.total()), strict=True):
                    if s <= 0:
                        continue
                    if len(best[i]) < k:
                        heapq.heappush(best[i], (s, *order))
                    else:
                        heapq.heappushpop(best[i], (s, *order))
        found = [(i, -d if known else None, s) for i, some in best.items() for s, known, d in some]
        columns = list(zip(*found, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["item", "doc_id", "score"])

    texts = index.store.join(asked, ["block", "row"]).select("doc_id", "text", "items")
    return texts.mapInArrow(run, "item int, doc_id long, score long")


def _top(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(index: Index, items: DataFrame, k: int = 20, item_terms: int = 50_000) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each of ``items`` (item_id, text)."""
    spark = items.sparkSession
    schema = "item_id long, rank int, doc_id long, score long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[t for some in terms(x) for t in some] for x in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({"item_id": batch.column("item_id"), "terms": pa.array(found, pa.list_(pa.binary())), "n": pa.array([len(f) for f in found], pa.int64())})

    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(read, "item_id long, terms array<binary>, n long")
    asked = stored(asked.filter("n > 0"), "lexical-items")
    total = asked.agg(F.sum("n")).first()[0] or 0
    if not total or not index.n_docs:
        return spark.createDataFrame([], schema)
    n_blocks = n_groups(total, item_terms)
    out = []
    for b in range(n_blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(n_blocks)) == b)
        rows = [(r.item_id, [bytes(t) for t in r.terms]) for r in mine.select("item_id", "terms").collect()]
        wanted = mine.select(F.explode("terms").alias("term")).distinct()
        # The terms of one block of items: about item_terms at most.
        df = {bytes(r.term): r.df for r in index.vocabulary.join(F.broadcast(wanted), "term").collect()}
        block = Items(rows, df, index.n_docs, index.n_terms)
        if not block.ids:
            continue
        sent = spark.sparkContext.broadcast((block, None, 2 * k))
        order = Window.partitionBy("item").orderBy(F.col("bound").desc(), "block", "row")
        first = _bounded(index, sent, every=False).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= 2 * k)
        scored = _top(_rescored(index, stored(first.select("item", "block", "row"), "lexical-first"), sent, k), k)
        reached = {r.item: r.score for r in scored.filter(F.col("rank") == k).select("item", "score").collect()}  # one row for each item of the block
        least = np.array([reached.get(i, 1) for i in range(len(block.ids))], np.int64)
        sent = spark.sparkContext.broadcast((block, least, k))
        pairs = stored(_bounded(index, sent, every=True).select("item", "block", "row"), "lexical-candidates")
        final = _top(_rescored(index, pairs, sent, k), k)
        names = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id long")
        out.append(stored(final.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "lexical-found"))
    if not out:
        return spark.createDataFrame([], schema)
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents for each benchmark item."""
    return search(build_index(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "benchmark"))


#: The contract in DuckDB.
SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (
  SELECT row_number() OVER () AS qrow, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
totals AS (SELECT count(*) AS nn, sum(len(w)) AS ll FROM d WHERE len(w) > 0),
occurring AS MATERIALIZED (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) GROUP BY row, term),
weights AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM occurring, totals GROUP BY term, nn),
asked AS (SELECT qrow, term, count(*) AS times FROM (SELECT qrow, unnest(w) AS term FROM q) GROUP BY qrow, term),
scores AS (
  SELECT qrow, row, sum(times * weights.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.w) * nn) // ll))))::BIGINT AS score
  FROM asked JOIN occurring USING (term) JOIN weights USING (term) JOIN d USING (row), totals GROUP BY qrow, row),
ranked AS (
  SELECT qrow, doc_id, score, row_number() OVER (PARTITION BY qrow ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores JOIN d USING (row) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked JOIN q USING (qrow) WHERE rank <= 20
"""
