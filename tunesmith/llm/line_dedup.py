"""Operator 2, reversible line dedup: sharded cuckoo filters over exact reference-count tables.

A line's key is the line without white space at its ends, A-Z lower-cased. Of a key with at
least ``least`` code points that at least two documents hold, only the document with the
smallest doc_id keeps its lines. The index that decides this consists of tables:

* ``postings``: (shard, key, doc), one row for each key of each document, key = 128-bit digest;
* ``refs``: (shard, key, n_docs, first_doc), the exact reference counts;
* ``filters``: (shard, filter), a cuckoo filter of the keys that two or more documents
  hold. As a cuckoo filter can forget a fingerprint, it follows deletions as well.

``insert`` and ``delete`` give the index after documents come or go, equal to one built afresh;
only counts of keys in the changed documents and filters in which a key crossed between one
and two documents change. To deduplicate, each document's keys are first looked up in the
filter of their shard, in the task that reads them; only those that may be shared are
joined with ``refs``, which decides exactly. Filters reach the tasks in rounds of at most
``round_bytes``. The postings of more than ``PART_SHARDS`` shards are written in folders of as many shards each, and a
round reads the folder of its shards alone.

No key is handled by one task: counting is a partial aggregate, and the joins on key are plain
joins whose large partitions AQE splits. Shards hold distinct keys.

Null or empty text is one empty line. Rows of one doc_id are one document; null doc_ids are one
document that comes after all others. Such rows get the lost keys of their own text only, not a list for all of them. Lines are separated by \\n alone. An empty table
gives no rows. Texts of documents that lose nothing are returned as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.llm.common import WHITE, n_groups, read_table, stored, text_of, tidied
from tunesmith.session import shared_scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER = str.maketrans(UPPER, LOWER)
LAST = (1 << 63) - 1  # stands for a null doc_id
SLOTS = 4
PART_SHARDS = 32
#: Bytes of a batch of texts that lose lines: beside the shuffled texts on the heap, a worker should hold little.
TEXT_BYTES = 4 << 20


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key may be in one of two buckets."""

    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, SLOTS), dtype=np.uint16)

    @staticmethod
    def for_keys(n: int) -> CuckooFilter:
        return CuckooFilter(1 << max(4, int(np.ceil(np.log2(max(1, n) / (SLOTS * 0.8))))))

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprint, bucket, other bucket) of 16-byte keys, given as an array of (n, 2) uint64."""
        mask = np.uint64(len(self.table) - 1)
        print_ = (keys[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        print_[print_ == 0] = 1
        first = keys[:, 0] & mask
        return print_, first, first ^ self._jump(print_)

    def _jump(self, print_):
        return (np.uint64(print_) * np.uint64(0x5BD1E995) >> np.uint64(3)) & np.uint64(len(self.table) - 1)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        f, a, b = self.places(keys)
        return (self.table[a] == f[:, None]).any(axis=1) | (self.table[b] == f[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray, kicks: int = 500) -> bool:
        """False if the filter is too full; it must then be built anew, larger."""
        f, a, b = self.places(keys)
        for print_, first, other in zip(f.tolist(), a.tolist(), b.tolist(), strict=True):
            at = first if not self.table[first].all() else other
            for kick in range(kicks):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = print_
                    break
                slot = (at + kick) % SLOTS
                print_, self.table[at, slot] = int(self.table[at, slot]), print_
                at = int(at ^ int(self._jump(np.uint16(print_))))
            else:
                return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        for print_, first, other in zip(*(x.tolist() for x in self.places(keys)), strict=True):
            for at in (first, other):
                held = np.flatnonzero(self.table[at] == print_)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    @staticmethod
    def from_bytes(content: bytes) -> CuckooFilter:
        f = CuckooFilter(len(content) // (2 * SLOTS))
        f.table = np.frombuffer(content, "<u2").reshape(-1, SLOTS).copy()
        return f


def _digests(keys) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)


@dataclass
class LineIndex:
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def doc_number() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def postings_of(docs: DataFrame, shards: int, least: int = 10) -> DataFrame:
    """shard, key, doc: each key once for each document."""
    keys = F.transform(F.split(text_of(), "\n", -1), line_key)
    digests = F.array_distinct(F.transform(F.filter(keys, lambda k: F.length(k) >= least), lambda k: F.unhex(F.md5(k))))
    rows = docs.select(doc_number().alias("doc"), F.explode(digests).alias("key"))
    return rows.select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), "key", "doc")


def counted(postings: DataFrame) -> DataFrame:
    return postings.groupBy("shard", "key").agg(F.count("*").alias("n_docs"), F.min("doc").alias("first_doc"))


def filters_of(refs: DataFrame, shards: int) -> DataFrame:
    """A filter for each shard that has a key of two or more documents."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = _digests(rows["key"])
        f = CuckooFilter.for_keys(len(keys))
        while not f.insert(keys):
            f = CuckooFilter(2 * len(f.table))
        return pd.DataFrame({"shard": [int(key[0])], "filter": [f.to_bytes()]})

    return refs.filter("n_docs > 1").select("shard", "key").groupBy("shard").applyInPandas(build, "shard int, filter binary")


def laid_out(postings: DataFrame, shards: int) -> DataFrame:
    """``postings`` as a written table: in one folder for each ``PART_SHARDS`` shards, if there are more."""
    rows = postings.select("shard", "key", "doc")
    if shards <= PART_SHARDS:
        return stored(rows.withColumn("part", F.lit(0)), "line-postings")
    # Rebalanced: files of about the advised size for each folder, large folders split over tasks.
    path = shared_scratch(rows.sparkSession, "line-postings")
    placed = rows.withColumn("part", F.floor(F.col("shard") / PART_SHARDS).cast("int"))
    placed.hint("rebalance", "part").write.partitionBy("part").parquet(path)
    return rows.sparkSession.read.schema(placed.schema).parquet(path)


def build(docs: DataFrame, least: int = 10, keys_per_shard: int = 200_000, least_shards: int = 32) -> LineIndex:
    """The index of ``docs``: as many shards as hold about ``keys_per_shard`` lines each."""
    rows = stored(postings_of(docs, 1, least).distinct().drop("shard"), "line-keys")
    shards = max(least_shards, n_groups(rows.count(), keys_per_shard))
    sharded = rows.select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), "key", "doc")
    postings = laid_out(sharded, shards) if shards > PART_SHARDS else sharded.withColumn("part", F.lit(0))
    refs = stored(counted(postings), "line-refs")
    return LineIndex(postings, refs, stored(filters_of(refs, shards), "line-filters"), shards)


def _updated(index: LineIndex, refs: DataFrame, crossed: DataFrame, postings: DataFrame) -> LineIndex:
    """The index with new ``refs`` and ``postings``; ``crossed``: (shard, key, up) of keys whose number of
    documents passed between one and two."""

    def update(key: tuple, old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        f = CuckooFilter.from_bytes(old["filter"].iloc[0]) if len(old) else CuckooFilter.for_keys(len(keys))
        full = False
        if len(keys):
            up = keys["up"].to_numpy(bool)
            every = _digests(keys["key"])
            f.delete(every[~up])
            full = not f.insert(every[up])
        return pd.DataFrame({"shard": [int(key[0])], "filter": [None if full else f.to_bytes()]})

    changed = stored(index.filters.groupBy("shard").cogroup(crossed.select(F.col("shard").alias("s"), "key", "up").groupBy("s")).applyInPandas(update, "shard int, filter binary"), "line-filters")
    full = changed.filter("filter IS NULL").select("shard")
    again = filters_of(refs.join(full, "shard", "left_semi"), index.shards)
    return LineIndex(postings, refs, stored(changed.filter("filter IS NOT NULL").unionByName(again), "line-filters"), index.shards)


def insert(index: LineIndex, docs: DataFrame, least: int = 10) -> LineIndex:
    """The index after ``docs``, whose doc_ids must be new to it, have come."""
    new = stored(postings_of(docs, index.shards, least).distinct(), "line-keys")
    came = counted(new).select("shard", "key", F.col("n_docs").alias("came"), F.col("first_doc").alias("first"))
    both = index.refs.join(came, ["shard", "key"], "full_outer")
    merged = both.select("shard", "key", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("came", F.lit(0))).alias("n_docs"), F.least("first_doc", "first").alias("first_doc"), F.coalesce("n_docs", F.lit(0)).alias("old"))
    merged = stored(merged, "line-refs")
    crossed = merged.filter("old < 2 AND n_docs > 1").select("shard", "key", F.lit(True).alias("up"))
    return _updated(index, merged.drop("old"), crossed, laid_out(index.postings.select("shard", "key", "doc").unionByName(new.select("shard", "key", "doc")), index.shards))


def delete(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index after the documents whose doc_id is in ``docs`` have gone."""
    ids = docs.select(doc_number().alias("doc")).distinct()
    going = index.postings.join(ids, "doc", "left_semi").select("shard", "key", "doc")
    left = laid_out(index.postings.join(ids, "doc", "left_anti").select("shard", "key", "doc"), index.shards)
    went = stored(counted(going).select("shard", "key", F.col("n_docs").alias("went"), F.col("first_doc").alias("gone")), "line-went")
    # A key whose first document goes gets the next one from the postings that are left.
    heirs = counted(left.join(went.select("shard", "key"), ["shard", "key"], "left_semi")).select("shard", "key", F.col("first_doc").alias("heir"))
    both = index.refs.join(went, ["shard", "key"], "left").join(heirs, ["shard", "key"], "left")
    n = F.col("n_docs") - F.coalesce("went", F.lit(0))
    refs = stored(both.select("shard", "key", n.alias("n_docs"), F.coalesce("heir", "first_doc").alias("first_doc"), F.col("n_docs").alias("old")).filter("n_docs > 0 OR old > 1"), "line-refs")
    crossed = refs.filter("old > 1 AND n_docs < 2").select("shard", "key", F.lit(False).alias("up"))
    return _updated(index, refs.filter("n_docs > 0").drop("old"), crossed, left)


def lost_postings(index: LineIndex, postings: DataFrame, round_bytes: int = 32 << 20) -> DataFrame:
    """doc, key: the keys whose lines a document loses. ``postings``: those of the index, or some of them."""
    spark = postings.sparkSession
    sizes = index.filters.select("shard", F.octet_length("filter").alias("bytes")).orderBy("shard").collect()  # a row for each shard
    rounds: list[tuple[int, list[int]]] = []
    held = 0
    for r in sizes:
        part = r.shard // PART_SHARDS if index.shards > PART_SHARDS else 0
        if not rounds or rounds[-1][0] != part or held + r.bytes > round_bytes:
            rounds.append((part, []))
            held = 0
        rounds[-1][1].append(r.shard)
        held += r.bytes
    hits = spark.createDataFrame([], "shard int, key binary, doc long")
    for part, shards in rounds:
        found = index.filters.filter(F.col("shard").isin(shards)).toArrow()
        sent = spark.sparkContext.broadcast(dict(zip(found.column("shard").to_pylist(), found.column("filter").to_pylist(), strict=True)))  # at most round_bytes, or one filter

        def screen(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            filters = {s: CuckooFilter.from_bytes(c) for s, c in sent.value.items()}
            for batch in batches:
                shard = batch.column("shard").to_numpy(zero_copy_only=False)
                keys = _digests(batch.column("key").to_pylist())
                may = np.zeros(len(shard), dtype=bool)
                for s in np.unique(shard):
                    if s in filters:
                        of = np.flatnonzero(shard == s)
                        may[of] = filters[s].may_hold(keys[of])
                yield batch.filter(pa.array(may))

        mine = postings.filter((F.col("part") == part) & F.col("shard").isin(shards)).select("shard", "key", "doc")
        hits = hits.unionByName(mine.mapInArrow(tidied(screen), hits.schema))
    shared = index.refs.filter("n_docs > 1").select(F.col("key").alias("of"), "first_doc")
    return hits.join(shared, F.col("key") == F.col("of")).filter("doc != first_doc").select("doc", "key")


def without_lost_lines(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """``docs`` with text lacking the lines of its ``lost`` keys (doc, key), and _n_lines and _n_dropped."""
    rows = docs.withColumn("_doc", doc_number())
    # Several rows under one number get lists by their texts: few numbers, but possibly of very many rows.
    several = stored(rows.groupBy("_doc").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select(F.col("_doc").alias("_several")), "line-several")
    lost = stored(lost, "line-lost")
    marked = rows.join(several, F.col("_doc") == F.col("_several"), "left").withColumn("_at", F.when(F.col("_several").isNotNull(), F.xxhash64(text_of())).otherwise(F.lit(0))).drop("_several")
    single = lost.join(several, F.col("doc") == F.col("_several"), "left_anti").groupBy("doc").agg(F.collect_list("key").alias("_keys")).select("doc", F.lit(0).cast("long").alias("at"), "_keys")
    lines = F.array_distinct(F.transform(F.split(text_of(), "\n", -1), lambda k: F.unhex(F.md5(line_key(k)))))
    own = rows.join(several, F.col("_doc") == F.col("_several"), "left_semi").select("_doc", F.xxhash64(text_of()).alias("at"), lines.alias("_l")).distinct()
    own = own.select("_doc", "at", F.explode("_l").alias("_key")).join(lost, (F.col("_doc") == F.col("doc")) & (F.col("_key") == F.col("key")))
    lists = single.unionByName(own.groupBy("doc", "at").agg(F.collect_list("key").alias("_keys"))).withColumnsRenamed({"doc": "_of", "at": "_of_at"})
    joined = marked.join(lists, (F.col("_doc") == F.col("_of")) & (F.col("_at") == F.col("_of_at")), "left").drop("_doc", "_at", "_of", "_of_at")
    joined = joined.withColumn("_n_lines", F.size(F.split(text_of(), "\n", -1)).cast("long"))
    schema = joined.drop("_keys").withColumn("_n_dropped", F.lit(0).cast("long")).schema
    at = docs.columns.index("text")
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BYTES))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("_keys")
            gone = np.zeros(len(batch), dtype=np.int64)
            changed: dict[int, str] = {}  # only texts that lose a line become Python strings, one at a time
            for i in np.flatnonzero(pc.fill_null(pc.list_value_length(keys), 0).to_numpy(zero_copy_only=False)):
                drop, lines = set(keys[i].as_py()), (texts[i].as_py() or "").split("\n")
                kept = [x for x in lines if hashlib.md5(x.strip(WHITE).translate(_LOWER).encode()).digest() not in drop]
                if len(kept) < len(lines):
                    gone[i], changed[i] = len(lines) - len(kept), "\n".join(kept)
            columns = [batch.column(c) for c in schema.names[:-1]]
            if changed:
                mask = np.zeros(len(batch), dtype=bool)
                mask[list(changed)] = True
                columns[at] = pc.replace_with_mask(texts, pa.array(mask), pa.array(changed.values(), texts.type))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone)], names=schema.names)

    return joined.mapInArrow(tidied(drop), schema)


def line_dedup(docs: DataFrame, least: int = 10) -> DataFrame:
    """All ``docs`` with their kept lines as text, and _n_lines and _n_dropped."""
    index = build(docs, least)
    return without_lost_lines(docs, lost_postings(index, index.postings))


def deduplicated_documents(docs: DataFrame) -> DataFrame:
    """The documents with their kept lines; their own columns."""
    out = line_dedup(docs)
    n = F.when(F.col("_n_dropped") > 0, F.length("text").cast(dict(docs.dtypes).get("n_chars", "long")))
    return (out.withColumn("n_chars", F.coalesce(n, "n_chars")) if "n_chars" in docs.columns else out).select(*docs.columns)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    out = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(text_of(), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), shared AS (
  SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT keyed.*, coalesce(first_doc <> doc_id, false) AS gone FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
