"""Operator 3, n-gram Jaccard join with Bayesian candidate pruning.

Two documents are linked when the Jaccard similarity of their sets of five-word shingles
is at least 0.8 (verified on the whole sets, in integers). Shingles are 64-bit hashes.

1. Every document gets a MinHash signature of 128 values. Documents with equal sets are one
   class from here on, with a weight; copies never meet each other.
2. Candidates: classes that agree in a whole band of 4 values (32 bands; two sets of
   similarity 0.8 miss all bands with probability 5e-8, more similar ones with less).
3. Classes with any candidate are laid out in blocks of related classes (a common smallest
   neighbour), at most ``block_rows`` classes and ``block_bytes`` of shingles each. Two blocks are compared
   if some band holds classes of both; a pair of classes is in exactly one pair of blocks, and a
   row travels once for each of these pairs, not for each band or candidate.
4. In a pair of blocks, MinHash values are compared 16 at a time. With n compared and m equal,
   and a uniform prior, the similarity s has P(s >= t | m, n) = P(Bin(n + 1, t) <= m). A
   pair whose posterior falls below ``tolerance`` (1e-9) is dropped; what is left after 128
   values is verified exactly. Only each class's number of links and a star that connects
   each linked set of the two blocks leave the task, never the pairs.
5. Linked classes become groups by connected components (alternating stars, as many
   rounds as it takes, each written to the shared folder).

Result for each document: class_id (the smallest doc_id of its group), n_links (documents linked to it,
copies counted) and copies (documents with an equal set, itself included).

Texts of one to four words have one shingle of all words; texts without words (null ones,
too) have no links and are their own class. Rows that repeat a doc_id are told apart by a hash of
their text, and so are null doc_ids: such rows share a group only if their texts are linked, and
groups may then have the same class_id. A null doc_id is numbered last and given back as null
(a group of only null ids has class_id null). An empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.llm.common import compressed, decompress, read_table, stored, text_of, tidied, utf8
from tunesmith.llm.shingles import mixed, shingles, slices
from tunesmith.plans.components import components

LAST = (1 << 63) - 1
WORD = r"[^\x20\x09-\x0D]"
VALUES, STEP = 128, 16
_SEEDS = np.random.default_rng(99).integers(1, 1 << 63, (2, VALUES), dtype=np.uint64) | np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(n, VALUES) uint32; the sets must not be empty."""
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    flat = np.concatenate(sets)
    out = np.empty((len(sets), VALUES), dtype=np.uint32)
    for i in range(VALUES):
        out[:, i] = np.minimum.reduceat((flat * _SEEDS[0, i] + _SEEDS[1, i]) >> np.uint64(32), first)
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band; the band's number is part of it."""
    bands = sig.shape[1] // rows
    x = sig[:, : bands * rows].reshape(len(sig), bands, rows).astype(np.uint64)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), 1))
    for r in range(rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + x[:, :, r])
    return key.view(np.int64)


def least_matches(threshold: float, tolerance: float, n: int) -> int:
    """The fewest equal values of ``n`` with which a pair stays a candidate."""
    below = 0.0
    for m in range(n + 1):
        below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if below >= tolerance:
            return m
    return n


def common(sets_a: list[np.ndarray], sets_b: list[np.ndarray], ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """The number of common shingles of each pair (ia, ib)."""
    if len(ia) < 500:
        return np.array([len(np.intersect1d(sets_a[i], sets_b[j], assume_unique=True)) for i, j in zip(ia, ib, strict=True)], dtype=np.int64)
    # Many pairs: products of 0/1 matrices, over some thousand shingles at a time.
    ua, ub = np.unique(ia), np.unique(ib)
    flat_a, flat_b = np.concatenate([sets_a[i] for i in ua]), np.concatenate([sets_b[j] for j in ub])
    row_a, row_b = np.repeat(np.arange(len(ua)), [len(sets_a[i]) for i in ua]), np.repeat(np.arange(len(ub)), [len(sets_b[j]) for j in ub])
    known = np.intersect1d(flat_a, flat_b)
    at_a, at_b = np.searchsorted(known, flat_a), np.searchsorted(known, flat_b)
    in_a = known[np.minimum(at_a, len(known) - 1)] == flat_a if len(known) else np.zeros(len(flat_a), bool)
    in_b = known[np.minimum(at_b, len(known) - 1)] == flat_b if len(known) else np.zeros(len(flat_b), bool)
    total = np.zeros((len(ua), len(ub)), dtype=np.float64)
    order_a, order_b = np.argsort(at_a[in_a], kind="stable"), np.argsort(at_b[in_b], kind="stable")
    col_a, row_a, col_b, row_b = at_a[in_a][order_a], row_a[in_a][order_a], at_b[in_b][order_b], row_b[in_b][order_b]
    for c in range(0, len(known), 4096):
        x, y = np.zeros((len(ua), 4096), np.float32), np.zeros((len(ub), 4096), np.float32)
        a, b = np.searchsorted(col_a, [c, c + 4096])
        x[row_a[a:b], col_a[a:b] - c] = 1
        a, b = np.searchsorted(col_b, [c, c + 4096])
        y[row_b[a:b], col_b[a:b] - c] = 1
        total += x @ y.T
    return total[np.searchsorted(ua, ia), np.searchsorted(ub, ib)].astype(np.int64)


def linked_pairs(sig_a, sets_a, sig_b, sets_b, same: bool, share: tuple[int, int], need: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(ia, ib) of the pairs with similarity of at least ``share``; for ``same``, each pair once."""
    size_a, size_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    num, den = share
    may = (np.minimum.outer(size_a, size_b) * den >= np.maximum.outer(size_a, size_b) * num)
    if same:
        may = np.triu(may, 1)
    ia, ib = np.nonzero(may)
    m = np.zeros(len(ia), dtype=np.int32)
    for c in range(0, VALUES, STEP):
        for a in range(0, len(ia), 100_000):
            some = slice(a, a + 100_000)
            m[some] += (sig_a[ia[some], c : c + STEP] == sig_b[ib[some], c : c + STEP]).sum(axis=1)
        keep = m >= need[c // STEP]
        ia, ib, m = ia[keep], ib[keep], m[keep]
    both = common(sets_a, sets_b, ia, ib) if len(ia) else np.zeros(0, np.int64)
    keep = both * den >= (size_a[ia] + size_b[ib] - both) * num
    return ia[keep], ib[keep]


def _stars(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """(member, smallest id) of each connected set of the links."""
    root = np.arange(len(ids))
    while True:  # smallest number by links, then by pointer
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            break
    smallest = np.full(len(ids), LAST, dtype=np.int64)
    np.minimum.at(smallest, root, ids)
    return [(int(i), int(s)) for i, s in zip(ids, smallest[root], strict=True) if i != s]


def _classes(docs: DataFrame, k: int = 5, share: tuple[int, int] = (4, 5), tolerance: float = 1e-9, band_rows: int = 4, block_rows: int = 256, block_bytes: int = 4 << 20) -> tuple[DataFrame, DataFrame]:
    """doc, cls of every row of ``docs`` (doc_id, text), and for each class c: n_links, copies, and the
    first document of its group (class: its number, fp: the hash of its text)."""
    need = [least_matches(share[0] / share[1], tolerance, n) for n in range(STEP, VALUES + 1, STEP)]
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), text_of().alias("text")).withColumn("fp", F.xxhash64("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in slices(offsets):
                sets = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k)
                full = [i for i, s in enumerate(sets) if len(s)]
                sig = signatures([sets[i] for i in full]) if full else np.empty((0, VALUES), np.uint32)
                cls, sigs = [None] * len(sets), [None] * len(sets)
                for i, s in zip(full, sig, strict=True):
                    cls[i], sigs[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), s.tobytes()
                yield pa.RecordBatch.from_pydict({"doc": batch.column("doc").slice(a, b - a), "fp": batch.column("fp").slice(a, b - a), "cls": pa.array(cls, pa.binary()), "n": pa.array([len(s) for s in sets], pa.int64()), "sig": pa.array(sigs, pa.binary())})

    sketches = stored(rows.mapInArrow(tidied(sketch), "doc long, fp long, cls binary, n long, sig binary"), "jaccard-sketches")
    grouped = sketches.filter("n > 0").groupBy("cls", "n", "sig").agg(F.min(F.struct("doc", "fp")).alias("first"), F.count("*").alias("weight"))
    grouped = grouped.select("cls", "n", "sig", F.col("first.doc").alias("rep"), F.col("first.fp").alias("fp"), "weight")
    # A short number for each class; fixed, as the table is written.
    classes = stored(grouped.withColumn("id", F.monotonically_increasing_id()), "jaccard-classes")
    known = classes.select("id", "cls", "n", "rep", "fp", "weight")

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, VALUES)
            keys = band_keys(sig, band_rows)
            at = pa.array(np.repeat(np.arange(len(sig)), keys.shape[1]))
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys.reshape(-1)), "id": batch.column("id").take(at)})

    keyed = classes.select("id", "sig").mapInArrow(tidied(bands), "key long, id long")
    # Written, so that the join below has exchanges of its own, which AQE can split where a band is crowded.
    heads = stored(keyed.groupBy("key").agg(F.count("*").alias("held"), F.min("id").alias("head")).filter("held > 1").select(F.col("key").alias("of"), "head"), "jaccard-heads")
    near = stored(keyed.join(heads, F.col("key") == F.col("of")).select("key", "id", "head"), "jaccard-near")

    # Blocks of related classes: label = the smallest head that a class, or one it shares a band with, has seen.
    own = near.groupBy("id").agg(F.min("head").alias("own"))
    spread = near.join(own, "id").groupBy("key").agg(F.min("own").alias("least"))
    label = near.select("key", "id").join(spread, "key").groupBy("id").agg(F.min("least").alias("label"))
    held = stored(label.join(known, "id"), "jaccard-held")
    room = held.groupBy("label").agg(F.greatest(F.ceil(F.count("*") / block_rows), F.ceil(F.sum("n") * 8 / block_bytes)).alias("parts"))
    placed = held.join(room, "label").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    block = F.xxhash64("label", "part")  # two blocks under one number would only be one larger block
    blocks = stored(placed.select("id", "cls", block.alias("block"), "rep", "fp", "weight"), "jaccard-blocks")
    met = near.select("key", "id").join(blocks.select("id", "block"), "id").select("key", "block").distinct()
    other = met.select(F.col("key").alias("k"), F.col("block").alias("other"))
    pairs = met.join(other, (F.col("key") == F.col("k")) & (F.col("block") <= F.col("other"))).select(F.col("block").alias("a"), F.col("other").alias("b")).distinct()
    sides = pairs.select("a", "b", F.col("a").alias("block"), F.lit(0).alias("side")).union(pairs.filter("a != b").select("a", "b", F.col("b").alias("block"), F.lit(1).alias("side")))
    # Who meets whom is settled before any set of shingles moves.
    members = stored(sides.join(blocks.drop("rep", "fp"), "block").drop("block"), "jaccard-members")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("z").to_pylist():
                data = np.frombuffer(decompress(content), np.uint8)
                found = shingles(data, np.array([0, len(data)]), k)[0]
                yield pa.RecordBatch.from_pydict({"c": pa.array([hashlib.blake2b(found.tobytes(), digest_size=16).digest()], pa.binary()), "shingles": pa.array([found.tobytes()], pa.binary())})

    # The texts are shuffled, compressed, at every size of the other side: one plan for all inputs.
    wanted = blocks.select(F.col("rep").alias("doc"), "fp").distinct().hint("merge")
    texts = compressed(rows, "doc", "fp").join(wanted, ["doc", "fp"]).select("z").mapInArrow(tidied(sets_of), "c binary, shingles binary")
    whole = members.join(texts, F.col("cls") == F.col("c")).select("a", "b", "side", "id", "weight", "shingles")

    def verify(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # A class comes twice where rows of one doc_id repeat a text.
        rows = rows.drop_duplicates(["side", "id"]).sort_values(["side", "id"], ignore_index=True)
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        sig = signatures(sets)
        cut = int((rows["side"] == 0).sum())
        same = key[0] == key[1]
        if same:
            ia, ib = linked_pairs(sig, sets, sig, sets, True, share, need)
        else:
            ia, ib = linked_pairs(sig[:cut], sets[:cut], sig[cut:], sets[cut:], False, share, need)
            ib = ib + cut
        ids, weight = rows["id"].to_numpy(np.int64), rows["weight"].to_numpy(np.int64)
        links = np.zeros(len(ids), dtype=np.int64)
        np.add.at(links, ia, weight[ib])
        np.add.at(links, ib, weight[ia])
        some = np.flatnonzero(links)
        stars = _stars(ids, ia, ib)
        return pd.DataFrame({"id": [*ids[some].tolist(), *[s[0] for s in stars]], "links": [*links[some].tolist(), *[0] * len(stars)], "root": [*ids[some].tolist(), *[s[1] for s in stars]]}, dtype="int64")

    found = stored(whole.groupBy("a", "b").applyInPandas(verify, "id long, links long, root long"), "jaccard-links")
    links = found.filter("links > 0").groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.filter("id != root").select(F.col("id").alias("u"), F.col("root").alias("v")))
    # Only linked classes are in a group of several; written, so that the join below can be split where a group is large.
    linked = known.join(links, "id", "left").join(roots, F.col("id") == F.col("node"), "left").withColumn("group", F.coalesce("root", "id"))
    linked = stored(linked.select("group", "cls", "rep", "fp", "weight", "links"), "jaccard-linked")
    firsts = stored(linked.filter("links > 0").groupBy("group").agg(F.min(F.struct("rep", "fp")).alias("first")).withColumnRenamed("group", "of"), "jaccard-firsts")
    first = F.coalesce("first", F.struct("rep", "fp"))
    table = linked.join(firsts, F.col("group") == F.col("of"), "left")
    table = table.select(F.col("cls").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.col("weight").alias("copies"), first["rep"].alias("class"), first["fp"].alias("fp"))
    return sketches.select("doc", "cls"), table


def jaccard_groups(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_links, copies for every row of ``docs`` (doc_id, text)."""
    rows, table = _classes(docs, **options)
    out = rows.join(table, F.col("cls") == F.col("c"), "left")
    back = lambda c: F.when(c != LAST, c)
    return out.select(back(F.col("doc")).alias("doc_id"), back(F.coalesce("class", "doc")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("copies", F.lit(1)).cast("long").alias("copies"))


def representative_documents(docs: DataFrame, **options) -> DataFrame:
    """One row of each group, the one with the smallest doc_id (then hash of the text, then of the row),
    with its own columns. Rows without words are groups of their own and all stay."""
    _, table = _classes(docs, **options)
    keep = table.select(F.col("class").alias("_class"), F.col("fp").alias("_of")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_doc"), F.xxhash64(text_of()).alias("_fp"), text_of().rlike(WORD).alias("_words"), F.xxhash64(*docs.columns).alias("_hash"))
    # Copies under one id meet by partial aggregation, before the join.
    one = rows.filter("_words").groupBy("_doc", "_fp").agg(F.min_by("_row", "_hash").alias("_row"))
    kept = one.join(keep, (F.col("_doc") == F.col("_class")) & (F.col("_fp") == F.col("_of")), "left_semi").select("_row.*")
    return kept.unionByName(rows.filter("NOT _words").select("_row.*"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over all documents: the group, links and copies of each."""
    return jaccard_groups(read_table(spark, sf_dir, "documents"))
