"""Operator 4, suffix-array dedup: removes each byte of a repeated passage but in its first place.

A byte goes when a string of ``length`` (100) bytes that covers it also starts earlier (in a document
with a smaller doc_id, or earlier in the same one). Sorting the suffixes of every byte
isn't needed: any string of 100 bytes contains a *minimizer*, the leftmost of its
24-byte grams with the smallest hash, and equal strings have it at the same place. So

1. one scan gives, for each sampled position (about one in 39), the stretch of windows that
   it stands for: a hash of the gram, and one of all bytes of these windows. Equal stretches
   within an Arrow batch are combined at once;
2. rows meet by gram. Of equal stretches all but the first go whole; the first ones of
   a gram that has several different stretches are *open*: they may agree in part;
3. an open stretch's suffix begins at its gram. Every map task sorts the suffixes of its open
   stretches and front-codes them (length of the prefix shared with the one before, and
   the rest); the runs are exchanged by gram, and a loser tree merges the runs of a partition. It keeps,
   for each loser, the length of the prefix it shares with what beat it, so known
   prefixes are never compared again, and gives the merged order with its LCP array;
4. windows that start d bytes before the gram are equal where LCP >= 100 - d and the d bytes to
   the left agree; all but the first go. The suffixes of grams with more than ``crowd`` rows aren't
   merged in one task: their windows are counted by 128-bit hashes with partial aggregation (the rows of a gram do pass
   one task in step 2, as numbers, without their texts);
5. stretches and windows become removed runs of each document.

Stretches are compared by 112 bits of hash, left contexts by 64 bits within a run of equal right
contexts. Texts travel compressed, once to give the open suffixes and once to lose bytes.

Null text is empty. Rows that repeat a doc_id have one place in the order: only a smaller start is
earlier among them, so fully equal rows all stay. Each loses bytes of its own text only: where
ids repeat, rows are told apart by ``fp``, a hash of the text (else 0). A null doc_id comes last.
Texts shorter than ``length`` lose nothing. An empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunesmith.llm.common import compressed, decompress, n_groups, read_table, stored, text_of, utf8
from tunesmith.llm.shingles import mixed, slices

LENGTH, GRAM = 100, 24
LAST = (1 << 63) - 1
SPAN = 1 << 19  # bytes that are hashed at a time
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(4100).integers(1, 1 << 63, 256, dtype=np.uint64)
_SECOND = np.random.default_rng(4200).integers(1, 1 << 63, 256, dtype=np.uint64)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, dtype=np.uint64))]) for b in (_BASE, _INVERSE))


def _room(n: int) -> int:
    """The size of the table of powers for n bytes: one for all usual parts, else the next power of two."""
    return max(2 * SPAN, 1 << n.bit_length())


def _sums(data: np.ndarray, table: np.ndarray = _BYTES) -> np.ndarray:
    power, _ = _powers(_room(len(data)))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[data] * power[: len(data)])])


def _hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the bytes [a, b)."""
    _, inverse = _powers(_room(len(sums) - 1))
    return mixed((sums[b] - sums[a]) * inverse[a])


def stretches(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Of the texts in ``data``: row, lo (first window), m (windows), off (from lo to the gram), gram, seg.
    At most 2^24 bytes."""
    n, w = len(data), length - gram + 1
    if n < length:
        return {k: np.empty(0, np.int64) for k in ("row", "lo", "m", "off", "gram", "seg")}
    sums = _sums(data)
    place = np.arange(n - gram + 1)
    grams = _hash(sums, place, place + gram)
    # The smallest (40 bits of the hash, position) of each w places, by doubling.
    least, size = (grams & np.uint64(0xFFFFFFFFFF000000)) | place.astype(np.uint64), 1
    while 2 * size <= w:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    if size < w:
        least = np.minimum(least[: len(least) - (w - size)], least[w - size :])
    at = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(len(at)), side="right") - 1
    inside = np.flatnonzero(np.arange(len(at)) + length <= offsets[row + 1])
    at, row = at[inside], row[inside]
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])])) if len(at) else np.empty(0, np.int64)
    m = np.diff(np.concatenate([first, [len(at)]]))
    lo, at, row = inside[first], at[first], row[first]
    seg = mixed(_hash(sums, lo, lo + m - 1 + length) + (m * 256 + (at - lo)).astype(np.uint64))
    return {"row": row, "lo": lo - offsets[row], "m": m, "off": at - lo, "gram": (grams[at] >> np.uint64(16)).astype(np.int64), "seg": seg.view(np.int64)}


def _chunks(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(first text, bytes, their offsets, bytes before them in the text): texts of about SPAN bytes
    together, and longer texts in parts that overlap by all but one byte of a window."""
    for a, b in slices(offsets, SPAN):
        if offsets[b] - offsets[a] <= 2 * SPAN:
            yield a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], 0
        else:
            for c in range(int(offsets[a]), int(offsets[b]) - length + 1, SPAN):
                part = data[c : min(c + SPAN + length - 1, int(offsets[b]))]
                yield a, part, np.array([0, len(part)]), c - int(offsets[a])


def anchored(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """gram, seg, doc, fp, lo, m, off; gram is negative for stretches that have an equal one before them in their batch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            doc, fp = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("doc", "fp"))
            found = []
            for a, part, at, before in _chunks(data, offsets, length):
                s = stretches(part, at, length)
                found.append({"doc": doc[a + s["row"]], "fp": fp[a + s["row"]], "lo": s["lo"] + before, "m": s["m"], "off": s["off"], "gram": s["gram"], "seg": s["seg"]})
            if not found:
                continue
            s = {k: np.concatenate([f[k] for f in found]) for k in found[0]}
            order = np.lexsort((s["lo"], s["doc"], s["seg"], s["gram"]))
            g, e = s["gram"][order], s["seg"][order]
            again = order[1:][(g[1:] == g[:-1]) & (e[1:] == e[:-1])]
            # Not rows of the same place: those of one doc_id may begin alike.
            head = order[np.concatenate([[True], (g[1:] != g[:-1]) | (e[1:] != e[:-1])])] if len(order) else order
            of = head[np.cumsum(np.concatenate([[True], (g[1:] != g[:-1]) | (e[1:] != e[:-1])])) - 1][1:][(g[1:] == g[:-1]) & (e[1:] == e[:-1])] if len(order) else order
            later = again[(s["doc"][again] != s["doc"][of]) | (s["lo"][again] != s["lo"][of])]
            s["gram"][later] = -1 - (mixed((s["doc"][later] * 1000003 + s["lo"][later]).view(np.uint64)) >> np.uint64(2)).view(np.int64)
            yield pa.RecordBatch.from_pydict({k: pa.array(s[k].astype(np.int32 if k in ("m", "off") else np.int64)) for k in ("gram", "seg", "doc", "fp", "lo", "m", "off")})

    return docs.mapInArrow(scan, "gram long, seg long, doc long, fp long, lo long, m int, off int")


def marked(rows: DataFrame, crowd: int) -> DataFrame:
    """For each document (doc, fp), its stretches that go (done: lo, m) and its open ones (open: lo, m, off, gram, many)."""
    by_gram = Window.partitionBy("gram")
    sorted_ = by_gram.orderBy("seg", "doc", "lo", "fp")
    of_seg = Window.partitionBy("gram", "seg").orderBy("doc", "lo")
    # The windows over a gram come first: their exchange and sort then serve those over its stretches, too.
    seen = rows.withColumn("before", F.lag(F.struct("seg", "doc", "lo", "fp")).over(sorted_))
    seen = seen.withColumn("least", F.min("seg").over(by_gram)).withColumn("most", F.max("seg").over(by_gram)).withColumn("n", F.count("*").over(by_gram))
    seen = seen.withColumn("head", F.first(F.struct("doc", "lo")).over(of_seg))
    later = (F.col("gram") < 0) | (F.col("head") != F.struct("doc", "lo"))
    # Equal rows of one place (of rows that repeat a doc_id and a text) are sent once.
    once = F.col("before").isNull() | (F.col("before") != F.struct("seg", "doc", "lo", "fp"))
    some = seen.filter(once & (later | (F.col("least") != F.col("most"))))
    done = F.when(later, F.struct("lo", "m"))
    open_ = F.when(~later, F.struct("lo", "m", "off", "gram", (F.col("n") > crowd).alias("many")))
    return some.select("doc", "fp", done.alias("d"), open_.alias("o")).groupBy("doc", "fp").agg(F.collect_list("d").alias("done"), F.collect_list("o").alias("open"))


def front_coded(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Of sorted strings: the length of the prefix shared with the one before, and the rest."""
    lcps, rests, before = [], [], b""
    for s in strings:
        k = shared(before, s, 0)
        lcps.append(k)
        rests.append(s[k:])
        before = s
    return lcps, rests


def shared(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix of two strings that agree in ``known`` bytes."""
    end = min(len(a), len(b))
    while known < end:
        x, y = a[known : known + 32], b[known : known + 32]
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            differ = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
            return known + n - (differ.bit_length() + 7) // 8
        known += n
    return end


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, int, bytes, int]]:
    """(run, place in it, string, length of the prefix shared with the string before) of front-coded
    sorted runs in merged order, by a loser tree that keeps shared prefix lengths.

    Each contender carries the length of the prefix that it shares with the last output. Of two,
    the one that shares more is smaller; only if both share as much are bytes
    compared, and from there on."""
    size = 1
    while size < len(runs):
        size *= 2
    head: list[bytes | None] = [b""] * size
    place = [-1] * size
    lcp = [0] * size

    def advance(r: int) -> None:
        place[r] += 1
        if r < len(runs) and place[r] < len(runs[r][0]):
            lcp[r] = runs[r][0][place[r]]
            head[r] = (head[r] or b"")[: lcp[r]] + runs[r][1][place[r]]
        else:
            head[r], lcp[r] = None, -1

    def loses(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's lcp becomes that with the winner."""
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        x, y = head[a], head[b]
        if x is None:
            return a, b
        k = shared(x, y, lcp[a])
        if (len(x) == k or len(y) != k and x[k] < y[k]) and not (len(y) == k and len(x) > k):
            lcp[b] = k
            return a, b
        lcp[a] = k
        return b, a

    for r in range(size):
        advance(r)
    losers = [0] * size
    winners = list(range(size))
    first = size
    while first > 1:
        first //= 2
        up = []
        for i in range(first):
            win, lose = loses(winners[2 * i], winners[2 * i + 1])
            losers[first + i] = lose
            up.append(win)
        winners = up
    win = winners[0]
    while head[win] is not None:
        yield win, place[win], head[win], lcp[win]
        advance(win)
        node = (win + size) // 2
        while node:
            best, lose = loses(win, losers[node])
            losers[node] = lose
            win = best
            node //= 2


def later_windows(lcp: np.ndarray, left: np.ndarray, off: np.ndarray, m: np.ndarray, order: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """(n, length) of booleans: whether the window that starts d bytes before a suffix goes. The suffixes are
    sorted, with their LCP array; ``left`` holds the bytes before them (nearest first), ``order`` their rank
    by document and position."""
    n = len(lcp)
    gone = np.zeros((n, length), dtype=bool)
    context = np.zeros(n, dtype=np.uint64)
    for d in range(int(off.max(initial=-1)) + 1):
        if d:
            context = context * np.uint64(_BASE) + _BYTES[left[:, d - 1]]
        valid = np.flatnonzero((off >= d) & (off - m + 1 <= d))
        if len(valid) < 2:
            continue
        run = np.cumsum(lcp < length - d)[valid]
        c, o = context[valid], order[valid]
        by = np.lexsort((o, c, run))
        same = (run[by][1:] == run[by][:-1]) & (c[by][1:] == c[by][:-1])
        head = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(by)), 0))
        later = np.concatenate([[False], same]) & (o[by] != o[by][head])
        gone[valid[by[later]], d] = True
    return gone


def _intervals(doc: np.ndarray, fp: np.ndarray, at: np.ndarray, gone: np.ndarray, length: int = LENGTH) -> pd.DataFrame:
    """doc, fp, a, b: the bytes covered by the windows that go; ``at`` is the place of each suffix."""
    edge = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return pd.DataFrame({"doc": doc[row], "fp": fp[row], "a": at[row] - (end - 1), "b": at[row] - first + length})


def open_contexts(docs: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    """gram, many, doc, fp, lo, m, off, bytes of the open stretches."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {k: [] for k in ("gram", "many", "doc", "fp", "lo", "m", "off", "bytes")}
            for doc, fp, content, rows in zip(*(batch.column(k).to_pylist() for k in ("doc", "fp", "z", "open")), strict=True):
                text = decompress(content)
                for r in rows:
                    end = r["lo"] + r["m"] - 1 + length
                    if end <= len(text):  # else two texts of this doc_id share a hash
                        for k in ("gram", "many", "lo", "m", "off"):
                            columns[k].append(r[k])
                        columns["doc"].append(doc)
                        columns["fp"].append(fp)
                        columns["bytes"].append(text[r["lo"] : end])
            schema = pa.schema([("gram", pa.int64()), ("many", pa.bool_()), ("doc", pa.int64()), ("fp", pa.int64()), ("lo", pa.int64()), ("m", pa.int32()), ("off", pa.int32()), ("bytes", pa.binary())])
            yield pa.RecordBatch.from_pydict(columns, schema=schema)

    some = marks.filter(F.size("open") > 0).select(F.col("doc").alias("of"), F.col("fp").alias("of_fp"), "open")
    joined = compressed(docs, "doc", "fp").join(some, (F.col("doc") == F.col("of")) & (F.col("fp") == F.col("of_fp"))).select("doc", "fp", "z", "open")
    return joined.mapInArrow(cut, "gram long, many boolean, doc long, fp long, lo long, m int, off int, bytes binary")


def merged_windows(contexts: DataFrame, rows_per_merge: int, length: int) -> DataFrame:
    """doc, fp, a, b of the windows that go, by front-coded runs and loser trees."""
    parts = n_groups(contexts.count(), rows_per_merge)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One sorted, front-coded run for each partition of the exchange, for some 50,000 suffixes of this task."""
        held: list[pd.DataFrame] = []

        def flush() -> pa.RecordBatch:
            rows = pd.concat(held, ignore_index=True)
            rows["suffix"] = [b[o:] for b, o in zip(rows["bytes"], rows["off"], strict=True)]
            rows["left"] = [b[:o][::-1] for b, o in zip(rows["bytes"], rows["off"], strict=True)]
            out: dict[str, list] = {k: [] for k in ("part", "lcps", "rests", "ends", "lefts", "docs", "fps", "ats", "ms", "offs")}
            for part, run in rows.groupby("part", sort=False):
                run = run.sort_values("suffix")
                lcps, rests = front_coded(run["suffix"].tolist())
                out["part"].append(int(part))
                out["lcps"].append(np.array(lcps, "<i4").tobytes())
                out["rests"].append(b"".join(rests))
                out["ends"].append(np.cumsum([len(r) for r in rests]).astype("<i4").tobytes())
                out["lefts"].append(b"".join(x.ljust(length, b"\0") for x in run["left"]))
                for k, v in (("docs", run["doc"]), ("fps", run["fp"]), ("ats", run["lo"] + run["off"]), ("ms", run["m"]), ("offs", run["off"])):
                    out[k].append(v.to_numpy().astype("<i8").tobytes())
            # The left contexts are mostly padding, so each run's are compressed.
            out["lefts"] = [zlib.compress(x, 1) for x in out["lefts"]]
            return pa.RecordBatch.from_pydict(out, schema=pa.schema([("part", pa.int32())] + [(k, pa.binary()) for k in ("lcps", "rests", "ends", "lefts", "docs", "fps", "ats", "ms", "offs")]))

        for batch in batches:
            held.append(batch.to_pandas())
            if sum(map(len, held)) >= 50_000:
                yield flush()
                held = []
        if sum(map(len, held)):
            yield flush()

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        coded = []
        for r in rows.itertuples():
            ends = np.frombuffer(r.ends, "<i4").tolist()
            coded.append((np.frombuffer(r.lcps, "<i4").tolist(), [r.rests[a:b] for a, b in zip([0, *ends], ends, strict=False)]))
        sizes = [len(c[0]) for c in coded]
        start = np.cumsum([0, *sizes])
        merged = [(start[run] + place, k) for run, place, _, k in merge_runs(coded)]
        at, lcp = (np.array(x, dtype=np.int64) for x in zip(*merged, strict=True))
        ints = {k: np.concatenate([np.frombuffer(x, "<i8") for x in rows[k]])[at] for k in ("docs", "fps", "ats", "ms", "offs")}
        left = np.concatenate([np.frombuffer(zlib.decompress(x), np.uint8).reshape(-1, length) for x in rows["lefts"]])[at]
        by = np.lexsort((ints["ats"], ints["docs"]))
        new = np.concatenate([[True], (np.diff(ints["docs"][by]) != 0) | (np.diff(ints["ats"][by]) != 0)])
        order = np.empty(len(by), dtype=np.int64)
        order[by] = np.cumsum(new)  # equal places have equal ranks
        gone = later_windows(lcp, left, ints["offs"], ints["ms"], order, length)
        return _intervals(ints["docs"], ints["fps"], ints["ats"], gone, length)

    dealt = contexts.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(parts)).cast("int"))
    schema = "part int, lcps binary, rests binary, ends binary, lefts binary, docs binary, fps binary, ats binary, ms binary, offs binary"
    return dealt.select("part", "doc", "fp", "lo", "m", "off", "bytes").mapInArrow(runs, schema).groupBy("part").applyInPandas(merge, "doc long, fp long, a long, b long")


def counted_windows(contexts: DataFrame, length: int) -> DataFrame:
    """doc, fp, a, b of the windows that go, for grams of too many rows: each window by 128 bits of hash."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, fp, lo, m, content in zip(*(batch.column(k).to_pylist() for k in ("doc", "fp", "lo", "m", "bytes")), strict=True):
                data, place = np.frombuffer(content, np.uint8), np.arange(m)
                hashes = [_hash(_sums(data, t), place, place + length).view(np.int64) for t in (_BYTES, _SECOND)]
                yield pa.RecordBatch.from_pydict({"h": pa.array(hashes[0]), "i": pa.array(hashes[1]), "doc": pa.array(np.full(m, doc)), "fp": pa.array(np.full(m, fp)), "a": pa.array(lo + place)})

    windows = stored(contexts.select("doc", "fp", "lo", "m", "bytes").mapInArrow(explode, "h long, i long, doc long, fp long, a long"), "suffix-windows")
    heads = stored(windows.groupBy("h", "i").agg(F.min(F.struct("doc", "a")).alias("head"), F.count("*").alias("n")).filter("n > 1"), "suffix-heads")
    met = windows.join(heads, ["h", "i"]).filter(F.col("head") != F.struct("doc", "a"))
    return met.select("doc", "fp", "a", (F.col("a") + length).alias("b"))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, crowd: int = 50_000, rows_per_merge: int = 20_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) for every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), text_of().alias("text"))
    repeated = not rows.groupBy("doc").count().filter("count > 1").isEmpty()
    rows = rows.withColumn("fp", F.xxhash64("text") if repeated else F.lit(0).cast("long"))
    marks = stored(marked(anchored(rows, length), crowd), "suffix-marks")
    contexts = stored(open_contexts(rows, marks, length), "suffix-contexts")
    parts = merged_windows(contexts.filter("NOT many"), rows_per_merge, length)
    if not contexts.filter("many").isEmpty():
        parts = parts.unionByName(counted_windows(contexts.filter("many"), length))
    whole = marks.select("doc", "fp", F.transform("done", lambda s: F.struct(s["lo"].alias("a"), (s["lo"] + s["m"] - 1 + length).alias("b"))).alias("gone"))
    partly = stored(parts, "suffix-parts").groupBy("doc", "fp").agg(F.collect_set(F.struct("a", "b")).alias("gone"))
    gone = whole.unionByName(partly).groupBy("doc", "fp").agg(F.flatten(F.collect_list("gone")).alias("gone"))

    def lose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, bytes]] = []
            for content, lists in zip(batch.column("z").to_pylist(), batch.column("gone"), strict=True):
                data = np.frombuffer(decompress(content), np.uint8)
                if not lists.is_valid or not len(lists.values):
                    out.append((len(data), 0, 0, data.tobytes()))
                    continue
                a, b = (np.minimum(lists.values.field(k).to_numpy(), len(data)) for k in ("a", "b"))
                depth = np.bincount(a, minlength=len(data) + 1).astype(np.int64) - np.bincount(b, minlength=len(data) + 1)
                covered = np.cumsum(depth)[:-1] > 0
                spans = int(covered[:1].sum()) + int((covered[1:] & ~covered[:-1]).sum())
                out.append((len(data), int(covered.sum()), spans, data[~covered].tobytes()))
            n, removed, spans, kept = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_pydict({"doc": batch.column("doc"), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(kept, pa.binary())})

    gone = gone.withColumnsRenamed({"doc": "of", "fp": "of_fp"})
    joined = compressed(rows, "doc", "fp").join(gone, (F.col("doc") == F.col("of")) & (F.col("fp") == F.col("of_fp")), "left").select("doc", "z", "gone")
    out = joined.mapInArrow(lose, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    out = suffix_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
