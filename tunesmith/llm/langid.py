"""Operator 10, language ID: averaged hashed subword embeddings with a linear softmax.

Subwords are the runs of 2, 3 and 4 bytes of the lower-cased text in which ASCII characters
other than letters count as one space, hashed into ``BUCKETS`` rows of an embedding
table. A document is the average of the embeddings of all its subwords (whole text); a linear
softmax layer over it gives the language. Both are trained by stochastic gradient descent in numpy.

Training reads a bounded sample: ``sample_rows`` distinct labelled rows by the hash
of doc_id, text and lang among those whose crc32(doc_id as text) mod 3 is not 1 (the rows with remainder 1
are held out). One in ``BACKGROUND`` sample texts enters once more with its characters shuffled, as a class of background
that is never predicted. Remainder 2 trains; remainder 0 calibrates: a temperature makes the
softmax a probability, and a document is rejected when its score is below the
``reject_share`` quantile of the scores of calibration rows that were predicted right, so about that share of documents in
a learned language goes. Only text and language of sample rows enter the model.

As the layer is linear, prediction needs only each bucket's logits (a table of BUCKETS x
classes, which is sent to the tasks) and averages them over a text.

``lang_pred`` is ``und``, with score 0, for null texts, texts without a letter, and if no
labelled row was found. Null doc_ids are never held out nor trained on; rows that repeat are
predicted alike; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.llm.common import read_table, tidied

BITS = 16
BUCKETS = 1 << BITS
SIZES = (2, 3, 4)
BACKGROUND = 4
_PAD = b"    "
_FOLD = np.array([b if b >= 128 else (b + 32 if 65 <= b <= 90 else (b if 97 <= b <= 122 else 32)) for b in range(256)], dtype=np.uint32)


def subwords(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each subword size: buckets, weights (0 inside runs of spaces), first place of each text."""
    parts = [t.encode() for t in texts]
    b = _FOLD[np.frombuffer(_PAD[:1] + _PAD.join(parts) + _PAD, dtype=np.uint8)]
    lengths = np.array([len(p) + len(_PAD) for p in parts])
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    n = len(b) - len(_PAD)
    blank = (b[:-1] == 32) & (b[1:] == 32)
    weight = (~blank[:n]).astype(np.float32)
    code = b[:n].copy()
    for size in range(2, max(SIZES) + 1):
        code = (code << np.uint32(8)) | b[size - 1 : size - 1 + n]
        if size in SIZES:
            yield ((code + np.uint32(size)) * np.uint32(2654435761)) >> np.uint32(32 - BITS), weight, first


def runs_of(rows: list[int], texts: list[str], chars: int = 400_000) -> Iterator[list[int]]:
    """Runs of rows with about ``chars`` characters, or one longer text: what is hashed at a time."""
    run: list[int] = []
    held = 0
    for i in rows:
        run.append(i)
        held += len(texts[i])
        if held >= chars:
            yield run
            run, held = [], 0
    if run:
        yield run


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # BUCKETS x (languages, background), the temperature already applied
    bias: np.ndarray
    reject: float

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, score) of each text."""
        total, weights = None, None
        for buckets, weight, first in subwords(texts):
            sums = np.add.reduceat(self.logits[buckets] * weight[:, None], first, axis=0)
            total = sums if total is None else total + sums
            w = np.add.reduceat(weight, first)
            weights = w if weights is None else weights + w
        z = total.astype(np.float64) / np.maximum(weights, 1.0)[:, None] + self.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p[:, : len(self.languages)].argmax(axis=1)
        return best, p[np.arange(len(best)), best]


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of one text and their shares."""
    counts = sum(np.bincount(h, weights=w, minlength=BUCKETS) for h, w, _ in subwords([text]))
    at = np.flatnonzero(counts)
    return at.astype(np.int32), (counts[at] / max(1.0, counts.sum())).astype(np.float32)


def shuffled(text: str) -> str:
    """The characters of a text in an order that depends on the text alone: what is no language."""
    chars = np.array(list(text))
    return "".join(np.random.default_rng(zlib.crc32(text.encode())).permutation(chars))


def train(rows: list[tuple[str | None, int, np.ndarray, np.ndarray]], dim: int = 16, epochs: int = 12, rate: float = 0.5, reject_share: float = 0.001, seed: int = 1) -> Model | None:
    """``rows``: (language, remainder, buckets, shares); language None is background. Remainder 2 trains, the others calibrate."""
    rows = [r for r in rows if len(r[2])]
    languages = sorted({r[0] for r in rows if r[0] is not None})
    if not languages:
        return None
    y = {name: i for i, name in enumerate([*languages, None])}
    learn = [r for r in rows if r[1] == 2] or rows
    learn += [next(r for r in rows if r[0] == name) for name in sorted(set(languages) - {r[0] for r in learn})]
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1.0 / dim, 1.0 / dim, (BUCKETS, dim))
    layer, bias = np.zeros((dim, len(y))), np.zeros(len(y))
    steps, done = epochs * len(learn), 0
    for _ in range(epochs):
        for i in rng.permutation(len(learn)):
            name, _, at, share = learn[i]
            step = rate * (1 - done / steps)
            done += 1
            hidden = share @ table[at]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[name]] -= 1
            back = layer @ p
            layer -= step * np.outer(hidden, p)
            bias -= 0.1 * step * p
            table[at] -= step * np.outer(share, back) * 50  # a subword's share is small; its embedding moves in proportion to it
    logits = table @ layer
    check = [r for r in rows if r[1] != 2] or rows
    z = np.array([share @ logits[at] for _, _, at, share in check]) + bias
    right = np.array([y[r[0]] for r in check])

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), right]).mean())

    temperature = min(np.geomspace(0.05, 20, 61), key=loss)
    s = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
    s /= s.sum(axis=1, keepdims=True)
    correct = s.max(axis=1)[(s.argmax(axis=1) == right) & (right < len(languages))]
    reject = float(np.quantile(correct, reject_share)) if len(correct) else 0.0
    return Model(languages, (logits / temperature).astype(np.float32), bias / temperature, reject)


def remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3


def fit(docs: DataFrame, sample_rows: int = 3000, **options) -> Model | None:
    """The model of the sample described above; at most ``sample_rows`` bags and their shuffled ones reach the driver."""
    spark = docs.sparkSession
    lettered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"), remainder().cast("long").alias("fold"))
    lettered = lettered.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.col("fold") != 1) & F.col("text").rlike(r"\p{L}"))
    lettered = lettered.withColumn("of", F.xxhash64("text")).withColumn("place", F.xxhash64(F.lit(29), "doc_id", "of", "lang"))
    # Distinct rows in the order of their hashes, from a range of hashes that holds some times as many rows as wanted.
    keys = lettered.select("place", "doc_id", "of", "lang")
    n = keys.count()
    if n > 20 * sample_rows:
        keys = keys.filter(F.pmod("place", F.lit(1 << 30)) < F.lit(int(20 * sample_rows / n * (1 << 30))))
    chosen = keys.distinct().orderBy("place", "doc_id", "of", "lang").limit(sample_rows).collect()
    places = spark.createDataFrame([(r.place, r.doc_id, r.of, r.lang) for r in chosen], "place long, doc_id long, of long, lang string")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            noise = [i for i, t in enumerate(texts) if zlib.crc32(t.encode()) % BACKGROUND == 0]
            every = [*map(bag, texts), *(bag(shuffled(texts[i])) for i in noise)]
            at, share = [a for a, _ in every], [s for _, s in every]
            rows = batch.select(["doc_id", "lang", "fold"]).to_pylist()
            rows += [rows[i] | {"lang": None} for i in noise]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()), "lang": pa.array([r["lang"] for r in rows], pa.string()), "fold": pa.array([r["fold"] for r in rows], pa.int64()), "at": pa.array(at, pa.list_(pa.int32())), "share": pa.array(share, pa.list_(pa.float32()))}
            )

    # At most sample_rows keys: a bounded broadcast. Rows that repeat a text under one id and language are one.
    sample = lettered.join(F.broadcast(places), ["place", "doc_id", "of", "lang"]).dropDuplicates(["place", "doc_id", "of", "lang"])
    found = sample.select("doc_id", "text", "lang", "fold").mapInArrow(tidied(bags), "doc_id long, lang string, fold long, at array<int>, share array<float>").toArrow()
    columns = [found.column(c).to_pylist() for c in ("doc_id", "lang", "fold")]
    lists = [[x.values.to_numpy() for x in found.column(c)] for c in ("at", "share")]
    rows = sorted(zip(*columns, *lists, strict=True), key=lambda r: (r[1] is None, r[0], r[1] or "", len(r[3]), r[3].tobytes()))
    return train([r[1:] for r in rows], **options)


NAMES = ("lang_pred", "score", "rejected")


def identify(docs: DataFrame, model: Model | None, keep: list[str], names: tuple[str, str, str] = NAMES) -> DataFrame:
    """The columns ``keep`` of ``docs`` with language, score and whether it is rejected, under ``names`` (which replace columns
    of these names)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # BUCKETS x languages floats
    keep = [c for c in keep if c not in names]
    rows = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"), F.col("text").alias("_text"))
    schema = rows.select(*keep).schema.add(names[0], "string").add(names[1], "double").add(names[2], "boolean")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts, letters = batch.column("_text").to_pylist(), batch.column("_letters").to_pylist()
            found, scores = ["und"] * len(texts), [0.0] * len(texts)
            usable = [i for i, x in enumerate(letters) if x] if model else []
            for some in runs_of(usable, texts):
                for i, k, s in zip(some, *model.predict([texts[i] for i in some]), strict=True):
                    found[i], scores[i] = model.languages[k], float(min(1.0, max(0.0, s)))
            gone = [n == "und" or s < model.reject for n, s in zip(found, scores, strict=True)]
            columns = [batch.column(c) for c in keep] + [pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(gone, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    return rows.mapInArrow(tidied(predict), schema)


def identified_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    names = tuple(f"_language_id_{n}" for n in NAMES)
    out = identify(docs, fit(docs, **options), docs.columns, names)
    return out.filter(~F.col(names[2])).select(*docs.columns)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify(docs, fit(docs), ["doc_id"])
    return out.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
