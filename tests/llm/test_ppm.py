"""Log probabilities by partial matching against a plain trie, and the base against counting."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunesmith.llm import ppm as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def stream(text):
    return "".join(w + " " for w in words(text)).encode() + b"\n"


class Plain:
    """Counts by context in a dictionary; one byte at a time."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for t in texts:
            data = b"\n" * order + stream(t)
            for i in range(order, len(data)):
                for k in range(order + 1):
                    self.seen[data[i - k : i]][data[i]] += 1

    def p(self, context, byte):
        excluded, out = set(), 1.0
        for k in range(self.order, -1, -1):
            counts = {b: c for b, c in self.seen.get(context[len(context) - k :], {}).items() if b not in excluded}
            n, q = sum(counts.values()), len(counts)
            if not n:
                continue
            if byte in counts:
                return out * (2 * counts[byte] - 1) / (2 * n)
            out *= q / (2 * n)
            excluded |= set(counts)
        return out / max(1, 256 - len(excluded))

    def log10(self, text):
        data = b"\n" * self.order + stream(text)
        return sum(math.log10(self.p(data[i - self.order : i], data[i])) for i in range(self.order, len(data)))


def some_docs():
    rng = random.Random(6)
    vocab = ["the", "There", "thin", "o\x0bf", "été", "ÉTÉ", "東京", "x", "end.", "a\x00b"]
    docs = [(i, (" " if i % 3 else "\n\t ").join(rng.choices(vocab, k=rng.randrange(0, 25)))) for i in range(80)]
    docs += [(7, "the the"), (7, docs[3][1]), (None, "thin there"), (None, None), (600, None), (601, ""), (602, " \n "), (603, "zq" * 40), (604, "the of " * 500)]
    return docs


def plain_rows(docs, order):
    def train(d):
        return d is None or zlib.crc32(str(d).encode()) % 5 != 1

    model = Plain([t for d, t in docs if train(d)], order)
    c = Counter(w for d, t in docs if train(d) for w in [*words(t), "\n"])
    n, v = c.total(), len(c)
    out = []
    for d, t in docs:
        some = [*words(t), "\n"]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in some)
        out.append((d is None, d or 0, train(d), len(some), sum(c[w] > 0 for w in some), n, round(base, 4), round(model.log10(t), 3)))
    return sorted(out)


@pytest.mark.parametrize("order, chunk, shard, piece", [(5, 8 << 20, 16 << 20, 1 << 20), (3, 300, 1000, 40), (2, 2000, 200, 1 << 20)])
def test_scores_equal_a_plain_trie(spark, monkeypatch, order, chunk, shard, piece):
    monkeypatch.setattr(P, "MERGE_AT", 10)
    monkeypatch.setattr(P, "STEP", 97)
    monkeypatch.setattr(P, "CHUNK_BYTES", 500)
    monkeypatch.setattr("tunesmith.llm.words.pieces.__defaults__", (piece,))
    docs = some_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("train", F.lit("x")).withColumn("score", F.lit(1)).repartition(3)
    got = P.score_documents(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, order, chunk, shard)
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.train, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 3)) for r in got.collect())
    want = plain_rows(docs, order)
    assert [r[:6] for r in rows] == [r[:6] for r in want]
    assert np.allclose([r[6:] for r in rows], [r[6:] for r in want], atol=2e-3)


def test_probabilities_add_up_to_one():
    texts = [t for _, t in some_docs()]
    data = np.frombuffer(b"".join(b"\n" * 4 + stream(t) for t in texts), np.uint8)
    keys = np.sort(P.windows(data, 4))
    at = P.distinct(keys)
    keys, counts = keys[at], np.diff(np.append(at, len(keys))).astype(np.uint64)
    pair = (keys >> np.uint64(32)).astype(np.int64) * 256 + (keys & np.uint64(255)).astype(np.int64)
    model = P.Contexts(keys, counts, np.bincount(pair, counts, minlength=1 << 16).astype(np.int64), 4)
    for context in (b"the ", b"\n\n\n\n", b"zzzz", "é ".encode()[-2:] * 2, b"tthe"):
        every = [int.from_bytes(context[::-1] + bytes([b]), "big") for b in range(256)]
        assert abs((10 ** model.log10(np.array(every, np.uint64))).sum() - 1) < 1e-9


def test_without_training_documents_and_without_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert P.score_documents(none, F.lit(True)).count() == 0
    one = spark.createDataFrame([(1, "ab c")], "doc_id long, text string")
    r = P.score_documents(one, F.lit(False)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and abs(r.score + 6 * math.log10(256)) < 1e-5


def test_held_out_text_like_the_training_text_scores_above_noise(spark):
    rng = random.Random(1)
    vocab = ["".join(rng.choices("aeiourstn", k=rng.randrange(2, 8))) for _ in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=60))) for i in range(300)]
    noise = [(1000 + i, " ".join("".join(rng.choices("qxzjkvwy", k=5)) for _ in range(60))) for i in range(20)]
    got = P.score_documents(spark.createDataFrame(docs + noise, "doc_id long, text string"), F.col("doc_id") % 5 != 1).filter(~F.col("train")).collect()
    like = [r.score / r.n_tokens for r in got if r.doc_id < 1000]
    assert min(like) > max(r.score / r.n_tokens for r in got if r.doc_id >= 1000)
