"""Suffix dedup against a dictionary of all 100-byte strings."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tunesmith.llm import suffix_dedup as S


def brute(rows):
    seen, out = {}, []
    for d, t in sorted(rows):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            if seen.setdefault(data[p : p + 100], (d, p)) != (d, p):
                gone[p : p + 100] = True
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((d, len(data), int(gone.sum()), spans, kept))
    return out


def make_rows():
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdeé"), rng.integers(1, 9)))
    passages = [" ".join(word() for _ in range(rng.integers(15, 60))) for _ in range(12)]
    rows = []
    for i in range(70):
        parts = []
        for _ in range(rng.integers(1, 6)):
            if rng.random() < 0.5:
                p = str(rng.choice(passages))
                a = rng.integers(0, len(p) // 2)
                parts.append(p[a : a + rng.integers(60, len(p))])
            else:
                parts.append(" ".join(word() for _ in range(rng.integers(1, 50))))
        rows.append((i, " ".join(parts)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (204, "x" * 99), (205, "x" * 100), (206, "x" * 350), (207, "Is onhe. " * 60), (208, "a Is onhe. " + "Is onhe. " * 50), (209, "短い文" * 80)]
    return rows


def collected(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


@pytest.mark.parametrize("crowd, per_merge", [(50_000, 20_000), (50_000, 7), (3, 50)])
def test_suffix_dedup(docs_of, crowd, per_merge):
    df = docs_of(make_rows()).withColumn("doc", F.lit(1)).withColumn("gram", F.lit(2)).withColumn("z", F.lit(3)).withColumn("gone", F.lit(4))
    assert collected(S.suffix_dedup(df, crowd=crowd, rows_per_merge=per_merge)) == brute(make_rows())


def test_long_texts_are_cut_into_parts(docs_of, monkeypatch):
    rng = np.random.default_rng(2)
    base = "".join(rng.choice(list("abcdefgh "), 9000))
    rows = [(1, base), (2, base[500:7000] + "!" + base[:3000]), (3, base[100:])]
    monkeypatch.setattr(S, "SPAN", 1000)
    parts = list(S._chunks(np.frombuffer(base.encode(), np.uint8), np.array([0, 9000])))
    assert len(parts) > 5
    assert collected(S.suffix_dedup(docs_of(rows))) == brute(rows)


def test_empty_nulls_and_repeats(docs_of):
    assert S.suffix_dedup(docs_of([(1, "x")]).filter("doc_id < 0")).count() == 0
    text = "".join(np.random.default_rng(1).choice(list("abcdefgh"), 400))
    got = S.suffix_dedup(docs_of([(5, text), (5, text), (None, text), (7, "short")])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("5", 0), ("5", 0), ("7", 0), ("None", 400)]


@pytest.mark.parametrize("crowd", [50_000, 1])
def test_rows_that_share_a_doc_id_lose_their_own_bytes_only(docs_of, crowd):
    rng = np.random.default_rng(9)
    text = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    passage, other = text(300), text(260)
    rows = [(1, passage + text(200)), (2, other)]
    rows += [(i, text(40 + 7 * j) + p[:-j] + text(350)) for i in (None, 7) for j, p in enumerate((passage, other, passage), 1)]
    rows += [(None, text(900)), (7, text(900)), (7, rows[-1][1])]
    first = {}
    for d, t in rows:
        for p in range(len(t) - 99):
            at = (d is None, d or 0, p)
            first[t[p : p + 100]] = min(first.get(t[p : p + 100], at), at)
    want = []
    for d, t in rows:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 99):
            if first[t[p : p + 100]] != (d is None, d or 0, p):
                gone[p : p + 100] = True
        want.append((str(d), len(t), int(gone.sum()), "".join(np.array(list(t))[~gone])))
    got = S.suffix_dedup(docs_of(rows), crowd=crowd).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, bytes(r.kept).decode()) for r in got) == sorted(want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=12).map(str.encode), max_size=9), min_size=1, max_size=6))
def test_loser_tree_merges_and_gives_lcps(runs):
    runs = [sorted(r) for r in runs]
    merged = list(S.merge_runs([S.front_coded(r) for r in runs]))
    strings = [s for _, _, s, _ in merged]
    assert strings == sorted(s for r in runs for s in r)
    assert all(runs[r][p] == s for r, p, s, _ in merged)
    for before, (_, _, s, k) in zip([b"", *strings], merged, strict=False):
        n = 0
        while n < min(len(before), len(s)) and before[n] == s[n]:
            n += 1
        assert k == n
