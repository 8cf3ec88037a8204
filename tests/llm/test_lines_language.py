"""Line dedup against brute force, its reversibility, and language ID on held-out rows."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from tunesmith.llm import langid, line_dedup

W = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(W).translate(LOWER)


def brute(rows):
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) > 1 and min(holders[key(x)]) != d)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def rows(first, n):
    rng = np.random.default_rng(first)
    pool = [f"  shared line number {i}\t" for i in range(40)] + ["SHARED line number 3", "short", "", "ÄÖÜ straße 東京 0123", "äöü straße 東京 0123", "x\x85 next line mark", "| | | | | | |"]
    return [(first + i, "\n".join(rng.choice(pool, rng.integers(0, 9)).tolist() + [f"own line of document {first + i}"] * (i % 3))) for i in range(n)]


ROWS = rows(0, 60) + [(500, None), (501, ""), (502, "\n\n"), (503, "one line only here\r"), (504, "One Line only here"), (505, "long shared line " * 9000), (506, "long shared line " * 9000)]


def digest(df):
    out = df.select("doc_id", "_n_lines", "_n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256))
    return sorted(tuple(r) for r in out.collect())


def test_line_dedup(docs_of):
    df = docs_of(ROWS).withColumn("key", F.lit(1)).withColumn("doc", F.lit(2)).withColumn("keys", F.lit(3)).withColumn("shard", F.lit(4))
    got = line_dedup.line_dedup(df)
    assert digest(got) == brute(ROWS)
    assert [c for c in got.columns if not c.startswith("_")] == df.columns


def test_no_rows_and_one_row(docs_of):
    assert line_dedup.line_dedup(docs_of([(1, "x")]).filter("doc_id < 0")).count() == 0
    assert digest(line_dedup.line_dedup(docs_of([(1, "the same line\nthe same line")]))) == brute([(1, "the same line\nthe same line")])


def test_null_ids_come_last(docs_of):
    got = line_dedup.line_dedup(docs_of([(None, "a line of some length"), (9, "a line of some length")]))
    assert sorted((str(r.doc_id), r._n_dropped) for r in got.collect()) == [("9", 0), ("None", 1)]


def state(index):
    filters = {r.shard: line_dedup.CuckooFilter.from_bytes(bytes(r["filter"])) for r in index.filters.collect()}
    refs = sorted((bytes(r.key), r.n_docs, r.first_doc) for r in index.refs.collect())
    for r in index.refs.filter("n_docs > 1").collect():
        assert filters[r.shard].may_hold(line_dedup._digests([bytes(r.key)]))[0]
    return refs, sum(int((f.table > 0).sum()) for f in filters.values())


def test_documents_come_and_go(docs_of):
    old, new = rows(0, 30), rows(100, 30)
    a = line_dedup.build(docs_of(old))
    both = line_dedup.insert(a, docs_of(new))
    assert state(both) == state(line_dedup.build(docs_of(old + new)))
    assert digest(line_dedup.without_lost_lines(docs_of(old + new), line_dedup.lost_postings(both, both.postings))) == brute(old + new)
    assert state(line_dedup.delete(both, docs_of(new).select("doc_id"))) == state(a)
    later = line_dedup.delete(both, docs_of(old).select("doc_id"))
    assert state(later) == state(line_dedup.build(docs_of(new)))


def test_filters_in_rounds(docs_of):
    index = line_dedup.build(docs_of(ROWS))
    got = line_dedup.without_lost_lines(docs_of(ROWS), line_dedup.lost_postings(index, index.postings, round_bytes=300))
    assert digest(got) == brute(ROWS)


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)
    f = line_dedup.CuckooFilter.for_keys(2500)
    assert f.insert(keys[:2500]) and f.may_hold(keys[:2500]).all()
    assert f.may_hold(keys[2500:]).mean() < 0.01
    f.delete(keys[:1000])
    assert f.may_hold(keys[1000:2500]).all() and f.may_hold(keys[:1000]).mean() < 0.01
    assert not line_dedup.CuckooFilter(16).insert(keys)


def language_rows():
    rng = np.random.default_rng(4)
    words = {"aa": ["ting", "thon", "ersh", "and", "oft"], "bb": ["kuva", "joki", "talo", "yksi", "sata"], "cc": ["чай", "дом", "лес", "мир", "сад"]}
    return [(i, " ".join(rng.choice(words[n], rng.integers(1, 40))), n) for i in range(300) for n in [list(words)[i % 3]]]


def test_language_id_on_held_out_rows(docs_of):
    odd = [(1000, None, None), (1001, "", "aa"), (1002, "12 +++ 34", "aa"), (1003, "Talo joki " * 20_000, None), (None, "kuva talo", "bb")]
    df = docs_of(language_rows() + odd).withColumn("score", F.lit("x")).withColumn("at", F.lit(1))
    model = langid.fit(df)
    assert model.languages == ["aa", "bb", "cc"]
    got = langid.identify(df, model, ["doc_id", "lang", "at", "score"]).withColumn("held", langid.remainder() == 1).collect()
    held = [r for r in got if r.held and r.doc_id < 1000]
    assert len(held) > 50 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "bb"]
    assert all(by_id[i].rejected and by_id[i].score == 0 for i in (1000, 1001, 1002))
    assert all(0 <= r.score <= 1 for r in got) and len(got) == 305
    kept = langid.identified_documents(df)
    assert kept.columns == df.columns and kept.count() >= 300
    again = langid.fit(df.repartition(1))
    assert np.array_equal(again.logits, model.logits) and again.reject == model.reject


def test_language_id_without_labels(docs_of):
    df = docs_of([(1, "abc", None), (2, None, None)])
    assert langid.fit(df) is None
    assert [tuple(r) for r in langid.identify(df, None, []).collect()] == [("und", 0.0, True)] * 2
    assert langid.identify(df.filter("doc_id < 0"), None, ["doc_id"]).count() == 0


def test_sample_has_many_ids_and_own_columns_stay(docs_of):
    rows = [(i, t, lang) for i, t, lang in language_rows()]
    hot = [(3, f"{t} {k}", "aa") for k, (_, t, _) in enumerate(rows * 4)] + [(5, "ting and", "aa")] * 400
    df = docs_of(rows + hot).withColumn("score", F.lit(7)).withColumn("lang_pred", F.lit("mine")).withColumn("rejected", F.lit("no"))
    model = langid.fit(df, sample_rows=300)
    assert model.languages == ["aa", "bb", "cc"]
    kept = langid.identified_documents(df, sample_rows=300)
    assert kept.columns == df.columns
    assert [tuple(r) for r in kept.select("score", "lang_pred", "rejected").distinct().collect()] == [(7, "mine", "no")]


def naive_prediction(model, text):
    """Subword by subword: logits of each, averaged; then the softmax."""
    folded = bytes(b if b >= 128 else (b + 32 if 65 <= b <= 90 else (b if 97 <= b <= 122 else 32)) for b in b" " + text.encode() + b"    ")
    total, n = np.zeros(len(model.languages) + 1), 0
    for size in langid.SIZES:
        for i in range(len(folded) - 4):
            if folded[i : i + 2] == b"  ":
                continue
            code = int.from_bytes(folded[i : i + size], "big") & 0xFFFFFFFF
            total += model.logits[(((code + size) * 2654435761) & 0xFFFFFFFF) >> (32 - langid.BITS)]
            n += 1
    z = total / max(n, 1) + model.bias
    p = np.exp(z - z.max())
    best = int(p[:-1].argmax())
    return model.languages[best], float((p / p.sum())[best])


def test_predictions_equal_a_naive_version(docs_of):
    df = docs_of(language_rows())
    model = langid.fit(df)
    texts = [t for _, t, _ in language_rows()[:40]] + ["Kuva, TALO 12!", "a", "мир and sata", "x\n\ny"]
    best, scores = model.predict(texts)
    for t, k, s in zip(texts, best, scores, strict=True):
        name, score = naive_prediction(model, t)
        assert model.languages[k] == name and abs(s - score) < 1e-4


def test_a_round_reads_its_folder(docs_of, monkeypatch):
    monkeypatch.setattr(line_dedup, "PART_SHARDS", 8)
    index = line_dedup.build(docs_of(ROWS))
    lost = line_dedup.lost_postings(index, index.postings)
    plan = lost._jdf.queryExecution().executedPlan().toString()
    filters = [x for x in plan.split("\n") if "PartitionFilters" in x and "(part" in x]
    assert len(filters) == 4
    assert digest(line_dedup.without_lost_lines(docs_of(ROWS), lost)) == brute(ROWS)
    old, new = rows(0, 30), rows(100, 30)
    both = line_dedup.insert(line_dedup.build(docs_of(old)), docs_of(new))
    assert digest(line_dedup.without_lost_lines(docs_of(old + new), line_dedup.lost_postings(both, both.postings))) == brute(old + new)


def test_many_rows_without_ids(docs_of):
    """A third of the rows have no id: each loses its own shared lines only, and the lists follow the texts."""
    shared = [f"a line that is shared {i}" for i in range(6)]
    named = [(i, "\n".join([shared[i % 6], f"line of its own {i}"])) for i in range(40)]
    nameless = [(None, "\n".join([shared[i % 6], f"only in a nameless row {i}", f"only in a nameless row {i}"])) for i in range(20)] + [(None, None), (3, "x\n" + shared[0])]
    df = docs_of(named + nameless)
    index = line_dedup.build(df)
    got = line_dedup.without_lost_lines(df, line_dedup.lost_postings(index, index.postings)).collect()
    assert len(got) == 62
    for r in got:
        if r.doc_id is None and r.text is not None:
            lines = r.text.split("\n")
            assert r._n_dropped == 1 and len(lines) == 2 and lines[0] == lines[1]
        elif r.text is not None and r.doc_id >= 6:
            assert r._n_dropped == 1 and r.text == f"line of its own {r.doc_id}"


def test_what_is_no_learned_language_is_rejected(docs_of):
    """Two languages in Latin script: another script and random letters go, clean held-out rows stay."""
    rng = np.random.default_rng(11)
    words = {"aa": ["ting", "thon", "ersh", "and", "oft", "wheren"], "bb": ["kuva", "joki", "talo", "yksi", "sata", "kaksi"]}
    clean = [(i, " ".join(rng.choice(words[n], rng.integers(15, 60))), n) for i in range(600) for n in [list(words)[i % 2]]]
    letters = list("abcdefghijklmnopqrstuvwxyz")
    noise = [(5000 + i, " ".join("".join(rng.choice(letters, 5)) for _ in range(40)), None) for i in range(40)]
    foreign = [(6000 + i, " ".join(rng.choice(["чай", "дом", "лес", "мир", "сад"], 40)), None) for i in range(40)]
    df = docs_of(clean + noise + foreign)
    got = langid.identify(df, langid.fit(df), ["doc_id"]).withColumn("held", langid.remainder() == 1).collect()
    held = [r for r in got if r.held and r.doc_id < 5000]
    assert len(held) > 100 and sum(not r.rejected for r in held) >= 0.99 * len(held)
    assert sum(r.rejected for r in got if 5000 <= r.doc_id < 6000) >= 36
    assert sum(r.rejected for r in got if r.doc_id >= 6000) == 40
    assert all(r.lang_pred in ("aa", "bb") for r in got)
