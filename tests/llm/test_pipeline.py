"""The pipeline against brute force over a small table, stage by stage."""

import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from test_jaccard import brute as brute_groups
from test_lines_language import brute as brute_lines
from tunesmith.llm import langid, mixing
from tunesmith.llm.tokens import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def make_documents():
    rng = np.random.default_rng(12)
    words = {"aa": ["ting", "thon", "ersh", "and", "oft", "bler"], "bb": ["kuva", "joki", "talo", "yksi", "sata", "pieni"]}
    rows = []
    for i in range(240):
        lang = ["aa", "bb"][i % 2]
        lines = [" ".join(rng.choice(words[lang], rng.integers(3, 30)).tolist() + [f"x{i}y{j}"]) for j in range(rng.integers(1, 6))]
        if i % 5 == 0:
            lines.append("a licence line that many documents hold")
        rows.append((i, "\n".join(lines), lang, f"src{i % 4}"))
    rows += [(300 + i, rows[i][1] + f" end{i}", rows[i][2], "src9") for i in range(0, 40, 3)]
    rows += [(400, None, "aa", "src0"), (401, "12 34 ++", "aa", None), (402, "", "bb", "src1"), (403, rows[7][1], None, "src1")]
    return rows


def test_pipeline(spark, docs_of, tmp_path):
    rows = make_documents()
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        steps.append((docs.collect(), spark.read.parquet(str(tmp_path / name))))
        if name != "packing":
            assert out.columns == docs.columns
        docs = steps[-1][1]
    # language ID: only texts without letters go, and the others are unchanged
    before, after = steps[0]
    model = langid.fit(docs_of(rows))
    reject = {r.doc_id for r in langid.identify(docs_of(rows), model, ["doc_id"]).collect() if r.rejected}
    assert {400, 401, 402} <= reject and len(reject) <= 6
    assert Counter(map(tuple, after.collect())) == Counter(tuple(r) for r in before if r.doc_id not in reject)
    # line dedup
    before, after = steps[1]
    import hashlib

    want = {d: h for d, _, _, h in brute_lines([(r.doc_id, r.text) for r in before])}
    got = after.collect()
    assert {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)
    # near duplicates
    before, after = steps[2]
    keep = {c for _, c, _, _ in brute_groups([(r.doc_id, r.text) for r in before])}
    assert Counter(map(tuple, after.collect())) == Counter(tuple(r) for r in before if r.doc_id in keep)
    # mixing: every document has its taken words
    before, after = steps[3]
    plan = {r.doc_id: r.taken for r in mixing.mix(steps[2][1]).collect()}
    got = {r.doc_id: r.text for r in after.collect()}
    assert {d: len(WORD.findall(t)) for d, t in got.items()} == {d: n for d, n in plan.items() if n}
    source = {r.doc_id: WORD.findall(r.text or "") for r in before}
    for d, t in got.items():
        spare = Counter({w: 3 * n for w, n in Counter(source[d]).items()})
        assert not Counter(WORD.findall(t)) - spare
    # packing
    before, after = steps[4]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    pieces = {}
    for r in after.collect():
        pieces.setdefault(r.doc_id, []).append(r)
    for r in before:
        ids, at = [*tok.encode(r.text, add_special_tokens=False).ids, 0], 0
        for p in sorted(pieces[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    # run() gives what the stages give
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, after.collect()))
