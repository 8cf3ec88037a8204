"""Token files and packing: exact round trips against the tokenizers library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tunesmith.llm import packing, token_output
from tunesmith.llm.tokens import Encoder, tokenizer_path

TEXTS = [
    (5, "The cat  sat \n on the mat.\n\nIt's  fine"),
    (1, None),
    (2, ""),
    (9, "don't  <|endoftext|> a  <|endoftext|>"),
    (7, "naïve 東京 \t x　y \x1c z 123abc ''s 's" * 3),
    (8, "word " * 4000),
    (3, "same"),
    (4, "same"),
    (None, "no id"),
]


def reference(text, end):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab A1.'s\n\t é東　\x1c<|>")), max_size=40))
def test_segments_encode_as_the_whole(text):
    enc = Encoder(tokenizer_path()) if not hasattr(test_segments_encode_as_the_whole, "e") else test_segments_encode_as_the_whole.e
    test_segments_encode_as_the_whole.e = enc
    assert enc.encode([text])[0].tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 5, 8, 16, 17, 31, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64)
    for n in (0, 1, 31, 32, 33, 1000):
        assert token_output.unpack_bits(token_output.pack_bits(ids[:n], bits), bits, n).tolist() == ids[:n].tolist()


def test_random_access_in_a_file():
    ids = np.random.default_rng(1).integers(0, 50257, 20_000).astype(np.uint32)
    f = token_output.TokenFile(token_output.file_bytes([(4, ids[:9000]), (None, ids[9000:])], 16, 0, 0) + b"\n")
    assert f.ids_at(4000, 10_000).tolist() == ids[4000:14_000].tolist()
    assert f.docs["n"].tolist() == [9000, 11_000] and f.docs["null"].tolist() == [0, 1]


@pytest.mark.parametrize("partitions, per_file", [(1, 100), (4, 3000)])
def test_token_files_round_trip(spark, docs_of, tmp_path, partitions, per_file):
    folder = str(tmp_path / "files")
    token_output.write_token_files(docs_of(TEXTS), folder, tokenizer_path(), 2, per_file, partitions)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_output.digest(spark, folder).collect())
    want, start = [], 0
    for d, t in sorted(TEXTS, key=lambda r: -1 if r[0] is None else r[0]):
        ids = reference(t, 2)
        want.append((-1 if d is None else d, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want
    held = {r.doc_id: list(r.ids) for r in token_output.read_token_files(spark, folder).collect()}
    assert all(held[d] == reference(t, 2) for d, t in TEXTS)


def test_empty_table(spark, docs_of, tmp_path):
    empty = docs_of([(1, "x")]).filter("doc_id < 0")
    folder = str(tmp_path / "files")
    token_output.write_token_files(empty, folder, tokenizer_path(), 2)
    assert token_output.digest(spark, folder).count() == 0
    assert packing.pack(empty, tokenizer_path(), 0).count() == 0


@pytest.mark.parametrize("per_group", [3, 2048])
def test_packing_is_a_partition_of_all_ids(docs_of, per_group):
    rows = TEXTS[:-1] + [(100 + i, "lorem ipsum " * (i % 90)) for i in range(60)] + [(None, "n")]
    got = packing.pack(docs_of(rows).selectExpr("*", "1 AS g", "2 AS n"), tokenizer_path(), 0, capacity=64, docs_per_group=per_group).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d, t in rows:
        ids, at = reference(t, 0), 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
        padding += 64 - at
    # less than one sequence for each group of documents
    assert padding < 64 * -(-len(rows) // per_group)


def test_lowest_cost_gets_the_next_rest():
    pieces = packing.assign(np.array([6, 6, 5, 3, 2, 2]), 12, 1.0, 0.1)
    assert sum(p[2] for p in pieces) == 24 and {p[3] for p in pieces} == {0, 1}
    assert [p[3] for p in pieces[:3]] == [0, 1, 0]
