"""Tokenizers, their alignment and the manifest against plain loops."""

from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pavilion.llm import align, bytebpe, merkle
from pavilion.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import frame, in_order, sorted_rows

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "b", " ", "  ", "\n", "'s", "'re", "é", "日本", "、", "1", "23", ".", "!", "　", "\x85", "\x1c", "x'", "😀", "\t", "the ", "don't", "<|endoftext|>", "<0x41>", "▁", "ﬁ", "́", "###"]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def jumble(seed, n=80):
    draw = random.Random(seed)
    return "".join(draw.choice(PARTS) for _ in range(n))


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as file:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}


@pytest.fixture(scope="module")
def pair():
    return align.read_pair(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def encoders(pair):
    return align.Encoders(*pair)


@pytest.fixture(scope="module")
def texts(messy):
    extra = [jumble(s) for s in range(40)] + [" " * 50, "x" + "\n" * 9000 + "y", "z" * 3000, " lead", "trail ", "日本" * 900]
    return [*messy, *((100 + i, t) for i, t in enumerate(extra)), (100, extra[0]), (200, extra[1])]


def whole(encoders, texts):
    return brute.alignment(texts, lambda t: encoders.a.encode(t, add_special_tokens=False).ids, encoders.b.encode, encoders.bytes_a, encoders.bytes_b)


def test_encode_and_decode(spark, texts, ranks):
    docs = frame(spark, texts)
    coded = bytebpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN, piece_chars=40)
    found = [(r["doc_id"], r["ids"], bytes(r["decoded"])) for r in bytebpe.decode_tokens(coded, RANKS).collect()]
    expected = [(i, brute.byte_pairs(t, ranks, public_tokenizers.PATTERN), (t or "").encode()) for i, t in texts if len(t or "") < 5000]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted((r for r in found if len(r[2]) < 5000), key=key) == sorted((r for r in expected if len(r[2]) < 5000), key=key)
    assert sorted((r[0] or 0, r[2]) for r in found) == sorted((i or 0, (t or "").encode()) for i, t in texts)
    assert bytebpe.encode_texts(docs.where("false"), RANKS, public_tokenizers.PATTERN).count() == 0


def test_decode_keeps_columns_and_broken_characters(spark):
    rows = spark.createDataFrame([(1, [160], "x"), (2, None, "y"), (3, [], "z")], "ids_of int, ids array<int>, decoded string")
    found = {r["ids_of"]: r["decoded"] for r in bytebpe.decode_tokens(rows, RANKS).collect()}
    assert found[2] is None and bytes(found[3]) == b"" and len(found[1]) == 1


@pytest.mark.parametrize("size", [7, 50, 1 << 16])
def test_pieces_do_not_change_ids(size):
    enc = bytebpe.encoding(bytebpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    for seed in range(60):
        text = jumble(seed, 300)
        if seed % 3 == 0:
            text = text[:150] + random.Random(seed).choice([" ", "\n", " \t"]) * 5000 + ["", "x", "\n"][seed % 9 // 3] + text[150:] + "\n" * 4500
        assert "".join(p for p, _ in bytebpe.pieces(text, size)) == text
        assert bytebpe.encode_whole(enc, text, size) == enc.encode_ordinary(text)


def test_very_long_texts_of_one_run():
    enc = bytebpe.encoding(bytebpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    for text in (" " * 2_000_000 + "x", "\n" * 1_000_000, "word " * 300_000, "é" * 200_000):
        assert enc.decode(bytebpe.encode_whole(enc, text)) == text


def test_bpe_over_the_table(spark, ranks):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op13_byte_level_bpe"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = brute.byte_pairs(docs[r["doc_id"]], ranks, public_tokenizers.PATTERN)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(docs[r["doc_id"]] or ""))


@pytest.mark.parametrize(("chunk_docs", "merge_runs"), [(1 << 15, 64), (3, 2)])
def test_alignment(spark, texts, pair, encoders, monkeypatch, chunk_docs, merge_runs):
    """Also with many chunks, whose runs are merged in several tasks, block by block."""
    monkeypatch.setattr(align, "CHUNK_DOCS", chunk_docs)
    monkeypatch.setattr(align, "MERGE_RUNS", merge_runs)
    monkeypatch.setattr(align, "_WIDE_GROUP", 30)
    monkeypatch.setattr(align, "_LINKS", 500)
    found = align.align_tokens(frame(spark, texts), pair)
    expected = whole(encoders, texts)
    assert sorted(map(str, found.select(*COLUMNS).collect())) == sorted(map(str, spark.createDataFrame(expected, found.select(*COLUMNS).schema).collect()))
    for r in found.collect():
        assert (brute.sha(r["groups"]) if r["groups"] else "") == r["groups_sha256"]


def test_alignment_of_nothing(spark, pair):
    docs = frame(spark, [(1, None), (2, ""), (2, "")])
    rows = sorted_rows(align.align_tokens(docs, pair, with_groups=False), *COLUMNS)
    assert rows == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert align.align_tokens(docs.where("false"), pair).count() == 0


def test_alignment_over_the_table(spark, encoders):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted_rows(QUERIES["op11_spill_counted_alignment"](spark, FOLDER), *COLUMNS) == in_order(whole(encoders, docs))


def test_runs_are_merged_by_blocks():
    draw = np.random.Generator(np.random.PCG64(1))
    runs, count = [], {}
    for _ in range(9):
        pairs = np.unique(draw.integers(0, 400, 150).astype(np.uint64) << np.uint64(18))
        rows = np.empty(len(pairs), align._COUNTED)
        rows["pair"], rows["n"] = pairs, draw.integers(1, 9, len(pairs))
        for p, n in zip(pairs.tolist(), rows["n"].tolist(), strict=True):
            count[p] = count.get(p, 0) + n
        runs.append(align._packed(rows))
    runs.append(align._packed(np.empty(0, align._COUNTED)))
    got = np.concatenate(list(align.judged(align.merged([align.run_blocks(r, align._COUNTED, 16) for r in runs]))))
    assert dict(zip(got["pair"].tolist(), got["n"].tolist(), strict=True)) == count and (np.diff(got["pair"].astype(np.int64)) > 0).all()
    most = {}
    for p, n in count.items():
        most[p >> 20] = max(n, most.get(p >> 20, 0))
    assert got["best"].tolist() == [int(n == most[p >> 20]) for p, n in sorted(count.items())]


def rows_of(texts, sources):
    return [(i, s, "en" if n % 3 else None, n, t) for n, ((i, t), s) in enumerate(zip(texts, sources, strict=True))]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(spark, texts, levels):
    """Sources of one leaf, of many, and none; blocks of three leaves, nine, and more than there are."""
    sources = [["hot", "hot", "é", None, f"s{n}"][n % 5] for n in range(len(texts))]
    rows = rows_of(texts, sources)
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(3)
    docs = docs.withColumns({"subroot": F.lit("x"), "extra": F.lit(1)})
    leaves = merkle.tampered_digests(docs, columns)
    found = merkle.merkle_proofs(leaves, F.col("source"), [F.col("doc_id")], block_levels=levels)
    assert "extra" in found.columns and found.columns.count("subroot") == 1
    proof = F.col("proof")
    found = found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(proof).alias("p"), merkle.fold_proof(F.col("tampered"), proof).alias("f"), merkle.fold_proof(F.col("leaf"), proof).alias("g"))
    got = found.collect()
    assert all(r["g"] == r["root"] for r in got)
    assert sorted(str((*r[:6], r["f"] == r["root"])) for r in got) == sorted(map(str, brute.manifest(rows)))
    assert merkle.merkle_proofs(leaves.where("false"), F.col("source"), [F.col("doc_id")]).count() == 0


def test_manifest_of_one_row(spark):
    leaves = spark.createDataFrame([("a", "s")], "leaf string, source string")
    row = merkle.merkle_proofs(leaves, F.col("source"), []).first()
    assert row["subroot"] == row["root"] == "a" and row["proof"] == []


def test_forward_and_backward():
    digests = [brute.sha(str(i)) for i in range(30)]
    for n in (1, 2, 3, 4, 9, 10, 27, 30):
        for alone in (True, False):
            tree = merkle.forward(digests[:n], 3, 4, alone)
            assert [len(x) for x in tree][-1] == 1 and (alone or len(tree) == 5)
            for i, proof in enumerate(merkle.backward(tree, 3, [("b", "a")])):
                own = digests[i]
                for before, after in proof[:-1]:
                    own = brute.sha(before + own + after)
                assert own == tree[-1][0] and proof[-1] == ("b", "a")
