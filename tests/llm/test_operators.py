"""Each operator against plain loops, on messy rows, repeated rows and empty tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from pavilion.llm import cascade, decontaminate, hilbert, keyfilter, langid, lines, mixture, neardup, repeats, rindex, rlz, textkeys, warc
from pavilion.llm.graph import components
from pavilion.session import new_folder
from tests.llm import brute
from tests.llm.conftest import frame, in_order, prose, sorted_rows

SMALL = {"filter_bits": 18}


@pytest.fixture(scope="module")
def docs(spark, messy):
    return frame(spark, messy).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_windows_of_words(docs, messy, empty):
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    found = rlz.remove_repeats(docs, window=12, seed_words=4, **SMALL)
    assert sorted_rows(found, *columns) == in_order(brute.repeated_words(messy, 12))
    assert rlz.remove_repeats(empty, **SMALL).count() == 0


@pytest.mark.parametrize("seed_rows", [0, 2])
def test_common_seeds_are_spread(docs, messy, seed_rows):
    words = rlz.remove_repeats(docs, window=12, seed_words=4, seed_rows=seed_rows, **SMALL)
    assert sorted_rows(words, "doc_id", "n_words", "n_removed", "kept_sha256") == in_order(brute.repeated_words(messy, 12))
    data = rindex.remove_repeated_bytes(docs, seed_rows=seed_rows, **SMALL)
    assert sorted_rows(data, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == in_order(brute.repeated_bytes(messy, 50))


def test_windows_of_words_inside_one_document(spark):
    rows = [(1, "a b " * 40), (2, " ".join(prose(1, 30) * 2)), (3, " ".join(prose(2, 50))), (4, "x " * 11), (5, "x y " * 6)]
    found = rlz.remove_repeats(frame(spark, rows), window=12, seed_words=4, **SMALL)
    assert sorted_rows(found, "doc_id", "n_words", "n_removed", "kept_sha256") == in_order(brute.repeated_words(rows, 12))


def test_factors_and_text(spark):
    shared, own = prose(1, 40), prose(2, 30)
    found = rlz.remove_repeats(frame(spark, [(1, " ".join(own + shared)), (2, "  ".join(shared))]), **SMALL)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert rows[1]["kept_text"] == " ".join(own) and [tuple(f) for f in rows[1]["factors"]] == [(30, 40)]
    assert rows[2]["kept_text"] == "" and rows[2]["n_removed"] == 40


def test_parse_against_a_block():
    draw = np.random.Generator(np.random.PCG64(11))
    texts = [draw.integers(0, 3, n).tolist() for n in (60, 1, 0, 45)] + [[7] * 30, [8, 9] * 12, [5]]
    texts.append(texts[0][10:50] + texts[3][:20])
    copies = [1, 1, 1, 1, 1, 1, 3, 1]
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = ends - [len(t) for t in texts]

    def longest(t, p):
        if copies[t] > 1:
            return len(texts[t]) - p
        most = 0
        for u, other in enumerate(texts):
            for q in range(len(other)):
                n = 0
                while (t, p) != (u, q) and p + n < len(texts[t]) and q + n < len(other) and texts[t][p + n] == other[q + n]:
                    n += 1
                most = max(most, n)
        return most

    symbols = [x for t, text in enumerate(texts) for x in [*(v + len(texts) for v in text), t]]
    found = rlz.longest_elsewhere(np.array(symbols))
    own = [longest(t, p) for t in range(len(texts)) if copies[t] == 1 for p in range(len(texts[t]))]
    assert own == [int(found[starts[t] + p]) for t in range(len(texts)) if copies[t] == 1 for p in range(len(texts[t]))]
    # The greedy factors of each text, by a plain walk.
    places, sizes = rlz.greedy_factors(found, starts, ends)
    factors = sorted(zip(places.tolist(), sizes.tolist(), strict=True))
    walked = []
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        while s < e:
            walked.append((s, int(found[s])))
            s += max(int(found[s]), 1)
    assert factors == walked and len(walked) > len(texts)
    for window in (1, 4, 9):
        block = pa.table({"part": range(len(texts)), "content": [np.array(t, np.uint64).tobytes() for t in texts], "lo": [0] * len(texts), "n": copies})
        runs = rlz.parsed_windows(window)(block)
        got = [{i for r in ranges if r["n"] > 1 for i in range(r["a"], r["b"])} for ranges in runs["ranges"].to_pylist()]
        assert got == [{p for p in range(len(text)) if longest(t, p) >= window} for t, text in enumerate(texts)]


def test_repeated_bytes(docs, messy, empty):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = rindex.remove_repeated_bytes(docs, **SMALL)
    assert sorted_rows(found, *columns) == in_order(brute.repeated_bytes(messy, 50))
    assert rindex.remove_repeated_bytes(empty, **SMALL).count() == 0
    with pytest.raises(ValueError):
        rindex.remove_repeated_bytes(docs, window=10)


def test_repeated_bytes_of_large_corpora(spark, monkeypatch):
    """What filters and tables hold follows the passages: few keys, room for them, and no contents of copies."""
    draw = np.random.Generator(np.random.PCG64(17))
    own = ["".join(draw.choice(list("abcdefgh"), 2000)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(own)] + [(100 + i, own[i][:1700] + "x" + own[i - 1][:250]) for i in range(20)]
    rows += [(200 + i, own[0]) for i in range(60)]
    tables, keys = {}, []

    def written(df, label, *more, f=repeats.materialize):
        tables[label] = f(df, label, *more)
        if "content" in df.columns:
            contents[label] = tables[label].selectExpr("count(*)", "sum(octet_length(content))").first()
        return tables[label]

    def counted(df, keys_of, *more, f=repeats.repeated_keys):
        dealt = df.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([len(k)])], ["n"]) for k in keys_of(batches)), "n bigint")
        keys.append(dealt.agg(F.sum("n")).first()[0])
        return f(df, keys_of, *more)

    contents = {}
    monkeypatch.setattr(repeats, "materialize", written)
    monkeypatch.setattr(repeats, "repeated_keys", counted)
    found = rindex.remove_repeated_bytes(frame(spark, rows), filter_bits=12)
    assert sorted_rows(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == in_order(brute.repeated_bytes(rows, 50))
    once = sum(len(t) for _, t in rows[:40])
    assert sum(keys[1:]) < once / 8
    # The 60 copies of one text are there once: every table with contents stays near the other texts' size.
    assert {label for label, (_, n) in contents.items() if n > 1.7 * once} <= {"parts", "texts"}
    assert contents["parts"][1] < 5 * once and contents["texts"][1] < 5 * once


def test_repeated_bytes_of_random_texts(spark):
    draw = np.random.Generator(np.random.PCG64(5))
    rows = [(int(i), "".join(draw.choice(list("ab"), 300))) for i in draw.permutation(12)]
    rows += [(20, rows[3][1][50:200] + rows[5][1][100:260]), (21, rows[3][1]), (21, rows[3][1])]
    found = rindex.remove_repeated_bytes(frame(spark, rows), window=16, seed_bytes=6, **SMALL)
    assert sorted_rows(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == in_order(brute.repeated_bytes(rows, 16))


def run_length_block(texts):
    """A block's texts as bytes with their ends, as symbols, and their sizes."""
    size = np.array([len(t) for t in texts])
    data = np.frombuffer(b"\0".join(texts) + bytes(9), np.uint8)
    symbols = data[: size.sum() + len(texts)].astype(np.int16) + 1
    symbols[np.cumsum(size + 1) - 1] = 0
    return data, symbols, size


def test_run_length_index():
    texts = [b"banana", b"bandana", b"anan", b"", b"banana", b"\0\0a", b"b" * 30, b"nab" + b"b" * 21]
    data, symbols, size = run_length_block(texts)
    order = rindex.suffix_order(symbols)
    ends = np.flatnonzero(symbols == 0)
    suffixes = [(*symbols[i : ends[np.searchsorted(ends, i)]], 0, int(np.searchsorted(ends, i))) for i in order]
    assert suffixes == sorted(suffixes)
    index = rindex.run_index(symbols, data)
    rank = np.argsort(order)
    same = [next(k for k, (x, y) in enumerate(zip(a, b)) if x != y or x == 0) for a, b in zip(suffixes, suffixes[1:])]
    for at in range(1, len(symbols)):
        if symbols[at - 1]:  # the row before the text's first symbol is never asked for
            before = [np.array([x]) for x in (rank[at], same[rank[at] - 1] if rank[at] else 0, order[rank[at] - 1])]
            row, length, source = (int(x[0]) for x in index.back(*before))
            assert row == rank[at - 1] and length == same[row - 1] and source == order[row - 1]
    assert len(index.head) < len(symbols)


@pytest.mark.parametrize("window", [1, 3, 8])
def test_matching_statistics(window):
    """Of every window the match with the suffix in the row before, and the least document of its string."""
    draw = np.random.Generator(np.random.PCG64(31))
    for _ in range(60):
        texts = [draw.integers(0, 2, draw.integers(0, 40), dtype=np.uint8).tobytes() for _ in range(draw.integers(1, 9))]
        texts += [texts[0][3:20], b"\1" * 25]
        data, symbols, size = run_length_block(texts)
        order = rindex.suffix_order(symbols)
        rank, starts = np.argsort(order), np.cumsum(size + 1) - size - 1
        places = [(t, p) for t, text in enumerate(texts) for p in range(len(text) - window + 1)]
        lengths, sources = rindex.matches(rindex.run_index(symbols, data), size, window)
        for (t, p), length, source in zip(places, lengths.tolist(), sources.tolist(), strict=True):
            row = rank[starts[t] + p]
            other = int(np.searchsorted(starts, order[row - 1], "right") - 1)
            rest = texts[other][order[row - 1] - starts[other] :]
            common = next((k for k, (x, y) in enumerate(zip(texts[t][p:], rest)) if x != y), min(len(rest), len(texts[t]) - p))
            assert (length, source) == (common, order[row - 1])
        lo = draw.integers(0, 50, len(texts))
        block = pa.table({"part": range(len(texts)), "content": texts, "lo": lo, "n": [1] * len(texts)})
        got = [[r["lo"] for r in ranges for _ in range(r["a"], r["b"])] for ranges in rindex.least_documents(window)(block)["ranges"].to_pylist()]
        least: dict[bytes, int] = {}
        for t, p in places:
            string = texts[t][p : p + window]
            least[string] = min(least.get(string, 99), int(lo[t]))
        assert got == [[least[text[p : p + window]] for p in range(len(text) - window + 1)] for text in texts]


def test_index_size_follows_the_runs():
    """Copies of a text, each with one byte changed, add runs for the changes and not for the text."""
    draw = np.random.Generator(np.random.PCG64(7))
    base = draw.integers(97, 101, 2000, dtype=np.uint8)
    held, nbytes = [], []
    for copies in (10, 200):
        texts = []
        for _ in range(copies):
            text = base.copy()
            text[draw.integers(2000)] = 122
            texts.append(text.tobytes())
        data, symbols, _ = run_length_block(texts)
        index = rindex.run_index(symbols, data)
        held.append(len(index.head))
        nbytes.append(sum(x.nbytes for x in index) / len(symbols))
    assert held[0] < 2000 + 10 * 50 and held[1] < 2000 + 200 * 50
    assert nbytes[1] < nbytes[0] / 5 and nbytes[1] < 2


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(docs, messy, empty, k):
    found = neardup.near_duplicates(docs, shingle_words=k, bands=60, rows=5, **SMALL)
    assert sorted_rows(found, "doc_id", "n_shingles", "component_id", "kept") == in_order(brute.near_duplicates(messy, k))
    assert neardup.near_duplicates(empty, **SMALL).count() == 0


def test_chains_of_near_duplicates(spark):
    """Neighbours are linked, ends of the chain are not; a group's hub need not be near all others."""
    base = prose(1, 100, 5000)
    rows = [(50 - i, " ".join([f"c{j}" if j < 4 * i else w for j, w in enumerate(base)])) for i in range(12)]
    rows += [(100 + i, " ".join([*base[:i], f"v{i}", *base[i + 1 :]])) for i in range(0, 100, 3)] + [(100, rows[3][1])]
    # Several blocks for a family, one for all, and buckets larger than a block.
    for bounds in ({"block_bytes": 4096}, {}, {"block_rows": 2}):
        found = neardup.near_duplicates(frame(spark, rows), shingle_words=2, bands=60, rows=5, **bounds, **SMALL)
        assert sorted_rows(found, "doc_id", "n_shingles", "component_id", "kept") == in_order(brute.near_duplicates(rows, 2))


@pytest.mark.parametrize("block_rows", [1, 3, 40, 4096])
def test_blocks_of_open_buckets(spark, block_rows):
    """A long chain of small buckets, a bucket of every second class and a small family, in blocks of any size."""
    draw = np.random.Generator(np.random.PCG64(3))
    classes = []
    for c in range(120):
        near = draw.integers(0, 1000, 20) + 5000 * (c % 7)
        buckets = {c // 3, (c + 1) // 3, 1000 + c % 2} if c < 110 else {2000}
        classes.append((c, c // 2 if c % 3 else c, sorted(set(near.tolist()) | set(range(70))), sorted(buckets), 0 if c < 110 else 110))
    rows = [(c, comp, len(held), buckets, family, bytearray(np.array(held, np.uint64).tobytes())) for c, comp, held, buckets, family in classes]
    rest = spark.createDataFrame(rows, "class bigint, component bigint, n bigint, buckets array<bigint>, family bigint, shingles binary")
    found = [tuple(sorted((r["a"], r["b"]))) for r in neardup._compared_in_blocks(rest, 63, 8 << 20, block_rows).collect()]
    wanted = {
        (a[0], b[0])
        for i, a in enumerate(classes)
        for b in classes[i + 1 :]
        if a[4] == b[4] and a[1] != b[1] and set(a[3]) & set(b[3]) and 100 * len(set(a[2]) & set(b[2])) >= 63 * len(set(a[2]) | set(b[2]))
    }
    assert sorted(found) == sorted(wanted)  # each pair once
    assert 100 < len(wanted) < 5000


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    links = spark.createDataFrame(chain, "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components(links, new_folder(spark, "test")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert components(links.where("false"), new_folder(spark, "test")).count() == 0


def test_benchmark_hits(spark, docs, messy, empty):
    w = brute.words(messy[0][1])
    items = [(1, " ".join(w[5:40])), (2, " ".join(w[5:40])), (10, "Two, WORDS!"), (3, "word"), (4, None), (5, ""), (6, "--"), (None, " ".join(w[60:64])), (7, "absent words only here"), (8, " ".join(w[100:105] + ["zzz"]))]
    table = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, doc_id int")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    found = decontaminate.benchmark_hits(docs, table, filter_bits=16)
    assert sorted_rows(found, *columns) == in_order(brute.benchmark_hits(messy, items))
    assert decontaminate.benchmark_hits(empty, table, filter_bits=16).count() == 0
    clean = decontaminate.benchmark_hits(docs, table.where("false"), filter_bits=16)
    assert clean.where("contaminated or n_items > 0").count() == 0 and clean.count() == len(messy)


def test_quality(docs, messy, empty):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    report = cascade.quality_report(docs)
    assert sorted_rows(report, *columns) == in_order(brute.quality(messy))
    kept = cascade.quality_cascade(docs)
    assert kept.columns == [c for c in docs.columns if c != "kept"] + ["kept"] or kept.columns == docs.columns
    assert sorted_rows(kept, "doc_id", "kept") == in_order([(r[0], r[-1]) for r in brute.quality(messy)])
    assert cascade.quality_report(empty).count() == 0 and cascade.quality_cascade(empty).count() == 0
    plan = kept.where("kept")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("x09-") <= 2  # texts are split once


def test_rules_are_ordered_by_rejections_per_cost(docs):
    cheap, dear = cascade.Rule("cheap", F.col("doc_id") > 3), cascade.Rule("never", F.lit(False))
    found = cascade.estimate(docs.select("doc_id", F.col("doc_id").cast("string").alias("text")), [dear], "text")
    assert found[0].rejected == 0 and found[0].seconds > 0 and cheap.name == "cheap"
    order = sorted([cascade.Estimate(dear, 0.1, 0.0), cascade.Estimate(cheap, 0.1, 0.5), cascade.Estimate(cheap, 1.0, 0.6)], key=lambda e: -e.worth)
    assert [e.rejected for e in order] == [0.5, 0.6, 0.0]


def test_lines(docs, messy, empty):
    rows = [r for r in messy if r[0] is not None]
    found = lines.deduplicate_lines(docs.where("doc_id is not null"), min_words=5, **SMALL)
    assert sorted_rows(found, "doc_id", "n_lines", "n_removed", "kept_sha256") == in_order(brute.lines(rows, 5))
    assert lines.deduplicate_lines(docs, **SMALL).count() == len(messy)
    assert lines.deduplicate_lines(empty, **SMALL).count() == 0


def test_lines_within_one_edit(spark):
    base = prose(1, 12)
    edits = [[*base[:i], "x", *base[i + 1 :]] for i in range(12)] + [[*base[:i], "y", *base[i:]] for i in range(13)] + [base[:i] + base[i + 1 :] for i in range(12)]
    far = [[*base[:3], "p", *base[4:8], "q", *base[9:]], ["a"] * 12, ["a"] * 11, ["a"] * 13, ["a"] * 15]
    rows = [(i, "\n".join([" ".join(e), f"line {i}"])) for i, e in enumerate([base, *far, *edits])]
    found = lines.deduplicate_lines(frame(spark, rows), min_words=5, **SMALL)
    assert sorted_rows(found, "doc_id", "n_lines", "n_removed", "kept_sha256") == in_order(brute.lines(rows, 5))


def test_language(spark, empty):
    kinds = {"aa": "abcde", "bb": "xyzwv", "cc": "éèçàù"}
    draw = np.random.Generator(np.random.PCG64(3))
    rows = []
    for i in range(240):
        name = list(kinds)[i % 3]
        text = " ".join("".join(draw.choice(list(kinds[name]), 4)) for _ in range(int(draw.integers(3, 40))))
        rows.append((i, text, name if i % 10 else None))
    rows += [(300, None, "aa"), (301, "", "bb"), (302, "12 !?", "aa"), (None, "abcd edcb", "aa"), (303, "abcd " * 20_000, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, letters string")
    found = {r["doc_id"]: r for r in langid.identify_languages(docs, landmarks=30).collect()}
    for doc_id, text, _ in rows:
        got = found[doc_id]
        right = next((k for k, v in kinds.items() if set((text or "").replace(" ", "")) & set(v)), "und")
        assert got["lang_pred"] == right and 0 <= got["score"] <= 1
        assert got["held_out"] == (doc_id is not None and __import__("zlib").crc32(str(doc_id).encode()) % 4 == 2)
    assert {r["lang_pred"] for r in langid.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify_languages(docs.where("false")).count() == 0


def test_language_scores_are_those_of_kernel_regression(spark):
    rows = []
    for i in range(80):
        lang = i // 20
        own = prose(100 + lang, 60)
        rows.append((i, " ".join(own[j] for j in np.random.Generator(np.random.PCG64(i)).integers(0, 60, 12)) + " Ö9", f"l{lang}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    got = {r["doc_id"]: r for r in langid.identify_languages(docs, held_out=F.col("doc_id") % 4 == 3, landmarks=500).collect()}
    wanted = brute.languages([(t, lang) for i, t, lang in rows if i % 4 != 3], [t for _, t, _ in rows])
    for (i, _, _), (lang, score) in zip(rows, wanted, strict=True):
        assert got[i]["lang_pred"] == lang and abs(got[i]["score"] - score) < 1e-5


def test_held_out_language_is_not_learned(spark):
    """A text whose only labels are held out does not move the model."""
    rows = [(i, "abc abd " * 5 if i % 2 else "xyz xyw " * 5, "a" if i % 2 else "x") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    hidden = F.col("doc_id") % 4 == 1
    wrong = docs.withColumn("lang", F.when(hidden, "wrong").otherwise(F.col("lang")))
    one, two = (langid.identify_languages(d, held_out=hidden) for d in (docs, wrong))
    assert sorted_rows(one, "doc_id", "lang_pred", "score") == sorted_rows(two, "doc_id", "lang_pred", "score")


def test_every_language_is_learned(spark):
    draw, rows = np.random.Generator(np.random.PCG64(11)), []
    for lang in range(520):
        own = ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(6)]
        rows += [(4 * lang + i, " ".join(draw.choice(own, 12)), f"l{lang}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r for r in langid.identify_languages(docs, held_out=F.col("doc_id") % 4 == 3).collect()}
    held = [(got[i]["lang_pred"], lang) for i, _, lang in rows if got[i]["held_out"]]
    assert len(held) == 520 and sum(a == b for a, b in held) >= 515


def mix_rows():
    rows = [(i, " ".join(prose(i, 1 + 7 * i % 97)), f"s{i % 4}") for i in range(120)]
    return rows + [(500, None, "s0"), (501, "", None), (502, "a b c", None), (502, "a b c", None), (None, "d e", "s1"), (503, "x " * 3000, "s3"), (504, "y", "lone"), (505, None, "none")]


def test_mixture(spark):
    rows = mix_rows()
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id bigint, text string, source string, taken int").repartition(3)
    found, pieces = mixture.mixed(docs, block_words=16, shard_slots=32)
    got = found.collect()
    assert sorted((r["id"] or -1, r["size"]) for r in got) == sorted((r[0] or -1, len(brute.words(r[1]))) for r in rows)
    sizes = {k: sum(len(brute.words(t)) for t in v) for k, v in brute.groups((r[2], r[1]) for r in rows).items()}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, mixture.targets([sizes[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))]), strict=True))
    by_id = {r[0]: r[2] for r in rows}
    for name in names:
        own = [r for r in got if by_id[r["id"]] == name]
        assert {(r["source_size"], r["target"]) for r in own} == {(sizes[name], goal[name])}
        assert abs(sum(r["taken"] for r in own) - goal[name]) <= 1
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    # A word is taken again only when all words of its source have been.
    for r in got:
        assert r["taken"] >= r["size"] * int(r["target"] // max(r["source_size"], 1))
    again, _ = mixture.mixed(docs.repartition(7), block_words=16, shard_slots=32)
    assert sorted_rows(found, "id", "size", "taken") == sorted_rows(again, "id", "size", "taken")
    places = pieces.select("uid", "shard", "place", "pass", "from").collect()
    assert len(set(places)) == len(places)
    none, _ = mixture.mixed(docs.where("false"))
    assert none.count() == 0


def test_mixture_as_documents(spark):
    docs = spark.createDataFrame([(*r, 1) for r in mix_rows()], "doc_id bigint, text string, source string, n_chars bigint")
    out = mixture.mixed_documents(docs, block_words=16)
    assert out.columns == docs.columns
    total = sum(len(brute.words(r["text"])) for r in out.collect())
    assert abs(total - sum(len(brute.words(r[1])) for r in mix_rows())) <= 6
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_targets():
    assert mixture.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    assert mixture.targets([10, 1000, 1000], [5, 2, 1]) == [30.0, pytest.approx(1320.0), pytest.approx(660.0)]
    assert mixture.targets([0, 0], [5, 2]) == [0.0, 0.0] and mixture.targets([], []) == []


def test_permutations():
    for size in (1, 2, 3, 17, 1000):
        index = np.arange(size)
        one, two = (mixture.permuted(index, np.full(size, size), np.full(size, s)) for s in (1, 2))
        assert sorted(one) == list(index) and sorted(two) == list(index)
        assert size < 17 or (one != two).any()


def test_permutations_back():
    for size in (1, 2, 3, 17, 1000):
        index, sizes, seeds = np.arange(size), np.full(size, size), np.full(size, 5)
        assert list(mixture.permuted(mixture.permuted(index, sizes, seeds), sizes, seeds, back=True)) == list(index)


def test_shards_drawn_in_ranges(spark):
    rows = [r for r in mix_rows() if r[0] not in (502, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found, pieces = mixture.mixed(docs, block_words=4, shard_slots=8, range_shards=2)
    named = pieces.join(found.select("uid", F.col("id").alias("doc_id")), "uid").join(docs, "doc_id")
    slots = named.select("source", "shard", "place").distinct().collect()
    in_shard = brute.groups((r["shard"], r) for r in slots)
    assert len(in_shard) > 4 and sorted(in_shard) == list(range(len(in_shard)))
    assert {len(in_shard[s]) for s in range(len(in_shard) - 1)} == {8} and 1 <= len(in_shard[len(in_shard) - 1]) <= 8
    for own in brute.groups((r["source"], (r["place"], r["shard"])) for r in slots).values():
        own.sort()
        assert [p for p, _ in own] == list(range(len(own))) and [s for _, s in own] == sorted(s for _, s in own)


def test_mixture_of_many_sources(spark, monkeypatch):
    n = 100_002
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.concat(F.lit("https://host"), "id").alias("source"))
    on_driver, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: on_driver.append(collect(self)) or on_driver[-1])
    found, pieces = mixture.mixed(docs)
    monkeypatch.undo()
    assert max(map(len, on_driver), default=0) <= 3
    got = found.agg(F.count("*"), F.sum("taken"), F.max("taken"), F.max(F.abs(F.col("taken") - F.col("target")))).first()
    assert got[0] == n and abs(got[1] - 2 * n) <= n and got[2] <= 6 and got[3] <= 1
    assert pieces.count() == found.where("taken > 0").agg(F.sum(F.expr("(taken + 1) div 2"))).first()[0]


def test_hilbert_curve():
    for axes, bits in ((2, 4), (3, 3)):
        points = np.stack([g.ravel() for g in np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij")])
        index = hilbert.hilbert_index(list(points), bits)
        assert sorted(index) == list(range(1 << bits * axes))
        path = points[:, np.argsort(index)]
        assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()  # neighbours on the curve are neighbours in space


def test_shards(spark, messy, empty):
    rows = [(i, t, None if i is not None and i % 5 == 0 else f"s{(i or 0) % 3}") for i, t in messy * 3]
    docs = spark.createDataFrame([(*r, "en", "old") for r in rows], "doc_id bigint, text string, source string, lang string, shard string")
    found = hilbert.shard_documents(docs, 7).collect()
    assert len(found) == len(rows)
    slots = brute.groups((r["shard"], r["slot"]) for r in found)
    assert sorted(slots) == list(range(7)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for r in found:
        data = (r["text"] or "").encode()
        assert r["size"] == len(data) + 8 and r["text_crc32"] == __import__("zlib").crc32(data)
    few = hilbert.shard_documents(docs.limit(3), 7).collect()
    assert sorted(r["slot"] for r in few) == [0, 0, 0]
    assert hilbert.shard_documents(docs.where("false"), 7).count() == 0


def test_shards_along_a_plain_walk(spark):
    for dims, bits in ((2, 3), (3, 2)):
        walk = brute.hilbert_walk(dims, bits)
        cells = sorted(walk)
        assert [walk[c] for c in cells] == hilbert.hilbert_index(list(np.array(cells).T), bits).tolist()
    draw = np.random.Generator(np.random.PCG64(3))
    rows = [(i, "é" * int(draw.integers(0, 90)) if i % 9 else None, f"s{draw.integers(0, 40)}" if i % 7 else None, f"l{draw.integers(0, 5)}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").repartition(5)
    assert sorted_rows(hilbert.shard_documents(docs, 7), "doc_id", "shard", "slot") == sorted(brute.shards(rows, 7))


def test_very_long_texts(spark):
    rows = [(1, " ".join(prose(1, 150_000, 100_000))), (2, "a b"), (3, None), (4, "\n".join([" ".join(prose(2, 30)), ""] * 2000))]
    docs = spark.createDataFrame([(*r, "s", "en") for r in rows], "doc_id bigint, text string, source string, lang string")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted_rows(cascade.quality_report(docs), *columns) == brute.quality(rows)
    assert sorted_rows(hilbert.shard_documents(docs, 3), "doc_id", "shard", "slot") == sorted(brute.shards([(*r, "s", "en") for r in rows], 3))


@pytest.mark.parametrize("total", [90_000_000, 100_000_000, 3_000_000_000])
def test_slots_of_large_tables(spark, total):
    for rank in (0, total // 2, total - 1):
        got = hilbert.equal_runs(spark.createDataFrame([(rank,)], "__rank bigint"), total, 24).first()
        shard = rank * 24 // total
        assert (got["shard"], got["slot"]) == (shard, rank - (shard * total + 23) // 24)


def test_shards_prune(spark):
    rows = [(i, f"s{i % 8}", (i * 37) % 1000) for i in range(4096)]
    table = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    axes = {"source": hilbert.text_code(F.col("source")), "size": F.col("size")}
    placed = hilbert.hilbert_shards(table, axes, 16, [F.col("doc_id")])
    spread = placed.groupBy("shard").agg(F.countDistinct("source").alias("s"), (F.max("size") - F.min("size")).alias("w")).collect()
    assert max(r["s"] for r in spread) <= 4 and max(r["w"] for r in spread) <= 600


def test_shards_prune_texts_with_a_common_start(spark):
    rows = [(i, "x" * ((i * 37) % 1000), f"https://www.example.org/{i % 8}" if i % 9 else None, "en") for i in range(4096)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    found = hilbert.shard_documents(docs, 16)
    assert found.columns == [*docs.columns, "size", "text_crc32", "shard", "slot"] and found.count() == len(rows)
    spread = found.groupBy("shard").agg(F.countDistinct("source").alias("s"), (F.max("size") - F.min("size")).alias("w")).collect()
    assert max(r["s"] for r in spread) <= 5 and max(r["w"] for r in spread) <= 800


def test_archives(spark):
    big, other = "<p>é" * 400, "<q>\r\n\r\nWARC/1.1\r\n" * 100
    rows = [(1, "http://b.example.org/x?q=1", big), (9, "http://a.example.org/", big), (3, None, big), (4, "http://a.example.org/", "small"), (5, "not a url\r\nX: y", "small"), (6, "http://[bad", None), (7, "", ""), (None, "http://n.example.org", big), (8, "http://b.example.org/x?q=1", other), (8, "http://b.example.org/x?q=1", other)]
    pages = spark.createDataFrame([(*r, "k", 0) for r in rows], "page_id bigint, url string, html string, key string, size int")
    found = warc.archive_round_trip(pages, with_payload=True, archive_bytes=600).collect()
    assert len(found) == len(rows)
    got = {r["page_id"]: r for r in found}
    for page_id, _, html in rows:
        data = (html or "").encode()
        row = got[page_id]
        assert (row["payload_bytes"], row["payload_digest"]) == (len(data), __import__("hashlib").sha1(data).hexdigest())
        revisit = html == big and page_id != 9
        assert (row["record_type"], row["refers_to"]) == (("revisit", 9) if revisit else ("response", None))
        assert revisit or bytes(row["payload"]) == data
    assert warc.archive_round_trip(pages.where("false")).count() == 0


def test_index_finds_what_is_there(spark):
    folder = new_folder(spark, "warc")
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.example.org/p{i % 50}", f"<p>{i}") for i in range(400)], "page_id bigint, url string, html string")
    captures = warc.write_archives(pages, folder)
    ranges = warc.write_index(captures, folder, block_lines=16)
    asked = spark.createDataFrame([("org,example,h1)/p7", 7), ("org,example,h1)/p7", 8), ("zz", 1), ("", None)], "key string, page_id bigint")
    assert [r["page_id"] for r in warc.read_captures(asked, folder, ranges).collect()] == [7]
    assert warc.read_captures(captures, folder, ranges).count() == 400


def test_url_keys():
    assert warc.url_key("http://www.Example.org:8080/A?B=c#d") == "org,example:8080)/a?b=c"
    assert warc.url_key(None) == "" and warc.url_key("http://example.org") == "org,example)/"


def test_words_and_shingles():
    import pyarrow as pa

    keyer = textkeys.Keyer()
    texts = ["a b  c", None, "", " x\ty\x0bz\r\n", "a b c", "é è", "A B c"]
    part = next(textkeys.slices(pa.array(texts)))
    found = keyer.words(part)
    assert np.diff(found.bounds).tolist() == [3, 0, 0, 3, 3, 2, 3]
    assert (found.key[:3] == found.key[6:9]).all() and not (found.key[:2] == found.key[11:13]).any()
    assert (keyer.words(part, lower=True).key[:3] == keyer.words(part, lower=True).key[11:14]).all()
    sets, bounds = textkeys.shingle_sets(keyer, part, 2)
    assert np.diff(bounds).tolist() == [2, 0, 0, 2, 2, 1, 2]
    assert textkeys.window_min(np.array([5, 3, 4, 1, 2], np.uint64), 3).tolist() == [3, 1, 1]


def test_key_filter(spark):
    """All repeated keys pass, few others do, and a key that comes twice in one task counts as one that comes in two."""
    from pavilion.llm import keyfilter

    keys = textkeys.mix(np.arange(40_000, dtype=np.uint64))
    rows = np.concatenate([keys, keys[:2000], keys[:500], keys[:500]])
    df = spark.createDataFrame([(int(k),) for k in rows.view(np.int64)], "k bigint").repartition(4)

    def keys_of(batches):
        for batch in batches:
            yield batch.column(0).to_numpy().view(np.uint64)

    found = keyfilter.repeated_keys(df, keys_of, 18).value
    passed = keyfilter.may_repeat(found, keys)
    assert passed[:2000].all() and passed[2000:].mean() < 0.01
    assert not keyfilter.may_repeat(found, textkeys.mix(np.arange(50_000, 51_000, dtype=np.uint64))).mean() > 0.02


def test_key_filter_grows(spark):
    """A filter that its keys would fill grows where it may, loses no key, and keeps others out."""
    keys = textkeys.mix(np.arange(40_000, dtype=np.uint64))
    df = spark.createDataFrame([(int(k),) for k in keys[:30_000].view(np.int64)], "k bigint")
    keys_of = lambda batches: (k for b in batches for k in [b.column(0).to_numpy().view(np.uint64)] * 2)
    passed = [keyfilter.may_repeat(keyfilter.repeated_keys(df, keys_of, 15, more).value, keys) for more in (0, 1, 3)]
    assert all(p[:30_000].all() for p in passed)
    full, half, open_ = (p[30_000:].mean() for p in passed)
    assert full > 0.7 > half > 0.4 and open_ < 0.1
    # Slices that have grown and slices that have not make one filter.
    mixed = np.packbits([1, 0, 0, 1, 0, 1, 0, 0], bitorder="little")
    assert np.unpackbits(keyfilter._widened(mixed, 2), bitorder="little").tolist() == [1, 1, 0, 0, 0, 0, 1, 1, 0, 0, 1, 1, 0, 0, 0, 0]
    few = spark.createDataFrame([(int(k),) for k in keys[keys >> np.uint64(63) == 0].view(np.int64)], "k bigint")
    passed = keyfilter.may_repeat(keyfilter.repeated_keys(few, keys_of, 15, 3).value, keys)
    assert passed[keys >> np.uint64(63) == 0].all() and not passed[keys >> np.uint64(63) == 1].any()
