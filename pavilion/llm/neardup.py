"""Near-duplicate documents by min-max hashing.

Each permutation of the shingles keeps its least and its greatest value, so one pass of
hashing gives two signature entries. Bands of entries of different permutations are the
buckets in which documents meet; every pair that may matter is then checked on the
documents' full shingle sets.

Documents with equal sets are one class from the start, so copies cost one row each. In a
bucket all classes are first checked against one of its classes, which joins most of a group of near
copies with one check per member. Buckets that stay larger than a block are checked against further classes
of theirs, round after round, as long as that empties them. Pairs that lie in one bucket but not yet in one component
are checked after that, so no link between components is left out. They are never listed as rows:
classes that are connected through such buckets are a family, and families are dealt to blocks of bounded size, where tasks
compare them and report links only. A family of more blocks than its classes have buckets is dealt by bucket, so a row is
copied at most once a bucket, however large the family, and a pair is compared where its least common bucket goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pavilion.llm import textkeys as tk
from pavilion.llm.graph import components
from pavilion.llm.keyfilter import may_repeat, repeated_keys
from pavilion.session import discard, materialize, new_folder

_U = np.uint64


def _class_key(sets: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One key for each set; equal sets have equal keys."""
    first = np.add.reduceat(tk.mix(sets), starts)
    second = np.add.reduceat(tk.mix(sets ^ _U(0x5851F42D4C957F2D)), starts)
    return tk.mix(first ^ tk.mix(second + counts.astype(np.uint64)))


def _signer(k: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyer = tk.Keyer()
        draw = np.random.Generator(np.random.PCG64(20011))
        n_hash = (bands + 1) // 2 * rows
        factor = draw.integers(0, 1 << 63, n_hash, dtype=np.uint64) * _U(2) + _U(1)
        shift = draw.integers(0, 1 << 63, n_hash, dtype=np.uint64)
        for batch in batches:
            for part in tk.slices(batch.column(1)):
                sets, bounds = tk.shingle_sets(keyer, part, k)
                counts = np.diff(bounds)
                some = np.flatnonzero(counts)
                starts = bounds[some]
                keys = np.zeros((len(some), bands), np.uint64)
                name = np.zeros(part.n, np.uint64)
                if len(some):
                    name[some] = _class_key(sets, starts, counts[some])
                    x = tk.mix(sets)
                    for i in range(n_hash):
                        y = x * factor[i] + shift[i]
                        band = i // rows * 2
                        keys[:, band] = tk.mix(keys[:, band] ^ np.minimum.reduceat(y, starts)) + _U(band)
                        if band + 1 < bands:
                            keys[:, band + 1] = tk.mix(keys[:, band + 1] ^ np.maximum.reduceat(y, starts)) + _U(band + 1)
                lists = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.n),
                        batch.column(2).slice(part.first, part.n),
                        pa.array(counts, pa.int64()),
                        pa.array(name.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(lists), pa.array(keys.reshape(-1).view(np.int64))),
                    ],
                    ["id", "row", "n", "class", "bands"],
                )

    return sign


def _bucket_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        yield batch.column(0).flatten().to_numpy().view(np.uint64)


def _bucket_rows(shared):
    """Buckets that more than one document may be in, one row for each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            keys = lists.flatten().to_numpy()
            at = np.flatnonzero(may_repeat(shared.value, keys.view(np.uint64)))
            of = pa.array(np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[at])
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(of) for i in range(3)), pa.array(keys[at])], ["class", "id", "n", "bucket"])

    return rows


def _set_reader(k: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyer = tk.Keyer()
        for batch in batches:
            for part in tk.slices(batch.column(0)):
                sets, bounds = tk.shingle_sets(keyer, part, k)
                some = np.flatnonzero(np.diff(bounds))
                if not len(some):
                    continue
                name = _class_key(sets, bounds[some], np.diff(bounds)[some])
                content = [sets[bounds[i] : bounds[i + 1]].tobytes() for i in some]
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(content, pa.binary())], ["class", "shingles"])

    return read


def _linker(percent: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                common = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return link


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb")), "b"
    )
    return both.select("a", "b", "sa", "sb").mapInArrow(_linker(percent), "a bigint, b bigint")


def _block_linker(percent: int):
    def link(block: pa.Table) -> pa.Table:
        first, second = block.column("i")[0].as_py(), block.column("j")[0].as_py()
        # The buckets whose pairs this block compares, all where rows were not dealt by bucket; a row may come for several.
        home = block.column("home").drop_null().to_numpy()
        block = block.take(np.unique(block.column("class").to_numpy(), return_index=True)[1])
        chunk = block.column("chunk").to_numpy()
        component, size = block.column("component").to_numpy(), block.column("n").to_numpy()
        lists = block.column("buckets").combine_chunks()
        bucket = lists.flatten().to_numpy()
        member = np.repeat(np.arange(len(size)), np.diff(lists.offsets.to_numpy()))
        order = np.argsort(bucket, kind="stable")
        bucket, member = bucket[order], member[order]
        heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        own = np.isin(bucket[heads], home) | (len(home) == 0)
        # Buckets in ascending order, so that the first one that a pair shares is its least.
        met = np.zeros((len(size), len(size)), bool)
        seen = met if own.all() else np.zeros_like(met)
        for a, b, here in zip(heads, np.append(heads[1:], len(bucket)), own, strict=True):
            if b - a > 1:
                pairs = np.ix_(member[a:b], member[a:b])
                if here:
                    met[pairs] |= ~seen[pairs]
                seen[pairs] = True
        contents = [np.frombuffer(x.as_buffer(), np.uint64) for x in block.column("shingles").combine_chunks()]
        found: list[tuple[int, int]] = []
        name = block.column("class").to_numpy()
        for a in range(len(size) - 1):
            others = np.flatnonzero(met[a, a + 1 :]) + a + 1
            near = 100 * np.minimum(size[others], size[a]) >= percent * np.maximum(size[others], size[a])
            # A pair of one chunk is compared in that chunk's own block.
            near &= (component[others] != component[a]) & ((first == second) | (chunk[others] != chunk[a]))
            others = others[near]
            if not len(others):
                continue
            at = np.concatenate([contents[b] for b in others])
            held = contents[a][np.minimum(np.searchsorted(contents[a], at), size[a] - 1)] == at
            common = np.add.reduceat(held, np.concatenate([[0], np.cumsum(size[others])[:-1]]), dtype=np.int64)
            found += [(name[a], name[b]) for b in others[100 * common >= percent * (size[others] + size[a] - common)]]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return link


def _compared_in_blocks(rest: DataFrame, percent: int, block_bytes: int, block_rows: int) -> DataFrame:
    """Links (a, b) between classes of one family and bucket but of different components.

    Small families share a block. A larger one is cut into chunks by class, and every two chunks make a block; where a
    class would go to more blocks so than it has buckets, each bucket is dealt to blocks in the same way instead.
    """
    # A row's share of a block, by bytes or by rows, whichever is larger.
    share = F.greatest((F.octet_length("shingles") + 8 * F.size("buckets")) / block_bytes, F.lit(1 / block_rows))
    rest = rest.withColumn("share", share)
    families = rest.groupBy("family").agg((F.ceil(F.sum("share")) > F.avg(F.size("buckets"))).alias("split"))
    whole = F.array(F.lit(None).cast("bigint"))
    rest = rest.join(families, "family").withColumn("home", F.explode(F.when(F.col("split"), F.col("buckets")).otherwise(whole)))
    rest = rest.withColumn("unit", F.coalesce("home", "family"))
    sizes = rest.groupBy("split", "unit").agg(F.ceil(F.sum("share")).cast("int").alias("chunks"), F.sum("share").alias("share"))
    bins = int(sizes.where("chunks = 1").agg(F.sum("share")).first()[0] or 0) + 1
    place = F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("unit"), F.lit(bins))).otherwise(F.col("unit"))
    dealt = rest.join(sizes.select("split", "unit", "chunks"), ["split", "unit"]).withColumns(
        {"chunk": F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"), "place": place}
    )
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select(
        "class", "component", "n", "buckets", "shingles", "home", "chunk", "split", "place", (F.col("chunks") > 1).alias("large"),
        F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
    )
    return dealt.groupBy("split", "large", "place", "i", "j").applyInArrow(_block_linker(percent), "a bigint, b bigint")


def _hub_links(members: DataFrame, sets: DataFrame, percent: int, turn: int) -> DataFrame:
    """Links (a, b) of one class of each bucket, another one every turn, to all classes of other components in it."""
    hub = F.min(F.struct(F.xxhash64("class", F.lit(turn)), "class", "n", "component"))
    stars = members.join(members.groupBy("bucket").agg(hub.alias("hub")), "bucket").where("component <> hub.component").select(
        F.col("hub.class").alias("a"), F.col("hub.n").alias("na"), F.col("class").alias("b"), F.col("n").alias("nb")
    )
    # Sizes alone may rule a pair out.
    stars = stars.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    return _confirmed(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), sets, percent)


def _labels(links: DataFrame, folder: str) -> DataFrame:
    return components(links, folder).select(F.col("node").alias("class"), "component")


def _still_open(members: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """Rows of buckets that hold several components, with their components, the bucket's least class and its rows."""
    named = members.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    named = materialize(named, "named", folder)
    buckets = named.groupBy("bucket").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("class").alias("a"), F.count(F.lit(1)).alias("rows")
    )
    return materialize(named.join(buckets.where("lo < hi").select("bucket", "a", "rows"), "bucket"), "open", folder)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    bands: int = 100,
    rows: int = 8,
    filter_bits: int = 27,
    block_bytes: int = 8 << 20,
    block_rows: int = 4096,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, and row, a key of (id, text).

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document's set has its distinct
    runs of ``shingle_words`` words, or its whole sequence where it has fewer. Documents are
    linked when ``100 * intersection >= percent * union``; ``component_id`` is the least id
    reachable and ``kept`` marks the document that bears it. With 100 bands of 8 entries a
    pair at 80 percent meets in no band with a probability of 1e-8, a closer pair less.
    ``block_bytes`` and ``block_rows`` bound the blocks that are compared at once; they move work, not results.

    A null or wordless text has an empty set and is linked with nothing. A row without an id
    is linked with nothing, has no component and is kept. Rows that repeat an id and a text
    are all marked alike; rows of one id with different texts are separate documents. Other
    columns are not read.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "neardup")
    docs = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    keyed = docs.select("*", F.xxhash64("__id", "__text"))
    signed = materialize(keyed.mapInArrow(_signer(shingle_words, bands, rows), "id bigint, row bigint, n bigint, class bigint, bands array<bigint>"), "signed", folder)
    known = signed.where("n > 0 and id is not null")
    classes = materialize(known.groupBy("class").agg(F.min("id").alias("rep"), F.min("n").alias("n")), "classes", folder)
    shared = repeated_keys(signed.select("bands"), _bucket_keys, filter_bits)
    members = known.select("class", "id", "n", "bands").mapInArrow(_bucket_rows(shared), "class bigint, id bigint, n bigint, bucket bigint")
    members = members.join(classes.select("class", F.col("rep").alias("id")), ["class", "id"], "left_semi").drop("id").distinct()
    members = materialize(members, "members", folder)
    # The full sets of all classes that share a bucket, read from the texts once.
    crowded = members.groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi").select("bucket")
    members = materialize(members.join(crowded, "bucket"), "crowded", folder)
    wanted = members.select("class").distinct().join(classes, "class").select("class", F.col("rep").alias("__id"))
    wanted = materialize(wanted, "wanted", folder)
    texts = docs.join(wanted.select("__id").distinct(), "__id", "left_semi").select("__text")
    sets = texts.mapInArrow(_set_reader(shingle_words), "class bigint, shingles binary")
    sets = materialize(sets.join(wanted, "class", "left_semi").dropDuplicates(["class"]), "sets", folder)
    # In every bucket all classes meet one of them.
    links = materialize(_hub_links(members.withColumn("component", F.col("class")), sets, percent, 0), "links", folder)
    labels = materialize(_labels(links, folder), "labels", folder)
    named = _still_open(members, labels, folder)
    # Buckets larger than a block meet further classes, as long as a tenth of their rows goes with each turn.
    large, turn, before = named.where(F.col("rows") > block_rows), 1, None
    while (left := large.count()) and (before is None or left < 0.9 * before):
        links = links.unionByName(materialize(_hub_links(large, sets, percent, turn), "links", folder))
        labels = materialize(_labels(links, folder), "labels", folder)
        named = _still_open(named.select("class", "n", "bucket"), labels, folder)
        large, turn, before = named.where(F.col("rows") > block_rows), turn + 1, left

    # Buckets that still hold several components are compared in blocks.
    families = components(named.select("a", F.col("class").alias("b")).distinct(), folder)
    families = families.select(F.col("node").alias("class"), F.col("component").alias("family"))
    rest = named.groupBy("class", "component", "n").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))
    rest = rest.join(families, "class").join(sets, "class")
    more = materialize(_compared_in_blocks(materialize(rest, "rest", folder), percent, block_bytes, block_rows), "more", folder)
    if not more.isEmpty():
        labels = _labels(links.unionByName(more), folder)
    rooted = classes.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    roots = rooted.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = materialize(rooted.join(roots, "component").select("class", "component_id"), "roots", folder)
    linked = signed.where("n > 0 and id is not null").select("id", "row", "n", "class").join(named, "class").select("id", "row", "n", "component_id")
    alone = signed.where("n = 0 or id is null").select("id", "row", "n", F.col("id").alias("component_id"))
    result = linked.unionByName(alone).select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
        "row",
    )
    result = materialize(result, "result", new_folder(spark, "neardup-result"))
    discard(spark, folder)
    return result
