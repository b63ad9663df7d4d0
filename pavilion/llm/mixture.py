"""Mixing sources to target weights over fixed-length blocks of words.

The words of a source lie in a row, document after document, and are packed into blocks of equal
length. The mix is a list of slots, one block each: every output shard draws how many slots
each source gets, multinomially from what the sources still have to give, and a source's slots
run through a pseudorandom permutation of its blocks, one permutation per pass, so that no block
is taken again before all have been taken. Slots and documents meet by block number.

Shards are drawn in ranges. A permutation of all slots deals them to the ranges, which gives each range
its quotas of the sources; within its range every shard draws from what these still have to give.
Ranges are drawn in tasks of bounded size; sources and slots are tables, never lists on the driver.
"""

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pavilion.llm.cascade import words
from pavilion.operators.rank import global_rank
from pavilion.session import discard, materialize, new_folder

_U = np.uint64
_RUN = 1 << 16  # slots or sources that one row or window stands for


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = 3.0) -> list[float]:
    """Words for each source: all words shared by weight, none above ``most`` times its size.

    The plain form, for lists; ``_share`` finds the same for a table of sources.
    """
    left, found = float(sum(sizes)), [0.0] * len(sizes)
    active = list(range(len(sizes)))
    while active:
        share = left / sum(weights[i] for i in active)
        full = [i for i in active if share * weights[i] > most * sizes[i]]
        if not full:
            for i in active:
                found[i] = share * weights[i]
            break
        for i in full:
            found[i] = most * sizes[i]
            left -= found[i]
        active = [i for i in active if i not in set(full)]
    return found


def permuted(index: np.ndarray, size: np.ndarray, seed: np.ndarray, back: bool = False) -> np.ndarray:
    """Image of each ``index`` under a pseudorandom permutation of ``range(size)`` chosen by ``seed``.

    Four rounds on two halves of an even number of bits; a value that falls outside goes
    through again until it lands inside. ``back`` takes the inverse.
    """
    half = np.maximum((np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2, 1).astype(_U)
    low = (_U(1) << half) - _U(1)
    out, todo = index.astype(_U), np.arange(len(index))
    while len(todo):
        x, h, m, s = out[todo], half[todo], low[todo], seed.astype(_U)[todo]

        def mix(part: np.ndarray, turn: int) -> np.ndarray:
            y = (part + s + _U(turn + 1)) * _U(0x9E3779B97F4A7C15)
            y = (y ^ (y >> _U(29))) * _U(0xBF58476D1CE4E5B9)
            return (y >> _U(32)) & m

        left, right = x >> h, x & m
        for turn in range(4):
            if back:
                left, right = right ^ mix(left, 3 - turn), left
            else:
                left, right = right, left ^ mix(right, turn)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size.astype(_U)[todo]]
    return out.astype(np.int64)


@F.pandas_udf(T.LongType())
def _block(index: pd.Series, size: pd.Series, seed: pd.Series) -> pd.Series:
    return pd.Series(permuted(index.to_numpy(np.int64), size.to_numpy(np.int64), seed.to_numpy(np.int64)))


@F.pandas_udf(T.LongType())
def _slot_of(block: pd.Series, size: pd.Series, seed: pd.Series) -> pd.Series:
    return pd.Series(permuted(block.to_numpy(np.int64), size.to_numpy(np.int64), seed.to_numpy(np.int64), back=True))


def _draw(quota: np.ndarray, shard_slots: int, seed: int | Sequence[int]) -> list[tuple[int, int, int, int]]:
    """(shard, source, first slot, slots): multinomial counts until every quota is used up."""
    draw = np.random.Generator(np.random.PCG64(seed))
    left, given, out, shard = quota.copy(), np.zeros_like(quota), [], 0
    while left.sum():
        counts = np.zeros_like(left)
        while (want := min(shard_slots, int(left.sum())) - int(counts.sum())) > 0:
            rest = left - counts
            counts += np.minimum(draw.multinomial(want, rest / rest.sum()), rest)
        out += [(shard, int(i), int(given[i]), int(counts[i])) for i in np.flatnonzero(counts)]
        given, left, shard = given + counts, left - counts, shard + 1
    return out


def _share(sources: DataFrame, weights: Sequence[float], most: float) -> float:
    """Words per unit of weight, so that all ``sources`` take as many words as they have, none above ``most`` times its size.

    Sources that are full at a share leave their words to the others, which raises it; a round is one
    aggregate, and one row per weight reaches the driver.
    """
    share, full_before = 0.0, None
    while True:
        full = F.col("weight") * share > F.col("size") * float(most)
        found = sources.groupBy("turn").agg(
            F.sum("size").alias("size"), F.sum(F.when(full, F.col("size")).otherwise(0)).alias("gone"),
            F.sum(F.when(full, 0).otherwise(1)).alias("open"), F.sum(F.when(full, 1).otherwise(0)).alias("full"),
        ).collect()
        n_full = sum(r["full"] for r in found)
        if n_full == full_before:
            return share
        open_weight = sum(weights[r["turn"]] * r["open"] for r in sorted(found, key=lambda r: r["turn"]))
        if not open_weight:
            return sys.float_info.max
        share = (sum(r["size"] for r in found) - most * sum(r["gone"] for r in found)) / open_weight
        full_before = n_full


def _quotas(sources: DataFrame, block_words: int, seed: int, most: float) -> DataFrame:
    """Adds ``blocks``, ``quota`` (slots to take), ``cut`` (words left out at the end of the last one) and ``seed``.

    What a source takes is whole passes over all its blocks and a rest that ends inside a block.
    """
    words_out = F.least(F.rint("target").cast("bigint"), (F.col("size") * float(most)).cast("bigint"))
    out = sources.withColumns(
        {
            "blocks": F.expr(f"(size + {block_words - 1}) div {block_words}"),
            "words_out": words_out,
            "seed": F.col("s") * F.lit(1_000_003).cast("bigint") + seed,
        }
    )
    out = out.withColumn("passes", F.expr("words_out div greatest(size, 1L)"))
    out = out.withColumn("rest", F.expr("words_out - passes * size"))
    # The short block's place in the last pass tells how many slots the rest takes.
    last = F.greatest(F.col("blocks") - 1, F.lit(0))
    place = _slot_of(last, F.greatest("blocks", F.lit(1)), F.col("seed") + 7919 * F.col("passes"))
    out = out.withColumns({"place": place, "missing": F.expr(f"blocks * {block_words} - size")})
    out = out.withColumn("at", F.expr(f"(rest + {block_words - 1}) div {block_words}"))
    one_more = F.expr(f"place < at and at * {block_words} - missing < rest")
    out = out.withColumn("at", F.col("at") + one_more.cast("bigint"))
    got = F.expr(f"at * {block_words} - if(place < at, missing, 0L)")
    return out.withColumns(
        {"quota": F.expr("passes * blocks + at"), "cut": F.when(F.col("rest") > 0, got - F.col("rest")).otherwise(F.lit(0)).cast("bigint")}
    ).drop("words_out", "passes", "rest", "place", "missing", "at")


def _slots(sources: DataFrame, shard_slots: int, range_shards: int, seed: int) -> DataFrame:
    """The draw: for each shard and source with slots there, ``first`` (of the source's slots) and ``n``."""
    total = sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    range_slots = shard_slots * range_shards
    given = sources.where("quota > 0").select("s", "blocks", "quota", "cut", "seed")
    # All slots are numbered through: running sums within runs of sources, and one number per run.
    given = given.withColumn("run", F.expr(f"s div {_RUN}"))
    runs = given.groupBy("run").agg(F.sum("quota").alias("n"))
    runs = runs.select("run", F.coalesce(F.sum("n").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    within = Window.partitionBy("run").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    numbered = given.withColumn("within", F.coalesce(F.sum("quota").over(within), F.lit(0))).join(runs, "run")
    numbered = numbered.withColumn("base", F.col("base") + F.col("within")).drop("run", "within")
    keys = ["s", "blocks", "quota", "cut", "seed"]
    part = numbered.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(quota - 1) div {_RUN}"))).alias("part"))
    part = part.repartition(total // (64 * _RUN) + 1, "s", "part")  # a row stands for many slots, which Spark cannot see
    first = F.col("part") * _RUN
    each = part.select(*keys, F.explode(F.sequence(F.col("base") + first, F.col("base") + F.least(first + _RUN, "quota") - 1)).alias("number"))
    at = _block("number", F.lit(max(total, 1)).cast("bigint"), F.lit(seed).cast("bigint"))
    ranges = each.select(*keys, at.alias("at")).withColumn("range", F.expr(f"at div {range_slots}")).groupBy("range", *keys).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))

    def draw(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("s", ignore_index=True)
        which = int(rows["range"].iloc[0])
        drawn = _draw(rows["n"].to_numpy(np.int64), shard_slots, [seed, which])
        shard, source, first, n = np.array(drawn, np.int64).T
        out = rows.loc[source, keys].reset_index(drop=True)
        return out.assign(shard=which * range_shards + shard, first=rows["before"].to_numpy(np.int64)[source] + first, n=n)

    schema = ", ".join(f"{c} bigint" for c in [*keys, "shard", "first", "n"])
    return ranges.groupBy("range").applyInPandas(draw, schema)


def _laid_out(sized: DataFrame, n_docs: int) -> DataFrame:
    """Adds ``start``, the document's first word in its source's row of words.

    Documents are ordered by a hash. Their running sums are taken within hash buckets and the
    buckets' sums are run up per source, so no task sees a whole source.
    """
    buckets = max(256, n_docs // 20_000)
    bucketed = sized.withColumn("bucket", F.pmod("order", F.lit(buckets)))
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = bucketed.groupBy("s", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.select("s", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("s", "bucket").orderBy("order", "id", "uid").rowsBetween(Window.unboundedPreceding, -1)
    placed = bucketed.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return placed.join(sums, ["s", "bucket"]).withColumn("start", F.col("base") + F.col("within")).drop("bucket", "base", "within")


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    most: float = 3,
    block_words: int = 256,
    shard_slots: int = 4096,
    seed: int = 7,
    range_shards: int = 64,
    carry: Sequence[str] = (),
    folder: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Documents with their share of the mix, and the mix itself as pieces of documents.

    Documents: uid, id, size, source_size, target, taken (and the columns of ``docs`` named by ``carry``
    in a struct ``doc``; they are written with the documents, so texts are better joined by the caller). Pieces: uid, shard, place, pass, from, n: words ``from`` to ``from + n - 1`` of the
    document ``uid`` are at the slot ``place`` of ``shard``. Size counts ``[^\\x20\\x09-\\x0D]+`` words. Sources
    in code-point order, null last, take the ``weights`` in turn; what a source takes equals its target
    to a word, because its last slot may end inside a block. A block is taken at most ``most`` times.

    Null and wordless texts have size 0 and are never taken. Rows that repeat are separate documents.
    Draws depend on ids, texts and ``seed`` only, so reruns agree. ``range_shards`` shards are drawn in one
    task. There may be any number of sources. The result reads tables in ``folder``, a new one by default.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "mixture")
    text = F.col(text_col)
    sized = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64(F.col(id_col), text, F.lit(seed)).alias("order"),
        *([F.struct(*carry).alias("doc")] if carry else []),
    )
    sized = materialize(sized, "documents", folder)
    names = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs"))
    sources = global_rank(names, F.col("source").isNull(), F.col("source"), name="s", folder=folder).withColumn("s", F.col("s") - 1)
    turn = F.col("s") % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    sources = materialize(sources.withColumns({"turn": turn.cast("int"), "weight": weight}), "sources", folder)
    wish = F.col("weight") * _share(sources, weights, most)
    all_of_it = F.col("size") * float(most)
    sources = sources.withColumn("target", F.when(wish > all_of_it, all_of_it).otherwise(wish))
    sources = materialize(_quotas(sources, block_words, seed, most), "quotas", folder)
    n_docs = sources.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    source_table = sources.select("s", "source", F.col("size").alias("source_size"), "target")
    slots = _slots(sources, shard_slots, range_shards, seed)
    slots = slots.select("*", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
    turn = F.expr("slot div blocks")
    slots = slots.select(
        "s",
        F.col("shard").cast("int").alias("shard"),
        "slot",
        turn.cast("int").alias("pass"),
        _block(F.col("slot") % F.col("blocks"), "blocks", F.col("seed") + 7919 * turn).alias("block"),
        # Words left out at the end of the source's very last slot.
        F.when(F.col("slot") == F.col("quota") - 1, F.col("cut")).otherwise(F.lit(0)).alias("cut"),
    )
    numbered = sized.join(source_table, sized["source"].eqNullSafe(source_table["source"])).drop(source_table["source"])
    numbered = numbered.select("uid", "id", "size", "order", "s", "source_size", "target")
    numbered = materialize(_laid_out(numbered, n_docs), "layout", folder)
    segments = numbered.where("size > 0").select(
        "uid", "s", "start", "size", "source_size",
        F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))).alias("block"),
    )
    begin = F.col("block") * block_words
    end = F.least(begin + block_words, F.col("source_size")) - F.col("cut")
    lo, hi = F.greatest(F.col("start"), begin), F.least(F.col("start") + F.col("size"), end)
    pieces = segments.join(slots, ["s", "block"]).select(
        "uid", "shard", F.col("slot").alias("place"), "pass", (lo - F.col("start")).alias("from"), (hi - lo).alias("n")
    ).where("n > 0")
    pieces = materialize(pieces, "pieces", folder)
    taken = pieces.groupBy("uid").agg(F.sum("n").alias("taken"))
    out = numbered.select("uid", "id", "size", "source_size", "target").join(taken, "uid", "left")
    out = out.withColumn("taken", F.coalesce("taken", F.lit(0)))
    if carry:
        out = out.join(sized.select("uid", "doc"), "uid")
    return out, pieces


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_cols: Sequence[str] = (), **options
) -> DataFrame:
    """The mix as documents with the columns of ``docs``: one row per document and pass that takes words of it.

    A pass that takes all words keeps the text as it is; otherwise the text is the taken words in
    order, joined by one space. ``n_chars``, where there is such a column, follows the text. ``row_cols`` name
    columns that tell rows apart and say the same whenever ``docs`` is read, and are left out of the result; without them
    ``docs`` is written once to number its rows.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "mixture")
    if not row_cols:
        docs = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "rows", new_folder(spark, "mixture-rows"))
        row_cols = ["__row"]
    documents, pieces = mixed(docs, id_col, text_col, carry=row_cols, folder=folder, **options)
    got = pieces.groupBy("uid", "pass").agg(F.sum("n").alias("__n"), F.array_sort(F.collect_list(F.struct("from", "n"))).alias("__parts"))
    rows = documents.select("uid", F.col("size").alias("__size"), "doc.*")
    # Numbers only; the texts meet them once, when the result is written.
    got = materialize(rows.join(got, "uid").select(*row_cols, "__size", "__n", "__parts"), "taken", new_folder(spark, "mixture-taken"))
    discard(spark, folder)
    both = docs.join(got, list(row_cols)).withColumn("__w", words(F.col(text_col)))
    parts = F.flatten(F.transform("__parts", lambda p: F.slice(F.col("__w"), (p["from"] + 1).cast("int"), p["n"].cast("int"))))
    text = F.when(F.col("__n") == F.col("__size"), F.col(text_col)).otherwise(F.array_join(parts, " "))
    columns = [c for c in docs.columns if c not in row_cols]
    out = both.select(*[text.alias(c) if c == text_col else F.col(c) for c in columns])
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out
