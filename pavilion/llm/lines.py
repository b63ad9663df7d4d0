"""Near-duplicate lines by a deletion-neighbourhood join.

Two lines are within one word edit when they share a variant: for a substitution both lose the
word at the same place, for an insertion the longer line loses the extra word and becomes the
shorter one. All variants are emitted as hashed keys and equal keys meet. A meeting only
needs the earliest line of each side, so it is a grouped minimum, never a list of pairs.

Long lines have many variants, so two filters of fixed size come first. Lines within one edit share
the words before or after their middle, so a line whose halves are both unique has no partner; and
a variant that only one line emits joins nothing. Neither filter can lose a partner.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pavilion.llm import textkeys as tk
from pavilion.llm.keyfilter import may_repeat, repeated_keys
from pavilion.session import discard, materialize, new_folder

_U = np.uint64
_SUBSTITUTED, _SHORTER, _LONGER = 0, 1, 2


def _lines(part: tk.Slice, found: tk.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every line with a word: its first word, the word after its last, and its number in its text."""
    breaks = np.flatnonzero(part.data == 0x0A)
    line = np.searchsorted(breaks, found.start)
    text = found.text
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(line)]]) if len(first) else first
    before = np.searchsorted(breaks, part.offsets[:-1])
    return first, last, line[first] - before[text[first]]


def _halves(keyer: tk.Keyer, keys: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Four keys a line: words before and after the middle, for lines of its length and one more."""
    size = last - first
    out = np.empty((len(first), 4), np.uint64)
    for i, longer in enumerate((size, size + 1)):
        half = (longer - 1) // 2
        name = tk.mix(longer.astype(_U))
        out[:, 2 * i] = tk.mix(keyer.runs(keys, first, first + half) ^ name)
        out[:, 2 * i + 1] = tk.mix(keyer.runs(keys, last - half, last) ^ name ^ _U(0x5555555555555555))
    return out


def _half_keys(min_words: int):
    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        keyer = tk.Keyer()
        for batch in batches:
            for part in tk.slices(batch.column(0)):
                found = keyer.words(part)
                first, last, _ = _lines(part, found)
                long = last - first >= min_words
                first, last = first[long], last[long]
                # Equal lines of a slice are one line.
                _, one = np.unique(keyer.runs(found.key, first, last), return_index=True) if len(first) else (None, first)
                # A line's two lengths meet a neighbour's at one length only, so no key is met by its own line.
                yield _halves(keyer, found.key, first[one], last[one]).reshape(-1)

    return keys_of


def _line_rows(min_words: int, halves):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyer = tk.Keyer()
        for batch in batches:
            for part in tk.slices(batch.column(2)):
                found = keyer.words(part)
                first, last, number = _lines(part, found)
                key = keyer.runs(found.key, first, last)
                near = last - first >= min_words
                near[near] = may_repeat(halves.value, _halves(keyer, found.key, first[near], last[near])).any(axis=1)
                raw = found.key.tobytes()
                content = [raw[8 * a : 8 * b] if c else None for a, b, c in zip(first.tolist(), last.tolist(), near.tolist(), strict=True)]
                text = pa.array(found.text[first] + part.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(text),
                        batch.column(1).take(text),
                        pa.array(number, pa.int64()),
                        pa.array(key.view(np.int64)),
                        pa.array(content, pa.binary()),
                    ],
                    ["row", "id", "number", "line", "words"],
                )

    return rows


def _variants(keyer: tk.Keyer, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, line and role of all variants: every line less one word, and every line itself."""
    size = np.diff(bounds)
    line = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(values))
    place = (at - bounds[line]).astype(_U)
    sums, inverse = keyer._prefix(values, tk._WORD_BASE)
    a, b = bounds[line], bounds[line + 1]
    # The words after the lost one move up by one place.
    rest = (sums[at] - sums[a]) * inverse[a] + (sums[b] - sums[at + 1]) * inverse[a + 1]
    shorter = tk.mix(rest + (size[line] - 1).astype(_U))
    substituted = tk.mix(shorter ^ tk.mix(place + _U(1)))
    whole = keyer.runs(values, bounds[:-1], bounds[1:])
    keys = np.concatenate([substituted, shorter, whole])
    lines = np.concatenate([line, line, np.arange(len(size))])
    roles = np.repeat(np.array([_SUBSTITUTED, _LONGER, _SHORTER], np.int8), [len(line), len(line), len(size)])
    return keys, lines, roles


def _variant_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    keyer = tk.Keyer()
    for batch in batches:
        for part in tk.slices(batch.column(0)):
            keys, lines, _ = _variants(keyer, np.frombuffer(part.data.tobytes(), np.uint64), part.offsets // 8)
            # A line that repeats a word has equal shorter variants; they count once.
            by = np.lexsort((keys, lines))
            keys, lines = keys[by], lines[by]
            yield keys[np.concatenate([[True], (keys[1:] != keys[:-1]) | (lines[1:] != lines[:-1])])] if len(keys) else keys


def _variant_rows(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyer = tk.Keyer()
        for batch in batches:
            for part in tk.slices(batch.column(1)):
                keys, lines, roles = _variants(keyer, np.frombuffer(part.data.tobytes(), np.uint64), part.offsets // 8)
                at = np.flatnonzero(may_repeat(shared.value, keys))
                of = pa.array(lines[at] + part.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of), pa.array(keys[at].view(np.int64)), pa.array(roles[at])], ["line", "variant", "role"]
                )

    return rows


def within_one(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether one sequence becomes the other by at most one substitution, insertion or deletion."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    differ = np.flatnonzero(a != b[: len(a)])
    if not len(differ):
        return True
    at = int(differ[0])
    return bool((a[at + 1 :] == b[at + 1 :]).all() if len(a) == len(b) else (a[at:] == b[at + 1 :]).all())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sure = [
            within_one(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64))
            for a, b in zip(batch.column(1), batch.column(2), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0)], ["line"]).filter(pa.array(sure, pa.bool_()))


def _keeper(with_text: bool):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            texts = batch.column(1)
            for i, numbers in enumerate(batch.column(2)):
                lines = bytes(texts[i].as_buffer()).split(b"\n") if texts[i].is_valid else []
                stay = set(numbers.as_py()) if numbers.is_valid else set()
                full = [bool(line.strip()) for line in lines]
                kept = [line for j, line in enumerate(lines) if j in stay or not full[j]]
                joined = b"\n".join(kept)
                out.append((sum(full), len(lines) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode() if with_text else None))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", "n_lines", "n_removed", "kept_sha256", "kept_text"],
            )

    return keep


def deduplicate_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 5,
    filter_bits: int = 27,
    with_text: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, kept_sha256, kept_text.

    A line is a ``\\n``-split piece of a text, and its words are ``[^\\x20\\x09-\\x0D]+``. A line goes when an
    earlier one, by (id, line number), has the same words, or when both have ``min_words`` words
    or more and one word edit (substitution, insertion, deletion) apart; lines are judged on the input.
    Lines without a word stay and are not counted. The other lines stay as they are, joined by
    ``\\n`` in ``kept_text`` (null unless ``with_text``).

    A null text has no lines. Rows without an id come last in the order. Rows that repeat an id and a text
    are one document and keep the same lines; rows of one id with different texts follow each other in an
    order of their own. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "lines")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    docs = docs.select(F.xxhash64("id", "text").alias("row"), "id", "text")
    halves = repeated_keys(docs.select("text"), _half_keys(min_words), filter_bits)
    lines = docs.mapInArrow(_line_rows(min_words, halves), "row bigint, id bigint, number bigint, line bigint, words binary")
    lines = materialize(lines, "lines", folder)
    place = F.struct(F.col("id").isNull().alias("last"), "id", "row", "number")
    first = materialize(lines.groupBy("line").agg(F.min(place).alias("first")), "first", folder)
    near = lines.where("words is not null").select("line", "words").dropDuplicates(["line"])
    near = materialize(near, "near", folder)
    shared = repeated_keys(near.select("words"), _variant_keys, filter_bits)
    variants = near.mapInArrow(_variant_rows(shared), "line bigint, variant bigint, role tinyint").distinct()
    variants = materialize(variants.join(first, "line"), "variants", folder)

    def least(role: int):
        return F.min(F.when(F.col("role") == role, F.struct("first", "line")))

    met = variants.groupBy("variant").agg(
        least(_SUBSTITUTED).alias("same"), least(_SHORTER).alias("shorter"), least(_LONGER).alias("longer"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    other = F.when(F.col("role") == _SUBSTITUTED, F.col("same")).when(F.col("role") == _SHORTER, F.col("longer")).otherwise(F.col("shorter"))
    partners = variants.join(met, "variant").select("line", "first", other.alias("other")).where("other.first < first")
    partners = partners.select("line", F.col("other.line").alias("partner")).distinct()
    words = near.select(F.col("line").alias("partner"), F.col("words").alias("other_words"))
    pairs = partners.join(near, "line").join(words, "partner").select("line", "words", "other_words")
    gone = pairs.mapInArrow(_verify, "line bigint").distinct()
    kept = first.join(gone, "line", "left_anti").groupBy(F.col("first.row").alias("row")).agg(F.collect_list("first.number").alias("numbers"))
    kept = materialize(kept, "kept", new_folder(spark, "lines-kept"))
    discard(spark, folder)
    return docs.join(kept, "row", "left").select("id", "text", "numbers").mapInArrow(
        _keeper(with_text), "doc_id bigint, n_lines bigint, n_removed bigint, kept_sha256 string, kept_text string"
    )
