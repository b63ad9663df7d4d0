"""Language identification with blended-spectrum string kernels.

The kernel of two texts counts the n-grams that both hold, whatever their number, blended over
several n and scaled to 1 for equal texts. Nyström landmarks, a bounded sample of labelled texts,
turn a text into the kernels to the landmarks, whitened by the landmarks' own kernel
matrix; one ridge regression per language reads the languages off these coordinates. Presence
vectors are hashed bits, so kernels of a batch are one matrix product, and scores another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pavilion.llm import textkeys as tk
from pavilion.session import discard, materialize, new_folder

#: Texts whose presence rows are held at once.
_BATCH = 64
#: Sample texts whose products one task sums.
_SAMPLE_BLOCK = 2048


@dataclass(frozen=True)
class Spectrum:
    """n-grams of the lower-cased UTF-8 bytes, each n hashed to ``2**bits`` places of its own."""

    lengths: tuple[int, ...] = (2, 3, 4)
    bits: int = 13

    @property
    def width(self) -> int:
        return len(self.lengths) << self.bits

    def presence(self, part: tk.Slice) -> np.ndarray:
        """One 0/1 row per text."""
        out = np.zeros((part.n, self.width), np.float32)
        # Digits, symbols and blanks of any kind are one blank; they say little of a language.
        data = _LETTERS[part.data].astype(np.uint32)
        text = np.repeat(np.arange(part.n), np.diff(part.offsets))
        grams = data.copy()
        for i, n in enumerate(range(1, max(self.lengths) + 1)):
            if i:
                grams = (grams[:-1] << np.uint32(8)) | data[i:]
            if n in self.lengths and len(grams):
                place = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)
                # A gram that runs into the next text is left out.
                own = text[: len(grams)] == text[i:] if i else slice(None)
                out[text[: len(grams)][own], place[own] + (self.lengths.index(n) << self.bits)] = 1
        return out


_LETTERS = np.full(256, 0x20, np.uint8)
for _b in range(256):
    if 0x41 <= _b <= 0x5A:
        _LETTERS[_b] = _b + 32
    elif 0x61 <= _b <= 0x7A or _b >= 0x80:
        _LETTERS[_b] = _b


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared n-grams, scaled by the texts' own numbers; 0 for a text without n-grams."""
    norms = np.sqrt(np.outer(np.maximum(a.sum(1), 1), np.maximum(b.sum(1), 1)))
    return (a @ b.T) / norms


@dataclass(frozen=True)
class Model:
    """``landmarks``: presence rows; ``weights``: kernels to the landmarks to a score per language."""

    spectrum: Spectrum
    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def scores(self, presence: np.ndarray) -> np.ndarray:
        return kernel(presence, self.landmarks.astype(np.float32)) @ self.weights + self.bias


def _unpacked(bits, width: int) -> np.ndarray:
    return np.stack([np.unpackbits(np.frombuffer(b, np.uint8))[:width] for b in bits]).astype(np.float32)


def _sums(fitting):
    """Of the sample rows of a block: the weighted sum of x x' (one row per coordinate) and the sum of x of each language."""

    def sums(rows: pd.DataFrame) -> pd.DataFrame:
        width, marks, whiten, weight = fitting.value
        rows = rows.sort_values(["place", "lang"], ignore_index=True)
        square, own = np.zeros((whiten.shape[1],) * 2), {}
        for first in range(0, len(rows), _BATCH):
            part = rows.iloc[first : first + _BATCH]
            x = kernel(_unpacked(part["bits"], width), marks.astype(np.float32)).astype(np.float64) @ whiten
            square += (x * part["lang"].map(weight).to_numpy()[:, None]).T @ x
            for lang, at in part.reset_index(drop=True).groupby("lang").indices.items():
                own[lang] = own.get(lang, 0) + x[at].sum(0)
        found = [(None, i, v) for i, v in enumerate(square)] + [(lang, None, v) for lang, v in own.items()]
        return pd.DataFrame([(rows["block"].iloc[0], lang, i, v.tobytes()) for lang, i, v in found], columns=["block", "lang", "place", "sums"])

    return sums


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    # In the order of the blocks, so that reruns agree to the last bit.
    parts = [np.frombuffer(b, np.float64) for b in rows.sort_values("block")["sums"]]
    return rows.iloc[:1][["lang", "place"]].assign(sums=[np.sum(parts, axis=0).tobytes()])


def fit(spectrum: Spectrum, sample: DataFrame, landmarks: int, ridge: float) -> Model | None:
    """Nyström coordinates of the sample and one ridge regression per language on them.

    ``sample``: lang, place (from 1 in each language) and bits. The languages in turn give the
    ``landmarks``, more if there are more languages, so that every language has one. The products of the regression are summed in
    tasks; landmarks, sums the size of the landmarks and one number per language reach the driver.
    """
    counts = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    languages, n = sorted(counts), sum(counts.values())
    first = sample.orderBy("place", "lang").limit(max(landmarks, len(languages))).select("bits").collect()
    marks = _unpacked([r["bits"] for r in first], spectrum.width)
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    # Languages weigh the same, whatever their share of the sample.
    weight = {lang: n / len(languages) / counts[lang] for lang in languages}
    sent = sample.sparkSession.sparkContext.broadcast((spectrum.width, marks.astype(np.uint8), whiten, weight))
    blocks = sample.withColumn("block", F.pmod(F.xxhash64("lang", "place"), F.lit(n // _SAMPLE_BLOCK + 1)).cast("bigint"))
    parts = blocks.groupBy("block").applyInPandas(_sums(sent), "block bigint, lang string, place bigint, sums binary")
    found = parts.groupBy("lang", "place").applyInPandas(_added, "lang string, place bigint, sums binary").collect()
    square, own = np.zeros((whiten.shape[1],) * 2), np.zeros((len(languages), whiten.shape[1]))
    at = {lang: i for i, lang in enumerate(languages)}
    for r in found:
        value = np.frombuffer(r["sums"], np.float64)
        if r["lang"] is None:
            square[r["place"]] = value
        else:
            own[at[r["lang"]]] = value * weight[r["lang"]]
    # Targets are 1 for the own language and -1 for all others; sums are moved to the means.
    mean_x, mean_y = own.sum(0) / n, 2 / len(languages) - 1
    product = 2 * own.T - own.sum(0)[:, None] - n * mean_x[:, None] * mean_y
    solved = np.linalg.solve(square - n * np.outer(mean_x, mean_x) + ridge * np.eye(len(square)), product)
    bias = mean_y - mean_x @ solved
    return Model(spectrum, languages, marks.astype(np.uint8), (whiten @ solved).astype(np.float32), bias.astype(np.float32))


def _presence_rows(spectrum: Spectrum):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch.column(1), 1 << 18, _BATCH):
                bits = np.packbits(spectrum.presence(part).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.n), pa.array([b.tobytes() for b in bits], pa.binary())], ["lang", "bits"]
                )

    return rows


def _predictor(model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, *rest = model.value
        fitted = Model(Spectrum(*spectrum), *rest)
        names = pa.array(fitted.languages)
        for batch in batches:
            for part in tk.slices(batch.column(1), 1 << 18, _BATCH):
                scores = fitted.scores(fitted.spectrum.presence(part))
                found, sure = scores.argmax(1), np.clip((scores.max(1) + 1) / 2, 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(part.first, part.n) for i in (0, 2, 3)),
                        names.take(pa.array(found)),
                        pa.array(sure, pa.float64()),
                    ],
                    ["doc_id", "held_out", "letters", "lang_pred", "score"],
                )

    return predict


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    order: Column | None = None,
    sample_per_language: int = 300,
    landmarks: int = 160,
    ridge: float = 1e-2,
    spectrum: Spectrum = Spectrum(),
) -> Model | None:
    """A model of the labelled texts, or None where there are none.

    Fitted on at most ``sample_per_language`` texts of every language, those that come first in ``order``
    (default: by a hash of the text). Rows without text or language teach nothing.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), (order if order is not None else F.xxhash64(text_col)).alias("order"))
    rows = rows.where("lang is not null and text is not null")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    # Ranks are taken without the texts; Spark keeps the first rows of each task only.
    chosen = rows.select("lang", "order").withColumn("place", place).where(F.col("place") <= sample_per_language)
    chosen = chosen.groupBy("lang", "order").agg(F.min("place").cast("bigint").alias("place"))
    folder = new_folder(labelled.sparkSession, "languages")
    chosen = materialize(chosen, "chosen", folder)
    # Small for some hundred languages, when Spark copies it to the tasks; the texts are shuffled only beyond.
    sample = rows.join(chosen, ["lang", "order"]).select(F.concat_ws("\x00", F.col("place").cast("string"), "lang").alias("lang"), "text")
    sample = sample.mapInArrow(_presence_rows(spectrum), "lang string, bits binary")
    sample = sample.select(F.expr("substring(lang, instr(lang, '\\u0000') + 1)").alias("lang"), F.substring_index("lang", "\x00", 1).cast("bigint").alias("place"), "bits")
    # Rows that share a place have equal orders; one of them teaches.
    sample = materialize(sample.groupBy("lang", "place").agg(F.min("bits").alias("bits")), "sample", folder)
    model = fit(spectrum, sample, landmarks, ridge)
    discard(labelled.sparkSession, folder)
    return model


def identify_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: Column | None = None, **options
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    The model learns from the text and language of documents that are not ``held_out`` (default: the crc32 of
    the id as text leaves 2 when divided by 4) and is applied to the whole text of every document; neither
    id nor language is used in a prediction. ``score`` is the winner's regression value moved from
    -1..1 to 0..1. A text without a letter, an empty or null one, is ``und`` with score 0, and so is
    every text where nothing could be learned. A null id is not held out. Other columns are not read.
    """
    if held_out is None:
        held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), held_out.alias("held_out"), letters.alias("letters"))
    # One text may come with several ids, so the id is in the order that picks the sample.
    model = train(rows.where("not held_out and letters"), order=F.xxhash64("doc_id", F.lit(3)), **options)
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    # Plain values: broadcasts are pickled by the names of their classes, which workers without the package do not know.
    spectrum = tuple(getattr(model.spectrum, f.name) for f in fields(model.spectrum))
    sent = docs.sparkSession.sparkContext.broadcast((spectrum, model.languages, model.landmarks, model.weights, model.bias))
    found = rows.select("doc_id", "text", "held_out", "letters").mapInArrow(
        _predictor(sent), "doc_id bigint, held_out boolean, letters boolean, lang_pred string, score double"
    )
    return found.select(
        "doc_id",
        "held_out",
        F.when(F.col("letters"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"),
    )
