"""Byte-level BPE: texts to token ids by a file of ranks, and ids back to bytes.

The tiktoken library encodes. Its pattern matcher recurses over long runs, so a long text is cut
first, at places that are the end of a match whatever stands around them; the pieces are encoded one by one
and their ids joined, which gives the ids of the whole text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Characters from which on a text is cut into pieces of about this size.
PIECE_CHARS = 1 << 16
#: Bytes of text whose ids make one batch.
_BATCH_BYTES = 1 << 22

# The characters with the Unicode property White_Space.
_BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# A match never goes on from a visible character into a blank, nor from a letter or digit into punctuation.
_CUT = re.compile(f"[^{_BLANK}](?=[{_BLANK}])|[0-9A-Za-zぁ-ゖァ-ヺ一-龥](?=[!,.:;?、。！，？])")
_LONG_BLANK = re.compile(f"[{_BLANK}]{{4096,}}")


def read_ranks(path: str) -> bytes:
    """The rank file at ``path``: a line per token, its bytes in base64 and its rank."""
    with open(path, "rb") as file:
        return file.read()


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """An encoding of the ranks, without special tokens."""
    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[tuple[str, bool]]:
    """The text in pieces that can be encoded apart, each with whether it is one match by itself.

    Long blank runs come alone: the pattern takes a run whole at the end of the text, and elsewhere all of
    it but the last blank, which belongs to what follows.
    """
    at = 0
    for run in _LONG_BLANK.finditer(text):
        yield from ((p, False) for p in _cut(text, at, run.start(), size))
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : at], True
    yield from ((p, False) for p in _cut(text, at, len(text), size))


def _cut(text: str, start: int, end: int, size: int) -> Iterator[str]:
    while end - start > size and (found := _CUT.search(text, start + size - 1, end)) is not None:
        yield text[start : found.end()]
        start = found.end()
    if start < end:
        yield text[start:end]


def encode_whole(enc: tiktoken.Encoding, text: str | None, size: int = PIECE_CHARS) -> list[int]:
    """Ids of the whole text, whatever its length; null and empty texts have none."""
    if not text:
        return []
    if len(text) <= min(size, 4096):
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece, alone in pieces(text, size):
        ids += enc._encode_single_piece(piece) if alone else enc.encode_ordinary(piece)
    return ids


def _encoder(ranks, pattern: str, size: int, kind: pa.DataType):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value, pattern)

        def made(batch, first, bounds, ids) -> pa.RecordBatch:
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            keys = batch.column(0).slice(first, len(bounds) - 1).cast(kind)
            return pa.RecordBatch.from_arrays([keys, lists], ["doc_id", "ids"])

        for batch in batches:
            texts, first, bounds, ids, held = batch.column(1), 0, [0], [], 0
            for i in range(len(texts)):
                text = texts[i].as_py()
                ids += encode_whole(enc, text, size)
                bounds.append(len(ids))
                held += len(text or "")
                if held >= _BATCH_BYTES:
                    yield made(batch, first, bounds, ids)
                    first, bounds, ids, held = i + 1, [0], [], 0
            if len(bounds) > 1:
                yield made(batch, first, bounds, ids)

    return encode


def encode_texts(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", piece_chars: int = PIECE_CHARS
) -> DataFrame:
    """One row per document: doc_id, ids (array of int).

    Each match of ``pattern`` is encoded by itself with the ranks of ``rank_file``, which the driver reads and
    sends to the tasks; its size does not depend on the data. Special tokens do not exist. Null and empty texts have
    an empty array; equal rows give equal rows; ids may be null or repeated; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_file))
    return rows.mapInArrow(_encoder(sent, pattern, piece_chars, to_arrow_type(kind)), f"doc_id {kind.simpleString()}, ids array<int>")


def _decoder(ranks, pattern: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value, pattern)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            found = [None if x is None else enc.decode_bytes(x) for x in (lists[i].as_py() for i in range(len(lists)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "decoded"])

    return decode


def decode_tokens(rows: DataFrame, rank_file: str, pattern: str = r"\S+|\s+") -> DataFrame:
    """``rows`` with ``decoded``, the bytes of the tokens in ``ids``; a null array gives null, an empty one no bytes.

    Bytes are not made into text: ids may end inside a character. An id without a rank is an error. A column named
    decoded is replaced; all others pass through.
    """
    rows = rows.drop("decoded")
    sent = rows.sparkSession.sparkContext.broadcast(read_ranks(rank_file))
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])
    return rows.mapInArrow(_decoder(sent, pattern), schema)
