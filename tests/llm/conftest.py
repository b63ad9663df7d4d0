from __future__ import annotations

import random

import pytest

EXTRA = "id bigint, row bigint, n bigint, kept boolean, class string, size string, shard string, words string"


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefghijklmnoprstuvé") for _ in range(draw.randint(2, 7))) if draw.random() < 0.3 else f"w{draw.randrange(vocabulary)}" for _ in range(n)]


def messy_rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, one word, copies, near copies, shared passages, one long text."""
    passage, base = prose(1, 80), prose(2, 150)
    edited = [*base[:70], "changed", *base[71:]]
    long = prose(3, 4000, 50_000)
    rows = [
        (1, " ".join(base)), (2, " ".join(base)), (3, " ".join(edited)), (4, " ".join(edited[:-3])),
        (5, None), (6, ""), (7, " \t\n\r "), (8, "word"), (9, "WORD"), (10, "two words"), (11, "Two Words"),
        (12, " ".join([*prose(4, 30), *passage, *prose(5, 30)])), (13, " ".join([*prose(6, 40), *passage, *prose(7, 5)])),
        (14, " ".join(passage)), (15, " ".join(long)), (16, " ".join([*prose(8, 10), *long[1000:1100]])),
        (17, "\n".join([" ".join(base[:20]), " ".join(base[:20]), " ".join([*base[:10], "x", *base[10:20]]), "", " ".join([*base[:9], *base[10:20]])])),
        (18, "a " * 120), (19, "### *** $$$ " * 40), (20, " ".join(prose(9, 60)).upper()),
        (21, "日本語 テキスト " * 30), (22, "é" * 300), (None, " ".join(base)), (None, None),
        (23, "\n".join([" ".join(prose(10, 60)), *["same line here"] * 9])),
    ]
    return rows


def frame(spark, rows, schema="doc_id bigint, text string"):
    """With columns whose names clash with those the operators use inside."""
    docs = spark.createDataFrame([(*r, 1, 2, 3, True, "c", "s", "h", "w") for r in rows], f"{schema}, {EXTRA}")
    return docs.repartition(3)


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(x is not None, x if x is not None else 0) for x in r])


def in_order(rows):
    return sorted(rows, key=lambda r: [(x is not None, x if x is not None else 0) for x in r])


@pytest.fixture(scope="session")
def messy():
    return messy_rows()
