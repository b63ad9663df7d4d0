"""Quality rules as a short-circuit cascade of DataFrame expressions.

Every rule rejects a text on one expression. On a sample the cost of each rule is measured and
its rejections are counted; the cascade then tries rules in the order of rejections per
cost, so that most bad texts meet a cheap rule that rejects them and the dear rules run on
what is left. The order never changes a verdict: a text is kept when no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pavilion.session import discard, materialize, new_folder

_BLANKS = " \t\n\x0b\x0c\r"
_SPLIT = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for a null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _SPLIT))


def word_chars(words: Column) -> Column:
    """Code points in the words."""
    return F.length(F.array_join(words, "")).cast("bigint")


def symbols(text: Column) -> Column:
    """Characters ``[#*$%&|<>]``."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("bigint")


def lines(text: Column) -> Column:
    """Lines of a text that hold a word."""
    cut = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(cut, lambda line: F.btrim(line, F.lit(_BLANKS)) != "")


def duplicate_lines(lines: Column) -> Column:
    """Lines equal to an earlier one."""
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once for all its uses."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more, the first included.

    Window keys are sorted with their places; neighbours of equal key are the repeated ones. Each
    of their places covers three words, less what the next place covers again.
    """

    def count(w: Column) -> Column:
        keys = F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("k"), i.alias("i")),
        )

        def covered(s: Column) -> Column:
            same = F.filter(
                s,
                lambda x, i: (x["k"] == F.get(s, i + 1)["k"]) | ((i > 0) & (x["k"] == F.get(s, F.greatest(i - 1, F.lit(0)))["k"])),
            )
            return F.aggregate(
                F.sort_array(F.transform(same, lambda x: x["i"])),
                F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
                lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
                lambda a: a["n"],
            )

        return _let(F.sort_array(keys), covered)

    return F.when(F.size(words) < 4, F.lit(0).cast("bigint")).otherwise(_let(words, count))


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true or false for a row of ``measured``; null rejects nothing."""

    name: str
    rejects: Column


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the arrays that the measures share, ``__words`` and ``__lines``.

    They stand behind a one-element generator, or the optimiser would split the text anew in
    every rule of a pushed-down filter.
    """
    text = F.col(text_col)
    return docs.select("*", F.inline(F.array(F.struct(words(text).alias("__words"), lines(text).alias("__lines")))))


def measures(text: Column) -> dict[str, Column]:
    """The measures as expressions on ``__words``, ``__lines`` and the text; computed only where used."""
    w, rows = F.col("__words"), F.col("__lines")
    return {
        "n_words": F.size(w).cast("bigint"),
        "word_chars": word_chars(w),
        "n_symbols": symbols(text),
        "n_dup_lines": duplicate_lines(rows),
        "n_lines": F.size(rows),
        "n_repeat_words": repeated_words(w),
        "has_lower_case": F.coalesce(text, F.lit("")).rlike(r"\p{Ll}|\p{Lo}"),
    }


def default_rules(m: Mapping[str, Column]) -> list[Rule]:
    """Rules on whole texts: length, repetition, symbols, repeated lines, word length and letter case."""
    return [
        Rule("few_words", m["n_words"] < 50),
        Rule("repeated_words", 100 * m["n_repeat_words"] > 50 * m["n_words"]),
        Rule("many_symbols", 10 * m["n_symbols"] > 3 * m["n_words"]),
        Rule("duplicate_lines", 100 * m["n_dup_lines"] > 50 * m["n_lines"]),
        Rule("long_words", m["word_chars"] > 25 * m["n_words"]),
        Rule("no_lower_case", ~m["has_lower_case"]),
    ]


@dataclass(frozen=True)
class Estimate:
    """What a sample says of a rule: seconds for the sample and the share it rejects."""

    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def estimate(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", sample_rows: int = 2000) -> list[Estimate]:
    """Cost and rejections of each rule on about ``sample_rows`` rows, best rejection per cost first.

    Every row is drawn with the same chance, so only the sample is shuffled, whatever the number of partitions.
    The sample only orders the rules. It is written once, so that the clock shows the rule
    and not the scan; the time of an empty rule is taken off.
    """
    folder = new_folder(docs.sparkSession, "cascade")
    texts = docs.select(text_col)
    share = min(1.0, sample_rows / max(docs.count(), 1))  # a stored table is counted from its files' own numbers
    sample = measured(materialize(texts.sample(share, seed=7).repartition(1), "sample", folder), text_col)

    def run(rejects: Column) -> tuple[float, float]:
        begun = time.perf_counter()
        share = sample.agg(F.avg(F.coalesce(rejects, F.lit(False)).cast("int"))).first()[0] or 0.0
        return time.perf_counter() - begun, share

    run(F.col(text_col).isNull())
    idle, _ = run(F.col(text_col).isNull())
    found = []
    for rule in rules:
        run(rule.rejects)  # code is compiled
        seconds, share = run(rule.rejects)
        found.append(Estimate(rule, max(seconds - idle, 1e-4), share))
    discard(docs.sparkSession, folder)
    return sorted(found, key=lambda e: -e.worth)


def verdict(rules: Sequence[Rule]) -> Column:
    """True where no rule rejects; a later rule is evaluated only where the earlier ones did not."""
    return reduce(lambda rest, rule: F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(False)).otherwise(rest), reversed(rules), F.lit(True))


def quality_cascade(
    docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] | None = None, sample_rows: int = 2000, kept_col: str = "kept"
) -> DataFrame:
    """``docs`` with ``kept_col``, the verdict of the ordered rules; all other columns stay as they are.

    A null, empty or wordless text fails the length rule. Equal texts get equal verdicts.
    An empty table gives an empty table. A column named ``kept_col`` is replaced.
    """
    ordered = [e.rule for e in estimate(docs, rules or default_rules(measures(F.col(text_col))), text_col, sample_rows)]
    return measured(docs, text_col).withColumn(kept_col, verdict(ordered)).drop("__words", "__lines")


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 2000) -> DataFrame:
    """One row per document: doc_id, n_words, the four base measures, base_failed and kept.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``base_failed`` means fewer than 50 words, or more than half of
    the words in repeated three-word windows; ``kept`` is the cascade's verdict, which has both as rules.
    A null text has no words and fails.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = measures(F.col("text"))
    order = [e.rule.name for e in estimate(docs, default_rules(found), "text", sample_rows)]
    # All base measures are wanted for every row, so the cascade reads them instead of computing them again.
    base = {name: found[name] for name in found if name != "has_lower_case"}
    judged = measured(docs).select("doc_id", "text", *[c.alias(name) for name, c in base.items()])
    rules = {r.name: r for r in default_rules({name: F.col(name) for name in base} | {"has_lower_case": found["has_lower_case"]})}
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = judged.select("*", failed.alias("base_failed"), verdict([rules[name] for name in order]).alias("kept"))
    return judged.drop("text", "n_lines")
