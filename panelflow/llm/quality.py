"""Quality rules compiled into one projection (operator 5); DataFrame functions only.

RULES is the threshold table: a measure, written over the columns that
``measures`` makes, and the range it must lie in. ``compile_rules`` turns
the table into one boolean expression, so all rules of a row are evaluated
in the same projection, without user functions and without a shuffle.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Common words of English, German, French and Spanish.
STOP_WORDS = (
    "the and of to in a is that for it was on are as with be by this from at or an "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les en un du une que est pour qui dans par sur au pas avec "
    "el y los del se las por para con no su al es").split()

# measure, least, most (None: open). Documents of fewer than 20 words fail the base before any rule.
RULES: list[tuple[str, str, float | None, float | None]] = [
    ("mean word length", "word_chars / n_words", 2.5, 12.0),
    ("symbols per word", "n_symbols / n_words", None, 0.1),
    ("share of stop words", "n_stop_words / n_words", 0.05, None),
    ("different words by root of words", "n_different / sqrt(n_words)", 2.5, None),
    ("share of repeated lines", "n_dup_lines / n_lines", None, 0.4),
    ("share of bullet lines", "n_bullet_lines / n_lines", None, 0.9),
    ("share of lines ending in an ellipsis", "n_ellipsis_lines / n_lines", None, 0.3),
]

WINDOW = 8
_SPACE = r"[ \t\n\x0B\f\r]+"
_A_WORD = r"[^ \t\x0B\f\r]"


def _stop_hashes() -> list[int]:
    """Spark's hashes of the stop words, capitalised or not, bare or before a comma or full stop."""
    forms = {v + end for w in STOP_WORDS for v in (w, w.capitalize()) for end in ("", ",", ".")}
    hashes = (xxhash.xxh64_intdigest(f.encode(), 42) for f in sorted(forms))
    return [h - (1 << 64) if h >> 63 else h for h in hashes]


def compile_rules(rules=RULES) -> Column:
    """True where every measure lies in its range (a measure that cannot be taken passes)."""
    tests = [F.lit(True)]
    for _, measure, least, most in rules:
        value = F.expr(f"try_divide({measure.split(' / ')[0]}, {measure.split(' / ')[1]})") if " / " in measure else F.expr(measure)
        if least is not None:
            tests.append(F.coalesce(value >= least, F.lit(True)))
        if most is not None:
            tests.append(F.coalesce(value <= most, F.lit(True)))
    verdict = tests[0]
    for t in tests[1:]:
        verdict = verdict & t
    return verdict


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with every count that the rules use."""
    size = lambda c: F.size(c).cast("long")
    base = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    split = base.select(
        "doc_id", F.array_remove(F.split("text", _SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.regexp_like(line, F.lit(_A_WORD))).alias("lines"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    hashed = split.select(
        "doc_id", "n_symbols", "lines", size("words").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    windows = hashed.withColumn("windows", F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), (F.col("n_words") - WINDOW + 1).cast("int")), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))))
    # only texts with a window twice go further: windows sorted by hash, those beside an equal one, their places
    placed = windows.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    at = lambda a, j: F.get(a, j)
    twice = placed.withColumn("places", F.when(F.col("sorted").isNotNull(), F.sort_array(F.transform(
        F.filter(F.transform("sorted", lambda s, j: F.when(
            s["h"].eqNullSafe(at("sorted", j - 1)["h"]) | s["h"].eqNullSafe(at("sorted", j + 1)["h"]), s["i"])), lambda i: i.isNotNull()),
        lambda i: i))))
    covered = F.aggregate(F.sequence(F.lit(1), F.size("places")), F.lit(0).cast("long"), lambda n, j: n + F.least(
        F.lit(WINDOW), F.coalesce(F.get("places", j) - F.get("places", j - 1), F.lit(WINDOW))))
    return twice.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("places") > 0, covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        size("lines").alias("n_lines"), size(F.array_distinct("hashes")).alias("n_different"),
        size(F.filter("hashes", lambda h: h.isin(_stop_hashes()))).alias("n_stop_words"),
        size(F.filter("lines", lambda line: F.regexp_like(line, F.lit(r"^\s*[-*•]")))).alias("n_bullet_lines"),
        size(F.filter("lines", lambda line: F.regexp_like(line, F.lit(r"(\.\.\.|…)\s*$")))).alias("n_ellipsis_lines"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per document: the base counts, base_failed and kept.

    Null and empty texts have no words and fail the base; lines without a
    word are not lines here; repeated rows each come back; other columns
    play no part. An empty table gives no rows.
    """
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measures(docs, id_col, text_col).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & compile_rules(rules)).alias("kept"))
