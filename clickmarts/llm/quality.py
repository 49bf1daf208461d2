"""Quality rules: a threshold table compiled into one projection, in DataFrame functions only.

A table of rules names a measure and the bounds it must keep.  ``compile_rules`` turns it
into one expression over the measures of a text: the names of the rules that it fails.
Measures are lengths and ratios of symbols, stop words, lines and repeated words; adding or
changing a rule takes no code.

Definitions: words are the maximal runs of characters other than space and U+0009 to
U+000D.  Lines are split at ``\\n``; a line counts if it has a word.  A repeated line equals
an earlier one of its text.  A repeated word lies in a window of eight words that stands
twice or more in its text; windows are compared by a 64-bit hash of their words' hashes.
Ratios with an empty base are null, and a null measure fails no rule.  Null counts as the
empty text, which has no words.  Every input row gives one output row, in whatever order and
however often it stands; an empty table gives an empty result.  Only ``doc_id`` and the text
are read, so other columns may have any names.
"""

from __future__ import annotations

from typing import NamedTuple, Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for on was as be this by with are or at from not have his they which "
    "le la les de des du et un une que qui en dans pour par sur au est ne pas plus ce se son avec il elle "
    "der die das und ein eine zu den dem mit ist im von auf für sich nicht auch wird werden einen oder "
    "el los las del y o con no una su para es al lo como más pero sus por").split()


class Rule(NamedTuple):
    """A measure must be at least ``low`` and at most ``high`` (None: no bound)."""

    name: str
    measure: str
    low: Optional[float]
    high: Optional[float]


#: The base rules of a report; a text that fails one of them is never kept.
BASE_RULES = (
    Rule("few_words", "n_words", 20, None),
    Rule("repeated_words", "repeat_word_percent", None, 30),
)
#: The method's own rules.
RULES = (
    Rule("word_length", "mean_word_chars", 2.5, 10),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("stop_words", "stop_word_ratio", 0.03, None),
    Rule("few_stop_words", "n_stop_words", 2, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.9),
    Rule("cut_lines", "ellipsis_line_ratio", None, 0.3),
)
#: More rules than this do not belong in one projection.
MAX_RULES = 1000


def rules_of(table: DataFrame) -> tuple[Rule, ...]:
    """Rules from a table (name, measure, low, high); at most ``MAX_RULES`` rows."""
    rows = table.select("name", "measure", F.col("low").cast("double"), F.col("high").cast("double")).limit(
        MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return tuple(Rule(*r) for r in sorted(rows, key=lambda r: tuple(map(str, r))))


def compile_rules(rules, measures: dict[str, Column]) -> Column:
    """Names of the failed rules, in the table's order (array of strings)."""
    failed = []
    for rule in rules:
        if rule.measure not in measures:
            raise ValueError(f"no measure {rule.measure!r}; there are {', '.join(measures)}")
        value, broken = measures[rule.measure], F.lit(False)
        if rule.low is not None:
            broken = broken | (value < F.lit(rule.low))
        if rule.high is not None:
            broken = broken | (value > F.lit(rule.high))
        failed.append(F.when(broken, F.lit(rule.name)))
    return F.array_compact(F.array(*failed)).cast("array<string>")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def window_hashes(words: Column) -> Column:
    """One hash for each window of ``WINDOW`` words, in order; empty for shorter texts."""
    def windows(h):
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
    hashed = F.array(F.transform(words, lambda w: F.xxhash64(w)))  # one element: binds the hashes once
    return F.when(F.size(words) >= WINDOW, F.element_at(F.transform(hashed, windows), 1)).otherwise(
        F.array().cast("array<long>"))


def repeated_words(windows: Column) -> Column:
    """How many words the windows that stand twice or more cover (overlaps count once)."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def at_repeats(s):
        # Equal windows are neighbours once sorted.
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        found = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    starts = F.element_at(F.transform(F.array(placed), at_repeats), 1)
    state = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(starts, state, lambda a, p: F.struct(
        p.alias("last"), (a["n"] + F.least(p - a["last"], F.lit(WINDOW))).alias("n")), lambda a: a["n"])
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(covered)


def measured(docs: DataFrame, stop_words=STOP_WORDS) -> DataFrame:
    """(doc_id, counts): the counts that all measures come from, one row per document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    stops = sorted({form for w in stop_words for form in (w, w.capitalize())})
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select("doc_id", "text", words_of(F.col("text")).alias("words"),
                       F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"))
    rows = rows.select("*", window_hashes(F.col("words")).alias("windows"))
    length = lambda c, gone: F.char_length(F.translate(c, gone, ""))
    return rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        length("text", SPACES).cast("long").alias("word_chars"),
        (F.char_length("text") - length("text", SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("windows")).alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.isin(stops))).cast("long").alias("n_stop_words"),
        F.size(F.filter("lines", lambda x: x.rlike("^[ \\t]*[-*\\u2022]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("lines", lambda x: x.rlike("(\\.\\.\\.|\\u2026)[ \\t\\r]*\\z"))).cast("long").alias("n_ellipsis_lines"))


def measures() -> dict[str, Column]:
    """What rules may name, over the columns of ``measured``."""
    counts = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")
    share = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    return {**{c: F.col(c) for c in counts},
            "mean_word_chars": share("word_chars", "n_words"),
            "symbols_per_word": share("n_symbols", "n_words"),
            "stop_word_ratio": share("n_stop_words", "n_words"),
            "repeat_word_percent": 100 * F.col("n_repeat_words") / F.nullif(F.col("n_words"), F.lit(0)),
            "dup_line_ratio": share("n_dup_lines", "n_lines"),
            "bullet_line_ratio": share("n_bullet_lines", "n_lines"),
            "ellipsis_line_ratio": share("n_ellipsis_lines", "n_lines")}


def quality_report(docs: DataFrame, rules=RULES, stop_words=STOP_WORDS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    failed): ``failed`` names the broken rules, base rules first, comma-joined."""
    named = measures()
    base, own = compile_rules(BASE_RULES, named), compile_rules(rules, named)
    return measured(docs, stop_words).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.size(base) > 0).alias("base_failed"), (F.size(F.concat(base, own)) == 0).alias("kept"),
        F.concat_ws(",", base, own).alias("failed"))
