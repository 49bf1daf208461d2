"""Spelling variants: words one edit apart, grouped under their most frequent form.

Pairs are found by pivotal grams.  Bigrams have a global order, rarest first.  A word's
prefix is its ``PREFIX`` rarest bigrams (all places of the last one included); two disjoint
ones of them are its pivots, chosen by dynamic programming over places, so that the fewest
entries are probed.  One edit cannot touch both pivots, so of two near words the one whose
prefix ends earlier in the order has a pivot in the prefix of the other.

Position limits: a pivot that an edit leaves alone keeps its whole text on the far side of
the edit, and its place counted from that side.  An index entry is therefore a prefix
bigram with everything to its left (or right), the word's length, and up to ``FAR`` letters
of the other end.  With pivots at p < q, the edit lies right of q (the text up to q stays),
left of p (the text from p stays), or between: then all up to p and the letters right of q
stay, or all from q and the letters left of p.  A word probes these four, for lengths one
less to one more.  Every candidate is verified by its edit distance.

How many entries stand under a key is estimated from a table of ``SLOTS`` counts, a fixed
size whatever the number of words; it and the bigram counts (at most the square of the
alphabet's 90 letters) steer the choice of pivots only, never the result.

Definitions, in ``words_of``: runs of A-Z, a-z and U+00C0 to U+00FF, with only A-Z
lower-cased; a null text has none, a null ``doc_id`` is the empty text in the run's hash.
Repeated rows count each time.  Of near words of equal number the smallest in code-point
order is the form.  An empty table, or one without words of enough occurrences, gives an
empty result.  Only ``doc_id`` and the text are read, so other columns may have any names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmarts.llm.common import lower_ascii, materialize, ship, trimmed

LETTERS = "a-zÀ-ÿ"
#: Letters of the alphabet: 26, and 64 from U+00C0 to U+00FF.
ALPHABET = 90
GRAM, PREFIX, FAR = 2, 4, 3
SLOTS = 1 << 20
#: One of so many runs loses a letter.
DAMAGE = 199
LEAST_CHARS, LEAST_COUNT, RATIO = 6, 5, 5


def words_of(docs: DataFrame, least_chars: int = LEAST_CHARS, damage: int = DAMAGE) -> DataFrame:
    """(word), one row per occurrence: maximal runs of letters, lower-cased; where ``damage``
    divides the hash of document and run, without one letter.  Only words of ``least_chars``."""
    run, h, n = F.col("run"), F.col("h"), F.char_length("run")
    cut = (h % n).cast("int")
    # A run of fewer letters cannot become a long enough word.
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(
        F.regexp_extract_all(lower_ascii(F.col("text").cast("string")), F.lit(f"[{LETTERS}]{{{least_chars},}}"), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("doc", F.lit(":"), "run")).alias("h"))
    word = F.when(h % damage == 0, F.concat(F.substring(run, F.lit(1), cut), F.substr(run, cut + 2))).otherwise(run)
    return hashed.select(word.alias("word")).where(F.char_length("word") >= least_chars)


def vocabulary(words: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with enough occurrences."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def gram_order(vocab: DataFrame) -> dict[str, int]:
    """Rank of every bigram, rarest first; at most ``ALPHABET ** GRAM`` entries."""
    grams = vocab.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.char_length("word") - (GRAM - 1)), lambda i: F.substring("word", i, GRAM))).alias("g"))
    rows = grams.groupBy("g").count().orderBy("count", "g").limit(ALPHABET ** GRAM + 1).collect()
    if len(rows) > ALPHABET ** GRAM:
        raise ValueError("words have letters outside the alphabet")
    return {r["g"]: i for i, r in enumerate(rows)}


def prefix(word: str, rank: dict[str, int]) -> tuple[list[int], int]:
    """Places of the word's rarest bigrams, rising, and the rank of the last one."""
    placed = sorted((rank[word[i:i + GRAM]], i) for i in range(len(word) - GRAM + 1))
    last = placed[min(PREFIX, len(placed)) - 1][0]
    return sorted(i for r, i in placed if r <= last), last


def left_key(length: int, text: str, far: str) -> str:
    return f"<{length},{text},{far}"


def right_key(length: int, text: str, far: str) -> str:
    return f">{length},{text},{far}"


def entries(word: str, places: list[int]) -> list[str]:
    """Index keys of a word: each prefix bigram with all to its left or right."""
    n, out = len(word), []
    for q in places:
        out += [left_key(n, word[:q + GRAM], word[n - k:]) for k in range(min(FAR, n - q - GRAM) + 1)]
        out += [right_key(n, word[q:], word[:k]) for k in range(min(FAR, q) + 1)]
    return out


def pair_probes(word: str, p: int, q: int) -> list[str]:
    """What a word with pivots at ``p`` and ``q`` probes: see the module's text."""
    n = len(word)
    ahead, behind = min(FAR, n - q - GRAM), min(FAR, p)
    return [key for m in (n - 1, n, n + 1) for key in (
        left_key(m, word[:q + GRAM], ""), right_key(m, word[p:], ""),
        left_key(m, word[:p + GRAM], word[n - ahead:]), right_key(m, word[q:], word[:behind]))]


def slot(key: str) -> int:
    return zlib.crc32(key.encode()) % SLOTS


def pivots(word: str, places: list[int], load) -> tuple[int, int]:
    """The two disjoint bigrams of ``places`` that meet the fewest entries (``load``: entries
    by slot), by dynamic programming: from left to right, the least cost of a left pivot that
    ends before the place, plus the place's cost as the right one.  Each cost assumes that
    the other pivot is the neighbouring bigram."""
    n = len(word)

    def cost(texts):
        return sum(int(load[slot(key(m, *text))]) for key, *text in texts for m in (n - 1, n, n + 1))

    def as_left(p):
        return cost([(right_key, word[p:], ""), (left_key, word[:p + GRAM], word[n - max(0, min(FAR, n - p - 2 * GRAM)):])])

    def as_right(q):
        return cost([(left_key, word[:q + GRAM], ""), (right_key, word[q:], word[:max(0, min(FAR, q - GRAM))])])

    best, least, lefts = None, None, iter(places)
    at = next(lefts)
    for q in places:
        while at <= q - GRAM:
            own = (as_left(at), at)
            least = min(least or own, own)
            at = next(lefts)
        if least:
            whole = (least[0] + as_right(q), least[1], q)
            best = min(best or whole, whole)
    return best[1], best[2]


_KEYS = pa.schema([("key", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("last", pa.int32())])
_DDL = "key string, word string, n long, last int"


def _keyed(vocab: DataFrame, make) -> DataFrame:
    """Rows (key, word, n, last) of every key that ``make(word)`` gives; ``last`` is the
    rank at which the word's prefix ends."""
    def run(batches):
        for b in batches:
            for start in range(0, b.num_rows, 4096):
                part = b.slice(start, 4096)
                keys, words, counts, lasts = [], [], [], []
                for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist()):
                    found, last = make(word)
                    keys += found
                    words += [word] * len(found)
                    counts += [n] * len(found)
                    lasts += [last] * len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip((keys, words, counts, lasts), _KEYS)], schema=_KEYS)
    return vocab.mapInArrow(trimmed(run), _DDL)


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all pairs of words one edit apart, both ways round."""
    spark = ship(vocab.sparkSession)
    ranks = spark.sparkContext.broadcast(gram_order(vocab))

    def indexed(word):
        places, last = prefix(word, ranks.value)
        return entries(word, places), last

    index = materialize(_keyed(vocab, indexed), "spelling-index")
    counts = index.groupBy(F.pmod(F.crc32("key"), F.lit(SLOTS)).cast("int").alias("slot")).agg(
        F.count(F.lit(1)).alias("n")).toArrow()
    load = np.zeros(SLOTS, np.int64)
    load[counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
    loads = spark.sparkContext.broadcast(load)

    def probed(word):
        places, last = prefix(word, ranks.value)
        return pair_probes(word, *pivots(word, places, loads.value)), last

    probes = _keyed(vocab, probed)
    a, b = probes.alias("a"), index.alias("b")
    found = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.last") <= F.col("b.last"))
                   & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)).select(
        F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))
    return found.union(found.select("near", "near_n", "word", "n")).distinct()


def forms(vocab: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest number, if it is ``ratio``
    times as frequent."""
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("best"))
    is_form = -F.col("best.m") >= ratio * F.col("n")
    return vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n"))


def roots(formed: DataFrame, largest: int, ratio: int = RATIO, least: int = LEAST_COUNT) -> DataFrame:
    """(word, root) of the words that have a form.  Numbers grow ``ratio`` times a step, so
    chains are short; each round doubles the steps followed."""
    steps, n = 1, least * ratio
    while n * ratio <= largest:
        steps, n = steps + 1, n * ratio
    chain = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range((steps - 1).bit_length()):
        chain = materialize(chain, "spelling-roots")
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("far"))
        chain = chain.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root"))
    return chain


def spelling_variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
                      ratio: int = RATIO, damage: int = DAMAGE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word; see the module's text."""
    if least_chars < 2 * GRAM + 1:
        raise ValueError(f"words need {2 * GRAM + 1} letters for two disjoint bigrams")
    vocab = materialize(vocabulary(words_of(docs, least_chars, damage), least_count), "spelling-words")
    largest = vocab.agg(F.max("n")).first()[0] or 0
    formed = materialize(forms(vocab, near_pairs(vocab), ratio), "spelling-forms")
    return formed.join(roots(formed, largest, ratio, least_count), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

