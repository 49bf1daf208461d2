"""Phrase collocations: word sequences that stand together more often than their parts.

Each task builds weighted acyclic automata (``automaton.py``) of the word sequences of its
documents, a bounded number of words at a time, and cuts them into ranges of prefixes.  One
task for each range unites what all shards have of it and sums the weights.  Phrases are
then composed with these automata: the count of a part is looked up by walking the
automaton of the range in which the part lies.

The ranges' bounds are quantiles of sequences from a sample of the documents
(``SAMPLE_DOCS`` of them, ``SAMPLE_KEYS`` sequences a range at most).  They are whole
sequences, so that even the continuations of one frequent word or pair spread over many
ranges; they spread the work only and never change a count.

Definitions: A-Z are lower-cased; texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, and
those at spaces and tabs into words.  A null text is empty, a null language is ``und``.
Repeated rows count each time.  A long text is taken in parts that overlap by the words
that a sequence may still need, so it needs no more memory than others.  Scores use
integers of 38 digits.  Ties in score fall by count, then by the phrase's UTF-8 bytes; a
word list has no two equal phrases, so the order is whole.  An empty table, or one without
frequent phrases, gives an empty result.  Only ``text`` and ``lang`` are read, so other
columns may have any names.
"""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmarts.llm import automaton
from clickmarts.llm.common import materialize, ship, trimmed

LONGEST, LEAST, TOP = 4, 30, 2000
SCALE, CONTAINED = 2_000_000, (80, 100)
#: Words of one automaton, bytes of a text that are split at once.
SHARD_WORDS, SLICE_BYTES = 1_000_000, 4 << 20
SAMPLE_DOCS, SAMPLE_KEYS, SAMPLE_STEP = 2000, 50, 16

#: Stands between pieces and texts; the byte 0xFF is in no UTF-8 text.
MARK = b"\xff"
_TABLE = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 255 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))

_PART = pa.schema([("range", pa.int32()), ("langs", pa.list_(pa.string())), ("words", pa.binary()),
                   ("parts", pa.list_(pa.binary()))])
_PART_DDL = "range int, langs array<string>, words binary, parts array<binary>"


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def _slices(text: bytes):
    """Parts of a text, cut at spaces."""
    data = text.translate(_TABLE).replace(MARK, b" " + MARK + b" ")
    start = 0
    while len(data) - start > SLICE_BYTES:
        end = data.rfind(b" ", start, start + SLICE_BYTES)
        if end <= start:
            end = data.find(b" ", start + SLICE_BYTES)
        if end < 0:
            break
        yield data[start:end]
        start = end
    yield data[start:]


def _shards(batches, size: int):
    """(tokens, langs, runs, starts): up to about ``size`` tokens with runs of tokens of one
    language each; sequences may begin at the first ``starts`` tokens."""
    tokens, langs, runs = [], [], []
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
            for piece in _slices(text.as_py()):
                found = piece.split()
                tokens += found
                langs.append(lang)
                runs.append(len(found))
                if len(tokens) >= size:
                    # The last words may go on in the next part of this text.
                    starts = max(0, len(tokens) - (LONGEST - 1))
                    yield tokens, langs, runs, starts
                    tokens, langs, runs = tokens[starts:], [lang], [len(tokens) - starts]
            tokens.append(MARK)
            langs.append(lang)
            runs.append(1)
    yield tokens, langs, runs, len(tokens)


def _automaton(shard) -> automaton.Automaton:
    tokens, langs, runs, starts = shard
    return automaton.build(tokens, langs, np.repeat(np.arange(len(runs)), runs), MARK, starts, LONGEST)


def range_bounds(docs: DataFrame, ranges: int) -> list[tuple]:
    """At most ``ranges - 1`` sequences (language and words), in order, from a sample."""
    rows = docs.count()
    if ranges < 2 or not rows:
        return []

    def run(batches):
        for tokens, langs, runs, _ in _shards(batches, SHARD_WORDS):
            lang_of = np.repeat(np.arange(len(runs)), runs)
            keys = []
            for i in range(0, len(tokens), SAMPLE_STEP):
                words = tokens[i:i + LONGEST]
                if MARK in words:
                    words = words[:words.index(MARK)]
                if words:
                    keys.append([langs[lang_of[i]].encode(), *words])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.list_(pa.binary()))], names=["key"])

    sample = _inputs(docs.sample(min(1.0, SAMPLE_DOCS / rows), 7)).mapInArrow(trimmed(run), "key array<binary>")
    got = sample.distinct().orderBy(F.xxhash64("key")).limit(SAMPLE_KEYS * ranges).toArrow()
    keys = sorted(tuple(bytes(x) for x in k) for k in got.column("key").to_pylist())
    picked = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    return [(k[0].decode(), *k[1:]) for k in picked]


def count_automata(docs: DataFrame, bounds: list[tuple], least: int = LEAST) -> DataFrame:
    """(range, langs, words, parts): for each range, the automaton of all its sequences of at
    least ``least`` occurrences; languages weigh the number of their words."""
    spark = ship(docs.sparkSession)
    limits = spark.sparkContext.broadcast(bounds)

    def rows(parts):
        packed = [(number, *automaton.pack(a)) for number, a in parts]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*packed), _PART)], schema=_PART) \
            if packed else pa.RecordBatch.from_pylist([], _PART)

    def shards(batches):
        for shard in _shards(batches, SHARD_WORDS):
            yield rows(automaton.cut(_automaton(shard), limits.value))

    def united(batches):
        held = {}
        for b in batches:
            for number, langs, words, parts in zip(*(b.column(i) for i in range(4))):
                mine = held.setdefault(number.as_py(), [])
                mine.append(automaton.unpack(langs.as_py(), words.as_py(), parts.as_py()))
                # Join the parts once they are more than what the united one holds.
                if len(mine) > 8 and sum(a.states for a in mine[1:]) > max(mine[0].states, SHARD_WORDS):
                    mine[:] = [automaton.union(mine)]
        for number, mine in sorted(held.items()):
            yield rows([(number, automaton.prune(automaton.union(mine), least))])

    dealt = _inputs(docs).mapInArrow(trimmed(shards), _PART_DDL).repartitionById(len(bounds) + 1, "range")
    return dealt.mapInArrow(trimmed(united), _PART_DDL)


_COUNT = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64())])


def counted(automata: DataFrame) -> DataFrame:
    """(lang, phrase, size, n) of the automata's sequences that lie in their own range;
    size 0: the language itself, with the number of its words."""
    def run(batches):
        for b in batches:
            for langs, words, parts in zip(*(b.column(i) for i in range(1, 4))):
                found = [(lang, text.decode(), size, n) for lang, text, size, n in automaton.sequences(
                    automaton.unpack(langs.as_py(), words.as_py(), parts.as_py())) if n]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _COUNT)], schema=_COUNT)
    return automata.mapInArrow(trimmed(run), "lang string, phrase string, size int, n long")


_ANSWER = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def part_counts(parts: DataFrame, automata: DataFrame, bounds: list[tuple]) -> DataFrame:
    """(lang, phrase, n): the distinct ``parts`` (lang, phrase) composed with the automata.
    Each part is sent to the range in which it lies and walked there."""
    spark = ship(automata.sparkSession)
    limits = spark.sparkContext.broadcast(bounds)

    @F.udf("int")
    def range_of(lang, phrase):
        key = (lang.encode(), *phrase.encode().split(b" "))
        return bisect_right(limits.value, key, key=lambda b: (b[0].encode(), *b[1:]))

    def run(batches):
        known, asked, langs = {}, [], []

        def answers():
            number = asked[0][0]
            phrases = [p for _, p in asked]
            # A range that no sequence lies in has no automaton.
            found = (automaton.lookup(known[number], langs, [p.encode() for p in phrases]) if number in known
                     else np.zeros(len(phrases), np.int64))
            return pa.RecordBatch.from_arrays([pa.array(langs), pa.array(phrases), pa.array(found)], schema=_ANSWER)

        # Within a partition rows come by range, the automaton before what is asked of it.
        for b in batches:
            for number, names, words, packed, lang, phrase in zip(*(b.column(i) for i in range(6))):
                number = number.as_py()
                if asked and (asked[0][0] != number or len(asked) >= 50_000):
                    yield answers()
                    asked, langs = [], []
                if words.is_valid:
                    known = {number: automaton.unpack(names.as_py(), words.as_py(), packed.as_py())}
                else:
                    asked.append((number, phrase.as_py()))
                    langs.append(lang.as_py())
        if asked:
            yield answers()

    empty = lambda kind: F.lit(None).cast(kind)
    wanted = parts.select(range_of("lang", "phrase").alias("range"), empty("array<string>").alias("langs"),
                          empty("binary").alias("words"), empty("array<binary>").alias("parts"), "lang", "phrase")
    given = automata.select("range", "langs", "words", "parts", empty("string").alias("lang"), empty("string").alias("phrase"))
    placed = given.union(wanted).repartitionById(len(bounds) + 1, "range").sortWithinPartitions(
        "range", F.col("words").isNull(), "lang", "phrase")
    return placed.mapInArrow(trimmed(run), "lang string, phrase string, n long")


def scored(candidates: DataFrame, automata: DataFrame, bounds: list[tuple]) -> DataFrame:
    """(lang, phrase, a, l, r, score) by each candidate's lowest-scoring cut (ties: the first)."""
    words = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"))
    parts = cuts.select("lang", F.explode(F.array("first", "rest")).alias("phrase")).distinct()
    found = materialize(part_counts(parts, automata, bounds), "collocation-parts")
    left = found.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    joined = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr(f"(cast(a as decimal(20,0)) * cast({SCALE} as decimal(10,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    least = joined.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
    return least.select("lang", "phrase", *[F.col(f"cut.{c}").alias(c) for c in ("a", "l", "r", "score")])


def contained(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, longest): the largest number of a longer candidate that holds the phrase."""
    words = F.split("phrase", " ")
    longer = candidates.where("size > 2").select("lang", "a", "size", words.alias("w"))
    inner = longer.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k"))
    inner = inner.select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("i"))
    return inner.select("lang", "a", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("phrase")).groupBy(
        "lang", "phrase").agg(F.max("a").alias("longest"))


def top_ranked(scores: DataFrame, top: int, partitions: int) -> DataFrame:
    """The first ``top`` phrases of each language, with their rank: first those of many small
    shares of a language, then of fewer, so that no task holds all phrases of one."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    for shares in (partitions, math.isqrt(partitions)):
        if shares > 1:
            share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
            scores = scores.withColumn("share", share).withColumn(
                "rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(
                    F.col("rank") <= top).drop("share", "rank")
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases; see the
    module's text for the definitions."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(docs, partitions)
    automata = materialize(count_automata(docs, bounds, least), "collocation-automata")
    counts = materialize(counted(automata), "collocation-counts")
    totals = counts.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    candidates = counts.where(f"size >= 2 and n >= {least}").select("lang", "phrase", "size", F.col("n").alias("a"))
    held = contained(candidates)
    kept = scored(candidates, automata, bounds).join(held, ["lang", "phrase"], "left").where(
        f"longest is null or cast(longest as decimal(20,0)) * {CONTAINED[1]} < cast(a as decimal(20,0)) * {CONTAINED[0]}")
    best = top_ranked(kept.drop("longest"), top, partitions)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
