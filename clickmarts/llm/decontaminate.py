"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded run of documents of one partition.  Its index holds the
stretches of words that occur in the benchmark block's vocabulary and are long
enough for its shortest window; a window cannot lie anywhere else, since it has
no word outside that vocabulary.  All windows are searched backwards at once,
occurrences are located by sampled suffix positions, and overlapping ones are
merged into spans.

Windows are made, made distinct and numbered into blocks in Spark.  The driver and a worker
hold one block at a time: of several, each is searched in a pass of its own over the
documents, whose spans and items so far stand in the shared folder in between.

Definitions: words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after
lower-casing A-Z.  A window is ``window`` consecutive words of an item; an item
of fewer words, but not none, is one window.  Null or empty texts have no words
and are never hit; null items have no windows; a null ``item_id`` counts as the
empty name.  Rows are independent: repeated rows give repeated results, and an
empty table or benchmark gives a result without hits.  Other columns of the
inputs are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmarts.llm.common import WORD_BYTES, batch, fresh, materialize, named, pieces, release, trimmed
from clickmarts.llm.fm_index import FmIndex

#: Words of benchmark windows in one broadcast, about; more take more broadcasts, sent and searched one after another.
BLOCK_WORDS = 4_000_000
SHARD_BYTES, SHARD_ROWS = 3 << 20, 1 << 12


class Block:
    """Windows of a bounded part of the benchmark, by word ids from 1."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], set[str]] = {}

    def add(self, items: list[str], words: list[bytes]) -> None:
        ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words)
        self.windows.setdefault(ids, set()).update(items)

    def arrays(self) -> dict:
        windows = list(self.windows)
        lengths = np.array([len(w) for w in windows], np.int64)
        phrases = np.zeros((len(windows), int(lengths.max(initial=0))), np.int64)
        for row, w in zip(phrases, windows):
            row[:len(w)] = w
        return {"vocabulary": self.vocabulary, "phrases": phrases, "lengths": lengths,
                "items": [sorted(self.windows[w]) for w in windows]}


_WINDOWS = pa.schema([("words", pa.binary()), ("item", pa.string()), ("n", pa.int64())])


def numbered_windows(benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """(block, words, items): the distinct windows, words with a space between, and the names
    of all items that have them, by block of about ``block_words`` words; materialized."""
    def run(batches):
        for b in pieces(batches, 256, 1 << 18):
            rows: list[tuple] = []
            for item, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
                words = (text or b"").translate(WORD_BYTES).split()
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    part = words[i:i + window]
                    rows.append((b" ".join(part), item, len(part)))
            yield batch(_WINDOWS, **{f.name: [r[i] for r in rows] for i, f in enumerate(_WINDOWS)})

    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.col("text").cast("binary").alias("text"))
    windows = materialize(named.mapInArrow(trimmed(run), "words binary, item string, n long").groupBy("words").agg(
        F.collect_set("item").alias("items"), F.max("n").alias("n")), "windows")
    total = windows.agg(F.sum("n")).first()[0] or 0
    block = F.pmod(F.xxhash64("words"), F.lit(max(1, -(-total // block_words))))
    numbered = materialize(windows.select(block.alias("block"), "words", "items").repartition("block")
                           .sortWithinPartitions("block"), "blocks")
    release(windows)
    return numbered


def load_block(numbered: DataFrame, number: int) -> dict:
    block = Block()
    for row in numbered.where(F.col("block") == number).select("words", "items").toLocalIterator():
        block.add(row["items"], bytes(row["words"]).split(b" "))
    return block.arrays()


def search_shard(texts: list[bytes], block: dict) -> tuple[list[int], list[np.ndarray], list[set]]:
    """Word counts, merged hit spans (word numbers, flattened) and items by text."""
    get, phrases, lengths = block["vocabulary"].get, block["phrases"], block["lengths"]
    least = int(lengths.min())
    counts, parts, doc_of, word_of = [], [], [], []
    for doc, text in enumerate(texts):
        words = text.translate(WORD_BYTES).split()
        counts.append(len(words))
        if len(words) < least:
            continue
        ids = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.r_[0, ids != 0, 0]))
        for a, b in edges.reshape(-1, 2):
            if b - a >= least:
                parts += [ids[a:b], np.zeros(1, np.int64)]
                doc_of.append(doc)
                word_of.append(a)
    spans = [np.empty(0, np.int64)] * len(texts)
    items: list[set] = [set() for _ in texts]
    if not parts:
        return counts, spans, items
    symbols = np.concatenate(parts)
    index = FmIndex(symbols, len(block["vocabulary"]))
    low, high = index.search(phrases, lengths)
    found = np.flatnonzero(high > low)
    many = (high - low)[found]
    which = np.repeat(found, many)
    slots = np.repeat(low[found], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    places = index.locate(slots)
    starts = np.r_[0, np.flatnonzero(symbols == 0)[:-1] + 1]
    stretch = np.searchsorted(starts, places, side="right") - 1
    doc_of, word_of = np.array(doc_of), np.array(word_of)
    for doc, phrase in {*zip(doc_of[stretch].tolist(), which.tolist())}:
        items[doc].update(block["items"][phrase])
    cover = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(cover, places, 1)
    np.add.at(cover, places + lengths[which], -1)
    edges = np.flatnonzero(np.diff(np.r_[0, np.cumsum(cover) > 0])).reshape(-1, 2)
    if len(edges):
        stretch = np.searchsorted(starts, edges[:, 0], side="right") - 1
        words = edges - (starts[stretch] - word_of[stretch])[:, None]
        for doc, pair in zip(doc_of[stretch], words):
            spans[doc] = np.r_[spans[doc], pair]
    return counts, spans, items


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of half-open spans (flattened pairs), touching ones joined."""
    pairs = spans.reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    out: list[int] = []
    for a, b in pairs.tolist():
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return np.array(out, np.int64)


#: What a search knows of a text: words, hit words as flattened half-open pairs (merged),
#: names of the items found, and, where texts are cut, what is left of a hit one.
FOUND = "n_words long, spans array<int>, items array<string>, rest binary"
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
                    ("rest", pa.binary())])


def _search(block, cutting: bool):
    """Column function of (text as bytes, struct found so far): searches one block, adds to what
    was found before, and cuts hit texts where asked.  Texts go to Python, findings come back."""
    def parts(batches):
        for text, before in batches:
            yield pa.RecordBatch.from_arrays([text, before], names=["text", "before"])

    @F.arrow_udf(FOUND)
    def search(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for b in trimmed(lambda it: pieces(it, SHARD_ROWS, SHARD_BYTES))(parts(batches)):
            texts = b.column("text").to_pylist()
            counts, spans, items = search_shard([t or b"" for t in texts], block.value)
            out = []
            for text, before, n, own, names in zip(texts, b.column("before").to_pylist(), counts, spans, items):
                before = before or {"spans": [], "items": []}
                hit = merged(np.r_[np.array(before["spans"], np.int64), own]).tolist()
                out.append({"n_words": n, "spans": hit, "items": sorted({*before["items"], *names}),
                            "rest": cut(text, hit) if cutting and hit else None})
            yield pa.array(out, _FOUND)
    return search


def searched(docs: DataFrame, benchmark: DataFrame, found: str, window: int = 10,
             block_words: int = BLOCK_WORDS, cutting: bool = False) -> DataFrame:
    """The columns of ``docs`` and the struct ``found`` (see ``FOUND``)."""
    sc = docs.sparkSession.sparkContext
    columns, text = named(docs.columns), F.col("text").cast("binary")
    out = docs.select(*columns, F.lit(None).cast(f"struct<{FOUND}>").alias(found))
    numbered = numbered_windows(benchmark, window, block_words)
    numbers = sorted(r["block"] for r in numbered.select("block").distinct().collect())
    for number in numbers[:-1]:
        shared = sc.broadcast(load_block(numbered, number))
        former, out = out, materialize(out.select(*columns, _search(shared, False)(text, F.col(found)).alias(found)), "found")
        shared.destroy()
        if number != numbers[0]:
            release(former)
    if numbers:
        block = load_block(numbered, numbers[-1])
    else:
        nothing = Block()
        nothing.add([""], [b""])  # no document word is empty: counts words, finds nothing
        block = nothing.arrays()
    release(numbered)
    return out.select(*columns, _search(sc.broadcast(block), cutting)(text, F.col(found)).alias(found))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                       block_words: int = BLOCK_WORDS, cutting: bool = False) -> DataFrame:
    """The columns of ``docs`` and ``_text`` (bytes; with ``cutting`` those left), ``_n_words``,
    ``_spans`` (hit words as flattened half-open pairs, merged) and ``_items`` (names of the
    items found); a name that ``docs`` has gets further underscores in front."""
    found = fresh(docs, "found")
    out = searched(docs, benchmark, found, window, block_words, cutting)
    text = F.coalesce(F.col(f"{found}.rest"), F.col("text").cast("binary"))
    return out.select(*named(docs.columns), text.alias(fresh(docs, "_text")),
                      *[F.col(f"{found}.{c}").alias(fresh(docs, f"_{c}")) for c in ("n_words", "spans", "items")])


def _hits(spans: Column) -> Column:
    """Words covered: ends less starts."""
    return F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
                       F.lit(0).cast("long"), lambda s, x: s + x)


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    found = searched(docs.select("doc_id", "text"), benchmark, "found", window).select("doc_id", "found.*")
    hits = _hits(F.col("spans"))
    return found.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))


_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def cut(text: bytes, spans: list[int]) -> bytes:
    """The text without the bytes from the first to the last word of each span."""
    places = [m.span() for m in _WORD.finditer(text.translate(WORD_BYTES))]
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return b"".join(out) + text[at:]


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` with every hit span cut out of ``text``; other texts as they were."""
    found = fresh(docs, "found")
    out = searched(docs, benchmark, found, window, cutting=True)
    left = F.coalesce(F.col(f"{found}.rest").cast("string"), F.col("text").cast("string"))
    return out.select(*[left.alias(c) if c == "text" else n for c, n in zip(docs.columns, named(docs.columns))])
