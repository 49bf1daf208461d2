"""Byte-level BPE encoding and decoding of a public tokenizer's vocabulary file.

Merging uses a segment tree over the ranks of adjacent pairs: the root holds the
leftmost pair of lowest rank, a merge changes three leaves, and each change is
carried to the root level by level; it ends when the root holds no pair.  Words
(pre-tokens) that a task has not met before are merged together, one tree per row of
a numpy array.  Merged words are kept in a table of bounded size per task.

Definitions: null counts as the empty text, which has no tokens.  Strings of added
tokens (``<|endoftext|>``) in a text become that token.  A word of any length has a tree
of its own size.  Rows are independent.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from clickmarts.llm.common import batch, pieces, trimmed

#: Fixed value: the byte-level pre-tokenizer's pattern.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.iinfo(np.int64).max
KEPT = 200_000       # words a task keeps
CELLS = 1 << 20      # cells of the trees merged at once


def byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in the vocabulary file: printable bytes for
    themselves, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocabulary = byte_letters(), spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items()} | {i: t.encode() for t, i in self.added.items()}
        self.bytes = np.empty(max(raw) + 1, object)  # by id
        self.bytes[list(raw)] = list(raw.values())
        self.start = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.start[b] = vocabulary[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        key = np.array([vocabulary[a] << 20 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.keys, self.ranks = key[order], order
        self.results = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.words = regex.compile(WORDS)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.kept: dict[str, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
        """Leaf of a pair: its rank, then its place; NONE if the pair has no rank."""
        key = left << 20 | right
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[i] == key) & (left >= 0) & (right >= 0), self.ranks[i] << bits | at, NONE)

    def _merge(self, words: list[bytes], leaves: int) -> list[bytes]:
        """Merge words of at most ``leaves`` pairs each; ``leaves`` is a power of two."""
        n, bits = len(words), leaves.bit_length() - 1
        sizes = np.array([len(w) for w in words])
        slots = np.arange(leaves + 2)
        symbol = np.full((n, leaves + 2), -1, np.int64)
        symbol[slots < sizes[:, None]] = self.start[np.frombuffer(b"".join(words), np.uint8)]
        right = np.broadcast_to(slots + 1, symbol.shape).copy()
        left = np.broadcast_to(slots - 1, symbol.shape).copy()
        alive = symbol >= 0
        tree = np.full((n, 2 * leaves), NONE, np.int64)
        tree[:, leaves:] = self._rank(symbol[:, :leaves], symbol[:, 1:leaves + 1], slots[:leaves], bits)
        width = leaves
        while width > 1:
            width //= 2
            tree[:, width:2 * width] = tree[:, 2 * width:4 * width].reshape(n, width, 2).min(axis=2)
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            root = tree[rows, 1]
            at = root & (leaves - 1)
            gone = right[rows, at]
            symbol[rows, at] = self.results[root >> bits]
            alive[rows, gone] = False
            after = right[rows, gone]
            right[rows, at] = after
            left[rows, after] = at
            before = left[rows, at]
            first = before >= 0
            tree[rows, leaves + at] = self._rank(symbol[rows, at], symbol[rows, after], at, bits)
            dead = gone < leaves
            tree[rows[dead], leaves + gone[dead]] = NONE
            tree[rows[first], leaves + before[first]] = self._rank(
                symbol[rows[first], before[first]], symbol[rows[first], at[first]], before[first], bits)
            for changed, of in ((leaves + at, rows), (leaves + gone[dead], rows[dead]),
                                (leaves + before[first], rows[first])):
                for _ in range(bits):
                    changed = changed >> 1
                    tree[of, changed] = np.minimum(tree[of, 2 * changed], tree[of, 2 * changed + 1])
            rows = rows[tree[rows, 1] < NONE]
        ends = np.cumsum(alive.sum(axis=1)) * 4
        flat = symbol[alive].astype("<u4").tobytes()
        return [flat[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    def _learn(self, words: set[str]) -> None:
        if len(self.kept) > KEPT:
            self.kept.clear()
        words = list(words)
        raw = [w.encode() for w in words]
        # Pairs of each word, rounded up to a power of two.
        leaves = 1 << np.frexp(np.maximum(0, np.array(list(map(len, raw)), np.int64) - 2))[1]
        for size in np.unique(leaves).tolist():
            group = np.flatnonzero(leaves == size).tolist()
            many = max(1, CELLS // (8 * size))
            for i in range(0, len(group), many):
                part = group[i:i + many]
                self.kept.update(zip([words[j] for j in part], self._merge([raw[j] for j in part], size)))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers."""
        parts = []  # by text: lists of words, and ids of added tokens between them
        for t in texts:
            if self.split is not None and any(a in t for a in self.added):
                parts.append([self.added.get(p) if p in self.added else self.words.findall(p)
                              for p in self.split.split(t)])
            else:
                parts.append([self.words.findall(t)])
        new = set().union(*[p for text in parts for p in text if isinstance(p, list)])
        if len(self.kept) > KEPT:
            self.kept.clear()
        self._learn(new - self.kept.keys())
        get = self.kept.__getitem__
        return [b"".join(p.to_bytes(4, "little") if isinstance(p, int) else b"".join(map(get, p)) for p in text)
                for text in parts]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of token ids; bytes that are not UTF-8 become U+FFFD."""
        raw = b"".join(self.bytes[np.frombuffer(ids, "<u4")].tolist())
        return raw.decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Bpe:
    return Bpe(path)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encode_table(docs: DataFrame, path: str | None = None, ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) and, if asked, the ids as bytes."""
    path = path or default_path()
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string())] + [("ids", pa.binary())] * ids
    schema = pa.schema(fields)

    def run(batches):
        bpe = tokenizer(path)
        for b in pieces(batches, 1024, 1 << 20):
            coded = bpe.encode_batch([t or "" for t in b.column("text").to_pylist()])
            columns = {"doc_id": b.column("doc_id").to_pylist(), "n_tokens": [len(x) // 4 for x in coded],
                       "ids_sha256": [hashlib.sha256(x).hexdigest() for x in coded],
                       "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in coded], "ids": coded}
            yield batch(schema, **columns)

    return docs.select("doc_id", "text").mapInArrow(
        trimmed(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * ids)
