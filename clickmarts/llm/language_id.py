"""Language ID: multinomial naive Bayes over hashed character n-grams.

Spark counts the n-grams of all labelled documents (every text whole); the
log-probability matrix, whose size the parameters bound, is broadcast, and batches of
documents are scored in numpy as sparse count matrices.

Definitions: text is lower-cased; every character that is not a letter becomes a
gap.  The grams are those of 1 to 3 characters that hold a letter, hashed into
``BUCKETS``.  ``score`` is the posterior of the predicted language.  A text that is null or
has no letters is ``und`` with score 0, and teaches nothing; so is every text if there
are no labelled documents.  Ties go to the first language by name.  Rows with a null
``doc_id`` teach nothing and are not held out; they are predicted like others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmarts.llm.common import batch, materialize, pieces, trimmed

BUCKETS = 1 << 14
#: Bound of the broadcast matrix: languages times buckets.
MAX_CELLS = 1 << 25
GAP = 2  # gaps between two documents


def _letters() -> np.ndarray:
    known = np.zeros(0x110000, bool)
    known[[c for c in range(0x20000) if chr(c).isalpha()]] = True
    known[0x20000:0x32000] = True  # ideographs
    return known


def grams(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket) of every gram, and the number of letters by text."""
    low = [t.lower() for t in texts]
    sizes = np.array([len(t) + GAP for t in low], np.int64)
    code = np.frombuffer(("\0" * GAP).join([*low, ""]).encode("utf-32-le", "replace"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    letter = letters[np.minimum(code, 0x10FFFF)]
    code = np.where(letter, code, 0).astype(np.uint32)
    buckets, owners = [], []
    value, holds = np.zeros(len(code), np.uint32), np.zeros(len(code), bool)
    for order in range(3):  # grams that end here, one character longer each time
        back = np.r_[np.zeros(order, np.uint32), code[:len(code) - order]]
        value = value * np.uint32(0x01000193) + back + np.uint32(order + 1)
        holds = holds | (back > 0)
        mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        buckets.append((mixed >> np.uint32(18))[holds])
        owners.append(owner[holds])
    return np.concatenate(owners), np.concatenate(buckets), np.bincount(owner[letter], minlength=len(texts))


def _count(batches):
    letters, counts, docs = _letters(), {}, {}
    for b in pieces(batches, 512, 1 << 20):
        langs = b.column("lang").to_pylist()
        owner, bucket, n = grams(b.column("text").to_pylist(), letters)
        names = {x: i for i, x in enumerate(dict.fromkeys(langs))}
        at = np.array([names[x] for x in langs])
        total = np.bincount(at[owner] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
        for x, i in names.items():
            counts[x] = counts.get(x, 0) + total[i]
            docs[x] = docs.get(x, 0) + int((n[at == i] > 0).sum())
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
    for x, c in counts.items():
        at = np.flatnonzero(c)
        yield batch(schema, lang=[x] * (len(at) + 1), bucket=np.r_[-1, at].astype(np.int32), n=np.r_[docs[x], c[at]])


def train(docs: DataFrame) -> dict:
    """Model from all rows of (text, lang) with neither null: languages, matrix, priors."""
    counted = docs.select("text", "lang").where("text is not null and lang is not null").mapInArrow(
        trimmed(_count), "lang string, bucket int, n long")
    counts = materialize(counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    limit = MAX_CELLS // BUCKETS
    names = sorted(r[0] for r in counts.where("bucket = -1 and n > 0").select("lang").limit(limit + 1).collect())
    if len(names) > limit:
        raise ValueError(f"more than {limit} languages: raise MAX_CELLS or lower BUCKETS")
    index = {x: i for i, x in enumerate(names)}
    matrix, docs_of = np.ones((len(names), BUCKETS)), np.zeros(len(names))
    for lang, bucket, n in counts.collect():
        if lang in index:
            if bucket < 0:
                docs_of[index[lang]] = n
            else:
                matrix[index[lang], bucket] += n
    if names:
        matrix = np.log(matrix / matrix.sum(1, keepdims=True))
        docs_of = np.log(docs_of / docs_of.sum())
    return {"names": names, "matrix": np.ascontiguousarray(matrix.T), "priors": docs_of}


def score_batch(texts: list[str], model: dict, letters: np.ndarray) -> list[tuple[str, float]]:
    owner, bucket, n = grams(texts, letters)
    counts = np.bincount(owner * BUCKETS + bucket, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)
    used = np.flatnonzero(counts.any(axis=0))
    if not model["names"]:
        return [("und", 0.0)] * len(texts)
    logs = counts[:, used].astype(np.float64) @ model["matrix"][used] + model["priors"]
    best = logs.argmax(axis=1)
    post = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
    return [(model["names"][i], float(min(p, 1.0))) if k else ("und", 0.0) for i, p, k in zip(best, post, n)]


def predict(docs: DataFrame, model: dict, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score in two further columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select("*", F.lit("").alias(pred), F.lit(0.0).alias(score))

    def run(batches):
        letters = _letters()
        for b in pieces(batches, 64, 1 << 19):
            found = score_batch([t or "" for t in b.column("text").to_pylist()], shared.value, letters)
            columns = [*b.columns[:-2], pa.array([x for x, _ in found], pa.string()),
                       pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return out.mapInArrow(trimmed(run), out.schema)


def judged(spark, text: Column, model: dict) -> Column:
    """Struct ``lang``, ``score`` of a text.  Only texts go to Python and only verdicts come back."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters = _letters()
        texts = (pa.RecordBatch.from_arrays([b], names=["text"]) for b in batches)
        for b in trimmed(lambda it: pieces(it, 64, 1 << 19))(texts):
            found = score_batch([t or "" for t in b.column("text").to_pylist()], shared.value, letters)
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()),
                                              pa.array([s for _, s in found], pa.float64())], names=["lang", "score"])

    return judge(text)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def language_report(docs: DataFrame) -> DataFrame:
    """Learns from documents outside the fixed fold and predicts all."""
    model = train(docs.where(~held_out() & F.col("doc_id").isNotNull()))
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), model).drop("text")
