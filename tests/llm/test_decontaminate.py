import hashlib
import random
import re

import numpy as np

from clickmarts.llm import decontaminate
from clickmarts.llm.decontaminate import contamination_report, remove_contamination
from clickmarts.llm.fm_index import FmIndex

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    out = set()
    for d, t in docs:
        w, hit, names = words(t), set(), set()
        for name, item in items:
            b = words(item)
            for i in range(max(1, len(b) - window + 1) if b else 0):
                part = b[i:i + window]
                for j in range(len(w) - len(part) + 1):
                    if w[j:j + len(part)] == part:
                        hit.update(range(j, j + len(part)))
                        names.add(name)
        out.add((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def cases(texts):
    passages = [t for t in texts if t and len(t.split()) >= 60][:2]
    items = [(str(i), " ".join(p.split()[10:30])) for i, p in enumerate(passages)]
    items += [("10", "the quick brown fox"), ("2", "the QUICK, brown"), ("9", None), ("8", "..."), ("7", "ab " * 30), ("7", "word")]
    return items


def test_report(spark, docs, texts, monkeypatch):
    items = cases(texts)
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = brute(enumerate(texts), items)
    assert {tuple(r) for r in contamination_report(docs, bench).collect()} == want
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 35)  # several passes
    got = decontaminate.find_contamination(docs.select("doc_id", "text"), bench, block_words=35)
    assert {(r["doc_id"], len(r["_items"])) for r in got.collect()} == {(w[0], w[3]) for w in want}


def test_one_block_at_a_time(spark, docs, texts, monkeypatch):
    from pyspark import SparkContext
    from pyspark.core.broadcast import Broadcast
    live, most, sent, make, end = set(), [0], [], SparkContext.broadcast, Broadcast.destroy

    def broadcast(self, value):
        out = make(self, value)
        live.add(id(out))
        sent.append((out, int(value["lengths"].sum())))
        most[0] = max(most[0], len(live))
        return out

    def destroy(self, blocking=False):
        live.discard(id(self))
        end(self, blocking)

    items = cases(texts)
    bench = spark.createDataFrame(items, "item_id string, text string")
    one = decontaminate.find_contamination(docs, bench, cutting=True).collect()
    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "destroy", destroy)
    many = decontaminate.find_contamination(docs, bench, block_words=35, cutting=True)
    assert most[0] == 1 and len(sent) > 3
    windows = {tuple(w[i:i + 10]) for _, t in items if (w := words(t)) for i in range(max(1, len(w) - 9))}
    assert sum(n for _, n in sent) == sum(map(len, windows))
    assert many.columns == [*docs.columns, "_text", "_n_words", "_spans", "_items"]
    assert sorted(map(str, many.collect())) == sorted(map(str, one)) and any(r["_spans"] for r in one)


def test_empty_tables_and_columns(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination_report(no_docs, none).count() == 0
    assert contamination_report(docs, none).where("contaminated or n_items > 0").count() == 0
    same = remove_contamination(docs, none)
    assert same.columns == docs.columns
    assert sorted(map(str, same.collect())) == sorted(map(str, docs.collect()))


def test_removal(spark):
    df = spark.createDataFrame([(1, "Keep. One TWO three! tail", "x"), (2, None, "y")], "doc_id long, text string, spans string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert sorted(tuple(r) for r in remove_contamination(df, bench).collect()) == [(1, "Keep. ! tail", "x"), (2, None, "y")]


def test_fm_index_finds_all_places():
    r = random.Random(1)
    for size in (1, 2, 5):
        stretches = [[r.randint(1, size) for _ in range(r.randint(1, 40))] for _ in range(12)]
        symbols = np.array([s for x in stretches for s in [*x, 0]], np.int64)
        index = FmIndex(symbols, size)
        phrases = [[r.randint(1, size) for _ in range(r.randint(1, 4))] for _ in range(40)]
        padded = np.zeros((40, 4), np.int64)
        for row, p in zip(padded, phrases):
            row[:len(p)] = p
        low, high = index.search(padded, np.array([len(p) for p in phrases]))
        for p, a, b in zip(phrases, low, high):
            places = sorted(index.locate(np.arange(a, b)).tolist())
            assert places == [i for i in range(len(symbols)) if symbols[i:i + len(p)].tolist() == p]
