import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmarts.llm import automaton, collocations
from clickmarts.llm.collocations import MARK, collocations as mine, count_automata, counted, part_counts, range_bounds

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(rows):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    return n, f


def brute(rows, least=30, top=2000):
    n, f = grams(rows)
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    longest = Counter()
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                longest[lang, w[i:i + m]] = max(longest[lang, w[i:i + m]], a)
    found = {}
    for (lang, w), a in cand.items():
        if 100 * longest[lang, w] >= 80 * a:
            continue
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return [(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, all_ in sorted(found.items())
            for i, (s, a, p, l, r) in enumerate(sorted(all_)[:top], 1)]


def got(df):
    return [tuple(r) for r in df.orderBy("lang", "rank").collect()]


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(2)
    words = ["new", "York", "times", "the", "of", "é", "ÉA", "x.y", "a\x00b", "Ünï", "zz"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(300):
        text = []
        for _ in range(r.randint(0, 40)):
            text.append(r.choice(["New york Times", "the new York", "of the", "a b c d e", r.choice(words), r.choice(words)]))
            if r.random() < .1:
                text[-1] += r.choice([".", ",", "\n", " ! ", "\r\n", "\t", "  "])
        rows.append((" ".join(text), r.choice(["en", "en", "en", "fr", None, "de us"])))
    rows += [(None, "en"), ("", None), ("  \t", "xx"), (". , ;", "en"), ("one word " * 40, "es"), ("one word " * 40, "es")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").repartition(6).withColumn("range", F.lit("x")).withColumn(
        "words", F.lit(None).cast("int")).withColumn("phrase", F.lit("p"))


def test_by_brute_force_in_many_shards_and_ranges(spark, corpus, monkeypatch):
    want = brute(corpus)
    assert len(want) > 30 and len({x[0] for x in want}) >= 4
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, words, slices in (("1", 1_000_000, 1 << 20), ("8", 50, 40), ("40", 7, 9)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            monkeypatch.setattr(collocations, "SHARD_WORDS", words)
            monkeypatch.setattr(collocations, "SLICE_BYTES", slices)
            assert got(mine(frame(spark, corpus))) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got(mine(frame(spark, corpus), least=2, top=5)) == brute(corpus, 2, 5)


def test_one_pair_of_words_in_most_texts(spark):
    """One pair with ever new followers: its continuations spread over the ranges."""
    rows = [(" ".join(f"in the w{i}_{j}" for j in range(60)), "en") for i in range(40)]
    docs = frame(spark, rows)
    bounds = range_bounds(docs, 8)
    assert len(bounds) == 7
    sizes = [r["count"] for r in counted(count_automata(docs, bounds, 1)).join(
        spark.range(1)).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.4 * sum(sizes)
    assert got(mine(docs)) == brute(rows)


def test_counts_and_lookups(spark, corpus):
    docs = frame(spark, corpus)
    n, f = grams(corpus)
    bounds = range_bounds(docs, 12)
    automata = count_automata(docs, bounds, 2).cache()
    found = {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in counted(automata).where("size > 0").collect()}
    assert found == {x: a for x, a in f.items() if a >= 2}
    assert {r["lang"]: r["n"] for r in counted(automata).where("size = 0").collect()} == {k: v for k, v in n.items() if v}
    asked = [(lang, " ".join(w)) for lang, w in f] + [("en", "no such words"), ("zz", "the"), ("en", "a b c d e f g")]
    answers = part_counts(spark.createDataFrame(asked, "lang string, phrase string"), automata, bounds).collect()
    assert {(r["lang"], r["phrase"]): r["n"] for r in answers} == {
        (lang, p): a if (a := f[lang, tuple(p.split(" "))]) >= 2 else 0 for lang, p in asked}
    automata.unpersist()


def test_empty(spark, no_docs):
    empty = mine(no_docs)
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and empty.count() == 0


def test_automata_cut_united_packed_and_pruned():
    r = random.Random(4)
    for _ in range(60):
        vocabulary = [bytes([97 + i]) * r.randint(1, 3) for i in range(r.randint(1, 6))]
        langs = ["en", "é", ""][:r.randint(1, 3)]
        tokens = [r.choice([MARK, *vocabulary, *vocabulary]) for _ in range(r.randint(0, 60))]
        lang_of = np.array([r.randrange(len(langs)) for _ in tokens], np.int64)
        lang_of.sort()
        whole = automaton.build(tokens, langs, lang_of, MARK, len(tokens), 4)
        table = {(x, p): n for x, p, _, n in automaton.sequences(whole)}
        paths = sorted({(x, *p.split(b" ")) if p else (x,) for x, p in table}, key=lambda k: (k[0].encode(), *k[1:]))
        more = [(r.choice(langs), *(r.choice([b"a", b"bb", b"zz", b"0"]) for _ in range(r.randint(0, 4)))) for _ in range(3)]
        bounds = sorted({*r.sample(paths, min(len(paths), 4)), *more}, key=lambda k: (k[0].encode(), *k[1:]))
        parts = [(k, automaton.unpack(*automaton.pack(a))) for k, a in automaton.cut(whole, bounds)]
        inside = {}
        for k, a in parts:
            low = bounds[k - 1] if k else None
            high = bounds[k] if k < len(bounds) else None
            as_key = lambda b: (b[0].encode(), *b[1:])
            for x, p, _, n in automaton.sequences(a):
                if n:
                    key = (x.encode(), *p.split(b" ")) if p else (x.encode(),)
                    assert (low is None or as_key(low) <= key) and (high is None or key < as_key(high))
                    assert (x, p) not in inside
                    inside[x, p] = n
        assert inside == table
        if parts:
            again = automaton.union([a for _, a in parts] + [whole])
            assert {(x, p): n for x, p, _, n in automaton.sequences(again)} == {k: 2 * n for k, n in table.items()}
            pruned = automaton.prune(again, 4)
            assert {(x, p): n for x, p, _, n in automaton.sequences(pruned) if p} == {
                (x, p): 2 * n for (x, p), n in table.items() if p and 2 * n >= 4}
