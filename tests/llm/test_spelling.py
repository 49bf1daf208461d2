import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickmarts.llm import spelling
from clickmarts.llm.spelling import near_pairs, pair_probes, pivots, prefix, spelling_variants

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute(rows, damage=199, least=5):
    count = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                count[run] += 1
    n = {w: c for w, c in count.items() if c >= least}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def got(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def edited(r, w, letters):
    i = r.randrange(len(w) + 1)
    kind = r.randrange(3)
    if kind == 0:
        return w[:i] + r.choice(letters) + w[i:]
    return w[:max(0, i - 1)] + (r.choice(letters) if kind == 1 else "") + w[max(1, i):]


def test_by_brute_force_with_chains_ties_and_damage(spark):
    r = random.Random(3)
    letters = "abcdeéÉÿ"
    rows = []
    for _ in range(40):
        w, n = "".join(r.choice(letters) for _ in range(r.randint(6, 11))), 5
        for _ in range(r.randint(1, 5)):
            rows += [(r.randrange(50), f"{w}, {w.upper()}." if r.random() < .1 else w) for _ in range(n)]
            w, n = edited(r, w, letters), n * r.choice([1, 2, 5, 6])
    rows += [(None, None), (1, ""), (2, "x" * 5), (None, "abcabcabc " * 30), (3, "aaaaaa " * 5 + "aaaaaaa " * 25 + "aaaaaaaa " * 25)]
    rows += [(7, " ".join("longword" + "abcdefgh"[i % 8] for i in range(20_000)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("no")).withColumn("n", F.lit(0))
    for damage in (199, 7):
        want = brute(rows, damage)
        assert got(spelling_variants(frame, damage=damage)) == want
        assert any(x[2] != x[0] and x[1] != x[2] for x in want) and any(x[4] > 2 for x in want)


def test_all_near_pairs_of_words_of_few_letters(spark):
    """Few letters give repeated bigrams, ties in the order and many near words."""
    r = random.Random(8)
    words = sorted({"".join(r.choice("ab") for _ in range(r.randint(6, 9))) for _ in range(400)}
                   | {"".join(r.choice("abcé") for _ in range(6)) for _ in range(300)} | {"a" * k for k in range(6, 30)})
    vocab = spark.createDataFrame([(w, 5 + i % 7) for i, w in enumerate(words)], "word string, n long")
    found = {(x["word"], x["near"]) for x in near_pairs(vocab).collect()}
    assert found == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_pivots_are_disjoint_rare_and_of_least_cost():
    rank = {g: i for i, g in enumerate(["xy", "qz", "ab", "bc", "cd", "bx", "yq", "zc", "de"])}
    places, last = prefix("abxyqzcd", rank)
    assert [("abxyqzcd"[i:i + 2]) for i in places] == ["ab", "xy", "qz", "cd"] and last == rank["cd"]
    load = [0] * spelling.SLOTS
    for p, q in ((0, 2), (0, 4), (0, 6), (2, 4), (2, 6)):
        for key in pair_probes("abxyqzcd", p, q):
            load[spelling.slot(key)] = 9
    for key in pair_probes("abxyqzcd", 4, 6):
        load[spelling.slot(key)] = 0
    assert pivots("abxyqzcd", places, load) == (4, 6)


def test_empty_tables_and_short_words(spark, no_docs):
    empty = spelling_variants(no_docs)
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0
    assert spelling_variants(spark.createDataFrame([(1, "tiny words only")], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(no_docs, least_chars=4)
