import hashlib

from pyspark.sql import functions as F

from clickmarts.llm.fingerprints import fingerprint_report, likeness, sketch


def edited(items):
    """{doc: (code points, edited text)} over rows in descending order."""
    order = sorted(items, key=lambda x: -x[0])
    out = {}
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        out[d] = (len(t), t[:len(t) - half] + nxt[:half])
    return out


def test_report(docs, texts, spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    want = edited(list(enumerate(texts)))
    try:
        for n in ("1", "8", "100"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {r["doc_id"]: r for r in fingerprint_report(docs).collect()}
            assert len(got) == len(texts)
            for d, (n_chars, text) in want.items():
                assert (got[d]["n_chars"], got[d]["edited_sha256"]) == (n_chars, hashlib.sha256(text.encode()).hexdigest())
                assert 0 <= got[d]["near_edited"] <= 1 and 0 <= got[d]["near_next"] <= 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    prints = {}
    for i, t in enumerate(texts):
        assert prints.setdefault(t or "", got[i]["fingerprint"]) == got[i]["fingerprint"]
    assert len(set(prints.values())) == len(prints)


def test_likeness_follows_jaccard(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = [(r["doc_id"], r["text"]) for r in rows.collect()]
    want = edited(items)

    def sh(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    errors = []
    for r in fingerprint_report(rows).collect():
        a, b = sh(dict(items)[r["doc_id"]].lower()), sh(want[r["doc_id"]][1].lower())
        if len(a) > 400:
            errors.append(abs(len(a & b) / len(a | b) - r["near_edited"]))
    assert len(errors) > 50 and sum(errors) / len(errors) < 0.06


def test_likeness_of_short_texts(spark):
    """Texts of 1-100 words against copies with one word changed, with half of the words
    changed, and in other case and spacing."""
    import random
    r = random.Random(11)

    def prose(n):
        return ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(3, 9))) for _ in range(n)]

    def sh(w):
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    rows = []
    for low, high in ((1, 4), (5, 9), (10, 19), (20, 49), (50, 100)):
        for _ in range(120):
            w = prose(r.randint(low, high))
            one, half = w.copy(), w[:(len(w) + 1) // 2] + prose(len(w) // 2)
            one[r.randrange(len(w))] = "changed"
            rows += [(low, k, " ".join(w), " ".join(b), len(sh(w) & sh(b)) / len(sh(w) | sh(b))) for k, b in (("one", one), ("half", half))]
            rows.append((low, "same", " ".join(w), "\n ".join(w).upper() + " ", 1.0))
    df = spark.createDataFrame(rows, "low int, kind string, a string, b string, want double")
    got = df.select("*", likeness(F.col("a"), sketch(F.col("a")), F.col("b"), sketch(F.col("b"))).alias("likeness"))
    errors = {}
    for x in got.collect():
        errors.setdefault((x["kind"], x["low"]), []).append(abs(x["likeness"] - x["want"]))
    mean = {k: sum(v) / len(v) for k, v in errors.items()}
    assert all(mean["same", low] == 0 for low in (1, 5, 10, 20, 50)), mean
    assert mean["one", 1] == mean["half", 1] == 0, mean
    for kind in ("one", "half"):
        for low, most in ((5, 0.15), (10, 0.17), (20, 0.11), (50, 0.07)):
            assert mean[kind, low] < most, mean


def test_repeats_nulls_one_row_empty(spark, no_docs):
    df = spark.createDataFrame([(5, "a b c d e f g", 1), (5, "a b c d e f g", 2), (None, "x", 3)],
                               "doc_id long, text string, hashes int")
    got = fingerprint_report(df).collect()
    assert len(got) == 3 and sum(r["near_next"] == 1 for r in got) == 1
    one = fingerprint_report(spark.createDataFrame([(1, "ab")], "doc_id long, text string")).collect()[0]
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"aa").hexdigest()
    assert fingerprint_report(no_docs).count() == 0


def test_no_python_in_the_plan(docs):
    plan = fingerprint_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
