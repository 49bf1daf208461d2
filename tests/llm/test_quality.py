import re

import pytest
from pyspark.sql import functions as F

from clickmarts.llm.quality import MAX_RULES, STOP_WORDS, Rule, compile_rules, measures, quality_report, rules_of

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    n, chars = len(words), sum(map(len, words))
    symbols = sum(c in "#*$%&|<>" for c in text)
    stops = sum(w in STOP_WORDS or w in [s.capitalize() for s in STOP_WORDS] for w in words)
    dups = len(lines) - len(set(lines))
    base = [k for k, bad in (("few_words", n < 20), ("repeated_words", 100 * len(covered) > 30 * n)) if bad]
    bullets = sum(bool(re.match(r"[ \t]*[-*•]", x)) for x in lines)
    cut = sum(bool(re.search(r"(\.\.\.|…)[ \t\r]*\Z", x)) for x in lines)
    own = [k for k, bad in (
        ("word_length", n and not 2.5 <= chars / n <= 10), ("symbols", n and symbols / n > 0.1),
        ("stop_words", n and stops / n < 0.03), ("few_stop_words", stops < 2),
        ("repeated_lines", lines and dups / len(lines) > 0.5), ("bullet_lines", lines and bullets / len(lines) > 0.9),
        ("cut_lines", lines and cut / len(lines) > 0.3)) if bad]
    return n, chars, symbols, dups, len(covered), bool(base), not base + own, ",".join(base + own)


def test_every_count_by_brute_force(spark, docs, texts):
    extra = ["a b c d e f g h i " * 2, "x " * 9, "one\ntwo\none\n \none\r", "- a\n* b\n• c", "the cut line ...\nof it… \nwhole",
             ("the of and " * 5 + "\n") * 4, "# * $ % & | < >", " ".join(f"the w{i} of" for i in range(40))]
    more = spark.createDataFrame([(1000 + i, t, "en", "s", 0) for i, t in enumerate(extra)], docs.schema)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in quality_report(docs.union(more)).collect()}
    want = {i: brute(t) for i, t in [*enumerate(texts), *enumerate(extra, 1000)]}
    assert got == want


def test_repeated_rows_null_ids_empty_table_and_other_columns(spark, no_docs):
    rows = spark.createDataFrame([(1, "the of " * 30, 7), (1, "the of " * 30, 8), (None, None, 9)],
                                 "doc_id long, text string, words long").withColumn("lines", F.lit("x")).withColumn(
                                     "windows", F.lit(None).cast("string"))
    got = quality_report(rows)
    assert sorted((r["doc_id"] or 0, r["n_words"]) for r in got.collect()) == [(0, 0), (1, 60), (1, 60)]
    empty = quality_report(no_docs)
    assert empty.count() == 0 and empty.schema == got.schema


def test_one_text_of_many_words(spark):
    text = " ".join(f"w{i}" for i in range(200_000)) + " " + " ".join(f"w{i}" for i in range(100, 108))
    row = quality_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_words"], row["n_repeat_words"]) == (200_008, 16)


def test_rules_from_a_table(spark, docs):
    table = spark.createDataFrame([("long", "n_words", None, 50.0), ("lines", "n_lines", 1.0, None)],
                                  "name string, measure string, low double, high double")
    rules = rules_of(table)
    assert rules == (Rule("lines", "n_lines", 1.0, None), Rule("long", "n_words", None, 50.0))
    got = {r["doc_id"]: r["failed"] for r in quality_report(docs, rules).collect()}
    assert got[0] == "few_words,lines" and got[6] == "long"
    with pytest.raises(ValueError):
        compile_rules([Rule("x", "no_such_measure", 0, 1)], measures())
    with pytest.raises(ValueError):
        rules_of(spark.range(MAX_RULES + 1).selectExpr("'a' as name", "'n_words' as measure", "0 as low", "1 as high"))


def test_no_python_on_the_path(docs):
    plan = quality_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_clean_labelled_documents_stay_and_bad_ones_go(spark):
    sf = "/root/testdata/sf0.1"
    rows = quality_report(spark.read.parquet(f"{sf}/documents.parquet")).join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    shares = {r["quality"]: r["share"] for r in rows.groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert shares[1] == 1 and shares[0] < 0.05, shares
