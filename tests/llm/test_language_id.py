import zlib

from pyspark.sql import functions as F

from clickmarts.llm.language_id import held_out, language_report, predict, train

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_report(docs)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert len(tested) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in tested) / len(tested) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_rows_and_other_columns_teach_nothing(spark):
    rows = [(i, "la casa verde" if i % 2 else "the green house", "es" if i % 2 else "en", "s") for i in range(40)]
    a = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    b = a.withColumn("lang", F.when(held_out(), "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("es"))
    assert sorted(language_report(a).collect()) == sorted(language_report(b).collect())
    assert "zz" not in {r["lang_pred"] for r in language_report(b).collect()}


def test_awkward_rows(spark, no_docs):
    df = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "12 !!", "en"), (None, "the house", "de"), (4, "the house", None),
                                (5, "the house is green", "en"), (5, "the house is green", "en"), (8, "das Haus", "de")],
                               "doc_id long, text string, lang string")
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in language_report(df).collect()}
    assert got[(1, "und")] == got[(2, "und")] == got[(3, "und")] == 0
    assert len(got) == 7
    assert language_report(no_docs).count() == 0
    clash = df.withColumn("lang_pred", F.lit("x")).withColumn("score", F.lit("y")).withColumn("held_out", F.lit(1))
    assert language_report(clash).columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert train(df.where("lang = 'none'"))["names"] == []
    out = predict(df, train(df.where("lang = 'none'")), "p", "s")
    assert {r["p"] for r in out.collect()} == {"und"}
