import hashlib
import random
import struct

import pytest

from clickmarts.llm.bpe import Bpe, default_path, encode_table


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(default_path())
    t.no_truncation()
    t.no_padding()
    return t


def expected(reference, doc, text):
    ids = reference.encode(text or "", add_special_tokens=False).ids
    back = reference.decode(ids, skip_special_tokens=False)
    return (doc, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_table_equals_the_library(docs, texts, reference):
    got = sorted(tuple(r) for r in encode_table(docs).collect())
    assert got == sorted(expected(reference, i, t) for i, t in enumerate(texts))


def test_given_documents(spark, reference):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted(expected(reference, r["doc_id"], r["text"]) for r in df.collect())
    assert sorted(tuple(r) for r in encode_table(df).collect()) == want


def test_long_words_and_round_trip(reference):
    r = random.Random(3)
    bpe = Bpe(default_path())
    texts = ["a" * 5000, "".join(r.choice("abcde") for _ in range(3000)), " " * 3000, "é漢字🙂" * 300, "<|endoftext|>" * 3,
             "x<|endoftext|>  <|endoftext|> y", "".join(chr(r.randrange(32, 0x2FFF)) for _ in range(2000)), "\r\n\t \n x"]
    for text, ids in zip(texts, bpe.encode_batch(texts)):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == reference.encode(text, add_special_tokens=False).ids
        assert bpe.decode(ids).decode() == text


def test_empty_table(no_docs):
    assert encode_table(no_docs, ids=True).count() == 0
