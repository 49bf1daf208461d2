import hashlib
import re

import numpy as np

from clickmarts.llm.pii import (KINDS, TAGS, base_spans, find_spans, labelled_rows, pii_report, redact, redacted, train,
                                viterbi)

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


AWKWARD = ["a@b", "a@b.c", "a@b.c@d.e", "@b.c", "a@b..c x.y@-.-", "1.2.3.4.5.6.7.8", "1.2.3.4567.8.9.1", "00000001.2.3.4", "256.1.1.1",
           "é1.2.3.4ü a@é.com", "4944339490429605 4944-3394 9042-9605", "4944339490429605 1", "+1 (988) 555-2485 9", "+12345678",
           "++1 23456789-", "+1 2 3 4 5 6 7 8 9 ( ", "4944339490429605@x.y", "", None, "١٢٣٤ 55.63.178.142\u00a0x"]


def test_base_spans():
    for text in AWKWARD:
        assert base_spans(text or "") == brute(text), text


def test_report(docs, texts, spark):
    got = {r["doc_id"]: r for r in pii_report(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = brute(t)
        assert got[i]["base_sha256"] == hashlib.sha256(
            ",".join(f"{k}:{a}:{b}" for a, b, k in want).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in KINDS[:4]] == [sum(s[2] == k for s in want) for k in KINDS[:4]]
        spans = got[i]["spans"].split(",") if got[i]["spans"] else []
        assert {f"{k}:{a}:{b}" for a, b, k in want} <= set(spans)


def test_crf_on_rows_it_was_not_trained_on():
    model, right, all_, extra, plain = train(), 0, 0, 0, 0
    for row in labelled_rows(300, seed=99):
        text = " ".join(w for w, _ in row)
        _, spans = find_spans([text], model)[0]
        at = 0
        for word, tag in row:
            covered = any(a < at + len(word) and at < b for a, b, _ in spans)
            all_, right = all_ + bool(tag), right + bool(tag and covered)
            plain, extra = plain + (not tag), extra + (not tag and covered)
            at += len(word) + 1
    assert right / all_ >= 0.97 and extra / plain <= 0.01


def test_clean_documents_are_left_alone_and_secrets_found(spark):
    model = train()
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    secret = re.compile(r'token = "([0-9a-f]{40})"|password=([0-9a-f]+)|(AKIA[A-Z0-9]{16})')
    clean, secrets = 0, 0
    for r in rows:
        base, spans = find_spans([r["text"]], model)[0]
        want = [next((m.start(i), m.end(i), "secret") for i in (1, 2, 3) if m[i]) for m in secret.finditer(r["text"])]
        secrets += len(want)
        assert set(want) <= set(spans)
        assert len(spans) <= len(base) + len(want), (r["doc_id"], set(spans) - set(base) - set(want))
        clean += not spans
    assert secrets > 10 and clean > 700


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    emit, moves = rng.normal(size=(20, 5, 3)), rng.normal(size=(3, 3))
    paths = np.array(np.meshgrid(*[range(3)] * 5)).reshape(5, -1).T
    for e, got in zip(emit, viterbi(emit, moves)):
        scores = [e[range(5), p].sum() + moves[p[:-1], p[1:]].sum() for p in paths]
        assert paths[int(np.argmax(scores))].tolist() == got.tolist()
    assert TAGS[0] == ""


def test_viterbi_over_long_chains_of_any_scale():
    rng = np.random.default_rng(1)
    for scale in (0.3, 2, 8):
        emit, moves = rng.normal(size=(3, 200, 6)) * scale, rng.normal(size=(6, 6))
        for e, got in zip(emit, viterbi(emit, moves)):
            score, back = e[0], []
            for row in e[1:]:
                ways = score[:, None] + moves
                back.append(ways.argmax(axis=0))
                score = ways.max(axis=0) + row
            path = [int(score.argmax())]
            for b in reversed(back):
                path.append(int(b[path[-1]]))
            assert path[::-1] == got.tolist()


def test_spans_do_not_depend_on_the_place_in_the_text():
    model = train()
    for phrase in ("(555) 123-4567", "(555) 123 4567", 'token = "' + "a1b2c3d4e5" * 4 + '"', "555 123-4567",
                   'secret "0123456789abcdef01"', "+1 988 555-2485"):
        texts = ["plain " * (k + 1) + phrase + " plain end" for k in range(0, 131)]
        spans = {tuple((a - 6 * (k + 1), b - 6 * (k + 1), c) for a, b, c in found)
                 for k, (_, found) in enumerate(find_spans(texts, model))}
        assert len(spans) == 1, (phrase, spans)


def test_redaction_and_empty(spark, no_docs):
    df = spark.createDataFrame([(1, "x a@b.cc y", 3), (2, None, 4)], "doc_id long, text string, spans int")
    assert sorted(tuple(r) for r in redact(df).collect()) == [(1, "x [email] y", 3), (2, None, 4)]
    assert redacted("abcdef", [(1, 3, "ip"), (2, 4, "card")]) == "a[ip]ef"
    assert pii_report(no_docs).count() == 0


def test_thousands_of_spans_in_one_text():
    """Work grows with the text, not with the square of its spans."""
    import time

    from clickmarts.llm.pii import find_spans, train
    model, took = train(), []
    for n in (2_000, 20_000):
        text = " ".join(f"Mail user{i}@mail{i % 7}.example.org now, card 1234567890{i:06d}, password=x{i:05d}yZ9q" for i in range(n))
        start = time.perf_counter()
        (base, spans), = find_spans([text], model)
        took.append(time.perf_counter() - start)
        assert sum(s[2] == "email" for s in base) == n and len(spans) >= len(base)
    assert took[1] < 25 * max(took[0], 0.1)


def test_shortest_span_is_a_parameter():
    from clickmarts.llm.pii import LEAST_SPAN, find_spans, train
    text = "see token = abc1 or api_key=0123456789abcdef0123456789abcdef end"
    (_, short), = find_spans([text], train(), 1)
    (_, usual), = find_spans([text], train())
    assert LEAST_SPAN == 6 and usual == [s for s in short if s[1] - s[0] >= 6] and usual
