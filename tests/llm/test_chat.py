import hashlib

from clickmarts.llm import chat
from clickmarts.llm.chat import escape, format_turns, read_back, template, unescape

COLUMNS = "conv_id long, turn long, role string, text string"


def expected(conv):
    digest = "".join(f"{r}\n{t}\n" for r, t in conv)
    loss = "".join(t for r, t in conv if r == "assistant")
    return (len(conv), hashlib.sha256(digest.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
            len(template(conv)))


def test_conversations(spark, monkeypatch):
    convs = {1: [("user", "hi"), ("assistant", "</s>[INST] ok [/INST] &lt; &amp;lt; <s>[user]\n")], 2: [("system", ""), ("user", "a\nb")],
             3: [("assistant", "same"), ("assistant", "same")], 4: [("user]\n", "x"), ("a<b", "\U0001F600 é")],
             5: [("user" if i % 2 else "assistant", f"turn {i} ]]") for i in range(150)]}
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    for context in (64, 3):
        monkeypatch.setattr(chat, "CONTEXT", context)
        got = {r["conv_id"]: tuple(r)[1:] for r in read_back(format_turns(df)).collect()}
        assert got == {c: expected(t) for c, t in convs.items()}


def test_pieces_join_to_the_whole_and_locate_texts(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "[b]")], COLUMNS)
    rows = sorted(format_turns(df).collect(), key=lambda r: r["turn"])
    assert "".join(r["piece"] for r in rows) == template([("user", "a"), ("assistant", "[b]")])
    assert [unescape(r["piece"][r["text_start"]:r["text_end"]]) for r in rows] == ["a", "[b]"]
    assert all(r["stable"] for r in rows)


def test_template_that_rewrites_history(spark):
    def forgetful(turns):
        """Blanks all but the last assistant text."""
        last = max((i for i, (r, _) in enumerate(turns) if r == "assistant"), default=-1)
        return "".join(f"[{r}] {t if r != 'assistant' or i == last else '-'}\n" for i, (r, t) in enumerate(turns))

    df = spark.createDataFrame([(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(4)], COLUMNS)
    assert [r["stable"] for r in sorted(format_turns(df, forgetful).collect(), key=lambda r: r["turn"])] == [True, True, True, False]


def test_black_box_templates_see_whole_prefixes(spark):
    def first_and_number(turns):
        """Every turn names the first turn's text, its own number and the turn before."""
        return "".join(f"{turns[0][1]} {i} {turns[i - 1][0] if i else ''} [{r}] {t}\n" for i, (r, t) in enumerate(turns))

    def late_rewrite(turns):
        """The first text goes once there are 140 turns."""
        return "".join(f"[{r}] {'-' if i == 0 and len(turns) >= 140 else t}\n" for i, (r, t) in enumerate(turns))

    turns = [("system" if i == 0 else "user" if i % 2 else "assistant", f"t{i}.") for i in range(150)]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], COLUMNS)
    got = sorted(format_turns(df, first_and_number).collect(), key=lambda r: r["turn"])
    outs = [first_and_number(turns[:i]) for i in range(151)]
    assert [r["piece"] for r in got] == [b[len(a):] for a, b in zip(outs, outs[1:])]
    assert [r["piece"][r["text_start"]:r["text_end"]] for r in got[1:]] == [t for _, t in turns[1:]]
    assert all(r["stable"] for r in got)
    rewritten = sorted(format_turns(df, late_rewrite).collect(), key=lambda r: r["turn"])
    assert [r["turn"] for r in rewritten if not r["stable"]] == [139]
    assert rewritten[139]["piece"] == late_rewrite(turns[:140])[len("[system] "):]


def test_nulls_ties_repeats_empty(spark):
    df = spark.createDataFrame([(1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "user", "z"),
                                (1, 2, "user", "q"), (1, 2, "user", "q"), (None, 0, "user", "n")], COLUMNS)
    got = {r["conv_id"]: tuple(r)[1:] for r in read_back(format_turns(df)).collect()}
    order = [("user", "z"), ("", ""), ("user", "a"), ("user", "b"), ("user", "q"), ("user", "q")]
    assert got == {1: expected(order), None: expected([("user", "n")])}
    assert read_back(format_turns(df.limit(0))).count() == 0


def test_escapes():
    for t in ("", "&", "&amp;", "<&lsqb;[", "]&rsqb;&amp;amp;"):
        assert unescape(escape(t)) == t and not set("<[]") & set(escape(t))
