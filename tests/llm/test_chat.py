import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import chat


def brute(rows):
    rows = sorted(rows, key=lambda r: ((r[1] is not None, r[1] or 0), (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or "")))
    turns = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows)
    loss = "".join(t or "" for _, _, r, t in rows if r == "assistant")
    formatted = chat.turn_template([(r or "", t or "") for _, _, r, t in rows])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(rows), sha(turns), len(loss), sha(loss), len(formatted)


def digest(df):
    got = chat.digest_formatted(chat.format_conversations(df)).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in got}


def test_matches_brute_force(spark):
    df = chat.with_probe_conversation(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    by = {}
    for r in df.collect():
        by.setdefault(r.conv_id, []).append(tuple(r))
    assert digest(df) == {k: brute(v) for k, v in by.items()}
    assert by[-7][1][3] == r"\### Assistant: </turn> ok"


def test_edges(spark):
    long = [(5, i, "assistant" if i % 2 else "user", f"t{i} ### </turn> \\") for i in range(200)]  # several windows
    rows = long + [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, None, None, "x"),
        (2, 3, "odd: role ### \\", "x</turn>\n### user: y"), (2, 3, "assistant", "#" * 50 + "<" * 3), (None, 0, "user", "no id"),
    ]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "'clash' as start", "1 as rendered")
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert digest(df) == {k: brute(v) for k, v in by.items()}
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


def test_spans_cover_the_whole_formatted_text(spark):
    rows = [(1, i, r, f"text {i}") for i, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spans = sorted(chat.format_conversations(df).collect(), key=lambda r: r.turn_no)
    whole = "".join(s.rendered for s in spans)
    assert whole == chat.turn_template([(r, t) for _, _, r, t in rows])
    assert [whole[s.body_start : s.body_end] for s in spans] == [t for *_, t in rows]
    assert [s.start for s in spans] == [0] + [s.end for s in spans[:-1]]
    assert [s.loss for s in spans] == [False, False, True, False, True]


def test_templates_that_rewrite_history_are_detected():
    def drops_old_thoughts(messages):  # strips all but the last text's thoughts
        return "".join(f"<{r}>{t if i == len(messages) - 1 else t.split('|')[-1]}\n" for i, (r, t) in enumerate(messages))

    found = list(chat.locate_turns(drops_old_thoughts, [("user", "q"), ("assistant", "why|a"), ("user", "r")]))
    assert [x[3] for x in found] == [False, False, True]

    def counts(messages):
        return f"{len(messages)}:" + "".join(t for _, t in messages)

    assert any(x[3] for x in chat.locate_turns(counts, [("user", "q"), ("user", "r")]))

    def trims(messages):
        return "".join(f"[{t.strip()}]" for _, t in messages)

    assert [x[3] for x in chat.locate_turns(trims, [("user", " q "), ("user", "r")])] == [False, False]


def forgetful(turns):
    """A template that drops the thoughts of assistant turns older than ``turns``."""

    def render(messages):
        parts = []
        for i, (role, text) in enumerate(messages):
            old = len(messages) - i > turns
            parts.append(f"<{role}>{text.split('|')[-1] if old else text}\n")
        return "".join(parts)

    return render


def flags(spark, n, render, **options):
    rows = [(1, i, "assistant", f"thought {i}|said {i}") for i in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return [r.rewrites_history for r in sorted(chat.format_conversations(df, render, **options).collect(), key=lambda r: r.turn_no)]


def test_rewrites_are_found_however_far_back(spark):
    for turns in (2, 70):
        want = [i >= turns for i in range(135)]
        assert flags(spark, 135, forgetful(turns)) == want
        assert flags(spark, 135, forgetful(turns), reach=turns) == want  # wherever the windows begin


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab:#/\\<tur>n \n"), st.text("ab#/\\<tur>n: \n")), max_size=4))
def test_escaping_round_trip(messages):
    rendered = chat.turn_template(messages)
    spans = [x[0] for x in chat.locate_turns(chat.turn_template, messages)]
    assert "".join(spans) == rendered
    assert [chat.read_turn(x) for x in spans] == messages
    for _, text in messages:
        assert "</turn>" not in chat.escape(text) and "###" not in chat.escape(text)
