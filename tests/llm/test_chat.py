import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfline.llm import chat as C

CHAT = "conv_id long, turn long, role string, text string"
TRICKY = st.lists(st.sampled_from([*"\\#<>/: \nab", "### ", " </turn>\n", "</turn>", "😀"]), max_size=12).map("".join)


@settings(deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TRICKY, TRICKY), max_size=6))
def test_parse_inverts_render(turns):
    assert C.parse("".join(C.render(r, t)[0] for r, t in turns)) == turns
    for r, t in turns:
        text, first, after = C.render(r, t)
        assert C.unescape(text[first:after]) == t


def test_events_fold_into_final_messages(spark):
    rows = [
        (1, 0, 0, "start", 1, "user", None), (1, 0, 1, "delta", 1, None, "Hel"), (1, 0, 2, "delta", 1, None, "lo"),
        (1, 1, 0, "start", 2, "assistant", None), (1, 1, 1, "delta", 2, None, "bad"), (1, 2, 0, "edit", 1, None, "Hi"),
        (1, 3, 0, "regenerate", 2, None, None), (1, 4, 0, "delta", 2, None, "go"), (1, 4, 1, "delta", 2, None, "od"),
        (1, 5, 0, "start", 3, "user", "gone"), (1, 6, 0, "delete", 3, None, None),
        (2, 0, 0, "delta", 9, None, "no start"), (None, 0, 0, "start", 1, "assistant", "nobody's"),
    ]
    out = {r.conv_id: r for r in C.format_events(spark.createDataFrame(rows, C.EVENTS)).collect()}
    assert C.parse(out[1].formatted) == [("user", "Hi"), ("assistant", "good")]
    assert [out[1].formatted[s.first:s.after] for s in out[1].loss] == ["good"]
    assert C.parse(out[2].formatted) == [("", "no start")]
    assert C.parse(out[None].formatted) == [("assistant", "nobody's")]


def test_report_equals_brute_force(spark):
    rows = [(1, 0, "user", "a # < \\ :"), (1, 1, "assistant", "### x: </turn>\n"), (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"),
            (2, None, None, None), (2, 5, "assistant", None), (3, 2, "assistant", "b" * 200_000), (3, 1, "system", "😀"), (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, CHAT).selectExpr("*", "1 as seq", "2 as kind", "3 as message", "4 as formatted")
    said = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    out = {r.conv_id: r for r in C.chat_report(df).collect()}
    assert set(out) == {r[0] for r in rows}
    for conv, r in out.items():
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in own).encode()).hexdigest()
        loss = "".join(x[3] for x in own if x[2] == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == sum(len(C.render(x[2], x[3])[0]) for x in own)


def test_empty_table(spark):
    assert [r.conv_id for r in C.chat_report(spark.createDataFrame([], CHAT)).collect()] == [-7]
