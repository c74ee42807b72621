import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from residua.llm.chat import PROBE, Codec, Reader, Template, digests, format_conversations, format_turns, with_probe
from residua.session import table

T = Template()
PIECES = st.lists(
    st.sampled_from([*T.control(), "\\", " ", "[", "]", "<", "ok", "\n", "é", "/", "[INS", "T]", "</", "s>"]), max_size=12
).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool]", "a\\b"]) | PIECES, PIECES), max_size=6))
def test_round_trip(turns):
    segments = list(format_turns([(7, r, t) for r, t in turns], T))
    reader = Reader(T)
    back = [turn for s in segments for turn in reader.feed(s[4])]
    assert back == turns and reader.held == ""
    whole = Reader(T)
    assert list(whole.feed("".join(s[4] for s in segments))) == turns
    codec = Codec(T)
    assert [codec.restore(s[4]) for s in segments if s[5]] == [t for r, t in turns if r == "assistant"]
    assert not any(c in codec.escape(t) for _, t in turns for c in T.control())


def test_turn_order():
    bad = [s[6] for s in format_turns([(1, "user", "a"), (1, "user", "b"), (2, "assistant", ""), (2, "user", "x")], T)]
    assert bad[::3] == [None, "user after user", "assistant after the start", None]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(learned), sha(learned))
    return out


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", PROBE), (None, 0, None, "x"), (2, 0, "user", "a"), (2, 0, "user", "a"), (3, None, "tool", "t" * 300_000)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, loss string")
    got = {r.conv_id: tuple(r)[1:5] for r in digests(df).collect()}
    assert got == expected(rows)
    assert digests(df.limit(0)).count() == 0 and format_conversations(df.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    convs = with_probe(table(spark, sf_dir, "conversations"))
    got = {r.conv_id: tuple(r)[1:5] for r in digests(convs).collect()}
    assert got == expected([tuple(r) for r in convs.select("conv_id", "turn", "role", "text").collect()])
    assert got[-1][0] == 2 and got[-1][2] == len(PROBE)


def test_sql_twin_on_odd_texts(spark):
    import duckdb
    import pandas as pd

    from residua.llm.chat import oracle_sql

    texts = ["a\\b", "[INST] x </s>", "[[INST]]", "<<SYS>>\\", "", "é[/ROLE]", "[ROLE a] \\]"]
    rows = [(i // 2, i % 2, ["user", "assistant", "tool]", "x\\"][i % 4], t) for i, t in enumerate(texts)]
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
    con = duckdb.connect()
    con.register("conversations", frame)
    names = "conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_errors"
    df = with_probe(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(map(tuple, digests(df).collect())) == sorted(con.sql(f"SELECT {names} FROM ({oracle_sql()})").fetchall())
