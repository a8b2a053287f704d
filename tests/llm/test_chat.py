import hashlib

from linkweave.llm import chat
from linkweave.llm.queries import MARKS, QUERIES

SCHEMA = "tree long, node long, parent long, role string, text string, score double, leaf int, ROLE2 string"


def messages(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).withColumnRenamed("ROLE2", "ROLE")


def paths(spark, rows, best=None):
    out = {}
    for r in chat.format_trees(messages(spark, rows), best).collect():
        out.setdefault((r.tree, r.leaf, r["rank"]), []).append((-r.up, r.piece))
    return {k: "".join(p for _, p in sorted(v)) for k, v in out.items()}


def turn(role, text):
    return chat.START + role + chat.MIDDLE + text + chat.STOP


def test_branches_ranked_and_listed(spark):
    rows = [
        (1, 1, None, "user", "q", 1.0), (1, 2, 1, "assistant", "a", 0.0), (1, 3, 1, "assistant", "b", 4.0),
        (1, 4, 3, "user", "c", 1.0), (1, 5, 99, "user", "its parent is not there", 9.0), (2, 1, None, None, None, None),
    ]
    got = paths(spark, rows)
    assert got == {
        (1, 2, 3): turn("user", "q") + turn("assistant", "a"),
        (1, 4, 2): turn("user", "q") + turn("assistant", "b") + turn("user", "c"),
        (1, 5, 1): turn("user", "its parent is not there"),
        (2, 1, 1): turn("", ""),
    }
    assert paths(spark, rows, best=1).keys() == {(1, 5, 1), (2, 1, 1)}


def test_circles_repeats_and_nulls(spark):
    rows = [
        (1, 1, 2, "user", "x", 0.0), (1, 2, 1, "user", "y", 0.0), (1, 3, 2, "user", "on a tail", 0.0),
        (1, 7, None, "user", "root", 0.0), (1, 7, None, "user", "root", 0.0), (None, 1, None, "user", "z", 0.0),
        (1, None, 7, "user", "z", 0.0), (1, 8, 8, "user", "itself", 0.0),
    ]
    assert paths(spark, rows) == {(1, 7, 1): turn("user", "root")}
    assert paths(spark, []) == {}


def test_deep_chain(spark):
    rows = [(1, i, i - 1 if i else None, "user", str(i), 0.0) for i in range(300)]
    assert paths(spark, rows) == {(1, 299, 1): "".join(turn("user", str(i)) for i in range(300))}


def test_control_strings_are_escaped_and_come_back(spark):
    texts = [*chat.CONTROLS, "".join(chat.CONTROLS), "\\", "\\\\", "\\<|im_end|>", "<\\|im_end|>", "<<s>", "a\n\\", "[[INST]"]
    rows = [(i, 1, None, "assistant", t, 0.0) for i, t in enumerate(texts)]
    for (i, _, _), whole in paths(spark, rows).items():
        inner = whole[len(chat.START + "assistant" + chat.MIDDLE):-len(chat.STOP)]
        assert not any(c in inner for c in chat.CONTROLS)
        assert chat.unescape(inner) == texts[i]


def expected(rows):
    """rows: (conv_id, turn, role, text)"""
    out = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(conv, []).append((role or "", text or ""))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return {
        conv: (
            len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)),
            sum(len(t) for r, t in turns if r == "assistant"), digest("".join(t for r, t in turns if r == "assistant")),
        )
        for conv, turns in out.items()
    }


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", MARKS), (-1, 1, "assistant", MARKS)]
    got = QUERIES["op6_reply_trees"](spark, "/root/testdata/sf0.001").collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == expected(rows)
    assert len(got) == len({r[0] for r in rows})


def test_chains_with_nulls_ties_and_repeats(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", "same turn"), (1, 2, None, "no role"),
        (2, None, "user", "no turn"), (2, 5, "assistant", "x" * 200_000), (2, 5, "assistant", "x" * 200_000),
    ]
    df = spark.createDataFrame([*rows, (None, 1, "user", "no conversation")], "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_trees(chat.chains(df))).collect()
    fixed = [(c, -1 if t is None else t, r, x) for c, t, r, x in rows]
    assert {r.tree: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected(fixed)
