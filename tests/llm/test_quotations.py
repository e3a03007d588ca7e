import pytest

from tapewire.llm import quotations
from tapewire.llm.quotations import link_quotations

SCHEMA = "conv_id long, turn long, role string, text string"


def test_a_conversation(spark):
    rows = [
        (1, 0, "a", "Shall we meet?\nOn Monday."),
        (1, 1, "b", "> Shall we meet?\n> On  MONDAY!\nYes."),
        (1, 2, "c", ">> Shall we meet?\n> Yes.\nGood, then."),
        (1, 3, "d", "Something else"),
        (1, 4, "a", "> Something else\n> Yes.\n>never said\n\nWhat?\n> "),
        (2, 0, "a", "> Something else\nnot of this conversation"),
        (1, 5, "e", "> later words\nSee."),
        (1, 6, "f", "later words"),
    ]
    out = link_quotations(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "turn").collect()
    assert [tuple(r)[3:] for r in out] == [
        (None, 0, 0, 0, 0, "Shall we meet?\nOn Monday."),
        (0, 0, 1, 2, 2, "Yes."),
        (1, 0, 2, 2, 2, "Good, then."),
        (None, 3, 0, 0, 0, "Something else"),
        (3, 3, 1, 3, 2, "What?"),
        (None, 5, 0, 1, 0, "See."),
        (None, 6, 0, 0, 0, "later words"),
        (None, 0, 0, 1, 0, "not of this conversation"),
    ]


@pytest.mark.parametrize("turns", [1000, 7])
def test_a_long_conversation_with_one_line(spark, monkeypatch, turns):
    monkeypatch.setattr(quotations, "TURNS", turns)
    rows = [(1, t, "a", "thanks" if t % 3 else "> thanks\nwelcome") for t in range(200)]
    rows += [(2, t, "a", ("" if t == 0 else f"> line {t - 1}\n") + f"line {t}") for t in range(150)]
    out = {(r.conv_id, r.turn): r for r in link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}
    for (conv, turn), row in out.items():
        if conv == 1:
            assert row.parent == (turn - 1 if turn and turn % 3 == 0 else None)
        else:
            assert (row.parent, row.thread, row.level) == (turn - 1 if turn else None, 0, turn)


def test_odd_rows(spark):
    rows = [
        (None, 0, "a", "x"), (1, None, "a", "> x"), (1, 0, None, None), (1, 1, "a", ""),
        (1, 2, "a", "x y"), (1, 2, "a", "x y"), (1, 3, "b", "> x y\n" + "> long " * 9000 + "\nz"),
        (1, 3, "b", "> x y\nother"), (1, 4, "a", "> ...\n>\n"),
    ]
    table = spark.createDataFrame([(*r, 1, "q") for r in rows], SCHEMA + ", parent int, hash string")
    out = link_quotations(table)
    found = sorted(map(tuple, out.collect()), key=str)
    assert len(found) == len(rows)
    assert {(r.turn, r.parent, r.thread) for r in out.collect() if r.conv_id == 1 and r.turn} == {
        (1, None, 1), (2, None, 2), (3, 2, 2), (4, None, 4)
    }
    assert [r.text for r in out.where("conv_id is null or turn is null").orderBy("conv_id").collect()] == ["x", ""]
    assert link_quotations(table.limit(0)).collect() == []
