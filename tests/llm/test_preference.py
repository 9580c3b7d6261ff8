from __future__ import annotations

from panelloom.llm import preference

SCHEMA = "pair_id long, turn long, role string, text string, part string, first string"


def side(spark, rows):
    return spark.createDataFrame([(*r, "p", "q") for r in rows], SCHEMA)


def test_prefix_is_rendered_once(spark):
    start = [(1, 0, "system", "s"), (1, 1, "user", "hi")]
    chosen = start + [(1, 2, "assistant", "good"), (1, 3, "user", "more"), (1, 4, "assistant", "yes")]
    rejected = start + [(1, 2, "assistant", "bad")]
    turns = preference.preference_turns(side(spark, chosen), side(spark, rejected))
    rows = sorted(turns.collect(), key=lambda r: (r.part, r.turn))
    assert [(r.part, r.turn) for r in rows] == [("chosen", 2), ("chosen", 3), ("chosen", 4), ("prompt", 0), ("prompt", 1), ("rejected", 2)]
    covered = {(r.part, r.turn): r.rendered[r.loss_start : r.loss_stop] for r in rows}
    end = preference.END
    assert covered == {("chosen", 2): f"good{end}", ("chosen", 3): "", ("chosen", 4): f"yes{end}", ("prompt", 0): "", ("prompt", 1): "", ("rejected", 2): f"bad{end}"}
    whole = preference.assembled(turns).first()
    assert whole.prompt == f"{preference.START}system\ns{end}\n{preference.START}user\nhi{end}\n"
    assert whole.rejected == f"{preference.START}assistant\nbad{end}\n" and whole.chosen.count(end) == 3


def test_odd_conversations(spark):
    chosen = [(1, 0, "user", "same"), (1, 0, "user", "same"), (2, 0, None, None), (2, 1, "assistant", "x"), (3, 5, "assistant", "alone"),
              (4, 0, "assistant", "first"), (None, 0, "user", "lost"), (5, None, "user", "lost"), (6, 0, "user", None), (7, 0, "user", "long " * 300_000)]
    rejected = [(1, 0, "user", "same"), (2, 0, None, None), (2, 1, "assistant", "y"), (4, 0, "assistant", "other"), (6, 0, "user", ""), (7, 0, "user", "long " * 300_000)]
    rows = preference.preference_turns(side(spark, chosen), side(spark, rejected)).collect()
    got = sorted(((r.pair_id or 0, r.part, r.turn if r.turn is not None else -1, r.loss_stop > r.loss_start) for r in rows))
    assert got == [
        (0, "unplaced", 0, False), (1, "prompt", 0, False), (2, "chosen", 1, True), (2, "prompt", 0, False), (2, "rejected", 1, True),
        (3, "chosen", 5, True), (4, "chosen", 0, True), (4, "rejected", 0, True), (5, "unplaced", -1, False), (6, "chosen", 0, False),
        (6, "rejected", 0, False), (7, "prompt", 0, False),
    ]
    assert any(r.rendered.startswith(preference.START + "unknown") for r in rows)


def test_empty_tables(spark):
    assert preference.preference_turns(side(spark, []), side(spark, [])).collect() == []
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert preference.preference_turns(*preference.reply_pairs(none)).collect() == []


def test_pairs_of_neighbours(spark):
    rows = [(0, 0, "user", "a"), (0, 1, "assistant", "A"), (0, 2, "user", "later"), (1, 0, "user", "b"), (1, 1, "assistant", "B"), (2, 0, "user", "c"), (None, 0, "assistant", "n"), (3, 0, "assistant", None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chosen, rejected = preference.reply_pairs(table)
    assert sorted(tuple(r) for r in chosen.collect()) == [(0, 0, "user", "a"), (0, 1, "assistant", "A")]
    assert sorted(tuple(r) for r in rejected.collect()) == [(0, 0, "user", "a"), (0, 1, "assistant", "B")]


def test_no_row_is_lost(spark):
    rows = [(10, 0, "user", "a"), (10, 1, "assistant", "A"), (10, 2, "user", "later"), (14, 0, "user", "none"), (17, 0, "user", "b"), (17, 1, "assistant", "B"),
            (90, 0, "user", "c"), (90, 3, "assistant", "C"), (90, 3, "assistant", "C"), (None, 0, "assistant", "n"), (95, None, "user", "n")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = preference.turns_of_all(table).collect()
    text = lambda r: r.rendered.split("\n")[1].removesuffix(preference.END)
    placed = sorted((r.pair_id, r.part, r.turn, text(r)) for r in got if r.part != "unplaced")
    assert placed == [
        (10, "chosen", 1, "A"), (10, "prompt", 0, "a"), (10, "rejected", 1, "B"), (10, "unpaired", 2, "later"), (14, "unpaired", 0, "none"),
        (17, "chosen", 1, "B"), (17, "prompt", 0, "b"), (17, "rejected", 1, "C"), (90, "chosen", 3, "C"), (90, "prompt", 0, "c"), (90, "rejected", 3, "A"),
    ]
    assert sorted(text(r) for r in got if r.part == "unplaced") == ["n", "n"]
    assert all((r.loss_stop > r.loss_start) == (r.part in ("chosen", "rejected")) for r in got)
    alone = preference.turns_of_all(table.where("conv_id = 10")).collect()
    assert [r.part for r in alone] == ["unpaired"] * 3 and preference.turns_of_all(table.where("false")).collect() == []


def test_next_reply_over_many_chunks(spark):
    ids = sorted({(k * 7919) % 100_003 for k in range(1, 300)})
    table = spark.createDataFrame([(f"{i:06d}", 1, "assistant", f"r{i}") for i in ids], "conv_id string, turn long, role string, text string")
    got = {r.pair_id: r.rendered for r in preference.turns_of_all(table).where("part = 'rejected'").collect()}
    assert {int(i): int(t.split("\n")[1].removesuffix(preference.END)[1:]) for i, t in got.items()} == dict(zip(ids, ids[1:] + ids[:1]))
