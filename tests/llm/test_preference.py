"""Preference pairs by hand and the cases of their docstring."""

from waybill.llm import preference

TURNS = "conv_id long, turn int, role string, text string, chosen string, n int"
T = [("user", "hi"), ("assistant", "yo"), ("user", "more"), ("assistant", "sure")]


def pair(spark, chosen, rejected):
    df = spark.createDataFrame([(1, chosen, rejected)], "pair_id int, chosen array<struct<role:string,text:string>>, "
                                                        "rejected array<struct<role:string,text:string>>")
    return preference.formatted(df).first()


def test_prompt_is_rendered_once_and_masks_cover_answers(spark):
    row = pair(spark, T, [*T[:3], ("assistant", "no ñ"), ("user", "why"), ("assistant", "")])
    assert row["pair_id"] == 1 and row["prompt_turns"] == 3
    assert row["prompt"] == "<|user|>\nhi<|end|>\n<|assistant|>\nyo<|end|>\n<|user|>\nmore<|end|>\n"
    assert row["chosen_text"] == "<|assistant|>\nsure<|end|>\n"
    trained = [row["rejected_text"][s["start"]:s["stop"]] for s in row["rejected_mask"]]
    assert trained == ["no ñ", ""] and row["rejected_text"].count("why") == 1
    assert [row["chosen_text"][s["start"]:s["stop"]] for s in row["chosen_mask"]] == ["sure"]


def test_prefix_ends(spark):
    assert pair(spark, T, T[:2])["prompt_turns"] == 2 and pair(spark, T, T[:2])["rejected_text"] == ""
    assert pair(spark, T, [])["prompt"] == "" and pair(spark, [], [])["prompt_turns"] == 0
    assert pair(spark, T, [("assistant", "hi"), *T[1:]])["prompt_turns"] == 0


def test_pairs(spark):
    def turns(conv, said, start=0):
        return [(conv, start + i, r, t, "c", 1) for i, (r, t) in enumerate(said)]

    other = [T[0], ("assistant", "else")]
    rows = (turns(1, T) + turns(2, other) + turns(2, other) + turns(5, T) + turns(9, [("user", "alone"), ("assistant", None)])
            + turns(None, T) + turns(10, [(None, None), ("user", "x")]) + [(11, None, "user", "hi", "c", 1), (11, 3, "assistant", "yo", "c", 1)])
    frame = spark.createDataFrame(rows, TURNS)
    got = sorted((r["chosen_id"], r["rejected_id"]) for r in preference.pairs_by_opening(frame).collect())
    assert got == [(1, 2), (1, 11)]  # 5 equals 1
    swapped = preference.formatted(preference.pairs_by_answer(frame)).collect()
    assert [(r["chosen_id"], r["rejected_id"], r["prompt_turns"]) for r in swapped] == [(1, 2, 3)]
    assert swapped[0]["rejected_text"] == "<|assistant|>\nelse<|end|>\n"
    for make in (preference.pairs_by_opening, preference.pairs_by_answer):
        assert preference.formatted(make(frame.limit(0))).count() == 0


def test_openings_are_role_and_text(spark):
    rows = [(1, 0, "a\nb", "c", "c", 1), (2, 0, "a", "b\nc", "c", 1), (3, 0, "1:a", "b", "c", 1), (4, 0, "1", "ab", "c", 1),
            (1, 1, "assistant", "x", "c", 1), (2, 1, "assistant", "y", "c", 1), (3, 1, "assistant", "z", "c", 1)]
    assert preference.pairs_by_opening(spark.createDataFrame(rows, TURNS)).count() == 0


def test_a_hot_opening_can_be_split(spark):
    rows = [(i, k, *T[k % 4], "c", 1) for i in range(60) for k in range(1 + i % 3)]
    pairs = preference.pairs_by_opening(spark.createDataFrame(rows, TURNS))
    assert pairs.count() == 40
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan, plan  # the joins read stored tables
