import random

import pytest
from pyspark.sql import functions as F

from notewright.plans.tournament import export_tournament
from notewright.operators.quiz import choice_items, cross_dataset_items, eliminations, tournament_report, value_ring, winner


def test_choice_items_with_a_hot_answer(spark):
    rows = [("d", i, f"p{i}", "hot" if i % 3 else f"v{i % 20}") for i in range(300)] + [("tiny", 1, "a", "one"), ("tiny", 2, "b", "two")]
    rows += [("single", 5, "a", "only"), ("d", 999, "no answer", None)]
    frame = spark.createDataFrame(rows, "dataset string, ord bigint, p string, a string").select(
        "dataset", "ord", F.map_filter(F.create_map(F.lit("P"), "p", F.lit("A"), "a"), lambda k, v: v.isNotNull()).alias("text")
    )
    items = choice_items(frame, "P", "A", options=5, chunk_bits=58).collect()
    assert len([r for r in items if r["dataset"] == "d"]) == 300
    values = {a for _, _, _, a in rows}
    for row in items:
        assert len(set(row["options"])) == len(row["options"]) and row["answer"] in row["options"]
        assert set(row["options"]) <= values
        assert len(row["options"]) == (5 if row["dataset"] == "d" else 2)
    assert not [r for r in items if r["dataset"] == "single"]  # one value leaves nothing to choose from
    places = {r["options"].index(r["answer"]) for r in items if r["dataset"] == "d"}
    assert places == {0, 1, 2, 3, 4}
    with pytest.raises(ValueError):
        choice_items(frame, "P", "A", options=6)


def test_ring_gives_each_value_others(spark):
    values = spark.createDataFrame([("d", f"v{i}") for i in range(50)] * 2, "dataset string, value string")
    ring = value_ring(values, "dataset", "value", 3, chunk_bits=57).collect()
    assert len(ring) == 150 and all(r["value"] != r["option"] for r in ring)
    assert len({(r["value"], r["option"]) for r in ring}) == 150


@pytest.mark.parametrize("short", [200_000, 5])
def test_cross_dataset_items(spark, monkeypatch, short):
    monkeypatch.setattr("notewright.operators.quiz.SHORT_DATASET", short)
    rows = [(name, i, f"{name}-{i}", {"T": f"{name} text {i}"}) for name, n in (("a", 40), ("b", 7), ("c", 3), ("other", 9)) for i in range(n)]
    frame = spark.createDataFrame(rows, "dataset string, ord bigint, id string, text map<string,string>")
    items = cross_dataset_items(frame, "a", "T", ["a", "b", "c"]).collect()
    assert len(items) == 120 and {r["dataset"] for r in items} == {"a", "b", "c"}
    for item in range(40):
        mine = [r for r in items if r["item"] == item]
        assert sorted(r["place"] for r in mine) == [1, 2, 3]
        right = [r for r in mine if r["correct"]]
        assert [r["id"] for r in right] == [f"a-{item}"] and right[0]["prompt"] == f"a text {item}"


@pytest.mark.parametrize("bits", [1, 3, 17])
def test_elimination_across_runs(spark, bits):
    rng = random.Random(9)
    rows, expected = [], {}
    for user in range(30):
        out, before = None, False
        for round in sorted(rng.sample(range(200), 40)):
            wrong = rng.random() < 0.2
            rows.append((user, round, not wrong))
            if wrong and before and out is None:
                out = round
            before = wrong
        expected[user] = out
    rows += [(99, r, True) for r in range(10)]
    expected[99] = None
    answers = spark.createDataFrame(rows, "participant int, round int, correct boolean").repartition(6)
    got = {r["participant"]: r["eliminated_round"] for r in eliminations(answers, chunk_bits=bits).collect()}
    assert got == expected
    report = tournament_report(answers, chunk_bits=bits)
    assert report.count() == 31
    best = winner(report).first()
    scores = {u: sum(c for p, _, c in rows if p == u) for u in expected}
    top = max((u for u in expected if expected[u] is None), key=lambda u: (scores[u], -u))
    assert (best["participants"], best["winner"], best["winner_score"]) == (31, top, scores[top])


def test_export(spark, tmp_path):
    answers = spark.createDataFrame(
        [("ann", 1, 7, "x", True), ("bob", 1, 7, "y", False), ("bob", 2, 8, "y", False)],
        "participant string, round int, question_id bigint, answer string, correct boolean",
    )
    export_tournament(answers, str(tmp_path / "out"))
    read = lambda name: spark.read.csv(str(tmp_path / "out" / name), header=True).collect()
    assert len(read("answers")) == 3 and {r["participant"]: r["eliminated_round"] for r in read("report")} == {"ann": None, "bob": "2"}
    assert read("outcome")[0]["winner"] == "ann"
