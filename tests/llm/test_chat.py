import hashlib

import pytest

from notewright.llm import chat
from notewright.llm.queries import QUERIES

NODES = "tree long, node long, parent long, role string, text string, score double, t string"
CONVERSATIONS = "conv_id long, turn long, role string, text string, l string"


def formatted(spark, rows):
    out = chat.format_trees(spark.createDataFrame(rows, NODES))
    out = out.select(
        "*",
        chat.read_turns(out.formatted).alias("turns"),
        chat.read_loss(out.formatted, out.loss_spans).alias("loss"),
    )
    return sorted(out.collect(), key=lambda r: (r.tree or 0, r.branch))


def test_branches_ranked_and_shared_loss_once(spark):
    rows = [
        (1, 10, None, "user", "q", 0.0, "x"),
        (1, 11, 10, "assistant", "a<|im_end|>", 1.0, "x"),
        (1, 12, 11, "user", "more\n", 0.5, "x"),
        (1, 13, 12, "assistant", "b1", 1.0, "x"),
        (1, 14, 12, "assistant", "b2", 3.0, "x"),
        (1, 15, 10, "assistant", "c<||", None, "x"),
        (2, 1, 99, None, None, None, "x"),
    ]
    best, second, third, lone = formatted(spark, rows)
    assert [t.text for t in best.turns] == ["q", "a<|im_end|>", "more\n", "b2"]
    assert best.loss == ["a<|im_end|>", "b2"] and second.loss == ["b1"]
    assert [t.text for t in third.turns] == ["q", "c<||"] and third.loss == ["c<||"]
    assert (best.path_score, second.path_score, third.path_score) == (4.5, 2.5, 0.0)
    assert [(t.role, t.text) for t in lone.turns] == [("", "")] and lone.loss == []


def test_long_chain_in_few_rounds(spark):
    rows = [(5, k, k - 1 if k else None, "user", str(k), 0.0, "") for k in range(100)]
    (only,) = formatted(spark, rows)
    assert [t.text for t in only.turns] == [str(k) for k in range(100)]


def test_cycle_is_an_error(spark):
    rows = [(1, 1, 2, "u", "a", 0.0, ""), (1, 2, 1, "u", "b", 0.0, "")]
    with pytest.raises(ValueError):
        formatted(spark, rows)


def test_empty(spark):
    assert formatted(spark, []) == []


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_round_trip(spark, sf_of):
    rows = [
        (1, 0, "user", None, "x"),
        (1, 1, "assistant", "é<|<||🙂\n", "x"),
        (1, 1, "assistant", "é<|<||🙂\n", "x"),
        (None, None, None, "<|im_start|>", "x"),
        (2, 0, "as\nsist<|br|>ant", "y" * 20000, "x"),
        (3, 0, "assistant", "", "x"),
    ]
    folder = sf_of(conversations=spark.createDataFrame(rows, CONVERSATIONS))
    got = {r.conv_id: r for r in QUERIES["op8_chat"](spark, folder).collect()}
    want = {1: rows[:3], None: rows[3:4], 2: rows[4:5], 3: rows[5:]}
    for conv, turns in want.items():
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns))
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), sha(loss))
    assert got[-1].n_turns == 2 and len(got) == 5
