from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera.operators import scoring as s

W, G, R, C = s.WAREHOUSE_TOOL, s.GEODATA_TOOL, s.REVIEW_TOOL, s.CONTEXT_TOOL


@pytest.mark.parametrize(
    "tools, route",
    [
        ([W], "warehouse"),
        ([G, G], "geodata"),
        ([R], "semantic"),
        ([C], "semantic"),
        ([G, W], "geodata+warehouse"),
        ([W, C], "warehouse+semantic"),
        ([G, R], "geodata"),
        ([G, W, R], "mixed"),
        ([], "mixed"),
    ],
)
def test_route_taken(spark, tools, route):
    assert spark.createDataFrame([(tools,)], "t array<string>").select(s.route_taken(F.col("t"))).first()[0] == route


@pytest.mark.parametrize("called, expected, score", [([W, W], [W, G], 0.5), ([], [], 1.0), ([R], [W], 0.0), ([W, G], [W, G], 1.0)])
def test_coverage(spark, called, expected, score):
    frame = spark.createDataFrame([(called, expected)], "a array<string>, b array<string>")
    assert frame.select(s.tool_coverage(F.col("a"), F.col("b"))).first()[0] == score


@pytest.mark.parametrize(
    "context, answer, score",
    [
        ("rows 36445", "There are 36,445 listings", 1.0),
        ("4.82 and 7", "4.82 of 9", 0.5),
        ("1", "no numbers", -1.0),
        ("", "3", 0.0),
        ("1 2", "1 2 3", 0.67),
        ("1", "1 2 3 4 5 6 7 8", 0.12),
    ],
)
def test_grounding(spark, context, answer, score):
    frame = spark.createDataFrame([(context, answer)], "c string, a string")
    assert frame.select(s.numeric_grounding(F.col("c"), F.col("a"))).first()[0] == score


def test_scores_dispatch_by_route(spark):
    runs = spark.createDataFrame(
        [
            (1, 1, "semantic", [R], [R], [], "1", "2", 0.7, 1.0),
            (2, 1, "semantic", [R], [R], [], "1", "1", None, 2.0),
            (3, 2, "geodata", [G], [G], [G], "1", "1", 0.0, 3.0),
            (4, 2, "warehouse", [W], [], [], "1", "none", 0.0, 4.0),
        ],
        "id int, difficulty int, expected_route string, expected_tools array<string>, tools_called array<string>,"
        " failed_tools array<string>, context string, answer string, judge_score double, elapsed_seconds double",
    )
    scored = s.score_runs(runs)
    got = {r.id: r for r in scored.collect()}
    assert [got[i].faithfulness for i in (1, 2, 3, 4)] == [0.7, -1.0, 1.0, -1.0]
    # a failed call still counts as the route and as covered; tool_success tells
    assert (got[3].route_accuracy, got[3].tool_coverage, got[3].tool_success) == (1.0, 1.0, 0.0)
    summary = s.run_summary(scored).first()
    assert (summary.n, summary.avg_faithfulness, summary.avg_elapsed_s) == (4, 0.85, 2.5)
    assert s.run_summary(s.chosen_runs(scored, ids=[4])).first().avg_faithfulness is None
    assert s.chosen_runs(scored, difficulty=2).count() == 2
    assert s.run_breakdown(scored, "difficulty").count() == 2


def test_contexts(spark):
    results = spark.createDataFrame(
        [(1, 2, R, "b" * 600), (1, 1, W, "a")], "id int, position int, tool string, result string"
    )
    contexts = s.scored_context(results)
    assert contexts.first().context == f"[{W}]\na\n\n[{R}]\n" + "b" * 600
    assert s.scored_context(results, chars=500).first().context == f"[{W}]\na\n\n[{R}]\n" + "b" * 500
    asked = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(s.context_or_default(asked, contexts).filter("id = 2")) == [(2, "(no tool results)")]


def test_answer_context_limits_and_skips_failures(spark):
    entries = [(1, W, 0, n, None, "k", n + 0.129, None) for n in range(1, 20)]
    entries += [(1, R, 1, n, None, None, None, "d" * 400) for n in range(1, 8)] + [(1, G, 2, 1, "timeout", "x", 1.0, None)]
    frame = spark.createDataFrame(entries, "id int, tool string, call int, rank int, error string, label string, amount double, document string")
    whole = s.answer_context(frame).first().context
    assert len(whole.split("\n\n---\n\n")[0].split("\n")) == 20 and "d" * 400 in whole
    text = s.answer_context(frame, rows={W: 15, R: 5}, chars=300).first().context
    first, second = text.split("\n\n---\n\n")
    assert first.split("\n")[0] == f"[{W}]" and first.split("\n")[1] == "k: 1.13" and len(first.split("\n")) == 16
    assert second == f"[{R}]\n" + "\n".join(["d" * 300] * 5)


@pytest.mark.parametrize(
    "question, planned, route",
    [
        ("best restaurant in town", "warehouse", "geodata"),
        ("best restaurant in town", "geodata+warehouse", "geodata+warehouse"),
        ("restaurant density and occupancy", "semantic", "geodata+warehouse"),
        ("what do guests say", "semantic", "semantic"),
        ("what do guests say", "nonsense", "warehouse"),
        ("what do guests say", None, "warehouse"),
        ("Places Near me", "semantic", "geodata"),
        ("occupancy by season", "warehouse+semantic", "warehouse+semantic"),
    ],
)
def test_route_labels(spark, question, planned, route):
    frame = spark.createDataFrame([(question, planned)], "q string, p string")
    assert s.route_labels(frame, "q", "p").first().route == route


def test_pairs_need_the_next_turn(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"), (2, 0, "user", "q3"), (2, 2, "assistant", "late")],
        "conv_id int, turn int, role string, text string",
    )
    assert rows(s.question_answer_pairs(turns)) == [(1, 1, "q1", "a1"), (1, 3, "q2", None), (2, 0, "q3", None)]


def test_summarised_rows(spark):
    rows_in = spark.createDataFrame(
        [(n, n + 0.126, [0.555, 1.0], (2.346,), (1.0, 2.0)) for n in range(20)],
        "n int, score double, parts array<double>, inner struct<x:double>, geometry struct<lon:double, lat:double>",
    )
    got = s.summarised_rows(rows_in, W, [F.col("n").desc()], 15).orderBy("rank").collect()
    assert len(got) == 15 and got[0].piece == '{"n":19,"score":19.13,"parts":[0.56,1.0],"inner":{"x":2.35}}'
    assert s.summarised_rows(rows_in, G, [F.col("n")], 8).count() == 8
    texts = spark.createDataFrame([(n, "d" * 400) for n in range(9)], "id int, document string")
    got = s.summarised_rows(texts, R, [F.col("id")], 5, 300).collect()
    assert len(got) == 5 and all(r.piece == "d" * 300 for r in got)
