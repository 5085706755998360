"""Scoring of recorded question-and-answer runs, as expressions over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.nested import shared_fraction
from tessera.functions.text import contains_any, numbers_in

# Tool names.
WAREHOUSE_TOOL = "query_warehouse"
GEODATA_TOOL = "query_geodata"
REVIEW_TOOL = "search_reviews"
CONTEXT_TOOL = "get_neighbourhood_context"

# Routes, and those whose answers are graded by a judge.
ROUTES = ["warehouse", "geodata", "semantic", "geodata+warehouse", "warehouse+semantic"]
JUDGED_ROUTES = ["semantic", "warehouse+semantic"]

# Words and phrases that point to a store.
PLACE_WORDS = [
    "restaurant",
    "bar",
    "lodging",
    "tourist_attraction",
    "transit_station",
    "cafe",
    "food",
    "night_club",
    "park",
    "museum",
    "bakery",
    "subway_station",
    "meal_takeaway",
    "meal_delivery",
    "bowling_alley",
]
PLACE_PHRASES = [
    "places near",
    "near me",
    "best rated",
    "top rated",
    "highest rated",
    "where to eat",
    "where to drink",
    "venues in",
    "spots in",
]
WAREHOUSE_WORDS = [
    "occupancy",
    "listing",
    "price",
    "host",
    "review score",
    "noise",
    "complaint",
    "season",
    "how many",
    "average rating",
]

NO_RESULTS = "(no tool results)"


def route_taken(tools: Column) -> Column:
    """Route implied by the tools that were called.

    The branches are tested in this order, so geodata with a text search and no
    warehouse counts as "geodata"; only all three stores, or none, give "mixed".
    """
    warehouse = F.array_contains(tools, WAREHOUSE_TOOL)
    geodata = F.array_contains(tools, GEODATA_TOOL)
    search = F.arrays_overlap(tools, F.array(F.lit(REVIEW_TOOL), F.lit(CONTEXT_TOOL)))
    return (
        F.when(geodata & warehouse & ~search, "geodata+warehouse")
        .when(warehouse & search & ~geodata, "warehouse+semantic")
        .when(geodata & ~warehouse, "geodata")
        .when(warehouse & ~geodata, "warehouse")
        .when(search & ~warehouse & ~geodata, "semantic")
        .otherwise("mixed")
    )


def route_accuracy(tools: Column, expected: Column) -> Column:
    return F.when(route_taken(tools) == expected, 1.0).otherwise(0.0)


def tool_coverage(tools: Column, expected: Column) -> Column:
    """Share of the expected tools that were called; 1 when none is expected."""
    return F.when(F.size(expected) == 0, 1.0).otherwise(shared_fraction(tools, expected))


def numeric_grounding(context: Column, answer: Column) -> Column:
    """Share of the answer's distinct numbers that the context holds; -1 without numbers."""
    stated = numbers_in(answer)
    share = F.size(F.array_intersect(stated, numbers_in(context))) / F.nullif(F.size(stated), F.lit(0))
    return F.when(F.size(stated) == 0, -1.0).otherwise(F.bround(share, 2))


def faithfulness(route: Column, context: Column, answer: Column, judge: Column) -> Column:
    """Judge's score on the judged routes (-1 when there is none), numeric grounding elsewhere."""
    # least and greatest skip nulls, so a missing score is tested first
    judged = F.when(judge.isNull(), -1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), judge)))
    return F.when(route.isin(JUDGED_ROUTES), judged).otherwise(numeric_grounding(context, answer))


def score_runs(runs: DataFrame) -> DataFrame:
    """Scores for every run row.

    Expects expected_route, expected_tools, tools_called, failed_tools, context, answer
    and judge_score. ``tool_success`` is the share of calls that did not fail, which
    route and coverage do not look at.
    """
    called = F.size("tools_called")
    failed = F.size(F.filter("tools_called", lambda t: F.array_contains(F.col("failed_tools"), t)))
    return runs.withColumns(
        {
            "route_taken": route_taken(F.col("tools_called")),
            "route_accuracy": route_accuracy(F.col("tools_called"), F.col("expected_route")),
            "tool_coverage": F.bround(tool_coverage(F.col("tools_called"), F.col("expected_tools")), 2),
            "faithfulness": F.bround(
                faithfulness(F.col("expected_route"), F.col("context"), F.col("answer"), F.col("judge_score")), 2
            ),
            "tool_success": F.when(called == 0, 0.0).otherwise((called - failed) / F.nullif(called, F.lit(0))),
        }
    )


def chosen_runs(runs: DataFrame, ids: list[int] | None = None, difficulty: int | None = None) -> DataFrame:
    picked = runs if not ids else runs.filter(F.col("id").isin(ids))
    return picked if difficulty is None else picked.filter(F.col("difficulty") == difficulty)


def _mean_columns() -> list[Column]:
    graded = F.when(F.col("faithfulness") >= 0, F.col("faithfulness"))
    return [
        F.count(F.lit(1)).alias("n"),
        F.bround(F.avg("route_accuracy"), 2).alias("avg_route_accuracy"),
        F.bround(F.avg("tool_coverage"), 2).alias("avg_tool_coverage"),
        F.bround(F.avg(graded), 2).alias("avg_faithfulness"),
        F.bround(F.avg("elapsed_seconds"), 1).alias("avg_elapsed_s"),
    ]


def run_summary(scored: DataFrame) -> DataFrame:
    """Means over all rows; faithfulness over graded rows only, null when there are none."""
    return scored.agg(*_mean_columns())


def run_breakdown(scored: DataFrame, *by: str) -> DataFrame:
    return scored.groupBy(*by).agg(*_mean_columns())


def _shown(text: str, chars: int | None) -> Column:
    return F.col(text) if chars is None else F.substring(text, 1, chars)


def scored_context(results: DataFrame, question: str = "id", chars: int | None = None) -> DataFrame:
    """One context text per question: each result labelled, whole or its first ``chars``, in call order.

    Expects the question key, ``position``, ``tool`` and ``result``. Numbers an answer takes from a
    part that ``chars`` cuts off would count as ungrounded.
    """
    piece = F.concat(F.lit("["), F.col("tool"), F.lit("]\n"), _shown("result", chars))
    joined = _joined_in_order(F.struct(F.col("position"), piece.alias("piece")), "\n\n")
    return results.groupBy(question).agg(joined.alias("context"))


def context_or_default(questions: DataFrame, contexts: DataFrame, question: str = "id") -> DataFrame:
    """One row per question, also for those whose run returned nothing."""
    keys = questions.select(question)
    return keys.join(contexts, question, "left").withColumn("context", F.coalesce("context", F.lit(NO_RESULTS)))


def _joined_in_order(entry: Column, separator: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["piece"]), separator)


def answer_context(
    results: DataFrame, question: str = "id", rows: dict[str, int] | None = None, chars: int | None = None
) -> DataFrame:
    """What an answer is written from: the results of every tool that did not fail.

    Expects the question key, ``tool``, ``call``, ``rank`` (1-based place of the row in
    the tool's result), ``error`` and a typed ``row``: a map of text and number parts
    is given as ``label`` and ``amount``, search hits as ``document``. Geometry is not
    among the inputs. Numbers are rounded to 2 digits. ``rows`` keeps only the first rows of a
    call of the tools it names, ``chars`` only the first characters of a document.
    """
    kept = results.filter(F.col("error").isNull())
    if rows:
        limit = F.create_map(*[F.lit(x) for pair in rows.items() for x in pair])[F.col("tool")]
        kept = kept.filter(limit.isNull() | (F.col("rank") <= limit))
    record = F.concat_ws(": ", F.col("label"), F.round("amount", 2).cast("string"))
    text = F.when(F.col("tool").isin(REVIEW_TOOL, CONTEXT_TOOL), _shown("document", chars)).otherwise(record)
    per_call = (
        kept.withColumn("piece", text)
        .groupBy(question, "call", "tool")
        .agg(_joined_in_order(F.struct("rank", "piece"), "\n").alias("_body"))
        .withColumn("piece", F.concat(F.lit("["), F.col("tool"), F.lit("]\n"), F.col("_body")))
    )
    return per_call.groupBy(question).agg(_joined_in_order(F.struct("call", "piece"), "\n\n---\n\n").alias("context"))


def summarised_rows(result: DataFrame, tool: str, order: list[Column], rows: int, chars: int | None = None) -> DataFrame:
    """The first ``rows`` of one tool's result, as an answer is shown them: (rank, piece).

    JSON text with floating numbers rounded to 2 digits and without geometry; of search
    hits the document, whole or its first ``chars``.
    """
    top = result.orderBy(*order).limit(rows)
    rank = F.row_number().over(Window.orderBy(*order))
    if tool in (REVIEW_TOOL, CONTEXT_TOOL):
        piece = _shown("document", chars)
    else:
        shown = [f for f in result.schema.fields if f.name not in ("geometry", "shape", "centroid")]
        piece = F.to_json(F.struct(*[_two_digits(F.col(f.name), f.dataType).alias(f.name) for f in shown]))
    # a few rows are left here, so one window over them is enough
    return top.select(rank.alias("rank"), piece.alias("piece"))


def _two_digits(value: Column, kind: T.DataType) -> Column:
    """Floating numbers rounded to 2 digits at any depth of arrays and structs."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.round(value, 2)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _two_digits(x, kind.elementType))
    if isinstance(kind, T.StructType):
        parts = [_two_digits(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    return value


def route_labels(questions: DataFrame, text: str, planned: str) -> DataFrame:
    """Route of each question: the planned one, corrected by the words of the question.

    An unknown or missing plan counts as "warehouse". Place words without warehouse
    words make it "geodata" unless geodata is already part of it; both together make it
    "geodata+warehouse".
    """
    plan = F.when(F.col(planned).isin(ROUTES), F.col(planned)).otherwise("warehouse")
    place = contains_any(F.col(text), PLACE_WORDS + PLACE_PHRASES)
    warehouse = contains_any(F.col(text), WAREHOUSE_WORDS)
    flagged = questions.withColumns({"mentions_place": place, "mentions_warehouse": warehouse, "_plan": plan})
    only_place = F.col("mentions_place") & ~F.col("mentions_warehouse")
    both = F.col("mentions_place") & F.col("mentions_warehouse")
    route = (
        F.when(only_place & ~F.col("_plan").isin("geodata", "geodata+warehouse"), "geodata")
        .when(both, "geodata+warehouse")
        .otherwise(F.col("_plan"))
    )
    return flagged.withColumn("route", route).drop("_plan")


def question_answer_pairs(turns: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it in the same conversation, null where none follows."""
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    replied = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(replied, ["conv_id", "turn"], "left")
