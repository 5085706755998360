"""Which SQL text may run over the published tables: one query, over them, with harmless functions.

The text is parsed by Spark on its own, before anything runs, and again looked at once Spark has
resolved it. Both plans may hold only the kinds of node that a query needs, all relations must be
published views (or parts of the query itself), and functions must be built in and belong to a
group that only computes values. Everything not named here is refused: commands, file
and catalog tables, scripts, generated ranges, recursion, identifiers made at run time, reflection,
functions that read the session or its files, and functions a user has registered.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

# Kinds of plan node, as parsed and as resolved.
NODES = frozenset(
    """Project Filter Aggregate Join Sort GlobalLimit LocalLimit Offset Distinct Union Except Intersect SubqueryAlias Window
    WithWindowDefinition Expand Generate LateralJoin Pivot Unpivot OneRowRelation LocalRelation WithCTE CTERelationDef CTERelationRef
    UnresolvedWith UnresolvedHaving UnresolvedRelation UnresolvedInlineTable UnresolvedSubqueryColumnAliases
    UnresolvedTVFAliases View ResolvedInlineTable AsOfJoin""".split()
)
# Groups of built-in functions that only compute values.
GROUPS = frozenset(
    """agg_funcs array_funcs bitwise_funcs collection_funcs conditional_funcs conversion_funcs date_funcs datetime_funcs generator_funcs hash_funcs
    json_funcs lambda_funcs map_funcs math_funcs predicate_funcs string_funcs struct_funcs window_funcs""".split()
)
# Expressions that name functions or tables at run time, or call outside code.
OUTSIDE = frozenset(
    "ExpressionWithUnresolvedIdentifier NamedParameter PosParameter PythonUDF PythonUDAF ScalaUDF ScalaUDAF ScalaAggregator "
    "UnresolvedTableValuedFunction PythonUDTF UnresolvedPolymorphicPythonUDTF CallMethodViaReflection TryReflect".split()
)


class Refused(ValueError):
    """The text is not a query that may run; the message says why."""


def _each(seq) -> Iterator:
    for i in range(seq.size()):
        yield seq.apply(i)


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _expressions(seq) -> Iterator:
    stack = list(_each(seq))
    while stack:
        expression = stack.pop()
        yield expression
        stack.extend(_each(expression.children()))


class Guard:
    """The check of one text against the views that it may read."""

    def __init__(self, spark: SparkSession, tables: Iterable[str]):
        self.spark, self.tables = spark, {t.lower() for t in tables}
        self.state = spark._jsparkSession.sessionState()
        self.identifier = spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier
        self.queries = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.expressions.PlanExpression")

    def check_function(self, parts: list[str]) -> None:
        name = ".".join(parts)
        held = self.state.functionRegistry().lookupFunction(self.identifier(parts[-1].lower()))
        if len(parts) > 1 or held.isEmpty():
            raise Refused(f"function {name} is not built in")
        info = held.get()
        if info.getSource() != "built-in" or info.getGroup() not in GROUPS:
            raise Refused(f"function {name} is not allowed")

    def refused_class(self, expression) -> bool:
        """Whether an expression is what a function of a group that is not allowed resolves to."""
        name = expression.prettyName()
        held = self.state.functionRegistry().lookupFunction(self.identifier(name.lower()))
        if held.isEmpty():
            return False
        info = held.get()
        same = info.getClassName() == expression.getClass().getName()
        return same and info.getGroup() not in GROUPS and info.getGroup() != ""

    def check(self, plan, resolved: bool) -> None:
        """Refuse the plan unless all its nodes, relations and functions are allowed."""
        stack = [plan]
        while stack:
            node = stack.pop()
            kind = _kind(node)
            if kind not in NODES:
                raise Refused(f"{kind} is not part of a query")
            if kind == "View":
                # what a view is made of is its publisher's affair
                if not node.isTempView() or node.desc().identifier().table().lower() not in self.tables:
                    raise Refused(f"{node.desc().identifier().unquotedString()} is not a published table")
                continue
            if kind == "UnresolvedRelation" and node.multipartIdentifier().size() != 1:
                raise Refused(f"{node.multipartIdentifier().mkString('.')} is not a published table")
            if kind == "UnresolvedWith":
                if node.allowRecursion():
                    raise Refused("a query may not be recursive")
                stack.extend(pair._2() for pair in _each(node.cteRelations()))
            for expression in _expressions(node.expressions()):
                self.check_expression(expression, resolved)
                if self.queries.isInstance(expression):
                    stack.append(expression.plan())
            stack.extend(_each(node.children()))

    def check_expression(self, expression, resolved: bool) -> None:
        kind = _kind(expression)
        if kind in OUTSIDE or "hive" in expression.getClass().getName():
            raise Refused(f"{kind} is not allowed")
        if kind == "UnresolvedFunction":
            self.check_function(list(_each(expression.nameParts())))
        elif resolved and self.refused_class(expression):
            raise Refused(f"function {expression.prettyName()} is not allowed")

    def run(self, text: str) -> DataFrame:
        try:
            parsed = self.state.sqlParser().parsePlan(text)
        except Exception as error:
            raise Refused(f"not one SQL statement: {_first_line(error)}") from error
        self.check(parsed, False)
        try:
            rows = self.spark.sql(text)
        except PySparkException as error:
            raise Refused(f"does not resolve: {_first_line(error)}") from error
        self.check(rows._jdf.queryExecution().analyzed(), True)
        return rows


def _first_line(error: Exception) -> str:
    cause = getattr(error, "java_exception", None)
    return str(cause.getMessage() if cause is not None else error).strip().split("\n")[0]


def guarded(spark: SparkSession, text: str, tables: Iterable[str]) -> DataFrame:
    """The rows of one query over ``tables`` (names of temporary views), or ``Refused``."""
    return Guard(spark, tables).run(text.strip().rstrip(";").rstrip())
