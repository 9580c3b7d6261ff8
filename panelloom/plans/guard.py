"""Which relations and functions a SQL text uses, off its parsed tree.

The text is parsed, which runs nothing, and every node of the tree is visited:
plans, expressions, and the plans of subqueries inside expressions. What is
not known to be harmless is refused: a kind of node, an expression or a
function has to be listed below. Names of WITH are resolved as the engine
does, by scope: a common table expression is visible to those after it in
its list and to the query the list belongs to, and hides a table of its name
there and nowhere else.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.errors import ParseException
from pyspark.sql import SparkSession

PLANS = set(
    """
    Aggregate Distinct Except Filter GlobalLimit Intersect Join LateralJoin LocalLimit Offset OneRowRelation Pivot Project Sort
    SubqueryAlias Union Unpivot UnresolvedHaving UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedWith
    WithWindowDefinition
    """.split()
)
SUBQUERIES = set("Exists LateralSubquery ListQuery ScalarSubquery".split())
EXPRESSIONS = SUBQUERIES | set(
    """
    Add AggregateExpression Alias And AnyValue BitwiseAnd BitwiseNot BitwiseOr BitwiseXor CaseWhen Cast Coalesce Concat
    CreateNamedStruct CreateStruct Cube CurrentRow$ Divide EqualNullSafe EqualTo First GreaterThan GreaterThanOrEqual
    GroupingSets ILike In InSubquery IntegralDivide IsNotNull IsNull IsUnknown IsNotUnknown LambdaFunction Last LessThan
    LessThanOrEqual Like LikeAll LikeAny Literal Multiply NamePlaceholder$ Not NotLikeAll NotLikeAny Or Overlay RLike
    Remainder Rollup SortOrder SpecifiedWindowFrame StringLocate StringTrim StringTrimLeft StringTrimRight Substring Subtract
    TimestampAdd TimestampDiff UnaryMinus UnaryPositive UnboundedFollowing$ UnboundedPreceding$ UnresolvedAlias
    UnresolvedAttribute UnresolvedExtractValue UnresolvedFunction UnresolvedNamedLambdaVariable UnresolvedOrdinal UnresolvedStar
    UnresolvedStarExceptOrReplace UnresolvedWindowExpression UnspecifiedFrame$ WindowExpression WindowSpecDefinition
    """.split()
)
FUNCTIONS = set(
    """
    abs any any_value approx_count_distinct array array_agg array_contains array_max array_min array_size avg between bool_and
    bool_or ceil ceiling coalesce collect_list collect_set concat concat_ws contains corr count count_if covar_pop covar_samp
    cume_dist current_date current_timestamp date date_add date_diff date_format date_sub date_trunc datediff day dayofmonth
    dayofweek dayofyear decimal dense_rank double endswith every exp extract filter first first_value floor greatest grouping
    grouping_id hour if ifnull initcap int isnan isnotnull isnull kurtosis lag last last_day last_value lcase lead least left
    len length ln log log10 log2 lower lpad ltrim make_date max max_by mean median min min_by mod mode month months_between
    named_struct nth_value ntile nullif nullifzero nvl nvl2 percent_rank percentile percentile_approx percentile_cont
    percentile_disc pmod position pow power quarter rank regexp_count regexp_extract regexp_like regexp_replace replace reverse
    right round row_number rpad rtrim sign signum size skewness some split split_part sqrt startswith std stddev stddev_pop
    stddev_samp string struct substr substring sum to_char to_date to_number trim trunc try_add try_avg try_cast try_divide
    try_subtract try_sum ucase upper var_pop var_samp variance weekofyear width_bucket year zeroifnull
    """.split()
)
# Names that are functions where no column has them, and the hidden column that tells of files.
NOT_COLUMNS = {"current_catalog", "current_database", "current_schema", "current_user", "session_user", "user", "_metadata"}


class Refused(ValueError):
    """The text is not a query that only reads what may be read."""


def _listed(found: JavaObject) -> list[JavaObject]:
    return [found.apply(i) for i in range(found.size())]


def _kind(node: JavaObject) -> str:
    return node.getClass().getSimpleName()


class _Visit:
    """Yields the relations outside the text's own WITH, as tuples of lower-case names."""

    def plan(self, node: JavaObject, known: frozenset[str]) -> Iterator[tuple[str, ...]]:
        kind = _kind(node)
        if kind not in PLANS:
            raise Refused(f"{kind} is not part of a query over named tables")
        if kind == "UnresolvedRelation":
            yield from self.relation(node, known)
        elif kind == "UnresolvedWith":
            if node.allowRecursion():
                raise Refused("recursive queries are not run")
            for one in _listed(node.cteRelations()):
                yield from self.plan(one._2(), known)
                known |= {one._1().lower()}
        elif kind == "WithWindowDefinition":
            for window in _listed(node.windowDefinitions().values().toSeq()):
                yield from self.expression(window, known)
        for expression in _listed(node.expressions()):
            yield from self.expression(expression, known)
        for child in _listed(node.children()):
            yield from self.plan(child, known)

    def relation(self, node: JavaObject, known: frozenset[str]) -> Iterator[tuple[str, ...]]:
        if node.isStreaming():
            raise Refused("streams are not read")
        name = tuple(part.lower() for part in _listed(node.multipartIdentifier()))
        if len(name) > 1 or name[0] not in known:
            yield name

    def expression(self, node: JavaObject, known: frozenset[str]) -> Iterator[tuple[str, ...]]:
        kind = _kind(node)
        if kind not in EXPRESSIONS:
            raise Refused(f"{kind} is not allowed")
        if kind == "UnresolvedFunction":
            name = ".".join(_listed(node.nameParts())).lower()
            if name not in FUNCTIONS:
                raise Refused(f"the function {name} is not allowed")
        elif kind == "UnresolvedAttribute":
            parts = {part.lower() for part in _listed(node.nameParts())}
            if parts & NOT_COLUMNS:
                raise Refused(f"not readable: {sorted(parts & NOT_COLUMNS)}")
        elif kind in SUBQUERIES:
            yield from self.plan(node.plan(), known)
        for child in _listed(node.children()):
            yield from self.expression(child, known)


def relations(spark: SparkSession, sql: str) -> set[tuple[str, ...]]:
    """The relations that the text reads, each as its parts in lower case; raises ``Refused`` for what is not a plain query."""
    try:
        tree = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except (ParseException, Py4JJavaError) as error:
        raise Refused(f"not a single reading query: {error}") from error
    return set(_Visit().plan(tree, frozenset()))


def _reads_view_or_mart(spark: SparkSession, name: str, readable: Collection[tuple[str, ...]]) -> bool:
    """Whether an unqualified name is a registered view, or stands for a readable table of the current schema."""
    catalog = spark._jsparkSession.sessionState().catalog()
    return catalog.getTempView(name).isDefined() or (spark.catalog.currentDatabase().lower(), name) in readable


def require_readable(spark: SparkSession, sql: str, readable: Collection[str]) -> None:
    """Raise ``Refused`` unless the text only reads ``readable``, names as in SQL, unquoted.

    A name without schema has to be a temporary view, or the current schema
    has to be that of a readable table: a table of another schema that
    happens to have the name of a mart is not one.
    """
    allowed = {tuple(name.lower().split(".")) for name in readable}
    found = relations(spark, sql)
    others = {name for name in found if name not in allowed or (len(name) == 1 and not _reads_view_or_mart(spark, name[0], allowed))}
    if others:
        raise Refused(f"not readable: {sorted('.'.join(name) for name in others)}")
