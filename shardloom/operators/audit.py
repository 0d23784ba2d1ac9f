"""Recorded tool calls evaluated again and compared with their recorded output."""

from __future__ import annotations

import ast
import operator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.functions.text import count_of

# Words that make a string call unsafe.
UNSAFE_WORDS = (
    "__", "import", "exec", "eval", "compile", "open", "file", "input", "raw_input",
    "globals", "locals", "vars", "dir", "getattr", "setattr", "delattr", "hasattr",
)
# Plain counts of one literal in another stay in Spark; other string calls go through Arrow.
_COUNT_CALL = r"""^\s*(?:'([^']*)'|"([^"]*)")\.count\(\s*(?:'([^']*)'|"([^"]*)")\s*\)\s*\z"""
_STRING_METHODS = ("capitalize", "casefold", "count", "lower", "lstrip", "rstrip", "strip", "swapcase", "title", "upper")
_OPERATIONS = {
    ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul,
    ast.Div: operator.truediv, ast.FloorDiv: operator.floordiv,
    ast.UAdd: operator.pos, ast.USub: operator.neg,
}


def _value(node: ast.AST):
    if isinstance(node, ast.Constant) and type(node.value) in (int, float):
        return node.value
    if isinstance(node, ast.UnaryOp):
        return _OPERATIONS[type(node.op)](_value(node.operand))
    if isinstance(node, ast.BinOp):
        return _OPERATIONS[type(node.op)](_value(node.left), _value(node.right))
    raise ValueError("not arithmetic")


def arithmetic(expression: str | None) -> str | None:
    """Result of + - * / // and brackets on numbers, as text; null when malformed."""
    if expression is None:
        return None
    try:
        return str(_value(ast.parse(expression.strip(), mode="eval").body))
    except (SyntaxError, ValueError, KeyError, ArithmeticError, RecursionError, MemoryError):
        return None


def _text_value(node: ast.AST):
    """A string literal, or a method of one; integers may be arguments."""
    if isinstance(node, ast.Constant) and type(node.value) in (str, int):
        return node.value
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and not node.keywords:
        owner = _text_value(node.func.value)
        if node.func.attr in _STRING_METHODS and isinstance(owner, str):
            return getattr(owner, node.func.attr)(*map(_text_value, node.args))
    raise ValueError("not a string call")


def string_call(expression: str | None) -> str | None:
    """Result of methods on string literals, as text; null when malformed."""
    if expression is None:
        return None
    try:
        return str(_text_value(ast.parse(expression.strip(), mode="eval").body))
    except (SyntaxError, ValueError, TypeError, RecursionError, MemoryError):
        return None


def _by_distinct(expressions: pa.Array, evaluate) -> pa.Array:
    distinct = expressions.dictionary_encode()
    results = pa.array([evaluate(e) for e in distinct.dictionary.to_pylist()], pa.string())
    return results.take(distinct.indices)


@F.arrow_udf(T.StringType())
def _arithmetic_column(expressions: pa.Array) -> pa.Array:
    return _by_distinct(expressions, arithmetic)


@F.arrow_udf(T.StringType())
def _string_column(expressions: pa.Array) -> pa.Array:
    return _by_distinct(expressions, string_call)


def call_result(df: DataFrame, call: str, out: str = "result") -> DataFrame:
    """Result of each call, null when it is not allowed or fails.

    Plain letter counts stay in Spark expressions; arithmetic and other calls that
    end in a count go through Arrow. Patterns hold to the very end of the text.
    """
    text = F.replace(F.col(call), F.lit(","), F.lit(""))
    numeric = text.rlike(r"^[0-9*+\-/.() ]*\z")
    unsafe = F.lit(False)
    for word in UNSAFE_WORDS:
        unsafe = unsafe | F.contains(F.lower(text), F.lit(word))
    allowed = text.rlike(r"""^[a-zA-Z0-9'"()._ ]*\z""") & ~unsafe & F.contains(text, F.lit(".count("))
    countable = allowed & text.rlike(_COUNT_CALL)
    group = lambda i: F.regexp_extract(text, _COUNT_CALL, i)
    counted = count_of(F.concat(group(1), group(2)), F.concat(group(3), group(4))).cast("string")
    to_compute = F.when(numeric & ~F.contains(text, F.lit("**")), text)
    return df.withColumn(
        out,
        F.when(numeric, _arithmetic_column(to_compute))
        .when(countable, counted)
        .when(allowed, _string_column(F.when(allowed & ~countable, text))),
    )


def tool_calls(conversations: DataFrame) -> DataFrame:
    """Every call with the output part that follows it.

    Outer generators: plain ones would make the optimizer build the messages a
    second time just to skip empty arrays.
    """
    message = conversations.select("task", "idx", F.explode_outer("messages").alias("m"))
    parts = message.select("task", "idx", F.col("m")["parts"].alias("parts"))
    placed = parts.select("task", "idx", "parts", F.posexplode_outer("parts").alias("part_no", "part"))
    after = F.get("parts", F.col("part_no") + 1)
    return placed.where(F.col("part")["type"] == "python").select(
        "task", "idx", "part_no", F.col("part")["text"].alias("call"),
        F.when(after["type"] == "python_output", after["text"]).alias("recorded"),
    )


def audit_tool_calls(conversations: DataFrame) -> DataFrame:
    """Each call with its result and a verdict: match, mismatch or rejected."""
    results = call_result(tool_calls(conversations), "call")
    as_double = lambda c: F.expr(f"try_cast({c} as double)")
    same = F.coalesce(
        (F.col("recorded") == F.col("result")) | (as_double("recorded") == as_double("result")), F.lit(False)
    )
    return results.withColumn(
        "verdict",
        F.when(F.col("result").isNull(), "rejected").when(same, "match").otherwise("mismatch"),
    )
