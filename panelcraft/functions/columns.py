"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_number(column: Column) -> Column:
    """Cast to double; text that is no number, and NaN, become null."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` with null for a zero denominator."""
    return F.try_divide(numerator, denominator)


def null_skipping_sum(columns: Iterable[Column]) -> Column:
    """Row-wise sum that reads null as 0, so an all-null row gives 0."""
    return reduce(
        lambda left, right: left + right,
        [F.coalesce(c, F.lit(0.0)) for c in columns],
    )


def null_flag(column: Column) -> Column:
    """'1' for a null, '0' otherwise."""
    return column.isNull().cast("int").cast("string")


def period_index(timestamp: Column, unit: str) -> Column:
    """Number a date or timestamp so that consecutive periods differ by 1."""
    if unit == "month":
        return (F.year(timestamp) * 12 + F.month(timestamp)).cast("int")
    if unit == "day":
        return F.datediff(timestamp, F.lit("1970-01-01").cast("date"))
    raise ValueError(f"unknown period unit {unit!r}, expected 'month' or 'day'")


def predicate(text: str, schema: T.StructType | None = None) -> Column:
    """A user's row filter such as ``month_nbr > 1 and amt != 0``.

    Comparisons (also chained, ``in [..]`` and ``not in [..]``), ``and``,
    ``or``, ``not`` and arithmetic over columns, numbers and text. A column
    whose name is no identifier stands in backticks. A missing value makes a
    comparison false, but satisfies ``!=`` and ``not in``; ``not`` then turns
    either round, so a part of a filter is never null. The outermost comparisons
    may be, which drops the row all the same, so that scans can use them. With the table's ``schema``, text
    meets a number as the number that it spells; text that spells none differs
    from every number and is neither above nor below one.

    The text is parsed to a tree of these parts and never evaluated. The
    bitwise spellings bind differently from and/or/not, so they are refused.
    """
    quoted: dict[str, str] = {}

    def plain_name(found: re.Match) -> str:
        if found[0][0] != "`":
            return found[0]
        return quoted.setdefault(found[0], f"_quoted_{len(quoted)}")

    spelled = re.sub(r"'[^']*'|\"[^\"]*\"|`[^`]+`", plain_name, text.strip())
    # A lone = means ==.
    spelled = re.sub(r"('[^']*'|\"[^\"]*\")|(?<![=!<>])=(?!=)", lambda m: m[1] or "==", spelled)
    names = {v: k[1:-1] for k, v in quoted.items()}

    def value(node: ast.AST) -> Column | None:
        match node:
            case ast.Name(id=name):
                return F.col("`" + names.get(name, name) + "`")
            case ast.Constant(value=str() | bool() as constant):
                return F.lit(constant)
        return None

    kinds = {f.name: f.dataType for f in schema or ()}

    def kind(node: ast.AST) -> T.DataType | None:
        match node:
            case ast.Name(id=name):
                return kinds.get(names.get(name, name))
            case ast.Constant(value=str()) if kinds:
                return T.StringType()
        return None

    return _Tree(text, value, kind).test(_parsed(text, spelled), outer=True)


def keyword_flag(column: Column, words: Sequence[str], method: str = "equal") -> Column:
    """1 where the value matches a keyword, else 0 (null counts as no match).

    ``equal``: the value is one of the words; ``contain``: the value contains
    one; ``contained``: one of the words contains the value.
    """
    words = list(words)
    if method not in ("equal", "contain", "contained"):
        raise ValueError(f"unknown match method {method!r}")
    if not words:
        return F.lit(0)
    if method == "equal":
        hit = column.isin(words)
    elif method == "contain":
        hit = F.exists(F.lit(words), lambda word: F.contains(column, word))
    else:
        hit = F.exists(F.lit(words), lambda word: F.contains(word, column))
    return F.coalesce(hit.cast("int"), F.lit(0))


def _modulo(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor; null for a zero divisor."""
    rest = F.try_mod(a, b)
    return F.when((rest != 0) & ((rest < 0) != (b < 0)), rest + b).otherwise(rest)


def _floor_division(a: Column, b: Column) -> Column:
    ratio = safe_ratio(a, b)
    # From 2 ** 53 on every double is whole, and may lie beyond the integers.
    return F.when(F.abs(ratio) < 2.0**53, F.floor(ratio).cast("double")).otherwise(ratio)


_ARITHMETIC = {
    ast.Add: lambda a, b: a + b,
    ast.Sub: lambda a, b: a - b,
    ast.Mult: lambda a, b: a * b,
    ast.Div: safe_ratio,
    ast.FloorDiv: _floor_division,
    ast.Mod: _modulo,
    ast.Pow: lambda a, b: F.pow(a, b),
}

_COMPARISONS = {
    ast.Eq: lambda a, b: a == b,
    ast.NotEq: lambda a, b: a != b,
    ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b,
    ast.Gt: lambda a, b: a > b,
    ast.GtE: lambda a, b: a >= b,
}


def _parsed(text: str, spelled: str | None = None) -> ast.AST:
    try:
        return ast.parse((text if spelled is None else spelled).strip(), mode="eval").body
    except SyntaxError as problem:
        raise ValueError(f"cannot read expression {text!r}") from problem


class _Tree:
    """Builds columns from the allowed parts of an expression's syntax tree.

    ``leaf`` gives the column of a name or constant, and ``kind`` the type of a
    part, or None if they know none.
    """

    def __init__(
        self,
        text: str,
        leaf: Callable[[ast.AST], Column | None],
        kind: Callable[[ast.AST], T.DataType | None] = lambda node: None,
    ):
        self.text, self.leaf, self.kind = text, leaf, kind

    def is_text(self, node: ast.AST) -> bool:
        return isinstance(self.kind(node), T.StringType)

    def value(self, node: ast.AST) -> Column:
        found = self.leaf(node)
        if found is not None:
            return found
        match node:
            case ast.BinOp(left=left, op=op, right=right) if type(op) in _ARITHMETIC:
                return _ARITHMETIC[type(op)](self.value(left), self.value(right))
            case ast.UnaryOp(op=ast.USub(), operand=operand):
                return -self.value(operand)
            case ast.UnaryOp(op=ast.UAdd(), operand=operand):
                return self.value(operand)
            case ast.Constant(value=bool()):
                pass
            case ast.Constant(value=int() | float() as number):
                return F.lit(float(number))
            case ast.Compare():
                return self.test(node).cast("double")
            case ast.Call(
                func=ast.Attribute(value=inner, attr="fillna"),
                args=[ast.Constant() | ast.UnaryOp(operand=ast.Constant()) as filler],
                keywords=[],
            ):
                return F.coalesce(self.value(inner), self.value(filler))
        raise ValueError(f"unsupported expression {self.text!r}")

    def test(self, node: ast.AST, outer: bool = False) -> Column:
        """A condition that is true or false; only an outermost one may be null for false."""
        match node:
            case ast.BoolOp(op=op, values=values):
                join = (lambda a, b: a & b) if isinstance(op, ast.And) else (lambda a, b: a | b)
                outer = outer and isinstance(op, ast.And)
                return reduce(join, [self.test(v, outer) for v in values])
            case ast.UnaryOp(op=ast.Not(), operand=operand):
                return ~self.test(operand)
            case ast.Compare(left=left, ops=ops, comparators=rights):
                terms = zip([left, *rights], ops, rights, strict=False)
                return reduce(lambda a, b: a & b, [self._compared(*t, outer) for t in terms])
            case ast.BinOp(op=ast.BitAnd() | ast.BitOr()) | ast.UnaryOp(op=ast.Invert()):
                raise ValueError(f"write and/or/not instead of &, |, ~ in filter {self.text!r}")
            case ast.Name() | ast.Constant(value=bool()):
                return F.coalesce(self.value(node).cast("boolean"), F.lit(False))
        raise ValueError(f"unsupported filter {self.text!r}")

    def _beside(self, node: ast.AST, other: ast.AST) -> Column:
        """A side of a comparison; whole numbers stay whole beside integers, so that scans can use them."""
        match node:
            case ast.Constant(value=int() as number) if isinstance(self.kind(other), T.IntegralType):
                return F.lit(number)
        return self.value(node)

    def _compared(self, left: ast.AST, op: ast.cmpop, right: ast.AST, outer: bool = False) -> Column:
        if isinstance(op, ast.In | ast.NotIn):
            if not isinstance(right, ast.List | ast.Tuple):
                raise ValueError(f"expected a list after in: {self.text!r}")
            same = [e for e in right.elts if self.is_text(e) == self.is_text(left)]
            mixed = [self._compared(left, ast.Eq(), e) for e in right.elts if e not in same]
            inside = F.coalesce(self.value(left).isin([self.value(e) for e in same]), F.lit(False))
            inside = reduce(lambda a, b: a | b, mixed, inside)
            return ~inside if isinstance(op, ast.NotIn) else inside
        if type(op) not in _COMPARISONS:
            raise ValueError(f"unsupported comparison in {self.text!r}")
        missing = F.lit(isinstance(op, ast.NotEq))
        sides = [self._beside(left, right), self._beside(right, left)]
        texts = [self.is_text(left), self.is_text(right)]
        if any(texts) and not all(texts):
            sides = [as_number(c) if t else c for c, t in zip(sides, texts, strict=True)]
        compared = _COMPARISONS[type(op)](*sides)
        return compared if outer and not isinstance(op, ast.NotEq) else F.coalesce(compared, missing)


def expression_column(text: str, allowed: Iterable[str]) -> Column:
    """Column for an expression over finished features: ``df["a"] + 2 * df["b"]``.

    Arithmetic, comparisons (1 or 0) and ``.fillna(number)``. The text is never
    evaluated: only these parts, column references and numbers pass, and only
    columns in ``allowed`` may be read.
    """
    allowed = set(allowed)

    def value(node: ast.AST) -> Column | None:
        match node:
            case ast.Subscript(value=ast.Name(id="df"), slice=ast.Constant(value=str() as name)):
                if name not in allowed:
                    raise ValueError(f"unknown column {name!r} in expression {text!r}")
                return F.col(f"`{name}`").cast("double")
        return None

    return _Tree(text, value).value(_parsed(text))
