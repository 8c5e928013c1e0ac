"""Formulas over bracketed tags, such as ``[a] / ([b] + [c])`` or ``([a] > 3) ? 1 : 0``, as Spark columns.

Operators: + - * / %, comparisons, && || !, ?: and parentheses. Python's own expression grammar reads the text once
its few foreign signs are spelled as Python does.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable
from types import SimpleNamespace

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_TAG = re.compile(r"\[([^\[\]]+)\]")


def formula_tags(text: str) -> list[str]:
    """The tags of a formula, each once, in the order of the text."""
    return list(dict.fromkeys(_TAG.findall(text)))


def is_formula(name: str) -> bool:
    return "[" in name


def _ternary(text: str) -> str:
    """``c ? a : b`` as Python writes it, from the inside of parentheses outwards."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        if c == "(":
            if not depth:
                out.append(text[start:i])
                start = i + 1
            depth += 1
        elif c == ")":
            depth -= 1
            if not depth:
                out.append(f"\0{len(out)}\0({_ternary(text[start:i])})")
                start = i + 1
    out.append(text[start:])
    held = {p.split("\0")[1]: p.split("\0")[2] for p in out if p.startswith("\0")}
    flat = "".join(f"\0{p.split(chr(0))[1]}\0" if p.startswith("\0") else p for p in out)
    at = flat.find("?")
    if at >= 0:
        open_, i = 1, at + 1
        while i < len(flat) and open_:
            open_ += (flat[i] == "?") - (flat[i] == ":")
            i += 1
        if open_:
            raise ValueError(f"? without : in {text!r}")
        yes, no = _ternary(flat[at + 1 : i - 1]), _ternary(flat[i:])
        flat = f"(({yes}) if ({flat[:at]}) else ({no}))"
    return re.sub("\0(\\d+)\0", lambda m: held.get(m[1], m[0]), flat)


#: What differs between columns and arrays; signs mean the same to both.
COLUMNS = SimpleNamespace(
    number=lambda v: F.lit(float(v)), value=lambda x: F.coalesce(x.cast("double"), F.lit(0.0)), divide=F.try_divide, rest=F.try_mod,
    choose=lambda c, a, b: F.when(c, a).otherwise(b), whole=lambda x: F.coalesce(x, F.lit(0.0)),
)


def _quietly(f):
    def run(x, y):
        with np.errstate(all="ignore"):
            return np.where(np.asarray(y) == 0, np.nan, f(x, y))

    return run


ARRAYS = SimpleNamespace(
    number=float, value=lambda x: np.nan_to_num(np.asarray(x, float), nan=0.0), divide=_quietly(np.divide), rest=_quietly(np.fmod),
    choose=np.where, whole=lambda x: np.where(np.isnan(x), 0.0, x),
)


def compile_formula(text: str, operand: Callable[[str], Column], how: SimpleNamespace = COLUMNS) -> Column:
    """The formula as a double column; ``operand(tag)`` gives each tag's column. With ARRAYS the same over numpy arrays.

    A missing operand counts as 0, a division by zero or a bare comparison gives 0, as a failed formula does. A text
    that is no formula raises ValueError.
    """
    tags = formula_tags(text)
    plain = _TAG.sub(lambda m: f" t{tags.index(m[1])}_ ", text)
    plain = re.sub(r"!(?!=)", " not ", plain.replace("&&", " and ").replace("||", " or "))
    try:
        tree = ast.parse(_ternary(plain).strip(), mode="eval")
    except SyntaxError as e:
        raise ValueError(f"not a formula: {text!r}") from e

    def number(node) -> Column:
        match node:
            case ast.Constant(value=v) if isinstance(v, (int, float)) and not isinstance(v, bool):
                return how.number(v)
            case ast.Name(id=n) if re.fullmatch(r"t\d+_", n):
                return how.value(operand(tags[int(n[1:-1])]))
            case ast.UnaryOp(op=ast.USub(), operand=x):
                return -number(x)
            case ast.UnaryOp(op=ast.UAdd(), operand=x):
                return number(x)
            case ast.BinOp(left=a, op=op, right=b):
                x, y = number(a), number(b)
                if isinstance(op, ast.Add):
                    return x + y
                if isinstance(op, ast.Sub):
                    return x - y
                if isinstance(op, ast.Mult):
                    return x * y
                if isinstance(op, ast.Div):
                    return how.divide(x, y)
                if isinstance(op, ast.Mod):
                    return how.rest(x, y)
            case ast.IfExp(test=c, body=a, orelse=b):
                return how.choose(truth(c), number(a), number(b))
        raise ValueError(f"not a number in {text!r}")

    def truth(node) -> Column:
        match node:
            case ast.BoolOp(op=op, values=parts):
                out = truth(parts[0])
                for p in parts[1:]:
                    out = out & truth(p) if isinstance(op, ast.And) else out | truth(p)
                return out
            case ast.UnaryOp(op=ast.Not(), operand=x):
                return ~truth(x)
            case ast.Compare(left=a, ops=[op], comparators=[b]):
                x, y = number(a), number(b)
                signs = {ast.Gt: x > y, ast.Lt: x < y, ast.GtE: x >= y, ast.LtE: x <= y, ast.Eq: x == y, ast.NotEq: x != y}
                if type(op) in signs:
                    return signs[type(op)]
        raise ValueError(f"not a condition in {text!r}")

    if isinstance(tree.body, (ast.Compare, ast.BoolOp)) or (isinstance(tree.body, ast.UnaryOp) and isinstance(tree.body.op, ast.Not)):
        truth(tree.body)
        return how.number(0)
    return how.whole(number(tree.body))
