"""The chain notation: ``AVG_KF_MAX#5s,5s|1,0.5|1m,1m`` is three stages with their arguments."""

from __future__ import annotations

from dataclasses import dataclass

from ..functions.times import is_duration, parse_duration

# The operators by the arguments they take.
WINDOW_OPS = ("AVG", "SUM", "MAX", "MIN", "MEDIAN", "RANGE", "VARIANCE", "STD", "CV", "SLOPE", "PSEQ", "INTERP")
LAG_OPS = ("LAST", "VAR", "TREND")
COUNT_OPS = ("EMA", "RSI")
OPS = (*WINDOW_OPS, *LAG_OPS, *COUNT_OPS, "DIF", "FOF", "DEJUMP", "KF", "RAW")


@dataclass(frozen=True)
class Stage:
    """One operator: args are milliseconds for windows, else numbers."""

    op: str
    args: tuple = ()


def _stage(op: str, text: str) -> Stage:
    parts = [p.strip() for p in text.split(",")]
    if op in WINDOW_OPS:
        if len(parts) != 2:
            raise ValueError(f"{op} needs a size and a slide")
        size, slide = map(parse_duration, parts)
        if slide <= 0 or size < slide:
            raise ValueError(f"{op}: the size must be at least the slide, both above 0")
        return Stage(op, (size, slide))
    if op == "RAW":
        return Stage(op)
    if any(is_duration(p) for p in parts) or not all(parts):
        raise ValueError(f"{op} needs numbers")
    count = 2 if op in ("KF", "DEJUMP", "DIF") else 1
    if len(parts) != count:
        raise ValueError(f"{op} needs {count} number(s)")
    whole = op in LAG_OPS or op in COUNT_OPS or op == "DIF"
    args = tuple(int(p) if whole else float(p) for p in parts)
    if (whole and min(args) < 1) or (op == "DEJUMP" and args[0] > args[1]):
        raise ValueError(f"{op}: arguments out of range")
    return Stage(op, args)


#: Operators that share one place for their arguments where only the last ones count.
SLOTS = {**dict.fromkeys(WINDOW_OPS, "window"), **dict.fromkeys((*LAG_OPS, "RAW"), "lag"), "KF": "KF", "DEJUMP": "DEJUMP"}


def parse_spec(calculate_type: str, param: str, last_wins: bool = False) -> tuple[Stage, ...]:
    """The stages of a type and its parameters; ValueError says what is wrong.

    ``last_wins``: all stages that share a place for their arguments take those of the last such stage, as a system does
    that reads all arguments before it starts.
    """
    ops, groups = calculate_type.strip().split("_"), param.strip().split("|")
    if len(ops) != len(groups):
        raise ValueError(f"{len(ops)} operators but {len(groups)} groups of arguments")
    for op in ops:
        if op not in OPS:
            raise ValueError(f"no operator {op!r}")
    stages = tuple(_stage(op, g) for op, g in zip(ops, groups))
    if not last_wins:
        return stages
    final = {SLOTS.get(s.op, "other"): s.args for s in stages}
    return tuple(Stage(s.op, s.args if s.op == "RAW" else final[SLOTS.get(s.op, "other")]) for s in stages)


def validate_specs(specs) -> tuple[list[str], dict[str, str]]:
    """Of ``type#param`` texts: those that are valid, and why each other one is not. Every stage is looked at."""
    good, bad = [], {}
    for spec in specs:
        kind, mark, param = spec.partition("#")
        try:
            if not mark or not param:
                raise ValueError("no parameters")
            parse_spec(kind, param)
            good.append(spec)
        except ValueError as e:
            bad[spec] = str(e)
    return good, bad
