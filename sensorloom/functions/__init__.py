"""Scalar helpers: durations, formulas, times, rounding."""

from .formula import compile_formula, formula_tags
from .times import millis, parse_duration, round_half_up, wire_time

__all__ = ["compile_formula", "formula_tags", "millis", "parse_duration", "round_half_up", "wire_time"]
