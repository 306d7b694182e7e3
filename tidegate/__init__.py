"""Spec-driven data products on Spark: pages in, a gated contract snapshot out."""

from tidegate.errors import ContractError, GateError, LandingError, TidegateError
from tidegate.lake import Lake
from tidegate.spec import BlankOrLiteral, Field, OrderBy, OutsideRange, ProductSpec, Rule

__all__ = [
    "BlankOrLiteral",
    "ContractError",
    "Field",
    "GateError",
    "Lake",
    "LandingError",
    "OrderBy",
    "OutsideRange",
    "ProductSpec",
    "Rule",
    "TidegateError",
]
