"""Column-expression helpers shared by the operators (all JVM built-ins)."""

from hirebook.functions.expr import (clamp, clamp0, date_lit, in_period, money,
                                     safe_div, sgn)

__all__ = ["clamp", "clamp0", "date_lit", "in_period", "money", "safe_div", "sgn"]
