"""Column expressions; all built-in functions, no Python UDFs."""

from riskmart.functions.casts import lenient
from riskmart.functions.display import delta_points, euro, percent, severity
from riskmart.functions.draws import draw, fraction
from riskmart.functions.ids import identifier

__all__ = ["delta_points", "draw", "euro", "fraction", "identifier", "lenient", "percent", "severity"]
