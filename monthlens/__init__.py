"""Monthly product metrics as Spark jobs."""

from monthlens.params import MonthParams

__all__ = ["MonthParams"]
