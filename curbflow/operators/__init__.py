"""Joins, windows and numbering that stay balanced when one key is hot."""

from curbflow.operators.asof import last_before
from curbflow.operators.intervals import covering
from curbflow.operators.lag import previous_row
from curbflow.operators.nearby import near_lines
from curbflow.operators.numbering import consecutive_numbers
from curbflow.operators.picks import first_per

__all__ = ["consecutive_numbers", "covering", "first_per", "last_before", "near_lines", "previous_row"]
