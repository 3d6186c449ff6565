"""Brazilian number and month text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names in report labels.
MONTHS = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)


def _swap_separators(text: Column) -> Column:
    return F.translate(text, ",.", ".,")


def format_currency(value: Column) -> Column:
    """1234567.891 to 'R$ 1.234.567,89'."""
    return F.concat(F.lit("R$ "), _swap_separators(F.format_number(value.cast("double"), 2)))


def format_integer(value: Column) -> Column:
    """1234567 to '1.234.567'; halves go to the even neighbour."""
    return _swap_separators(F.format_number(value.cast("double"), 0))


def format_percent(value: Column, brazilian: bool = False) -> Column:
    """12.345 to '12.35%', or with grouping and a decimal comma."""
    number = value.cast("double")
    if brazilian:
        text = _swap_separators(F.format_number(number, 2))
    else:
        text = F.call_function("format_number", number, F.lit("0.00"))
    return F.concat(text, F.lit("%"))


def month_label(date_ref: Column) -> Column:
    """'2025-04' to 'Abril/2025'; anything else stays as it is."""
    year, month = F.substring(date_ref, 1, 4), F.substring(date_ref, 6, 2)
    names = F.array(*[F.lit(name) for name in MONTHS])
    label = F.concat(F.get(names, month.try_cast("int") - 1), F.lit("/"), year)
    valid = date_ref.rlike(r"^[0-9]{4}-(0[1-9]|1[0-2])$")
    return F.when(valid, label).otherwise(date_ref)
