"""Column expressions. All are Spark built-ins put together; none runs Python per row."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.schemas import ORDER_MONEY


def title_case(text: Column) -> Column:
    """Upper-case the first character of every run of letters and digits, lower-case the rest.

    Spark's ``initcap`` starts a word only after white space; here "embu-guaçu" gives "Embu-Guaçu".
    """
    words = F.split(F.lower(text), r"(?<=[^\p{L}\p{N}])")
    raised = F.transform(words, lambda w: F.concat(F.upper(w.substr(1, 1)), w.substr(F.lit(2), F.length(w))))
    return F.array_join(raised, "")


def clean_lower(text: Column) -> Column:
    return F.lower(F.trim(text))


def clean_upper(text: Column) -> Column:
    return F.upper(F.trim(text))


def exact_avg(value: Column) -> Column:
    """Mean from an exact sum, so that it does not depend on the order of rows; NULL without values."""
    return F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))


def ratio_rounded(part: Column, whole: Column, digits: int, factor: int = 1) -> Column:
    """``part * factor / whole`` of non-negative integers, rounded half up to ``digits`` exactly; NULL if whole is 0."""
    scale = factor * 10**digits
    halves = part * F.lit(2 * scale) + whole
    quotient = F.call_function("div", halves, F.nullif(whole * F.lit(2), F.lit(0)))
    return quotient.cast("double") / F.lit(float(10**digits))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return ratio_rounded(part, whole, digits, factor=100)


def cents(amount: Column) -> Column:
    """Decimal amount with two places as a whole number of hundredths."""
    return (amount * F.lit(100)).cast("decimal(29,0)")


def sum_in_order(amount: str) -> str:
    """SQL for the sum of an amount with two places within one order.

    Adds whole hundredths as bigint, several times faster than decimals and with a wider range than
    the decimal(18,2) of the result; overflow raises.
    """
    return sum_of_cents(f"bigint({amount} * 100)")


def sum_of_cents(number: str) -> str:
    """SQL for the sum of whole hundredths within one order, as an amount."""
    return f"CAST(CAST(sum({number}) AS decimal(20,0)) * 0.01 AS {ORDER_MONEY})"


def distinct_list(text: Column) -> Column:
    """Sorted distinct values joined by ", "; NULL when there are none."""
    found = F.array_sort(F.collect_set(text))
    return F.when(F.size(found) > 0, F.array_join(found, ", "))


def as_of_column(as_of: str | datetime | None) -> Column:
    """The moment that stands for "now"."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(str(as_of)).cast("timestamp_ntz")


# 0 for Sunday up to 6 for Saturday.
DAY_OF_WEEK = "dayofweek({}) - 1"

# Labels of the reports.
DAY_LABELS = {0: "Sun", 1: "Mon", 2: "Tue", 3: "Wed", 4: "Thu", 5: "Fri", 6: "Sat"}
MONTH_LABELS = {
    1: "Jan",
    2: "Feb",
    3: "Mar",
    4: "Apr",
    5: "May",
    6: "Jun",
    7: "Jul",
    8: "Aug",
    9: "Sep",
    10: "Oct",
    11: "Nov",
    12: "Dec",
}


def label_of(code: Column, labels: dict[int, str]) -> Column:
    """Label of a code, NULL for a code without one."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.element_at(F.create_map(*pairs), code)


def fixed_digits(value: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, rounded half to even."""
    return F.call_function("format_number", value.cast("double"), F.lit("0." + "0" * digits if digits else "0"))


def thousands(value: Column) -> Column:
    """Whole number as text with thousands separators."""
    return F.format_number(value, 0)


def money_label(value: Column) -> Column:
    """Short money text: millions with two decimals and an M, thousands whole with a K, else whole."""
    amount = value.cast("double")
    return (
        F.when(amount >= 1e6, F.concat(F.lit("R$"), fixed_digits(amount / 1e6, 2), F.lit("M")))
        .when(amount >= 1e3, F.concat(F.lit("R$"), fixed_digits(amount / 1e3, 0), F.lit("K")))
        .otherwise(F.concat(F.lit("R$"), fixed_digits(amount, 0)))
    )
