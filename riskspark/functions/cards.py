"""Card numbers: normalise, check, mask."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised(pan: Column) -> Column:
    return F.regexp_replace(pan, r"[\s\-]", "")


def card_error(pan: Column) -> Column:
    """Null for a valid card number, otherwise why it is not one."""
    digits = normalised(pan)
    return (
        F.when(digits.isNull(), "MISSING")
        .when(~digits.rlike(r"^[0-9]+$"), "NON_DIGIT")
        .when(~F.length(digits).isin(15, 16), "BAD_LENGTH")
        .when(~F.call_function("luhn_check", digits), "CHECK_DIGIT")
    )


def card_bin(pan: Column) -> Column:
    return F.substring(normalised(pan), 1, 6)


def card_last4(pan: Column) -> Column:
    return F.right(normalised(pan), F.lit(4))


def masked_card(pan: Column) -> Column:
    """First six and last four digits, a star for each digit between."""
    digits = normalised(pan)
    stars = F.repeat(F.lit("*"), (F.length(digits) - 10).cast("int"))
    return F.concat(F.substring(digits, 1, 6), stars, F.right(digits, F.lit(4)))


def looks_like_card(text: Column) -> Column:
    """The whole text is a run of 15 to 19 digits."""
    return text.rlike(r"^[0-9]{15,19}$")
