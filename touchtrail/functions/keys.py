"""Identity keys: F1-F4, F11 strip, F21."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import COUNTRY_CODE, LOCAL_NUMBER_LENGTHS

# Every character Unicode calls white space, plus the four ASCII separators (0x1C-0x1F)
# that text strippers also remove.  Spark's own trim() drops U+0020 only.
_SPACES = "".join(
    chr(point)
    for first, last in (
        (0x09, 0x0D),
        (0x1C, 0x20),
        (0x85, 0x85),
        (0xA0, 0xA0),
        (0x1680, 0x1680),
        (0x2000, 0x200A),
        (0x2028, 0x2029),
        (0x202F, 0x202F),
        (0x205F, 0x205F),
        (0x3000, 0x3000),
    )
    for point in range(first, last + 1)
)


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind (recipe R0)."""
    return F.btrim(text, F.lit(_SPACES))


def is_blank(text: Column) -> Column:
    """TRUE for NULL, an empty text or white space only."""
    return text.isNull() | (strip(text) == "")


def email_key(email: Column) -> Column:
    """lower-case, stripped address."""
    return F.lower(strip(email))


def digits(value: Column) -> Column:
    """the ASCII digits of a text or whole number."""
    return F.regexp_replace(value.cast("string"), "[^0-9]", "")


def phone_from_digits(
    number: Column,
    country_code: str = COUNTRY_CODE,
    local_lengths: tuple[int, ...] = LOCAL_NUMBER_LENGTHS,
) -> Column:
    """F3 on a text of digits: local numbers (10 or 11 digits) get the country code in front.

    A number that already carries the code is longer than a local one and stays as it is,
    and so does anything that cannot be a full number.
    """
    is_local = F.length(number).isin(*local_lengths)
    return F.when(is_local, F.concat(F.lit(country_code), number)).otherwise(number)


def phone_key(phone: Column) -> Column:
    """digits of a text or whole number, with the country code."""
    return phone_from_digits(digits(phone))
