"""Column masking policies for landing pipes."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POLICIES = ("redact", "hash", "last4", "email_domain")


def mask_column(c: Column, policy: str) -> Column:
    """Apply a masking policy to a string column. NULL stays NULL.

    * ``redact``: every letter becomes ``x``/``X`` and every digit ``9``;
    * ``hash``: hex SHA-256 of the text;
    * ``last4``: all but the last four characters become ``*``; a text of up to
      four characters is masked whole;
    * ``email_domain``: the local part of an e-mail address becomes ``***``.
    """
    if policy == "redact":
        return F.regexp_replace(F.regexp_replace(F.regexp_replace(
            c, "[A-Z]", "X"), "[a-z]", "x"), "[0-9]", "9")
    if policy == "hash":
        return F.sha2(c, 256)
    if policy == "last4":
        n = F.char_length(c)
        return F.when(n <= 4, F.repeat(F.lit("*"), n)).otherwise(
            F.concat(F.repeat(F.lit("*"), n - 4), F.substring(c, -4, 4)))
    if policy == "email_domain":
        return F.regexp_replace(c, "^[^@]*@", "***@")
    raise ValueError(f"unknown masking policy {policy!r}; expected one of {POLICIES}")
