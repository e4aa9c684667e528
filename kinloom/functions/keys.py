"""Hash keys and derived identifiers.

Identifiers are functions of their input, so a recomputed task yields the same
id as the first attempt and no checkpoint is needed to pin them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import column, lookup_key


def stable_id(key: Column | str, salt: str = "new", dashed: bool = False) -> Column:
    """128-bit id derived from a key; ``dashed`` gives the 8-4-4-4-12 form."""
    digest = F.md5(F.concat(F.lit(f"{salt}|"), column(key)))
    if not dashed:
        return digest
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def text_digest(columns: Sequence[Column | str]) -> Column:
    """MD5 over pipe-joined text, null as empty, values as they are."""
    return F.md5(F.concat_ws("|", *[F.coalesce(column(c).cast("string"), F.lit("")) for c in columns]))


def person_digest(columns: Sequence[str]) -> Column:
    """MD5 over pipe-joined normalised features; null when every one is blank.

    Two records without any personal data are not evidence of one person, so
    they get no digest and can never meet in a join.
    """
    values = [F.coalesce(F.lower(F.trim(F.col(c))), F.lit("")) for c in columns]
    joined = F.concat_ws("|", *values)
    return F.when(F.length(F.concat(*values)) > 0, F.md5(joined))


def email_hash(c: Column | str) -> Column:
    """Upper-case hex SHA-256 of the normalised e-mail; null when blank."""
    return F.upper(F.sha2(lookup_key(c), 256))


def record_id(identifier: Column | str, source: Column | str, customer: Column | str) -> Column:
    return F.coalesce(column(identifier), F.concat_ws(":", column(source), column(customer)))


def document_key(source: Column | str = "source_name", customer: Column | str = "source_customer_id") -> Column:
    return F.concat_ws("_", column(source), column(customer))
