"""Deterministic identifiers and hashes, in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import strip_or_null

#: Fixed value: the URL namespace of RFC 4122.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """The version-5 UUID of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12),
    )


def entry_id(lang_code: Column, normalized_word: Column) -> Column:
    return uuid5(F.concat_ws("|", lang_code, normalized_word))


def group_id(pos: Column, etymology_id: Column) -> Column:
    """pos|etymology, `_` for what is blank."""
    known = [F.coalesce(strip_or_null(c), F.lit("_")) for c in (pos, etymology_id)]
    return F.concat_ws("|", *known)


def sample_key(seed: str, key: Column) -> Column:
    """md5 of seed|key: the order of a deterministic sample."""
    return F.md5(F.concat_ws("|", F.lit(seed), key))


def order_key(*parts: Column) -> Column:
    """The first 8 bytes of the sha1 of the parts joined by |, as hexadecimal: sorts as the unsigned number does."""
    return F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, 16)
