"""Masking, encryption, check digits, keys and variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import _c

NULL_MARKER = "_null_"


def mask_card(card) -> Column:
    card = _c(card).cast("string")
    return F.concat(F.substring(card, 1, 4), F.lit("********"), F.right(card, F.lit(4)))


def encrypt_columns(df: DataFrame, columns, key: str) -> DataFrame:
    """AES-encrypt text columns to base64; null and empty values stay as they are."""
    def seal(name):
        sealed = F.base64(F.aes_encrypt(F.col(name).cast("string"), F.lit(key)))
        return F.when(F.col(name).cast("string") != "", sealed).otherwise(
            F.col(name).cast("string")
        )

    return df.withColumns({name: seal(name) for name in columns})


def decrypt_columns(df: DataFrame, columns, key: str) -> DataFrame:
    def reveal(name):
        opened = F.aes_decrypt(F.unbase64(F.col(name)), F.lit(key)).cast("string")
        return F.when(F.col(name) != "", opened).otherwise(F.col(name))

    return df.withColumns({name: reveal(name) for name in columns})


def luhn_valid(number) -> Column:
    return F.call_function("luhn_check", _c(number).cast("string"))


def luhn_digit(number) -> Column:
    """The digit that makes the number followed by it pass the check."""
    number = _c(number).cast("string")
    digits = F.reverse(F.split(number, ""))
    total = F.aggregate(
        F.transform(
            digits,
            lambda d, i: F.when(
                i % 2 == 0,
                F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9).otherwise(
                    d.cast("int") * 2
                ),
            ).otherwise(d.cast("int")),
        ),
        F.lit(0),
        lambda acc, d: acc + d,
    )
    return F.pmod(10 - total % 10, F.lit(10))


def surrogate_key(*columns) -> Column:
    """md5 over the columns as text, with a marker where a column is null."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_MARKER)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def hash_slot(column, slots: int) -> Column:
    """A number below ``slots`` from the MD5 of a value as text, the same in any engine."""
    head = F.substring(F.md5(column.cast("string")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(slots))


def variant(id_column, share: float) -> Column:
    """canary for about ``share`` of the ids, primary otherwise; the same id always agrees."""
    slot = hash_slot(_c(id_column), 10_000)
    return F.when(slot < int(round(share * 10_000)), "canary").otherwise("primary")
