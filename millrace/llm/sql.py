"""Pieces of DuckDB SQL that several checks need."""

from __future__ import annotations

# Fixed value: the reversed CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320

# The words of the decontamination, resampling and fingerprint operators, of a text column.
LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# A CTE with the table of crc32 of every byte, and the crc32 of a text's UTF-8 bytes by that table.
CRC_TABLE = f"""crc_table as (select list_transform(range(256), lambda x: list_reduce(
  list_transform(range(8), lambda i: cast(i as ubigint)),
  lambda a, i: case when a & 1 = 1 then xor(a >> 1, {POLYNOMIAL}::ubigint) else a >> 1 end, cast(x as ubigint))) as crc_of)"""
_BYTES = "list_transform(range(strlen({0})), lambda i: cast('0x' || substr(hex(encode({0})), cast(2 * i + 1 as integer), 2) as ubigint))"
CRC = (
    f"cast(xor(list_reduce({_BYTES}, lambda s, b: xor(s >> 8, crc_of[cast(xor(s & 255, b) + 1 as bigint)]), "
    "4294967295::ubigint), 4294967295::ubigint) as bigint)"
)
