"""crc32 as SQL, for the SQL of queries that hash ids."""

from __future__ import annotations

#: A common table ``crc`` of one row: ``t``, the remainders of all bytes.
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t)"""


def crc32_sql(ascii_text: str) -> str:
    """crc32 of a non-empty ASCII text, where ``crc`` is joined."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split({ascii_text}, ''), lambda b: ascii(b)::BIGINT)),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])))"""
