"""A hash in DuckDB SQL, for the SQL that checks queries."""

from __future__ import annotations


def xxh64_sql(shingles: str) -> str:
    """CTEs up to ``hashes`` (s, h): the unsigned XXH64, seed 42, of each s of a table, on hex digits.

    Numbers are 128 bits wide and cut to 64. A rotation by r bits is a product with 2 ** r modulo 2 ** 64 - 1
    (but for 64 ones, which would stay as they are).
    """
    p1, p2, p3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
    p4, p5, seed, ones = 9650029242287828579, 2870177450012600261, 42, (1 << 64) - 1

    def wide(n: int) -> str:
        return f"CAST('{n % (1 << 64)}' AS UHUGEINT)"

    def add(a: str, b: str) -> str:
        return f"((({a}) + ({b})) & {wide(ones)})"

    def times(a: str, n: int) -> str:
        return f"((({a}) * {wide(n)}) & {wide(ones)})"

    def turned(a: str, bits: int) -> str:
        return f"((({a}) * {wide(1 << bits)}) % {wide(ones)})"

    def number(at: str, size: int) -> str:
        digits = " || ".join(f"substr(x, 2 * ({at}) + {2 * i + 1}, 2)" for i in reversed(range(size)))
        return f"CAST(CAST('0x' || {digits} AS UBIGINT) AS UHUGEINT)"

    def round_(v: str, lane: str) -> str:
        return times(turned(add(times(lane, p2), v), 31), p1)

    lanes = ",\n         ".join(
        f"list_reduce(list_transform(range(n // 32), lambda j: {number(f'32 * j + {8 * k}', 8)}), "
        f"lambda v, lane: {round_('v', 'lane')}, {wide(begin)}) AS v{k}"
        for k, begin in enumerate((seed + p1 + p2, seed + p2, seed, seed - p1))
    )
    merged = add(add(turned("v0", 1), turned("v1", 7)), add(turned("v2", 12), turned("v3", 18)))
    for k in range(4):
        merged = add(times(f"xor({merged}, {round_(wide(0), f'v{k}')})", p1), wide(p4))
    eights = add(times(turned(f"xor(v, {round_(wide(0), 'lane')})", 27), p1), wide(p4))
    four = add(times(turned(f"xor(h, {times(number('n // 8 * 8', 4), p1)})", 23), p2), wide(p3))
    return f"""digits AS (SELECT s, hex(s) AS x, length(hex(s)) // 2 AS n FROM (SELECT DISTINCT s FROM {shingles})),
lanes AS (
  SELECT *, {lanes}
  FROM digits),
begun AS (
  SELECT s, x, n, {add(f"CASE WHEN n >= 32 THEN {merged} ELSE {wide(seed + p5)} END", "CAST(n AS UHUGEINT)")} AS h
  FROM lanes),
eights AS (
  SELECT s, x, n, list_reduce(list_transform(range(n // 32 * 4, n // 8), lambda j: {number("8 * j", 8)}),
         lambda v, lane: {eights}, h) AS h FROM begun),
fours AS (SELECT s, x, n, CASE WHEN n % 8 >= 4 THEN {four} ELSE h END AS h FROM eights),
ended AS (
  SELECT s, list_reduce(list_transform(range(n // 4 * 4, n), lambda j: {number("j", 1)}),
         lambda v, lane: {times(turned(f"xor(v, {times('lane', p5)})", 11), p1)}, h) AS h FROM fours),
mixed AS (SELECT s, {times("xor(h, h >> 33)", p2)} AS h FROM ended),
stirred AS (SELECT s, {times("xor(h, h >> 29)", p3)} AS h FROM mixed),
hashes AS (SELECT s, xor(h, h >> 32) AS h FROM stirred)"""
