"""XXH64 as a DuckDB expression, so that fingerprints can be compared with SQL.

Numbers are UHUGEINT, reduced modulo 2^64 after each step; what is used twice is bound by a lambda over a list of one.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

# The primes of XXH64.
PRIMES = [11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261]
MODULUS = "18446744073709551616::UHUGEINT"
_names = count()


def number(n: int) -> str:
    return f"{n % 2**64}::UHUGEINT"


def bind(x: str, f: Callable[[str], str]) -> str:
    name = f"v{next(_names)}"
    return f"list_transform([{x}], lambda {name}: {f(name)})[1]"


def times(x: str, prime: int) -> str:
    return f"(({x}) * {number(PRIMES[prime - 1])}) % {MODULUS}"


def plus(*x: str) -> str:
    return "(" + " + ".join(f"({y})" for y in x) + f") % {MODULUS}"


def rotated(x: str, bits: int) -> str:
    return bind(x, lambda v: f"(({v} * {number(1 << bits)}) % {MODULUS} + {v} // {number(1 << (64 - bits))})")


def folded(x: str, bits: int) -> str:
    return bind(x, lambda v: f"xor({v}, {v} // {number(1 << bits)})")


def mixed(state: str, word: str) -> str:
    return times(rotated(plus(state, times(word, 2)), 31), 1)


def word(data: str, at: str, size: int) -> str:
    """size bytes from at on, the lowest first."""
    return "(" + " + ".join(f"{data}[{at} + {j + 1}] * {number(1 << 8 * j)}" for j in range(size)) + ")"


def xxh64(data: str, n: str, seed: int) -> str:
    """data: a list of n byte values (UHUGEINT)."""
    stripes = lambda k: f"list_transform(range(0, {n} // 32), lambda s: {word(data, f's * 32 + {8 * k}', 8)})"
    starts = [seed + PRIMES[0] + PRIMES[1], seed + PRIMES[1], seed, seed - PRIMES[0]]
    states = ", ".join(f"list_reduce({stripes(k)}, lambda a, x: {mixed('a', 'x')}, {number(v)})" for k, v in enumerate(starts))

    def joined(v: str) -> str:
        h = plus(*(rotated(f"{v}[{k + 1}]", r) for k, r in enumerate((1, 7, 12, 18))))
        for k in range(4):
            h = plus(times(f"xor({h}, {mixed(number(0), f'{v}[{k + 1}]')})", 1), number(PRIMES[3]))
        return h

    h = f"CASE WHEN {n} >= 32 THEN {bind(f'[{states}]', joined)} ELSE {number(seed + PRIMES[4])} END"
    h = plus(h, f"{n}::UHUGEINT")
    eights = f"list_transform(range({n} // 32 * 4, {n} // 8), lambda s: {word(data, 's * 8', 8)})"
    step = plus(times(rotated(f"xor(a, {mixed(number(0), 'x')})", 27), 1), number(PRIMES[3]))
    h = f"list_reduce({eights}, lambda a, x: {step}, {h})"
    four = lambda v: plus(times(rotated(f"xor({v}, {times(word(data, f'{n} // 8 * 8', 4), 1)})", 23), 2), number(PRIMES[2]))
    h = bind(h, lambda v: f"CASE WHEN {n} % 8 >= 4 THEN {four(v)} ELSE {v} END")
    h = f"list_reduce({data}[{n} // 4 * 4 + 1 :], lambda a, x: {times(rotated(f'xor(a, {times(chr(120), 5)})', 11), 1)}, {h})"
    return folded(times(folded(times(folded(h, 33), 2), 29), 3), 32)
