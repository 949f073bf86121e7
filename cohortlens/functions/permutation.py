"""A keyed permutation of 0 .. n - 1 as column arithmetic.

A number is cut into a pair (x mod a, x div a) with a = ceil(sqrt(n)) and
b = ceil(n / a); four Feistel rounds add to each half in turn a keyed function
(a square between two linear maps) of the other one, modulo a or b. That permutes 0 .. ab - 1. Of its fewer than a
numbers from n on, the permutation walks on until it is back below n; how often
that can be needed is counted beforehand over those numbers only.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Two primes below 2**31: halves, keys and products stay in 64 bits.
P1, P2 = 2**31 - 1, 2**31 - 19
ROUNDS = 4


@dataclass(frozen=True)
class Permutation:
    n: int
    seed: int

    def __post_init__(self):
        if not 0 < self.n < 2**61:
            raise ValueError("a permutation needs 1 to 2**61 - 1 numbers")

    @property
    def sides(self) -> tuple[int, int]:
        a = math.isqrt(self.n - 1) + 1
        return a, -(-self.n // a)

    def keys(self, j: int) -> tuple[int, int, int, int]:
        """A multiplier and a summand for either prime, from md5(seed|round)."""
        h = hashlib.md5(f"{self.seed}|permutation|{j}".encode()).hexdigest()
        a, b, c, d = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
        return 1 + a % (P1 - 1), b % P1, 1 + c % (P2 - 1), d % P2

    def _mixed(self, half, j: int):
        """The keyed function of a half; the same for integers, arrays and columns."""
        a, b, c, d = self.keys(j)
        u = (half * a + b) % P1
        return (u * u % P2 * c + d) % P1

    def once(self, low, high):
        """One pass over 0 .. ab - 1 of a number's two halves."""
        a, b = self.sides
        for j in range(0, ROUNDS, 2):
            low = (low + self._mixed(high, j)) % a
            high = (high + self._mixed(low, j + 1)) % b
        return low + high * a

    def walks(self) -> int:
        """The most passes after the first that a number below n can need."""
        a, b = self.sides
        outside = np.arange(self.n, a * b, dtype=np.int64)
        low, high = outside % a, outside // a
        for j in range(ROUNDS - 2, -1, -2):  # where each comes from
            high = (high - self._mixed(low, j + 1)) % b
            low = (low - self._mixed(high, j)) % a
        x, passes = outside[low + high * a < self.n], 0
        while len(x):
            x = self.once(x % a, x // a)
            x, passes = x[x >= self.n], passes + 1
        return passes

    def add(self, df: DataFrame, source: str, target: str) -> DataFrame:
        """``df`` with ``target``, the permuted ``source`` (0 .. n - 1)."""
        a, _ = self.sides

        def passed(name: str) -> Column:
            return self.once(F.col(name) % a, F.expr(f"`{name}` div {a}"))
        df = df.withColumn(target, passed(source))
        for _ in range(self.walks()):
            df = df.withColumn(target, F.when(F.col(target) < self.n, F.col(target)).otherwise(passed(target)))
        return df


def sql_pass(x: str, a: str, b: str, seed: int) -> str:
    """DuckDB select items that end in ``y``, the permuted ``x``; a and b are columns."""
    items = [f"{x} % {a} AS l0", f"{x} // {a} AS h0"]
    p = Permutation(1, seed)
    for i, j in enumerate(range(0, ROUNDS, 2)):
        for side, other, m, k in ((f"l{i}", f"h{i}", a, j), (f"h{i}", f"l{i + 1}", b, j + 1)):
            ka, kb, kc, kd = p.keys(k)
            u = f"(({other} * {ka} + {kb}) % {P1})"
            items.append(f"({side} + ({u} * {u} % {P2} * {kc} + {kd}) % {P1}) % {m} AS {side[0]}{i + 1}")
    return ", ".join(items) + f", l{ROUNDS // 2} + h{ROUNDS // 2} * {a} AS y"
