"""Pseudorandom permutations of 0..n-1 as Spark columns: an alternating Feistel network over a
grid of a x b >= n cells with a = ceil(sqrt(n)), walking on from cells outside 0..n-1.

A walk leaves the domain with probability below 1/a at each step and passes at most a - 1 cells
outside it, so STEPS steps always suffice for a <= STEPS and practically always above.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS, ROUNDS = 16, 4


def permuted(index: str, n: str, key: str) -> Column:
    """The place of ``index`` (0 <= index < n) under the permutation that ``key`` names; all three
    are SQL expressions, of longs and of any list of columns."""
    a, b = f"cast(ceil(sqrt({n})) as bigint)", f"cast(ceil({n} / ceil(sqrt({n}))) as bigint)"
    left = f"pmod(p.l + pmod(xxhash64(p.r, k, {key}), {a}), {a})"
    right = f"pmod(p.r + pmod(xxhash64({left}, -k, {key}), {b}), {b})"
    once = f"aggregate(sequence(1, {ROUNDS}), named_struct('l', s.v div {b}, 'r', s.v % {b}), (p, k) -> named_struct('l', {left}, 'r', {right}), p -> p.l * {b} + p.r)"
    step = f"if(s.done, s, aggregate(array({once}), s, (o, v) -> named_struct('v', v, 'done', v < {n})))"
    start = f"named_struct('v', cast({index} as bigint), 'done', false)"
    return F.expr(f"aggregate(sequence(1, {STEPS}), {start}, (s, i) -> {step}, s -> if(s.done, s.v, cast(raise_error('a walk of the permutation did not end') as bigint)))")
