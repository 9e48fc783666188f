"""Repeatable pseudo-random draws from integer keys.

Plain integer arithmetic modulo a prime, so that a draw depends on (key, seed) only: the
same on every executor, after every retry, and in any SQL engine.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2147483647


def draw(key: Column, seed: int) -> Column:
    """Uniform integer in [0, PRIME). Every product stays below 2^62."""
    base = key % PRIME
    first = (base * 48271 + (seed * 7919 + 12345)) % PRIME
    second = (first * first + base) % PRIME
    third = (second * 69621 + first) % PRIME
    return (third * third + second) % PRIME


def below(key: Column, seed: int, ratio: float) -> Column:
    """True for about ``ratio`` of the keys."""
    return draw(key, seed) < int(ratio * PRIME)


def pick(key: Column, seed: int, values: list[str]) -> Column:
    """One of the values, all equally likely."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (draw(key, seed) % len(values) + 1).cast("int"))


def weighted(key: Column, seed: int, values: list[str], weights: list[float]) -> Column:
    """One of the values with the given odds: cumulative thresholds over one draw."""
    ball = draw(key, seed)
    edges = [int(sum(weights[: i + 1]) * PRIME) for i in range(len(weights) - 1)]
    chain = reduce(lambda c, ve: c.when(ball < ve[1], ve[0]), zip(values[1:-1], edges[1:]), F.when(ball < edges[0], values[0]))
    return chain.otherwise(values[-1])
