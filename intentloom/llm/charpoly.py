"""Eigenvalues and eigenvectors of an integer matrix by its exact characteristic polynomial.

The polynomial is worked out modulo many primes, each on its own (so Spark can deal
them out), and put together by Chinese remaindering. All its roots are real, as the
matrix is symmetric, so the sign changes of the shifted polynomial count the roots
above any place exactly; bisection on that count and Newton steps from above give each
root to any precision. Eigenvectors are the null space of the matrix less a root, by
inverse iteration in decimals of the same precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from decimal import Decimal, localcontext

import numpy as np

#: Products of two residues stay below 2^62.
LARGEST_PRIME = 1 << 31
#: Roots are known to this share of the largest one; nearer ones count as one root.
ROOT_BITS = 200
DIGITS = 110


def primes(count: int) -> list[int]:
    """The `count` largest primes below LARGEST_PRIME."""
    root = math.isqrt(LARGEST_PRIME) + 1
    small = np.ones(root + 1, dtype=bool)
    small[:2] = False
    for k in range(2, math.isqrt(root) + 1):
        small[k * k :: k] = False
    divisors = np.flatnonzero(small)
    found: list[int] = []
    high = LARGEST_PRIME
    while len(found) < count:
        block = np.arange(high - 4096, high)
        prime = np.ones(len(block), dtype=bool)
        for divisor in divisors.tolist():
            prime[-block[0] % divisor :: divisor] = False
        found += block[prime][::-1].tolist()
        high -= 4096
    return found[:count]


def primes_needed(trace: int, size: int) -> int:
    """Primes whose product exceeds twice any coefficient.

    A coefficient is a sum of products of eigenvalues; as none is negative, it is at
    most what equal eigenvalues of the same sum would give.
    """
    most = max(
        math.comb(size, k) * trace**k // size**k + 1 for k in range(size + 1)
    )
    return (2 * most).bit_length() // (LARGEST_PRIME.bit_length() - 2) + 1


def _inverse(values: np.ndarray, moduli: np.ndarray) -> np.ndarray:
    return np.array(
        [pow(int(v), -1, int(p)) if v else 0 for v, p in zip(values, moduli)], dtype=np.int64
    )


def polynomials_modulo(matrix: Sequence[Sequence[int]], moduli: Sequence[int]) -> np.ndarray:
    """Coefficients (lowest first) of det(t - matrix) modulo each prime.

    Each copy of the matrix is brought to Hessenberg form by similarity steps modulo
    its prime; the polynomial then follows from those of its leading blocks.
    """
    size, p = len(matrix), np.array(moduli, dtype=np.int64)
    exact = np.array(matrix, dtype=object)
    h = np.stack([(exact % int(q)).astype(np.int64) for q in p])
    each, wide = np.arange(len(p)), p[:, None]
    for k in range(1, size - 1):
        # the first row from k on with something in column k - 1 becomes row k
        below = h[:, k:, k - 1] != 0
        pivot = k + below.argmax(axis=1)
        row, other = h[each, k].copy(), h[each, pivot].copy()
        h[each, k], h[each, pivot] = other, row
        column, other = h[each, :, k].copy(), h[each, :, pivot].copy()
        h[each, :, k], h[each, :, pivot] = other, column
        inverse = _inverse(h[:, k, k - 1], p)
        factors = h[:, k + 1 :, k - 1] * inverse[:, None] % wide
        h[:, k + 1 :] = (h[:, k + 1 :] - factors[:, :, None] * h[:, k, None, :] % p[:, None, None]) % p[:, None, None]
        # the inverse step on the columns; a sum of residues stays far below 2^63
        moved = h[:, :, k + 1 :] * factors[:, None, :] % p[:, None, None]
        h[:, :, k] = (h[:, :, k] + moved.sum(axis=2)) % wide
    blocks = np.zeros((size + 1, len(p), size + 1), dtype=np.int64)
    blocks[0, :, 0] = 1
    for m in range(1, size + 1):
        grown = np.zeros((len(p), size + 1), dtype=np.int64)
        grown[:, 1:] = blocks[m - 1, :, :-1]
        grown = (grown - h[:, m - 1, m - 1, None] * blocks[m - 1]) % wide
        chain = np.ones(len(p), dtype=np.int64)
        for i in range(1, m):
            chain = chain * h[:, m - i, m - i - 1] % p
            share = h[:, m - i - 1, m - 1] * chain % p
            grown = (grown - share[:, None] * blocks[m - i - 1]) % wide
        blocks[m] = grown
    return blocks[size]


def remaindered(residues: Sequence[Sequence[int]], moduli: Sequence[int]) -> list[int]:
    """The integer coefficients, each within half the product of the primes of zero."""
    product = math.prod(moduli)
    weights = [(product // p) * pow(product // p, -1, p) for p in moduli]
    sums = [sum(w * int(r[k]) for w, r in zip(weights, residues)) % product for k in range(len(residues[0]))]
    return [s - product if 2 * s > product else s for s in sums]


def _roots_above(polynomial: Sequence[int], place: int) -> int:
    """How many roots, by multiplicity, lie above an integer place; exact for real roots."""
    shifted = list(polynomial)
    for low in range(len(shifted) - 1):
        for k in range(len(shifted) - 2, low - 1, -1):
            shifted[k] += place * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _scaled(polynomial: Sequence[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2^bits times as large."""
    degree = len(polynomial) - 1
    return [c << (bits * (degree - k)) for k, c in enumerate(polynomial)]


def _isolated(polynomial: Sequence[int], low: int, high: int, above: int, inside: int, need: int) -> Iterator[tuple[int, int, int]]:
    """(low, high, roots) in falling order: (low, high] holds one root, or is one wide."""
    if not inside or above >= need:
        return
    if inside == 1 or high - low == 1:
        yield low, high, inside
        return
    middle = (low + high) // 2
    over = _roots_above(polynomial, middle) - above
    yield from _isolated(polynomial, middle, high, above, over, need)
    yield from _isolated(polynomial, low, middle, above + over, inside - over, need)


def largest_roots(polynomial: Sequence[int], need: int) -> list[tuple[Decimal, int]]:
    """The `need` largest positive roots and their multiplicities, in falling order.

    The roots must all be real and none negative. The last root is given with its whole
    multiplicity, so their number may exceed `need`.
    """
    zero = next(k for k, c in enumerate(polynomial) if c)
    polynomial = list(polynomial[zero:])  # without the roots that are zero
    degree = len(polynomial) - 1
    if not degree:
        return []
    largest = -polynomial[-2]  # the sum of the roots
    fine = max(8, ROOT_BITS - largest.bit_length() + 2 * degree.bit_length())
    coarse = 8  # bits after the point at which well separated roots are told apart
    found: list[tuple[Decimal, int]] = []
    part = _scaled(polynomial, coarse)
    top = largest << coarse
    for low, high, inside in _isolated(part, 0, top, 0, degree, need):
        if inside > 1:  # within 2^-8 of each other: look closer, or take them as one
            closer = _scaled(polynomial, fine)
            shift = fine - coarse
            above = _roots_above(closer, high << shift)
            for a, b, n in _isolated(closer, low << shift, high << shift, above, inside, need):
                found.append((_refined(closer, a, b, n, fine), n))
        else:
            found.append((_refined(part, low, high, 1, coarse), 1))
    return found


def _refined(polynomial: Sequence[int], low: int, high: int, inside: int, bits: int) -> Decimal:
    """The root in (low, high] of the scaled polynomial, as a decimal."""
    with localcontext() as context:
        context.prec = DIGITS + 2 * len(polynomial)
        if inside > 1:
            return Decimal(high) / (1 << bits)
        values = [Decimal(c) for c in polynomial]

        def value(x: Decimal) -> Decimal:
            total = Decimal(0)
            for c in reversed(values):
                total = total * x + c
            return total

        a, b = Decimal(low), Decimal(high)
        at_b = value(b)
        if not at_b:
            return b / (1 << bits)
        # a single root in between: the sign changes, so a secant kept inside by halving
        tiny = Decimal(2) ** -ROOT_BITS * (abs(b) + 1)
        slope = [c * k for k, c in enumerate(values)][1:]
        x = b
        while b - a > tiny:
            steep = Decimal(0)
            for c in reversed(slope):
                steep = steep * x + c
            at_x = value(x)
            step = at_x / steep if steep else Decimal(0)
            new = x - step
            if not (a < new < b) or not steep:
                new = (a + b) / 2
            at_new = value(new)
            if not at_new:
                return new / (1 << bits)
            if (at_new > 0) == (at_b > 0):
                b = new
            else:
                a = new
            if abs(new - x) <= tiny:
                return new / (1 << bits)
            x = new
        return (a + b) / 2 / (1 << bits)


def null_vectors(matrix: Sequence[Sequence[int]], root: Decimal, count: int) -> list[list[Decimal]]:
    """`count` orthonormal eigenvectors of a root of that multiplicity, by inverse iteration."""
    size = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        a = [[Decimal(x) for x in row] for row in matrix]
        for k in range(size):
            a[k][k] -= root
        scale = max((abs(x) for row in a for x in row), default=Decimal(1)) or Decimal(1)
        least = scale * Decimal(10) ** -(DIGITS // 2 + 10)
        order = list(range(size))
        for k in range(size):  # rows are exchanged for the largest pivot
            pivot = max(range(k, size), key=lambda i: abs(a[i][k]))
            a[k], a[pivot] = a[pivot], a[k]
            order[k], order[pivot] = order[pivot], order[k]
            if abs(a[k][k]) < least:
                a[k][k] = least
            head = a[k]
            for i in range(k + 1, size):
                row = a[i]
                if row[k]:
                    f = row[k] / head[k]
                    row[k] = f
                    for j in range(k + 1, size):
                        row[j] -= f * head[j]

        def solved(b: list[Decimal]) -> list[Decimal]:
            y = [b[i] for i in order]
            for i in range(size):
                row = a[i]
                y[i] -= sum((row[j] * y[j] for j in range(i)), Decimal(0))
            for i in reversed(range(size)):
                row = a[i]
                y[i] = (y[i] - sum((row[j] * y[j] for j in range(i + 1, size)), Decimal(0))) / row[i]
            return y

        def apart(v: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
            for _ in range(2):
                for o in others:
                    along = sum((x * y for x, y in zip(v, o)), Decimal(0))
                    v = [x - along * y for x, y in zip(v, o)]
            length = sum((x * x for x in v), Decimal(0)).sqrt()
            return [x / length for x in v]

        # any start that is not orthogonal to the null space will do; these are fixed
        starts = [
            [Decimal((i + 1) * (s * size + i + 3) * 7919 % 1009 + 1) for i in range(size)]
            for s in range(count)
        ]
        vectors = starts
        for _ in range(3):
            done: list[list[Decimal]] = []
            for v in vectors:
                done.append(apart(solved(v), done))
            vectors = done
        return vectors
