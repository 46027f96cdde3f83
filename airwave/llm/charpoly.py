"""Characteristic polynomials of integer matrices, exactly, and what follows from them.

A polynomial is a list of integers, the leading coefficient first. Matrices are numpy arrays of Python's
integers. All work grows with the matrix alone, never with the rows it was summed from.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np

#: Bits kept behind the point of a root and of the solutions of its equations.
BITS = 128


def is_prime(n: int) -> bool:
    """Miller-Rabin; with these bases exact below 3.4e14."""
    if n < 2 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7, 11, 13, 17):
        if n % base == 0:
            return n == base
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(matrix: np.ndarray) -> list[int]:
    """Primes below 2^31 whose product tells all coefficients of the polynomial apart.

    For a positive semidefinite matrix of size d the k-th coefficient is at most C(d, k) (trace / d)^k.
    """
    d = len(matrix)
    mean = -(-sum(int(matrix[i, i]) for i in range(d)) // d) if d else 0
    bound = 2 * max(math.comb(d, k) * mean**k for k in range(d + 1)) + 1
    primes, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(n):
            primes.append(n)
            product *= n
        n -= 2
    return primes


def charpoly_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """det(x I - matrix) modulo a prime, by reduction to Hessenberg form."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        if (j := k + int(below[0])) != k:
            h[[k, j]] = h[[j, k]]
            h[:, [k, j]] = h[:, [j, k]]
        u = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        # Similar by I - u e_k: rows below lose multiples of row k, column k gains their columns.
        h[k + 1 :] = (h[k + 1 :] - u[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * u % p).sum(axis=1)) % p
    # Rows of `minors`: the polynomials of the leading blocks, lowest coefficient first.
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, d + 1):
        weights = np.zeros(k, np.int64)
        product = 1
        for i in range(k - 1, -1, -1):
            weights[i] = h[i, k - 1] * product % p
            if i:
                product = product * int(h[i, i - 1]) % p
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] = (minors[k] - (weights[:, None] * minors[:k] % p).sum(axis=0)) % p
    return minors[d, ::-1].copy()


def from_remainders(remainders: dict[int, list[int]]) -> list[int]:
    """The integers, of either sign, with these remainders by prime (Chinese remainder theorem)."""
    product = math.prod(remainders)
    size = len(next(iter(remainders.values())))
    total = [0] * size
    for p, values in remainders.items():
        rest = product // p
        unit = rest * pow(rest, -1, p)
        total = [t + unit * int(v) for t, v in zip(total, values, strict=True)]
    total = [t % product for t in total]
    return [t - product if 2 * t > product else t for t in total]


def _shifted(poly: list[int], by: int) -> list[int]:
    """poly(x + by)."""
    out = list(poly)
    for end in range(len(out) - 1, 0, -1):
        for i in range(1, end + 1):
            out[i] += by * out[i - 1]
    return out


def roots_above(poly: list[int], a: int) -> int:
    """How many roots, with multiplicity, lie above `a`; exact where all roots are real (Descartes)."""
    signs = [c > 0 for c in _shifted(poly, a) if c]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2^bits times those of `poly`."""
    return [c << (bits * i) for i, c in enumerate(poly)]


def isolated(poly: list[int], most: int, bits: int = BITS) -> Iterator[tuple[int, int, int]]:
    """Intervals (low, high, roots), falling, with the `most` largest positive roots; all must be real.

    `poly` is scaled by `bits`, and so are the ends. An interval is (low, high], low is 0 or more, and holds
    one root, or several that agree to `bits` places behind the point.
    """
    # The sum of all roots is above each of them.
    high = max(-poly[1], 0) + 1 if len(poly) > 1 else 1
    above = {0: roots_above(poly, 0), high: 0}
    stack, given = [(0, high)], 0
    while stack and given < most:
        low, high = stack.pop()
        roots = above[low] - above[high]
        if roots == 0:
            continue
        if roots == 1 or high - low == 1:
            yield low, high, roots
            given += roots
            continue
        middle = (low + high) // 2
        above[middle] = roots_above(poly, middle)
        stack += [(low, middle), (middle, high)]


def refined(poly: list[int], low: int, high: int, roots: int) -> int:
    """The root in an interval of `isolated`, to the next integer above: to all places kept."""
    if roots > 1:
        return high

    def value(x: int) -> int:
        y = 0
        for c in poly:
            y = y * x + c
        return y

    # Right of its only root here the polynomial has the sign it has at the upper end.
    if (at_high := value(high)) == 0:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if (at := value(middle)) == 0:
            return middle
        low, high = (low, middle) if (at > 0) == (at_high > 0) else (middle, high)
    return high


def null_vectors(matrix: np.ndarray, root: int, count: int, bits: int = BITS) -> list[np.ndarray]:
    """`count` orthonormal vectors v, as doubles, with matrix v = root v, by inverse iteration.

    `root` is scaled by 2^bits, close to an eigenvalue of that multiplicity. Equations are solved in
    fixed-point arithmetic with `bits` places. The largest entry of each vector is positive.
    """
    d = len(matrix)
    a = np.array([[int(v) << bits for v in row] for row in matrix], object).reshape(d, d)
    for i in range(d):
        a[i, i] -= root
    order = list(range(d))
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(a[i, k]))
        a[[k, best]] = a[[best, k]]
        order[k], order[best] = order[best], order[k]
        if a[k, k] == 0:
            a[k, k] = 1
        factor = (a[k + 1 :, k] << bits) // a[k, k]
        a[k + 1 :, k + 1 :] -= (factor[:, None] * a[k, k + 1 :]) >> bits
        a[k + 1 :, k] = factor

    def normed(v: list[int]) -> list[int]:
        shift = max(abs(x) for x in v).bit_length() - bits - 8
        v = [x >> shift if shift > 0 else x << -shift for x in v]
        length = math.isqrt(sum(x * x for x in v)) or 1
        return [(x << bits) // length for x in v]

    def orthogonal(v: list[int], to: list[list[int]]) -> list[int]:
        for u in to:
            along = sum(x * y for x, y in zip(u, v, strict=True)) >> bits
            v = [x - (along * y >> bits) for x, y in zip(v, u, strict=True)]
        return normed(v)

    found: list[list[int]] = []
    for number in range(count):
        draw = random.Random(number)
        v = normed([draw.getrandbits(bits) + 1 for _ in range(d)])
        for _ in range(3):
            x = [v[i] for i in order]
            for k in range(d):
                for i in range(k + 1, d):
                    x[i] -= int(a[i, k]) * x[k] >> bits
            for k in range(d - 1, -1, -1):
                rest = sum(int(a[k, j]) * x[j] for j in range(k + 1, d)) >> bits
                x[k] = ((x[k] - rest) << bits) // int(a[k, k])
            v = orthogonal(normed(x), found)
        # Once more, as the first pass leaves what was lost to rounding.
        found.append(orthogonal(v, found))
    out = []
    for v in found:
        sign = 1 if max(v, key=abs) > 0 else -1
        out.append(np.array([sign * x / (1 << bits) for x in v]))
    return out
