"""Exact spectra of positive semidefinite integer matrices.

The characteristic polynomial is found modulo many primes (Hessenberg reduction)
and put together by Chinese remaindering, so its coefficients are exact. All its
roots are real and not negative: the sign variations of the coefficients of
``p(a + t)`` then count the roots above ``a`` exactly, with multiplicity, and
bisection isolates each root to any precision. Null vectors of ``M - root`` come
from inverse iteration in decimal arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext

import numpy as np

#: Bits to which a root is isolated, and decimal digits of the null vectors.
BITS, DIGITS = 90, 70


def primes() -> Iterator[int]:
    """Primes below 2**31, from the largest down: products of two residues fit 64 bits."""
    n = (1 << 31) - 1
    while True:
        # these bases decide every number below 3.2 * 10**9
        if all(pow(a, n - 1, n) == 1 and _strong(n, a) for a in (2, 3, 5, 7)):
            yield n
        n -= 2


def _strong(n: int, a: int) -> bool:
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    x = pow(a, odd, n)
    return x in (1, n - 1) or any((x := x * x % n) == n - 1 for _ in range(twos - 1))


def coefficient_bound(m: list[list[int]]) -> int:
    """No coefficient is larger: their absolute sum is the product of ``1 + root``."""
    d = len(m)
    trace = sum(m[i][i] for i in range(d))
    return (2 + trace // max(d, 1)) ** d


def char_poly_mod(m: np.ndarray, p: int) -> list[int]:
    """Coefficients of ``det(x - m)`` modulo the prime ``p``, lowest first."""
    h = m.astype(np.int64) % p
    d = len(h)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factor % p).sum(axis=1)) % p
    # p_k = (x - h_kk) p_(k-1) - sum over i < k of h_ik * (subdiagonal product from i to k) * p_i
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)
    polys[0, 0] = 1
    below = np.zeros(d, dtype=np.int64)  # products of the subdiagonal from row i + 1 to k
    for k in range(d):
        if k:
            below[:k] = below[:k] * h[k, k - 1] % p
            below[k - 1] = h[k, k - 1]
        new = (-h[k, k] * polys[k]) % p
        new[1:] += polys[k, :-1]
        if k:
            new -= (polys[:k] * (h[:k, k] * below[:k] % p)[:, None] % p).sum(axis=0) % p
        polys[k + 1] = new % p
    return polys[d].tolist()


def remainders(m: list[list[int]], p: int) -> np.ndarray:
    return np.array([[x % p for x in row] for row in m], dtype=np.int64).reshape(len(m), len(m))


def from_residues(residues: dict[int, list[int]]) -> list[int]:
    """Integers nearest zero with the given residues: ``{prime: [residue of each]}``."""
    found, product = None, 1
    for p, r in residues.items():
        if found is None:
            found = list(r)
        else:
            inverse = pow(product, -1, p)
            found = [x + product * ((y - x) * inverse % p) for x, y in zip(found, r)]
        product *= p
    return [x - product if 2 * x > product else x for x in found]


def roots_above(poly: list[int], a: int) -> int:
    """Number of roots above ``a`` (with multiplicity) of a polynomial whose roots are all real."""
    c = list(poly)
    for lo in range(len(c) - 1):  # coefficients of p(a + t) by repeated synthetic division
        for i in range(len(c) - 2, lo - 1, -1):
            c[i] += a * c[i + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _value(poly: list[int], a: int) -> int:
    total = 0
    for c in reversed(poly):
        total = total * a + c
    return total


def kth_root(poly: list[int], k: int) -> tuple[int, int]:
    """The k-th largest root (from 1, with multiplicity) as ``(m, s)``: it lies in ``[m, m + 1] / 2**s``.

    Zero is exact: ``(0, 0)`` if fewer than ``k`` roots are positive.
    """
    if roots_above(poly, 0) < k:
        return 0, 0
    lo, hi = 0, -poly[-2]  # the sum of the roots
    if hi < 1 or roots_above(poly, hi) >= k:
        raise ValueError("the matrix is not positive semidefinite")
    lo, hi = _bisect(poly, k, lo, hi)
    s = max(0, BITS - lo.bit_length())
    d = len(poly) - 1
    fine = [c << s * (d - i) for i, c in enumerate(poly)]  # its roots are 2**s times as large
    return _bisect(fine, k, lo << s, hi << s)[0], s


def _bisect(poly: list[int], k: int, lo: int, hi: int) -> tuple[int, int]:
    """Narrow ``lo < root <= hi`` to ``hi = lo + 1``."""
    above_lo, above_hi = roots_above(poly, lo), roots_above(poly, hi)
    while hi - lo > 1 and above_lo - above_hi > 1:
        mid = (lo + hi) // 2
        above = roots_above(poly, mid)
        lo, hi, above_lo, above_hi = (mid, hi, above, above_hi) if above >= k else (lo, mid, above_lo, above)
    # one root is left: the sign of the value beyond it tells the side
    positive = hi - lo > 1 and above_hi % 2 == 0  # right of the root, below ``above_hi`` larger ones
    while hi - lo > 1:
        mid = (lo + hi) // 2
        v = _value(poly, mid)
        right = v == 0 or (v > 0) == positive
        lo, hi = (lo, mid) if right else (mid, hi)
    return lo, hi


def null_vectors(m: list[list[int]], roots: list[tuple[int, int]]) -> list[list[float]]:
    """Unit vectors of the null spaces of ``m - root``, orthogonal to each other.

    The largest entry (the first of equal ones) is positive. Equal roots get an
    orthonormal basis of their common space.
    """
    d = len(m)
    out: list[list[Decimal]] = []
    with localcontext() as context:
        context.prec = DIGITS
        tiny = Decimal(10) ** -DIGITS * (1 + max((abs(x) for row in m for x in row), default=0))
        for number, (at, s) in enumerate(roots):
            root = (Decimal(2 * at + 1) if at else Decimal(0)) / (2 << s)
            lu, order = _factor([[Decimal(x) - (root if i == j else 0) for j, x in enumerate(row)] for i, row in enumerate(m)], tiny)
            # starts that are no combination of a few axes
            v = [Decimal(1 + (i * 7919 + number * 104729) % 101) for i in range(d)]
            for _ in range(4):
                v = _solve(lu, order, v)
                for _ in range(2):
                    for w in out:
                        dot = sum(x * y for x, y in zip(v, w))
                        v = [x - dot * y for x, y in zip(v, w)]
                    norm = sum(x * x for x in v).sqrt()
                    v = [x / norm for x in v]
            lead = max(range(d), key=lambda i: (abs(v[i]).quantize(Decimal("1e-30")), -i))
            out.append([-x for x in v] if v[lead] < 0 else v)
    return [[float(x) for x in v] for v in out]


def _factor(a: list[list[Decimal]], tiny: Decimal) -> tuple[list[list[Decimal]], list[int]]:
    """LU with row exchanges; a vanishing pivot becomes ``tiny``."""
    d = len(a)
    order = list(range(d))
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i][k]))
        a[k], a[pivot] = a[pivot], a[k]
        order[k], order[pivot] = order[pivot], order[k]
        if abs(a[k][k]) < tiny:
            a[k][k] = tiny
        right = a[k][k + 1 :]
        for i in range(k + 1, d):
            if a[i][k]:
                f = a[i][k] = a[i][k] / a[k][k]
                a[i][k + 1 :] = [x - f * y for x, y in zip(a[i][k + 1 :], right)]
    return a, order


def _solve(lu: list[list[Decimal]], order: list[int], b: list[Decimal]) -> list[Decimal]:
    d = len(lu)
    y = [b[i] for i in order]
    for i in range(d):
        y[i] -= sum(f * x for f, x in zip(lu[i][:i], y))
    for i in range(d - 1, -1, -1):
        y[i] = (y[i] - sum(f * x for f, x in zip(lu[i][i + 1 :], y[i + 1 :]))) / lu[i][i]
    return y
