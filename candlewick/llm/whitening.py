"""Whitening of embeddings on components from the exact characteristic polynomial.

Entries are fitted as whole numbers: c becomes floor(256 c). The fit list holds each distinct vector once. Tasks add up
counts, sums and products as whole numbers, exactly, and the sums over all tasks make the integer scatter
M = n * sum(x x') - S S' (the covariance times n squared). Only this matrix, whose size is the number of dimensions,
reaches the driver.

There M is reduced to Hessenberg form modulo many 31-bit primes, which gives its characteristic polynomial modulo each,
and Chinese remaindering gives the whole coefficients, bounded beforehand by the trace. All roots are real, so by
Descartes' rule the changes of sign of the polynomial shifted by a count exactly the roots above a: bisection by that
count isolates the largest roots, by the sign of the polynomial narrows each down to 2^-DEPTH of the trace. Roots that
are closer than that count as one of higher multiplicity. Trailing zero coefficients tell how many roots are zero.
A component is found in the null space of M minus its root, by inverse iteration in decimals of DIGITS places, a root of
multiplicity m with m orthogonal starts. It turns to doubles at the very end.

Vectors that are null or hold a null, a NaN or an infinity take no part, nor do vectors of another length than the most
frequent one (of equally frequent lengths the longer). A component whose variance is zero cannot be whitened and has no
rows, so there are fewer than four where the fit list spans fewer dimensions, and none for an empty table or equal
vectors. Entries beyond a long become the nearest long; a deviation beyond a long is null. A null vec_id is carried,
repeated rows each get their rows, other columns are not read.
"""

from __future__ import annotations

import decimal
import math
import random
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.frames import column
from candlewick.sources.scratch import materialise

COMPONENTS = 4
SCALE = 256
DEPTH = 220  # bits below the trace to which a root is narrowed down
DIGITS = 160  # decimal places of inverse iteration
_ROWS = 4096  # rows multiplied at a time
_LIMB, _LIMBS = 40, 4  # whole numbers travel as four parts of 40 bits, the last one signed


class Components(NamedTuple):
    n: int
    sums: list[int]
    vectors: np.ndarray  # a row for each component
    scale: np.ndarray  # square roots of the eigenvalues of the covariance
    explained: np.ndarray


# --- whole numbers over all rows ---------------------------------------------------------------------------------


def fixed(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id and x, the vector in whole numbers, of the rows that take part."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf"))
    picked = df.select(column(df, key).alias("vec_id"), column(df, vector).alias("v"))
    sound = picked.where(F.col("v").isNotNull() & F.forall("v", entry))
    return sound.select("vec_id", F.transform("v", lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def matrix(array: pa.Array) -> np.ndarray:
    """A column of equally long lists of longs as rows."""
    values = array.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(array), -1) if len(array) else values.reshape(0, 0)


def _products(x: np.ndarray) -> np.ndarray:
    """x' x in Python's whole numbers."""
    top = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if 2 * top.bit_length() + _ROWS.bit_length() <= 53:  # every sum is a whole number that a double holds
        f = x.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = x.astype(object)
    return o.T @ o


def _limbs(value: int) -> list[int]:
    parts = [(value >> (_LIMB * i)) & ((1 << _LIMB) - 1) for i in range(_LIMBS - 1)]
    return [*parts, value >> (_LIMB * (_LIMBS - 1))]


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (i, j, parts of the sum): products for i <= j, sums of entries for i = -1, the count for i = j = -1."""
    total, sums, n = None, None, 0
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            x = matrix(batch.column(0).slice(at, _ROWS))
            product, own = _products(x), x.astype(object).sum(axis=0) if len(x) else 0
            total, sums, n = (product, own, len(x)) if total is None else (total + product, sums + own, n + len(x))
    if not n:
        return
    dims = len(sums)
    rows = [(-1, -1, n), *((-1, i, int(s)) for i, s in enumerate(sums))]
    rows += [(i, j, int(total[i, j])) for i in range(dims) for j in range(i, dims)]
    columns = list(zip(*((i, j, *_limbs(v)) for i, j, v in rows)))
    names = ["i", "j", *(f"p{k}" for k in range(_LIMBS))]
    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in columns[:2]), *(pa.array(c, pa.int64()) for c in columns[2:])], names=names)


def scatter(distinct: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """n, sums and M of the distinct vectors `x`. What comes to the driver grows with dims squared only."""
    parts = [f"p{k}" for k in range(_LIMBS)]
    partial = distinct.select("x").mapInArrow(_partial_sums, "i int, j int, " + ", ".join(f"{p} long" for p in parts))
    whole = {
        (r.i, r.j): sum(r[p] << (_LIMB * k) for k, p in enumerate(parts))
        for r in partial.groupBy("i", "j").agg(*(F.sum(p).alias(p) for p in parts)).collect()
    }
    n = whole.get((-1, -1), 0)
    s = [whole.get((-1, i), 0) for i in range(dims)]
    m = [[n * whole.get((min(i, j), max(i, j)), 0) - s[i] * s[j] for j in range(dims)] for i in range(dims)]
    return n, s, m


# --- the characteristic polynomial -------------------------------------------------------------------------------


def primes(below: int = 1 << 31) -> Iterator[int]:
    """Primes in falling order; four bases settle the test for numbers of 31 bits."""
    for p in range(below - 1, 3, -2):
        if all(p % q for q in (3, 5, 7, 11, 13)) and all(_passes(p, b) for b in (2, 3, 5, 7)):
            yield p


def _passes(p: int, base: int) -> bool:
    odd = (p - 1) // ((p - 1) & (1 - p))
    x = pow(base, odd, p)
    if x in (1, p - 1):
        return True
    while odd * 2 < p - 1:
        x, odd = x * x % p, odd * 2
        if x == p - 1:
            return True
    return False


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to `a` modulo p, zero below the first subdiagonal."""
    a, d = a.copy(), len(a)
    for m in range(1, d - 1):
        rows = np.flatnonzero(a[m:, m - 1])
        if not len(rows):
            continue
        i = m + int(rows[0])
        if i != m:
            a[[i, m]] = a[[m, i]]
            a[:, [i, m]] = a[:, [m, i]]
        u = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1 :] = (a[m + 1 :] - u[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * u % p).sum(axis=1)) % p
    return a


def polynomial_mod(a: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x I - a) modulo p, highest power first, by the recurrence over leading blocks."""
    h, d = hessenberg(a, p), len(a)
    known = np.zeros((d + 1, d + 1), np.int64)  # row k: block of size k, lowest power first
    known[0, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros(d + 1, np.int64)
        new[1:] = known[k - 1, :-1]
        new = (new - h[k - 1, k - 1] * known[k - 1]) % p
        below, factors = 1, []
        for i in range(k - 1, 0, -1):  # the product of the subdiagonal from row i + 1 to k
            below = below * int(h[i, i - 1]) % p
            if not below:
                break
            factors.append(int(h[i - 1, k - 1]) * below % p)
        if factors:
            first = k - 1 - len(factors)
            c = np.array(factors[::-1], np.int64)
            new = (new - (c[:, None] * known[first : k - 1] % p).sum(axis=0)) % p
        known[k] = new
    return known[d, ::-1].tolist()


def characteristic_polynomial(m: list[list[int]]) -> list[int]:
    """Whole coefficients of det(x I - m) for a positive semidefinite m, highest power first."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    # the k-th coefficient is a sum of products of k roots: at most the one for equal roots of the same sum
    bound = 2 * max(-(-math.comb(d, k) * trace**k // d**k) for k in range(d + 1)) + 1
    product, found = 1, [0] * (d + 1)
    for p in primes():
        own = polynomial_mod(np.array([[v % p for v in row] for row in m], np.int64), p)
        lift = product * pow(product, -1, p)
        found = [c + lift * ((r - c) % p) for c, r in zip(found, own)]
        product *= p
        found = [c % product for c in found]
        if product > bound:
            break
    return [c - product if 2 * c > product else c for c in found]


# --- roots and components ----------------------------------------------------------------------------------------


def roots_above(coefficients: list[int], a: int) -> int:
    """How many roots, with multiplicity, are larger than a; exact where all roots are real."""
    shifted = list(coefficients)
    for last in range(len(shifted), 1, -1):
        for i in range(1, last):
            shifted[i] += a * shifted[i - 1]
    signs = [c > 0 for c in shifted if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(coefficients: list[int], a: int) -> int:
    value = 0
    for c in coefficients:
        value = value * a + c
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], wanted: int) -> list[tuple[Decimal, int]]:
    """(root, multiplicity) of the largest roots above zero, until `wanted` of them are covered."""
    zeros = len(coefficients) - max(i + 1 for i, c in enumerate(coefficients) if c)
    wanted = min(wanted, len(coefficients) - 1 - zeros)
    if not wanted:
        return []
    trace = -coefficients[1]
    shift = max(0, DEPTH - trace.bit_length())  # roots are looked for in units of 2^-shift
    scaled = [c << (shift * k) for k, c in enumerate(coefficients)]
    found, above = [], 0
    high = (trace << shift) + 1
    while above < wanted:
        low, top = 0, high
        count = roots_above(scaled, low)
        while top - low > 1 and count - above > 1:  # until one root is left, or several that cannot be told apart
            middle = (low + top) // 2
            n = roots_above(scaled, middle)
            low, top, count = (middle, top, n) if n > above else (low, middle, count)
        if count - above == 1:
            side = _sign(scaled, top)
            while top - low > 1:
                middle = (low + top) // 2
                s = _sign(scaled, middle)
                if s == 0:
                    low = top = middle
                elif s == side:
                    top = middle
                else:
                    low = middle
        with decimal.localcontext(prec=DIGITS):
            found.append((Decimal(low + top) / 2 / (1 << shift), count - above))
        above, high = count, low
    return found


def _factored(a: np.ndarray, tiny: Decimal) -> tuple[np.ndarray, list[int]]:
    """LU parts with partial pivoting; a vanishing pivot, which a root brings about, becomes `tiny`."""
    a, order = a.copy(), list(range(len(a)))
    for k in range(len(a)):
        i = max(range(k, len(a)), key=lambda r: abs(a[r, k]))
        if i != k:
            a[[i, k]] = a[[k, i]]
            order[i], order[k] = order[k], order[i]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
        a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.outer(a[k + 1 :, k], a[k, k + 1 :])
    return a, order


def _solved(factors: tuple[np.ndarray, list[int]], b: np.ndarray) -> np.ndarray:
    a, order = factors
    x = b[order]
    for k in range(len(a)):
        x[k + 1 :] = x[k + 1 :] - np.multiply.outer(a[k + 1 :, k], x[k])
    for k in range(len(a) - 1, -1, -1):
        x[k] = x[k] / a[k, k]
        x[:k] = x[:k] - np.multiply.outer(a[:k, k], x[k])
    return x


def _orthonormal(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    done: list[np.ndarray] = []
    for j in range(x.shape[1]):
        v = x[:, j]
        for _ in range(2):
            for u in [*others, *done]:
                v = v - u * (u @ v)
        done.append(v / (v @ v).sqrt())
    return np.stack(done, axis=1)


def null_space(m: list[list[int]], root: Decimal, multiplicity: int, others: list[np.ndarray]) -> list[np.ndarray]:
    """Orthonormal vectors of the null space of m - root, by inverse iteration in decimals."""
    with decimal.localcontext(prec=DIGITS):
        d = len(m)
        a = np.array([[Decimal(v) for v in row] for row in m], object).reshape(d, d)
        trace = sum(a[i, i] for i in range(d))
        for i in range(d):
            a[i, i] -= root
        factors = _factored(a, trace * Decimal(10) ** (20 - DIGITS))
        draw = random.Random(d)
        x = np.array([[Decimal(draw.randrange(1, 1 << 30)) for _ in range(multiplicity)] for _ in range(d)], object)
        x = _orthonormal(x, others)
        for _ in range(8):
            before, x = x, _orthonormal(_solved(factors, x), others)
            away = before - x @ (x.T @ before)  # what the last step left of the old space outside the new one
            if max(abs(v) for v in away.ravel()) < Decimal(10) ** -30:
                break
        vectors = []
        for j in range(multiplicity):
            v = x[:, j]
            vectors.append(-v if v[max(range(d), key=lambda i: abs(v[i]))] < 0 else v)
        return vectors


def components(n: int, sums: list[int], m: list[list[int]], wanted: int = COMPONENTS) -> Components:
    trace = sum(m[i][i] for i in range(len(m)))
    vectors: list[np.ndarray] = []
    scale, explained = [], []
    if trace:
        for root, multiplicity in largest_roots(characteristic_polynomial(m), wanted):
            vectors += null_space(m, root, multiplicity, vectors)
            with decimal.localcontext(prec=DIGITS):
                scale += [float(root.sqrt() / n)] * multiplicity
                explained += [float(root / trace)] * multiplicity
    count = min(wanted, len(vectors))
    rows = np.array([[float(e) for e in v] for v in vectors[:count]], np.float64).reshape(count, len(m))
    return Components(n, sums, rows, np.array(scale[:count]), np.array(explained[:count]))


# --- every row ---------------------------------------------------------------------------------------------------


def project(rows: DataFrame, found: Components) -> DataFrame:
    """vec_id, deviation and `whitened`, an array with a number for each component, of rows (vec_id, x)."""
    schema = T.StructType(
        [
            rows.schema["vec_id"],
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )
    n, sums, width = found.n, np.array(found.sums, object), len(found.scale)
    low = max((abs(s) for s in found.sums), default=0)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                x = matrix(batch.column(1).slice(at, _ROWS))
                top = max(int(x.max(initial=0)), -int(x.min(initial=0)))
                if (n * top + low) ** 2 * x.shape[1] < 1 << 63:
                    apart = n * x - sums.astype(np.int64)
                    deviation = (apart * apart).sum(axis=1).tolist()
                else:
                    apart = n * x.astype(object) - sums
                    deviation = [v if v < 1 << 63 else None for v in (apart * apart).sum(axis=1).tolist()]
                values = (apart.astype(np.float64) / n) @ found.vectors.T / found.scale
                offsets = np.arange(len(x) + 1, dtype=np.int32) * width
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
                columns = [batch.column(0).slice(at, _ROWS), pa.array(deviation, pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(task, schema)


def identity_error(distinct: DataFrame, found: Components) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    width = len(found.scale)
    fitted = project(distinct.select(F.lit(0).alias("vec_id"), "x"), found)
    fitted = fitted.select(*(F.col("whitened")[i].alias(f"w{i}") for i in range(width)))
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    covariance = fitted.agg(*(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(covariance[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(df: DataFrame, vector: str = "embedding", key: str = "vec_id", wanted: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    rows = materialise(fixed(df, vector, key), "whole-vectors")
    distinct = materialise(rows.select("x").distinct(), "distinct-vectors")
    common = distinct.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = common.dims if common else 0
    rows, distinct = (t.where(F.size("x") == dims) for t in (rows, distinct))
    found = components(*scatter(distinct, dims), wanted)
    if not len(found.scale):
        named = rows.select("vec_id", F.lit(0).alias("component"), *(F.lit(0).cast("long").alias(c) for c in ("n", "deviation")))
        return named.select("*", *(F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error"))).limit(0)
    error = identity_error(distinct, found)
    shares = F.array(*(F.lit(float(e)) for e in found.explained))
    each = project(rows, found).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("place")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
