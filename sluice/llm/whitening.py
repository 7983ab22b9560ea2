"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter matrix.

Entries become integers ``floor(64 c) + 1000000``. Over the distinct integer
vectors Spark sums counts, sums and products exactly. Their scatter matrix
``n * sum(x x') - S S'`` is an integer matrix, ``n**2`` times the covariance.

* Its characteristic polynomial is found modulo many primes by Hessenberg
  reduction, a row of primes per task, and put together by Chinese remaindering.
* All its roots are real, so the sign changes of the polynomial moved to a
  place count the roots beyond it exactly. Bisection on that count, then on the
  sign, isolates the largest roots to more than double precision.
* Components are null vectors of ``A - root``, by inverse iteration with
  60-digit decimals, one task per root.

Defined results: rows whose vector is null or holds a null, a NaN or an
infinity are left out, and so are vectors of another length than most (the
longer of equally many) and vectors with an entry whose integer is beyond
2**53. Repeated vectors count once in the fit, and every row of them is
returned. Components with eigenvalue 0 can't be scaled and aren't returned, so
a table of one distinct vector, or none, gives an empty result. A root of a
higher multiplicity gives that many orthonormal components. ``deviation`` is
null where it doesn't fit a long. Null and repeated vec_ids pass through; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
ENTRY_BOUND = 1 << 53
# Digits of roots and of the solver, and the bits to which a root is bisected beyond its size.
DIGITS, ROOT_BITS = 100, 200
PRIMES_A_TASK = 16
ROWS_AT_ONCE = 2048


# ---------------------------------------------------------------- integers


def integer_rows(batch_column):
    """Entries of an Arrow list column as integers without the offset: (places of usable rows, list of int64 arrays)."""
    import numpy as np
    import pyarrow as pa

    column = batch_column.cast(pa.list_(pa.float64()))
    ends = column.offsets.to_numpy().astype(np.int64)
    flat = column.values
    values = flat.to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * SCALE)
        usable = np.abs(scaled) <= ENTRY_BOUND  # false for a NaN, which a null becomes too
    bad = np.concatenate([[0], np.cumsum(~usable)])
    valid = np.asarray(column.is_valid())
    good = np.flatnonzero(valid & (bad[ends[1:]] == bad[ends[:-1]]) & (ends[1:] > ends[:-1]))
    numbers = np.where(usable, scaled, 0).astype(np.int64)
    return good, [numbers[ends[i] : ends[i + 1]] for i in good]


def integer_vectors(embeddings: DataFrame, vector: str) -> DataFrame:
    """``x``: the integers of each usable row, packed little-endian without the offset, and ``d``, how many they are."""

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            _, rows = integer_rows(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([r.astype("<i8").tobytes() for r in rows], pa.binary()), pa.array([len(r) for r in rows], pa.int32())], names=["x", "d"])

    return embeddings.select(F.col(vector)).mapInArrow(pack, "x binary, d int")


def exact_products(rows):
    """``rows' @ rows`` of an integer matrix, exactly."""
    import numpy as np

    most = int(np.abs(rows).max(initial=0))
    if most * most * len(rows) < 1 << 53:
        whole = rows.astype(np.float64)
        return (whole.T @ whole).astype(np.int64).astype(object)
    kind = np.int64 if most * most * len(rows) < 1 << 62 else object
    return (rows.T.astype(kind) @ rows.astype(kind)).astype(object)


def exact_sums(vectors: DataFrame, d: int) -> DataFrame:
    """Over vectors ``x``: rows (i, j, total) of sums of products for i <= j, of sums for j = -1, and the count at (-1, -1)."""

    def add(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        products, sums, n = np.zeros((d, d), object), np.zeros(d, object), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.column(0).slice(at, ROWS_AT_ONCE).to_pylist()
                rows = np.frombuffer(b"".join(some), "<i8").reshape(len(some), d)
                products += exact_products(rows)
                sums += rows.astype(object).sum(0) if np.abs(rows).max() > 1 << 50 else rows.sum(0).astype(object)
                n += len(rows)
        if n:
            i, j = np.triu_indices(d)
            lines = [(-1, -1, n), *((int(a), -1, int(s)) for a, s in enumerate(sums)), *((int(a), int(b), int(products[a, b])) for a, b in zip(i, j, strict=True))]
            a, b, total = zip(*lines, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array([str(t) for t in total])], names=["i", "j", "total"])

    parts = vectors.select("x").mapInArrow(add, "i int, j int, total string")
    # 38 digits hold the products of 10**20 rows of entries up to 10**9; beyond, Spark raises an error
    return parts.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


# -------------------------------------------------------- characteristic polynomial


def primes_below(bound: int, how_many: int) -> list[int]:
    """The largest primes below ``bound`` (at most 2**31)."""

    def is_prime(n: int) -> bool:
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # enough below 3.2e9
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

    found, n = [], bound - 1 - bound % 2
    while len(found) < how_many:
        if is_prime(n):
            found.append(n)
        n -= 2
    return found


def polynomial_mod(matrix, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo a prime below 2**31, the constant first."""
    import numpy as np

    d = len(matrix)
    h = (np.asarray(matrix, object) % p).astype(np.int64)
    # similar matrix of Hessenberg form: column by column, what stands below the subdiagonal is cleared
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        factors = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factors[:, None] * h[m] % p) % p
        # a sum of d products of 31-bit numbers is taken in parts that fit 63 bits
        low, high = factors & 0xFFFF, factors >> 16
        columns = h[:, m + 1 :]
        h[:, m] = (h[:, m] + columns @ low % p + (columns @ high % p) * 65536) % p
    # polynomials of the leading blocks
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        now = np.zeros(d + 1, np.int64)
        now[1:] = polys[k - 1, :-1]
        now = (now - h[k - 1, k - 1] * polys[k - 1]) % p
        chain = 1
        for i in range(1, k):
            chain = chain * int(h[k - i, k - i - 1]) % p
            if not chain:
                break
            now = (now - (chain * int(h[k - i - 1, k - 1]) % p) * polys[k - i - 1]) % p
        polys[k] = now
    return polys[d].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(x - matrix) of a symmetric non-negative matrix, the constant first.

    Coefficient d - k is at most the sum of all products of k eigenvalues,
    which is at most ``comb(d, k) * (trace / d)**k``; so many primes are taken.
    """
    from math import comb

    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(comb(d, k) * (trace**k // d**k + 1) for k in range(d + 1))
    primes = primes_below(1 << 31, 2 * bound.bit_length() // 61 + 2)

    def reduce(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            primes = batch.column(0).to_pylist()
            residues = [polynomial_mod(matrix, p) for p in primes]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(residues, pa.list_(pa.int64()))], names=["p", "residues"])

    tasks = -(-len(primes) // PRIMES_A_TASK)
    listed = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    got = listed.mapInArrow(reduce, "p long, residues array<long>").collect()  # d + 1 numbers a prime
    total, coefficients = 1, [0] * (d + 1)
    for row in sorted(got, key=lambda r: r.p):
        inverse = pow(total, -1, row.p)
        coefficients = [c + total * ((r - c) * inverse % row.p) for c, r in zip(coefficients, row.residues, strict=True)]
        total *= row.p
    return [c - total if 2 * c > total else c for c in coefficients]


# ------------------------------------------------------------------- roots


def moved(coefficients: list[int], place: int, bits: int) -> list[int]:
    """A multiple of the polynomial in x, written in y with x = (place + y) / 2**bits."""
    d = len(coefficients) - 1
    c = [a << (bits * (d - k)) for k, a in enumerate(coefficients)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += place * c[k + 1]
    return c


def roots_beyond(coefficients: list[int], place: int, bits: int) -> int:
    """How many roots exceed place / 2**bits, by sign changes; exact as all roots are real."""
    signs = [c > 0 for c in moved(coefficients, place, bits) if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def sign_at(coefficients: list[int], place: int, bits: int) -> int:
    total = 0
    for k, c in enumerate(reversed(coefficients)):
        total = total * place + (c << (bits * k))
    return (total > 0) - (total < 0)


def largest_roots(coefficients: list[int], most: int) -> list[tuple[int, int, int]]:
    """The largest positive roots as (numerator, bits, multiplicity) with value numerator / 2**bits.

    ``most`` roots by multiplicity, falling; the last may bring some more.
    Roots closer than 2**-ROOT_BITS of the largest count as one.
    """
    d = len(coefficients) - 1
    top = max(1, -coefficients[d - 1]).bit_length() if d else 1  # the sum of the roots bounds each
    found: list[tuple[int, int, int]] = []
    # open intervals (low, high], with the number of roots beyond each end; the highest first
    bits = 0
    stack = [(0, 1 << top, bits, roots_beyond(coefficients, 0, 0), 0)]
    while stack and sum(m for *_, m in found) < most:
        low, high, bits, more, less = stack.pop()
        if more == less:
            continue
        if more - less == 1 and sign_at(coefficients, high, bits):
            found.append((*bisected(coefficients, low, high, bits, top), 1))
            continue
        if high - low == 1:
            if bits >= ROOT_BITS - top:
                found.append((2 * low + 1, bits + 1, more - less))
                continue
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        between = roots_beyond(coefficients, middle, bits)
        stack += [(low, middle, bits, more, between), (middle, high, bits, between, less)]
    return found


def bisected(coefficients: list[int], low: int, high: int, bits: int, top: int) -> tuple[int, int]:
    """The one root between two places, bisected by sign to ROOT_BITS below the largest."""
    want = max(bits, ROOT_BITS - top)
    low, high, bits = low << (want - bits), high << (want - bits), want
    above = sign_at(coefficients, high, bits)
    while high - low > 1:
        middle = (low + high) // 2
        sign = sign_at(coefficients, middle, bits)
        if not sign:
            return middle, bits
        if sign == above:
            high = middle
        else:
            low = middle
    return 2 * low + 1, bits + 1


# -------------------------------------------------------------- components


def null_vectors(matrix: list[list[int]], numerator: int, bits: int, how_many: int) -> list[list[float]]:
    """Orthonormal vectors that the matrix less a root sends to nothing, by inverse iteration in long decimals."""
    import decimal

    import numpy as np

    with decimal.localcontext() as context:
        context.prec, context.Emax, context.Emin = DIGITS, decimal.MAX_EMAX, decimal.MIN_EMIN
        context.traps[decimal.Inexact] = False
        number = decimal.Decimal
        d = len(matrix)
        root = number(numerator) / number(2) ** bits
        largest = max(abs(a) for row in matrix for a in row)
        a = np.array([[number(x) for x in row] for row in matrix], object)
        for i in range(d):
            a[i, i] -= root
        tiny = number(largest) * number(10) ** (20 - DIGITS)
        swaps = []
        for k in range(d):  # elimination with the largest pivot; what is exactly singular gets a tiny one
            at = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            swaps.append(at)
            if at != k:
                a[[k, at]] = a[[at, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - a[k + 1 :, k, None] * a[k, k + 1 :]

        def solve(b):
            b = b.copy()
            for k, at in enumerate(swaps):
                if at != k:
                    b[k], b[at] = b[at], b[k]
                b[k + 1 :] = b[k + 1 :] - a[k + 1 :, k] * b[k]
            for k in range(d - 1, -1, -1):
                b[k] = b[k] / a[k, k]
                b[:k] = b[:k] - a[:k, k] * b[k]
            return b

        def unit(b, others):
            for _ in range(2):
                for o in others:
                    b = b - o * (b * o).sum()
            return b / (b * b).sum().sqrt()

        draw, found = np.random.default_rng(13), []
        for _ in range(how_many):
            b = np.array([number(int(x)) for x in draw.integers(1, 1 << 30, d)], object)
            for _ in range(3):
                b = unit(solve(unit(b, found)), found)
            found.append(b)
        return [[float(x) for x in b] for b in found]


def components_of(spark: SparkSession, matrix: list[list[int]], roots: list[tuple[int, int, int]]) -> list[list[float]]:
    """The roots' components in their order, one task per root."""

    def solve(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            at, vectors = [], []
            for place, numerator, bits, how_many in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for v in null_vectors(matrix, int(numerator), bits, how_many):
                    at.append(place)
                    vectors.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(vectors, pa.list_(pa.float64()))], names=["place", "vector"])

    listed = [(k, str(numerator), bits, m) for k, (numerator, bits, m) in enumerate(roots)]
    df = spark.createDataFrame(listed, "place int, numerator string, bits int, m int").repartition(len(roots), "place")
    got = df.mapInArrow(solve, "place int, vector array<double>").collect()  # at most d vectors of d numbers
    return [r.vector for r in sorted(got, key=lambda r: r.place)]


# ------------------------------------------------------------------- whole


class Whitening:
    """What ``fit`` finds: n, exact sums without the offset, components, their eigenvalues and shares of the trace."""

    def __init__(self, n: int, sums: list[int], components: list[list[float]], eigenvalues: list[float], explained: list[float]):
        self.n, self.sums, self.components, self.eigenvalues, self.explained = n, sums, components, eigenvalues, explained
        self.identity_error = 0.0


def whitened_rows(rows, fit):
    """Centred rows projected on the components, over the roots of the eigenvalues."""
    import numpy as np

    exact = exact_centred(rows, fit) / float(fit.n) if fits_long(rows, fit, 1) else (exact_centred(rows, fit) / fit.n).astype(np.float64)
    return exact @ (np.asarray(fit.components) / np.sqrt(fit.eigenvalues)[:, None]).T


def fits_long(rows, fit, power: int) -> bool:
    import numpy as np

    most = fit.n * int(np.abs(rows).max(initial=0)) + max(map(abs, fit.sums))
    return most < 1 << 53 if power == 1 else most * most * len(fit.sums) < 1 << 63


def exact_centred(rows, fit):
    """n * x - S of every row, exactly."""
    import numpy as np

    kind = np.int64 if fits_long(rows, fit, 1) else object
    return fit.n * rows.astype(kind) - np.asarray(fit.sums, kind)


def deviations(rows, fit) -> list[int | None]:
    import numpy as np

    if fits_long(rows, fit, 2):
        return (exact_centred(rows, fit).astype(np.int64) ** 2).sum(1).tolist()
    totals = (exact_centred(rows, fit).astype(object) ** 2).sum(1)
    return [int(t) if t < 1 << 63 else None for t in totals]


def fit_whitening(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct integer vectors; None without two of them."""
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "whitening")
    distinct = scratch.write(integer_vectors(embeddings, vector).groupBy("x", "d").agg(F.count(F.lit(1)).alias("n_rows")), "fit")
    lengths = distinct.groupBy("d").agg(F.sum("n_rows").alias("n")).orderBy(F.desc("n"), F.desc("d")).head()
    if lengths is None:
        return None
    d = lengths.d
    vectors = distinct.where(F.col("d") == d)
    cells = {(r.i, r.j): int(r.total) for r in exact_sums(vectors, d).collect()}  # d * (d + 3) / 2 + 1 numbers
    n, sums = cells[-1, -1], [cells[i, -1] for i in range(d)]
    scatter = [[n * cells[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(scatter[i][i] for i in range(d))
    if not trace:
        return None
    roots = largest_roots(characteristic_polynomial(spark, scatter), components)
    found = components_of(spark, scatter, roots)
    from fractions import Fraction

    values = [Fraction(numerator, 1 << bits) for numerator, bits, m in roots for _ in range(m)]
    eigenvalues, explained = [float(v / n**2) for v in values[:components]], [float(v / trace) for v in values[:components]]
    fit = Whitening(n, sums, found[:components], eigenvalues, explained)
    fit.identity_error = identity_error(vectors, fit)
    return fit


def identity_error(vectors: DataFrame, fit: Whitening) -> float:
    """Largest entry, by size, of the whitened vectors' covariance less the identity."""
    k = len(fit.components)

    def multiply(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros((k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.column(0).slice(at, ROWS_AT_ONCE).to_pylist()
                white = whitened_rows(np.frombuffer(b"".join(some), "<i8").reshape(len(some), -1), fit)
                total += white.T @ white
        places = np.arange(k * k)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(total.ravel())], names=["place", "total"])

    sums = vectors.select("x").mapInArrow(multiply, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    covariance = {r.place: r.total / fit.n for r in sums.collect()}
    return max(abs(v - (p // k == p % k)) for p, v in covariance.items())


def whiten(embeddings: DataFrame, fit: Whitening | None, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """A row per usable row and component: key, component, n, deviation, whitened, explained, identity_error."""
    key_type = embeddings.schema[key].dataType
    schema = T.StructType([T.StructField(key, key_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    if fit is None:
        return embeddings.sparkSession.createDataFrame([], schema)

    def project(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        k, d = len(fit.components), len(fit.sums)
        for batch in batches:
            places, numbers = integer_rows(batch.column(1))
            whole = [i for i, r in enumerate(numbers) if len(r) == d]
            for at in range(0, len(whole), ROWS_AT_ONCE):
                some = whole[at : at + ROWS_AT_ONCE]
                rows = np.stack([numbers[i] for i in some])
                each = np.repeat(places[some], k)
                columns = [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(some))),
                    pa.array(np.full(len(each), fit.n, np.int64)),
                    pa.array(deviations(rows, fit), pa.int64()).take(pa.array(np.repeat(np.arange(len(some)), k))),
                    pa.array(whitened_rows(rows, fit).ravel()),
                    pa.array(np.tile(fit.explained, len(some))),
                    pa.array(np.full(len(each), fit.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return embeddings.select(F.col(key), F.col(vector)).mapInArrow(project, schema)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return whiten(embeddings, fit_whitening(embeddings))
