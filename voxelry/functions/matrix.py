"""3x3 and 4x4 matrix algebra on ``array<double>`` columns (row-major), as plain column arithmetic."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def cells(matrix: Column, n: int) -> list[list[Column]]:
    return [[matrix[r * n + c] for c in range(n)] for r in range(n)]


def pack(rows: list[list[Column]]) -> Column:
    return F.array(*[c for row in rows for c in row])


def product(a: list[list[Column]], b: list[list[Column]]) -> list[list[Column]]:
    inner, width = len(b), len(b[0])
    return [[reduce(add, (row[t] * b[t][c] for t in range(inner))) for c in range(width)] for row in a]


def transpose(a: list[list[Column]]) -> list[list[Column]]:
    return [list(col) for col in zip(*a)]


def det3(m: list[list[Column]]) -> Column:
    return (m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
            - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
            + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0]))


def inverse3(m: list[list[Column]]) -> list[list[Column]]:
    d = det3(m)

    def cofactor(r: int, c: int) -> Column:
        a, b = [x for x in range(3) if x != r]
        p, q = [x for x in range(3) if x != c]
        minor = m[a][p] * m[b][q] - m[a][q] * m[b][p]
        return minor if (r + c) % 2 == 0 else -minor

    return [[cofactor(c, r) / d for c in range(3)] for r in range(3)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, so composed matrices do not multiply the expression size."""
    return F.transform(F.array(value), body)[0]


def matmul4(a: Column, b: Column) -> Column:
    return let(F.struct(a.alias("a"), b.alias("b")), lambda s: pack(product(cells(s["a"], 4), cells(s["b"], 4))))


def inverse_affine(a: Column) -> Column:
    """Inverse of an affine whose last row is 0 0 0 1."""
    def with_rotation(s: Column) -> Column:
        rot, shift = cells(s["r"], 3), [s["a"][4 * r + 3] for r in range(3)]
        moved = [-reduce(add, (rot[r][t] * shift[t] for t in range(3))) for r in range(3)]
        zero, one = F.lit(0.0), F.lit(1.0)
        return pack([[*rot[r], moved[r]] for r in range(3)] + [[zero, zero, zero, one]])

    def rotation(m: Column) -> Column:
        return let(F.struct(pack(inverse3([row[:3] for row in cells(m, 4)[:3]])).alias("r"), m.alias("a")), with_rotation)

    return let(a, rotation)


def origin_voxel(a: Column) -> Column:
    """Voxel coordinates (array of three) of the origin of the space that an affine maps to.

    The three equations are solved by elimination with row exchanges, each unknown by one division: an origin that lies on a voxel comes out on it, where
    the product with an inverse, off by the rounding of its determinant, may come out just beyond.
    """
    def pivot(rows: Column, c: int) -> Column:
        # the row with the largest entry comes first, the earlier one on ties
        order = F.transform(rows, lambda r, n: F.struct((-F.abs(r[c])).alias("x"), n.alias("n"), r.alias("r")))
        return F.transform(F.array_sort(order), lambda s: s["r"])

    def minus(r: Column, factor: Column, other: Column) -> Column:
        return F.zip_with(r, other, lambda x, y: x - factor * y)

    def without(rows: Column, c: int) -> Column:
        """The pivot row and the others freed of unknown ``c``."""
        first = rows[0]
        return F.transform(rows, lambda r, n: F.when(n == 0, r).otherwise(minus(r, r[c] / first[c], first)))

    def back(one: Column, two: Column, three: Column) -> Column:
        two, one = minus(two, two[2] / three[2], three), minus(one, one[2] / three[2], three)
        one = let(F.struct(one.alias("a"), two.alias("b")), lambda s: minus(s["a"], s["a"][1] / s["b"][1], s["b"]))
        return F.array(one[3] / one[0], two[3] / two[1], three[3] / three[2])

    def last(first: Column, rest: Column) -> Column:
        return let(F.struct(first.alias("f"), without(pivot(rest, 1), 1).alias("t")), lambda s: back(s["f"], s["t"][0], s["t"][1]))

    equations = F.array(*[F.array(*[a[4 * r + c] for c in range(3)], -a[4 * r + 3]) for r in range(3)])
    return let(without(pivot(equations, 0), 0), lambda rows: last(rows[0], F.slice(rows, 2, 2)))


def apply_affine(a: Column, point: list[Column]) -> list[Column]:
    return [a[r * 4] * point[0] + a[r * 4 + 1] * point[1] + a[r * 4 + 2] * point[2] + a[r * 4 + 3] for r in range(3)]


def from_rigid12(m: Column) -> Column:
    """4x4 affine of a stored rigid transform (nine rotation, then three translation values)."""
    zero, one = F.lit(0.0), F.lit(1.0)
    return pack([[m[3 * r], m[3 * r + 1], m[3 * r + 2], m[9 + r]] for r in range(3)] + [[zero, zero, zero, one]])
