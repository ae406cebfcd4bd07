"""Similarity and rating expressions.

The Pearson expressions take sums of whole-number ratings. Multiplying each deviation by the item's
rating count removes the division from the averages, so numerators and squared norms are exact and the
test "numerator is zero" does not depend on the order of summation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,0)"


def jaccard(common: Column, size_a: Column, size_b: Column) -> Column:
    return common / (size_a + size_b - common)


def ratio_of_averages(avg_a: Column, avg_b: Column) -> Column:
    """Similarity of two items without a common user: the smaller average over the larger."""
    return F.try_divide(F.least(avg_a, avg_b), F.greatest(avg_a, avg_b))


def amplify(similarity: Column, rho: float) -> Column:
    """Case amplification: positive similarities are raised to ``rho``, others stay."""
    return F.when(similarity > 0, F.pow(similarity, F.lit(float(rho)))).otherwise(similarity)


def blend(alpha: Column, first: Column, second: Column) -> Column:
    return alpha * first + (F.lit(1.0) - alpha) * second


def term_bound(mode: str, largest_rating: int) -> str:
    """SQL of an upper bound, as a double, on every Pearson term of a row.

    With n ratings of at most m, every term is below 4 m^2 n^3, or 12 m^2 n^5 with default voting.
    """
    n, m = "CAST(greatest(rows_a, rows_b) AS double)", float(max(largest_rating, 1))
    return {"common": f"{4 * m * m}D * pow({n}, 3)", "default_voting": f"{12 * m * m}D * pow({n}, 5)"}[mode]


BIGINT_BOUND, DECIMAL_BOUND = 9e18, 9e37


def fits_in_bigint(mode: str, largest_rating: int, most_ratings: int | None = None) -> str | bool:
    """Whether all Pearson terms of items of up to ``most_ratings`` ratings fit; without it, SQL that tells it of a row."""
    if most_ratings is None:
        return f"{term_bound(mode, largest_rating)} < {BIGINT_BOUND}D"
    n, m = float(most_ratings), float(max(largest_rating, 1))
    return {"common": 4 * m * m * n ** 3, "default_voting": 12 * m * m * n ** 5}[mode] < BIGINT_BOUND


def exact_terms(mode: str, largest_rating: int, size: str | None = None) -> dict[str, str]:
    """SQL of the three Pearson terms of a row, each in the cheapest type that holds them.

    bigint, then 38-digit decimals; beyond these, for items of hundreds of millions of ratings with default voting,
    the factors are still exact and only their products are doubles. ``size="small"`` is for rows that are known to fit in
    bigints, ``"large"`` for others; the code then holds no type that isn't needed.
    """
    small, middle = (TERMS[mode](kind) for kind in ("bigint", EXACT))
    if size == "small":
        return small
    bound = term_bound(mode, largest_rating)
    large = default_voting_terms(EXACT, "double") if mode == "default_voting" else middle
    if large != middle:
        middle = {x: f"CASE WHEN {bound} < {DECIMAL_BOUND}D THEN {middle[x]} ELSE {large[x]} END" for x in middle}
    return middle if size == "large" else {
        x: f"CASE WHEN {bound} < {BIGINT_BOUND}D THEN {small[x]} ELSE {middle[x]} END" for x in small}


def pearson_terms(kind: str = EXACT) -> dict[str, str]:
    """SQL of the numerator ``top`` and the squared norms over the common users, scaled to whole numbers.

    The columns of a pair are, for both items x in a and b: ``total_x`` and ``rows_x`` (sum and count of all its
    ratings), ``sum_x`` and ``squares_x`` (over the common users); and ``products`` and ``n_common``.
    """
    return {"top": _as_double(_common_product(kind)), "norm_a": _as_double(_common_norm("a", kind)),
            "norm_b": _as_double(_common_norm("b", kind))}


def default_voting_terms(kind: str = EXACT, product: str | None = None) -> dict[str, str]:
    """The same three terms over the union of the users.

    A user who rated one item only gets, for the other, that item's average over the common users. That vote is
    a constant per pair, so totals over all users of each item suffice and the union is never formed: ``all_sum_x``,
    ``all_squares_x`` and ``raters_x`` over all distinct users of x. The numerator is scaled by rows_a * rows_b * n
    and the norms by rows^2 * n^2; the quotient needs one factor n. ``product`` is the type in which exact factors are
    multiplied, if another one.
    """
    n = _exact("n_common", kind)

    def factor(sql: str) -> str:
        return f"CAST({sql} AS {product})" if product else sql

    def parts(x: str) -> dict[str, str]:
        return {c: _exact(f"{c}_{x}", kind) for c in (
            "total", "rows", "sum", "all_sum", "all_squares", "raters")}

    def deviation(x: str) -> str:
        v = parts(x)
        return factor(f"({v['rows']} * {v['sum']} - {n} * {v['total']})")

    def only(x: str) -> str:
        v = parts(x)
        return factor(f"({v['rows']} * ({v['all_sum']} - {v['sum']}) - ({v['raters']} - {n}) * {v['total']})")

    def norm(x: str, other: str) -> str:
        v, others = parts(x), _exact(f"raters_{other}", kind)
        own = factor(f"({v['rows']} * {v['rows']} * {v['all_squares']} - {_exact('2', kind)} * {v['rows']} * {v['total']} "
               f"* {v['all_sum']} + {v['raters']} * {v['total']} * {v['total']})")
        return f"{factor(n)} * {factor(n)} * {own} + {factor(f'({others} - {n})')} * {deviation(x)} * {deviation(x)}"

    top = (f"{factor(n)} * ({factor(n)} * {factor(f'({_common_product(kind)})')} + {only('a')} * {deviation('b')}"
           f" + {only('b')} * {deviation('a')})")
    return {"top": _as_double(top), "norm_a": _as_double(norm("a", "b")), "norm_b": _as_double(norm("b", "a"))}


def _exact(column: str, kind: str) -> str:
    return f"CAST({column} AS {kind})"


def _as_double(sql: str) -> str:
    return f"CAST({sql} AS double)"


def _common_product(kind: str) -> str:
    names = ("total_a", "rows_a", "sum_a", "total_b", "rows_b", "sum_b", "n_common", "products")
    total_a, rows_a, sum_a, total_b, rows_b, sum_b, n, products = [_exact(x, kind) for x in names]
    return (f"{rows_a} * {rows_b} * {products} - {total_a} * {rows_b} * {sum_b}"
            f" - {total_b} * {rows_a} * {sum_a} + {n} * {total_a} * {total_b}")


def _common_norm(x: str, kind: str) -> str:
    names = (f"total_{x}", f"rows_{x}", f"sum_{x}", f"squares_{x}", "n_common", "2")
    total, rows, part, squares, n, two = [_exact(c, kind) for c in names]
    return f"{rows} * {rows} * {squares} - {two} * {rows} * {total} * {part} + {n} * {total} * {total}"


def pearson_quotient(top: Column, norm_a: Column, norm_b: Column) -> Column:
    """Zero numerator gives similarity 0, which also covers zero norms."""
    return F.when(top == 0, F.lit(0.0)).otherwise(top / (F.sqrt(norm_a) * F.sqrt(norm_b)))


TERMS = {"common": pearson_terms, "default_voting": default_voting_terms}
