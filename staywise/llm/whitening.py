"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

X holds the centred vectors as rows. The bidiagonalisation X V = U B alternates products with
X and with its transpose; the singular values and right singular vectors of the small matrix B
give the deviations and components.

Both products of a step come from one pass over the table: a row's share of X v is needed by
its share of the transposed product only. The left vectors have a value per row of the table, but
lie in the range of X, so only their coefficients (``left`` with U = X left) are kept; a row
computes its values again. Each step takes out what the new vector still has of earlier ones,
on both sides (full reorthogonalisation), and repeats that if much was taken out.

The driver holds matrices of d rows and at most d columns for vectors of length d; a pass sends
back a few times d numbers. Nothing else depends on the number of rows.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from staywise.functions.shipping import shipped

#: Components that are given out.
COMPONENTS = 32
#: Entries become whole numbers, floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Whole numbers stay within this, as sums and differences of two must fit in a long.
LARGEST = 1 << 60
#: A triplet is found when its residual is below this share of the largest singular value.
FOUND = 1e-13
#: Deviations below this share of the whole are zero.
ZERO = 1e-9
#: Steps of the search for repeated singular values that a first run cannot see.
PROBE = 8


@dataclass(frozen=True)
class Space:
    """Vectors of one length: their number, exact sums, and components once they are found."""

    n: int
    sums: tuple[int, ...]
    total: float = 0.0  # squared deviations, summed over rows and dimensions
    values: np.ndarray | None = None  # eigenvalues of the covariance, falling
    axes: np.ndarray | None = None  # unit eigenvectors as columns
    error: float = 0.0  # largest entry of the whitened covariance minus the identity

    @property
    def base(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean as its floor and the remainder of the sum."""
        parts = [divmod(s, self.n) for s in self.sums]
        return np.array([q for q, _ in parts], np.int64), np.array([r for _, r in parts], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        floor, rest = self.base
        return (x - floor) - rest / self.n

    @property
    def whitener(self) -> np.ndarray:
        return self.axes / np.sqrt(self.values)


def whole_numbers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole-number matrix of the usable vectors, one pair per length."""
    offsets, entries = column.offsets.to_numpy(), column.values
    numbers = entries.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.r_[0, np.cumsum(~np.isfinite(numbers))]
    length = np.diff(offsets)
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
    for d in np.unique(length[usable]):
        rows = np.flatnonzero(usable & (length == d))
        vectors = numbers[offsets[rows][:, None] + np.arange(d)]
        with np.errstate(over="ignore"):
            scaled = np.clip(np.floor(SCALE * vectors), -LARGEST, LARGEST)
        yield rows, scaled.astype(np.int64) + SHIFT


def _totals(frame: DataFrame) -> dict[int, Space]:
    """Number of vectors and exact sums for each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = {}, {}
        for batch in batches:
            for _, x in whole_numbers(batch.column(1)):
                d = x.shape[1]
                # Halves are summed apart, so that no sum leaves a long.
                add = [(int(h) << 32) + int(low) for h, low in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), strict=True)]
                count[d] = count.get(d, 0) + len(x)
                sums[d] = [a + b for a, b in zip(sums.get(d, [0] * d), add, strict=True)]
        rows = [(d, k, str(v)) for d in sums for k, v in enumerate([count[d], *sums[d]])]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [(), (), ()], [pa.int32(), pa.int32(), pa.string()], strict=True)], ["d", "pos", "v"])

    parts = frame.mapInArrow(run, "d int, pos int, v string").groupBy("d", "pos").agg(F.sum(F.col("v").cast("decimal(38,0)")).cast("string").alias("v"))
    found: dict[int, dict[int, int]] = {}
    for r in parts.collect():  # d + 1 numbers for each length
        found.setdefault(r.d, {})[r.pos] = int(r.v)
    return {d: Space(v[0], tuple(v[k + 1] for k in range(d))) for d, v in found.items()}


def _passed(frame: DataFrame, spaces: dict[int, Space], work) -> dict[int, np.ndarray]:
    """Sums over all rows of ``work(d, centred rows)``, a vector for each length in ``spaces``."""
    load = shipped(frame.sparkSession, (spaces, work))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, share = load()
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in whole_numbers(batch.column(1)):
                d = x.shape[1]
                if d in known:
                    sums[d] = sums.get(d, 0) + share(d, known[d].centred(x))
        for d, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), d, np.int32)), pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], ["d", "pos", "v"])

    parts = frame.mapInArrow(run, "d int, pos int, v double").groupBy("d", "pos").agg(F.sum("v").alias("v"))
    out: dict[int, dict[int, float]] = {}
    for r in parts.collect():  # as many as ``work`` gives
        out.setdefault(r.d, {})[r.pos] = r.v
    return {d: np.array([v[k] for k in range(len(v))]) for d, v in out.items()}


Triplets = tuple[np.ndarray, np.ndarray]


def _fresh(d: int, against: np.ndarray, rng) -> np.ndarray | None:
    """A unit vector orthogonal to the columns of ``against``; None if there is no room."""
    if against.shape[1] >= d:
        return None
    v = rng.standard_normal(d)
    for _ in range(3):
        v -= against @ (against.T @ v)
        v /= np.linalg.norm(v)
    return v


def _run(d: int, wanted: int, locked: Triplets, limit: float, scale: float, rng) -> Generator[np.ndarray, np.ndarray, tuple[Triplets, bool]]:
    """One bidiagonalisation in the complement of ``locked`` triplets.

    Yields matrices [left, y] and is sent the sums of [left, y]'X'Xy and X'Xy over all rows. Ends
    with the leading triplets and True when there is no room for further vectors; or
    when ``wanted`` triplets, or all above ``limit`` if that is given, are found.
    """
    held, sizes = locked
    # Left vectors of the locked triplets, and what the transpose makes of them.
    left, image = held / sizes, held * sizes
    right, alphas, betas = np.zeros((d, 0)), [], []
    v, beta, last = _fresh(d, held, rng), 0.0, np.zeros(d)
    while v is not None:
        y = v - beta * last
        for _ in range(4):
            reply = yield np.column_stack([left, y])
            k = left.shape[1]
            shares, square, product = reply[:k], reply[k], reply[k + 1 : k + 1 + d]
            taken = shares @ shares
            y, product = y - left @ shares, product - image @ shares
            if taken <= 1e-6 * square or square <= (ZERO * scale) ** 2:
                break
        alpha = np.sqrt(max(square - taken, 0.0))
        right = np.column_stack([right, v])
        if alpha <= ZERO * scale:  # X v lies in the span of the left vectors
            alphas.append(0.0)
            w, last = np.zeros(d), np.zeros(d)
        else:
            alphas.append(alpha)
            last = y / alpha
            left, image = np.column_stack([left, last]), np.column_stack([image, product / alpha])
            w = product / alpha - alpha * v
        span = np.column_stack([held, right])
        for _ in range(2):
            w = w - span @ (span.T @ w)
        beta = float(np.linalg.norm(w))
        size = len(alphas)
        small = np.diag(alphas) + np.diag(betas, 1)
        outer, singular, inner = np.linalg.svd(small)
        triplets = right @ inner.T, singular
        residual = beta * np.abs(outer[size - 1])
        if span.shape[1] >= d:
            return triplets, True
        if limit:
            above = singular + residual > limit * (1 - 1e-9)
            if size >= PROBE and not above.any() and residual[0] <= 1e-3 * max(singular[0], limit):
                return (right[:, :0], singular[:0]), False
            # All above the limit are found, and the next one below is settled.
            if size > above.sum() and above.any() and (residual[: above.sum() + 1] <= FOUND * scale).all():
                return (triplets[0][:, above], singular[above]), False
        elif size >= wanted and (residual[:wanted] <= FOUND * singular[0]).all():
            return (triplets[0][:, :wanted], singular[:wanted]), False
        if beta <= ZERO * scale:  # an invariant space: go on outside of it
            v, beta = _fresh(d, span, rng), 0.0
        else:
            v = w / beta
        betas.append(beta)
    return (right, np.zeros(0)), True


def leading(d: int, wanted: int, scale: float) -> Generator[np.ndarray, np.ndarray, Triplets]:
    """The ``wanted`` leading right singular vectors and values, through passes it asks for.

    A single start vector finds one vector of each repeated singular value. So what was found is
    locked and a new run looks in its complement, until that holds nothing larger.
    """
    rng = np.random.default_rng(20)
    locked: Triplets = np.zeros((d, 0)), np.zeros(0)
    limit = 0.0
    while True:
        (vectors, values), done = yield from _run(d, wanted, locked, limit, scale, rng)
        order = np.argsort(-np.r_[locked[1], values], kind="stable")
        locked = np.column_stack([locked[0], vectors])[:, order], np.r_[locked[1], values][order]
        # With a deviation of zero among the leading ones, nothing larger is left.
        if done or (limit and not len(values)) or locked[1][wanted - 1] <= ZERO * scale:
            break
        limit = float(locked[1][wanted - 1])
    keep = locked[1][:wanted] > ZERO * scale
    return locked[0][:, :wanted][:, keep], locked[1][:wanted][keep]


def _step(factors: dict[int, np.ndarray]):
    """Shares of the two products of a step."""

    def share(d: int, x: np.ndarray) -> np.ndarray:
        if d not in factors:
            return np.zeros(0)
        values = x @ factors[d]
        return np.r_[values.T @ values[:, -1], x.T @ values[:, -1]]

    return share


def _spread(d: int, x: np.ndarray) -> np.ndarray:
    return np.array([np.einsum("ij,ij->", x, x)])


def _whitened_products(spaces: dict[int, Space]):
    def share(d: int, x: np.ndarray) -> np.ndarray:
        w = x @ spaces[d].whitener
        return np.r_[w.sum(axis=0), (w.T @ w).ravel()]

    return share


def fitted(frame: DataFrame, wanted: int = COMPONENTS) -> dict[int, Space]:
    """The components of the vectors (second column), for each length on its own.

    All lengths share the passes. Directions without deviation are no components.
    """
    spaces = _totals(frame)
    spread = _passed(frame, spaces, _spread)
    spaces = {d: replace(s, total=float(spread[d][0])) for d, s in spaces.items()}
    searches = {d: leading(d, min(wanted, d), np.sqrt(s.total)) for d, s in spaces.items() if d and s.total}
    found = {d: (np.zeros((d, 0)), np.zeros(0)) for d in spaces}
    asked = {d: next(g) for d, g in searches.items()}
    while asked:
        sums = _passed(frame, {d: spaces[d] for d in asked}, _step(asked))
        open_ = {}
        for d in asked:
            try:
                open_[d] = searches[d].send(sums[d])
            except StopIteration as end:
                found[d] = end.value
        asked = open_
    spaces = {d: replace(s, values=found[d][1] ** 2 / s.n, axes=found[d][0]) for d, s in spaces.items()}
    out = {d: s for d, s in spaces.items() if not len(s.values)}
    spread_out = {d: s for d, s in spaces.items() if len(s.values)}
    products = _passed(frame, spread_out, _whitened_products(spread_out)) if spread_out else {}
    for d, s in spread_out.items():
        r = len(s.values)
        mean, second = products[d][:r] / s.n, products[d][r:].reshape(r, r) / s.n
        out[d] = replace(s, error=float(np.abs(second - np.outer(mean, mean) - np.eye(r)).max(initial=0.0)))
    return out


def _deviations(x: np.ndarray, space: Space) -> list[int | None]:
    """Exact sums of (n x - S)**2; None where they do not fit in a long."""
    floor, rest = space.base
    x = x - floor
    reach = space.n * (int(np.abs(x).max(initial=0)) + 1)
    if reach * reach * max(x.shape[1], 1) < 1 << 63:
        return ((space.n * x - rest) ** 2).sum(axis=1).tolist()
    exact = [sum((space.n * a - b) ** 2 for a, b in zip(row, rest.tolist(), strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whitened(table: DataFrame, key: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: ``component`` from 1, ``whitened`` value and the fit's figures.

    Vectors that are null or hold null or non-finite entries are left out. Vectors of different
    lengths have no covariance with each other: each length is a list of its own with its own
    ``n``. ``deviation`` is the exact squared distance from the mean in units of 1/n, null beyond
    a long; entries beyond 2**60 / 64 count as that. A list of one vector, of equal vectors or of
    empty ones has no deviation, hence no components and no rows; a list of lower rank has as
    many as its rank. Repeated rows and ids stay, null ids too; ties of eigenvalues come in
    any order, the same for all rows. An empty table gives an empty result. Other columns
    are left out, so their names cannot clash.
    """
    frame = table.select(key, vector)
    load = shipped(table.sparkSession, fitted(frame, wanted))
    kind = table.schema[key].dataType
    fields = {"n": pa.int64(), "deviation": pa.int64(), "whitened": pa.float64(), "explained": pa.float64(), "identity_error": pa.float64()}
    schema = pa.schema([(key, to_arrow_type(kind)), ("component", pa.int32()), *fields.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces = load()
        for batch in batches:
            for rows, x in whole_numbers(batch.column(1)):
                space = spaces[x.shape[1]]
                r, m = len(space.values), len(rows)
                values = space.centred(x) @ space.whitener
                shares = space.values / (space.total / space.n) if r else space.values
                columns = [
                    batch.column(0).take(pa.array(np.repeat(rows, r))),
                    np.tile(np.arange(1, r + 1, dtype=np.int32), m),
                    np.full(m * r, space.n),
                    pa.array([v for v in _deviations(x, space) for _ in range(r)], pa.int64()),
                    values.ravel(),
                    np.tile(shares, m),
                    np.full(m * r, space.error),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, schema, strict=True)], schema=schema)

    return frame.mapInArrow(run, f"`{key}` {kind.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double")
