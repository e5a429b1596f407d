"""Embedding whitening by shifted CholeskyQR.

Vectors become whole numbers, each distinct one once is the fit list. Passes over that list add up Gram matrices of its
centred rows, orthogonalised by all factors so far through triangular solves; the Cholesky factor of each Gram matrix is the
next factor. Their product is R of the rows' QR decomposition, and its singular value decomposition gives the components.
Squaring the condition number, the weak point of covariance matrices, is mended by the later passes.

A task sends one matrix per vector length, added up in two steps; only matrices of dimensions x dimensions reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwitness.llm.common import stored

STEPS_PER_UNIT = 256
COMPONENTS = 4
# Tasks' matrices meet in so many groups first.
GROUPS = 64
# Singular values below this part of the largest are rounding: such directions hold no variance.
RANK = 1e-11
# A Gram matrix is that of an orthonormal basis when its eigenvalues are this near to 1; or to 0, where rows do not reach.
NEAR = 1e-10
# The first Gram matrix may miss so much of its norm by rounding, those of nearly orthonormal rows less.
FIRST_SHIFT, LATER_SHIFT = 1e-10, 1e-12
MOST_PASSES = 12

_MATRIX = "dims int, part int, cells binary"


@dataclass(frozen=True)
class Whitening:
    """What the vectors of one length need: count and sums of the fit list, components as rows, their variances."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def project(self, centred: np.ndarray) -> np.ndarray:
        """Whitened rows. Sums run in one order for every row, so equal rows get equal numbers whatever lies beside them."""
        out = np.zeros((len(centred), len(self.components)))
        for d in range(centred.shape[1]):
            out += centred[:, d : d + 1] * self.components[:, d]
        return out / np.sqrt(self.variances)


def whole(vector: Column) -> Column:
    """``floor(256 * c)`` of each entry; null if the vector is null or holds null, NaN or infinity.

    An entry whose number would leave 53 bits fails: such numbers have no exact place between doubles.
    """
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    scaled = F.transform(vector, lambda c: c.cast("double") * STEPS_PER_UNIT)
    fits = F.forall(scaled, lambda c: F.abs(c) < float(2**53))
    checked = F.when(fits, F.transform(scaled, lambda c: F.floor(c).cast("bigint"))).otherwise(
        F.raise_error("an entry of a vector is too large to whiten")
    )
    return F.when(finite, checked)


def _blocks(column) -> list[tuple[int, np.ndarray]]:
    """Rows of a list column without nulls, by their length: places and matrix."""
    import pyarrow.compute as pc

    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = []
    for dims in np.unique(lengths):
        at = np.flatnonzero(lengths == dims)
        values = column.take(at).flatten().to_numpy(zero_copy_only=False)
        out.append((int(dims), at, values.reshape(len(at), dims)))
    return out


def _added(fit: DataFrame, cells: Callable[[int, np.ndarray], np.ndarray | None], kind: str) -> dict[int, np.ndarray]:
    """Sums over the fit list of what ``cells(dims, rows)`` gives for blocks of rows, by vector length."""

    def local(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, _, rows in _blocks(batch.column(0)):
                found = cells(dims, rows)
                if found is not None:
                    sums[dims] = sums[dims] + found if dims in sums else found
        part = TaskContext.get().partitionId()
        for dims, found in sums.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "dims": pa.array([dims], pa.int32()),
                    "part": pa.array([part], pa.int32()),
                    "cells": pa.array([found.astype(kind).tobytes()], pa.binary()),
                }
            )

    def add(group):
        import pyarrow as pa

        # In the order of parts, so that a task that runs again gets the same rounding.
        group = group.sort_by("part")
        total = sum(np.frombuffer(x, kind) for x in group.column("cells").to_pylist())
        return group.slice(0, 1).select(["dims", "part"]).append_column("cells", pa.array([total.tobytes()], pa.binary()))

    parts = fit.mapInArrow(local, _MATRIX).withColumn("near", F.col("part") % GROUPS)
    near = parts.groupBy("dims", "near").applyInArrow(lambda g: add(g.drop_columns(["near"])), _MATRIX)
    return {r["dims"]: np.frombuffer(r["cells"], kind) for r in near.groupBy("dims").applyInArrow(add, _MATRIX).collect()}


def _solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows @ inverse(factor)`` for an upper triangular factor, column after column."""
    out = np.empty_like(rows)
    for d in range(rows.shape[1]):
        out[:, d] = (rows[:, d] - out[:, :d] @ factor[:d, d]) / factor[d, d]
    return out


def _shifted_factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of ``gram``, whose diagonal is raised by a part of its norm so that it exists."""
    return np.linalg.cholesky(gram + shift * np.linalg.norm(gram, 2) * np.eye(len(gram))).T


def _last_factor(gram: np.ndarray) -> np.ndarray | None:
    """A square root of ``gram`` if it is settled (see ``NEAR``), directions that no row reaches being zero."""
    values, axes = np.linalg.eigh(gram)
    void = np.abs(values) < NEAR
    if np.all(void | (np.abs(values - 1) < NEAR)):
        return np.sqrt(np.where(void, 0.0, values))[:, None] * axes.T
    return None


def fit(whole_rows: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A model per vector length, from the distinct vectors of the column ``x`` (arrays of long, none null).

    Lengths are whitened apart. Directions without variance (fewer distinct vectors than dimensions, constant entries) are
    no components, so a length may have fewer than ``components``, or none.
    """
    distinct = stored(whole_rows.select("x").distinct(), "whitening-fit")

    def counted(dims: int, rows: np.ndarray) -> np.ndarray:
        return np.append(rows.sum(0), len(rows))

    totals = {dims: (int(v[-1]), v[:-1]) for dims, v in _added(distinct, counted, "<i8").items()}
    factors: dict[int, list[np.ndarray]] = {dims: [] for dims in totals}
    open_ = {dims for dims in totals if dims}

    for _ in range(MOST_PASSES):
        if not open_:
            break

        def gram(dims: int, rows: np.ndarray, wanted=frozenset(open_), factors=factors) -> np.ndarray | None:
            if dims not in wanted:
                return None
            q = centred(rows, *totals[dims])
            for factor in factors[dims]:
                q = _solved(q, factor)
            return (q.T @ q).reshape(-1)

        for dims, cells in _added(distinct, gram, "<f8").items():
            found = cells.reshape(dims, dims)
            last = _last_factor(found) if factors[dims] else None
            if last is not None or not found.any():
                open_.discard(dims)
            else:
                shift = LATER_SHIFT if factors[dims] else FIRST_SHIFT
                last = _shifted_factor(found, shift)
            if last is not None:
                factors[dims] = [*factors[dims], last]
    if open_:
        raise ArithmeticError(f"vectors of lengths {sorted(open_)} do not settle")

    models = {}
    for dims, (n, sums) in totals.items():
        product = np.eye(dims)
        for factor in factors[dims]:
            product = factor @ product
        values, axes = np.linalg.svd(product)[1:] if factors[dims] else (np.zeros(0), np.zeros((0, dims)))
        real = min(int((values > RANK * values.max(initial=0)).sum()), components)
        variances = values**2 / n
        share = variances[:real] / variances.sum() if real else np.zeros(0)
        # Of an axis' two directions, the one whose largest entry is positive.
        axes = axes[:real]
        if real:
            axes = axes * np.sign(axes[np.arange(real), np.abs(axes).argmax(1)])[:, None]
        models[dims] = Whitening(n, sums, axes, variances[:real], share)

    def spread(dims: int, rows: np.ndarray) -> np.ndarray | None:
        model = models[dims]
        if not len(model.components):
            return None
        white = model.project(centred(rows, model.n, model.sums))
        return (white.T @ white).reshape(-1)

    for dims, cells in _added(distinct, spread, "<f8").items():
        model = models[dims]
        k = len(model.components)
        error = float(np.abs(cells.reshape(k, k) / model.n - np.eye(k)).max())
        models[dims] = Whitening(model.n, model.sums, model.components, model.variances, model.explained, error)
    return models


def centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S / n``, from whole numbers so that it is rounded once where they fit 64 bits."""
    if len(rows) and int(np.abs(rows).max(initial=0)) * n < 2**62 and int(np.abs(sums).max(initial=0)) < 2**62:
        return (rows * n - sums) / n
    return rows - sums / n


OUT = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Vectors that are null or hold null, NaN or infinite entries are dropped. Entries become ``floor(256 * c)``; one beyond 53
    bits is an error. Rows that repeat are counted once in the fit and each returned; a null id stays null. Equal variances
    leave the choice of axes open. Components without variance have no rows, so a table of one distinct vector, of vectors
    without entries, or an empty one gives none. Vectors of another length are whitened among their own. ``deviation`` (the sum
    over dimensions of ``(n * x - S) ** 2``) is exact up to 38 digits. Other columns are not read. Ids must be whole numbers.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    if id_type not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"ids of type {id_type}")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), whole(F.col(vector_col)).alias("x")).where("x IS NOT NULL")
    models = fit(rows, components)
    sent = vectors.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        import decimal

        import pyarrow as pa

        digits = decimal.Context(prec=60)
        for batch in batches:
            for dims, at, x in _blocks(batch.column(1)):
                model = sent.value[dims]
                k = len(model.components)
                if not k:
                    continue
                white = model.project(centred(x, model.n, model.sums))
                most = int(np.abs(x).max(initial=0)) * model.n + int(np.abs(model.sums).max(initial=0))
                if most**2 * dims < 2**63:
                    square = ((x * model.n - model.sums) ** 2).sum(1).tolist()
                else:
                    square = ((x.astype(object) * model.n - model.sums.astype(object)) ** 2).sum(1).tolist()
                ids = batch.column(0).take(pa.array(np.repeat(at, k)))
                exact = [digits.create_decimal(v) for v in square for _ in range(k)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": ids,
                        "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        "n": pa.array(np.full(len(at) * k, model.n, np.int64)),
                        "deviation": pa.array(exact, pa.decimal128(38, 0)),
                        "whitened": pa.array(white.reshape(-1)),
                        "explained": pa.array(np.tile(model.explained, len(at))),
                        "identity_error": pa.array(np.full(len(at) * k, model.identity_error)),
                    }
                )

    return rows.mapInArrow(run, OUT)
