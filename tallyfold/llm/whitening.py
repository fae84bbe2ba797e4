"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Rotations make the factor's columns orthogonal; their squared lengths are the eigenvalues of the scatter and the columns at unit
length its eigenvectors. Small eigenvalues keep their relative accuracy, and a factor of lower rank ends by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyfold.llm.words import release
from tallyfold.runtime import stage

SCALE, SHIFT = 64.0, 1_000_000
CELLS = 1 << 24  # matrix cells that one task holds; lengths of vectors are fitted together up to this, a larger one alone
ROWS = 4096  # vectors per block of a product
LONG = 2**63 - 1


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """A factor G (d x rank) with G G' = scatter, a lower trapezoid up to the order of its rows; stops at the numerical rank."""
    d = len(scatter)
    rest = np.diag(scatter).astype(np.float64).copy()
    floor = d * np.finfo(np.float64).eps * max(float(rest.max(initial=0.0)), 0.0)
    factor = np.zeros((d, d))
    open_rows = np.ones(d, bool)
    for k in range(d):
        pivot = int(np.argmax(np.where(open_rows, rest, -np.inf)))
        if not rest[pivot] > floor:
            return factor[:, :k]
        column = scatter[:, pivot] - factor[:, :k] @ factor[pivot, :k]
        open_rows[pivot] = False
        root = np.sqrt(rest[pivot])
        factor[open_rows, k] = column[open_rows] / root
        factor[pivot, k] = root
        rest -= factor[:, k] ** 2
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of factor factor', by falling eigenvalue.

    A sweep meets all pairs of columns in rounds of disjoint pairs, which are rotated together.
    """
    g = factor.copy()
    r = g.shape[1]
    ring = list(range(r + r % 2))  # an odd number plays with an empty place
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = [(a, b) for a, b in zip(ring[:half], ring[::-1][:half]) if a < r and b < r]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            if not pairs:
                continue
            i, j = np.array(pairs).T
            x, y = g[:, i], g[:, j]
            xx, yy, xy = np.einsum("dk,dk->k", x, x), np.einsum("dk,dk->k", y, y), np.einsum("dk,dk->k", x, y)
            cosine = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, float(cosine.max()))
            turn = cosine > 1e-16
            zeta = (yy - xx) / np.where(turn, 2.0 * xy, 1.0)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = np.where(turn, 1.0 / np.hypot(1.0, t), 1.0)
            s = np.where(turn, c * t, 0.0)
            g[:, i], g[:, j] = c * x - s * y, s * x + c * y
        if worst < 1e-15:
            break
    values = np.einsum("dk,dk->k", g, g)
    order = np.argsort(-values, kind="stable")
    return values[order], g[:, order] / np.sqrt(values[order])


def _grid(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, x as longs) of rows (.., dim, x) by length of vector."""
    dims = batch.column(batch.schema.names.index("dim")).to_numpy()
    x = batch.column(batch.schema.names.index("x"))
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        for lo in range(0, len(at), ROWS):
            some = at[lo : lo + ROWS]
            body = b"".join(x.take(pa.array(some)).to_pylist())
            yield int(d), some, np.frombuffer(body, "<i8").reshape(len(some), int(d))


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, dim, x): floor(64 c) + 1000000 of every entry as 64-bit integers, packed. Vectors that are null, empty or hold null or
    non-finite entries are left out, and so are those with an entry whose integer does not fit."""
    id_type = vectors.schema[id_column].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("dim", T.IntegerType()), T.StructField("x", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            offsets = v.offsets.to_numpy()
            flat = v.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
            n = np.where(v.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
            scaled = np.floor(flat * SCALE) + SHIFT
            bad = np.concatenate([[0], np.cumsum(~(np.isfinite(flat) & (np.abs(scaled) < 2.0**62)))])
            keep = np.flatnonzero((n > 0) & (bad[offsets[1:]] == bad[offsets[:-1]]))
            whole = np.where(np.isfinite(scaled) & (np.abs(scaled) < 2.0**62), scaled, 0.0).astype("<i8")
            packed = [whole[offsets[i] : offsets[i + 1]].tobytes() for i in keep]
            columns = [batch.column(0).take(pa.array(keep)), pa.array(n[keep].astype(np.int32)), pa.array(packed, arrow.field("x").type)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    return rows.mapInArrow(code, schema)


def exact_sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """n and the exact sums S per length of vector: as many numbers as the vectors are long."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, at, x in _grid(batch):
                counts[d] = counts.get(d, 0) + len(at)
                # Two halves of each number, so that no sum of a task overflows.
                halves = np.stack([(x >> 31).sum(axis=0), (x & (2**31 - 1)).sum(axis=0)])
                sums[d] = sums[d] + halves if d in sums else halves
        for d, n in counts.items():
            columns = [np.full(d, d, np.int32), np.arange(d, dtype=np.int32), np.full(d, n), sums[d][0], sums[d][1]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["dim", "at", "n", "high", "low"])

    parts = fit.mapInArrow(add, "dim int, at int, n long, high long, low long")
    rows = parts.groupBy("dim", "at").agg(
        F.sum("n").alias("n"), (F.sum(F.col("high").cast("decimal(38,0)")) * 2**31 + F.sum("low")).alias("s")
    )
    found: dict[int, tuple[int, list[int]]] = {}
    for r in rows.orderBy("dim", "at").toLocalIterator():
        found.setdefault(r["dim"], (r["n"], []))[1].append(int(r["s"]))
    return found


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, each entry rounded once: whole parts are subtracted as integers."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - part


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the entries of (n x - S)^2, exact; null where it does not fit a long."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n for s in sums], np.int64)
    largest = np.abs((x - whole).astype(np.float64)).max(initial=0.0) + 1.0
    if x.shape[1] * (n * largest) ** 2 < 2.0**62:
        y = n * (x - whole) - part
        return (y * y).sum(axis=1).tolist()
    exact = ((n * (x - whole).astype(object) - part.astype(object)) ** 2).sum(axis=1)
    return [int(v) if v <= LONG else None for v in exact]


def _groups(lengths: list[int]) -> Iterator[list[int]]:
    held: list[int] = []
    for d in sorted(lengths):
        if held and sum(h * h for h in held) + d * d > CELLS:
            yield held
            held = []
        held.append(d)
    if held:
        yield held


def fit_components(fit: DataFrame, sums: dict[int, tuple[int, list[int]]], k: int = 16) -> dict[int, dict]:
    """Per length of vector: components (k or fewer rows), their eigenvalues and the trace of the covariance."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {d: np.zeros((d, d)) for d in sums}
        for batch in batches:
            for d, _, x in _grid(batch):
                z = centred(x, *sums[d])
                total[d] += z.T @ z
        for d, m in total.items():
            if m.any():
                rows = [np.full(d, d, np.int32), np.arange(d, dtype=np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array([r.tobytes() for r in m])], names=["dim", "at", "row"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        row = np.sum([np.frombuffer(b) for b in pdf["row"]], axis=0)
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "at": pdf["at"].iloc[:1], "row": [row.tobytes()]})

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        d = int(pdf["dim"].iloc[0])
        scatter = np.stack([np.frombuffer(b) for b in pdf.sort_values("at")["row"]]) / sums[d][0]
        scatter = (scatter + scatter.T) / 2
        values, vectors = one_sided_jacobi(pivoted_cholesky(scatter))
        first = values[:k]
        return pd.DataFrame({
            "dim": [d], "trace": [float(np.trace(scatter))], "values": [first.tobytes()], "vectors": [vectors[:, :k].T.tobytes()],
        })

    kind = "dim int, at int, row binary"
    rows = fit.where(F.col("dim").isin(list(sums))).mapInArrow(products, kind).groupBy("dim", "at").applyInPandas(add, kind)
    solved = rows.groupBy("dim").applyInPandas(solve, "dim int, trace double, values binary, vectors binary").collect()
    return {
        r["dim"]: {
            "trace": r["trace"], "values": np.frombuffer(r["values"]), "vectors": np.frombuffer(r["vectors"]).reshape(-1, r["dim"]),
        }
        for r in solved
    }


def identity_errors(fit: DataFrame, sums: dict, models: dict[int, dict]) -> dict[int, float]:
    """Largest entry, in size, of the covariance of the whitened fit vectors minus the identity; measured over all of them."""

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _grid(batch):
                w = whiten(x, *sums[d], models[d])
                w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
                total[d] = total.get(d, 0.0) + w.T @ w
        for d, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([m.tobytes()])], names=["dim", "sums"])

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        d = int(pdf["dim"].iloc[0])
        m = np.sum([np.frombuffer(b) for b in pdf["sums"]], axis=0)
        side = len(models[d]["values"]) + 1
        m = m.reshape(side, side) / sums[d][0]
        covariance = m[:-1, :-1] - np.outer(m[:-1, -1], m[:-1, -1])
        return pd.DataFrame({"dim": [d], "error": [float(np.abs(covariance - np.eye(side - 1)).max())]})

    parts = fit.where(F.col("dim").isin(list(models))).mapInArrow(squares, "dim int, sums binary")
    return {r["dim"]: r["error"] for r in parts.groupBy("dim").applyInPandas(judge, "dim int, error double").collect()}


def whiten(x: np.ndarray, n: int, sums: list[int], model: dict) -> np.ndarray:
    return (centred(x, n, sums) @ model["vectors"].T) / np.sqrt(model["values"])


def whitened(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 16) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row per vector that is kept and component up to ``k``.

    The fit is over distinct integer vectors, each once; every row that is kept is projected, repeated rows and null ids as well.
    Vectors of different length are spaces of their own. A space has as many components as the rank of its covariance allows: none,
    and so no rows, where all vectors are equal. ``deviation`` is null where it does not fit a long. An empty table gives no rows.
    Tasks hold one square matrix; the driver gets sums per entry and ``k`` components, whatever the number of vectors.
    """
    coded = integer_vectors(vectors, id_column, vector_column)
    fit = stage(coded.select("dim", "x").distinct(), "fit_vectors")
    all_sums = exact_sums(fit)
    id_type = vectors.schema[id_column].dataType
    schema = T.StructType([
        T.StructField(id_column, id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ])
    arrow = to_arrow_schema(schema)

    def project(lengths: list[int]) -> DataFrame:
        sums = {d: all_sums[d] for d in lengths}
        models = {d: m for d, m in fit_components(fit, sums, k).items() if len(m["values"])}
        errors = identity_errors(fit, sums, models) if models else {}
        shared = vectors.sparkSession.sparkContext.broadcast((sums, models, errors))  # k + 1 numbers per entry of a vector

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, models, errors = shared.value
            for batch in batches:
                for d, at, x in _grid(batch):
                    if d not in models:
                        continue
                    m, (n, s) = models[d], sums[d]
                    c = len(m["values"])
                    columns = [
                        batch.column(0).take(pa.array(np.repeat(at, c))), np.tile(np.arange(1, c + 1, dtype=np.int32), len(at)),
                        np.full(len(at) * c, n), pa.array(deviations(x, n, s), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), c))),
                        whiten(x, n, s, m).ravel(), np.tile(m["values"] / m["trace"], len(at)), np.full(len(at) * c, errors[d]),
                    ]
                    arrays = [v if isinstance(v, pa.Array) else pa.array(v) for v in columns]
                    yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(arrays, arrow)], schema=arrow)
            release()

        return coded.where(F.col("dim").isin(list(models))).mapInArrow(run, schema)

    parts = [project(lengths) for lengths in _groups(list(all_sums))]
    if not parts:
        return vectors.sparkSession.createDataFrame([], schema)
    while len(parts) > 1:
        parts = [a.unionByName(b) for a, b in zip(parts[::2], parts[1::2])] + (parts[-1:] if len(parts) % 2 else [])
    return parts[0]
