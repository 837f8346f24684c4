"""Correlation of wide tables by blocked cross-products with null masks.

Columns are taken in blocks of ``BLOCK``. For two blocks a task multiplies
matrices of its rows: products of values, of their squares and of the masks that
say which values are there, so every pair of columns gets its own count, means
and second moments over the rows that hold both. Tasks send one row for each
column and block; these moments are merged pairwise, first in ``SALTS`` parts
of the tasks, so no group grows with the table. The plan has no expression for
a pair: d columns need (d / BLOCK)^2 / 2 scans of two blocks' columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyspark.operators.prep import q
from tallyspark.session import workers_import

BLOCK = 1024
ROWS = 4096        # of a product
SALTS = 256
# Moments of a pair: rows, means, sums of squared deviations, of products of deviations, rows with an infinity.
MOMENTS = ("n", "mx", "my", "cxx", "cyy", "cxy", "wild")
CONSTANT = 1e-13   # a spread under this part of the squares is rounding
_PART = "i int, salt int, part binary"


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])


def _moments(left: int, same: bool):
    """Moments of the first ``left`` columns with the others (with themselves, if ``same``), over a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = shift = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                v = _matrix(batch.slice(at, ROWS))
                there, wild = ~np.isnan(v), np.isinf(v)
                good = there & ~wild
                if shift is None:   # any value near the column's own will do
                    shift = np.where(good, v, 0).sum(0) / np.maximum(good.sum(0), 1)
                    sums = np.zeros((7, left, v.shape[1] if same else v.shape[1] - left))
                x = np.where(good, v - np.where(good, shift, 0), 0.0)
                m, b = good.astype(float), wild.astype(float)
                (xl, ml, bl), (xr, mr, br) = ([a[:, part] for a in (x, m, b)] for part in (slice(left), slice(0 if same else left, None)))
                for k, (p, r) in enumerate(((ml, mr), (xl, mr), (ml, xr), (xl * xl, mr), (ml, xr * xr), (xl, xr))):
                    sums[k] += p.T @ r
                if wild.any():
                    sums[6] += bl.T @ (mr + br) + ml.T @ br
        if sums is None:
            return
        n, sx, sy, sxx, syy, sxy, wild = sums
        d = np.maximum(n, 1)
        cut = 0 if same else left
        out = np.stack([n, np.where(n > 0, shift[:left, None] + sx / d, 0), np.where(n > 0, shift[None, cut:] + sy / d, 0),
                        _spread(sxx, sx, d), _spread(syy, sy, d), sxy - sx * sy / d, wild], 1)
        salt = TaskContext.get().partitionId() % SALTS
        yield _parts(range(left), salt, out)
    return run


def _spread(squares: np.ndarray, total: np.ndarray, n: np.ndarray) -> np.ndarray:
    c = squares - total * total / n
    return np.where(c > CONSTANT * squares, c, 0.0)


def _parts(of: Sequence[int], salt: int, moments: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(of), pa.int32()), pa.array([salt] * len(of), pa.int32()),
                                       pa.array([np.ascontiguousarray(m).tobytes() for m in moments], pa.binary())], ["i", "salt", "part"])


def _none(width: int):
    """No rows at all, for each column; so empty tables have their pairs, too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _parts(batch.column(0).to_pylist(), 0, np.zeros((batch.num_rows, 7, width)))
    return run


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of the rows of both, from the moments of each."""
    n = a[0] + b[0]
    d = np.maximum(n, 1)
    dx, dy, share = b[1] - a[1], b[2] - a[2], a[0] * b[0] / d
    return np.stack([n, a[1] + dx * b[0] / d, a[2] + dy * b[0] / d, a[3] + b[3] + dx * dx * share,
                     a[4] + b[4] + dy * dy * share, a[5] + b[5] + dx * dy * share, a[6] + b[6]])


def _merged(rows: pa.Table) -> np.ndarray:
    return reduce(merge, (np.frombuffer(x.as_buffer(), float).reshape(7, -1) for x in rows.column("part")))


def _merge_salt(rows: pa.Table) -> pa.Table:
    return pa.Table.from_batches([_parts([rows.column("i")[0].as_py()], rows.column("salt")[0].as_py(), _merged(rows)[None])])


def _pairs(names: Sequence[str], others: Sequence[str], same: bool):
    def run(rows: pa.Table) -> pa.Table:
        i = rows.column("i")[0].as_py()
        n, _, _, cxx, cyy, cxy, wild = _merged(rows)
        r = np.clip(cxy / np.sqrt(np.where((cxx > 0) & (cyy > 0), cxx * cyy, 1)), -1, 1)
        r = np.where(wild > 0, np.nan, r)
        none = (wild == 0) & ((n < 2) | (cxx <= 0) | (cyy <= 0))
        at = np.arange(i + 1 if same else 0, len(others))
        pair = [names[i]] * len(at), [others[j] for j in at]
        values = pa.array(r[at], pa.float64(), mask=none[at], from_pandas=False)
        out = [pa.table({"f1": pa.array(pair[a], pa.string()), "f2": pa.array(pair[1 - a], pa.string()), "r": values}) for a in (0, 1)]
        if same:
            out.append(pa.table({"f1": [names[i]], "f2": [names[i]], "r": [1.0]}))
        return pa.concat_tables(out)
    return run


def correlations(df: DataFrame, cols: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(f1, f2, r) of all ordered pairs of columns, over the rows that hold both; 1 on the diagonal.

    Null and NaN are missing values. ``r`` is null for fewer than two common
    rows or a constant column, NaN if a common row holds an infinity.
    """
    spark, cols = df.sparkSession, list(cols)
    workers_import(spark)
    blocks = [cols[at:at + block] for at in range(0, len(cols), block)]
    out = []
    for a, left in enumerate(blocks):
        for b in range(a, len(blocks)):
            right, same = blocks[b], a == b
            both = left if same else left + right
            rows = df.select(*[q(c).cast("double").alias(f"c{k}") for k, c in enumerate(both)])
            parts = (rows.mapInArrow(_moments(len(left), same), _PART)
                     .unionByName(spark.range(0, len(left), 1, 1).mapInArrow(_none(len(right)), _PART)))
            out.append(parts.groupBy("i", "salt").applyInArrow(_merge_salt, _PART)
                       .groupBy("i").applyInArrow(_pairs(left, right, same), "f1 string, f2 string, r double"))
    return reduce(DataFrame.unionByName, out)
