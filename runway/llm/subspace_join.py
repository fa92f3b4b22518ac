"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors with cosine >= c lie within squared distance 2 - 2c.  After a
seeded rotation they are split into blocks of a few dimensions; by the
pigeonhole principle a linked pair is, in one block at least, within that
block's proportional share of the squared distance.  Vectors are dealt into
parts so that each pair of vectors meets in one group; there every block is
range-joined on a grid over its first coordinates, and the union of candidates
is checked exactly in double precision, each pair in the first block that yields it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import written
from .workers import ship

#: Dimensions of a block.
BLOCK_DIMS = 8
#: Parts grow with the root of the number of vectors (this many times it), up to
#: CELL_ROWS vectors and PART_BYTES of vectors.  A vector is sent once per part.
ROOT_ROWS = 32
CELL_ROWS = 32768
PART_BYTES = 8 << 20
#: Most tasks of the join; more groups share them.
MOST_TASKS = 4096
#: Vectors of a grid cell, pairs compared at a time, and candidate pairs checked
#: and links held at a time.
LEAF = 128
TILE = 1 << 20
CHECKED = 1 << 16


@lru_cache(maxsize=4)
def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Blocks:
    """The blocks of one dimension and their budgets."""

    def __init__(self, dim: int, cosine: float, seed: int):
        self.turn = rotation(dim, seed)
        self.edges = list(range(0, dim, BLOCK_DIMS)) + [dim]
        share = (2 - 2 * cosine) * np.diff(self.edges) / dim
        self.budget = share * (1 + 1e-9) + 1e-12


def _near(home: np.ndarray, guest: np.ndarray | None, budget: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(home rows, guest rows) of all pairs within ``budget``, and a few beyond
    it by less than rounding; each pair of ``home`` once if there is no guest.

    ``home`` is cut at the medians of its first coordinates into cells of about
    LEAF rows; a guest is compared with the cells that its ball reaches."""
    k = min(home.shape[1], max(0, int(math.log2(max(1, len(home) / LEAF)))))
    cut = np.median(home[:, :k], axis=0)
    cell = ((home[:, :k] > cut) << np.arange(k)).sum(axis=1)
    order = np.argsort(cell, kind="stable")
    home = home[order]
    own = guest is None
    guest = home if own else guest
    kind, slack = (np.float32, 1e-5) if budget > 1e-3 else (np.float64, 1e-12)
    starts = np.searchsorted(cell[order], np.arange((1 << k) + 1))
    over, under = np.maximum(guest[:, :k] - cut, 0) ** 2, np.maximum(cut - guest[:, :k], 0) ** 2

    def norms(x):
        return (x * x).sum(axis=1)[:, None]
    # one product gives squared distances
    left = np.hstack([guest * -2, norms(guest), np.ones((len(guest), 1))]).astype(kind)
    right = np.hstack([home, np.ones((len(home), 1)), norms(home)]).astype(kind)
    for c in range(1 << k):
        first, last = starts[c], starts[c + 1]
        if first == last:
            continue
        bit = (c >> np.arange(k)) & 1
        skip = first if own else 0
        reach = skip + np.flatnonzero(over[skip:] @ (1 - bit) + under[skip:] @ bit <= budget + slack)
        for s in range(first, last, 1024):
            h = min(1024, last - s)
            for t in range(0, len(reach), TILE // h):
                g = reach[t:t + TILE // h]
                q, p = np.divmod(np.flatnonzero((left[g] @ right[s:s + h].T).ravel() <= budget + slack), h)
                p, q = s + p, g[q]
                if own:
                    p, q = p[q > p], q[q > p]
                    yield order[p], order[q]
                else:
                    yield order[p], q


def _units(raw: list[bytes], width: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype=np.float32 if width == 4 else np.float64).astype(np.float64)
    x = x.reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _raw(width: int):
    """(id, vector bytes); null for a vector that links with nothing."""
    dtype = np.float32 if width == 4 else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                if not v or None in v:
                    out.append(None)
                    continue
                x = np.array(v, dtype=dtype) + dtype(0)  # one zero: -0.0 becomes 0.0
                out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "raw"])
    return run


def _by_dim(raw: list[bytes], width: int):
    size = np.array([len(r) // width for r in raw])
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        yield int(dim), at


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable, for links (i, j) between n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _join_parts(width: int, cosine: float, seed: int):
    """Of one pair of parts: (rep, n_links, root) for vectors that link."""
    names = ["rep", "n_links", "root"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        raw, rep, same = pdf["raw"].tolist(), pdf["rep"].to_numpy(), pdf["same"].to_numpy()
        part, lo, hi = pdf["part"].to_numpy(), pdf["lo"].iloc[0], pdf["hi"].iloc[0]
        ids, at = np.unique(rep, return_inverse=True)
        n_links, root = np.zeros(len(ids)), np.arange(len(ids))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n_held = 0

        def fold():
            # of links only degrees and roots are kept
            nonlocal n_links, root, n_held
            i, j = (np.concatenate(x) for x in zip(*held))
            n_links += np.bincount(at[i], same[j], len(ids)) + np.bincount(at[j], same[i], len(ids))
            root = _roots(len(ids), np.r_[at[i], np.arange(len(ids))], np.r_[at[j], root])
            held.clear()
            n_held = 0

        for dim, rows in _by_dim(raw, width):
            blocks = Blocks(dim, cosine, seed)
            unit = _units([raw[r] for r in rows], width)
            turned = unit @ blocks.turn
            home = np.flatnonzero(part[rows] == hi)
            guest = np.flatnonzero(part[rows] == lo)
            if not len(home) or not len(guest):
                continue
            for b, budget in enumerate(blocks.budget):
                block = turned[:, blocks.edges[b]:blocks.edges[b + 1]]
                for p, q in _near(block[home], None if lo == hi else block[guest], budget):
                    for c in range(0, len(p), CHECKED):
                        i, j = home[p[c:c + CHECKED]], guest[q[c:c + CHECKED]]
                        within = np.add.reduceat((turned[i] - turned[j]) ** 2, blocks.edges[:-1], axis=1) <= blocks.budget
                        first = within[:, b] & ~within[:, :b].any(axis=1)
                        i, j = i[first], j[first]
                        hit = (np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine) & (rep[rows[i]] != rep[rows[j]])
                        if hit.any():
                            held.append((rows[i[hit]], rows[j[hit]]))
                            n_held += len(held[-1][0])
                            if n_held >= CHECKED:
                                fold()
        if held:
            fold()
        hit = np.flatnonzero(n_links)
        return pd.DataFrame({"rep": ids[hit], "n_links": n_links[hit].astype(np.int64),
                             "root": ids[root[hit]]}, columns=names)
    return run


def _meetings(classes: DataFrame) -> tuple[DataFrame, int]:
    """``classes`` dealt so that each pair of vectors meets in one group of
    (lo, hi), the parts of the two; and the number of groups."""
    n, size = classes.agg(F.count(F.lit(1)), F.sum(F.length("raw"))).first()
    parts = max(1, math.ceil(max(math.sqrt(n) / ROOT_ROWS, n / CELL_ROWS, (size or 0) / PART_BYTES)))
    # by the vector's bytes, as ids may repeat
    dealt = (classes.withColumn("part", F.pmod(F.xxhash64("raw"), F.lit(parts)).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    return dealt.select(F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"),
                        "part", "rep", "same", "raw"), parts * (parts + 1) // 2


def subspace_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                        cosine: float = 0.95, seed: int = 3) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links`` (other vectors with
    cosine >= ``cosine``), ``component_id`` (smallest id reachable by links,
    itself included) and ``kept`` (id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, nor do vectors of different lengths with each other.
    Equal vectors are joined as one and counted as many; repeated rows (same id
    and vector) are one vector with a row each.  Rows with a null id link with
    nothing and have a null component.  Ids must be integers.  Other columns
    are ignored; an empty table gives none.

    Vectors are dealt into parts of at most CELL_ROWS, and each pair of parts is
    joined in one group, so no task holds the table; only counts and one link per
    vector to its group's smallest leave a task.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema[vector_col].dataType.simpleString()
    width = 4 if kind == "array<float>" else 8
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(
        "array<float>" if width == 4 else "array<double>").alias("v"))
    rows = written(rows.mapInArrow(_raw(width), "id long, raw binary"), "vectors")
    classes = written(rows.where("id is not null and raw is not null").groupBy("raw", "id").agg(F.lit(1).alias("one"))
                      .groupBy("raw").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("same"))
                      .select("rep", "same", "raw"), "vector-classes")
    dealt, groups = _meetings(classes)
    found = written(dealt.repartition(min(groups, MOST_TASKS), "lo", "hi").groupBy("lo", "hi").applyInPandas(
        _join_parts(width, cosine, seed), "rep long, n_links long, root long"), "vector-links")

    degree = found.groupBy("rep").agg(F.sum("n_links").alias("n"))
    linked = components(found, "rep", "root")
    # a component's smallest representative is its smallest id
    of_class = written(
        classes.join(degree, "rep", "left").join(linked.withColumnRenamed("node", "rep"), "rep", "left")
        .select("raw", (F.coalesce("n", F.lit(0)) + F.col("same") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")), "vector-groups")
    out = rows.join(of_class, "raw", "left")
    alone = F.col("id").isNull() | F.col("component_id").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
