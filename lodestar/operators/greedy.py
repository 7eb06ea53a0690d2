"""The greedy canopy rule over groups of any size, in rounds on Spark.

The rule (C1, C2): in the order of the rows, a row is accepted iff it is farther
than the radius from every row accepted before it in its group; the accepted rows
are the lexicographically first independent set of the radius graph. A round takes
the first undecided rows of every group, at most ``head_rows``: tasks thin their
rows to these, one task a group walks them (a bounded number), and the accepted
ones go to all tasks, where every row that they cover, or that was walked, leaves.
So the distances of all rows to the accepted ones, nearly all of the work, are
computed wherever the rows lie, by all cores, and the rows are never shuffled.
Rounds end when no group has rows left. The driver sees the accepted rows of one
round at a time, ``MAX_CENTER_NUMBERS`` numbers at most; the accepted sets are
written to the shared folder by Spark.

Within a task both steps look only at accepted rows in a slab of one coordinate
around a row (``physical.any_within``).
"""

from __future__ import annotations

from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.plans import physical, storage

#: Rows of a group that one round walks.
HEAD_ROWS = 20_000
#: Rows walked in one step: first against the rows accepted before, then among themselves.
STEP_ROWS = 512
HEAD_SCHEMA = "grp int, seq bigint, id bigint, features array<double>, nth int, last bigint, more boolean"


def greedy_pick(x: np.ndarray, radius: float, prior: np.ndarray | None = None) -> list[int]:
    """Rows (in order) that become centres: distance to all centres so far > radius. ``prior`` ones count as chosen."""
    d = x.shape[1]
    parts = [] if prior is None else [np.asarray(prior, np.float64).reshape(-1, d)]
    picked: list[int] = []
    for s in range(0, len(x), STEP_ROWS):
        block = x[s : s + STEP_ROWS]
        cand = np.arange(len(block))
        if parts:
            parts = [np.vstack(parts)]
            cand = np.flatnonzero(~physical.any_within(block, parts[0], radius))
        far = ~(np.sqrt(physical.sq_dists(block[cand], block[cand])) <= radius)
        left, new = np.ones(len(cand), bool), []
        for i in range(len(cand)):
            if left[i]:
                new.append(i)
                left &= far[i]
        picked += (s + cand[new]).tolist()
        if new:
            parts.append(block[cand[new]])
    return picked


def ordered(points: DataFrame, *by: str) -> DataFrame:
    """``points`` with ``seq``, a number that ascends in the order of ``by`` (nulls first)."""
    return points.orderBy(*by).withColumn("seq", F.monotonically_increasing_id())


def _thin(rows: int):
    """Of each group the ``rows`` + 1 smallest by seq that a task has."""

    def fn(batches):
        kept, top = None, {}
        for rb in batches:
            if rb.num_rows == 0:
                continue
            grp, seq = rb.column(0).to_numpy(), rb.column(1).to_numpy()
            if top:  # most rows of later batches are behind what is kept
                known = np.array(sorted(top), np.int64)
                at = np.minimum(np.searchsorted(known, grp), len(known) - 1)
                bar = np.array([top[g] for g in known.tolist()])
                rb = rb.filter(pa.array((known[at] != grp) | (seq < bar[at])))
                if rb.num_rows == 0:
                    continue
            t = pa.Table.from_batches([rb] if kept is None else [*kept.to_batches(), rb]).combine_chunks()
            grp, seq = t.column(0).to_numpy(), t.column(1).to_numpy()
            order = np.lexsort((seq, grp))
            g = grp[order]
            place = np.arange(len(g)) - np.searchsorted(g, g)
            keep = place <= rows
            kept = t.take(pa.array(order[keep])).combine_chunks()
            full = order[place == rows]
            top = dict(zip(grp[full].tolist(), seq[full].tolist()))
        if kept is not None:
            yield from kept.to_batches()

    return fn


def _walk(radius: float, dim: int, rows: int):
    """Walk the first ``rows`` of each group, which come in order.

    After a group's accepted rows comes one with their number (as seq), the last seq walked and whether more rows came.
    """
    names = ["grp", "seq", "id", "features", "nth", "last", "more"]

    def out(grp, seq, ids, vecs, nth, last, more):
        n = len(nth)
        cols = [pa.array(np.full(n, grp), pa.int32()), seq, ids, vecs, pa.array(nth, pa.int32())]
        return pa.RecordBatch.from_arrays([*cols, pa.array([last] * n, pa.int64()), pa.array([more] * n, pa.bool_())], names)

    def fn(batches):
        now, seen, last, cent = None, 0, None, None

        def mark():
            none = pa.nulls(1, pa.list_(pa.float64()))
            return out(now, pa.array([len(cent)], pa.int64()), pa.nulls(1, pa.int64()), none, [None], last, seen > rows)

        for rb in batches:
            grp = rb.column(0).to_numpy()
            edge = np.concatenate([[0], np.flatnonzero(np.diff(grp)) + 1, [len(grp)]])
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if lo == hi:
                    continue
                if now is None or grp[lo] != now:
                    if now is not None:
                        yield mark()
                    now, seen, last, cent = int(grp[lo]), 0, None, np.zeros((0, dim))
                part = rb.slice(lo, min(hi - lo, max(rows - seen, 0)))
                seen += hi - lo
                if part.num_rows == 0:
                    continue
                last = part.column(1)[-1].as_py()
                x, _ = physical._features_matrix(part, "features", dim)
                at = greedy_pick(x, radius, cent if len(cent) else None)
                if at:
                    took = part.take(pa.array(at, pa.int64()))
                    yield out(now, took.column(1), took.column(2), took.column(3), np.arange(len(at)) + len(cent), None, None)
                    cent = np.vstack([cent, x[at]])
        if now is not None:
            yield mark()

    return fn


def _leave(radius: float, dim: int, accepted: dict[int, np.ndarray], last: dict[int, int]):
    """Rows that were neither walked nor are covered by their group's newly accepted rows."""

    def fn(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            grp, seq = rb.column(0).to_numpy(), rb.column(1).to_numpy()
            x, _ = physical._features_matrix(rb, "features", dim)
            keep = np.ones(len(grp), bool)
            for g in np.unique(grp).tolist():
                at = np.flatnonzero((grp == g) & keep)
                at_left = at[seq[at] > last.get(g, -1)]
                keep[at] = False
                if g in accepted:
                    at_left = at_left[~physical.any_within(x[at_left], accepted[g], radius)]
                keep[at_left] = True
            if keep.any():
                yield rb.filter(pa.array(keep))

    return fn


def walked(rows: DataFrame, radius: float, dim: int, most: int) -> tuple[DataFrame, list]:
    """The accepted ones of the first ``most`` rows of each group of ``rows`` (which come in order), stored; and each group's last row."""
    out = storage.held(rows.select("grp", "seq", "id", "features").mapInArrow(_walk(float(radius), dim, most), HEAD_SCHEMA), "greedy-heads")
    ends = out.where("nth is null").select("grp", F.col("seq").alias("n"), "last", "more").collect()
    return out.where("nth is not null").select("grp", "seq", "id", "features", "nth"), ends


def greedy_rounds(points: DataFrame, radius: float, dim: int, groups: int = 1, head_rows: int = HEAD_ROWS, trace: list | None = None) -> list[DataFrame]:
    """Accepted rows of ``points`` (``grp, seq, id, features``), one stored table ``grp, seq, id, features, nth`` per round.

    ``nth`` counts a group's accepted rows within the round. ``groups`` bounds the number of groups.
    ``trace`` gets the number of accepted rows of each round.
    """
    rows = max(1, min(head_rows, physical.MAX_CENTER_NUMBERS // max(1, groups * dim)))
    schema = "grp int, seq bigint, id bigint, features array<double>"
    tables = []
    with ExitStack() as now:
        left = points.select("grp", "seq", "id", "features")
        while True:
            heads = left.mapInArrow(_thin(rows), schema).repartition("grp").sortWithinPartitions("grp", "seq")
            table, ends = walked(heads, radius, dim, rows)
            tables.append(table)
            if trace is not None:
                trace.append(sum(r["n"] for r in ends))
            if not any(r["more"] for r in ends):
                return tables
            got: dict[int, list] = {}
            for r in tables[-1].select("grp", "features").collect():
                got.setdefault(r["grp"], []).append(r["features"])
            accepted = {g: np.array(v, np.float64) for g, v in got.items()}
            last = {r["grp"]: r["last"] for r in ends}
            undecided = left.mapInArrow(_leave(float(radius), dim, accepted, last), schema)
            then = ExitStack()
            left = then.enter_context(storage.prepared(undecided, "greedy-left"))
            now.close()  # the rows of the round before
            now = then
