"""K1 rounds that remember: most points compute one distance a round.

When a state is laid down, every point stores its nearest centre and a lower bound
of its distance to any other one, both for the centres of that moment. Later
centres lie within their drift from those. So a point whose distance to its own
centre stays under its bound less the largest drift of another centre has the
same nearest centre still (triangle inequality); only the rest compute more, and
only to centres within twice that distance of their own one. Drifts are straight
from the state's centres, not added up by rounds. Once a round computed over
``RENEW`` of all distances, the next lays the state down anew, from the old one.

The state is a table in the shared folder (the points' columns, the nearest
centre and the bound), read and filtered like any other: no join, no shuffle of
points. It costs a copy of the points, so it pays where K distances a point cost
more than reading two more columns. Centres, deltas and trace equal those of the
plain rounds up to the rounding of sums.
"""

from __future__ import annotations

from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators.assign import assemble_long
from lodestar.plans import physical, storage

#: Share of all distances that a round may compute before the state is renewed.
RENEW = 0.1
#: Up to this many centres their distances from each other are used.
MOST_BETWEEN = 2048
#: Rows that meet the same centres in one step.
STEP_ROWS = 256
#: Cluster number of the rows that count distances.
COUNTS = -1


def _two_nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centre (lowest position on ties), its squared distance, and the distance of the next one."""
    n, k = len(x), len(c)
    lab, d2, low = np.zeros(n, np.int64), np.zeros(n), np.full(n, np.inf)
    step = max(1, physical._BLOCK_ELEMS // max(1, k))
    for s in range(0, n, step):
        d = physical.sq_dists(x[s : s + step], c)
        j = d.argmin(axis=1)
        rows = np.arange(len(j))
        lab[s : s + step], d2[s : s + step] = j, d[rows, j]
        if k > 1:
            d[rows, j] = np.inf
            low[s : s + step] = np.sqrt(d.min(axis=1))
    return lab, d2, low


class _Checked:
    """Nearest centres of rows with a stored centre and bound, new bounds, and the distances computed beyond one a row.

    A row that its bound doesn't settle meets only centres within twice its distance
    from its own centre: no other can be nearer (triangle inequality).
    """

    def __init__(self, c: np.ndarray, drift: np.ndarray):
        self.c = c
        order = np.argsort(drift)
        top = drift[order[-1]]
        self.other = np.full(len(c), top)  # largest drift of another centre
        self.other[order[-1]] = drift[order[-2]] if len(c) > 1 else 0.0

        self.order = self.between = None

    def _settle(self, x: np.ndarray, cid: np.ndarray, own: np.ndarray):
        if self.order is None:  # made by the task
            between = np.sqrt(physical.sq_dists(self.c, self.c))
            self.order = np.argsort(between, axis=1, kind="stable")
            self.between = np.take_along_axis(between, self.order, axis=1)
        lab, d2, low, n = cid.copy(), np.zeros(len(x)), np.zeros(len(x)), 0
        for j in np.unique(cid).tolist():
            mine = np.flatnonzero(cid == j)
            mine = mine[np.argsort(own[mine], kind="stable")]
            for s in range(0, len(mine), STEP_ROWS):
                rows = mine[s : s + STEP_ROWS]
                m = int(np.searchsorted(self.between[j], 2 * own[rows[-1]] * (1 + 1e-9), side="right"))
                cand = np.sort(self.order[j, :m])
                at, d2[rows], second = _two_nearest(x[rows], self.c[cand])
                lab[rows] = cand[at]
                beyond = self.between[j, m] * (1 - 1e-9) - own[rows] if m < len(self.c) else np.inf
                low[rows] = np.minimum(second, beyond)
                n += len(rows) * m
        return lab, d2, low, n

    def __call__(self, x: np.ndarray, cid: np.ndarray, low: np.ndarray):
        d2 = np.zeros(len(x))
        for j in range(x.shape[1]):
            diff = x[:, j] - self.c[cid, j]
            d2 += diff * diff
        left = low - self.other[cid]
        own = np.sqrt(d2)
        open_ = np.flatnonzero(~(own * (1 + 1e-9) < left))
        cid, low, n = cid.copy(), left, 0
        if len(open_) and len(self.c) <= MOST_BETWEEN:
            cid[open_], d2[open_], low[open_], n = self._settle(x[open_], cid[open_], own[open_])
        elif len(open_):
            cid[open_], d2[open_], low[open_] = _two_nearest(x[open_], self.c)
            n = len(open_) * len(self.c)
        return cid, d2, low, n


class BoundedStats:
    """``collect_stats`` for one run of rounds: called with each round's centres."""

    def __init__(self, points: DataFrame, features: str, weight: str | None, computed: list | None, stack: ExitStack):
        self.points, self.features, self.weight = points, features, weight
        self.computed = [] if computed is None else computed
        self.held = self.state = self.anchor = None
        self.renew = True
        stack.callback(lambda: self.held and self.held.close())

    def _lay_down(self, c: np.ndarray) -> int:
        """Write the state for these centres; returns the distances computed."""
        d, features, state = c.shape[1], self.features, self.state
        schema = T.StructType([*self.points.schema.fields, T.StructField("_cid", T.IntegerType()), T.StructField("_low", T.DoubleType())])
        check = None if state is None else _Checked(c, np.sqrt(((c - self.anchor) ** 2).sum(axis=1)))
        names = schema.names
        seen = self.points.sparkSession.sparkContext.accumulator(0)

        def fn(batches):
            for rb in batches:
                if rb.num_rows == 0:
                    continue
                x, ok = physical._features_matrix(rb, features, d)
                if check is None:
                    cid, _, low = _two_nearest(x, c)
                    seen.add(len(x) * len(c))
                    cols = rb.columns
                else:
                    cid, _, low, n = check(x, rb.column(rb.num_columns - 2).to_numpy().astype(np.int64), rb.column(rb.num_columns - 1).to_numpy())
                    cols = rb.columns[:-2]
                    seen.add(len(x) + n)
                out = pa.RecordBatch.from_arrays([*cols, pa.array(cid, pa.int32()), pa.array(low)], names)
                yield out if ok.all() else out.filter(pa.array(ok))

        then = ExitStack()
        self.state = then.enter_context(storage.prepared((self.points if state is None else state).mapInArrow(fn, schema), "bounds", stored=True))
        if self.held is not None:
            self.held.close()
        self.held, self.anchor = then, c
        return seen.value

    def __call__(self, centers: list[list[float]]) -> list[dict]:
        c = np.array(centers, np.float64)
        first = self._lay_down(c) if self.renew else 0
        check = _Checked(c, np.sqrt(((c - self.anchor) ** 2).sum(axis=1)))
        k, d, features, weight = len(c), c.shape[1], self.features, self.weight

        def fn(batches):
            total, rows, whole = np.zeros((k, d + 3)), 0, 0
            for rb in batches:
                if rb.num_rows == 0:
                    continue
                x, _ = physical._features_matrix(rb, features, d)
                wt = None if weight is None else rb.column(rb.schema.get_field_index(weight)).to_numpy(zero_copy_only=False).astype(np.float64)
                at = rb.schema.get_field_index
                cid, d2, _low, n = check(x, rb.column(at("_cid")).to_numpy().astype(np.int64), rb.column(at("_low")).to_numpy())
                total += physical._sums(cid, x, d2, wt, k)
                rows, whole = rows + len(x), whole + n
            live = np.flatnonzero(total[:, 0])
            if len(live):
                yield physical._long(live, total[live], ["cid", "dim", "value"])
                yield pa.RecordBatch.from_arrays([pa.array([COUNTS] * 2, pa.int32()), pa.array([0, 1], pa.int32()), pa.array([float(rows), float(whole)])], ["cid", "dim", "value"])

        cols = [features, "_cid", "_low", *([weight] if weight else [])]
        part = self.state.select(*cols).mapInArrow(fn, "cid int, dim int, value double")
        tot = part.groupBy("cid", "dim").agg(F.sum("value").alias("value")).collect()
        seen = {r["dim"]: int(r["value"]) for r in tot if r["cid"] == COUNTS}
        self.computed.append(first + seen.get(0, 0) + seen.get(1, 0))
        self.renew = seen.get(1, 0) > RENEW * k * max(seen.get(0, 0), 1)
        return assemble_long([r for r in tot if r["cid"] != COUNTS], d)
