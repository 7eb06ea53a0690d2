"""Plain NumPy and Python models that the operators are checked against."""

import numpy as np


def blobs(n, d, k, seed=0, spread=1.0):
    """``n`` rounded points around ``k`` centres, with some equal rows."""
    rng = np.random.default_rng(seed)
    c = rng.uniform(0, 10, (k, d))
    x = np.round(c[rng.integers(0, k, n)] + rng.normal(0, spread, (n, d)), 1)
    x[n // 2] = x[0]
    x[n - 1] = x[1]
    return x


def sq(a, b):
    return ((a[:, None] - b[None]) ** 2).sum(-1)


def lloyd(x, seeds, tol, max_iter):
    """Centres, rounds, sizes and squared error under the final centres."""
    c = np.array(seeds, float)
    for it in range(1, max_iter + 1):
        lab = sq(x, c).argmin(1)
        new = np.array([x[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(len(c))])
        delta = ((new - c) ** 2).sum()
        c = new
        if delta <= tol:
            break
    d = sq(x, c)
    return c, it, np.bincount(d.argmin(1), minlength=len(c)).tolist(), d.min(1).sum()


def greedy(x, radius):
    out = []
    for i, v in enumerate(x):
        if all(np.sqrt(((v - x[j]) ** 2).sum()) > radius for j in out):
            out.append(i)
    return out


def canopy_kmeans(x, t1, t2, t3, tol, max_iter):
    """One bucket, rows in order: canopies, covered rows, deltas, sizes of the last round."""
    local = x[greedy(x, t1)]
    can = local[greedy(local, t3)]
    member = np.sqrt(sq(x, can)) < t2
    cov = np.flatnonzero(member.any(1))
    centre = {j: can[j] for j in range(len(can))}
    active = {j: {j} for j in centre}
    deltas, sizes = [], {}
    for _ in range(max_iter):
        if not active:
            break
        own = {}
        for i in cov:
            mine = set(np.flatnonzero(member[i]))
            may = [j for j in sorted(active) if active[j] & mine]
            if may:
                own.setdefault(min(may, key=lambda j: (((x[i] - centre[j]) ** 2).sum(), j)), []).append(i)
        new = {j: x[rows].mean(0) for j, rows in own.items()}
        sizes = {j: len(rows) for j, rows in own.items()}
        deltas.append(sum(((new[j] - centre[j]) ** 2).sum() for j in new))
        centre.update(new)
        active = {j: s for j in new if (s := set(np.flatnonzero(np.sqrt(sq(new[j][None], can))[0] < t2)))}
        if deltas[-1] <= tol:
            break
    return len(can), len(cov), deltas, [sizes.get(j, 0) for j in range(len(can))]


def density_seeds(x, t2, most=3, weight="reference"):
    """Rows chosen as centres, walking the sample in order."""
    d2 = sq(x, x)
    inside = d2 <= t2
    dens, total, near = inside.sum(1), d2.sum(1), np.where(inside, d2, 0).sum(1)
    first = min(range(len(x)), key=lambda i: (-dens[i], i))
    chosen, value = [first], [tuple(v) for v in x]
    scan = [i for i in range(len(x)) if value[i] != value[first]]
    alive = list(scan)
    for i in scan:
        if len(chosen) == most or not alive:
            break
        if min(np.sqrt(d2[i, c]) for c in chosen) <= t2:
            alive = [j for j in alive if value[j] != value[i]]
            continue

        def score(j):
            m = min(range(len(chosen)), key=lambda q: (np.sqrt(d2[j, chosen[q]]), q))
            far = np.sqrt(d2[j, chosen[m]])
            if weight == "reference":
                return dens[first] / (total[m] / dens[m]) * far
            return dens[j] / (near[j] / dens[j]) * far if near[j] else 0.0

        chosen.append(min(alive, key=lambda j: (-score(j), j)))
        alive = [j for j in alive if value[j] != value[chosen[-1]]]
    return chosen, [int(dens[c]) for c in chosen]
