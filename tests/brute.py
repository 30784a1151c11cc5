"""Plain small-input versions of the density operators, to compare with."""

import numpy as np


def distances(x):
    diff = x[:, None, :] - x[None, :, :]
    return np.sqrt((diff * diff).sum(axis=2))


def dbscan(x, eps, min_samples):
    n = len(x)
    close = distances(x) <= eps
    core = close.sum(axis=1) >= min_samples
    labels = np.full(n, -1)
    cluster = 0
    for i in range(n):
        if labels[i] >= 0 or not core[i]:
            continue
        labels[i] = cluster
        todo = [i]
        while todo:
            p = todo.pop()
            for q in np.flatnonzero(close[p]):
                if labels[q] < 0:
                    labels[q] = cluster
                    if core[q]:
                        todo.append(q)
        cluster += 1
    return labels


def silhouette(x, labels):
    d = distances(x)
    out = []
    for i, own in enumerate(labels):
        inside = labels == own
        if inside.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, inside].sum() / (inside.sum() - 1)
        b = min(d[i, labels == other].mean() for other in set(labels) - {own})
        out.append(0.0 if max(a, b) == 0 else (b - a) / max(a, b))
    return float(np.mean(out))


def hdbscan(x, mcs, min_samples=None):
    """Single linkage over mutual reachability, condensed top-down, excess of mass; labels by smallest member."""
    n = len(x)
    k = min_samples or mcs
    d = distances(x)
    core = np.sort(d, axis=1)[:, k - 1]
    mr = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    iu, ju = np.triu_indices(n, 1)
    order = np.lexsort((ju, iu, mr[iu, ju]))
    parent = list(range(2 * n - 1))
    top = list(range(n))
    members = {i: [i] for i in range(n)}
    kids = {}
    height = {}
    find = list(range(2 * n))

    def root(a):
        while find[a] != a:
            find[a] = find[find[a]]
            a = find[a]
        return a

    node = n
    for e in order:
        a, b = root(iu[e]), root(ju[e])
        if a == b:
            continue
        kids[node] = (a, b)
        height[node] = mr[iu[e], ju[e]]
        members[node] = members[a] + members[b]
        find[a] = find[b] = node
        node += 1
    del parent, top
    root_node = node - 1
    inv = lambda w: np.inf if w == 0 else 1.0 / w
    clusters = {0: {"parent": None, "birth": 0.0, "kids": [], "out": []}}
    todo = [(root_node, 0)]
    while todo:
        t, c = todo.pop()
        while True:
            if t < n:
                clusters[c]["out"].append((t, clusters[c].get("last", np.inf)))
                break
            a, b = kids[t]
            lam = inv(height[t])
            big = [s for s in (a, b) if len(members[s]) >= mcs]
            if len(big) == 2:
                for s in (a, b):
                    new = len(clusters)
                    clusters[new] = {"parent": c, "birth": lam, "kids": [], "out": []}
                    clusters[c]["kids"].append((new, len(members[s])))
                    todo.append((s, new))
                break
            for s in (a, b):
                if len(members[s]) < mcs:
                    clusters[c]["out"] += [(p, lam) for p in members[s]]
            if not big:
                break
            t = big[0]
    stability, chosen = {}, set()
    for c in sorted(clusters, reverse=True):
        info = clusters[c]
        own = sum(lam - info["birth"] for _, lam in info["out"])
        own += sum(m * (clusters[s]["birth"] - info["birth"]) for s, m in info["kids"])
        below = sum(stability[s] for s, _ in info["kids"])
        if c != 0 and not (info["kids"] and below > own):
            stability[c] = own
            chosen.add(c)
        else:
            stability[c] = below
    labels = np.full(n, -1)
    for c, info in clusters.items():
        line, at = [], c
        while at is not None:
            line.append(at)
            at = clusters[at]["parent"]
        picked = [a for a in line if a in chosen]
        for p, _ in info["out"]:
            labels[p] = picked[-1] if picked else -1
    return by_first_member(labels)


def by_first_member(labels):
    out = np.full(len(labels), -1)
    seen = {}
    for i, c in enumerate(labels):
        if c >= 0:
            out[i] = seen.setdefault(c, len(seen))
    return out
