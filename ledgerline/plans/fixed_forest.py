"""A small forest given by rule, so that scoring, rounding, flagging and the
watch-list can be checked against SQL (a fitted forest has no SQL statement).

Every tree has three splits over z-scored features: the root and one below
each side.  ``trees`` lists them as ((feature, threshold) x 3, leaf sizes).
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from ledgerline.operators.isolation_forest import Forest

N_TREES = 24
PSI = 32
DEPTH = 2


def trees() -> list[tuple[list[tuple[int, float]], list[int]]]:
    out = []
    for i in range(N_TREES):
        splits = [((i + k) % 4, round(-2.0 + 0.17 * ((7 * i + 5 * k) % 25), 2)) for k in range(3)]
        sizes = [1 + i % 3, 3 + i % 5, 20 - i % 7]
        out.append((splits, [*sizes, PSI - sum(sizes)]))
    return out


def forest() -> Forest:
    rows = []
    for t, (splits, sizes) in enumerate(trees()):
        (f0, t0), (f1, t1), (f2, t2) = splits
        rows += [
            (t, 0, f0, t0, 1, 2, PSI, 0),
            (t, 1, f1, t1, 3, 4, sizes[0] + sizes[1], 1),
            (t, 2, f2, t2, 5, 6, sizes[2] + sizes[3], 1),
            *[(t, 3 + k, -1, 0.0, -1, -1, n, DEPTH) for k, n in enumerate(sizes)],
        ]
    names = ["tree_id", "node_id", "feature", "threshold", "left", "right", "size", "depth"]
    return Forest.from_nodes(pd.DataFrame(rows, columns=names), N_TREES, DEPTH, PSI)


def leaf_path(size: int) -> float:
    """Depth plus the mean path of an unsuccessful search among ``size``."""
    from ledgerline.operators.isolation_forest import average_path_length

    return DEPTH + float(average_path_length(np.array([size]))[0])
