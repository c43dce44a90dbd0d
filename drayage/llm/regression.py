"""Logistic regression with a square penalty on sparse yes-or-no features, with array operations.

The loss is the mean over the rows plus half the penalty times the square of the weights. Rows
told well have next to none, so the loss of a few chosen rows is lowered first, by Newton's method
on their products with each other, whose steps stay few however far apart the scales lie. One pass
over all rows then tells which others to choose. The loss bends at least as much as the penalty, so
that of the chosen rows is at most the slope's square over twice the penalty above its least one,
which is no more than the least one of all rows: this and the loss of the others tell when to end.

Where too many rows have to be chosen, as with labels that tell little, limited-memory quasi-Newton
steps go on from there; each takes the loss and its slope from one pass of array operations over
all rows, and ends by the same rule.

Features are numbered anew, those of most rows first, so that the weights needed most often lie
together in the processor's cache. Rows are kept in about two bytes for each feature.
"""

from __future__ import annotations

import numpy as np

#: Rows that are chosen at first, and at most: products of so many with each other are kept.
FIRST_ROWS = 512
CHOSEN_ROWS = 4096
#: Features whose products are taken at once.
COLUMNS = 1024
#: Newton's method ends within its gap, or gives up after so many steps.
NEWTON_STEPS = 200
#: Steps whose effect on the slope is remembered.
REMEMBERED = 8
#: The fit ends within its gap, or after so many steps.
STEPS = 1000
#: Features of rows that are taken at once.
BLOCK_FEATURES = 1 << 21

#: There are at most so many features.
MOST_FEATURES = 1 << 20
_HIGH = np.arange(MOST_FEATURES >> 16, dtype=np.int32) << 16


def shortened(found: np.ndarray) -> bytes:
    """Ascending features in two bytes each, behind how many there are of each higher part."""
    return np.bincount(found >> 16, minlength=len(_HIGH)).astype("<i4").tobytes() + found.astype("<u2").tobytes()


def lengthened(data: bytes) -> np.ndarray:
    counts = np.frombuffer(data, "<i4", len(_HIGH))
    return np.repeat(_HIGH, counts) + np.frombuffer(data, "<u2", offset=4 * len(_HIGH))


def fit(rows: list[bytes], labels: np.ndarray, scales: np.ndarray, penalty: float, bias: float, gap: float) -> tuple[np.ndarray, float]:
    """Weights of the unscaled features, zero for those in no row, and the intercept, with a loss
    within ``gap`` of the least. ``bias`` is the scale of the intercept's feature. The shortened
    ``rows`` are replaced by those with the new numbers."""
    seen = np.zeros(len(scales), np.int64)
    for row in rows:
        seen[lengthened(row)] += 1
    used = np.flatnonzero(seen)
    used = used[np.argsort(-seen[used], kind="stable")]
    place = np.zeros(len(scales), np.int32)
    place[used] = np.arange(len(used))
    for i, row in enumerate(rows):
        # Ascending places: the weights are read from front to back.
        rows[i] = shortened(np.sort(place[lengthened(row)]))
    signs, scales_used = np.where(labels > 0, 1.0, -1.0), scales[used]
    at, ended = _chosen(rows, signs, scales_used, penalty, bias, gap)
    if not ended:
        at = _solved(_blocks(rows), signs, scales_used, penalty, bias, gap, at)
    weights, intercept = at[:-1] * scales_used, float(at[-1] * bias)
    out = np.zeros(len(scales))
    out[used] = weights
    return out, intercept


def _blocks(rows: list[bytes]) -> list[tuple[list[bytes], int, int]]:
    """Neighbouring rows, and the range they are, with about ``BLOCK_FEATURES`` features each."""
    ends = np.cumsum([len(r) // 2 for r in rows])
    cuts = [0, *(np.flatnonzero(np.diff(ends // BLOCK_FEATURES)) + 1).tolist(), len(rows)]
    return [(rows[a:b], a, b) for a, b in zip(cuts, cuts[1:])]


def _joined(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The features of all ``rows`` and how many each has."""
    heads = np.frombuffer(b"".join([r[: 4 * len(_HIGH)] for r in rows]), "<i4")
    lows = np.frombuffer(b"".join([r[4 * len(_HIGH) :] for r in rows]), "<u2")
    found = np.repeat(np.tile(_HIGH, len(rows)), heads)
    found += lows
    return found, heads.reshape(len(rows), -1).sum(1)


def _sums(weights: np.ndarray, found: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For neighbouring rows of ``lengths`` features, the sum of the weights of those ``found``."""
    sums = np.add.reduceat(np.r_[weights[found], 0.0], np.r_[0, np.cumsum(lengths)][:-1])
    sums[lengths == 0] = 0.0
    return sums


def _chosen(rows: list[bytes], signs: np.ndarray, scales: np.ndarray, penalty: float, bias: float, gap: float) -> tuple[np.ndarray, bool]:
    """Weights of numbered and scaled features, the intercept's last, by the rows that matter, and
    whether their loss is within ``gap`` of the least. Half of it is for the rows not chosen."""
    n, blocks = len(signs), _blocks(rows)
    at, margins, rest = np.zeros(len(scales) + 1), np.zeros(n), np.ones(n, bool)
    chosen, duals, products, before = np.empty(0, np.int64), np.empty(0), np.empty((0, 0)), n + 1
    while True:
        losses = np.where(rest, np.logaddexp(0, -margins), 0.0) / n
        if len(chosen) and losses.sum() <= gap / 2:
            return at, True
        # The fewest rows without which the others lose little, but not many more than there are.
        order = np.argsort(-losses, kind="stable")
        wanted = np.count_nonzero(np.cumsum(losses[order][::-1])[::-1] > gap / 16)
        new = order[: min(wanted, max(FIRST_ROWS, len(chosen)))]
        if len(chosen) + len(new) > CHOSEN_ROWS or len(chosen) + wanted > CHOSEN_ROWS and wanted >= before:
            # They would not fit, or are too many and get no fewer.
            return at, False
        before = wanted
        rest[new] = False
        chosen = np.r_[chosen, new]
        found, lengths = _joined([rows[i] for i in chosen])
        products = _products(products, found, lengths, signs[chosen], scales, bias)
        duals, ended = _newton(products, np.r_[duals, np.zeros(len(new))], n, penalty, gap / 2)
        if not ended:
            return at, False
        pulls = duals * signs[chosen]
        at[:-1] = np.bincount(found, np.repeat(pulls, lengths), len(scales)) * scales
        at[-1] = pulls.sum() * bias
        weights = at[:-1] * scales
        for some, start, end in blocks:
            margins[start:end] = signs[start:end] * (_sums(weights, *_joined(some)) + at[-1] * bias)


def _products(known: np.ndarray, found: np.ndarray, lengths: np.ndarray, signs: np.ndarray, scales: np.ndarray, bias: float) -> np.ndarray:
    """The products with each other, by their signs, of rows of ``lengths`` features among those
    ``found``. Those of the first rows are ``known``."""
    old, n = len(known), len(lengths)
    products = np.full((n, n), bias**2)
    new, among = products[old:], np.repeat(np.arange(n, dtype=np.int32), lengths)
    # By feature: who has it, from where on.
    order = np.argsort(found, kind="stable")
    holders, counts = among[order], np.bincount(found, minlength=len(scales))
    starts = np.cumsum(counts) - counts
    # Features of many rows as columns of a matrix.
    common = counts > n // 16
    columns = np.flatnonzero(common)
    for at in range(0, len(columns), COLUMNS):
        some = columns[at : at + COLUMNS]
        held, index = _runs(starts[some], counts[some])
        matrix = np.zeros((n, len(some)))
        matrix[holders[index], held] = scales[some][held]
        new += matrix[old:] @ matrix.T
    # Of the others, the rows that share one with a new row.
    squares, ends = scales**2, np.cumsum(lengths)
    for i in range(old, n):
        own = found[ends[i] - lengths[i] : ends[i]]
        own = own[~common[own]]
        held, index = _runs(starts[own], counts[own])
        products[i] += np.bincount(holders[index], squares[own][held], n)
    new *= signs[old:, None] * signs
    products[:old, :old] = known
    products[:old, old:] = new[:, :old].T
    return products


def _runs(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """So many numbers from each start on, behind the run that each belongs to."""
    run = np.repeat(np.arange(len(counts)), counts)
    return run, np.arange(len(run)) + (starts - np.cumsum(counts) + counts)[run]


def _newton(products: np.ndarray, duals: np.ndarray, n: int, penalty: float, gap: float) -> tuple[np.ndarray, bool]:
    """How often each row goes into the weights, for the loss of these rows among ``n``, from
    ``duals`` on, and whether it is within ``gap`` of the least."""
    margins = products @ duals
    loss = np.logaddexp(0, -margins).sum() / n + penalty / 2 * (duals @ margins)
    for _ in range(NEWTON_STEPS):
        pulls = np.exp(-np.logaddexp(0, margins))
        off = penalty * duals - pulls / n
        slope = products @ off
        if off @ slope <= 2 * penalty * gap:
            return duals, True
        bends = np.sqrt(pulls * np.exp(-np.logaddexp(0, -margins)) / n)
        # The others bend the loss by nothing that floats can hold.
        near = np.flatnonzero(bends * np.sqrt(np.diagonal(products)) > 1e-8 * np.sqrt(penalty))
        bent = products[np.ix_(near, near)]
        bent *= bends[near, None]
        bent *= bends[near]
        bent[np.diag_indices(len(near))] += penalty
        step = off.copy()
        step[near] -= bends[near] * np.linalg.solve(bent, bends[near] * slope[near])
        step /= penalty
        turn, size = products @ step, 1.0
        while True:
            next_duals, next_margins = duals - size * step, margins - size * turn
            next_loss = np.logaddexp(0, -next_margins).sum() / n + penalty / 2 * (next_duals @ next_margins)
            if next_loss <= loss - 1e-4 * size * (slope @ step):
                break
            size /= 2
            if size < 1e-12:
                return duals, False
        duals, loss = next_duals, next_loss
        margins = products @ duals
    return duals, False


def _solved(blocks: list, signs: np.ndarray, scales: np.ndarray, penalty: float, bias: float, gap: float, at: np.ndarray) -> np.ndarray:
    """Weights of numbered and scaled features, the intercept's last, from ``at`` on by steps over
    all rows, in blocks."""
    n = len(signs)

    def judged(at: np.ndarray) -> tuple[float, np.ndarray]:
        """The loss and its slope; the intercept's weight comes last."""
        weights, total = at[:-1] * scales, 0.0
        slope = np.zeros(len(at))
        for rows, start, end in blocks:
            found, lengths = _joined(rows)
            sign = signs[start:end]
            margins = sign * (_sums(weights, found, lengths) + at[-1] * bias)
            total += np.logaddexp(0, -margins).sum()
            pulls = -sign * np.exp(-np.logaddexp(0, margins))
            slope[:-1] += np.bincount(found, np.repeat(pulls, lengths), len(scales))
            slope[-1] += pulls.sum() * bias
        slope[:-1] *= scales
        return total / n + penalty / 2 * (at @ at), slope / n + penalty * at

    loss, slope = judged(at)
    moves, turns = [], []
    for _ in range(STEPS):
        if slope @ slope <= 2 * penalty * gap:
            break
        step = -_unbent(slope, moves, turns)
        size = 1.0
        while True:
            next_loss, next_slope = judged(at + size * step)
            if next_loss <= loss + 1e-4 * size * (slope @ step):
                break
            size /= 2
            if size < 1e-12:
                # No number that floats can hold is lower.
                return at
        moves.append(size * step)
        turns.append(next_slope - slope)
        del moves[:-REMEMBERED], turns[:-REMEMBERED]
        at, loss, slope = at + moves[-1], next_loss, next_slope
    return at


def _unbent(slope: np.ndarray, moves: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    """The slope times the inverse of the loss's bend, as the remembered steps tell it."""
    if not moves:
        return slope / (10 * np.sqrt(slope @ slope))
    shares = []
    for move, turn in zip(reversed(moves), reversed(turns)):
        shares.append((move @ slope) / (move @ turn))
        slope = slope - shares[-1] * turn
    slope = slope * ((moves[-1] @ turns[-1]) / (turns[-1] @ turns[-1]))
    for move, turn, share in zip(moves, turns, reversed(shares)):
        slope = slope + (share - (turn @ slope) / (move @ turn)) * move
    return slope
