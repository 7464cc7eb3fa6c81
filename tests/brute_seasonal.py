"""The seasonal order search and its rounds worked out series by series, with loops over
weeks and whole design matrices."""

import numpy as np

SHORT, LONG, LAGS, TURNS, ROUNDS = 5, 7, 12, 3, 10


def lagged(a, j):
    return [a[t - j] if t >= j else 0.0 for t in range(len(a))]


def least_squares(target, columns, rows):
    if not columns:
        return np.zeros(0)
    x = np.array([[c[t] for c in columns] for t in rows])
    return np.linalg.lstsq(x, np.array([target[t] for t in rows]), rcond=1e-12)[0]


def lags_of(p, q, ar, ma, seasonal, season):
    """{lag: weight} of the multiplied polynomials, for values and for residuals."""
    values, residuals = {}, {}
    for i in range(p):
        values[i + 1] = ar[i]
        values[season + i + 1] = -ar[i] * seasonal[0]
    values[season] = seasonal[0]
    for j in range(q):
        residuals[j + 1] = ma[j]
        residuals[season + j + 1] = ma[j] * seasonal[1]
    residuals[season] = seasonal[1]
    return values, residuals


def estimate(w, e, order, seasonal, season, rows):
    p, q, sp, sq, const = order
    one = [1.0] * len(w)
    ar, ma, c = [0.0] * SHORT, [0.0] * SHORT, 0.0
    ws, es = lagged(w, season), lagged(e, season)
    for turn in range(TURNS if sp or sq else 1):
        if turn:
            target = [w[t] - c - sum(ar[i] * lagged(w, i + 1)[t] for i in range(p)) - sum(ma[j] * lagged(e, j + 1)[t] for j in range(q)) for t in range(len(w))]
            u = [ws[t] - sum(ar[i] * lagged(ws, i + 1)[t] for i in range(p)) for t in range(len(w))]
            v = [es[t] + sum(ma[j] * lagged(es, j + 1)[t] for j in range(q)) for t in range(len(w))]
            beta = least_squares(target, [u] * sp + [v] * sq, rows)
            seasonal = [beta[0] if sp else 0.0, beta[-1] if sq else 0.0]
        target = [w[t] - seasonal[0] * ws[t] - seasonal[1] * es[t] for t in range(len(w))]
        columns = [one] * const
        columns += [[a - seasonal[0] * b for a, b in zip(lagged(w, i), lagged(ws, i))] for i in range(1, p + 1)]
        columns += [[a + seasonal[1] * b for a, b in zip(lagged(e, j), lagged(es, j))] for j in range(1, q + 1)]
        beta = least_squares(target, columns, rows)
        c = beta[0] if const else 0.0
        ar[:p], ma[:q] = beta[const : const + p], beta[const + p :]
    return c, ar, ma, seasonal


def off(w, e, order, model, season, rows):
    """Sum of squares of the residuals, taken from given earlier residuals."""
    c, ar, ma, seasonal = model
    values, residuals = lags_of(order[0], order[1], ar, ma, seasonal, season)
    total = 0.0
    for t in rows:
        x = w[t] - c
        x -= sum(v * w[t - j] for j, v in values.items() if t >= j)
        x -= sum(v * e[t - j] for j, v in residuals.items() if t >= j)
        total += x * x
    return total


def filtered(w, order, model, season):
    c, ar, ma, seasonal = model
    values, residuals = lags_of(order[0], order[1], ar, ma, seasonal, season)
    start = order[0] + (season if seasonal[0] != 0 else 0)
    e = []
    for t in range(len(w)):
        if t < start:
            e.append(0.0)
            continue
        x = w[t] - c - sum(v * w[t - j] for j, v in values.items() if t >= j)
        e.append(x - sum(v * e[t - j] for j, v in residuals.items() if t >= j))
    return e


def stable(order, model, season):
    _, ar, ma, seasonal = model
    for weights in (ar[: order[0]], [-x for x in ma[: order[1]]]):
        poly = [1.0] + [-x for x in weights]
        if any(abs(r) <= 1.01 for r in np.roots(poly[::-1])):
            return False
    return all(abs(x) * 1.01**season < 1 for x in seasonal)


def row(model, order, season):
    values, residuals = lags_of(order[0], order[1], *model[1:], season)
    return [model[0], *[v for _, v in sorted(values.items())], *[v for _, v in sorted(residuals.items())]]


def fit(w, may_shift, season):
    """(order, model, residuals, mean square, AICc) or None."""
    w = list(map(float, w))
    n = len(w)
    has_season = n >= 2 * season + LAGS and season > SHORT
    reach = min(LAGS, max(0, (n - 3) // 2))
    most = reach * SHORT // LAGS
    rows = range(season + SHORT if has_season else reach, n)
    if not rows:
        return None
    lags = [j for j in range(1, LONG + 1) if j <= reach - most] + [season, season + 1] * has_season
    beta = least_squares(w, [[1.0] * n] + [lagged(w, j) for j in lags], rows)
    known = season + 1 if has_season else reach - most
    e = [
        w[t] - beta[0] - sum(b * lagged(w, j)[t] for b, j in zip(beta[1:], lags)) if t >= known else 0.0
        for t in range(n)
    ]
    best = None
    parts = (0, 1) if has_season else (0,)
    for sp in parts:
        for sq in parts:
            for p in range(SHORT + 1 - sp - sq):
                for q in range(SHORT + 1 - sp - sq - p):
                    for const in (0, 1):
                        order, count = (p, q, sp, sq, const), len(rows)
                        k = sum(order) + 1
                        if max(p, q) > most or count - k - 1 <= 0 or (const and not may_shift):
                            continue
                        model = estimate(w, e, order, [0.0, 0.0], season, rows)
                        squares = max(off(w, e, order, model, season, rows), 1e-10 * count)
                        score = count * np.log(squares / count) + 2 * k + 2 * k * (k + 1) / (count - k - 1)
                        if (best is None or score < best[2] - 1e-9) and stable(order, model, season):
                            best = (order, model, score)
    if best is None:
        return None
    order, model, score = best
    e = filtered(w, order, model, season)
    least = sum(e[t] ** 2 for t in rows)
    for _ in range(ROUNDS if order[1] or order[3] else 0):
        new = estimate(w, e, order, list(model[3]), season, rows)
        if not stable(order, new, season):
            break
        found = filtered(w, order, new, season)
        squares = sum(found[t] ** 2 for t in rows)
        if squares >= least:
            break
        moved = max(abs(a - b) for a, b in zip(row(new, order, season), row(model, order, season)))
        model, e, least = new, found, squares
        if moved <= 1e-6:
            break
    return order, model, e, least / len(rows), score


def ahead(w, order, model, e, steps, season):
    values, residuals = lags_of(order[0], order[1], *model[1:], season)
    w, e = list(map(float, w)), list(e)
    for _ in range(steps):
        t = len(w)
        x = model[0] + sum(v * w[t - j] for j, v in values.items() if t >= j)
        w.append(x + sum(v * e[t - j] for j, v in residuals.items() if t >= j))
        e.append(0.0)
    return w[-steps:]
