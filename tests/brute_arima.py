"""The same ARIMA search for one series, row by row with plain least squares."""

import numpy as np

MAX, LONG, LAGS = 5, 7, 12


def kpss(z):
    n = len(z)
    e = z - z.mean()
    if (e * e).sum() <= 1e-10 * n:
        return 0.0
    lag = int(3 * np.sqrt(n) / 13)
    spread = (e * e).sum()
    for j in range(1, lag + 1):
        spread += 2 * (1 - j / (lag + 1)) * (e[j:] * e[:-j]).sum()
    return (np.cumsum(e) ** 2).sum() / n**2 / (spread / n)


def strength(x, season):
    t = np.arange(1, len(x) + 1)
    off = x - np.polyval(np.polyfit(t, x, 1), t)
    if off.var() <= 1e-10:
        return 0.0
    rest = off.copy()
    for place in range(season):
        at = t % season == place
        rest[at] -= off[at].mean()
    return 1 - rest.var() / off.var()


def roots_outside(weights):
    if not len(weights) or not np.any(weights):
        return True
    last = np.max(np.nonzero(weights)) + 1
    roots = np.roots(np.r_[-np.asarray(weights)[:last][::-1], 1])
    return bool(np.all(np.abs(roots) > 1.01))


def fit(y, season):
    y = np.asarray(y, float)
    n, centre, scale = len(y), y.mean(), y.std()
    if n < 4 or scale <= 1e-10 * max(abs(centre), 1):
        return None
    x = (y - centre) / scale
    sd = int(n >= 2 * season + 8 and strength(x, season) > 0.64)
    z = x[season:] - x[:-season] if sd else x
    d, w = 0, z
    if kpss(z) > 0.463:
        d, w = 1, np.diff(z)
        if kpss(w) > 0.463:
            d, w = 2, np.diff(w)
    seasonal = len(w) >= 2 * season + LAGS
    reach = min(LAGS, max(0, (len(w) - 3) // 2))
    most = reach * MAX // LAGS
    back = reach - most
    start = max(LAGS, season) if seasonal else reach
    rows = np.arange(start, len(w))
    count = len(rows)
    if count == 0:
        return None

    long_x = np.column_stack([np.ones(count)] + [w[rows - i] for i in range(1, back + 1)])
    long = np.linalg.lstsq(long_x, w[rows], rcond=None)[0]

    def residual(t):
        return w[t] - long[0] - sum(long[i] * w[t - i] for i in range(1, back + 1))

    best = None
    for s in (0, 1) if seasonal else (0,):
        for p in range(MAX + 1 - s):
            for q in range(MAX + 1 - s - p):
                if max(p, q) > most:
                    continue
                for const in (0, 1) if d + sd <= 1 else (0,):
                    cols = [np.ones(count)] * const + [w[rows - i] for i in range(1, p + 1)]
                    cols += [residual(rows - j) for j in range(1, q + 1)]
                    cols += [w[rows - season]] if s else []
                    beta, sse = np.zeros(0), (w[rows] ** 2).sum()
                    if cols:
                        m = np.column_stack(cols)
                        beta = np.linalg.lstsq(m, w[rows], rcond=None)[0]
                        sse = ((w[rows] - m @ beta) ** 2).sum()
                    k = len(cols) + 1
                    if count - k - 1 <= 0:
                        continue
                    sse = max(sse, 1e-10 * count)
                    score = count * np.log(sse / count) + 2 * k
                    score += 2 * k * (k + 1) / (count - k - 1)
                    ar = np.zeros(max(p, season * s))
                    ar[:p] = beta[const : const + p]
                    if s:
                        ar[season - 1] += beta[-1]
                    ma = beta[const + p : const + p + q]
                    if best is not None and score >= best[0] - 1e-9:
                        continue
                    if roots_outside(ar) and roots_outside(-ma):
                        c = beta[0] if const else 0.0
                        best = (score, (p, d, q, s, sd), c, ar, ma)
    return best and (best, residual, (x, z, w), (centre, scale))


def forecast(y, season, horizon):
    y = np.asarray(y, float)
    found = fit(y, season)
    if found is None:
        return (0, 0, 0, 0, 0), np.full(horizon, y.mean())
    (_, order, c, ar, ma), residual, (x, z, w), (centre, scale) = found
    _, d, _, _, sd = order
    x, z, path = list(x), list(z), list(w)
    n = len(path)
    for k in range(horizon):
        value = c + sum(a * path[-1 - i] for i, a in enumerate(ar))
        value += sum(b * residual(n + k - j) for j, b in enumerate(ma, 1) if j > k)
        path.append(value)
        z.append(value + (0, z[-1], 2 * z[-1] - z[-2])[d])
        x.append(z[-1] + (x[-season] if sd else 0.0))
    return order, centre + scale * np.array(x[-horizon:])
