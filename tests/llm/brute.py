"""The operators' results worked out the plain way, on few rows."""

import hashlib
import re

import numpy as np
import xxhash


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def groups(n, linked):
    """Smallest member of each one's group, for a symmetric boolean matrix."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in np.flatnonzero(linked[i]):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    if not words:
        return 0
    size = min(shingle, len(words))
    parts = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(parts))


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    def fits(kind, match):
        digits = re.sub("[^0-9]", "", match)
        return {
            "email": True,
            "ip": kind == "ip" and all(int(p) <= 255 for p in match.split(".")),
            "card": 14 <= len(digits) <= 19 and luhn(digits),
            "phone": 10 <= len(digits) <= 15,
        }[kind]

    found = []
    for rank, (kind, pattern) in enumerate(PII.items()):
        found += [
            (m.start(), rank, m.end(), kind)
            for m in re.finditer(pattern, text or "")
            if fits(kind, m[0])
        ]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


def contamination(text, items, width):
    """(words, words hit, ids of items with occurring windows)."""
    own, hit, named = words(text), set(), set()
    for item, body in items:
        listed = words(body)
        size = min(width, len(listed))
        for k in range(len(listed) - size + 1) if size else ():
            for at in range(len(own) - size + 1):
                if own[at : at + size] == listed[k : k + size]:
                    hit |= set(range(at, at + size))
                    named |= {item} if item is not None else set()
    return len(own), len(hit), sorted(map(str, named))


def url_parts(url):
    rest = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0]
    return ascii_lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def url_rule(url, rules):
    host, path = url_parts(url)
    fitting = [
        (len(h) + len(p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fitting)[2:] if fitting else None


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def hard_negatives(rows, is_anchor, scale=256, k=5):
    """Rows (id, vector or None, label or None) to (anchor, positive, rank, negative, scores)."""
    own = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            own.append((i, [int(np.floor(scale * x)) for x in v], label))
    out = []
    for n, (i, v, label) in enumerate(own):
        if not is_anchor(i):
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w)), j is None, j, same == label)
            for m, (j, w, same) in enumerate(own)
            if m != n and len(w) == len(v)
        ]
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        for p, _, j, _ in [r for r in scored if r[3]][:k]:
            fit = [r for r in scored if not r[3] and 80 * -p <= 100 * -r[0] <= 100 * -p]
            out += [(i, j, rank, r[2], -p, -r[0]) for rank, r in enumerate(fit[:k], 1)]
    return sorted(out, key=str)


def merkle(rows, fields, group, number, suspect):
    """Per row (a dict): leaf, subroot, root, proof, folded root; everything hashed anew."""

    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    def leaf(row):
        return sha("".join(field(row[c]) for c in fields))

    def up(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            own = levels[-1]
            levels.append([sha("".join(own[k : k + 16])) for k in range(0, len(own), 16)])
        return levels

    def proof(levels, k):
        out = []
        for own in levels[:-1]:
            first = k // 16 * 16
            out.append((own[first:k], own[k + 1 : first + 16]))
            k //= 16
        return out

    groups = {}
    for row in rows:
        groups.setdefault(row[group], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: ((r[number] is not None, r[number] or 0), leaf(r)))
        trees[name] = up([leaf(r) for r in groups[name]])
    top = up([trees[name][-1][0] for name in names])
    out = []
    for at, name in enumerate(names):
        for k, row in enumerate(groups[name]):
            path = proof(trees[name], k) + proof(top, at)
            folded = suspect(row, leaf) or leaf(row)
            for left, right in path:
                folded = sha("".join(left) + folded + "".join(right))
            siblings = "".join("".join(left + right) for left, right in path)
            out.append((row[number], leaf(row), trees[name][-1][0], top[-1][0], sha(siblings), folded, folded == top[-1][0]))
    return out
