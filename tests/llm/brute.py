"""Plain versions of what the operators compute, for small tables."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def components(sets):
    """Index of the component of each set; linked at 75 % of the union."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted((i for i, s in enumerate(sets) if s), key=lambda i: len(sets[i]))
    for a, i in enumerate(order):
        for j in order[a + 1 :]:
            if 100 * len(sets[i]) < 75 * len(sets[j]):
                break
            same = len(sets[i] & sets[j])
            if 100 * same >= 75 * len(sets[i] | sets[j]):
                root[find(j)] = find(i)
    return [find(i) for i in range(len(sets))]


def quality(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if windows[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(w)
    return (
        n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n,
    )


def water_filling(sizes, weights, share, passes):
    """Targets by raising the level over the sources' caps, lowest first."""
    total, level, used = share * sum(sizes), 0.0, 0.0
    order = sorted(range(len(sizes)), key=lambda i: passes * sizes[i] / weights[i])
    open_weight = sum(weights)
    out = [0.0] * len(sizes)
    for place, i in enumerate(order):
        level = (total - used) / open_weight
        if passes * sizes[i] > level * weights[i]:
            for j in order[place:]:
                out[j] = level * weights[j]
            break
        out[i] = float(passes * sizes[i])
        used += out[i]
        open_weight -= weights[i]
    return out


SECRETS = {
    "assign": re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"([A-Za-z0-9+/_.=-]+)",
        re.A,
    ),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}
PERSONAL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _valid(kind, m):
    digits = re.sub("[^0-9]", "", m[0])
    return {
        "assign": lambda: len(m[2]) >= 8,
        "access": lambda: len(m[0]) >= 16,
        "hex": lambda: len(m[0]) >= 32,
        "email": lambda: True,
        "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def spans(text, kinds):
    found = [
        (m.start(), rank, kind, m.end())
        for rank, (kind, pattern) in enumerate(kinds.items())
        for m in pattern.finditer(text or "")
        if _valid(kind, m)
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def written(found):
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in found)
