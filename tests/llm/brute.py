"""Plain versions of the operators, over lists, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {
        i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for k in range(3)
    }
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def secret_base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def spans_digest(spans):
    listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
    return hashlib.sha256(listed.encode()).hexdigest()


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        a, b = sorted((self.find(x), self.find(y)))
        self.up[b] = a


def shingle_words(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def jaccard_components(rows):
    """{id: (set size, component)} of (id, text)."""
    sets = [(i, shingle_words(t)) for i, t in rows]
    groups = Union()
    for n, (i, x) in enumerate(sets):
        groups.find(i)
        for j, y in sets[:n]:
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    groups.join(i, j)
    return {i: (len(x), groups.find(i)) for i, x in sets}


def mix(rows, weights, share, epochs, seed):
    """[(key, epoch)] of rows (key, path, tokens)."""
    leaves = defaultdict(int)
    for _, path, tokens in rows:
        leaves[path] += tokens
    depth = len(next(iter(leaves), ()))

    def weight(path):
        return weights.get(path, 1)

    alive = [p for p in leaves if all(weight(p[:d]) > 0 for d in range(1, depth + 1))]
    capacity = defaultdict(int)
    for p in alive:
        for d in range(depth + 1):
            capacity[p[:d]] += leaves[p] * epochs
    budgets = {(): min(sum(leaves.values()) * share[0] // share[1], capacity[()])}

    def hand_down(path):
        children = sorted({p[: len(path) + 1] for p in alive if p[: len(path)] == path})
        children.sort(key=lambda c: (capacity[c] / weight(c), c[-1]))
        left, weights_left = budgets[path], sum(map(weight, children))
        for n, c in enumerate(children):
            if left * weight(c) < capacity[c] * weights_left:
                for rest in children[n:]:
                    budgets[rest] = left * weight(rest) // weights_left
                break
            budgets[c] = capacity[c]
            left, weights_left = left - capacity[c], weights_left - weight(c)
        if len(path) + 1 < depth:
            for c in children:
                hand_down(c)

    hand_down(())
    out = []
    for path, available in leaves.items():
        budget = budgets.get(path, 0)
        full, rest = divmod(budget, available) if available else (0, 0)
        own = [(k, t) for k, p, t in rows if p == path]
        out += [(k, e) for k, _ in own for e in range(full)]
        own.sort(key=lambda r: hashlib.md5(f"{seed}:{full}:{'' if r[0] is None else r[0]}".encode()).hexdigest())
        used = 0
        for k, t in own:
            used += t
            if rest and used <= rest:
                out.append((k, full))
    return sorted(out, key=str)


def clean_line(line):
    """Whether a line with words keeps all rules."""
    line = line.strip(" \t\n\x0b\x0c\r")
    n = len(WORD.findall(line))
    symbols, bars, shouts = (len(re.findall(c, line)) for c in (r"[#*$%&|<>]", "[|>»›•·]", "[!?]"))
    if symbols > 0.3 * n or (bars >= 3 and bars > 0.2 * n) or shouts > 0.5 * max(n, 4):
        return False
    phrases = (
        "accept cookies|all rights reserved|click here|cookie policy|enable javascript|log in|lorem ipsum|privacy policy"
        "|sign in|sign up|subscribe to our newsletter|terms of service|terms of use"
    ).replace(" ", r"[ \x09-\x0D]+")
    if len(line) <= 200 and re.search(rf"(?:^|[^A-Za-z0-9_])(?:{phrases})(?:[^A-Za-z0-9_]|$)", line, re.I | re.A):
        return False
    return line.rstrip("\"')]»”’")[-1:] in tuple(".!?…。！？")


def quality_kept(text):
    n, chars, _, _, _, failed = quality_base(text)
    lost = sum(
        len(w) for line in (text or "").split("\n") if WORD.search(line) and not clean_line(line) for w in WORD.findall(line)
    )
    return not failed and lost <= 0.5 * chars
