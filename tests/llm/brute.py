"""Plain definitions that the operators are compared with."""

import collections
import re

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def spans(flags):
    out, start = [], None
    for i, f in enumerate([*flags, False]):
        if f and start is None:
            start = i
        if not f and start is not None:
            out.append((start, i))
            start = None
    return out


def contamination(text, items, n):
    """(number of words, hit spans, items) of one text."""
    w, hit, found = words(text), set(), set()
    for item, other in items:
        o = words(other)
        for k in range(max(len(o) - n + 1, min(len(o), 1))):
            part = o[k:k + n]
            for i in range(len(w) - len(part) + 1):
                if w[i:i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    found.add(str(item))
    return len(w), spans([i in hit for i in range(len(w))]), sorted(found)


def runs(text, n=5):
    w = words(text)
    return collections.Counter(zip(*(w[i:] for i in range(n)))) if len(w) >= n else collections.Counter([tuple(w)])


def similarity(a, b):
    both, any_ = sum((a & b).values()), sum((a | b).values())
    return both / any_ if any_ else 1.0


def classes(texts, least):
    """Least id of the similarity component of each text."""
    ids, sets = sorted(texts), {i: runs(t) for i, t in texts.items()}
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and similarity(sets[a], sets[b]) >= least - 1e-9:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def repeated(texts, n):
    """For each text (bytes), the flags of bytes in an ``n``-byte string that starts elsewhere too."""
    seen = collections.defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - n + 1):
            seen[t[p:p + n]].append((i, p))
    gone = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p:p + n] = b"\1" * n
    return gone


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(s):
    return re.sub("[^0-9]", "", s)


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(_digits(m[0])) <= 19 and luhn(_digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m[0])) <= 15),
)
SECRETS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24),
)


def found(text, kinds):
    """(place of the kind, start, end) of every valid base match, by kind."""
    return [(k, m.start(), m.end()) for k, (_, p, ok) in enumerate(kinds) for m in re.finditer(p, text or "", re.A) if ok(m)]


def listing(matches, kinds):
    return ",".join(f"{kinds[k][0]}:{a}:{z}" for k, a, z in matches)


def quality(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, hit = collections.Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)
