"""Brute-force versions of operators, for small tables."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words1(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def contamination_by_force(texts, items, size=10):
    out = {}
    for k, text in enumerate(texts):
        w, hit, found = words1(text), set(), set()
        for item, it in items:
            b = words1(it)
            n = min(size, len(b))
            for i in range(max(len(b) - size, 0) + 1 if b else 0):
                win = b[i:i + n]
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == win:
                        hit.update(range(p, p + n))
                        found.add(str(item))
        out[k] = (len(w), len(hit), sorted(found))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def spans_by_force(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def jaccard_by_force(texts):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(ASCII_LOWER))
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4
                    else ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: (len(s), root(i)) for i, s in enumerate(sets)}
