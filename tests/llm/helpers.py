"""Plain versions that the operators are held against."""
import re


def pieces(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, n):
    w = pieces(text)
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def components(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {i: root(i) for i in ids}


def near_duplicates(rows, n, percent=80):
    """{id: (set size, component)} by comparing every two sets that share a shingle."""
    sets = {i: shingles(t, n) for i, t in rows}
    where, pairs = {}, set()
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    for ids in where.values():
        pairs.update((a, b) for a in ids for b in ids if a < b)
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components(sets, links)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def duplicate_lines(rows):
    """{id: removed line numbers} by comparing every line with all earlier ones that share a word."""
    lines = [(i, p, frozenset(pieces(x))) for i, t in rows for p, x in enumerate(t.split("\n") if t else [])]
    lines = sorted((x for x in lines if x[2]), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    out, where = {i: [] for i, _ in rows}, {}
    firsts = {}
    for i, p, s in lines:
        if s in firsts:
            out[i] += [p] if firsts[s] != (i, p) else []
        near = {k for w in s for k in where.get(w, ())}
        linked = s in firsts or any(5 * len(s & k) >= 4 * len(s | k) for k in near)
        if linked and p not in out[i]:
            out[i].append(p)
        if s not in firsts:
            firsts[s] = i, p
            for w in s:
                where.setdefault(w, []).append(s)
    return {i: sorted(v) for i, v in out.items()}


def repeated_bytes(rows, length=100):
    """[(n_bytes, n_removed, n_spans, kept bytes)] in the order of ``rows`` (id, text), which is by id."""
    seen, out = set(), []
    for _, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            piece = data[s:s + length]
            if piece in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(piece)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(data), sum(gone), spans, kept))
    return out
