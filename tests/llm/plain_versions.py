"""Plain versions that the operators are held against."""


def shingles(text, k, as_list=False):
    words = (text or "").encode().lower().split()
    if len(words) >= k:
        out = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
    else:
        out = [tuple(words)] if words else []
    return out if as_list else set(out)


def brute_components(rows, k, percent=80):
    """Rows (id, size, smallest id reachable) by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [(key, len(s), least.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))]
