"""Shared by the tests of this folder."""


def groups(n, edges):
    """The connected sets of 0..n-1, sorted."""
    parent = list(range(n))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for a, b in edges:
        a, b = top(int(a)), top(int(b))
        parent[max(a, b)] = min(a, b)
    sets = {}
    for i in range(n):
        sets.setdefault(top(i), []).append(i)
    return sorted(sets.values())
