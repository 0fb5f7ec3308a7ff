"""Helpers of the tests that are no fixtures."""


def groups_of(items, linked):
    """Group number of each item, by linking every pair that ``linked`` names."""
    parent = {i: i for i in items}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(items):
        for b in items[k + 1:]:
            if linked(a, b):
                parent[root(b)] = root(a)
    return {i: root(i) for i in items}
