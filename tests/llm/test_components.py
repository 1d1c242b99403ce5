import random

from tidemark.llm.components import components


def brute(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is None or b is None or a == b:
            continue
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_same_as_union_find(rows):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(1900, 2100)]
    links += [(5, 5), (None, 3), (-4, -9), (-9, -4), (-9, -4)]
    out = components(rows("u long, v long", links)).collect()
    assert len(out) == len({r.node for r in out})
    assert {r.node: r.component for r in out} == brute(links)
    assert components(rows("u long, v long", [])).collect() == []
