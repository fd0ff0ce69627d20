"""The edit lattice of a conversation and its cheapest edits.

A node is (rows consumed, state); states say what the output ends with: nothing
yet, the one system row, a user row, an assistant row.  Edges delete, keep or
rerole the next row or insert a row, and each has a cost and an initial.  A
conversation is legal when it ends in "nothing" or "assistant".

``cheapest`` is Dijkstra's search from both ends: a forward heap from the
entry, a reverse heap from the exits, always growing the nearer one.  It stops
when the two smallest distances together exceed the best crossing, so every
crossing of equal cost is finished: each cheapest path then is a settled
forward part followed by a settled reverse part.  Marking those nodes leaves
the graph of all cheapest paths, and since from one node each initial leads to
one node only, the smallest initial at every step spells the least audit.

Rows are given as a shape, two characters a row: the role's initial (``s``,
``u``, ``a``, or ``-``) and its fault (``b``lank, ``d``uplicate, ``t``runcated,
or ``.``).  ``entry`` and ``leave`` are the costs of getting to each state
before the first row and of finishing from each state after the last one, so a
long conversation can be solved piece by piece; inserts after the last row
belong to the next piece unless this is the last.
"""

from __future__ import annotations

import heapq

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FAR = 1 << 40  # no way
BEGIN = (0, FAR, FAR, FAR)
FINISH = (0, FAR, FAR, 0)


def next_role(state: int) -> int:
    """What an inserted or reroled row must be after ``state``."""
    return ASSISTANT if state == USER else USER


def _kept(initial: str, state: int) -> int | None:
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


def _steps(shape: str, layer: int, state: int, last: bool):
    """(initial, cost, next layer, next state) from a node, by initial."""
    n = len(shape) // 2
    if layer < n:
        initial, fault = shape[2 * layer], shape[2 * layer + 1]
        yield "D", DELETE, layer + 1, state
    if layer < n or last:
        yield "I", INSERT, layer, next_role(state)
    if layer < n and fault not in "bd":
        extra = TRUNCATED if fault == "t" else 0
        kept = _kept(initial, state)
        if kept is not None:
            yield "K", KEEP + extra, layer + 1, kept
        if kept is None or kept == SYSTEM:
            yield "R", REROLE + extra, layer + 1, next_role(state)


def _back_steps(shape: str, layer: int, state: int, last: bool):
    """(cost, previous layer, previous state) into a node."""
    n = len(shape) // 2
    for before in range(4):
        if layer < n or last:
            if next_role(before) == state:
                yield INSERT, layer, before
        if layer > 0:
            for initial, cost, _, to in _steps(shape, layer - 1, before, last):
                if initial != "I" and to == state:
                    yield cost, layer - 1, before


def reach(shape: str, state: int, last: bool) -> list[int]:
    """Cheapest costs from ``state`` before the first row to each state after the last."""
    best, heap, n = {(0, state): 0}, [(0, 0, state)], len(shape) // 2
    while heap:
        cost, layer, at = heapq.heappop(heap)
        if cost > best[layer, at]:
            continue
        for _, more, to_layer, to in _steps(shape, layer, at, last):
            if cost + more < best.get((to_layer, to), FAR):
                best[to_layer, to] = cost + more
                heapq.heappush(heap, (cost + more, to_layer, to))
    return [best.get((n, q), FAR) for q in range(4)]


def cheapest(shape: str, entry=BEGIN, leave=FINISH, last: bool = True) -> tuple[int, list]:
    """(cost, by entry state: (state after the last row, audit), or None where
    no cheapest path enters)."""
    n = len(shape) // 2
    ahead = {(0, q): c for q, c in enumerate(entry) if c < FAR}
    back = {(n, q): c for q, c in enumerate(leave) if c < FAR}
    forward = [(c, 0, q) for (_, q), c in ahead.items()]
    reverse = [(c, -n, q) for (_, q), c in back.items()]
    heapq.heapify(forward)
    heapq.heapify(reverse)
    seen_ahead, seen_back = set(), set()
    best = min((c + back[v] for v, c in ahead.items() if v in back), default=FAR)
    while forward and reverse and forward[0][0] + reverse[0][0] <= best:
        if forward[0][0] <= reverse[0][0]:
            cost, layer, q = heapq.heappop(forward)
            if (layer, q) in seen_ahead:
                continue
            seen_ahead.add((layer, q))
            for _, more, to_layer, to in _steps(shape, layer, q, last):
                v = (to_layer, to)
                if cost + more < ahead.get(v, FAR):
                    ahead[v] = cost + more
                    heapq.heappush(forward, (cost + more, to_layer, to))
                    best = min(best, cost + more + back.get(v, FAR))
        else:
            cost, layer, q = heapq.heappop(reverse)
            layer = -layer
            if (layer, q) in seen_back:
                continue
            seen_back.add((layer, q))
            for more, to_layer, to in _back_steps(shape, layer, q, last):
                v = (to_layer, to)
                if cost + more < back.get(v, FAR):
                    back[v] = cost + more
                    heapq.heappush(reverse, (cost + more, -to_layer, to))
                    best = min(best, cost + more + ahead.get(v, FAR))

    rest = {v: back[v] for v in seen_back}  # what is left to pay, on cheapest paths
    for v in sorted(seen_ahead, key=lambda v: (ahead[v], v[0]), reverse=True):
        if v not in rest and (ahead[v] + back.get(v, FAR) == best
                              or any(rest.get((layer, q), FAR) + more == best - ahead[v]
                                     for _, more, layer, q in _steps(shape, *v, last))):
            rest[v] = best - ahead[v]
    walks = []
    for q in range(4):
        at, audit = (0, q), []
        if entry[q] >= FAR or entry[q] + rest.get(at, FAR) != best:
            walks.append(None)
            continue
        while at[0] < n or rest[at] != leave[at[1]]:
            initial, at = next((i, (layer, s)) for i, more, layer, s in _steps(shape, *at, last)
                               if rest.get((layer, s), FAR) + more == rest[at])
            audit.append(initial)
        walks.append((at[1], "".join(audit)))
    return best, walks


def output(shape: str, audit: str, state: int = NOTHING) -> list[tuple[int, str | None]]:
    """The repaired rows: (row, or -1 for an inserted one; its new role, or None as it was)."""
    rows, at = [], 0
    for step in audit:
        if step in "IR":
            state = next_role(state)
            rows.append((-1 if step == "I" else at, "assistant" if state == ASSISTANT else "user"))
        elif step == "K":
            state = _kept(shape[2 * at], state)
            rows.append((at, None))
        at += step != "I"
    return rows
