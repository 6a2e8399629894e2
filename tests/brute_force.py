"""Plain Python graph measures for small graphs."""

from __future__ import annotations

from collections import defaultdict, deque


def outgoing(edges, topic):
    found = defaultdict(list)
    for s, t, c in edges:
        if c == topic:
            found[s].append(t)
    return found


def shortest(out, source):
    distance, count, order, before = {source: 0}, {source: 1.0}, [], defaultdict(list)
    queue = deque([source])
    while queue:
        v = queue.popleft()
        order.append(v)
        for w in out[v]:
            if w not in distance:
                distance[w] = distance[v] + 1
                count[w] = 0.0
                queue.append(w)
            if distance[w] == distance[v] + 1:
                count[w] += count[v]
                before[w].append(v)
    return distance, count, order, before


def closeness(edges, topic, nodes, direction="in"):
    out = outgoing(edges, topic)
    total, reached = defaultdict(int), defaultdict(int)
    for u in nodes:
        for v, d in shortest(out, u)[0].items():
            if d:
                end = v if direction == "in" else u
                total[end] += d
                reached[end] += 1
    return {v: reached[v] / total[v] if total[v] else 0.0 for v in nodes}


def betweenness(edges, topic, nodes, sources=None):
    out = outgoing(edges, topic)
    score = dict.fromkeys(nodes, 0.0)
    for s in nodes if sources is None else sources:
        _, count, order, before = shortest(out, s)
        gain = defaultdict(float)
        for w in reversed(order):
            for v in before[w]:
                gain[v] += count[v] / count[w] * (1 + gain[w])
            if w != s:
                score[w] += gain[w]
    return score


def pagerank(edges, topic, nodes, rounds=100, damping=0.85):
    out = outgoing(edges, topic)
    rank = dict.fromkeys(nodes, 1 - damping)
    for _ in range(rounds):
        fresh = dict.fromkeys(nodes, 1 - damping)
        for u in nodes:
            for v in out[u]:
                fresh[v] += damping * rank[u] / len(out[u])
        rank = fresh
    return rank
