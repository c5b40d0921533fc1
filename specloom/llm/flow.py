"""Maximum flow and minimum-cost flow on graphs of at most some thousand arcs (membership patterns and sources)."""

from __future__ import annotations

import heapq
from collections import deque

EPS = 1e-7


class Network:
    """Arcs with capacity and cost; arc i's reverse is i ^ 1."""

    def __init__(self, nodes: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[float] = []
        self.cost: list[float] = []

    def arc(self, a: int, b: int, capacity: float, cost: float = 0.0) -> int:
        for start, end, room, price in ((a, b, capacity, cost), (b, a, 0.0, -cost)):
            self.out[start].append(len(self.to))
            self.to.append(end)
            self.room.append(room)
            self.cost.append(price)
        return len(self.to) - 2

    def flow_on(self, arc: int) -> float:
        return self.room[arc ^ 1]

    def max_flow(self, source: int, sink: int) -> float:
        """By levels and blocking flows."""
        total = 0.0
        while True:
            level = {source: 0}
            queue = deque([source])
            while queue:
                a = queue.popleft()
                for i in self.out[a]:
                    if self.room[i] > EPS and self.to[i] not in level:
                        level[self.to[i]] = level[a] + 1
                        queue.append(self.to[i])
            if sink not in level:
                return total
            place = [0] * len(self.out)
            while sent := self._block(source, sink, level, place):
                total += sent

    def _block(self, source: int, sink: int, level: dict[int, int], place: list[int]) -> float:
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                sent = min(self.room[i] for i in path)
                for i in path:
                    self.room[i] -= sent
                    self.room[i ^ 1] += sent
                return sent
            while place[a] < len(self.out[a]):
                i = self.out[a][place[a]]
                if self.room[i] > EPS and level.get(self.to[i]) == level[a] + 1:
                    break
                place[a] += 1
            else:
                if a == source:
                    return 0.0
                i = path.pop()
                a = self.to[i ^ 1]
                place[a] += 1
                continue
            path.append(i)
            a = self.to[i]

    def min_cost_flow(self, source: int, sink: int) -> float:
        """Maximum flow of least cost, by cheapest augmenting paths with potentials; costs must not be negative."""
        potential = [0.0] * len(self.out)
        total = 0.0
        while True:
            best = [float("inf")] * len(self.out)
            best[source] = 0.0
            via = [-1] * len(self.out)
            heap = [(0.0, source)]
            while heap:
                d, a = heapq.heappop(heap)
                if d > best[a] + 1e-12:
                    continue
                for i in self.out[a]:
                    if self.room[i] > EPS:
                        b = self.to[i]
                        length = d + self.cost[i] + potential[a] - potential[b]
                        if length < best[b] - 1e-12:
                            best[b], via[b] = length, i
                            heapq.heappush(heap, (length, b))
            if best[sink] == float("inf"):
                return total
            potential = [p + min(d, best[sink]) for p, d in zip(potential, best)]
            sent, b = float("inf"), sink
            while b != source:
                sent = min(sent, self.room[via[b]])
                b = self.to[via[b] ^ 1]
            b = sink
            while b != source:
                self.room[via[b]] -= sent
                self.room[via[b] ^ 1] += sent
                b = self.to[via[b] ^ 1]
            total += sent
