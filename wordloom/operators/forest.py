"""The packed parse forest of one sentence, for use inside a task.

``row[i][cat]`` holds the ends of the spans of a category from word i as the
bits of an integer, ``col[j][cat]`` the starts of those that end before word
j.  Whether a rule covers a span is one ``and`` of two integers, and the set
bits are its split points, so back-pointers are read from the bits when they
are needed and never stored.  Rules with more than two symbols are split with
helper symbols that trees leave out.  Trees are taken one by one: a node
keeps a heap of its next candidates, each made of an edge and the ranks of
its parts' trees, so the k best cost about k more steps.
"""

from __future__ import annotations

import heapq
import sys


class Grammar:
    def __init__(self, rules: list, start: str):
        self.start = start
        self.unary: dict = {}   # part -> [(cost, order, whole)]
        self.binary: dict = {}  # first part -> [(second part, cost, order, whole)]
        self.up: dict = {}      # whole -> [(first part, second part or None, cost, order)]
        for order, (lhs, rhs, cost) in enumerate(rules):
            while len(rhs) > 2:
                rest = lhs if isinstance(lhs, tuple) else (lhs, order)
                rest = (*rest[:2], rhs[1:])
                self._add(lhs, rhs[0], rest, cost, order)
                lhs, rhs, cost = rest, rhs[1:], 0.0
            if rhs:
                self._add(lhs, rhs[0], rhs[1] if len(rhs) == 2 else None, cost, order)
        self._chains()

    def _add(self, whole, first, second, cost, order):
        self.up.setdefault(whole, []).append((first, second, cost, order))
        if second is None:
            self.unary.setdefault(first, []).append(whole)
        else:
            self.binary.setdefault(first, []).append((second, whole))

    def _chains(self):
        """Order of the symbols by their one-symbol rules; a cycle has none."""
        self.level, done = {}, set()
        for symbol in [*self.unary]:
            stack = [(symbol, iter(self.unary.get(symbol, ())))]
            path = {symbol}
            while stack:
                node, more = stack[-1]
                nxt = next(more, None)
                if nxt is None:
                    stack.pop()
                    path.discard(node)
                    done.add(node)
                    self.level[node] = 1 + max((self.level.get(x, 0) for x in self.unary.get(node, ())), default=0)
                elif nxt in path:
                    raise ValueError("unary cycle in grammar")
                elif nxt not in done:
                    path.add(nxt)
                    stack.append((nxt, iter(self.unary.get(nxt, ()))))

    def parse(self, words: list, k: int) -> tuple[int, list[str]]:
        """Number of parses and the first k trees of [(word, categories)]."""
        forest = Forest(self, words)
        n = forest.count()
        return n, forest.trees(min(k, n))


class Forest:
    def __init__(self, grammar: Grammar, words: list):
        self.grammar, self.words, n = grammar, words, len(words)
        self.row, self.col = [{} for _ in range(n + 1)], [{} for _ in range(n + 1)]
        self._best: dict = {}
        for size in range(1, n + 1):
            for i in range(n - size + 1):
                j = i + size
                found = set(words[i][1]) if size == 1 else set()
                if size > 1:
                    ends = self.col[j]
                    for first, bits in self.row[i].items():
                        for second, whole in grammar.binary.get(first, ()):
                            if whole not in found and bits & ends.get(second, 0):
                                found.add(whole)
                stack = list(found)
                while stack:
                    for whole in grammar.unary.get(stack.pop(), ()):
                        if whole not in found:
                            found.add(whole)
                            stack.append(whole)
                for cat in found:
                    self.row[i][cat] = self.row[i].get(cat, 0) | 1 << j
                    self.col[j][cat] = self.col[j].get(cat, 0) | 1 << i

    def edges(self, i: int, j: int, cat) -> list:
        """(cost, parts) of a node, in order: parts are nodes, or the word."""
        out = []
        for first, second, cost, order in self.grammar.up.get(cat, ()):
            if second is None:
                if self.row[i].get(first, 0) >> j & 1:
                    out.append((j - i, order, cost, ((i, j, first),)))
                continue
            bits = self.row[i].get(first, 0) & self.col[j].get(second, 0)
            while bits:
                at = bits.bit_length() - 1
                bits ^= 1 << at
                out.append((at - i, order, cost, ((i, at, first), (at, j, second))))
        out.sort(key=lambda e: (len(e[3]) == 1, -e[0], e[1]))
        found = [(cost, parts) for _, _, cost, parts in out]
        if j == i + 1 and cat in self.words[i][1]:
            found.append((0.0, (self.words[i][0],)))
        return found

    def _nodes(self) -> list:
        """The nodes below the root, parts before wholes, with their edges."""
        n, root = len(self.words), (0, len(self.words), self.grammar.start)
        if not n or not self.row[0].get(self.grammar.start, 0) >> n & 1:
            return []
        seen, stack = {}, [root]
        while stack:
            node = stack.pop()
            if node not in seen:
                seen[node] = self.edges(*node)
                stack += [p for _, parts in seen[node] for p in parts if not isinstance(p, str)]
        self._edges = seen
        return sorted(seen, key=lambda x: (x[1] - x[0], -self.grammar.level.get(x[2], 0)))

    def count(self) -> int:
        number: dict = {}
        self.order = self._nodes()
        for node in self.order:
            total = 0
            for _, parts in self._edges[node]:
                ways = 1
                for p in parts:
                    ways *= 1 if isinstance(p, str) else number[p]
                total += ways
            number[node] = total
        n = number[self.order[-1]] if self.order else 0
        if n >= 1 << 63:
            raise OverflowError("a sentence has more parses than 64 bits hold")
        return n

    def _tree(self, node, rank: int):
        """(cost, edge, ranks) of a node's tree of this rank; None beyond the last."""
        state = self._best.get(node)
        if state is None:
            heap, seen = [], set()
            for e, (cost, parts) in enumerate(self._edges[node]):
                ranks = (0,) * len(parts)
                heap.append((cost + sum(self._cost(p, 0) for p in parts), e, ranks))
                seen.add((e, ranks))
            heapq.heapify(heap)
            state = self._best[node] = ([], heap, seen)
        taken, heap, seen = state
        while len(taken) <= rank and heap:
            cost, e, ranks = heapq.heappop(heap)
            taken.append((cost, e, ranks))
            own, parts = self._edges[node][e]
            for x in range(len(parts)):
                more = (*ranks[:x], ranks[x] + 1, *ranks[x + 1:])
                if (e, more) not in seen and not isinstance(parts[x], str) and self._tree(parts[x], more[x]) is not None:
                    seen.add((e, more))
                    heapq.heappush(heap, (own + sum(self._cost(p, r) for p, r in zip(parts, more)), e, more))
        return taken[rank] if rank < len(taken) else None

    def _cost(self, part, rank: int) -> float:
        return 0.0 if isinstance(part, str) else self._tree(part, rank)[0]

    def _text(self, node, rank: int) -> str:
        _, e, ranks = self._tree(node, rank)
        inner = " ".join(p if isinstance(p, str) else self._text(p, r) for p, r in zip(self._edges[node][e][1], ranks))
        return inner if isinstance(node[2], tuple) else f"({node[2]} {inner})"

    def trees(self, k: int) -> list[str]:
        if not k:
            return []
        limit = sys.getrecursionlimit()
        sys.setrecursionlimit(max(limit, 1000 + 20 * len(self.order)))
        try:
            for node in self.order:  # parts first, so that costs are known without deep recursion
                self._tree(node, 0)
            root = (0, len(self.words), self.grammar.start)
            return [self._text(root, r) for r in range(k)]
        finally:
            sys.setrecursionlimit(limit)
