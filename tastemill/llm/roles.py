"""Generalised LR repair of role sequences: the grammar, its stacks, and the cheapest edits.

The roles of a conversation, by initials, have to form ``(s?(ua)+)?``:

    C -> empty | P | s P        P -> P u a | u a

Stacks share their tails: a stack is (state, symbols below as another stack), so that many stacks form one graph.
At every row each stack may keep, rerole or delete it, after inserting symbols; stacks with equal tops are
merged into the one with the smallest (cost, audit). What may follow depends on the top alone, so nothing is lost.

Two audits at the same row are never prefixes of each other (both end with an edit of that row and count
the same rows), so their order is settled by their ranks and never changes by what is appended.
"""

from __future__ import annotations

from functools import cache

#: LR(0) table of the grammar: shifts, and what a state reduces (symbols popped); the goto after a reduction.
SHIFT = {(0, "s"): 2, (0, "u"): 3, (1, "u"): 4, (2, "u"): 3, (3, "a"): 6, (4, "a"): 7, (5, "u"): 4}
REDUCE = {6: 2, 7: 3}
GOTO = {0: 1, 2: 5}
ACCEPT = (0, 1, 5)

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
FULL = {"u": "user", "a": "assistant"}

Stack = tuple  # (state, Stack below or None)
START: Stack = (0, None)


def push(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a shift and the reductions it allows; None where the grammar has no such symbol."""
    state = SHIFT.get((stack[0], symbol))
    if state is None:
        return None
    stack = (state, stack)
    if state in REDUCE:
        for _ in range(REDUCE[state]):
            stack = stack[1]
        stack = (GOTO[stack[0]], stack)
    return stack


@cache
def inserted(stack: Stack) -> tuple[tuple[Stack, str], ...]:
    """Stacks after inserting nothing, one or two roles, with the roles; more would come back to a top passed before."""
    out, last = [(stack, "")], [(stack, "")]
    for _ in range(2):
        last = [(after, done + symbol) for s, done in last for symbol in "ua" if (after := push(s, symbol))]
        out += last
    return tuple(out)


@cache
def moves(stack: Stack, initial: str, fault: str) -> tuple[tuple[Stack, int, str], ...]:
    """(stack, cost, edits) of every way over one row; faults are '', 't' (truncated), 'b' or 'd' (to be deleted)."""
    out = [(stack, DELETE_COST, DELETE)]
    if fault not in ("b", "d"):
        extra = TRUNCATED_COST if fault == "t" else 0
        for s, roles in inserted(stack):
            cost, edits = extra + INSERT_COST * len(roles), INSERT * len(roles)
            if after := push(s, initial):
                out.append((after, cost, edits + KEEP))
            for symbol in "ua":
                if after := push(s, symbol):
                    out.append((after, cost + REROLE_COST, edits + REROLE))
    return tuple(out)


def paths(rows: list[tuple[str, str]], start: Stack = START) -> dict[Stack, tuple[int, str]]:
    """Cheapest (cost, audit) to each stack top after all ``rows`` of (initial, fault)."""
    # One entry per top, in the order of audits: (stack, cost, trail); a trail links edits backwards.
    front: list = [(start, 0, None)]
    for initial, fault in rows:
        best: dict[int, tuple] = {}
        for rank, (stack, cost, _) in enumerate(front):
            for after, price, edits in moves(stack, initial, fault):
                found = (cost + price, rank, edits, after)
                if after[0] not in best or found[:3] < best[after[0]][:3]:
                    best[after[0]] = found
        merged = sorted(best.values(), key=lambda x: x[1:3])
        front = [(after, cost, (edits, front[rank][2])) for cost, rank, edits, after in merged]
    out = {}
    for stack, cost, trail in front:
        parts = []
        while trail:
            parts.append(trail[0])
            trail = trail[1]
        out[stack] = (cost, "".join(reversed(parts)))
    return out


def merge(found: list[tuple[Stack, int, str]]) -> dict[Stack, tuple[int, str]]:
    """One stack for each top: that with the smallest (cost, audit)."""
    best: dict[int, tuple] = {}
    for stack, cost, audit in found:
        if stack[0] not in best or (cost, audit) < best[stack[0]][1:]:
            best[stack[0]] = (stack, cost, audit)
    return {s: (c, a) for s, c, a in best.values()}


def finish(front: dict[Stack, tuple[int, str]]) -> tuple[int, str]:
    """The cheapest way from any of the stacks to a whole conversation."""
    return min(
        (cost + INSERT_COST * len(roles), audit + INSERT * len(roles))
        for stack, (cost, audit) in front.items()
        for after, roles in inserted(stack)
        if after[0] in ACCEPT
    )


class Replay:
    """Repaired ``role:text`` lines of rows under an audit; the audit and the rows settle every role."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.before = audit, 0, ""

    def _next(self) -> str:
        self.before = "a" if self.before == "u" else "u"
        return FULL[self.before]

    def _inserted(self) -> list[str]:
        out = []
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            out.append(f"{self._next()}:")
            self.at += 1
        return out

    def row(self, role: str, text: str) -> list[str]:
        out = self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            self.before = role[:1]
            out.append(f"{role}:{text}")
        elif edit == REROLE:
            out.append(f"{self._next()}:{text}")
        return out

    def rest(self) -> list[str]:
        return self._inserted()
