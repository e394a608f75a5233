"""The cheapest edits that give a conversation a well-formed order of roles.

A conversation is a text of one sign per turn: who speaks (system, user, assistant, anyone else)
and what is wrong with the turn. Its lattice has a node per number of turns read and state of the
wanted order `(s?(ua)+)?`, and an edge per edit. Two Dijkstra searches run over it, one from each
end. They stop once their two least open distances together exceed the best path found, so that
every shortest path consists of nodes one search settled and then nodes the other settled; of
these paths the one whose edits read least is taken.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heappop, heappush
from typing import NamedTuple

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
SPEAKERS = "sua"  # any other first letter counts as the fourth speaker

# States of the wanted order: nothing yet, after the system turn, after user, after assistant.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = STATES = range(4)
ACCEPTED = (START, AFTER_ASSISTANT)
# The speaker that may come next by edit, and where that leads.
WANTED = ("u", "u", "a", "u")
NEXT = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
STEPS = {("s", START): AFTER_SYSTEM} | {(WANTED[q], q): NEXT[q] for q in STATES}
# Inserts that end a well-formed order from a state.
ENDING = ("", INSERT * 2, INSERT, "")


def sign(role: str, fault: int) -> str:
    """One turn as a letter: 16 of them, speaker by fault."""
    speaker = SPEAKERS.find(role[:1]) if role else -1
    return chr(65 + 4 * (speaker % 4) + fault)


def speaker_of(letter: str) -> str:
    return "suax"[(ord(letter) - 65) // 4]


def fault_of(letter: str) -> int:
    return (ord(letter) - 65) % 4


def _edits(letter: str, state: int) -> list[tuple[str, int, int]]:
    """What may be done with a turn in a state: edit, state after it, cost."""
    done = [(DELETE, state, DELETE_COST)]
    fault = fault_of(letter)
    if fault in (BLANK, DUPLICATE):
        return done
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    kept = STEPS.get((speaker_of(letter), state))
    if kept is not None:
        done.append((KEEP, kept, extra))
    return [*done, (REROLE, NEXT[state], REROLE_COST + extra)]


_LETTERS = [chr(65 + n) for n in range(16)]
# Edits of a turn by letter and state, in the order of their initials; and the same backwards.
ONWARD = {x: [_edits(x, q) for q in STATES] for x in _LETTERS}
BACKWARD = {
    x: [[(e, p, c) for p in STATES for e, to, c in ONWARD[x][p] if to == q] for q in STATES]
    for x in _LETTERS
}
INSERTED_FROM = [[p for p in STATES if NEXT[p] == q] for q in STATES]


class Edits(NamedTuple):
    cost: int
    audit: str


def cheapest(letters: str, start: int, ends: tuple[int, ...], inserts_last: bool) -> Edits | None:
    """The cheapest edits of `letters` from one state to any of `ends`, least initials first.

    Without `inserts_last` no insert follows the last turn. None where there is no way.
    """
    count = len(letters)
    ahead = _Search({start: 0})
    behind = _Search({count * 4 + q: 0 for q in ends})
    best = min((0 for q in ends if not count and q == start), default=None)

    def onward(node: int):
        at, state = divmod(node, 4)
        if at < count or inserts_last:
            yield INSERT, at * 4 + NEXT[state], INSERT_COST
        if at < count:
            for edit, to, cost in ONWARD[letters[at]][state]:
                yield edit, at * 4 + 4 + to, cost

    def backward(node: int):
        at, state = divmod(node, 4)
        if at < count or inserts_last:
            for before in INSERTED_FROM[state]:
                yield INSERT, at * 4 + before, INSERT_COST
        if at:
            for edit, before, cost in BACKWARD[letters[at - 1]][state]:
                yield edit, at * 4 - 4 + before, cost

    while ahead.heap and behind.heap:
        if best is not None and ahead.least() + behind.least() > best:
            break
        near, far, edges = (
            (ahead, behind, onward) if ahead.least() <= behind.least() else (behind, ahead, backward)
        )
        node = near.settle()
        if node is None:
            continue
        here = near.distance[node]
        for _, to, cost in edges(node):
            near.offer(to, here + cost)
            there = far.distance.get(to)
            if there is not None and (best is None or here + cost + there < best):
                best = here + cost + there
    if best is None:
        return None
    return Edits(best, _least_audit(start, best, ahead, behind, onward, backward))


class _Search:
    """One direction: distances so far, an open heap, and the nodes whose distance is final."""

    def __init__(self, sources: dict[int, int]):
        self.sources = frozenset(sources)
        self.distance = dict(sources)
        self.heap = sorted((d, node) for node, d in sources.items())
        self.settled: set[int] = set()

    def least(self) -> int:
        return self.heap[0][0]

    def offer(self, node: int, distance: int) -> None:
        known = self.distance.get(node)
        if known is None or distance < known:
            self.distance[node] = distance
            heappush(self.heap, (distance, node))

    def settle(self) -> int | None:
        distance, node = heappop(self.heap)
        if node in self.settled or distance > self.distance[node]:
            return None
        self.settled.add(node)
        return node

    def final(self, node: int) -> int | None:
        known = node in self.settled or node in self.sources
        return self.distance[node] if known else None


def _least_audit(start: int, best: int, ahead: _Search, behind: _Search, onward, backward) -> str:
    """The least initials of any path of length `best`, walked from the start.

    Where the searches cross, every crossing of that length counts; from there the nodes that lead
    to one are found backwards among those settled from the start.
    """
    leads = {
        node
        for node in ahead.settled
        if (node in behind.sources and ahead.distance[node] == best)
        or any(
            behind.final(to) == best - ahead.distance[node] - cost
            for _, to, cost in onward(node)
        )
    }
    open_nodes = list(leads)
    while open_nodes:
        node = open_nodes.pop()
        for _, before, cost in backward(node):
            if (
                before in ahead.settled
                and before not in leads
                and ahead.distance[before] + cost == ahead.distance[node]
            ):
                leads.add(before)
                open_nodes.append(before)

    audit, node, spent = [], start, 0
    while spent < best or node not in behind.sources:
        edit, node, cost = min(
            (edit, to, cost)
            for edit, to, cost in onward(node)
            if behind.final(to) == best - spent - cost
            or (to in leads and ahead.distance[to] == spent + cost)
        )
        audit.append(edit)
        spent += cost
    return "".join(audit)


class Repair(NamedTuple):
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    cost: int
    audit: str


def counts(letters: str) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated turns, and neighbours whose speakers may not follow."""
    faults = [fault_of(x) for x in letters]
    speakers = [speaker_of(x) for x in letters]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(speakers, speakers[1:]))
    return faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal


@lru_cache(maxsize=20_000)
def repair(letters: str) -> Repair:
    """All that follows from the signs of a conversation."""
    return Repair(*counts(letters), *cheapest(letters, START, ACCEPTED, True))


def stretch(letters: str) -> list[list[Edits | None]]:
    """The cheapest edits of a stretch of a conversation from each state to each."""
    return [[cheapest(letters, p, (q,), False) for q in STATES] for p in STATES]


def joined(stretches: list[list[list[Edits | None]]]) -> Edits:
    """The cheapest edits of a conversation given stretch by stretch, in order.

    No stretch ends in an insert, so of two audits of one stretch neither begins the other, and
    the lesser stays the lesser whatever follows.
    """
    rest = [Edits(len(ENDING[q]) * INSERT_COST, ENDING[q]) for q in STATES]
    tails: list[list[tuple[int, str] | None]] = []
    costs = [e.cost for e in rest]
    for ways in reversed(stretches):
        chosen = []
        for from_state in STATES:
            options = [
                (found.cost + costs[q], found.audit, q)
                for q, found in enumerate(ways[from_state])
                if found is not None
            ]
            chosen.append(min(options))
        tails.append([(q, audit) for _, audit, q in chosen])
        costs = [cost for cost, _, _ in chosen]
    state, audit = START, []
    for chosen in reversed(tails):
        state, some = chosen[state]
        audit.append(some)
    return Edits(costs[START], "".join(audit) + ENDING[state])
