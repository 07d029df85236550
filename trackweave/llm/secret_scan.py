"""Secret scan with one combined deterministic automaton.

Every rule is a regular expression over bytes.  It becomes a nondeterministic automaton, then by subset
construction a scanning automaton whose state is the list of live attempts in order of their start
(leftmost wins; once an attempt has matched, younger ones are dropped).  The rules' automata run side by
side as one product, which is minimised by partition refinement and stored as one transition array; a
text is read once, byte by byte, for all rules.  Where a rule starts to match, a small reversed automaton
of that rule walks back to the leftmost start.

The tables are built on the driver (a few thousand states, whatever the data) and travel with the task;
texts are scanned in place, partition by partition, with no shuffle.

Spans count code points, end exclusive.  Per rule they are leftmost, longest and non-overlapping.  Rules
must be such that a match, once begun, can only go on or end (checked when compiled): then its end is
where the scan leaves the accepting states, and nothing is read twice.

Defined cases: a null text is empty and has no spans; a null id is returned as null; repeated rows give
repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from re import _parser as regex_tree

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, table


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  Matches whose group `group` is shorter than `least` bytes are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False


#: The rules whose spans are always reported, in the order in which kinds sort.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # runs of hex digits are maximal, so asking for 24 in the expression equals dropping shorter runs later
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Rules that the method adds.
MORE_RULES = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("pem", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----", 0, 20),
)


class _Nfa:
    """Thompson's construction from the expression's parse tree; `backwards` builds the reversed language."""

    def __init__(self, rule: Rule, backwards: bool = False):
        self.edges: list[tuple[frozenset[int], int] | None] = []
        self.empty: list[list[int]] = []
        self.any_case, self.backwards = rule.any_case, backwards
        self.start = self._state()
        self.final = self._sequence(regex_tree.parse(rule.pattern.encode()), self.start)

    def _state(self) -> int:
        self.edges.append(None)
        self.empty.append([])
        return len(self.edges) - 1

    def _sequence(self, items, at: int) -> int:
        for op, arg in reversed(list(items)) if self.backwards else items:
            at = self._item(str(op), arg, at)
        return at

    def _item(self, op: str, arg, at: int) -> int:
        if op in ("LITERAL", "IN"):
            to = self._state()
            self.edges[at] = (self._bytes(op, arg), to)
            after = self._state()
            self.empty[to].append(after)
            return after
        if op == "SUBPATTERN":
            return self._sequence(arg[3], at)
        if op == "BRANCH":
            end = self._state()
            for branch in arg[1]:
                begin = self._state()
                self.empty[at].append(begin)
                self.empty[self._sequence(branch, begin)].append(end)
            return end
        if op == "MAX_REPEAT":
            least, most, sub = arg
            for _ in range(least):
                at = self._sequence(sub, at)
            if most is regex_tree.MAXREPEAT:
                loop, end = self._state(), self._state()
                self.empty[at].append(loop)
                begin = self._state()
                self.empty[loop] += [begin, end]
                self.empty[self._sequence(sub, begin)].append(loop)
                return end
            ends = [at]
            for _ in range(most - least):
                begin = self._state()
                self.empty[at].append(begin)
                at = self._sequence(sub, begin)
                ends.append(at)
            end = self._state()
            for x in ends:
                self.empty[x].append(end)
            return end
        raise ValueError(f"{op} is not supported in a rule")

    def _bytes(self, op: str, arg) -> frozenset[int]:
        found: set[int] = set()
        for kind, value in [(op, arg)] if op == "LITERAL" else [(str(k), v) for k, v in arg]:
            if kind == "LITERAL":
                found.add(value)
            elif kind == "RANGE":
                found.update(range(value[0], value[1] + 1))
            else:
                raise ValueError(f"{kind} is not supported in a set")
        if self.any_case:
            found |= {ord(chr(b).swapcase()) for b in found if b < 128 and chr(b).isalpha()}
        return frozenset(found)

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(x for x in seen if self.edges[x] or x == self.final)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure({e[1] for x in states if (e := self.edges[x]) and byte in e[0]})


class _Scanner:
    """The scanning automaton of one rule; a state is a tuple of attempts, eldest first."""

    def __init__(self, rule: Rule):
        self.nfa = _Nfa(rule)
        self.fresh = self.nfa.closure({self.nfa.start})
        if self.nfa.final in self.fresh:
            raise ValueError(f"{rule.pattern} matches the empty string")
        self.kind, self.known = rule.kind, {}

    def accepts(self, state: tuple) -> bool:
        return bool(state) and self.nfa.final in state[0]

    def step(self, state: tuple, byte: int) -> tuple:
        key = (state, byte)
        if key not in self.known:
            self.known[key] = self._step(state, byte)
        return self.known[key]

    def _step(self, state: tuple, byte: int) -> tuple:
        if self.accepts(state):
            if on := self.nfa.step(state[0], byte):
                if self.nfa.final not in on:
                    raise ValueError(f"{self.kind}: a match must only go on or end")
                return (on,)
            state, ended = (), True
        else:
            ended = False
        seen: set[int] = set()
        out: list[frozenset[int]] = []
        for attempt in (*state, self.fresh):
            if left := frozenset(self.nfa.step(attempt, byte) - seen):
                seen |= left
                out.append(left)
                if self.nfa.final in left:
                    if len(out) > 1 or ended:
                        raise ValueError(f"{self.kind}: a younger attempt matches first, or one begins where another ends")
                    break
        return tuple(out)


@dataclass
class Automaton:
    """The combined, minimised tables; plain arrays, so that they travel to the tasks."""

    rules: tuple[Rule, ...]
    classes: bytes  # byte -> class
    width: int
    moves: list[int]  # state * width + class -> next state * width
    masks: list[int]  # state -> bit per rule that is in a match
    first: int  # states * width from here on accept for some rule
    back: list[tuple[list[int], list[bool]]] = field(default_factory=list)  # per rule: reversed moves by state * 256 + byte (-1: none), accepting


def compile_rules(rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> Automaton:
    scanners = [_Scanner(r) for r in rules]
    sets = {e[0] for s in scanners for e in s.nfa.edges if e}
    signature = {b: tuple(b in x for x in sorted(sets, key=sorted)) for b in range(256)}
    ids = {sig: i for i, sig in enumerate(dict.fromkeys(signature.values()))}
    classes = bytes(ids[signature[b]] for b in range(256))
    sample = [classes.index(bytes([c])) for c in range(len(ids))]
    start = tuple(() for _ in scanners)
    number, order, rows = {start: 0}, [start], []
    for state in order:  # grows while it is read
        row = []
        for b in sample:
            to = tuple(s.step(x, b) for s, x in zip(scanners, state, strict=True))
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        rows.append(row)
    moves = np.array(rows)
    masks = np.array([sum(s.accepts(x) << i for i, (s, x) in enumerate(zip(scanners, state, strict=True))) for state in order])
    block = np.unique(masks, return_inverse=True)[1]
    while True:  # states stay together while they lead to the same blocks
        split = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)[1].ravel()
        if split.max() == block.max():
            break
        block = split
    _, pick = np.unique(block, return_index=True)
    rank = sorted(range(len(pick)), key=lambda k: (masks[pick[k]] > 0, k != block[0]))  # the start first, accepting states last
    place = np.empty(len(pick), int)
    place[rank] = np.arange(len(pick))
    small = place[block[moves[pick[rank]]]]
    width = len(ids)
    found = masks[pick[rank]]
    return Automaton(rules, classes, width, (small * width).ravel().tolist(), found.tolist(), int((found == 0).sum()) * width, [_reverse(r) for r in rules])


def _reverse(rule: Rule) -> tuple[list[int], list[bool]]:
    nfa = _Nfa(rule, backwards=True)
    start = nfa.closure({nfa.start})
    number, order, moves = {start: 0}, [start], []
    for state in order:
        for b in range(256):
            to = nfa.step(state, b)
            if not to:
                moves.append(-1)
                continue
            if to not in number:
                number[to] = len(order)
                order.append(to)
            moves.append(number[to])
    return moves, [nfa.final in x for x in order]


def scan(data: bytes, auto: Automaton) -> list[tuple[int, int, int]]:
    """(start, end, rule number) in bytes, sorted; matches that are too short are dropped."""
    moves, first, width, masks = auto.moves, auto.first, auto.width, auto.masks
    state, live, begun, floor, out = 0, 0, {}, [0] * len(auto.rules), []

    def end(mask: int, at: int) -> None:
        for r, rule in enumerate(auto.rules):
            if mask >> r & 1:
                start, floor[r] = begun[r], at
                size = at - start
                if rule.group:
                    found = re.fullmatch(rule.pattern.encode(), data[start:at], re.IGNORECASE if rule.any_case else 0)
                    size = len(found[rule.group])
                if size >= rule.least:
                    out.append((start, at, r))

    for i, c in enumerate(data.translate(auto.classes)):
        state = moves[state + c]
        if state >= first or live:
            mask = masks[state // width]
            if mask != live:
                end(live & ~mask, i)
                for r in range(len(auto.rules)):
                    if mask >> r & 1 and not live >> r & 1:
                        begun[r] = _leftmost(data, i, floor[r], auto.back[r])
                live = mask
    end(live, len(data))
    return sorted(out)


def _leftmost(data: bytes, last: int, floor: int, back: tuple[list[int], list[bool]]) -> int:
    moves, accepting = back
    state, best = 0, last
    for i in range(last, floor - 1, -1):
        state = moves[state * 256 + data[i]]
        if state < 0:
            break
        if accepting[state]:
            best = i
    return best


def find_secrets(text: str, auto: Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then by the rules' order."""
    data = text.encode()
    found = scan(data, auto)
    if not found or len(data) == len(text):
        return [(auto.rules[r].kind, a, b) for a, b, r in found]
    begins = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])  # code points begun before each byte
    return [(auto.rules[r].kind, int(begins[a]), int(begins[b])) for a, b, r in found]


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_documents(docs: DataFrame, more_rules: tuple[Rule, ...] = MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, and all spans as kind:start:end."""
    auto = compile_rules(BASE_RULES + more_rules)
    base = [r.kind for r in BASE_RULES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                found = find_secrets(text, auto)
                own = [x for x in found if x[0] in base]
                listed = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
                rows.append((*(sum(x[0] == k for x in own) for k in base), hashlib.sha256(listed.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for k, a, b in found)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return documents(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents"))
