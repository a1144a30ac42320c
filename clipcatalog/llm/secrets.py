"""Secret scan with one combined deterministic automaton.

The patterns of all rules become one non-deterministic automaton; subset construction
gives a deterministic one over byte classes, partition refinement makes it minimal, and
the result is a transition array.  One pass over the bytes of a text drives all rules at
once: at each byte the state names the rules of which a match may end here.  A run of such
ends is one match; its start comes from a small automaton for the reversed pattern of the
rule, run backwards from the first end.  Matches of one rule are leftmost and do not
overlap; matches that fail the length test are dropped but still use up their bytes.
Behind the marker of a private key, ``key_end`` follows the key's lines; prose stays.
The automata are made once, on the driver, and go to the tasks as arrays.

Patterns match bytes, letters of ``(?i)`` patterns in either ASCII case.  Spans count
code points, end exclusive.  Null texts are empty, texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcatalog.llm.common import record_batch, slices


@dataclass(frozen=True)
class Rule:
    """A match needs ``least`` bytes, in all or (``value``) from the first possible end on.

    ``key`` marks the rule whose matches go on with the lines of a private key.
    """

    kind: str
    pattern: bytes
    least: int
    value: bool = False
    key: bool = False


BASE = (
    Rule("assign", rb"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 12, True),
    Rule("access", rb"AKIA[A-Z0-9]+", 18),
    Rule("hex", rb"[0-9a-f]{16,}", 16),
)
MORE = (
    Rule("hub", rb"gh[opsu]_[A-Za-z0-9]+", 40),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", 20, key=True),
)
RULES = BASE + MORE


KEY_PART = re.compile(
    rb"(?:[\x20\t\r\n]|\\[nrt])*+"  # also line ends written out
    rb"(?:(?P<head>(?:Proc-Type|DEK-Info):\x20?[A-Za-z0-9,-]*+)|(?P<body>[A-Za-z0-9+/=]++)"
    rb"|(?P<mark>-++(?:(?P<turn>END|BEGIN)[A-Z\x20]*+-*+)?))")


def key_end(data: bytes, at: int, least: int = 16) -> int:
    """End of the key whose marker ends at ``at``: headers, base64 lines and the END line.

    A run of ``least`` base64 signs belongs to the key while no shorter one came before it;
    shorter ones do when the END line, or the next key, follows.
    """
    end, short = at, False
    while part := KEY_PART.match(data, at):
        at = part.end()
        if part["body"]:
            short = short or len(part["body"]) < least
        elif part["mark"] and not part["turn"]:
            return at if at == len(data) and not short else end  # the text ends within a line of dashes
        if part["turn"] or not short:
            end, short = at, False
        if part["turn"] == b"END":
            break
    return end


ANY_BYTE = frozenset(range(256))
CLASS_PART = re.compile(rb"\\x([0-9A-Fa-f]{2})|\\([^a-zA-Z0-9])|([^\\\]])", re.S)


def parsed(pattern: bytes) -> list:
    """The parts of a pattern: byte sets, ``("or", branches)`` and ``("many", low, high, part)``.

    Signs, ``\\xNN``, classes, groups, ``|`` and ``* + ? {n} {n,}``; ``(?i)`` at the start.
    """
    fold = pattern.startswith(b"(?i)")
    at = 4 if fold else 0

    def one(byte: re.Match) -> int:
        return int(byte[1], 16) if byte[1] else (byte[2] or byte[3])[0]

    def byte_set(found: set[int]) -> frozenset[int]:
        if fold:
            found |= {b ^ 32 for b in found if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(found)

    def part():
        nonlocal at
        sign = pattern[at : at + 1]
        if sign == b"(":
            at += 1
            inner = branches()
            at += 1
            return inner
        if sign == b"[":
            at += 1
            negative, found = pattern[at : at + 1] == b"^", set()
            at += negative
            while pattern[at : at + 1] != b"]":
                low = CLASS_PART.match(pattern, at)
                at = low.end()
                high = low
                if pattern[at : at + 1] == b"-" and pattern[at + 1 : at + 2] != b"]":
                    high = CLASS_PART.match(pattern, at + 1)
                    at = high.end()
                found.update(range(one(low), one(high) + 1))
            at += 1
            found = byte_set(found)
            return ANY_BYTE - found if negative else found
        byte = CLASS_PART.match(pattern, at)
        if not byte or sign in b"*+?{^$.":
            raise ValueError(f"pattern part {pattern[at:]!r} is not supported")
        at = byte.end()
        return byte_set({one(byte)})

    def branches():
        nonlocal at
        out = [[]]
        while at < len(pattern) and pattern[at : at + 1] != b")":
            if pattern[at : at + 1] == b"|":
                at += 1
                out.append([])
                continue
            own = part()
            times = re.compile(rb"([*+?])|\{(\d+)(,?)\}").match(pattern, at)
            if times:
                at = times.end()
                low = {b"*": 0, b"+": 1, b"?": 0}[times[1]] if times[1] else int(times[2])
                own = "many", low, 1 if times[1] == b"?" else low if times[2] and not times[3] else None, own
            out[-1].append(own)
        return "or", out

    tree = branches()
    if at < len(pattern):
        raise ValueError(f"pattern part {pattern[at:]!r} is not supported")
    return [tree]


class _Nfa:
    """Empty moves and byte-set moves; built from the parts of a pattern."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def node(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, parts: list, at: int, back: bool) -> int:
        """Append ``parts`` behind node ``at`` (in reverse when ``back``); returns the last node."""
        for own in reversed(parts) if back else parts:
            if isinstance(own, frozenset):
                to = self.node()
                self.moves[at].append((own, to))
                at = to
            elif own[0] == "or":
                end = self.node()
                for branch in own[1]:
                    self.empty[self.add(branch, at, back)].append(end)
                at = end
            else:
                _, low, high, inner = own
                for _ in range(low):
                    at = self.add([inner], at, back)
                loop = self.node()  # any number more, or one more where ``high`` says so
                self.empty[at].append(loop)
                if high is None:
                    self.empty[self.add([inner], loop, back)].append(loop)
                    at = loop
                elif high > low:
                    end = self.node()
                    self.empty[loop].append(end)
                    self.empty[self.add([inner], loop, back)].append(end)
                    at = end
        return at

    def closure(self, nodes: Iterable[int]) -> frozenset[int]:
        seen, todo = set(), list(nodes)
        while todo:
            if (n := todo.pop()) not in seen:
                seen.add(n)
                todo += self.empty[n]
        return frozenset(seen)


def automaton(patterns: list[bytes], back: bool = False, anywhere: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Minimal automaton: ``moves[state, byte]`` and ``ends[state]``, bit k set where pattern k may end.

    State 0 is the start.  ``anywhere`` lets a match begin at every byte.
    """
    nfa, accept = _Nfa(), {}
    start = nfa.node()
    for k, pattern in enumerate(patterns):
        first = nfa.node()
        nfa.empty[start].append(first)
        accept[nfa.add(parsed(pattern), first, back)] = 1 << k
    sets = {s for moves in nfa.moves for s, _ in moves}
    signature: dict[tuple, int] = {}
    group = [signature.setdefault(tuple(b in s for s in sets), len(signature)) for b in range(256)]
    sample = {g: b for b, g in reversed(list(enumerate(group)))}

    first = nfa.closure([start])
    numbers, rows, todo = {first: 0}, [], [first]
    for state in todo:
        row = []
        for g in range(len(signature)):
            reached = {to for n in state for s, to in nfa.moves[n] if sample[g] in s}
            to = nfa.closure(reached | ({start} if anywhere else set()))
            if to not in numbers:
                numbers[to] = len(todo)
                todo.append(to)
            row.append(numbers[to])
        rows.append(row)
    moves = np.array(rows)
    ends = np.array([sum({accept.get(n, 0) for n in s}) for s in todo])

    block = np.unique(ends, return_inverse=True)[1]  # refine until no two states of a block differ in a move
    while True:
        finer = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    order = np.unique(block, return_index=True)[1]
    renumber = np.argsort(np.argsort(order))[block]  # blocks in order of their first state, so 0 stays the start
    order = np.sort(order)
    return renumber[moves[order]][:, group].astype(np.int32), ends[order]


@lru_cache(maxsize=4)
def automata(rules: tuple[Rule, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The automaton of all rules, then the reversed one of each."""
    return [automaton([r.pattern for r in rules]), *(automaton([r.pattern], back=True, anywhere=False) for r in rules)]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES, arrays: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.rules = rules
        self.states, *self.back = (_linked(*own) for own in arrays or automata(rules))

    def ends(self, data: bytes) -> dict[int, list[list[int]]]:
        """Per rule the runs ``[first, last]`` of bytes at which a match may end."""
        state, runs = self.states, {}
        for i, byte in enumerate(data):
            state = state[byte]
            if state[256]:
                for k in state[257]:
                    found = runs.setdefault(k, [])
                    if found and found[-1][1] == i - 1:
                        found[-1][1] = i
                    else:
                        found.append([i, i])
        return runs

    def begin(self, k: int, data: bytes, last: int, low: int) -> int:
        """Smallest start, ``low`` at least, of a match of rule ``k`` that ends at byte ``last``."""
        state, found = self.back[k], last
        for i in range(last, low - 1, -1):
            state = state[data[i]]
            if state[258]:
                break
            if state[256]:
                found = i
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) of all matches, in that order, as byte offsets."""
        out = []
        for k, runs in self.ends(data).items():
            rule, cursor, todo = self.rules[k], 0, [(a, b, 0) for a, b in reversed(runs)]
            while todo:
                first, last, low = todo.pop()
                begin = self.begin(k, data, first, low)
                if begin < cursor:  # the head lies in the match before: look once more behind that match
                    again = self.ends(data[cursor : last + 1]).get(k, [])
                    todo += [(a + cursor, b + cursor, cursor) for a, b in again if b + cursor == last]
                    continue
                cursor = last + 1
                if last + 1 - (first if rule.value else begin) >= rule.least:
                    out.append((begin, k, key_end(data, last + 1) if rule.key else last + 1))
        return sorted(out)


def _linked(moves: np.ndarray, ends: np.ndarray) -> list:
    """The transition array as rows that hold the next row at each byte: one look-up per byte.

    Entry 256 tells whether a match may end here, 257 which, 258 whether the state is dead.
    """
    rows = [[None] * 259 for _ in ends]
    for s, row in enumerate(rows):
        row[:256] = [rows[t] for t in moves[s]]
        row[256] = bool(ends[s])
        row[257] = [k for k in range(int(ends[s]).bit_length()) if ends[s] >> k & 1]
        row[258] = not ends[s] and bool((moves[s] == s).all())
    return rows[0]


_scanners: dict[tuple[Rule, ...], Scanner] = {}


def scanner(rules: tuple[Rule, ...], arrays=None) -> Scanner:
    """The scanner of this process; a task hands it the broadcast ``arrays``."""
    if rules not in _scanners:
        _scanners[rules] = Scanner(rules, arrays.value if arrays else None)
    return _scanners[rules]


def text_spans(text: str | None, rules: tuple[Rule, ...] = RULES, arrays=None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then in order of the rules."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    found = scanner(rules, arrays).spans(data)
    if found and len(data) != len(text):
        heads = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        point = lambda at: int(heads[at - 1]) if at else 0
        found = [(point(a), k, point(b)) for a, k, b in found]
    return [(rules[k].kind, a, b) for a, k, b in found]


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, found array<struct<kind, start, end>>``, a row per input row."""
    schema = pa.schema([("doc_id", pa.int64()), ("found", SPANS)])
    arrays = docs.sparkSession.sparkContext.broadcast(automata(rules))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in text_spans(body, rules, arrays)]
                for body in batch.column(1).to_pylist()
            ]
            yield record_batch(schema, doc_id=batch.column(0).to_pylist(), found=found)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, found array<struct<kind:string,start:long,end:long>>")


def masked(text: str | None, rules: tuple[Rule, ...] = RULES, arrays=None) -> str | None:
    """The text with every found span (overlapping ones as one) replaced by ``[secret]``."""
    if not text:
        return text
    out, at = [], 0
    for _, start, end in text_spans(text, rules, arrays):
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The same rows and columns with the secrets of ``text`` masked."""
    arrays = docs.sparkSession.sparkContext.broadcast(automata(rules))

    @F.pandas_udf("string")
    def mask(texts):
        return texts.map(lambda body: masked(body, rules, arrays) if isinstance(body, str) else None)

    return docs.withColumn(text, mask(F.col(text).cast("string")))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the checksum of the base spans and all spans as text."""
    line = "transform({}, s -> concat(s.kind, ':', s.start, ':', s.end))"
    base = "filter(found, s -> s.kind in ('assign', 'access', 'hex'))"
    count = "cast(size(filter(found, s -> s.kind = '{0}')) as bigint) as n_{0}"
    return found.selectExpr(
        "doc_id", *(count.format(k) for k in ("assign", "access", "hex")),
        f"sha2(array_join({line.format(base)}, ','), 256) as base_sha256",
        f"array_join({line.format('found')}, ',') as spans",
    )
