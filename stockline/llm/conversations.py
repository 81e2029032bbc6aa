"""Repair the structure of conversations by their cheapest edits.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``: an optional system turn, then user and
assistant in turn. Edits, by their initials: Keep a row (0), Rerole it to user or assistant (3), Delete it (4, and the
only choice for blank and repeated rows), Insert a turn without text (3). A row that ends without ``.!?`` and is not
deleted adds 3. Of the cheapest edits the string of initials that is least in ASCII wins.

Nodes of the edit lattice are (rows read, state of the pattern). Dijkstra's search runs from both ends with a heap
each; after the searches meet it goes on until no crossing of equal cost can be missing, and takes the least
concatenated string of initials. The edits' initials determine the path, and of two equally dear paths to a node neither
string begins with the other, so the least string to a node is always part of the least string through it.

Rows are range-partitioned by conversation and turn, so a conversation with a third of all rows is spread over tasks. A
conversation that lies in one task and has at most 512 rows and 4 MB is finished there. Any other is cut into
segments of that size: each segment finds its least edits between every two states, a pass from the last segment to the first picks
the states between segments by cost and then by the rank of the segment's strings, and a pass forward joins edits
and digests. Both passes read one conversation's segments in order and keep a few numbers, so memory is bounded; only
the digest, which is sequential by definition, reads the texts of a conversation in one task.

Nulls: a null role or text is read as one space (no role of the pattern; blank), null turns come first, rows without a
conversation form one. Rows of one turn are ordered by the digest of role and text. Empty tables give no
rows; a conversation without rows gives zeros, no edits and the digest of nothing. Other columns are not read, whatever
their names. The audit of a conversation must fit a column value (2 GB).
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stockline.llm.common import small_batches, stored

SEGMENT_ROWS, SEGMENT_BYTES = 512, 4 << 20
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3  # costs
START, SYSTEM, USER, ASSISTANT = STATES = range(4)  # what was read last
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
THEN = {state: {"user": USER, "assistant": ASSISTANT}[role] for state, role in WANTED.items()}
FROM = {state: [s for s in STATES if THEN[s] == state] for state in STATES}
READ = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = ("su", "ua", "au")
#: Least edits after the last row, by state.
TAIL = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
SPACE = " \t\n\x0b\x0c\r"

#: A row as the lattice sees it: initial of the role, whether it must go, what it costs if it stays.
Fact = tuple[str, bool, int]


def least_edits(facts: list[Fact], start: int, ends: dict[int, tuple[int, str]]) -> tuple[int, str] | None:
    """Cost and initials of the least edits from ``start`` to any of ``ends``, their own cost and initials included.

    Nothing is inserted after the last row: ``ends`` holds that. None if no end can be reached.
    """
    last = len(facts)
    labels = ({(0, start): (0, "")}, {(last, state): label for state, label in ends.items()})
    heaps = ([(0, 0, start)], [(cost, -last, state) for state, (cost, _) in ends.items()])
    heapq.heapify(heaps[1])
    settled: tuple[set, set] = (set(), set())
    best = min(((0 + cost, text) for state, (cost, text) in ends.items() if last == 0 and state == start), default=None)

    def steps(side: int, at: int, state: int) -> Iterator[tuple[int, int, int, str]]:
        if side == 0:
            if at == last:
                return
            initial, gone, extra = facts[at]
            yield at, THEN[state], INSERT, "I"
            yield at + 1, state, DELETE, "D"
            if not gone:
                yield at + 1, THEN[state], REROLE + extra, "R"
                if (state, initial) in READ:
                    yield at + 1, READ[state, initial], extra, "K"
            return
        if at < last:
            for before in FROM[state]:
                yield at, before, INSERT, "I"
        if at == 0:
            return
        initial, gone, extra = facts[at - 1]
        yield at - 1, state, DELETE, "D"
        if not gone:
            for before in FROM[state]:
                yield at - 1, before, REROLE + extra, "R"
            for before in STATES:
                if READ.get((before, initial)) == state:
                    yield at - 1, before, extra, "K"

    while heaps[0] and heaps[1]:
        if best is not None and heaps[0][0][0] + heaps[1][0][0] > best[0]:
            break  # every crossing that costs as little as the best is known
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, place, state = heapq.heappop(heaps[side])
        at = place if side == 0 else -place
        if (at, state) in settled[side] or labels[side][at, state][0] < cost:
            continue
        settled[side].add((at, state))
        text = labels[side][at, state][1]
        for to, then, price, initial in steps(side, at, state):
            label = (cost + price, text + initial if side == 0 else initial + text)
            known = labels[side].get((to, then))
            if known is not None and known <= label:
                continue
            labels[side][to, then] = label
            if known is None or known[0] > label[0]:
                heapq.heappush(heaps[side], (label[0], to if side == 0 else -to, then))
            other = labels[1 - side].get((to, then))
            if other is not None:
                crossing = (label[0] + other[0], label[1] + other[1] if side == 0 else other[1] + label[1])
                best = crossing if best is None else min(best, crossing)
    return best


def fault(text: str, repeated: bool) -> str:
    """The first fault of a row: blank, duplicate, truncated, or none."""
    seen = text.strip(SPACE)
    if not seen:
        return "blank"
    if repeated:
        return "duplicate"
    return "truncated" if seen[-1] not in ".!?" else ""


def fact(role: str, found: str) -> Fact:
    return role[:1], found in ("blank", "duplicate"), CUT_OFF if found == "truncated" else 0


class Repair:
    """One conversation read from its first row to its last: counts, edits and the digest of what is left."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.state, self.cost, self.audit = conv_id, START, 0, []
        self.count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.first = self.turn = None
        self.turns, self.before = 0, None
        self.digest, self.empty = hashlib.sha256(), True

    def _say(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def read(self, rows: list[dict], faults: list[str], cost: int, audit: str) -> None:
        for row, found in zip(rows, faults):
            initial = row["role"][:1]
            if found:
                self.count[found] += 1
            self.count["illegal"] += self.before is not None and self.before + initial not in LEGAL
            self.before = initial
            if row["turn"] is not None:
                self.turns += row["turn"] != self.turn
                self.turn, self.first = row["turn"], row["turn"] if self.first is None else self.first
        self.cost += cost
        self.audit.append(audit)
        left = iter(rows)
        for edit in audit:
            row = None if edit == "I" else next(left)
            if edit == "D":
                continue
            role = row["role"] if edit == "K" else WANTED[self.state]
            self._say(role, row["text"] if row else "")
            self.state = READ[self.state, role[:1]] if edit == "K" else THEN[self.state]

    def result(self) -> dict:
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return {"conv_id": self.conv_id, "gaps": gaps, **self.count, "cost": self.cost, "audit": "".join(self.audit),
                "repaired_sha256": self.digest.hexdigest()}


def repair(conv_id, rows: list[dict]) -> dict:
    """A whole conversation; rows hold turn, role, text and the digest of role and text, by turn."""
    seen, faults = set(), []
    for row in rows:
        faults.append(fault(row["text"], row["digest"] in seen))
        seen.add(row["digest"])
    cost, audit = least_edits([fact(r["role"], f) for r, f in zip(rows, faults)], START, TAIL)
    done = Repair(conv_id)
    done.read(rows, faults, cost, audit)
    return done.result()


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROW = "array<struct<turn: long, role: string, text: string, digest: string>>"
_CUT = f"{RESULT}, segment long, rows {_ROW}"
_ARROW_RESULT = pa.schema([
    pa.field(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64())
    for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")])
_ARROW_ROW = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("digest", pa.string())]))
_ARROW_CUT = pa.schema([*_ARROW_RESULT, ("segment", pa.int64()), ("rows", _ARROW_ROW)])


def _rows(batches) -> Iterator[dict]:
    for batch in small_batches(batches, 1 << 20):
        yield from batch.to_pylist()


def _packed(rows: Iterable[dict], schema: pa.Schema, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``most`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 300 + sum(len(r["text"]) for r in row.get("rows") or ())
        if size >= most:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _cut(batches) -> Iterator[pa.RecordBatch]:
    """Finished conversations, and segments of those that are long or may go on in another task."""
    from pyspark import TaskContext

    def found() -> Iterator[dict]:
        segment = TaskContext.get().partitionId() << 32
        current, rows, size, split = None, [], 0, True  # the first one may have begun in another task
        for row in _rows(batches):
            if current is None or current[0] != row["conv_id"]:
                if current is not None:
                    if split:
                        yield {"conv_id": current[0], "segment": segment, "rows": rows}
                        segment += 1
                    else:
                        yield repair(current[0], rows)
                    split = False
                current, rows, size = (row["conv_id"],), [], 0
            if not row["kept"]:
                continue
            if len(rows) == SEGMENT_ROWS or size + len(row["text"]) > SEGMENT_BYTES and rows:
                yield {"conv_id": current[0], "segment": segment, "rows": rows}
                segment, rows, size, split = segment + 1, [], 0, True
            rows.append({k: row[k] for k in ("turn", "role", "text", "digest")})
            size += len(row["text"])
        if current is not None:
            yield {"conv_id": current[0], "segment": segment, "rows": rows}

    yield from _packed(found(), _ARROW_CUT)


def _faults(row: dict) -> list[str]:
    first = set(row["firsts"] or ())
    return [fault(r["text"], at not in first) for at, r in enumerate(row["rows"])]


_ARROW_PATHS = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
_ARROW_CHOICES = pa.schema([("segment", pa.int64()), ("choices", pa.list_(pa.int32()))])


def _paths(batches) -> Iterator[pa.RecordBatch]:
    """Least edits of each segment from every state to every state."""
    def found() -> Iterator[dict]:
        for row in _rows(batches):
            facts = [fact(r["role"], f) for r, f in zip(row["rows"], _faults(row))]
            ways = [least_edits(facts, s, {t: (0, "")}) or (None, None) for s in STATES for t in STATES]
            yield {"conv_id": row["conv_id"], "segment": row["segment"], "costs": [c for c, _ in ways], "audits": [a for _, a in ways]}

    yield from _packed(found(), _ARROW_PATHS)


def _choose(batches) -> Iterator[pa.RecordBatch]:
    """From each conversation's last segment to its first: the state to leave a segment in, for every state to enter it in."""
    def found() -> Iterator[dict]:
        current, rest = None, {}
        for row in _rows(batches):
            if current is None or current[0] != row["conv_id"]:
                current, rest = (row["conv_id"],), {s: TAIL[s][0] for s in STATES}
            ways = [[(row["costs"][4 * s + t] + rest[t], row["ranks"][4 * s + t], t) for t in STATES if row["costs"][4 * s + t] is not None]
                    for s in STATES]
            chosen = [min(way) for way in ways]
            rest = {s: chosen[s][0] for s in STATES}
            yield {"segment": row["segment"], "choices": [t for _, _, t in chosen]}

    yield from _packed(found(), _ARROW_CHOICES)


def _joined(batches) -> Iterator[pa.RecordBatch]:
    """From each conversation's first segment to its last: its result."""
    def found() -> Iterator[dict]:
        done = None
        for row in _rows(batches):
            if done is None or done.conv_id != row["conv_id"]:
                if done is not None:
                    done.read([], [], *TAIL[done.state])
                    yield done.result()
                done = Repair(row["conv_id"])
            way = 4 * done.state + row["choices"][done.state]
            done.read(row["rows"], _faults(row), row["costs"][way], row["audits"][way])
        if done is not None:
            done.read([], [], *TAIL[done.state])
            yield done.result()

    yield from _packed(found(), _ARROW_RESULT)


def repair_conversations(turns: DataFrame) -> DataFrame:
    """Counts of faults, cost, edits and digest of each conversation of ``(conv_id, turn, role, text, kept)``.

    Rows that are not ``kept`` only tell that the conversation exists.
    """
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    sorted_rows = (turns.withColumns({"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))})
                   .withColumns({"digest": digest, "at": F.monotonically_increasing_id()})
                   .repartitionByRange("conv_id", "turn", "digest", "at").sortWithinPartitions("conv_id", "turn", "digest", "at"))
    cut = stored(sorted_rows.select("conv_id", "turn", "role", "text", "digest", "kept").mapInArrow(_cut, _CUT), "conversations")
    done = cut.filter("segment IS NULL").select(_ARROW_RESULT.names)
    parts = cut.filter("segment IS NOT NULL").select("conv_id", "segment", "rows")
    firsts = (parts.select("conv_id", "segment", F.posexplode("rows.digest").alias("at", "digest"))
              .groupBy("conv_id", "digest").agg(F.min(F.struct("segment", "at")).alias("first"))
              .groupBy(F.col("first.segment").alias("segment")).agg(F.collect_list("first.at").alias("firsts")))
    known = stored(parts.join(firsts, "segment", "left"), "segments")
    paths = stored(known.mapInArrow(_paths, "conv_id long, segment long, costs array<long>, audits array<string>"), "paths")
    ranks = F.transform("audits", lambda a: F.array_position(F.array_sort(F.array_compact("audits")), F.coalesce(a, F.lit(""))))
    choices = (paths.select("conv_id", "segment", "costs", ranks.alias("ranks")).repartition("conv_id")
               .sortWithinPartitions("conv_id", F.desc("segment")).mapInArrow(_choose, "segment long, choices array<int>"))
    ready = known.join(paths.select("segment", "costs", "audits"), "segment").join(choices, "segment")
    rest = ready.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(_joined, RESULT)
    return done.unionByName(rest)


def damaged(conversations: DataFrame, code: Column) -> DataFrame:
    """Turns after damage by code: 0 drops one, 1 empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes it the user's."""
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(code == 4, "user").otherwise(F.col("role"))
    copies = F.sequence(F.lit(1), F.when(code == 3, 2).otherwise(1))
    return conversations.select(
        F.col("conv_id"), F.col("turn"), role.alias("role"), text.alias("text"), (code != 0).alias("kept"),
        F.explode(copies).alias("copy")).drop("copy")
