"""Repair the structure of conversations: generalised LR parsing with weighted repairs.

A conversation is right when its role initials form ``(s?(ua)+)?``. The grammar of GRAMMAR is
compiled to shift-reduce tables once. A conversation's rows are parsed in order of turn while
each row may be kept (0), given the role user or assistant (1) or deleted (2), and an empty user
or assistant turn may be inserted anywhere (5). Blank and repeated rows can only be deleted; a
truncated row that stays costs 5 more.

The parser follows all repairs at once in a graph-structured stack: a node is a table state above
another node, equal nodes are one object, and tops that meet in one node keep the smallest
``(cost, audit)``, the audit being the initials of the edits so far. That is exact: what can
follow depends on the node alone. Audits are not carried along: after each row every top has as many
letters of rows, and none is a prefix of another, so their order is that of ``(rank of the audit
before, letters added)``, and the chosen one is read back from two bytes per top and row.

Parsing needs no texts: JVM expressions find the faults, and rows of (id, turn, role, digest,
fault) are shuffled by conversation and sorted, which spills; a worker holds a few bytes a row of
the conversation at hand. The texts move once, in :func:`repaired`, in the same order behind their
conversation's audit, and stream through.

Nulls: a null role or text is one space, null turns come first, rows without a conversation id are
one conversation with a null id. Ties of turn are ordered by role and SHA-256 of the text; equal rows
are repeated rows. Empty texts are blank. Length is not limited. An empty table gives no
conversations. Other columns stay behind, so their names cannot clash.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm import text as T

#: Conversation, pairs, one pair; terminals are role initials.
GRAMMAR = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "T"), ("P", "PT"), ("T", "ua"))
RETAG, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
END = "$"
#: Stacks the grammar may have; a list grammar that recurses on the left has a handful.
STACKS = 64
BLANK, REPEATED, CUT_OFF = 1, 2, 3

PLAN = (
    "conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, roles string"
)


class Tables:
    """Shift-reduce tables of a grammar (SLR); a cell may hold several actions."""

    def __init__(self, grammar: tuple[tuple[str, str], ...]):
        self.rules = (("", grammar[0][0]), *grammar)
        self.heads = {head for head, _ in grammar}
        follow = self._follow()
        items = self._closure({(0, 0)})
        states, self.shifts, self.reduces = [items], [], []
        for at in count():
            if at == len(states):
                break
            self.shifts.append({})
            self.reduces.append({})
            ahead = {self.rules[r][1][d] for r, d in states[at] if d < len(self.rules[r][1])}
            for symbol in sorted(ahead):
                step = {(r, d + 1) for r, d in states[at] if self.rules[r][1][d : d + 1] == symbol}
                target = self._closure(step)
                if target not in states:
                    states.append(target)
                self.shifts[at][symbol] = states.index(target)
            for r, d in states[at]:
                if d == len(self.rules[r][1]):
                    for symbol in follow[self.rules[r][0]]:
                        self.reduces[at].setdefault(symbol, []).append(r)

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        todo, found = list(items), set(items)
        while todo:
            rule, dot = todo.pop()
            symbol = self.rules[rule][1][dot : dot + 1]
            for new in ((r, 0) for r, (head, _) in enumerate(self.rules) if symbol and head == symbol):
                if new not in found:
                    found.add(new)
                    todo.append(new)
        return frozenset(found)

    def _first(self, symbol: str) -> set[str]:
        """First terminals of a symbol; only the start symbol may be empty."""
        seen, todo, out = set(), [symbol], set()
        while todo:
            s = todo.pop()
            if s in seen:
                continue
            seen.add(s)
            if s not in self.heads:
                out.add(s)
            todo += [body[0] for head, body in self.rules if head == s and body]
        return out

    def _follow(self) -> dict[str, set[str]]:
        follow = {head: set() for head in self.heads | {""}}
        follow[""].add(END)
        changed = True
        while changed:
            before = sum(map(len, follow.values()))
            for head, body in self.rules:
                for symbol, after in zip(body, [*body[1:], None]):
                    if symbol in self.heads:
                        follow[symbol] |= follow[head] if after is None else self._first(after)
            changed = sum(map(len, follow.values())) > before
        return follow


class Stacks:
    """The graph-structured stack: nodes are ``(state, number of the node below)``."""

    def __init__(self, grammar: tuple[tuple[str, str], ...] = GRAMMAR):
        self.tables = Tables(grammar)
        self.nodes: list[tuple[int, int]] = [(0, -1)]
        self.numbers = {(0, -1): 0}
        # Every stack that the terminals can build, so that a node's number fits a byte.
        terminals = sorted({c for _, body in grammar for c in body} - self.tables.heads)
        self.steps: list[dict[str, list[int]]] = []
        for node in count():
            if node == len(self.nodes):
                break
            self.steps.append({t: self._after(node, t) for t in terminals})
            if len(self.nodes) > STACKS:
                raise ValueError("the grammar has unbounded stacks")
        self.accepts = [self._accepts(n) for n in range(len(self.nodes))]
        self.segments = ["I" * k + edit for k in range(len(self.nodes) + 1) for edit in ("D", "K", "R", "")]
        self.segment_number = {s: i for i, s in enumerate(self.segments)}
        # By node: the inserts that reach others, cheapest first.
        self.inserts = [[(t, n) for t in ROLES for n in steps.get(t, ())] for steps in self.steps]

    def _push(self, state: int, below: int) -> int:
        if (state, below) not in self.numbers:
            self.numbers[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.numbers[state, below]

    def _reductions(self, node: int, ahead: str) -> Iterator[int]:
        """The node and all that reductions under the next symbol make of it."""
        todo, seen = [node], set()
        while todo:
            top = todo.pop()
            if top in seen:
                continue
            seen.add(top)
            yield top
            for rule in self.tables.reduces[self.nodes[top][0]].get(ahead, ()):
                head, body = self.tables.rules[rule]
                if not head:
                    continue
                below = top
                for _ in body:
                    below = self.nodes[below][1]
                todo.append(self._push(self.tables.shifts[self.nodes[below][0]][head], below))

    def _after(self, node: int, terminal: str) -> list[int]:
        tops = list(self._reductions(node, terminal))
        shifted = ((self.tables.shifts[self.nodes[t][0]].get(terminal), t) for t in tops)
        return [self._push(state, t) for state, t in shifted if state is not None]

    def _accepts(self, node: int) -> bool:
        return any(0 in self.tables.reduces[self.nodes[t][0]].get(END, ()) for t in self._reductions(node, END))


@functools.lru_cache(maxsize=1)
def _stacks() -> Stacks:
    return Stacks()


class Repair:
    """One conversation: rows go in by turn, ``finish`` gives cost, audit and roles.

    ``tops`` maps nodes to ``(cost, rank)``; ``trail`` holds per row and node the node before and
    the letters added, two bytes each.
    """

    def __init__(self):
        self.stacks = _stacks()
        self.width = 2 * len(self.stacks.nodes)
        self.tops: dict[int, tuple[int, int]] = {0: (0, 0)}
        self.trail = bytearray()

    def _with_inserts(self) -> dict[int, tuple[int, int, str, int]]:
        """Node to ``(cost, rank, letters, node before)`` after any number of inserts."""
        best = {node: (cost, rank, "", node) for node, (cost, rank) in self.tops.items()}
        todo = list(best)
        while todo:
            cost, rank, letters, origin = best[node := todo.pop()]
            for _, after in self.stacks.inserts[node]:
                found = (cost + INSERT, rank, letters + "I", origin)
                if after not in best or found < best[after]:
                    best[after] = found
                    todo.append(after)
        return best

    def row(self, initial: str, fault: int) -> None:
        reached: dict[int, tuple[int, int, str, int]] = {}

        def offer(node: int, found: tuple[int, int, str, int]) -> None:
            if node not in reached or found < reached[node]:
                reached[node] = found

        late = TRUNCATED if fault == CUT_OFF else 0
        for node, (cost, rank, letters, origin) in self._with_inserts().items():
            offer(node, (cost + DELETE, rank, letters + "D", origin))
            if fault in (BLANK, REPEATED):
                continue
            steps = self.stacks.steps[node]
            for after in steps.get(initial, ()):
                offer(after, (cost + late, rank, letters + "K", origin))
            for role in ROLES:
                for after in steps.get(role, ()):
                    offer(after, (cost + RETAG + late, rank, letters + "R", origin))
        ranks = {key: i for i, key in enumerate(sorted({(rank, letters) for _, rank, letters, _ in reached.values()}))}
        step = bytearray(self.width)
        for node, (_, _, letters, origin) in reached.items():
            step[2 * node], step[2 * node + 1] = origin, self.stacks.segment_number[letters]
        self.trail += step
        self.tops = {node: (cost, ranks[rank, letters]) for node, (cost, rank, letters, _) in reached.items()}

    def finish(self) -> tuple[int, str, str]:
        ended = {n: v for n, v in self._with_inserts().items() if self.stacks.accepts[n]}
        node = min(ended, key=ended.get)
        cost, _, letters, origin = ended[node]
        parts = [(letters, origin, node)]
        for at in range(len(self.trail) - self.width, -1, -self.width):
            node = origin
            origin, letters = self.trail[at + 2 * node], self.stacks.segments[self.trail[at + 2 * node + 1]]
            parts.append((letters, origin, node))
        parts.reverse()
        return cost, "".join(p[0] for p in parts), "".join(self._roles(*p) for p in parts)

    def _roles(self, letters: str, origin: int, target: int) -> str:
        """The initials that lead from one node to the other by these edits, '-' for a deletion."""
        paths = [(origin, "")]
        for letter in letters:
            if letter == "D":
                paths = [(node, done + "-") for node, done in paths]
                continue
            may = ROLES if letter in "IR" else self.stacks.steps[0].keys()
            paths = [(n, done + t) for node, done in paths for t in may for n in self.stacks.steps[node].get(t, ())]
        return next(done for node, done in paths if node == target)


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``conv_id, turn, initial, fault, here`` in order to one row per conversation."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "roles"]
    types = [None, *[pa.int64()] * 6, pa.string(), pa.string()]
    legal = {"su", "ua", "au"}
    done: list[tuple] = []
    state = None

    def close() -> None:
        conv, repair, faults, turns, illegal = state[0], *state[1:5]
        first, last, distinct = turns
        gaps = 0 if first is None else last - first + 1 - distinct
        done.append((conv, gaps, faults[BLANK], faults[REPEATED], faults[CUT_OFF], illegal, *repair.finish()))

    def out(kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [()] * len(names)
        arrays = [pa.array(c, t or kind) for c, t in zip(columns, types)]
        done.clear()
        return pa.RecordBatch.from_arrays(arrays, names=names)

    kind = pa.int64()
    for batch in batches:
        kind = batch.column(0).type
        for conv, turn, initial, fault, here in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or state[0] != conv:
                if state is not None:
                    close()
                state = [conv, Repair(), [0, 0, 0, 0], (None, None, 0), 0, None]
            if not here:
                continue
            _, repair, faults, (first, last, distinct), illegal, before = state
            repair.row(initial, fault)
            faults[fault] += 1
            if turn is not None:
                state[3] = (turn if first is None else first, turn, distinct + (turn != last))
            state[4] = illegal + (before is not None and before + initial not in legal)
            state[5] = initial
        yield out(kind)
    if state is not None:
        close()
        yield out(kind)


def _rows(conversations: DataFrame, *more: str) -> DataFrame:
    """The columns the operator reads, nulls replaced, with the fault-finding ones."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = conversations.select("conv_id", "turn", blank("role"), blank("text"), *more)
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _order(*first: str) -> list[Column]:
    return [*map(F.col, first), F.asc_nulls_first("turn"), F.col("role"), F.col("digest")]


def plan(conversations: DataFrame, here: str | None = None) -> DataFrame:
    """One row per conversation: faults, and the cheapest repair as ``cost``, ``audit`` and
    ``roles`` (initials after repair, ``-`` for a deleted row; one letter per edit).

    ``here`` names a boolean column: rows where it is false are gone, but keep their
    conversation in the result.
    """
    T.ship(conversations.sparkSession)
    rows = _rows(conversations.withColumn("_here", F.col(here) if here else F.lit(True)), "_here")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    light = rows.select(
        "conv_id", "turn", "role", "digest", "_here",
        (last == "").alias("_blank"), (~last.isin(".", "!", "?")).alias("_cut"),
    )
    # The window and the parse need the same partitioning, so rows move once.
    same = Window.partitionBy("conv_id", "role", "digest", "_here").orderBy(F.asc_nulls_first("turn"))
    fault = (
        F.when(F.col("_blank"), BLANK).when(F.col("_nth") > 1, REPEATED).when(F.col("_cut"), CUT_OFF).otherwise(0)
    )
    ordered = (
        light.repartition("conv_id")
        .withColumn("_nth", F.row_number().over(same))
        .sortWithinPartitions(*_order("conv_id"), "_nth")
        .select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "_here")
    )
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(_plan, PLAN.format(kind=kind))


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``conv_id, role, text, audit, roles``, the audit first, to repaired turns."""
    letters = roles = ""
    at = place = 0
    done: list[tuple] = []
    kind, conv = pa.int64(), None

    def inserted() -> None:
        nonlocal at, place
        while letters[at : at + 1] == "I":
            done.append((conv, place, "I", ROLES[roles[at]], ""))
            at, place = at + 1, place + 1

    def out() -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [()] * 5
        types = (kind, pa.int64(), pa.string(), pa.string(), pa.string())
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        done.clear()
        return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "place", "edit", "role", "text"])

    for batch in batches:
        kind = batch.column(0).type
        for conv_id, role, text, audit, became in zip(*(c.to_pylist() for c in batch.columns)):
            if audit is not None:
                conv, letters, roles, at, place = conv_id, audit, became, 0, 0
                inserted()
                continue
            edit = letters[at]
            if edit != "D":
                done.append((conv, place, edit, ROLES[roles[at]] if edit == "R" else role, text))
                place += 1
            at += 1
            inserted()
        yield out()


def repaired(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    """The turns after repair, ``conv_id, place, edit, role, text``: each conversation's rows lie
    together in one partition, in order. ``conversations`` without rows that are gone."""
    rows = _rows(conversations)
    none = F.lit(None).cast("string")
    both = plans.select(
        "conv_id", F.lit(0).alias("_kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        none.alias("role"), none.alias("text"), F.lit(None).cast("binary").alias("digest"), "audit", "roles",
    ).unionByName(rows.select("conv_id", F.lit(1).alias("_kind"), "turn", "role", "text", "digest", none.alias("audit"), none.alias("roles")))
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return (
        both.repartition("conv_id")
        .sortWithinPartitions(*_order("conv_id", "_kind"))
        .select("conv_id", "role", "text", "audit", "roles")
        .mapInArrow(_replay, f"conv_id {kind}, place bigint, edit string, role string, text string")
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    kind, conv, digest = pa.int64(), None, None
    for batch in batches:
        kind, done = batch.column(0).type, []
        for conv_id, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if place == 0:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = conv_id, hashlib.sha256()
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        yield _pairs(done, kind)
    if digest is not None:
        yield _pairs([(conv, digest.hexdigest())], kind)


def _pairs(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    keys, values = zip(*done) if done else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(values, pa.string())], names=["conv_id", "sha256"])


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of the ``role:text`` lines of :func:`repaired`, streamed."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    return turns.select("conv_id", "place", "role", "text").mapInArrow(_digests, f"conv_id {kind}, sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by the CRC-32 of ``conv_id:turn`` modulo 20: 0 is gone (``here``
    is false), 1 has no text, 2 no ``.!?``, 3 stands twice, 4 is the user's."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.regexp_replace(blank("text"), "[.!?]", ""))
    return (
        conversations.select("conv_id", "turn", "role", "text", draw.alias("_draw"))
        .select(
            "conv_id", "turn", F.when(F.col("_draw") == 4, "user").otherwise(blank("role")).alias("role"),
            text.otherwise(blank("text")).alias("text"), (F.col("_draw") != 0).alias("here"),
            F.explode(F.when(F.col("_draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
        )
        .drop("_copy")
    )


def repair_digest(conversations: DataFrame, spark: SparkSession, here: str = "here") -> DataFrame:
    """The plan of every conversation with the hash of its repaired turns."""
    plans = T.written(plan(conversations, here), spark, "turn-plans")
    hashes = digests(repaired(conversations.filter(F.col(here)), plans)).withColumnRenamed("conv_id", "_id")
    return (
        plans.join(hashes, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
        .withColumn("repaired_sha256", F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)))
        .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    )
