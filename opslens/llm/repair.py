"""Conversation structure repair: generalised LR parsing with weighted edits over a grammar of roles.

The grammar's LR(0) automaton is run on all readings of a conversation at once. A reading is a stack of automaton
states; stacks share the cells below them. At each row every stack top may keep the row (shift its role), rerole it (shift
another role), or delete it (stay); before it, roles may be inserted (shift without a row). Equal tops, those that
nothing to come can tell apart, merge, and the reading of least (cost, audit) stays, audit being the letters of the edits so far. A step depends only on the tops, their cost
differences and the order of their audits, so it is computed once for each such state and looked up afterwards.

A row's edits end in K, R or D and begin with its inserts. So no edit sequence of some rows is a prefix of another one,
and the order of two audits never depends on what follows. That is what lets a conversation be cut into blocks:
a block is parsed from every top it may start with, the blocks of a conversation are chained by their costs, and only
then edits are read off. Rows are range partitioned by (conversation, turn), so a conversation of any length is spread
over tasks; only its hash is computed from first to last row in one task, in constant memory, because SHA-256 has no
other form.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.functions.scalars import join_null_safe
from opslens.llm.common import crc_mod
from opslens.session import broadcast_if_small, frozen

#: Initials of the roles a grammar may speak of, and the productions of the conversation grammar: s?(ua)+ or nothing.
ROLES = {"s": "system", "u": "user", "a": "assistant"}
GRAMMAR = (
    ("conversation", ()), ("conversation", ("turns",)), ("conversation", ("s", "turns")),
    ("turns", ("turns", "pair")), ("turns", ("pair",)), ("pair", ("u", "a")),
)
#: Roles that may be given or inserted, and neighbours that are in order.
GIVEN, LEGAL = ("u", "a"), ("su", "ua", "au")
#: Rows and bytes of text of a block. A conversation within them, inside a slice, is repaired where it is read.
BLOCK_ROWS, BLOCK_BYTES = 16_384, 4 << 20
WORD, ENDS = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"


@dataclass(frozen=True)
class Weights:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class Automaton:
    """LR(0) automaton of a grammar: ``goto[state][symbol]``, ``reduce[state]`` as (left side, length), and the state
    that accepts. The first production's left side is the start symbol."""

    def __init__(self, grammar: Sequence[tuple[str, tuple[str, ...]]]):
        rules = [("", (grammar[0][0],)), *grammar]

        def closed(items: set) -> frozenset:
            items, new = set(items), set(items)
            while new:
                wanted = {rules[r][1][dot] for r, dot in new if dot < len(rules[r][1])}
                new = {(r, 0) for r, (left, _) in enumerate(rules) if left in wanted} - items
                items |= new
            return frozenset(items)

        sets = [closed({(0, 0)})]
        self.goto: list[dict[str, int]] = []
        for items in sets:  # grows while it is read
            by: dict[str, set] = {}
            for r, dot in sorted(items):
                if dot < len(rules[r][1]):
                    by.setdefault(rules[r][1][dot], set()).add((r, dot + 1))
            self.goto.append({})
            for symbol, kernel in by.items():
                target = closed(kernel)
                if target not in sets:
                    sets.append(target)
                self.goto[-1][symbol] = sets.index(target)
        self.reduce = [[(rules[r][0], len(rules[r][1])) for r, dot in sorted(s) if r and dot == len(rules[r][1])] for s in sets]
        self.accept = self.goto[0][rules[0][1][0]]
        self.terminals = sorted({s for _, right in rules for s in right} - {left for left, _ in rules})


class Stacks:
    """All stacks the automaton can have with something left to do, as shared cells (state, cell below).

    Only grammars with finitely many stacks are taken: those that repeat to the left, as any role grammar can.
    ``shift[top][role]`` holds the tops after a shift and all reductions; tops are numbered the same everywhere.
    """

    def __init__(self, table: Automaton):
        self.table, self.cells, self.number = table, [(0, -1)], {(0, -1): 0}
        tops, self.shift = [0], {}
        for top in tops:  # grows while it is read
            self.shift[top] = {}
            for role in table.terminals:
                # Every other top comes with those it reduces to; the first stack is alone.
                states = {c: table.goto[self.cells[c][0]].get(role) for c in (self._reduced(0) if top == 0 else [top])}
                after = [c for below, state in states.items() if state is not None for c in self._reduced(self._push(state, below))]
                live = [c for c in after if any(t in table.goto[self.cells[c][0]] for t in table.terminals)]
                if not any(map(self._accepts, live)):
                    live += [c for c in after if self.cells[c][0] == table.accept]
                self.shift[top][role] = tuple(live)
                tops += [c for c in live if c not in tops]
        self.accepts = {top for top in tops if self._accepts(top)}
        # Tops that nothing to come can tell apart are equal: split classes until their shifts agree, keep the first of each.
        kind = {top: top in self.accepts for top in tops}
        while True:
            looks = {top: (kind[top], *(frozenset(kind[c] for c in self.shift[top][r]) for r in table.terminals)) for top in tops}
            first = {look: min(t for t in tops if looks[t] == look) for look in looks.values()}
            if len(first) == len(set(kind.values())):
                break
            kind = {top: first[looks[top]] for top in tops}
        same = {top: first[looks[top]] for top in tops}
        self.tops = tuple(sorted(set(same.values())))
        self.shift = {top: {r: tuple(sorted({same[c] for c in cs})) for r, cs in self.shift[top].items()} for top in self.tops}
        self.accepts &= set(self.tops)

    def _accepts(self, cell: int) -> bool:
        return any(self.cells[c][0] == self.table.accept for c in self._reduced(cell))

    def _push(self, state: int, below: int) -> int:
        cell = (state, below)
        if cell not in self.number:
            depth, c = 0, below
            while c >= 0:
                depth, c = depth + 1, self.cells[c][1]
            if depth > len(self.table.goto):
                raise ValueError("the stacks of this grammar grow without bound; repeat to the left")
            self.number[cell] = len(self.cells)
            self.cells.append(cell)
        return self.number[cell]

    def _reduced(self, cell: int) -> list[int]:
        found = [cell]
        for c in found:  # grows while it is read
            for left, n in self.table.reduce[self.cells[c][0]]:
                below = c
                for _ in range(n):
                    below = self.cells[below][1]
                new = self._push(self.table.goto[self.cells[below][0]][left], below)
                if new not in found:
                    found.append(new)
        return found


#: Tops with their cost above the cheapest one, in order of their audits.
Frontier = tuple[tuple[int, int], ...]


class Repair:
    """Cheapest edits of strings of symbols: a role's initial (? for any other), in upper case if the row is truncated,
    and - for a row that must be deleted."""

    KEPT_STEPS = 50_000

    def __init__(self, grammar=GRAMMAR, weights: Weights = Weights(), given: Sequence[str] = GIVEN):
        self.stacks, self.weights, self.given = Stacks(Automaton(grammar)), weights, given
        self._steps: dict[tuple[Frontier, str], tuple[Frontier, int, tuple]] = {}

    def _inserted(self, frontier: Frontier) -> dict[int, tuple]:
        """top -> least (cost, place in the frontier, edits, roles) with any roles inserted."""
        found = {top: (cost, at, "", "") for at, (top, cost) in enumerate(frontier)}
        new = dict(found)
        while new:
            more: dict[int, tuple] = {}
            for top, (cost, at, edits, roles) in new.items():
                for role in self.given:
                    reading = (cost + self.weights.insert, at, edits + "I", roles + role)
                    for after in self.stacks.shift[top][role]:
                        if reading < min(found.get(after, (reading[0] + 1,)), more.get(after, (reading[0] + 1,))):
                            more[after] = reading
            found |= more
            new = more
        return found

    def step(self, frontier: Frontier, symbol: str) -> tuple[Frontier, int, tuple]:
        """The frontier after a row, what its cheapest cost rose by, and for each top (place before, edits, roles)."""
        w, found = self.weights, {}

        def offer(top: int, *reading) -> None:
            if top not in found or reading < found[top]:
                found[top] = reading

        for top, (cost, at, edits, roles) in self._inserted(frontier).items():
            offer(top, cost + w.delete, at, edits + "D", roles + "-")
            if symbol == "-":
                continue
            kept = cost + (w.truncated if symbol.isupper() else 0)
            own = symbol.lower()
            for after in self.stacks.shift[top].get(own, ()):
                offer(after, kept, at, edits + "K", roles + own)
            for role in self.given:
                for after in self.stacks.shift[top][role]:
                    offer(after, kept + w.rerole, at, edits + "R", roles + role)
        order = sorted(found, key=lambda top: found[top][1:])
        rise = min(r[0] for r in found.values())
        return tuple((top, found[top][0] - rise) for top in order), rise, tuple(found[top][1:] for top in order)

    def run(self, symbols: Iterable[str], top: int = 0) -> tuple[Frontier, int, list[tuple]]:
        """The frontier after all symbols from one top, the cheapest cost, and the way back."""
        frontier, total, way, steps = ((top, 0),), 0, [], self._steps
        for symbol in symbols:
            step = steps.get((frontier, symbol))
            if step is None:
                if len(steps) > self.KEPT_STEPS:
                    steps.clear()
                step = steps[frontier, symbol] = self.step(frontier, symbol)
            frontier, rise, back = step
            total += rise
            way.append(back)
        return frontier, total, way

    def finish(self, frontier: Frontier) -> tuple[int, int, str, str] | None:
        """Least (cost, place in the frontier, edits, roles) of a reading that ends here, with what must be inserted."""
        return min((r for top, r in self._inserted(frontier).items() if top in self.stacks.accepts), default=None)

    @staticmethod
    def back(way: list[tuple], at: int) -> tuple[str, str]:
        """Edits and roles (- for a deleted row) of the reading that ends at place ``at`` of the frontier."""
        edits, roles = [], []
        for step in reversed(way):
            at, e, r = step[at]
            edits.append(e)
            roles.append(r)
        return "".join(reversed(edits)), "".join(reversed(roles))

    def whole(self, symbols: str) -> tuple[int, str, str]:
        """Cost, audit and roles of the cheapest repair; ties go to the ASCII-least audit."""
        frontier, total, way = self.run(symbols)
        cost, at, edits, roles = self.finish(frontier)
        before = self.back(way, at)
        return total + cost, before[0] + edits, before[1] + roles

    def moves(self, symbols: str) -> list[int]:
        """(top before, top after, cost) of a block for all tops it may start with, flat; in order of the audits."""
        out = []
        for top in self.stacks.tops:
            frontier, total, _ = self.run(symbols, top)
            for after, cost in frontier:
                out += (top, after, total + cost)
        return out

    def chain(self, blocks: list[list[int]]) -> tuple[int, list[tuple[int, int]]]:
        """Cost of a conversation given as the moves of its blocks, and the tops before and after each block."""
        ends = {top: done[0] if (done := self.finish(((top, 0),))) else None for top in self.stacks.tops}
        choices = []
        for moves in reversed(blocks):
            best: dict[int, tuple[int, int, int]] = {}
            for nth, (top, after, cost) in enumerate(zip(moves[::3], moves[1::3], moves[2::3])):
                if ends.get(after) is not None:
                    offer = (cost + ends[after], nth, after)
                    best[top] = min(best.get(top, offer), offer)
            choices.append(best)
            ends = {top: b[0] for top, b in best.items()}
        top, path = 0, []
        for best in reversed(choices):
            path.append((top, best[top][2]))
            top = path[-1][1]
        return ends[0], path

    def between(self, symbols: str, before: int, after: int) -> tuple[str, str]:
        """Edits and roles of a block from one top to another."""
        frontier, _, way = self.run(symbols, before)
        return self.back(way, [top for top, _ in frontier].index(after))


@lru_cache
def _repair(grammar: tuple, weights: Weights) -> Repair:
    return Repair(grammar, weights)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: ``rows`` damaged by crc32(``conv_id:turn``) modulo 20, nulls being one space.

    0 drops a row, 1 empties its text, 2 takes its marks .!? away, 3 repeats it, 4 gives it to the user.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = crc_mod(key, 20)
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("_kind"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    ).filter("_kind <> 0").drop("_kind")


def faulty(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) with fault: b (blank), d (role and text were there in an earlier turn), t
    (truncated) or empty; equal rows become one with the sum of their copies. All copies after a row's first are
    duplicates (or blank). Texts are compared by their SHA-256.
    """
    keyed = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    key = ["conv_id", "role", "digest"]
    place = F.struct("turn")  # null first
    same = keyed.groupBy(*key).agg(F.sum("copies").alias("_n"), F.min(place).alias("_first")).filter("_n > 1")
    same = broadcast_if_small(frozen(same))
    known = join_null_safe(keyed, same, key, "left").withColumn("_late", F.coalesce(place != F.col("_first"), F.lit(False)))
    alone = known.filter("_n IS NULL").drop("_n", "_first")
    # Only rows that are there more than once are grouped.
    again = known.filter("_n IS NOT NULL").groupBy(*key, "turn", "text", "_late").agg(F.sum("copies").alias("copies"))
    fault = (
        F.when(~F.col("text").rlike(WORD), "b").when(F.col("_late"), "d").when(~F.col("text").rlike(ENDS), "t").otherwise("")
    )
    return alone.unionByName(again).withColumn("fault", fault).drop("_late")


def symbol(initial: Column, fault: Column) -> Column:
    known = F.when(initial.isin(*ROLES), initial).otherwise("?")
    return F.when(fault.isin("b", "d"), "-").when(fault == "t", F.upper(known)).otherwise(known)


_STATS = "gaps long, blank long, duplicate long, truncated long, illegal long"
_DONE = f"conv_id long, {_STATS}, cost long, audit string, repaired_sha256 string"
_BLOCK = (
    "conv_id long, block long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, head string, tail string, "
    "symbols string, roles array<string>, texts array<string>, moves array<long>, cost long, audit string, repaired_sha256 string"
)


class _Block:
    """Consecutive rows of a conversation: counts, symbols, and role and text of the rows that may stay."""

    def __init__(self):
        self.low = self.high = self.head = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.bytes = 0
        self.tail, self.symbols, self.roles, self.texts = "", [], [], []

    def add(self, turn, initial: str, fault: str, symbol: str, role: str, text: str | None, first: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        if self.head is None:
            self.head = initial
        else:
            self.illegal += self.tail + initial not in LEGAL
        self.tail = initial
        if fault == "b":
            self.blank += 1
        elif fault == "d" or not first:
            self.duplicate += 1
            symbol = "-"
        elif fault == "t":
            self.truncated += 1
        self.symbols.append(symbol)
        if symbol != "-":
            self.roles.append(role)
            self.texts.append(text)
            self.bytes += len(text)

    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def _lines(edits: str, roles: str, own: list[str], texts: list[str], symbols: str) -> list[str]:
    """The repaired rows as role:text."""
    out, row, at = [], 0, 0
    for edit, role in zip(edits, roles):
        if edit == "I":
            out.append(f"{ROLES[role]}:")
            continue
        if edit != "D":
            out.append(f"{own[at] if edit == 'K' else ROLES[role]}:{texts[at]}")
        at += symbols[row] != "-"
        row += 1
    return out


def _read(grammar: tuple, weights: Weights):
    """Sorted rows of a slice to one row for each conversation inside it (block is null), and blocks of the others."""
    schema = pa.schema([
        ("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("block", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal")],
        ("head", pa.string()), ("tail", pa.string()), ("symbols", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
        ("moves", pa.list_(pa.int64())), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, name = _repair(grammar, weights), TaskContext.get().partitionId() << 32
        held, held_bytes = [], 0

        def done(conv_id, b: _Block, whole: bool) -> None:
            nonlocal name, held_bytes
            symbols = "".join(b.symbols)
            out = {"conv_id": conv_id, "low": b.low, "high": b.high, "turns": b.turns, "blank": b.blank, "duplicate": b.duplicate,
                   "truncated": b.truncated, "illegal": b.illegal}
            if whole:
                cost, audit, roles = repair.whole(symbols)
                text = "\n".join(_lines(audit, roles, b.roles, b.texts, symbols))
                out |= {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}
            else:
                out |= {"block": name, "head": b.head, "tail": b.tail, "symbols": symbols, "roles": b.roles, "texts": b.texts,
                        "moves": repair.moves(symbols)}
                name += 1
                held_bytes += 4 * b.bytes
            held.append(out)
            held_bytes += 200 + len(symbols)

        def flush() -> pa.RecordBatch:
            nonlocal held_bytes
            out = pa.RecordBatch.from_pylist(held, schema)
            held.clear()
            held_bytes = 0
            return out

        block, current, whole = None, None, False
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "symbol", "role", "text", "copies")]
            for conv_id, turn, initial, fault, mark, role, text, copies in zip(*columns):
                if block is None or conv_id != current:
                    if block is not None:
                        done(current, block, whole)
                    # The slice's first conversation may have begun in the slice before.
                    block, current, whole = _Block(), conv_id, block is not None
                for nth in range(copies):
                    if len(block.symbols) >= BLOCK_ROWS or block.bytes >= BLOCK_BYTES:
                        done(current, block, False)
                        block, whole = _Block(), False
                    block.add(turn, initial, fault, mark, role, text, nth == 0)
                    if held_bytes >= BLOCK_BYTES:
                        yield flush()
        if block is not None:
            done(current, block, False)  # it may go on in the next slice
        if held:
            yield flush()

    return run


def _chain(grammar: tuple, weights: Weights):
    """The blocks of one conversation, without texts, to the tops before and after each block and the totals."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        cost, path = _repair(grammar, weights).chain([r["moves"] for r in rows])
        total = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
        total["illegal"] += sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(rows, rows[1:]))
        high = None
        for r in rows:
            if r["low"] is not None:
                total["turns"] -= r["low"] == high
                high = r["high"]
        low = min((r["low"] for r in rows if r["low"] is not None), default=None)
        gaps = high - low + 1 - total.pop("turns") if low is not None else 0
        n = len(rows)
        return pa.table({
            "block": pa.array([r["block"] for r in rows], pa.int64()), "before": pa.array([b for b, _ in path], pa.int64()),
            "after": pa.array([a for _, a in path], pa.int64()), "last": pa.array([i == n - 1 for i in range(n)]),
            "gaps": pa.array([gaps] * n, pa.int64()), **{c: pa.array([total[c]] * n, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")},
            "cost": pa.array([cost] * n, pa.int64())})

    return run


def _fold(grammar: tuple, weights: Weights):
    """Blocks in order, with the tops before and after them, to one row for each conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, audit, sha, empty = _repair(grammar, weights), [], hashlib.sha256(), True
        for batch in batches:
            for at in range(batch.num_rows):
                (r,) = batch.slice(at, 1).to_pylist()
                edits, roles = repair.between(r["symbols"], r["before"], r["after"])
                if r["last"]:
                    _, _, more, inserted = repair.finish(((r["after"], 0),))
                    edits, roles = edits + more, roles + inserted
                audit.append(edits)
                for line in _lines(edits, roles, r["roles"], r["texts"], r["symbols"]):
                    sha.update(line.encode() if empty else b"\n" + line.encode())
                    empty = False
                if r["last"]:
                    yield pa.record_batch({
                        **{c: pa.array([r[c]], pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")},
                        "audit": pa.array(["".join(audit)]), "repaired_sha256": pa.array([sha.hexdigest()])}).select(
                            ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])
                    audit, sha, empty = [], hashlib.sha256(), True

    return run


def repaired(rows: DataFrame, grammar: tuple = GRAMMAR, weights: Weights = Weights()) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text, copies; turn nulls first, equal turns by
    role and digest of the text): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A null conv_id is a conversation of its own. A role whose initial the grammar does not know is never kept. Rows
    that are there more than once count as often as they are there. No rows, no result.
    """
    found = faulty(rows)
    initial = F.substring("role", 1, 1)
    stays = ~F.col("fault").isin("b", "d")
    marked = found.select(
        "conv_id", "turn", "role", "digest", "copies", initial.alias("initial"), "fault", symbol(initial, F.col("fault")).alias("symbol"),
        F.when(stays, F.col("text")).alias("text"))
    order = ["conv_id", "turn", "role", "digest"]
    slices = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    read = frozen(slices.mapInArrow(_read(grammar, weights), _BLOCK))
    gaps = F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(F.lit(0).cast("long"))
    inside = read.filter("block IS NULL").withColumn("gaps", gaps).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    blocks = read.filter("block IS NOT NULL")
    chained = blocks.select("conv_id", "block", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "head", "tail", "moves").groupBy(
        "conv_id").applyInArrow(_chain(grammar, weights), f"block long, before long, after long, last boolean, {_STATS}, cost long")
    with_tops = blocks.select("conv_id", "block", "symbols", "roles", "texts").join(chained, "block")
    ordered = with_tops.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return inside.unionByName(ordered.mapInArrow(_fold(grammar, weights), _DONE))


def repair_damaged(rows: DataFrame) -> DataFrame:
    """The result of ``repaired`` for ``rows`` after ``damage``, one row for each conv_id of ``rows``; a conversation that
    the damage leaves without rows has zeros, an empty audit and the hash of an empty string."""
    all_ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = join_null_safe(all_ids, repaired(damage(rows)), ["conv_id"], "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit(""), 256)
    return found.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
