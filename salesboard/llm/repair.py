"""Repair of the turn structure of conversations by weighted generalised LR parsing.

The roles of a conversation, in turn order, should read ``(s?(ua)+)?`` by their
initials.  An LR automaton of that role grammar reads the rows; beside keeping a
row, a parse may rerole it (to user or assistant), delete it or insert an empty
turn before it, each at its cost.  The stacks of all parses form one graph whose
nodes are shared; parses that reach an equal stack are merged into the one with
the least ``(cost, audit)``, the audit being the initials of the edits in order.
The grammar recurses to the left, so only a handful of stacks exist (eight) and a
row costs the same however long the conversation is.  Merging is exact: the audit
fixes the cost, so of two parses with equal cost neither audit is the beginning of
the other, and what follows cannot turn their order round.

A conversation of any length is split.  Rows are range-partitioned by conversation
and turn and cut into blocks of bounded size.  A block's parse is a small matrix:
for each stack before it and each stack after it the cost, and the rank of the
audit among those of the block.  ``chain`` multiplies the matrices of a
conversation in order (a row a block) and tells every block between which stacks
the best repair runs; the blocks then write their edits on their own.

Edge cases: a null role or text counts as one space (a role of neither initial, a
blank text); rows are ordered by turn, null first, then by role and text; equal
rows are merged into one with a number of copies before any shuffle, all but the
first of them being duplicates; rows without a ``conv_id`` form a conversation of
their own; a conversation without rows is empty and stays so; an empty table gives
no row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesboard.llm.common import written

#: Role grammar over initials (head, body); the first head is the start.
GRAMMAR = (("conversation", ()), ("conversation", ("turns",)), ("conversation", ("s", "turns")), ("turns", ("u", "a")), ("turns", ("turns", "u", "a")))
#: Roles that an edit may give.
GIVEN = {"u": "user", "a": "assistant"}
#: Adjacent initials that are in order.
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: Rows and characters at which a block of a conversation ends (a row and its copies are at most two).
BLOCK_ROWS, BLOCK_CHARS = 4096, 4_000_000

WHITE = " \t\n\x0b\x0c\r"


# --- automaton and stacks ---------------------------------------------------------

class Parser:
    """LR automaton of a grammar, the stacks that occur and the edits that lead from stack to stack."""

    def __init__(self, grammar=GRAMMAR):
        self._rules = [("", (grammar[0][0],)), *grammar]
        self._heads = {head for head, _ in self._rules}
        self._states = [self._closure({(0, 0)})]
        self._goto: list[dict[str, int]] = []
        for state in self._states:  # grows while it is read
            after: dict[str, set] = {}
            for rule, dot in sorted(state):  # stacks have the same numbers in every task
                body = self._rules[rule][1]
                if dot < len(body):
                    after.setdefault(body[dot], set()).add((rule, dot + 1))
            targets = {symbol: self._closure(kernel) for symbol, kernel in after.items()}
            self._states += [t for t in dict.fromkeys(targets.values()) if t not in self._states]
            self._goto.append({symbol: self._states.index(t) for symbol, t in targets.items()})
        # nodes of the graph of stacks: (state, node below); equal stacks are one node
        self._nodes: list[tuple[int, int | None]] = [(0, None)]
        self.move = lru_cache(None)(self._move)
        self.shift = lru_cache(None)(self._shift)
        self.finish = lru_cache(None)(self._finish)
        k = 0
        while k < len(self._nodes):  # all stacks: those that a shift reaches
            for symbol in "sua":
                self.shift(k, symbol)
            k += 1
            if k > 10_000:
                raise ValueError("the grammar's stacks have no bound; let it recurse to the left")
        self.stacks = [k for k in range(len(self._nodes)) if k == 0 or any(k in self.shift(j, x) for j in range(len(self._nodes)) for x in "sua")]

    def _closure(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            body = self._rules[rule][1]
            if dot < len(body) and body[dot] in self._heads:
                new = {(k, 0) for k, (head, _) in enumerate(self._rules) if head == body[dot]} - items
                items |= new
                todo += new
        return frozenset(items)

    def _push(self, state: int, below: int) -> int:
        if (state, below) not in self._nodes:
            self._nodes.append((state, below))
        return self._nodes.index((state, below))

    def _reduced(self, stack: int) -> list[int]:
        """``stack`` and all stacks that reductions make of it."""
        found = [stack]
        for node in found:
            for rule, dot in sorted(self._states[self._nodes[node][0]]):
                head, body = self._rules[rule]
                if rule and dot == len(body):
                    base = node
                    for _ in body:
                        base = self._nodes[base][1]
                    new = self._push(self._goto[self._nodes[base][0]][head], base)
                    if new not in found:
                        found.append(new)
        return found

    def _accepts(self, stack: int) -> bool:
        return any((0, 1) in self._states[self._nodes[n][0]] for n in self._reduced(stack))

    def _shift(self, stack: int, symbol: str) -> tuple[int, ...]:
        """Stacks after ``symbol``, reduced as far as something can follow."""
        out = []
        for node in self._reduced(stack):
            if (state := self._goto[self._nodes[node][0]].get(symbol)) is not None:
                top = self._push(state, node)
                open_ = [n for n in self._reduced(top) if any(x in self._goto[self._nodes[n][0]] for x in "sua")]
                if self._accepts(top) and not any(map(self._accepts, open_)):
                    open_.append(top)
                out += open_
        return tuple(dict.fromkeys(out))

    def _inserts(self, stack: int) -> list[tuple[int, str]]:
        """Stacks reached by inserting turns, each by as few as possible, with their initials."""
        found = [(stack, "")]
        for node, put in found:
            found += [(n, put + x) for x in GIVEN for n in self.shift(node, x) if n not in [f for f, _ in found]]
        return found

    def _move(self, stack: int, kind: str) -> tuple[tuple[int, int, str, str, str], ...]:
        """Ways past a row of ``kind`` (initial, then ``.`` if cut off; ``-``: to be deleted).

        ``(stack after, cost, audit, initials inserted before, initial given)``, the least (cost, audit) for each stack after.
        """
        best: dict[int, tuple] = {}

        def way(after: int, cost: int, put: str, edit: str, given: str) -> None:
            audit = "I" * len(put) + edit
            if after not in best or (cost, audit) < best[after][1:3]:
                best[after] = (after, cost, audit, put, given)

        for node, put in self._inserts(stack):
            cost = INSERT * len(put)
            way(node, cost + DELETE, put, "D", "")
            if kind == "-":
                continue
            stay = cost + CUT_OFF * kind.endswith(".")
            for after in self.shift(node, kind[0]):
                way(after, stay, put, "K", kind[0])
            for x in GIVEN:
                for after in self.shift(node, x):
                    way(after, stay + REROLE, put, "R", x)
        return tuple(best.values())

    def _finish(self, stack: int) -> tuple[int, str] | None:
        """Cheapest ``(cost, initials inserted)`` that ends a conversation."""
        ends = [(INSERT * len(put), put) for node, put in self._inserts(stack) if self._accepts(node)]
        return min(ends, default=None)


@lru_cache(1)
def parser() -> Parser:
    return Parser()


#: A row as the parser sees it: its kind and how many rows like it follow on each other ("-" only).
Item = tuple[str, int]


def kinds(initial: str, blank: bool, duplicate: bool, cut_off: bool, copies: int) -> list[Item]:
    """What a row and its copies are to the parser."""
    if blank or duplicate:
        return [("-", copies)]
    first = (initial if initial in ("s", "u", "a") else "?") + "." * cut_off
    return [(first, 1), ("-", copies - 1)] if copies > 1 else [(first, 1)]


def parse(items: list[Item], start: int) -> list[dict[int, tuple]]:
    """Best parses from stack ``start``: after each item, per stack ``(cost, rank, stack before, audit, put, given)``.

    Of ``n`` rows that must go, the first ``n - 1`` are deleted at once: turns that are
    inserted among them stand before the last one, since D sorts before I.  ``rank``
    orders the audits that have come so far (equal audits share it).
    """
    move, level = parser().move, {start: (0, 0, None, "", "", "")}
    levels = [level]
    for kind, n in items:
        extra, best = DELETE * (n - 1), {}
        for stack, (cost, rank, *_) in level.items():
            for after, more, audit, put, given in move(stack, kind):
                key = (cost + more + extra, rank, audit)
                if after not in best or key < best[after][0]:
                    best[after] = (key, stack, put, given)
        order = {k: r for r, k in enumerate(sorted({key[1:] for key, *_ in best.values()}))}
        level = {after: (key[0], order[key[1:]], stack, key[2], put, given) for after, (key, stack, put, given) in best.items()}
        levels.append(level)
    return levels


def traced(levels: list[dict[int, tuple]], to: int) -> list[tuple[str, str, str]]:
    """``(audit, put, given)`` of each item on the best parse that ends on stack ``to``."""
    out = []
    for level in reversed(levels[1:]):
        _, _, before, audit, put, given = level[to]
        out.append((audit, put, given))
        to = before
    return out[::-1]


def matrix(items: list[Item], starts: list[int]) -> list[tuple[int, int, int, int]]:
    """``(from, to, cost, rank)`` of a block; ``rank`` orders the audits of all its entries."""
    cells = []
    for start in starts:
        levels = parse(items, start)
        cells += [(start, to, entry[0], [audit for audit, *_ in traced(levels, to)] if len(starts) > 1 else [entry[1]]) for to, entry in levels[-1].items()]
    order = sorted(c[3] for c in cells)
    order = {tuple(a): r for r, a in reversed(list(enumerate(order)))}
    return [(a, b, cost, order[tuple(audit)]) for a, b, cost, audit in cells]


# --- rows -------------------------------------------------------------------------

def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of a conversations table."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text, F.lit(1).alias("copies"))


def damage(rows: DataFrame) -> DataFrame:
    """The contract's damage of ``turn_rows``; a dropped row stays as no copy of a row, so that its conversation is not lost."""
    where = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    how = F.crc32(where.cast("binary")) % 20
    text = F.when(how.isin(0, 1), "").when(how == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", F.when(how != 0, F.col("turn")).alias("turn"), F.when(how == 0, "").when(how == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"))


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct rows with ``copies`` and their faults ``blank, duplicate, cut_off``.

    A row is a duplicate if an earlier turn has its role and text.  Only role and text
    pairs found at several turns are joined back, by a digest that holds the conversation.
    """
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    key = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    rows = rows.withColumn("key", key)
    again = (rows.where("copies > 0").groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
             .where("n > 1").select("key", F.lit(True).alias("again"), F.col("first.turn").alias("first_turn")))
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    return rows.join(again, "key", "left").select(
        "conv_id", "turn", "role", "text", "copies", (last == "").alias("blank"),
        (F.coalesce("again", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first_turn"))).alias("duplicate"), (~last.isin(".", "!", "?")).alias("cut_off"))


# --- blocks -----------------------------------------------------------------------

#: Counts of a block, in the order of ``_Block.counts``.
COUNTS = ("rows_", "turns", "least_turn", "last_turn", "blank", "duplicate", "truncated", "illegal")
BLOCK = ("conv_id long, block long, roles array<string>, texts array<string>, kinds array<string>, copies array<long>, " + ", ".join(f"{c} long" for c in COUNTS)
         + ", left string, right string, cells array<array<long>>")


class _Block:
    """Rows of one conversation in order, with what can be counted on the way."""

    def __init__(self, conv_id: int | None, block: int, first: bool):
        self.conv_id, self.block, self.first, self.chars = conv_id, block, first, 0
        self.roles, self.texts, self.items = [], [], []
        self.counts = dict.fromkeys(COUNTS, 0) | {"least_turn": None, "last_turn": None}
        self.left = self.right = None

    def add(self, r: dict) -> None:
        n, c, initial = r["copies"], self.counts, r["role"][:1]
        if not n:
            return
        c["rows_"] += n
        if r["turn"] is not None and r["turn"] != c["last_turn"]:
            c["turns"] += 1
            c["least_turn"] = r["turn"] if c["least_turn"] is None else c["least_turn"]
            c["last_turn"] = r["turn"]
        c["blank"] += n if r["blank"] else 0
        c["duplicate"] += 0 if r["blank"] else n if r["duplicate"] else n - 1
        doomed = r["blank"] or r["duplicate"]
        c["truncated"] += not doomed and r["cut_off"]
        c["illegal"] += n - 1 + (self.right is not None and self.right + initial not in LEGAL)
        self.left, self.right = initial if self.left is None else self.left, initial
        for kind, copies in kinds(initial, r["blank"], r["duplicate"], r["cut_off"], n):
            self.items.append((kind, copies))
            self.roles.append(None if kind == "-" else r["role"])
            self.texts.append(None if kind == "-" else r["text"])
        self.chars += 0 if doomed else len(r["text"])

    def row(self) -> tuple:
        cells = matrix(self.items, [0] if self.first else parser().stacks)
        return (self.conv_id, self.block, self.roles, self.texts, [k for k, _ in self.items], [n for _, n in self.items], *self.counts.values(),
                self.left, self.right, [list(c) for c in cells])


_ARROW = {"long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()),
          "array<array<long>>": pa.list_(pa.list_(pa.int64())), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(f.strip().split(" ", 1) for f in schema.split(", ")))
    return pa.record_batch([pa.array(list(column), _ARROW[t]) for column, t in zip(zip(*rows), types)], names=list(names))


def _cut_blocks(size: int):
    """Blocks of the rows of a range partition, sorted by conversation and turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, out = TaskContext.get().partitionId() << 32, None, []
        for batch in batches:
            for r in batch.to_pylist():
                if held is None or r["conv_id"] != held.conv_id or len(held.items) >= size or held.chars >= BLOCK_CHARS:
                    # the first block of a partition may continue a conversation of the one before
                    first = held is not None and r["conv_id"] != held.conv_id
                    if held is not None:
                        out.append(held.row())
                    held, number = _Block(r["conv_id"], number, first), number + 1
                    if sum(len(o[2]) for o in out) >= BLOCK_ROWS:
                        yield _batch(out, BLOCK)
                        out = []
                held.add(r)
        if held is not None:
            out.append(held.row())
            yield _batch(out, BLOCK)
    return run


def blocks(rows: DataFrame, size: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of ``turn_rows``: bounded stretches of a conversation with their matrix, in the order of ``block``."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    return written(_faults(rows).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_cut_blocks(size), BLOCK), "repair-blocks")


CHAINED = "block long, conv_id long, from_ long, to_ long, tail string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best way through the blocks of each conversation, from block rows sorted by conversation and block."""
    conv_id, held, out = None, [], []

    def close() -> None:
        level, levels = {0: (0, 0, None)}, []
        totals = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal"), 0)
        least = last = right = None
        for b in held:
            best: dict[int, tuple] = {}
            for a, to, cost, rank in b["cells"]:
                if a in level:
                    key = (level[a][0] + cost, level[a][1], rank)
                    if to not in best or key < best[to][0]:
                        best[to] = (key, a)
            order = {k: r for r, k in enumerate(sorted({key[1:] for key, _ in best.values()}))}
            level = {to: (key[0], order[key[1:]], a) for to, (key, a) in best.items()}
            levels.append(level)
            for k in totals:
                totals[k] += b[k]
            if b["least_turn"] is not None:
                totals["turns"] -= b["least_turn"] == last
                least, last = b["least_turn"] if least is None else least, b["last_turn"]
            if b["left"] is not None:
                totals["illegal"] += right is not None and right + b["left"] not in LEGAL
                right = b["right"]
        (cost, _, _), to, tail = min(((level[s][0] + more, level[s][1], "I" * len(put)), s, put) for s in level for more, put in filter(None, [parser().finish(s)]))
        way = []
        for level in reversed(levels):
            way.append((level[to][2], to))
            to = level[to][2]
        gaps = 0 if least is None else last - least + 1 - totals["turns"]
        for k, (b, (a, to)) in enumerate(zip(held, way[::-1])):  # the conversation's figures travel on its first block
            figures = (gaps, *(totals[c] for c in ("blank", "duplicate", "truncated", "illegal")), cost) if k == 0 else (None,) * 6
            out.append((b["block"], b["conv_id"], a, to, tail if k + 1 == len(held) else "", *figures))

    for batch in batches:
        for b in batch.to_pylist():
            if held and b["conv_id"] != conv_id:
                close()
                held = []
            conv_id = b["conv_id"]
            held.append(b)
        if out:
            yield _batch(out, CHAINED)
            out.clear()
    if held:
        close()
        yield _batch(out, CHAINED)


EDITS = ("conv_id long, block long, audit string, roles array<string>, texts array<string>, gaps long, blank long, duplicate long, truncated long, illegal long, cost long")


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and repaired rows of blocks, given the stacks before and after each."""
    for batch in batches:
        out = []
        for b in batch.to_pylist():
            items = list(zip(b["kinds"], b["copies"]))
            audit, roles, texts = [], [], []
            for (kind, n), role, text, (edits, put, given) in zip(items, b["roles"], b["texts"], traced(parse(items, b["from_"]), b["to_"])):
                audit += ["D" * (n - 1), edits]
                roles += [GIVEN[x] for x in put]
                texts += [""] * len(put)
                if given:
                    roles.append(GIVEN[given] if edits.endswith("R") else role)
                    texts.append(text)
            audit.append("I" * len(b["tail"]))
            roles += [GIVEN[x] for x in b["tail"]]
            texts += [""] * len(b["tail"])
            out.append((b["conv_id"], b["block"], "".join(audit), roles, texts, *(b[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))))
        if out:
            yield _batch(out, EDITS)


def repair(rows: DataFrame, size: int = BLOCK_ROWS) -> DataFrame:
    """The cheapest repair of every conversation of ``turn_rows``, block by block.

    ``conv_id, block, audit, roles, texts`` (the repaired rows of the block) and, on the
    first block of a conversation, its ``gaps, blank, duplicate, truncated, illegal, cost``.
    """
    cut = blocks(rows, size)
    by_conv = [F.col("conv_id").asc_nulls_first(), F.col("block").asc()]
    narrow = cut.drop("roles", "texts", "kinds", "copies", "rows_").repartition("conv_id").sortWithinPartitions(*by_conv)
    ways = narrow.mapInArrow(_chain, CHAINED).drop("conv_id")
    rows_ = cut.select("conv_id", "block", "roles", "texts", "kinds", "copies")
    return rows_.join(ways, "block").mapInArrow(_edit, EDITS)


SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation, from its edits sorted by block; texts pass through the digest and are not held."""
    head, audit, sha, any_ = None, [], None, False

    def done() -> tuple:
        return (*head, "".join(audit), sha.hexdigest())

    for batch in batches:
        out = []
        for b in batch.to_pylist():
            if b["cost"] is not None:  # a first block
                if head is not None:
                    out.append(done())
                head, audit, sha, any_ = tuple(b[c] for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), [], hashlib.sha256(), False
            audit.append(b["audit"])
            for role, text in zip(b["roles"], b["texts"]):
                sha.update((("\n" if any_ else "") + f"{role}:{text}").encode())
                any_ = True
        if out:
            yield _batch(out, SUMMARY)
    if head is not None:
        yield _batch([done()], SUMMARY)


def summary(edits: DataFrame) -> DataFrame:
    """A row for each conversation: its figures, its audit and the digest of its repaired rows ``role:text``."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("block").asc()]
    return edits.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_digest, SUMMARY)
