"""Conversations brought back to their grammar at the least cost: a dynamic program over compressed sequences.

Each turn is one of nine symbols, by its role and its fault. Re-Pair gives the pairs of symbols that are frequent in
the whole table a symbol of their own, again and again. Every symbol has one transfer matrix over the grammar's
states in the (min, +) algebra; that of a rule is the product of its two parts', made once and shared by all
conversations. What the cheapest edits are is kept as a rope: the state between the two parts tells where it goes on.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StringType, StructField, StructType

from shelfcast.llm.common import Scratch, ceil_div, ship, shuffle_partitions

# Costs of the edits, and what a turn that stays but is cut off costs besides.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# A word's characters are any but these; a sentence ends in one of those.
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"
# States: nothing yet, after the system turn, after a user turn, after an assistant turn; and the turn to come.
START, SYSTEM, OPEN, DONE = range(4)
STATES = 4
FOLLOWING = (OPEN, OPEN, DONE, OPEN)
# What closes a conversation in each state.
CLOSING = ("", "II", "I", "")
# Symbols: 0 must go; 1 + 2 * role (s, u, a, other) + whether it is cut off.
GONE, SYMBOLS = 0, 9
SYSTEM_SYMBOLS = (1, 2)
NEVER = 1 << 50
# Rounds of Re-Pair, pairs looked at in each, and the longest stretch that a rule stands for. They bound the work on
# the grammar and what is broadcast, not the outcome.
ROUNDS, TOP_PAIRS, LONGEST_RULE = 12, 256, 1024
# Turns of a task, about.
TASK_TURNS = 200_000


# Transfer matrices ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Transfer:
    """The cheapest way from each state to each other over some symbols.

    `cost` has its cost. `rank` orders the edits of ways from one state to different ones as strings: as each has
    one letter per turn beside its inserts, and ends in a turn's letter, none is the start of another, so what follows
    does not change their order. `via` is the state between the two parts of a rule; a symbol has `edits` instead.
    """

    cost: tuple[tuple[int, ...], ...]
    rank: tuple[tuple[int, ...], ...]
    via: tuple[tuple[int, ...], ...] | None = None
    edits: tuple[tuple[str, ...], ...] | None = None


def symbol_transfer(symbol: int) -> Transfer:
    """Inserts, then one edit of the turn, for every pair of states."""
    cost = [[NEVER] * STATES for _ in range(STATES)]
    edits = [[""] * STATES for _ in range(STATES)]
    role, late = ("sua?"[(symbol - 1) // 2], (symbol - 1) % 2 * TRUNCATED) if symbol != GONE else ("", 0)
    for origin in range(STATES):
        state = origin
        for inserts in range(STATES):
            ways = [(state, DELETE, "D")]
            if symbol != GONE:
                ways.append((FOLLOWING[state], REROLE + late, "R"))
                if role == "s" and state == START:
                    ways.append((SYSTEM, late, "K"))
                elif role == {OPEN: "u", DONE: "a"}[FOLLOWING[state]]:
                    ways.append((FOLLOWING[state], late, "K"))
            for target, price, letter in ways:
                way = inserts * INSERT + price, "I" * inserts + letter
                if way < (cost[origin][target], edits[origin][target]):
                    cost[origin][target], edits[origin][target] = way
            state = FOLLOWING[state]
    rank = [[sorted(row).index(x) for x in row] for row in edits]
    return Transfer(*(tuple(map(tuple, m)) for m in (cost, rank)), None, tuple(map(tuple, edits)))


def product(a: Transfer, b: Transfer) -> Transfer:
    """a, then b: of equally cheap ways the one whose edits come first as a string, decided by ranks alone."""
    cost, via, rank = [], [], []
    for i in range(STATES):
        between = sorted(range(STATES), key=lambda k: a.rank[i][k])
        best = [min((a.cost[i][k] + b.cost[k][j], place, k) for place, k in enumerate(between)) for j in range(STATES)]
        order = sorted(range(STATES), key=lambda j: (best[j][1], b.rank[best[j][2]][j]))
        cost.append(tuple(min(x[0], NEVER) for x in best))
        via.append(tuple(x[2] for x in best))
        rank.append(tuple(order.index(j) for j in range(STATES)))
    return Transfer(tuple(cost), tuple(rank), tuple(via))


class Grammar:
    """Rules (left, right), the nth being symbol SYMBOLS + n, and the transfer matrix of every symbol, bottom-up."""

    def __init__(self, rules: list[tuple[int, int]]):
        self.rules = rules
        self.transfers = [symbol_transfer(s) for s in range(SYMBOLS)]
        self.lengths = [1] * SYMBOLS
        for left, right in rules:
            self.transfers.append(product(self.transfers[left], self.transfers[right]))
            self.lengths.append(self.lengths[left] + self.lengths[right])
        self.ropes: dict[tuple[int, int, int], str] = {}
        self.sequences: dict[tuple[int, ...], tuple[Transfer, list[Transfer]]] = {}

    def edits(self, symbol: int, origin: int, target: int) -> str:
        """The edits that a symbol's rope stands for, each stretch unrolled once."""
        key = symbol, origin, target
        if key not in self.ropes:
            own = self.transfers[symbol]
            if own.edits:
                self.ropes[key] = own.edits[origin][target]
            else:
                (left, right), k = self.rules[symbol - SYMBOLS], own.via[origin][target]
                self.ropes[key] = self.edits(left, origin, k) + self.edits(right, k, target)
        return self.ropes[key]

    def over(self, sequence: tuple[int, ...]) -> tuple[Transfer, list[Transfer]]:
        """The transfer over a compressed sequence, and the products up to each of its symbols. Short ones, of which
        conversations share many, are remembered."""
        known = self.sequences.get(sequence)
        if known is None:
            whole = self.transfers[sequence[0]]
            upto = [whole]
            for symbol in sequence[1:]:
                whole = product(whole, self.transfers[symbol])
                upto.append(whole)
            known = whole, upto
            if len(sequence) <= 16 and len(self.sequences) < 1 << 16:
                self.sequences[sequence] = known
        return known

    def path(self, sequence: tuple[int, ...], origin: int, target: int) -> str:
        """The cheapest edits over a compressed sequence between two states."""
        upto, parts = self.over(sequence)[1], []
        for place in range(len(sequence) - 1, 0, -1):
            before = upto[place].via[origin][target]
            parts.append(self.edits(sequence[place], before, target))
            target = before
        parts.append(self.edits(sequence[0], origin, target))
        return "".join(reversed(parts))


def compressed(sequences: list[bytes], rules: list[tuple[int, int]]) -> list[np.ndarray]:
    """Sequences after all rules, one rule after the other, leftmost pairs first."""
    if not sequences:
        return []
    sizes = np.array([len(s) + 1 for s in sequences])
    x = np.full(int(sizes.sum()), -1, np.int64)
    inside = np.ones(len(x), bool)
    inside[np.cumsum(sizes) - 1] = False
    x[inside] = np.frombuffer(b"".join(sequences), np.uint8)
    for number, (left, right) in enumerate(rules):
        at = np.flatnonzero((x[:-1] == left) & (x[1:] == right))
        if left == right and len(at):  # of pairs that overlap, every other one
            head = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            run = np.repeat(at[head], np.diff(np.append(head, len(at))))
            at = at[(at - run) % 2 == 0]
        if len(at):
            x[at] = SYMBOLS + number
            x = np.delete(x, at + 1)
    return np.split(x, np.flatnonzero(x < 0)[:-1] + 1)


def _pairs(rules: list[tuple[int, int]]):
    """Neighbouring symbols of the compressed sequences, summed by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            for x, times in zip(compressed(batch.column("seq").to_pylist(), rules), batch.column("times").to_pylist(), strict=True):
                x = x[x >= 0]
                pair, n = np.unique(x[:-1] << 32 | x[1:], return_counts=True)
                for p, k in zip(pair.tolist(), n.tolist(), strict=True):
                    total[p] += k * times
            columns = [pa.array(list(c), pa.int64()) for c in (total.keys(), total.values())]
            yield pa.RecordBatch.from_arrays(columns, names=["pair", "n"])

    return run


def frequent_pairs(sequences: DataFrame, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Re-Pair over all `sequences` (seq, times): the rules, in the order in which they apply.

    Each round counts the pairs of neighbours in all sequences as the rules so far leave them, and makes rules of the
    most frequent ones that share no symbol, so that one does not change the count of another. A pair has to occur
    twice. The driver sees at most TOP_PAIRS pairs a round.
    """
    rules: list[tuple[int, int]] = []
    lengths = [1] * SYMBOLS
    for _ in range(rounds):
        counted = sequences.mapInArrow(_pairs(list(rules)), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counted.filter("n > 1").orderBy(F.desc("n"), "pair").limit(TOP_PAIRS).collect()
        taken: set[int] = set()
        for row in top:
            left, right = row["pair"] >> 32, row["pair"] & 0xFFFFFFFF
            if left in taken or right in taken or lengths[left] + lengths[right] > LONGEST_RULE:
                continue
            taken |= {left, right}
            rules.append((left, right))
            lengths.append(lengths[left] + lengths[right])
        if not taken:
            break
    return rules


# Pieces of conversations ------------------------------------------------------------------------


def _schema(conv: DataType, *fields: str) -> tuple[StructType, pa.Schema]:
    """conv_id in its own type, then longs, `text:string` and `bytes:binary` columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BinaryType

    kinds = {"": LongType(), "string": StringType(), "binary": BinaryType(), "int": IntegerType()}
    named = [f.partition(":") for f in fields]
    schema = StructType([StructField("conv_id", conv), *[StructField(n, kinds[k]) for n, _, k in named]])
    return schema, to_arrow_schema(schema)


PIECE = ("place", "seq:binary", "uids:binary", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns")
LEGAL = np.zeros((4, 4), bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True


def _pieces(schema: pa.Schema):
    """Stretches of one conversation's turns, which come in order, a row each: at most one Arrow batch of turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id")
            code = conv.dictionary_encode(null_encoding="encode").indices.to_numpy()
            symbol, initial, uid = (batch.column(c).to_numpy() for c in ("symbol", "initial", "uid"))
            fault = batch.column("fault").to_numpy()
            has_turn = batch.column("turn").is_valid().to_numpy(zero_copy_only=False)
            turn = batch.column("turn").fill_null(0).to_numpy()
            heads = np.flatnonzero(np.diff(code, prepend=-1))
            tails = np.append(heads[1:], len(code))
            illegal = np.zeros(len(code), bool)
            illegal[1:] = ~LEGAL[initial[:-1], initial[1:]]
            illegal[heads] = False
            fresh = has_turn.copy()
            fresh[1:] &= (turn[1:] != turn[:-1]) | ~has_turn[:-1]
            fresh[heads] = has_turn[heads]
            known = np.flatnonzero(has_turn)
            low = np.minimum(np.searchsorted(known, heads), max(0, len(known) - 1))
            sums = [np.add.reduceat(x.astype(np.int64), heads) for x in (fault == 1, fault == 2, fault == 3, illegal, fresh)]
            some = np.add.reduceat(has_turn.astype(np.int64), heads) > 0
            bounds = [pa.array(turn[at] if len(known) else np.zeros(len(heads), np.int64), pa.int64(), mask=~some) for at in (known[low] if len(known) else heads, tails - 1)]
            raw = symbol.astype(np.uint8).tobytes()
            columns = {
                "conv_id": conv.take(pa.array(heads)),
                "place": pa.array(place + np.arange(len(heads))),
                "seq": pa.array([raw[a:z] for a, z in zip(heads, tails, strict=True)], pa.binary()),
                "uids": pa.array([uid[a:z].tobytes() for a, z in zip(heads, tails, strict=True)], pa.binary()),
                **{n: pa.array(s) for n, s in zip(("blank", "duplicate", "truncated", "illegal", "turns"), sums, strict=True)},
                "first": pa.array(initial[heads].astype(np.int64)),
                "last": pa.array(initial[tails - 1].astype(np.int64)),
                "low": bounds[0],
                "high": bounds[1],
            }
            place += len(heads)
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)

    return run


FACTS = ("place", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns")


def _evaluated(rules: list[tuple[int, int]], schema: pa.Schema):
    """Pieces with their transfer matrix (16 costs, 16 ranks) in place of their turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            found = []
            for x in compressed(batch.column("seq").to_pylist(), rules):
                whole = grammar.over(tuple(x[x >= 0].tolist()))[0]
                found.append(np.array((whole.cost, whole.rank), np.int64).tobytes())
            columns = {"matrix": pa.array(found, pa.binary())}
            yield pa.RecordBatch.from_arrays([columns.get(f.name, batch.column(f.name) if f.name not in columns else None) for f in schema], schema=schema)

    return run


PLAN = ("place", "entry", "leave", "final", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _joined(schema: pa.Schema):
    """Pieces of each conversation, which come side by side in order, put together by their matrices: the state in
    which the cheapest way enters and leaves each piece. The last piece carries the conversation's figures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        pieces: list[dict] = []

        def close() -> None:
            links, sums = [], Counter()
            whole, upto, turns, low, high = None, [], 0, None, None
            for piece in pieces:
                cost, rank = np.frombuffer(piece["matrix"], np.int64).reshape(2, STATES, STATES).tolist()
                own = Transfer(tuple(map(tuple, cost)), tuple(map(tuple, rank)))
                whole = product(whole, own) if whole else own
                upto.append(whole)
                for name in ("blank", "duplicate", "truncated", "illegal"):
                    sums[name] += piece[name]
                links.append((piece["first"], piece["last"]))
                turns += piece["turns"] - (high is not None and piece["low"] == high)
                low = piece["low"] if low is None else low
                high = piece["high"] if piece["high"] is not None else high
            sums["illegal"] += sum(not LEGAL[a[1], b[0]] for a, b in zip(links, links[1:], strict=False))
            # Ranks order the edits; a closing insert after one of them does not change that.
            ends = [(whole.cost[START][j] + INSERT * len(CLOSING[j]), whole.rank[START][j], j) for j in range(STATES)]
            total, _, state = min(ends)
            gaps = 0 if low is None else high - low + 1 - turns
            totals = (gaps, sums["blank"], sums["duplicate"], sums["truncated"], sums["illegal"], total)
            for k in range(len(pieces) - 1, -1, -1):
                entry = upto[k].via[START][state] if k else START
                last = k == len(pieces) - 1
                rows.append((pieces[k]["conv_id"], pieces[k]["place"], entry, state, int(last), *(totals if last else (0,) * 6)))
                state = entry

        def flush() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for piece in batch.to_pylist():
                if pieces and pieces[-1]["conv_id"] != piece["conv_id"]:
                    close()
                    pieces = []
                pieces.append(piece)
            if rows:
                yield flush()
                rows = []
        if pieces:
            close()
            yield flush()

    return run


EDITED = ("place", "audit:string", "seq:binary", "uids:binary", "entry")


def _edited(rules: list[tuple[int, int]], schema: pa.Schema):
    """The edits of each piece between its two states, and the inserts that close the conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            audits = []
            ways = zip(*(batch.column(c).to_pylist() for c in ("entry", "leave", "final")), strict=True)
            for x, (entry, leave, final) in zip(compressed(batch.column("seq").to_pylist(), rules), ways, strict=True):
                audit = grammar.path(tuple(x[x >= 0].tolist()), entry, leave)
                audits.append(audit + (CLOSING[leave] if final else ""))
            columns = {"audit": pa.array(audits, pa.string())}
            yield pa.RecordBatch.from_arrays([columns.get(f.name) if f.name in columns else batch.column(f.name) for f in schema], schema=schema)

    return run


TURN = ("place", "nth", "uid", "new_role:string")


def _turns(schema: pa.Schema):
    """A row per turn that stays or is put in: which row it was (none if put in), its new role (none if kept)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, nth, uid, role = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("audit", "seq", "uids", "entry"))
            for k, (audit, symbols, uids, state) in enumerate(zip(*columns, strict=True)):
                left = iter(zip(symbols, np.frombuffer(uids, np.int64).tolist(), strict=True))
                for place, letter in enumerate(audit):
                    symbol, source = (None, None) if letter == "I" else next(left)
                    if letter == "D":
                        continue
                    state = SYSTEM if letter == "K" and symbol in SYSTEM_SYMBOLS else FOLLOWING[state]
                    owner.append(k)
                    nth.append(place)
                    uid.append(source)
                    role.append(None if letter == "K" else "assistant" if state == DONE else "user")
                    if len(owner) >= 1 << 16:
                        yield table(batch, owner, nth, uid, role)
                        owner, nth, uid, role = [], [], [], []
            yield table(batch, owner, nth, uid, role)

    def table(batch: pa.RecordBatch, owner: list, nth: list, uid: list, role: list) -> pa.RecordBatch:
        at = pa.array(owner, pa.int64())
        arrays = [batch.column("conv_id").take(at), batch.column("place").take(at), pa.array(nth, pa.int64()), pa.array(uid, pa.int64()), pa.array(role, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


# The operator -----------------------------------------------------------------------------------


def _hashed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each conversation's lines, which come side by side in order; one digest is held at a time."""
    owner, digest, done = None, None, []

    def flush() -> pa.RecordBatch:
        columns = zip(*done, strict=True) if done else [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if digest is None or conv != owner:
                if digest is not None:
                    done.append((owner, digest.hexdigest()))
                owner, digest = conv, hashlib.sha256(line)
            else:
                digest.update(b"\n" + line)
        if done:
            yield flush()
            done = []
    if digest is not None:
        done.append((owner, digest.hexdigest()))
        yield flush()


@dataclass(frozen=True)
class Repaired:
    """`summary`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, a row per conversation with turns.
    `turns`: conv_id, place, nth, role, text, the repaired turns, in the order of place and nth."""

    summary: DataFrame
    turns: DataFrame

    def digests(self) -> DataFrame:
        """conv_id, repaired_sha256 of its turns as lines `role:text`. SHA-256 is sequential, so the turns of one
        conversation pass through one task, one after the other; no conversation is gathered."""
        conv = self.turns.schema["conv_id"].dataType
        schema, arrow = _schema(conv, "repaired_sha256:string")
        line = F.concat("role", F.lit(":"), "text").cast("binary").alias("line")
        ordered = self.turns.select("conv_id", "place", "nth", line).repartition("conv_id").sortWithinPartitions("conv_id", "place", "nth")
        return ordered.select("conv_id", "line").mapInArrow(lambda batches: _hashed(batches, arrow), schema)


def repair_conversations(conversations: DataFrame, scratch: Scratch | None = None) -> Repaired:
    """Faults of the turns of `conversations` (conv_id, turn, role, text), and the cheapest edits that bring each
    conversation into the form system? (user assistant)+, or to nothing.

    Turns come by `turn` (nulls first), rows of one turn by role, then by their hash. A turn's fault is the first of:
    blank, duplicate (role and text seen earlier in the conversation, told by 128 bits of hashes), truncated (does not
    end in a sentence's end). Blank and duplicate turns must be deleted; a truncated one that stays costs more. Of
    equally cheap edits those with the ASCII-least string of initials are taken (D, I, K, R). `illegal` counts
    neighbours whose roles do not follow each other; `gaps`, missing numbers between the first and the last turn.
    Null roles and texts are one space. Null conv_ids are one conversation. Repeated rows are duplicates. Other
    columns are not read. An empty table gives empty ones.

    1. Turns are stored once with a number; from here on only thin rows move, without texts.
    2. Turns are dealt to tasks by conversation and turn, so a hot conversation lies in many tasks, and become pieces.
    3. Re-Pair over the distinct pieces gives the rules; each piece gets its matrix.
    4. The few numbers of each piece say, conversation by conversation, where the cheapest way enters and leaves it.
    5. Each piece unrolls its edits; turns get theirs back by their number.
    """
    spark = conversations.sparkSession
    ship(spark)
    scratch = scratch or Scratch(spark, "conversations")
    conv = conversations.schema["conv_id"].dataType
    space = F.lit(" ")
    rows = scratch.store(
        conversations.select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), space).alias("role"),
            F.coalesce(F.col("text").cast("string"), space).alias("text"),
            F.monotonically_increasing_id().alias("uid"),
        )
    )
    bare = F.expr(f"rtrim('{_escaped(BLANKS)}', text)")
    last = F.substring(bare, -1, 1)
    thin = rows.select(
        "conv_id",
        "turn",
        "uid",
        "role",
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64(F.lit(1), "text", "role").alias("h2"),
        (F.length(bare) == 0).alias("is_blank"),
        (~last.isin(*ENDS)).alias("is_cut"),
    )
    when = F.struct(F.col("turn").isNotNull().alias("later"), F.col("turn"), F.col("uid"))
    seen = (
        thin.filter("NOT is_blank")
        .groupBy("conv_id", "h1", "h2")
        .agg(F.min(when)["uid"].alias("first_uid"), F.count("*").alias("times"))
        .filter("times > 1")
        .select(F.col("conv_id").alias("_conv"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first_uid")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    fault = F.when(F.col("is_blank"), 1).when(F.col("first_uid") != F.col("uid"), 2).when(F.col("is_cut"), 3).otherwise(0)
    initial = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for x in ("s", 0, "u", 1, "a", 2)]), F.substring("role", 1, 1)), F.lit(3))
    symbol = F.when(F.col("fault").isin(1, 2), GONE).otherwise(1 + 2 * F.col("initial") + (F.col("fault") == 3).cast("int"))
    marked = thin.join(seen, same, "left").withColumn("fault", fault).withColumn("initial", initial).withColumn("symbol", symbol)
    order = ["conv_id", "turn", "role", "h1", "h2", "uid"]
    tasks = max(shuffle_partitions(spark), ceil_div(rows.count(), TASK_TURNS))
    ordered = marked.select(*order, "fault", "initial", "symbol").repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    schema, arrow = _schema(conv, *PIECE)
    pieces = scratch.store(ordered.select("conv_id", "turn", "uid", "fault", "initial", "symbol").mapInArrow(_pieces(arrow), schema))

    rules = frequent_pairs(scratch.store(pieces.groupBy("seq").agg(F.count("*").alias("times"))))
    schema, arrow = _schema(conv, *FACTS, "matrix:binary")
    facts = pieces.mapInArrow(_evaluated(rules, arrow), schema).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    schema, arrow = _schema(conv, *PLAN)
    plan = scratch.store(facts.mapInArrow(_joined(arrow), schema))
    schema, arrow = _schema(conv, *EDITED)
    ways = pieces.select("conv_id", "place", "seq", "uids").join(plan.select("place", "entry", "leave", "final"), "place")
    edited = scratch.store(ways.mapInArrow(_edited(rules, arrow), schema))

    parts = F.array_sort(F.collect_list(F.struct("place", "audit")))
    audits = edited.groupBy(F.col("conv_id").alias("_conv")).agg(F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"))
    figures = plan.filter("final = 1").select("conv_id", *PLAN[4:])
    summary = figures.join(audits, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    schema, arrow = _schema(conv, *TURN)
    kept = scratch.store(edited.mapInArrow(_turns(arrow), schema))
    names = ["conv_id", "place", "nth", "role", "text"]
    old = kept.filter("uid IS NOT NULL").join(rows.select("uid", "role", "text"), "uid")
    old = old.withColumn("role", F.coalesce("new_role", "role")).select(*names)
    new = kept.filter("uid IS NULL").select("conv_id", "place", "nth", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return Repaired(summary, old.union(new))


def _escaped(characters: str) -> str:
    return "".join(f"\\u{ord(c):04x}" for c in characters)


def damaged(conversations: DataFrame) -> DataFrame:
    """`conversations` with faults by crc32(`conv_id:turn`) % 20: 0 drops the row, 1 empties its text, 2 takes the
    sentence ends out of it, 3 repeats the row, 4 makes it the user's. Nulls in any column count as one space."""
    space = F.lit(" ")

    def text_of(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), space)

    kind = F.pmod(F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")), F.lit(20))
    some = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    left = some.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time"))
    return left.drop("time")


EMPTY = hashlib.sha256(b"").hexdigest()


def damaged_and_repaired(conversations: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Per conv_id of `conversations`, what `repair_conversations` says of its damaged turns, and their
    repaired_sha256; zeros, an empty audit and the hash of nothing if no turn is left."""
    found = repair_conversations(damaged(conversations), scratch)
    hashes = found.digests()
    every = conversations.select(F.col("conv_id").alias("_id")).distinct()
    joined = every.join(found.summary, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    joined = joined.join(hashes, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in PLAN[4:]]
    return joined.select(
        F.col("_id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256")
    )
