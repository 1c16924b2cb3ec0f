"""Repair of conversations: the cheapest edits that give a well-formed sequence of roles.

Rows are sorted into range partitions and cut into blocks of at most BLOCK_ROWS rows, so that a
conversation of any length is worked on in many tasks; a block's rows become one byte each. A row
is a duplicate unless it is the first of its role and text, and firsts are minima by key. The
cost program runs in every block for all four states it may start and end in; the blocks' tables
are multiplied (minimum of sums) from a conversation's end, which gives each block the costs
behind it. Inside a block the optimal arcs are then ranked by the audits that begin with them, of
length 1, 2, 4, ...: a rank is the pair of the ranks of two halves, and pointers double with
them. The ranks pick each node's arc, the doubled pointers give the path from each entry state.
Exit states are strung together from a conversation's start, and the edits meet their texts
again in one pass that reads each conversation in order.

States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. The next user or
assistant is determined by the state, so that a label leads to one node only.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmloom.llm.common import stored

BLOCK_ROWS, BLOCK_BYTES = 2048, 1 << 20
#: Bytes of a range partition, and most partitions: beyond, partitions grow.
PART_BYTES, MOST_PARTS = 16 << 20, 20_000
SPACE = " \t\n\x0b\x0c\r"
DELETE, RETRUNCATED, INSERT, REROLE = 4, 3, 3, 3
FAR = 1 << 60
#: Codes of rows: two bits for the role, then marks.
ROLES = {"u": 0, "a": 1, "s": 2}
OTHER, BLANK, TRUNCATED, DUPLICATE = 3, 4, 8, 16
#: State after an inserted or changed row, and after a kept one by (state, role).
NEXT = (2, 2, 3, 2)
KEPT = {(0, 2): 1, (0, 0): 2, (1, 0): 2, (2, 1): 3, (3, 0): 2}
LABELS = "DIKR"
#: Costs behind a conversation's last row by state, and the inserts they stand for.
LAST, TAILS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")

# ---- costs


def _choices(code: int, state: int) -> list[tuple[int, int, int]]:
    """(label, cost, next state) of the edits that use up a row."""
    found = [(0, DELETE, state)]
    if not code & (BLANK | DUPLICATE):
        more = RETRUNCATED if code & TRUNCATED else 0
        kept = KEPT.get((state, code & 3))
        if kept is not None:
            found.append((2, more, kept))
        found.append((3, REROLE + more, NEXT[state]))
    return found


_EDITS = [[_choices(code, state) for state in range(4)] for code in range(32)]


def _before(code: int, behind: tuple) -> tuple:
    """Costs from each state in front of a row on, inserts included, by those behind it."""
    a, b, c, d = (min(cost + behind[to] for _, cost, to in edits) for edits in _EDITS[code])
    c, d = min(c, INSERT + d), min(d, INSERT + c)
    return min(a, INSERT + c), min(b, INSERT + c), c, d


@functools.lru_cache(maxsize=50_000)
def _table(codes: bytes) -> tuple[tuple, ...]:
    """Costs of a block from each state (row) to each state (column)."""
    columns = []
    for end in range(4):
        behind = tuple(0 if q == end else FAR for q in range(4))
        for code in reversed(codes):
            behind = _before(code, behind)
        columns.append(behind)
    return tuple(zip(*columns))


def block_table(codes: bytes) -> tuple[tuple, ...]:
    return _table(codes) if len(codes) <= 64 else _table.__wrapped__(codes)


# ---- paths


def _paths(codes: bytes, behind: tuple) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """The least of the cheapest audits of a block from each state, and the state each ends in."""
    n = len(codes)
    costs = [behind]
    for code in reversed(codes):
        costs.append(_before(code, costs[-1]))
    costs.reverse()
    # optimal arcs, node by node; a node at the block's end has one arc to itself, of no label
    source, label, target = [], [], []
    for i, code in enumerate(codes):
        here, then = costs[i], costs[i + 1]
        for state in range(4):
            arcs = [(k, 4 * (i + 1) + to) for k, cost, to in _EDITS[code][state] if cost + then[to] == here[state]]
            if INSERT + here[NEXT[state]] == here[state]:
                arcs.append((1, 4 * i + NEXT[state]))
            for k, to in arcs:
                source.append(4 * i + state)
                label.append(k + 1)
                target.append(to)
    for state in range(4):
        source.append(4 * n + state)
        label.append(0)
        target.append(4 * n + state)
    source, label, target = map(np.array, (source, label, target))

    def best(rank: np.ndarray) -> np.ndarray:
        """The arc of least rank out of each node."""
        order = np.lexsort((rank, source))
        first = np.concatenate([[True], source[order][1:] != source[order][:-1]])
        return order[first]

    rank, jumps = label, [best(label)[target]]
    while (label[jumps[-1]] > 0).any():
        jump = jumps[-1]
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)[1]
        jumps.append(jump[jump])
    chosen = best(rank)
    audits, exits = [], []
    for state in range(4):
        path = chosen[[state]]
        for jump in jumps:
            path = np.concatenate([path, jump[path]])
        # past the end the path stays on the last arc
        labels = label[path]
        audits.append("".join(LABELS[k - 1] for k in labels[labels > 0]))
        exits.append(int(target[path[-1]]) - 4 * n)
    return tuple(audits), tuple(exits)


_cached_paths = functools.lru_cache(maxsize=50_000)(_paths)


def block_paths(codes: bytes, behind: tuple) -> tuple[tuple[str, ...], tuple[int, ...]]:
    if len(codes) > 64:
        return _paths(codes, behind)
    # only differences matter, and small numbers let more blocks share an entry
    least = min(behind)
    return _cached_paths(codes, tuple(b - least for b in behind))


# ---- rows


def row_code(role: str, text: str) -> int:
    """Role, blank and truncated mark of a row."""
    code = ROLES.get(role[:1], OTHER)
    rest = text.rstrip(SPACE)
    if not rest:
        return code | BLANK
    return code if rest[-1] in ".!?" else code | TRUNCATED


def _ordered(rows: DataFrame, part_bytes: int) -> DataFrame:
    """Rows in range partitions, sorted as documented at `repair`. Long texts stay out of the key."""
    size = rows.agg(F.sum(F.octet_length("text") + F.octet_length("role") + 32)).first()[0] or 0
    parts = max(1, min(MOST_PARTS, -(-size // part_bytes)))
    order = ["conv_id", "turn", "role", "begin", "hash", "row"]
    return (
        rows.withColumn("begin", F.substring("text", 1, 32)).withColumn("hash", F.xxhash64("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .select("conv_id", "turn", "role", "text")
    )


_BLOCKS = "conv_id long, part long, block long, turns array<long>, roles array<string>, texts array<string>, keys array<binary>, codes binary"


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows to blocks, numbered within the partition."""
    part, number, size = TaskContext.get().partitionId(), 0, 0
    conv, held, done = None, [], []

    def close() -> None:
        nonlocal number, size, held
        turns, roles, texts = zip(*held)
        codes = bytes(row_code(r, t) for r, t in zip(roles, texts))
        keys = [
            None if c & BLANK else hashlib.blake2b(f"{len(r)}:{r}{t}".encode(), digest_size=16).digest()
            for c, r, t in zip(codes, roles, texts)
        ]
        done.append((conv, part, number, turns, roles, texts, keys, codes))
        number, size, held = number + 1, 0, []

    def batch_of() -> pa.RecordBatch:
        kinds = (
            pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()),
            pa.list_(pa.binary()), pa.binary(),
        )
        names = [f.split()[0] for f in _BLOCKS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    waiting = 0
    for batch in batches:
        for conv_id, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (conv_id != conv or len(held) >= block_rows or size >= BLOCK_BYTES):
                waiting += size
                close()
                if waiting >= 4 << 20 or len(done) >= 5000:
                    yield batch_of()
                    waiting, done = 0, []
            conv = conv_id
            held.append((turn, role, text))
            size += len(text) + len(role) + 32
    if held:
        close()
    if done:
        yield batch_of()


def _mapped(df: DataFrame, function, layout: str, kinds: list[pa.DataType]) -> DataFrame:
    """`function` gives for each row of `df` (as values of its columns) a row of `layout`."""
    names = [f.split()[0] for f in layout.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [function(*values) for values in zip(*(c.to_pylist() for c in batch.columns))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return df.mapInArrow(run, layout)


def _solve(conv_id, part, block, codes, firsts):
    """Marks duplicates, and the block's cost table."""
    seen = set(firsts or ())
    codes = bytes(c if c & BLANK or i in seen else c | DUPLICATE for i, c in enumerate(codes))
    return conv_id, part, block, codes, [min(v, FAR) for row in block_table(codes) for v in row]


def _costs_behind(solved: DataFrame) -> DataFrame:
    """(part, block, behind, cost): costs behind each block by state, and of its conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for blocks in batch.column(0).to_pylist():
                behind, mine = LAST, []
                for b in reversed(blocks):
                    mine.append((b["part"], b["block"], behind))
                    table = b["costs"]
                    behind = tuple(min(table[4 * q + k] + behind[k] for k in range(4)) for q in range(4))
                rows += [(*m, behind[0]) for m in mine]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "block", "behind", "cost"])

    tables = solved.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "block", "costs"))).alias("b"))
    return tables.select("b").mapInArrow(run, "part long, block long, behind array<long>, cost long")


def _entries(paths: DataFrame) -> DataFrame:
    """(part, block, entry): the state in which each block's path begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for blocks in batch.column(0).to_pylist():
                state = 0
                for b in blocks:
                    rows.append((b["part"], b["block"], state))
                    state = b["exits"][state]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["part", "block", "entry"])

    exits = paths.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "block", "exits"))).alias("b"))
    return exits.select("b").mapInArrow(run, "part long, block long, entry long")


class _Conversation:
    """One conversation read in order: counts, audit and the running digest of what is left."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.cost = conv_id, 0, 0
        self.low = self.high = self.role = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.audit, self.digest, self.begun = [], hashlib.sha256(), False

    def say(self, role: str, text: str) -> None:
        self.digest.update(("\n" * self.begun + f"{role}:{text}").encode())
        self.begun = True

    def insert(self, text: str = "") -> None:
        self.say("assistant" if self.state == 2 else "user", text)
        self.state = NEXT[self.state]

    def block(self, turns: list, roles: list, texts: list, codes: bytes, audit: str) -> None:
        for turn in turns:
            if turn is not None and turn != self.high:
                self.low, self.high = (turn if self.low is None else self.low), turn
                self.turns += 1
        for code in codes:
            self.blank += bool(code & BLANK)
            self.duplicate += code & (BLANK | DUPLICATE) == DUPLICATE
            self.truncated += code & (BLANK | DUPLICATE | TRUNCATED) == TRUNCATED
            role = code & 3
            self.illegal += self.role is not None and (self.role, role) not in ((2, 0), (0, 1), (1, 0))
            self.role = role
        at = 0
        for label in audit:
            if label == "I":
                self.insert()
                continue
            if label == "K":
                self.say(roles[at], texts[at])
                self.state = KEPT[self.state, codes[at] & 3]
            elif label == "R":
                self.insert(texts[at])
            at += 1
        self.audit.append(audit)

    def row(self) -> tuple:
        tail = TAILS[self.state]
        for _ in tail:
            self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (
            self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
            "".join(self.audit) + tail, self.digest.hexdigest(),
        )


_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted marks, edits and blocks of whole conversations to one row each."""
    current, edits, done, size = None, None, [], 0
    names = [f.split()[0] for f in _RESULT.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    for batch in batches:
        for conv_id, _, _, kind, turns, roles, texts, codes, audit, cost in zip(*(c.to_pylist() for c in batch.columns)):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    done.append(current.row())
                    size += len(done[-1][-2])
                    if len(done) >= 5000 or size >= 4 << 20:
                        yield batch_of()
                        done, size = [], 0
                current = _Conversation(conv_id)
            if kind == 1:
                edits, current.cost = (codes, audit), cost
            elif kind == 2:
                current.block(turns, roles, texts, *edits)
    if current is not None:
        done.append(current.row())
    if done:
        yield batch_of()


def repair(
    rows: DataFrame, ids: DataFrame | None = None, block_rows: int = BLOCK_ROWS, part_bytes: int = PART_BYTES
) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row a
    conversation of `rows` (conv_id long, turn long, role string, text string).

    Rows count by turn (null first); of equal turns by role, the first 32 characters of the text and a
    hash of it. Null roles and texts are one space. A null conv_id is a conversation like any other.
    Each row's first fault counts: blank (white space only), duplicate (role and text seen earlier),
    truncated (no `.!?` at the end). Edits: Keep costs 0, Rerole 3, Delete 4 (required for blank and
    duplicate rows), Insert 3; a truncated row that is not deleted adds 3. `audit` is the ASCII-least
    of the cheapest edits' initials; the roles' initials are then `(s?(ua)+)?`. `ids` (conv_id) adds
    conversations without rows: zeros, an empty audit and the digest of nothing. Other columns are left out;
    an empty table gives no rows.

    The digest runs over a conversation from start to end, so one task reads all blocks of a
    conversation, one after the other; everything before works on blocks.
    """
    narrow = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    ordered = _ordered(narrow, part_bytes)
    blocks = stored(ordered.mapInArrow(functools.partial(_blocks, block_rows=block_rows), _BLOCKS), "turn-blocks")
    keyed = blocks.select("conv_id", "part", "block", F.posexplode("keys").alias("at", "key")).where("key is not null")
    firsts = (
        keyed.groupBy("conv_id", "key").agg(F.min(F.struct("part", "block", "at")).alias("f"))
        .groupBy("f.part", "f.block").agg(F.collect_list("f.at").alias("firsts"))
    )
    whole = blocks.select("conv_id", "part", "block", "codes").join(firsts, ["part", "block"], "left")
    solved = stored(
        _mapped(
            whole.select("conv_id", "part", "block", "codes", "firsts"), _solve,
            "conv_id long, part long, block long, codes binary, costs array<long>",
            [pa.int64()] * 3 + [pa.binary(), pa.list_(pa.int64())],
        ),
        "turn-costs",
    )
    behind = solved.select("conv_id", "part", "block", "codes").join(_costs_behind(solved), ["part", "block"])
    paths = stored(
        _mapped(
            behind.select("conv_id", "part", "block", "codes", "behind", "cost"),
            lambda conv_id, part, block, codes, after, cost: (conv_id, part, block, codes, cost, *block_paths(codes, tuple(after))),
            "conv_id long, part long, block long, codes binary, cost long, audits array<string>, exits array<long>",
            [pa.int64()] * 3 + [pa.binary(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())],
        ),
        "turn-paths",
    )
    none = {"turns": "array<long>", "roles": "array<string>", "texts": "array<string>", "codes": "binary", "audit": "string", "cost": "long"}

    def part_of(df: DataFrame, kind: int, *given: str) -> DataFrame:
        place = ["part", "block"] if kind else [F.lit(-1).cast("long").alias(c) for c in ("part", "block")]
        rest = [F.col(c) if c in given else F.lit(None).cast(t).alias(c) for c, t in none.items()]
        return df.select("conv_id", *place, F.lit(kind).alias("kind"), *rest)

    edits = paths.join(_entries(paths), ["part", "block"]).withColumn("audit", F.get("audits", F.col("entry").cast("int")))
    marks = (narrow if ids is None else ids.select(F.col("conv_id").cast("long").alias("conv_id"))).select("conv_id").distinct()
    parts = part_of(blocks.drop("codes"), 2, "turns", "roles", "texts").union(part_of(edits, 1, "codes", "audit", "cost")).union(part_of(marks, 0))
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "kind").mapInArrow(_read, _RESULT)


def damage(turns: DataFrame) -> DataFrame:
    """`turns` (conv_id, turn, role, text) with faults by the checksum of `conv_id:turn` (nulls: one
    space): of 20 remainders, 0 drops the row, 1 empties its text, 2 removes `.!?` from it, 3 repeats
    the row, 4 makes its role user."""

    def filled(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        filled("role").alias("role"), filled("text").alias("text"), fault.alias("fault"),
    ).where("fault <> 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
