"""Conversation repair: the cheapest edits that give a conversation a legal order of roles.

A legal conversation is empty, or alternates user and assistant turns and ends with the
assistant, perhaps behind one system turn. Rows may be kept, given another role or deleted,
and empty turns inserted, each at its cost. A dynamic program goes over the rows and holds, for
each of the four states a conversation can be in, the cheapest audit: the letters of the edits
so far. Of audits of one cost the least in ASCII order counts.

Audits are persistent. An edit is a node behind the audit it extends, so that all states share
their prefixes. Each node has ancestors at powers of two and a rolling hash of all its letters.
Two audits of one cost are compared by the length of their longest common prefix, found by
halving over the hashes of their prefixes. Equal hashes are verified: the prefixes must run
into one node, or agree letter by letter down to it.

Rows are dealt by a range partitioning over conversation, turn and row, so a conversation may be
cut. A part of a conversation at the edge of a task gives a table of transfers: for each state
it may be entered in and left in, the cheapest audit. The parts of a conversation are then put
together by the same dynamic program over transfers. That is exact, since among a part's audits
of one cost, all with a letter for each of its rows, none is the beginning of another. Rows of
conversations at an edge pass a second time, in order, to hash what they were repaired to; a
hash of one text has to be taken in one sequence, which holds one row at a time. Repeats of a
row are found by aggregation and a join, so no task gathers a conversation.

Defined cases: a null role or text is one space. A null turn comes first; rows of one turn are
ordered by role and digest, repeats adjacent. A null id is a conversation. An empty role can not
be kept, and is illegal beside any other. Very long texts are held while their conversation is
read, within a task. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from layerloom.llm.common import settled

# The edits' letters and costs, white space, marks that end a text, legal neighbours.
KEEP, DELETE, REROLE, INSERT = "K", "D", "R", "I"
COST = {KEEP: 0, DELETE: 4, REROLE: 3, INSERT: 3}
TRUNCATED_COST = 3
WHITE_SPACE = " \t\n\v\f\r"
ENDS = (".", "!", "?")
LEGAL = frozenset(("su", "ua", "au"))

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = (START, SYSTEM, USER, ASSISTANT)
#: The state that a kept role leads to, by the state before and the role's initial.
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The state that a turn by user or assistant, whichever is legal, leads to.
_NEXT = (USER, USER, ASSISTANT, USER)

_BASE, _MODULUS = 1_000_003, (1 << 61) - 1

#: An audit of each state, as cost and node; none if the state can't be reached.
States = list[tuple[int, int] | None]


def _hashed(start: int, letters: str) -> int:
    for letter in letters:
        start = (start * _BASE + ord(letter)) % _MODULUS
    return start


class Trails:
    """Audits as linked nodes; node 0 is the empty one. A node adds one letter or more."""

    def __init__(self) -> None:
        self.letters = [""]
        self.lengths = [0]
        self.hashes = [0]
        self.ancestors: list[list[int]] = [[]]  # 1, 2, 4, ... nodes back

    def extended(self, node: int, letters: str) -> int:
        back, power = [node], 0
        while power < len(self.ancestors[back[power]]):
            back.append(self.ancestors[back[power]][power])
            power += 1
        self.letters.append(letters)
        self.lengths.append(self.lengths[node] + len(letters))
        self.hashes.append(_hashed(self.hashes[node], letters))
        self.ancestors.append(back)
        return len(self.letters) - 1

    def text(self, node: int) -> str:
        parts = []
        while node:
            parts.append(self.letters[node])
            node = self.ancestors[node][0]
        return "".join(reversed(parts))

    def less(self, one: int, other: int) -> bool:
        """Whether an audit is before another in ASCII order."""
        shorter = min(self.lengths[one], self.lengths[other])
        low, high = 0, shorter  # of this length the prefixes agree; of any above ``high`` not
        while low < high:
            middle = (low + high + 1) // 2
            if self._prefix_hash(one, middle) == self._prefix_hash(other, middle):
                low = middle
            else:
                high = middle - 1
        if not self._verified(one, other, low):
            return self.text(one) < self.text(other)
        if low == shorter:
            return self.lengths[one] < self.lengths[other]
        return self._letter(one, low) < self._letter(other, low)

    def _holding(self, node: int, length: int) -> int:
        """The ancestor, or node itself, that has the letter at ``length - 1``."""
        if not length:
            return 0
        for power in range(len(self.ancestors[node]) - 1, -1, -1):
            if power < len(self.ancestors[node]) and self.lengths[self.ancestors[node][power]] >= length:
                node = self.ancestors[node][power]
        return node

    def _prefix_hash(self, node: int, length: int) -> int:
        node = self._holding(node, length)
        if self.lengths[node] == length:
            return self.hashes[node]
        before = self.ancestors[node][0]
        return _hashed(self.hashes[before], self.letters[node][: length - self.lengths[before]])

    def _letter(self, node: int, at: int) -> str:
        node = self._holding(node, at + 1)
        return self.letters[node][at - self.lengths[self.ancestors[node][0]]]

    def _verified(self, one: int, other: int, length: int) -> bool:
        """Whether the prefixes of that length, of equal hashes, are indeed equal."""
        while length:
            one, other = self._holding(one, length), self._holding(other, length)
            if one == other:
                return True
            before = [self.lengths[self.ancestors[node][0]] for node in (one, other)]
            start = max(before)
            mine = self.letters[one][start - before[0] : length - before[0]]
            if mine != self.letters[other][start - before[1] : length - before[1]]:
                return False
            length = start
        return True


class Audits:
    """The dynamic program over rows, or over the transfers of parts."""

    def __init__(self) -> None:
        self.trails = Trails()

    def entered(self, state: int) -> States:
        return [(0, 0) if own == state else None for own in _STATES]

    def after_row(self, states: States, initial: str, fault: int) -> States:
        offers: list[list[tuple[int, int, str]]] = [[], [], [], []]
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for state, held in enumerate(self.with_inserts(states)):
            if held is None:
                continue
            cost, node = held
            offers[state].append((cost + COST[DELETE], node, DELETE))
            if fault in (BLANK, DUPLICATE):
                continue
            offers[_NEXT[state]].append((cost + COST[REROLE] + extra, node, REROLE))
            kept = _KEPT.get((state, initial))
            if kept is not None:
                offers[kept].append((cost + COST[KEEP] + extra, node, KEEP))
        return [self._best(of_state) for of_state in offers]

    def after_part(self, states: States, transfers: dict[tuple[int, int], tuple[int, str]]) -> States:
        offers: list[list[tuple[int, int, str]]] = [[], [], [], []]
        for (entry, exit_), (added, audit) in transfers.items():
            held = states[entry]
            if held is not None:
                offers[exit_].append((held[0] + added, held[1], audit))
        return [self._best(of_state) for of_state in offers]

    def with_inserts(self, states: States) -> States:
        """The states that insertions lead to as well; a second one may follow a first."""
        found = list(states)
        for _ in range(2):
            for state, held in enumerate(list(found)):
                if held is None:
                    continue
                cost, target = held[0] + COST[INSERT], _NEXT[state]
                known = found[target]
                if known is None or cost <= known[0]:
                    node = self.trails.extended(held[1], INSERT)
                    if known is None or cost < known[0] or self.trails.less(node, known[1]):
                        found[target] = (cost, node)
        return found

    def closed(self, states: States) -> tuple[int, str]:
        """Cost and audit of the whole conversation."""
        states = self.with_inserts(states)
        ends = [(held[0], held[1], "") for held in (states[START], states[ASSISTANT]) if held is not None]
        cost, node = self._best(ends)
        return cost, self.trails.text(node)

    def _best(self, offers: list[tuple[int, int, str]]) -> tuple[int, int] | None:
        if not offers:
            return None
        least = min(cost for cost, _, _ in offers)
        best = None
        for cost, node, letters in offers:
            if cost == least:
                node = self.trails.extended(node, letters) if letters else node
                if best is None or self.trails.less(node, best):
                    best = node
        return least, best


class Rebuilder:
    """Hashes the repaired rows one by one, as the audit says."""

    def __init__(self, audit: str):
        self.audit = audit
        turns = len(audit) - audit.count(DELETE)
        self.at, self.turn = 0, -(turns % 2)  # an odd number begins with a system turn
        self.hash, self.first = sha256(), True

    def take(self, role: str, text: str) -> None:
        self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != DELETE:
            self._turn(role if letter == KEEP else None, text)

    def digest(self) -> str:
        self._inserted()
        if self.at != len(self.audit):
            raise AssertionError("an audit has a letter for each row")
        return self.hash.hexdigest()

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == INSERT:
            self.at += 1
            self._turn(None, "")

    def _turn(self, role: str | None, text: str) -> None:
        role = ("user", "assistant")[self.turn % 2] if role is None else role
        self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
        self.first, self.turn = False, self.turn + 1


@dataclass
class Part:
    """The consecutive rows of one conversation that a task has."""

    key: str
    conv: object
    initials: list[str] = field(default_factory=list)
    faults: list[int] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    low: int | None = None
    high: int | None = None
    turns: int = 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        self.initials.append(role[:1])
        self.faults.append(fault)
        self.roles.append(role)
        self.texts.append(text)

    def figures(self) -> tuple:
        pairs = zip(self.initials, self.initials[1:], strict=False)
        illegal = sum(one + other not in LEGAL for one, other in pairs)
        counts = [self.faults.count(fault) for fault in (BLANK, DUPLICATE, TRUNCATED)]
        return (*counts, illegal, self.initials[0], self.initials[-1], self.low, self.high, self.turns)

    def whole(self) -> tuple:
        audits = Audits()
        states = audits.entered(START)
        for initial, fault in zip(self.initials, self.faults, strict=True):
            states = audits.after_row(states, initial, fault)
        cost, audit = audits.closed(states)
        built = Rebuilder(audit)
        for role, text in zip(self.roles, self.texts, strict=True):
            built.take(role, text)
        return (None, None, cost, audit, built.digest())

    def transfers(self) -> Iterator[tuple]:
        for entry in _STATES:
            audits = Audits()
            states = audits.entered(entry)
            for initial, fault in zip(self.initials, self.faults, strict=True):
                states = audits.after_row(states, initial, fault)
            for exit_, held in enumerate(states):
                if held is not None:
                    yield (entry, exit_, held[0], audits.trails.text(held[1]), None)


_PART = (
    "entry int, exit int, cost bigint, audit string, repaired_sha256 string, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, opening string, closing string, low bigint, high bigint, turns bigint"
)
_FIGURES = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def faults(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Every row with the ``key`` of its conversation, its own number, and its first fault."""
    spaced = lambda name: F.coalesce(F.col(name), F.lit(" "))
    rows = turns.select(
        F.coalesce(F.concat(F.lit(":"), F.col(conv_id).cast("string")), F.lit("-")).alias("key"),
        F.col(conv_id).alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        spaced(role).alias("role"),
        spaced(text).alias("text"),
    )
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    rows = settled(rows.select("*", same.alias("same"), F.monotonically_increasing_id().alias("row")), "turns")
    # Only of rows that are repeated, the number of the first.
    earliest = F.min(F.struct(F.col("turn").isNotNull(), "turn", "row"))
    firsts = rows.groupBy(F.col("key").alias("_key"), F.col("same").alias("_same")).agg(
        earliest.alias("first"), F.count("*").alias("times")
    )
    firsts = firsts.filter("times > 1").select("_key", "_same", F.col("first.row").alias("first"))
    known = rows.join(firsts, (F.col("key") == F.col("_key")) & (F.col("same") == F.col("_same")), "left")
    shown = F.rtrim(F.col("text"), F.lit(WHITE_SPACE))
    fault = (
        F.when(shown == "", BLANK)
        .when(F.col("first") != F.col("row"), DUPLICATE)
        .when(~F.right(shown, F.lit(1)).isin(*ENDS), TRUNCATED)
        .otherwise(SOUND)
    )
    return known.select(*rows.columns, fault.alias("fault"))


_ORDER = ["key", "turn", "role", "same", "row"]


def repaired(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row per conversation: its id, its faults, and its cheapest repair.

    ``gaps``, ``blank``, ``duplicate``, ``truncated`` and ``illegal`` count the faults;
    ``audit`` has the letters of the edits, and ``repaired_sha256`` is of the repaired turns.
    """
    rows = faults(turns, conv_id, turn, role, text)
    kind = turns.schema[conv_id].dataType
    schema = StructType([
        *StructType.fromDDL("key string, part int").fields, StructField("conv", kind), *StructType.fromDDL(_PART).fields
    ])
    dealt = rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    dealt = dealt.select("key", "conv", "turn", "role", "text", "fault")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for part, edge in _parts(batches):
            figures = part.figures()
            found = part.transfers() if edge else [part.whole()]
            yield [(part.key, number, part.conv, *one, *figures) for one in found]

    found = settled(dealt.mapInArrow(_batched(judged, schema), schema), "conversations")
    whole = _summed(found.filter("entry is null"))
    edges = found.filter("entry is not null")
    columns = StructType([StructField("key", edges.schema["key"].dataType), StructField("conv", kind),
                          *StructType.fromDDL(_FIGURES).fields])
    joined = settled(edges.groupBy("key").applyInArrow(_joined(columns), columns), "edges")
    of_edges = _hashed_rows(rows, joined).withColumnRenamed("key", "_key")
    joined = joined.join(of_edges, F.col("key") == F.col("_key"))
    every = whole.unionByName(joined.select(*whole.columns))
    return every.withColumnRenamed("conv", conv_id)


def _summed(parts: DataFrame) -> DataFrame:
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return parts.select(
        "conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Part, bool]]:
    """A task's parts of conversations, and whether each is the first or last of the task."""
    part, first = None, True
    for batch in batches:
        for key, conv, *row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if part is None or part.key != key:
                if part is not None:
                    yield part, first
                    first = False
                part = Part(key, conv)
            part.add(*row)
    if part is not None:
        yield part, True


#: Characters of audits that go into one batch; it decides no result.
_BATCH = 1 << 20


def _batched(function, schema: StructType):
    """Rows of Python values, some at a time, as Arrow batches of the schema."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for rows in function(given):
            held += rows
            if len(held) >= 4096 or (held and len(held[-1][6] or "") * len(held) > _BATCH):
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    return batches


def _batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(column, one.type) for column, one in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema.names)


def _joined(columns: StructType):
    """The parts of one conversation put together, in order of the tasks that had them."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(columns)

    def joined(parts: pa.Table) -> pa.Table:
        audits = Audits()
        states = audits.entered(START)
        blank = duplicate = truncated = illegal = turns = 0
        closing = low = high = None
        rows = sorted(parts.to_pylist(), key=lambda row: row["part"])
        at = 0
        while at < len(rows):
            row, transfers = rows[at], {}
            while at < len(rows) and rows[at]["part"] == row["part"]:
                one = rows[at]
                transfers[one["entry"], one["exit"]] = (one["cost"], one["audit"])
                at += 1
            states = audits.after_part(states, transfers)
            blank, duplicate, truncated = blank + row["blank"], duplicate + row["duplicate"], truncated + row["truncated"]
            illegal += row["illegal"] + (closing is not None and closing + row["opening"] not in LEGAL)
            closing = row["closing"]
            if row["low"] is not None:
                turns += row["turns"] - (row["low"] == high)
                low, high = row["low"] if low is None else low, row["high"]
        cost, audit = audits.closed(states)
        gaps = 0 if low is None else high - low + 1 - turns
        found = (rows[0]["key"], rows[0]["conv"], gaps, blank, duplicate, truncated, illegal, cost, audit)
        return pa.Table.from_batches([_batch([found], arrow)])

    return joined


def _hashed_rows(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """``key, repaired_sha256`` of the conversations in ``joined``: their rows once more, in order.

    Each conversation's audit goes before its rows, and a task holds one row at a time.
    """
    names = joined.select(F.col("key").alias("_key"))
    own = rows.join(names, F.col("key") == F.col("_key"), "left_semi").select(*_ORDER, "text")
    audits = joined.select(
        "key", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("same"),
        F.lit(-1).cast("bigint").alias("row"), F.col("audit").alias("text"),
    )
    leads = F.col("row") >= 0
    dealt = own.unionByName(audits).withColumn("leads", leads).repartition("key")
    ordered = dealt.sortWithinPartitions("key", "leads", *_ORDER[1:])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, built = None, None

        def ended() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([built.digest()])], ["key", "repaired_sha256"])

        for batch in batches:
            for own_key, role, text, row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row < 0:
                    if built is not None:
                        yield ended()
                    key, built = own_key, Rebuilder(text)
                else:
                    built.take(role, text)
        if built is not None:
            yield ended()

    return ordered.select("key", "role", "text", "row").mapInArrow(hashed, "key string, repaired_sha256 string")


def with_empty(conversations: DataFrame, found: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``found`` with a row of zeros and an empty audit for each further id of ``conversations``."""
    ids = conversations.select(F.col(conv_id).alias("_id")).distinct()
    joined = ids.join(found, F.col("_id").eqNullSafe(F.col(conv_id)), "left")
    empty: dict[str, Column] = {
        name: F.coalesce(F.col(name), F.lit(sha256().hexdigest() if name == "repaired_sha256" else "" if name == "audit" else 0))
        for name in found.columns if name != conv_id
    }
    return joined.select(F.col("_id").alias(conv_id), *(value.alias(name) for name, value in empty.items()))
