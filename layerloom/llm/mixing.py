"""Mixing sources to target weights by a Pfair schedule.

Time is a row of equal slots, and a slot takes one block of one source. A source of weight
``w`` (of all slots a share) releases its block ``j`` at slot ``floor(j/w)`` and must have
it placed before slot ``ceil((j+1)/w)``. Of the released blocks the one with the earliest
deadline takes the slot. With weights that add up to one, every deadline is met, so at any
slot each source has had its exact share but for less than one block.

Weights are exact fractions of the targets, never rounded to slots, and there may be any
number of sources. Roots of row counts have no common period, so one task places the blocks
slot by slot, up to the last block of any source. It keeps three numbers a source, and its
work is bounded: a corpus has at most ``MOST_BLOCKS`` blocks and one more a source, as blocks
grow with it beyond that. The schedule is a small table with a row per block. The rows get their block
by their rank within their source, counted in parallel: a range partitioning splits a hot
source over tasks, each task counts its rows, and a small table has what comes before each
task.

A source that has run out leaves its slots empty; the others keep their places. No row is
dropped or repeated, so target weights hold up to the slot where a source runs out.

Defined cases: rows with a null source are a source of their own. Within a source rows
are ordered by a hash of their id, then by the id; rows that repeat an id in a source keep
any order among themselves. Texts play no part, however long. An empty table gives an empty
result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import count, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from layerloom.llm.common import others, settled

#: Slots that the schedule hands on at a time; it decides no result.
PERIOD = 1000
BLOCK_ROWS = 16
#: What one task schedules. Of more rows than these blocks hold, a block has more rows, so that a
#: deviation is always less than one block, and never takes one task more than some seconds.
MOST_BLOCKS = 1 << 21
#: A source's weight is its number of rows to this power: below one, small sources gain.
TEMPERATURE = 0.5

Source = str | None


def slots_of(targets: Mapping[Source, float], period: int = PERIOD) -> dict[Source, Fraction]:
    """Each target's exact share of ``period`` slots, which need not be whole."""
    if any(not weight > 0 for weight in targets.values()):
        raise ValueError("target weights must be above zero")
    total = sum(Fraction(weight) for weight in targets.values())
    return {source: Fraction(weight) * period / total for source, weight in targets.items()}


def schedule(slots: Mapping[Source, Fraction | int]) -> list[tuple[Source, int, int]]:
    """The first period, as many slots as ``slots`` has in sum, as (source, block, slot)."""
    order = sorted(slots, key=_by_name)
    placed = islice(_placed([slots[source] for source in order]), math.ceil(sum(slots.values())))
    return [(order[number], block, slot) for number, block, slot in placed]


def _by_name(source: Source) -> tuple[bool, Source]:
    return source is None, source


def _placed(weights: Sequence[Fraction | float]) -> Iterator[tuple[int, int, int]]:
    """All slots as (number of the source, block, slot), earliest deadline first among released blocks."""
    exact = [Fraction(weight) for weight in weights]
    scale = math.lcm(*(weight.denominator for weight in exact))
    shares = [int(weight * scale) for weight in exact]
    total = sum(shares)
    releases = [(0, number, 0) for number in range(len(shares))]
    released: list[tuple[int, int, int]] = []
    for slot in count():
        while releases and releases[0][0] <= slot:
            _, number, block = heapq.heappop(releases)
            heapq.heappush(released, (-(-(block + 1) * total // shares[number]), number, block))
        deadline, number, block = heapq.heappop(released)
        if slot >= deadline:
            raise AssertionError("a deadline was missed")
        yield number, block, slot
        heapq.heappush(releases, ((block + 1) * total // shares[number], number, block + 1))


def mixed(
    docs: DataFrame,
    targets: Mapping[Source, float] | None = None,
    source: str = "source",
    doc_id: str = "doc_id",
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
    temperature: float = TEMPERATURE,
    most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """All rows and columns, with ``block``, ``slot``, ``place``: their place in the mix.

    The mix is the order by ``slot`` and then ``place``, the row's place within its block.
    Columns of these names are replaced. Without ``targets`` the weights are the sources'
    row counts to the power ``temperature``. Sources missing from the targets are an error.
    """
    counts = settled(docs.groupBy(F.col(source).alias("of")).agg(F.count("*").alias("rows")), "sources")
    if targets is not None:
        # One more than the caller has listed is enough to tell that one is missing.
        present = {row["of"] for row in counts.select("of").limit(len(targets) + 1).collect()}
        if missing := present - set(targets):
            raise ValueError(f"no target weight for {sorted(map(str, missing))}")
        targets = slots_of({name: targets[name] for name in present})
    rows = counts.agg(F.sum("rows")).first()[0] or 0
    block_rows = max(block_rows, math.ceil(rows / most_blocks))
    plan = settled(_plan(counts, targets, temperature, block_rows, period), "plan")
    blocks = _ranked(docs, source, doc_id).select(
        "row",
        "source",
        F.expr(f"rank div {block_rows}").alias("block"),
        F.pmod("rank", F.lit(block_rows)).cast("int").alias("place"),
    )
    placed = blocks.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("own")))
    return placed.select(
        *(F.col("row").getField(c).alias(c) for c in others(docs.columns, "block", "slot", "place")),
        "block",
        F.col("at").alias("slot"),
        "place",
    )


def _plan(
    counts: DataFrame,
    targets: Mapping[Source, Fraction] | None,
    temperature: float,
    block_rows: int,
    period: int,
) -> DataFrame:
    """``of, own, at``: the slot of each block that has rows."""
    of = counts.schema["of"]
    schema = StructType([of, StructField("own", LongType()), StructField("at", LongType())])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, kind = {}, None
        for batch in batches:
            sizes |= dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            kind = batch.schema.field(0).type
        if not sizes:
            return
        order = sorted(sizes, key=_by_name)
        weights = [sizes[name] ** temperature if targets is None else targets[name] for name in order]
        blocks = [-(-sizes[name] // block_rows) for name in order]
        slots, left = _placed(weights), sum(blocks)
        while left:
            # Those of sources that have run out stay empty.
            taken = [found for found in islice(slots, period) if found[1] < blocks[found[0]]]
            left -= len(taken)
            columns = [
                pa.array([order[number] for number, _, _ in taken], kind),
                pa.array([block for _, block, _ in taken], pa.int64()),
                pa.array([slot for _, _, slot in taken], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return counts.coalesce(1).mapInArrow(placed, schema)


def mix_sorted(placed: DataFrame) -> DataFrame:
    """Rows with ``slot`` and ``place`` sorted by them: partitions in order, rows in each."""
    return placed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The rows as they are, sorted into the mix: files in order of their names, rows in each."""
    rows = docs.select(F.struct("*").alias("row"), F.col("source"), F.col("doc_id"))
    return mix_sorted(mixed(rows, **options)).select("row.*")


def _ranked(docs: DataFrame, source: str, doc_id: str) -> DataFrame:
    """``row, source, rank``: each row with its rank, from 0, within its source."""
    order = ["source", "key", "id"]
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.col(source).alias("source"),
        F.md5(F.col(doc_id).cast("string").cast("binary")).alias("key"),
        F.col(doc_id).alias("id"),
    )
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("row", "source")
    schema = StructType([*dealt.schema.fields, StructField("part", IntegerType()), StructField("nth", LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            numbers = []
            for name in batch.column(1).to_pylist():
                seen = seen + 1 if name == last else 0
                last = name
                numbers.append(seen)
            parts = pa.array([part] * len(numbers), pa.int32())
            columns = [*batch.columns, parts, pa.array(numbers, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    ranked = settled(dealt.mapInArrow(counted, schema), "ranked")
    sizes = ranked.groupBy("source", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # About as many rows as there are tasks and sources.
    offsets = sizes.select(
        F.col("source").alias("of"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
    )
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))
    joined = ranked.join(settled(offsets, "offsets"), same)
    return joined.select("row", "source", (F.col("nth") + F.col("before")).alias("rank"))
