"""Questions and answers: grouping blocks into conversations, and checks of such groups."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Held blocks, skips in a row and rejections that force a group; confidence by cause.
MOST_BLOCKS, MOST_SKIPS, MOST_REJECTIONS, STUCK = 50, 5, 2, 3
CONFIDENCE = {"validated": 1.0, "final": 1.0, "memory_limit": 0.8, "forced_skip_limit": 0.7, "unvalidated": 0.5}

#: decide(window) -> how many blocks of it end a group, or 0 to skip, or None for no decision; validate(blocks) -> bool.
Decider = Callable[[list[dict]], int | None]
Validator = Callable[[list[dict]], bool]


@dataclass(frozen=True)
class Group:
    qa_group_id: int
    start_block_id: int
    end_block_id: int
    confidence: float
    method: str


def group_blocks(blocks: list[dict], decide: Decider, validate: Validator, window: int = 10, block: str = "block", force_undecided: bool = True) -> list[Group]:
    """The sliding-window state machine over one document's blocks, in order. A window grows while no end is found; five
    skips or fifty held blocks force a group; a rejected end is taken after the second rejection; what is left at the end
    is one group. A forced group takes the whole window. Rounds without a decision count towards the fifty blocks only if
    force_undecided."""
    out: list[Group] = []
    n = len(blocks)
    start = end = skips = rejections = stuck = rounds = 0
    before = -1

    def emit(part: list[dict], method: str) -> None:
        out.append(Group(len(out) + 1, part[0][block], part[-1][block], CONFIDENCE[method], method))

    while start < n and rounds < 3 * n:
        rounds += 1
        stuck = stuck + 1 if start == before else 0
        before = start
        at_end = end >= n
        end = min((end or start) + window, n)
        view = blocks[start:end]
        found = decide(view)
        if not found:
            skips += found == 0
            forced = None if found is None and not force_undecided else "forced_skip_limit" if skips >= MOST_SKIPS else "memory_limit" if len(view) >= MOST_BLOCKS else None
            if forced:
                emit(view, forced)
                start, end, skips, rejections = end, 0, 0, 0
            elif at_end and stuck > STUCK:
                break
            continue
        skips = 0
        part = view[:found]
        accepted = validate(part)
        rejections += not accepted
        if accepted or rejections >= MOST_REJECTIONS:
            emit(part, "validated" if accepted else "unvalidated")
            start, end, rejections = start + len(part), 0, 0
        elif end >= n and at_end:
            break
    if start < n:
        emit(blocks[start:], "final")
    return out


class Grouper:
    """The state machine of group_blocks over blocks that come one by one: feed() gives the groups that a block completes,
    finish() what is left at the end. It holds one window: fewer than MOST_BLOCKS blocks and two steps, since rounds
    without a decision count, too. The limit of three rounds for each block, which needs
    their number, is left out; each round grows the window, ends a group or is one of the few at the end."""

    def __init__(self, decide: Decider, validate: Validator = lambda _: True, window: int = 10, block: str = "block"):
        self.decide, self.validate, self.window, self.block = decide, validate, max(1, window), block
        self.held: list[dict] = []
        self.made = self.size = self.skips = self.rejections = 0
        self.stuck = -1  # rounds before this one with the same first block

    def feed(self, block: dict) -> list[Group]:
        self.held.append(block)
        out: list[Group] = []
        while len(self.held) >= self.size + self.window:
            self.size += self.window
            out += self._round()
        return out

    def finish(self) -> list[Group]:
        out: list[Group] = []
        while self.held:
            at_end = self.size >= len(self.held)
            self.size = min(self.size + self.window, len(self.held))
            rejected = self.rejections
            found = self._round()
            out += found
            if not found and at_end and (self.rejections > rejected or self.stuck > STUCK):
                break
        if self.held:
            out.append(self._taken(len(self.held), "final"))
        return out

    def _taken(self, n: int, method: str) -> Group:
        part, self.held, self.size = self.held[:n], self.held[n:], 0
        self.made, self.stuck = self.made + 1, -1
        return Group(self.made, part[0][self.block], part[-1][self.block], CONFIDENCE[method], method)

    def _round(self) -> list[Group]:
        view = self.held[: self.size]
        self.stuck += 1
        found = self.decide(view)
        if not found:
            self.skips += found == 0
            forced = "forced_skip_limit" if self.skips >= MOST_SKIPS else "memory_limit" if len(view) >= MOST_BLOCKS else None
            if forced is None:
                return []
            self.skips = self.rejections = 0
            return [self._taken(len(view), forced)]
        self.skips = 0
        accepted = self.validate(view[:found])
        self.rejections += not accepted
        if not accepted and self.rejections < MOST_REJECTIONS:
            return []
        self.rejections = 0
        return [self._taken(found, "validated" if accepted else "unvalidated")]


def asker_rule(is_start: str = "is_start") -> Decider:
    """A decider by rule: a group ends before the next block that starts one."""

    def decide(view: list[dict]) -> int | None:
        for i in range(1, len(view)):
            if view[i][is_start]:
                return i
        return None

    return decide


#: What a service that decides may raise without ending the work.
FAILURES = (ValueError, RuntimeError, OSError)


def bounded(decide: Decider, attempts: int = 5) -> Decider:
    """decide with a number of attempts: an error, or an end outside the window, is one; without an answer in the end, None."""

    def run(view: list[dict]) -> int | None:
        for _ in range(attempts):
            try:
                found = decide(view)
            except FAILURES:
                continue
            if found is None or 0 <= found <= len(view):
                return found
        return None

    return run


def lenient(validate: Validator, attempts: int = 3) -> Validator:
    """validate with a number of attempts: a verdict counts at once; what only raises errors is accepted."""

    def run(part: list[dict]) -> bool:
        for _ in range(attempts):
            try:
                return validate(part)
            except FAILURES:
                continue
        return True

    return run


def nested(rows: DataFrame, key: str, group: str, block: str) -> DataFrame:
    """(key, groups): the groups of a key in order, each with its blocks in order; both levels use one shuffle by key."""
    inner = rows.repartition(key).groupBy(key, group).agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    return inner.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(group, "blocks"))).alias("groups"))


GROUP_FIELDS = "qa_group_id int, start_block_id long, end_block_id long, confidence double, method string"


def state_machine(blocks: DataFrame, key: str, block: str, decide: Decider, validate: Validator = lambda _: True, window: int = 10, force_undecided: bool = False) -> DataFrame:
    """The groups of each key by arbitrary decisions; a key's blocks are held by one task. Without a decision a window only
    grows, unless force_undecided."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(block)
        found = group_blocks(rows.to_dict("records"), decide, validate, window, block, force_undecided)
        return pd.DataFrame([{key: rows[key].iloc[0], **g.__dict__} for g in found])

    kind = blocks.schema[key].dataType.simpleString()
    return blocks.groupBy(key).applyInPandas(run, f"{key} {kind}, {GROUP_FIELDS}")


def by_rule(blocks: DataFrame, key: str, block: str, is_start: Column, among: Column | None = None) -> DataFrame:
    """qa_group_id by rule, as a window: every block that starts a group adds one; what stands before the first is in the
    first. Blocks outside `among` get null."""
    w = Window.partitionBy(key).orderBy(block)
    number = F.greatest(F.sum(is_start.cast("int")).over(w), F.lit(1))
    return blocks.withColumn("qa_group_id", number.cast("int") if among is None else F.when(among, number.cast("int")))


def assigned(rows: DataFrame, groups: DataFrame, key: str, block: str, among: Column) -> DataFrame:
    """rows with the qa_group_id of the group whose blocks include theirs; null outside `among` and where there is none."""
    spread = groups.select(key, "qa_group_id", F.explode(F.sequence("start_block_id", "end_block_id")).alias(block))
    return rows.join(spread, [key, block], "left").withColumn("qa_group_id", F.when(among, F.col("qa_group_id")))


def gap_positions(blocks: DataFrame, key: str, block: str, group: str) -> DataFrame:
    """Blocks without a group and where they stand: first, last or middle."""
    w = Window.partitionBy(key).orderBy(block)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    place = F.when(F.row_number().over(w) == 1, "first").when(F.row_number().over(w) == n, "last").otherwise("middle")
    return blocks.withColumn("position", place).where(F.col(group).isNull())


def order_breaks(blocks: DataFrame, key: str, block: str, group: str) -> DataFrame:
    """Where a group follows one that isn't its predecessor."""
    w = Window.partitionBy(key).orderBy(block)
    steps = blocks.where(F.col(group).isNotNull()).withColumn("previous", F.lag(group).over(w))
    return steps.where((F.col(group) != F.col("previous")) & (F.col(group) != F.col("previous") + 1))


def runs(blocks: DataFrame, key: str, block: str, same: list[str]) -> DataFrame:
    """Neighbouring blocks with equal values merged: first and last block and how many."""
    w = Window.partitionBy(key).orderBy(block)
    unlike = [~F.col(c).eqNullSafe(F.lag(c).over(w)) for c in same]
    change = F.when(F.lag(block).over(w).isNull() | (F.col(block) != F.lag(block).over(w) + 1), 1)
    for u in unlike:
        change = change.when(u, 1)
    marked = blocks.withColumn("_change", change.otherwise(0)).withColumn("_island", F.sum("_change").over(w))
    return marked.groupBy(key, "_island", *same).agg(F.min(block).alias("first_block"), F.max(block).alias("last_block"), F.count(F.lit(1)).alias("blocks")).drop("_island")


def positions(blocks: DataFrame, key: str, block: str) -> DataFrame:
    """opening, closing or middle; a lone block is opening."""
    at = F.row_number().over(Window.partitionBy(key).orderBy(block))
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    return blocks.withColumn("block_position", F.when(at == 1, "opening").when(at == n, "closing").otherwise("middle"))


def context(blocks: DataFrame, key: str, block: str, content: Column, n: int = 2) -> DataFrame:
    """The contents of up to n blocks before, oldest first."""
    w = Window.partitionBy(key).orderBy(block).rowsBetween(-n, -1)
    return blocks.withColumn("context", F.collect_list(content).over(w))


def first_missing(blocks: DataFrame, key: str, block: str) -> DataFrame:
    """The first missing number of each gap between a key's least and greatest block."""
    found = blocks.select(key, block).distinct()
    top = found.groupBy(key).agg(F.max(block).alias("_top"))
    behind = found.join(found.select(key, (F.col(block) - 1).alias(block)), [key, block], "left_anti")
    return behind.join(top, key).where(F.col(block) < F.col("_top")).select(key, (F.col(block) + 1).alias("missing_block"))


def all_missing(blocks: DataFrame, key: str, block: str) -> DataFrame:
    """Every missing number between a key's least and greatest block."""
    ends = blocks.groupBy(key).agg(F.min(block).alias("a"), F.max(block).alias("b"))
    spread = ends.select(key, F.explode(F.sequence("a", "b")).alias(block))
    return spread.join(blocks.select(key, block).distinct(), [key, block], "left_anti").withColumnRenamed(block, "missing_block")
