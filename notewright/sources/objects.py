"""Distributed scan for JSON objects that are merely strung together.

Where objects may start and end anywhere (``}{``, several per line, junk between)
a split of a file cannot be read alone: whether a brace counts depends on what
came before it. The scan works in three steps, each over Spark's own file splits:

1. every split of a multi-split file is summarised for both possible starts
   (outside or inside a string): string state at its end and effect on the depth;
2. the summaries of a file, one small row per split, are folded into the true
   start of each split;
3. every split emits its complete objects, and the pieces of objects that cross a
   border are joined by a group-by on the object they belong to.

Files of a single split, the usual case, need only step 3.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.operators.sizing import BROADCAST_ROWS, is_small

ACCUMULATE = "accumulate"  # text since the last object belongs to the next one
TOLERANT = "tolerant"  # an object starts at its own brace, depth never drops below zero

_OUTSIDE = re.compile(r'["{}]')
_TO_STRING_END = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"')
_SPLIT = ["file_path", "block"]
_SUMMARY = (
    "file_path string, block bigint, exit_out boolean, shift_out int, floor_out int, ends_out array<int>, "
    "exit_in boolean, shift_in int, floor_in int, ends_in array<int>"
)
_STATE = (
    "file_path string, block bigint, in_string boolean, depth int, carry bigint, "
    "carry_closes boolean, rest_closes boolean"
)
_PIECE = "file_path string, ord bigint, block bigint, whole boolean, raw string"
_LAST_IN_SPLIT = (1 << 31) - 1


def order_key(block: int, index: int) -> int:
    """Order of an object inside its file; the same layout ``scan_lines`` uses for lines."""
    return ((block >> 12) << 31) | index


def _braces(line: str, in_string: bool) -> tuple[list[tuple[int, int]], bool]:
    """Positions and steps (+1/-1) of the braces that count, and the string state at line end."""
    found, at = [], 0
    while True:
        if in_string:
            end = _TO_STRING_END.match(line, at)
            if end is None:
                return found, True
            at, in_string = end.end(), False
        hit = _OUTSIDE.search(line, at)
        if hit is None:
            return found, False
        at = hit.end()
        mark = hit.group()
        if mark == '"':
            in_string = True
        else:
            found.append((at - 1, 1 if mark == "{" else -1))


class _Effect:
    """What a run of lines does to (string state, depth), for one assumed string state at its start."""

    def __init__(self, in_string: bool):
        self.in_string, self.shift, self.floor, self.ends = in_string, 0, 0, set()

    def add(self, line: str) -> None:
        found, self.in_string = _braces(line, self.in_string)
        for _, step in found:
            self.shift += step
            self.floor = max(self.floor + step, 0)
            if step < 0:
                self.ends.add(self.shift)

    def row(self) -> tuple:
        return self.in_string, self.shift, self.floor, sorted(self.ends)


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, Iterator[str]]]:
    """Lines grouped by split; the rows of a split are contiguous inside a task."""
    from itertools import groupby

    def rows():
        for batch in batches:
            yield from batch.itertuples(index=False)

    for _, run in groupby(rows(), key=lambda r: (r.file_path, r.block)):
        first = next(run)

        def lines(first=first, run=run):
            yield first.value.decode("utf-8", errors="ignore")
            for row in run:
                yield row.value.decode("utf-8", errors="ignore")

        yield first, lines()


def _summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [part.split()[0] for part in _SUMMARY.split(", ")]
    for first, lines in _runs(batches):
        outside, inside = _Effect(False), _Effect(True)
        for line in lines:
            outside.add(line)
            inside.add(line)
        yield pd.DataFrame([(first.file_path, first.block, *outside.row(), *inside.row())], columns=columns)


def _fold(mode: str):
    """Start state of each split of one file, from the summaries of its splits."""

    def fold(summaries: pd.DataFrame) -> pd.DataFrame:
        in_string, depth, carry = False, 0, None
        rows, closed = [], set()
        for s in summaries.sort_values("block").itertuples(index=False):
            exit_, shift, floor, ends = (
                (s.exit_in, s.shift_in, s.floor_in, s.ends_in)
                if in_string
                else (s.exit_out, s.shift_out, s.floor_out, s.ends_out)
            )
            ends_here = (depth > 0 or mode == ACCUMULATE) and -depth in set(ends)
            entry = (in_string, depth, carry)
            if ends_here and carry is not None:
                closed.add(carry)
            if mode == ACCUMULATE:
                next_depth = depth + shift
                carry = s.block if ends_here or carry is None else carry
            else:
                next_depth = max(depth + shift, floor)
                if depth == 0 or ends_here:
                    carry = s.block if next_depth > 0 else None
            in_string, depth = bool(exit_), int(next_depth)
            rows.append((s.file_path, s.block, *entry, carry))
        return pd.DataFrame(
            [(f, b, i, d, c, c in closed, rest in closed) for f, b, i, d, c, rest in rows],
            columns=[part.split()[0] for part in _STATE.split(", ")],
        ).astype({"carry": "Int64"})

    return fold


def _emit(mode: str, whole_wanted: bool):
    """Complete objects of each split, or else the pieces of objects crossing its borders."""

    def pieces_of(first, lines) -> Iterator[tuple]:
        known = first.depth is not None and not pd.isna(first.depth)
        in_string = bool(first.in_string) if known else False
        depth = int(first.depth) if known else 0
        carry = int(first.carry) if known and not pd.isna(first.carry) else None
        carry_closes = bool(first.carry_closes) if known else False
        rest_closes = bool(first.rest_closes) if known else False
        keep, index, taken = carry is None or carry_closes, 0, []
        for line in lines:
            found, in_string = _braces(line, in_string)
            start = 0
            for at, step in found:
                if mode == TOLERANT and step > 0 and depth == 0:
                    start, taken, carry, keep = at, [], None, True
                if mode == TOLERANT and step < 0 and depth == 0:
                    continue
                depth += step
                if step < 0 and depth == 0:
                    taken.append(line[start : at + 1])
                    if carry is None:
                        if whole_wanted:
                            yield first.file_path, order_key(first.block, index), first.block, True, "\n".join(taken)
                        index += 1
                    elif carry_closes and not whole_wanted:
                        yield first.file_path, order_key(carry, _LAST_IN_SPLIT), first.block, False, "\n".join(taken)
                    start, taken, carry, keep = at + 1, [], None, True
            if keep and (mode == ACCUMULATE or depth > 0):
                taken.append(line[start:])
        if rest_closes and not whole_wanted and (mode == ACCUMULATE or depth > 0):
            owner = first.block if carry is None else carry
            yield first.file_path, order_key(owner, _LAST_IN_SPLIT), first.block, False, "\n".join(taken)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [part.split()[0] for part in _PIECE.split(", ")]
        rows, size = [], 0
        for first, lines in _runs(batches):
            for row in pieces_of(first, lines):
                rows.append(row)
                size += len(row[-1])
                if size > 8_000_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    return emit


def _attach(text: DataFrame, states: DataFrame, how: str, max_rows: int) -> DataFrame:
    """Give each line the start state of its split, keeping the lines of a split in order."""
    if is_small(states, max_rows):
        return text.join(F.broadcast(states), _SPLIT, how)
    return text.join(states.hint("merge"), _SPLIT, how).sortWithinPartitions(*_SPLIT, "place")


def find_objects(
    text: DataFrame, large: DataFrame | None = None, mode: str = TOLERANT, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``(file_path, ord, raw)``: brace-matched candidates, not yet checked to be valid JSON.

    ``text`` holds lines as ``(file_path, block, place, partial, value)`` straight from a
    text scan, with ``value`` binary and ``partial`` telling a split from a whole file.
    ``large`` may hold the same for only those files that can have several splits.
    """
    large = text if large is None else large
    if mode not in (ACCUMULATE, TOLERANT):
        raise ValueError(f"unknown mode: {mode}")
    summaries = large.filter("partial").select(*_SPLIT, "value").mapInPandas(_summarise, _SUMMARY)
    states = summaries.groupBy("file_path").applyInPandas(_fold(mode), _STATE).persist(StorageLevel.MEMORY_AND_DISK)
    # One row per split of a large file: input bytes / spark.sql.files.maxPartitionBytes at most.
    if states.isEmpty():
        empty = [F.lit(None).cast(part.split()[1]).alias(part.split()[0]) for part in _STATE.split(", ")[2:]]
        return text.select("*", *empty).mapInPandas(_emit(mode, True), _PIECE).select("file_path", "ord", "raw")
    whole = _attach(text, states, "left", max_rows).mapInPandas(_emit(mode, True), _PIECE)
    crossing = _attach(large.filter("partial"), states, "inner", max_rows).mapInPandas(_emit(mode, False), _PIECE)
    joined = crossing.groupBy("file_path", "ord").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("block", "raw"))), lambda piece: piece["raw"]), "\n"
        ).alias("raw")
    )
    return whole.select("file_path", "ord", "raw").unionByName(joined)
