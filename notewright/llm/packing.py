"""Cost-balanced packing of documents into training sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.bytebpe import ByteBpe, byte_bpe, read_vocabulary
from notewright.llm.shingles import give_back, texts_of
from notewright.session import small_batches

LINEAR_COST = 1.0
QUADRATIC_COST = 1.0 / 2048  # attention weighs as much as the linear layers at this length
SHARD_ROWS = 2000  # rows that are packed together at most
SHARD_TOKENS = 4_000_000  # and tokens, up to the row that reaches them
_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def balance(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Place pieces shorter than ``capacity`` into as few sequences as hold them: (piece, from, length, sequence, offset).

    The longest piece comes first; each goes to the sequence of the lowest estimated cost
    among those with room for it. A piece that fits nowhere is cut to fill the emptiest
    sequence and its rest is placed next, so all padding together is less than one sequence.
    Ties go to the earlier piece and the lower sequence.
    """
    total = int(lengths.sum())
    count = -(-total // capacity)
    used, cost = np.zeros(count, dtype=np.int64), np.zeros(count)
    placed = []
    for piece in np.argsort(-lengths, kind="stable"):
        begin, left = 0, int(lengths[piece])
        while left:
            open_cost = np.where(used + left <= capacity, cost, np.inf)
            at = int(open_cost.argmin())
            size = left
            if open_cost[at] == np.inf:
                at = int(used.argmin())
                size = capacity - int(used[at])
            placed.append((int(piece), begin, size, at, int(used[at])))
            used[at] += size
            cost[at] += linear * size + quadratic * size * size
            begin, left = begin + size, left - size
    return placed


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    linear: float = LINEAR_COST,
    quadratic: float = QUADRATIC_COST,
) -> DataFrame:
    """Sequences of at most ``capacity`` tokens that hold every token of every row once.

    A row's ids are those of its text (null: empty) and then ``end_id``. Runs of ``capacity``
    ids fill sequences of their own; what remains of each row is placed by ``balance`` among
    the same shard of ``SHARD_ROWS`` rows or ``SHARD_TOKENS`` tokens, so no row moves between tasks and each such
    shard is padded by less than one sequence. A shard spans Arrow batches, which are kept small. Sequence ids name
    the partition in their upper half, so a task that runs again gives the same ids.

    Returns one row per piece: doc_id, start (ids of the row before it), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id and offset within the sequence.
    An empty text gives one piece that holds the end id alone; repeated rows are packed each
    for itself, also under the same or a null id; an empty table gives no rows; other columns
    are ignored.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    vocabulary = read_vocabulary(vocabulary_path)
    small_batches(docs.sparkSession)

    def shards(batches: Iterator[pa.RecordBatch], encoder: ByteBpe) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
        doc_ids, ids, tokens = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                doc_ids.append(doc_id)
                ids.append(np.append(encoder.ids(text or ""), np.uint32(end_id)))
                tokens += len(ids[-1])
                if len(ids) == SHARD_ROWS or tokens >= SHARD_TOKENS:
                    yield doc_ids, ids
                    doc_ids, ids, tokens = [], [], 0
        if ids:
            yield doc_ids, ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        next_sequence = (context.partitionId() if context else 0) << 32
        for doc_ids, ids in shards(batches, byte_bpe(vocabulary)):
            sizes = np.array([len(x) for x in ids], dtype=np.int64)
            rows: list[tuple] = []  # of (row, start, length, sequence, offset)
            for row, whole in enumerate(sizes // capacity):
                rows += [(row, k * capacity, capacity, next_sequence + k, 0) for k in range(int(whole))]
                next_sequence += int(whole)
            rest = sizes % capacity
            rows += [
                (row, int(sizes[row] - rest[row]) + begin, size, next_sequence + at, offset)
                for row, begin, size, at, offset in balance(rest, capacity, linear, quadratic)
            ]
            next_sequence += int(-(-rest.sum() // capacity))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_ids[r[0]] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([ids[r[0]][r[1] : r[1] + r[2]].astype("<u4").tobytes() for r in rows], pa.binary()),
                    pa.array([int(sizes[r[0]]) for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.int64()),
                    pa.array([r[4] for r in rows], pa.int64()),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
        give_back()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, _SCHEMA)
