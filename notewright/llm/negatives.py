"""Hard negatives of anchors by exact inner product, found in STR-packed R-trees.

Rows are dealt by ranges of label and leading coordinates; each task sorts and tiles its share (sort-tile-recursive) into leaves
with their least bounding boxes and stores one tree a label. A box gives an interval of inner products for
any anchor. An anchor opens the leaves of a tree from the highest upper end down, leaves out those outside its
score windows, and stops where the upper end is strictly below its k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notewright.llm.shingles import give_back
from notewright.session import stored

TREE_ROWS = 8192  # rows of a tree at most (about: ranges are sampled)
LEAF_ROWS = 128
BLOCK_ROWS = 1024  # anchors that go through a tree together
TREES_OF_A_SLOT = 2  # trees that meet the same copy of an anchor block
ANCHORS_OF_A_GROUP = 4096  # anchors that meet the same copy of a tree
_TREE = "tree long, label long, ids binary, vectors binary, lows binary, highs binary, leaf_rows binary"
_ANY = (-(2**62), 2**62)  # the window that leaves nothing out


@dataclass(frozen=True)
class Shape:
    """Of the table: length of the longest vector, and the number types that hold components and scores exactly."""

    rows: int
    dims: int
    component: str
    score: str

    @property
    def lowest(self) -> float | int:
        return -np.inf if self.score == "f8" else np.iinfo(np.int64).min

    def matrix(self, held: bytes) -> np.ndarray:
        return np.frombuffer(held, self.component).reshape(-1, self.dims).astype(self.score)


def usable(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, label, vector) of whole numbers; rows with a null or non-finite part are left out."""
    scaled = F.transform(F.col(vector_col), lambda x: x.cast("double") * scale)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), scaled.alias("vector"))
    inside = F.forall("vector", lambda x: F.coalesce(F.abs(x) < 2.0**62, F.lit(False)))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & inside)
    return rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x).cast("long")))


def measure(rows: DataFrame) -> Shape:
    largest = F.coalesce(F.array_max(F.transform("vector", F.abs)), F.lit(0))
    count, dims, most = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(largest)).first()
    dims, most = max(1, dims or 1), most or 0
    component = next(t for t in ("i2", "i4", "i8") if most <= np.iinfo(t).max)
    bound = dims * most * most
    if bound >= _ANY[1]:
        raise ValueError("inner products of these vectors exceed a long")
    return Shape(count, dims, component, "f8" if bound < 2**53 else "i8")


def _tiles(vectors: np.ndarray, axes: int) -> Iterator[np.ndarray]:
    """Rows of each leaf: sort by the coordinate of the widest spread, cut into equal slabs, tile each slab along the next."""
    todo = [(np.arange(len(vectors)), axes)]
    while todo:
        rows, left = todo.pop()
        leaves = -(-len(rows) // LEAF_ROWS)
        if leaves <= 1:
            yield rows
            continue
        slabs = max(2, round(leaves ** (1 / max(1, left))))
        held = vectors[rows]
        order = rows[np.argsort(held[:, np.ptp(held, axis=0).argmax()], kind="stable")]
        size = -(-leaves // slabs) * LEAF_ROWS
        todo += [(order[at : at + size], left - 1) for at in range(0, len(order), size)]


def _padded(lists: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a column as a matrix, shorter ones with zeros behind."""
    sizes = np.diff(lists.offsets.to_numpy())
    found = np.zeros((len(lists), dims), np.int64)
    found[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return found


def pack_trees(rows: DataFrame, shape: Shape) -> DataFrame:
    """One row per tree: its label, its rows leaf by leaf, and the box of each leaf.

    Ranges end in the id, so a label or a vector that very many rows share is dealt to as many tasks as it fills.
    """
    parts = -(-max(1, shape.rows) // TREE_ROWS)
    dealt = rows.withColumns({f"__{k}": F.coalesce(F.get("vector", F.lit(k)), F.lit(0)) for k in (0, 1)})
    dealt = dealt.repartitionByRange(parts, "label", "__0", "__1", "id").select("id", "label", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        ids, labels, vectors = [], [], []
        for batch in batches:
            ids.append(batch.column(0).to_numpy())
            labels.append(batch.column(1).to_numpy())
            vectors.append(_padded(batch.column(2), shape.dims).astype(shape.component))
        if not ids:
            return
        all_ids, all_labels, all_vectors = np.concatenate(ids), np.concatenate(labels), np.concatenate(vectors)
        for label in np.unique(all_labels):
            of = np.flatnonzero(all_labels == label)
            own = all_vectors[of]
            axes = max(1, min(shape.dims, int(np.log2(max(2, len(of) / LEAF_ROWS)))))
            leaves = [of[t[np.argsort(all_ids[of[t]], kind="stable")]] for t in _tiles(own.astype(shape.score), axes)]
            order = np.concatenate(leaves)
            lows = np.stack([all_vectors[leaf].min(axis=0) for leaf in leaves])
            highs = np.stack([all_vectors[leaf].max(axis=0) for leaf in leaves])
            sizes = np.array([len(leaf) for leaf in leaves], np.int64)
            parts = (all_ids[order], all_vectors[order], lows, highs, sizes)
            columns = [pa.array([number]), pa.array([int(label)]), *(pa.array([x.tobytes()], pa.binary()) for x in parts)]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "label", "ids", "vectors", "lows", "highs", "leaf_rows"])
        give_back()

    return stored(dealt.mapInArrow(run, _TREE), "negatives-trees")


def _blocks(anchors: DataFrame, shape: Shape, windows: int) -> DataFrame:
    """Anchors (id, label, vector, and lows and highs of their windows) as blocks of one label, within their partitions.

    Sorting inside a partition brings equal labels together; nothing is moved for it.
    """

    def block(rows: list[tuple]) -> pa.RecordBatch:
        ids, vectors, lows, highs = (np.stack([r[k] for r in rows]) for k in (0, 2, 3, 4))
        parts = (ids.astype("i8"), vectors.astype(shape.component), lows.astype("i8"), highs.astype("i8"))
        columns = [pa.array([int(rows[0][1])]), *(pa.array([x.tobytes()], pa.binary()) for x in parts)]
        return pa.RecordBatch.from_arrays(columns, names=["anchor_label", "anchors", "anchor_vectors", "window_lows", "window_highs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            vectors = _padded(batch.column(2), shape.dims)
            bounds = [np.stack(batch.column(k).to_pylist()).reshape(-1, windows) for k in (3, 4)] if len(ids) else []
            for row in zip(ids, labels, vectors, *bounds, strict=True) if len(ids) else ():
                if held and (held[0][1] != row[1] or len(held) == BLOCK_ROWS):
                    yield block(held)
                    held = []
                held.append(row)
        if held:
            yield block(held)

    kinds = "anchor_label long, anchors binary, anchor_vectors binary, window_lows binary, window_highs binary"
    picked = anchors.select("id", "label", "vector", "lows", "highs").sortWithinPartitions("label")
    return picked.mapInArrow(run, kinds)


class Best:
    """The k best (score, id) of each window of each anchor met so far, highest score first, ties by the smaller id."""

    def __init__(self, anchors: int, windows: int, k: int, shape: Shape):
        self.k, self.lowest = k, shape.lowest
        self.scores = np.full((anchors, windows, k), shape.lowest, dtype=shape.score)
        self.ids = np.zeros((anchors, windows, k), np.int64)

    def kth(self) -> np.ndarray:
        return self.scores[:, :, -1]

    def add(self, anchors: np.ndarray, window: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` (anchors x rows) with the lowest value where a row does not count; ``ids`` ascend."""
        first = np.argsort(-scores, axis=1, kind="stable")[:, : self.k]
        new = np.concatenate((self.scores[anchors, window], np.take_along_axis(scores, first, 1)), axis=1)
        of = np.concatenate((self.ids[anchors, window], ids[first]), axis=1)
        order = np.lexsort((of, -new), axis=-1)[:, : self.k]
        self.scores[anchors, window] = np.take_along_axis(new, order, 1)
        self.ids[anchors, window] = np.take_along_axis(of, order, 1)


def search_tree(
    best: Best, anchors: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tree: tuple, same_label: bool, shape: Shape
) -> int:
    """Take a tree's rows into ``best``; returns how many pairs of anchor and leaf were opened.

    Every anchor has a queue of the tree's leaves by their upper ends. All anchors take the head of their queues at once,
    so that those that meet in a leaf share one matrix product; an anchor is done when no window wants its queue's next leaf.
    """
    anchor_ids, queries, lows, highs = anchors
    ids, vectors, box_lows, box_highs, ends = tree
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    upper = up @ box_highs.T + down @ box_lows.T
    lower = up @ box_lows.T + down @ box_highs.T
    queue = np.argsort(-upper, axis=1, kind="stable")
    alive, opened = np.arange(len(queries)), 0
    for turn in range(queue.shape[1]):
        head = queue[alive, turn]
        high, low = upper[alive, head][:, None], lower[alive, head][:, None]
        floor = np.maximum(best.kth()[alive], lows[alive])  # queues descend, so below this no later leaf counts either
        more = (high >= floor).any(axis=1)
        wanted = ((high >= floor) & (low <= highs[alive])).any(axis=1)
        takers, leaves = alive[more & wanted], head[more & wanted]
        for leaf in np.unique(leaves):
            who = takers[leaves == leaf]
            begin, end = ends[leaf], ends[leaf + 1]
            found = queries[who] @ vectors[begin:end].T
            opened += len(who)
            here = ids[begin:end]
            counts = here[None, :] != anchor_ids[who, None] if same_label else True
            least = np.maximum(best.kth()[who], lows[who])  # a row at the k-th score may still win by its id
            for window in range(lows.shape[1]):
                inside = (found >= least[:, window, None]) & (found <= highs[who, window, None]) & counts
                hit = inside.any(axis=1)
                if hit.any():
                    best.add(who[hit], window, np.where(inside[hit], found[hit], shape.lowest), here)
        alive = alive[more]
        if not len(alive):
            break
    return opened


def _search(
    blocks: DataFrame, trees: DataFrame, same_label: bool, k: int, windows: int, shape: Shape, anchors: int
) -> DataFrame:
    """(anchor, window, score, id): the best rows of each block copy; copies of an anchor are merged by the caller.

    Trees are dealt to slots and blocks to groups, a bounded number each; a block goes to every slot and a tree to every
    group. Blocks are the stated query set. They meet trees by slot and group (and label), so that no key has more
    than one slot's trees and one group's blocks, and a label that many rows have is no hot key.
    """
    parts = -(-max(1, shape.rows) // TREE_ROWS)
    slots, groups = -(-parts // TREES_OF_A_SLOT), -(-max(1, anchors) // ANCHORS_OF_A_GROUP)
    trees = trees.withColumn("slot", F.pmod("tree", F.lit(slots))).withColumn("group", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
    copies = blocks.withColumn("group", F.pmod(F.xxhash64("anchors"), F.lit(groups)))
    copies = copies.withColumn("slot", F.explode(F.expr(f"sequence(0L, {slots - 1}L)")))
    on = (copies["slot"] == trees["slot"]) & (copies["group"] == trees["group"])
    on = on & (copies["anchor_label"] == trees["label"]) if same_label else on & (copies["anchor_label"] != trees["label"])
    met = copies.join(trees.hint("merge"), on).select(
        "anchors", "anchor_vectors", "window_lows", "window_highs", "ids", "vectors", "lows", "highs", "leaf_rows"
    )

    def rows_of(best: Best, ids: np.ndarray) -> pa.RecordBatch:
        anchor, window, place = np.nonzero(best.scores > shape.lowest)
        values = (ids[anchor], window, best.scores[anchor, window, place].astype(np.int64), best.ids[anchor, window, place])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in values], names=["anchor", "window", "score", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Joined rows come block by block, so bounds found in one tree serve the next.
        at, best, block = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(c)[i].as_py() for c in range(9)]
                if row[:2] != at or best is None:
                    if best is not None:
                        yield rows_of(best, block[0])
                    at, ids = row[:2], np.frombuffer(row[0], "i8")
                    bounds = [np.frombuffer(x, "i8").reshape(-1, windows) for x in row[2:4]]
                    block = (ids, shape.matrix(row[1]), *bounds)
                    best = Best(len(ids), windows, k, shape)
                boxes = [shape.matrix(x) for x in row[5:8]]
                ends = np.concatenate(([0], np.cumsum(np.frombuffer(row[8], "i8"))))
                search_tree(best, block, (np.frombuffer(row[4], "i8"), *boxes, ends), same_label, shape)
        if best is not None:
            yield rows_of(best, block[0])
        give_back()

    return met.mapInArrow(run, "anchor long, window long, score long, id long")


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows of each key with their rank; a key has at most k rows from each slot."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = 256,
) -> DataFrame:
    """For each anchor and positive, the hardest rows of other labels within a window of the positive's score.

    Components become floor(scale * x); scores are their inner products, exact. Anchors are the rows where
    ``anchor`` (over ``rows``) holds. Positives are an anchor's first rows of the same label by score, ties by the smaller id; a
    negative has ``low_percent * positive <= 100 * negative <= high_percent * positive``.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score; an anchor without positives, or a pair
    without rows in its window, gives no rows. Rows with a null id, label or vector, or a null or non-finite component (after scaling, 2^62 and more
    included) take no part. Of vectors of unlike length the shorter one counts as filled with zeros. A repeated id: its least
    (label, vector) row is the anchor, rows of an anchor's own id are not its positives, and every other row counts for itself. An empty table or no
    anchor gives no rows. Other columns are ignored. Raises ValueError where products could exceed a long.
    """
    chosen = usable(rows.filter(F.coalesce(anchor, F.lit(False))), id_col, label_col, vector_col, scale)
    rows = usable(rows, id_col, label_col, vector_col, scale)
    shape = measure(rows)
    trees = pack_trees(rows, shape)
    chosen = chosen.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("__row"))
    chosen = stored(chosen.select("id", "__row.label", "__row.vector"), "negatives-anchors")
    search = partial(_search, trees=trees, shape=shape, anchors=chosen.count())
    open_window = {"lows": F.array(F.lit(_ANY[0]).cast("long")), "highs": F.array(F.lit(_ANY[1]).cast("long"))}
    found = search(_blocks(chosen.withColumns(open_window), shape, 1), same_label=True, k=positives, windows=1)
    pairs = _best(found, ["anchor"], positives).select(
        "anchor", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    pairs = stored(pairs, "negatives-pairs")
    low, high = (F.expr(x) for x in (_ceil("positive_score", low_percent), _floor("positive_score", high_percent)))
    bounds = pairs.withColumns({"low": low, "high": high}).groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("window", "low", "high"))).alias("x")  # at most ``positives`` of them
    )
    filled = bounds.select(
        F.col("anchor").alias("id"),
        *(
            F.array(*(F.coalesce(F.get("x", F.lit(i))[c], F.lit(d).cast("long")) for i in range(positives))).alias(name)
            for c, d, name in (("low", 1, "lows"), ("high", 0, "highs"))  # a window that is not there holds nothing
        ),
    )
    blocks = _blocks(chosen.join(filled, "id"), shape, positives)
    found = search(blocks, same_label=False, k=negatives, windows=positives)
    ranked = _best(found, ["anchor", "window"], negatives)
    return ranked.join(pairs, ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _floor(column: str, percent: int) -> str:
    """Whole part, downwards, of a percentage of a whole number, without leaving whole numbers."""
    product = f"(cast({column} as decimal(38, 0)) * {percent})"
    return f"cast(({product} - pmod({product}, 100)) / 100 as long)"


def _ceil(column: str, percent: int) -> str:
    product = f"(-cast({column} as decimal(38, 0)) * {percent})"
    return f"-cast(({product} - pmod({product}, 100)) / 100 as long)"
