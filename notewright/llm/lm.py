"""Hierarchical Pitman-Yor language model with Chinese-restaurant seating sampled by Gibbs.

A token is a word or the end of its text; its context is the word before it. Every preceding
word has a restaurant of its own, so their number grows with the corpus. Their parents are 512
restaurants for the last three characters of the word before (16 hashed classes for each of 32
classes of its last character), whose parents are 32 restaurants for the last character, whose
parent is the restaurant of no context. Its base gives half to any unknown word and the rest
evenly to the known ones.

The number of class restaurants is fixed, so what a word has in all of them is one bounded row,
and what its seating needs of other words are just the restaurants' totals. Seating there is
sampled word by word, in parallel, given the totals; the totals are then added up over all words
and the next round runs with them. Preceding words stay rows: customers and tables of each
(preceding word, word) and totals of each preceding word are tables that are joined in. A pair
seen once has one table, so only pairs seen more often are drawn. Words are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm.shingles import texts_of
from notewright.session import Scratch

CLASSES, PER_CLASS = 32, 16
CONTEXTS = CLASSES * PER_CLASS
UNKNOWN_SHARE = 0.5
STRENGTH = 1.0
EXACT = 64  # customers up to which a dish's number of tables is drawn from its exact conditional
BURN_IN, SAMPLES = 2, 4
HOT_WORDS = 8192  # words after the word before them that are most frequent; their probabilities go to every task
_BEGIN, _END = b" begin", b" end"  # no words, as they hold a space
_MOST_WORDS = 200_000


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def context_of(word: bytes) -> int:
    """Context a word sets for the next token: the class of its last byte, and within it one of its last three characters."""
    if word == _BEGIN:
        return CONTEXTS - 1
    last = word[-1]
    if 97 <= last <= 122:
        kind = last - 97
    elif last in b".,":
        kind = 26 if last == 46 else 27
    else:
        kind = 30 if last > 127 else 29 if 48 <= last <= 57 else 28
    tail = word.decode("utf-8", "surrogatepass")[-3:].encode("utf-8", "surrogatepass")
    return kind * PER_CLASS + xxhash.xxh32_intdigest(tail) % PER_CLASS


class Tokens(dict):
    """Numbers words as they come; the numbers lead to hashes and contexts. Forgets all between batches once it is large."""

    def __init__(self):
        super().__init__()
        self._clear()

    def _clear(self) -> None:
        self.clear()
        self.hashes: list[int] = []
        self.contexts: list[int] = []
        self.end, self.begin = self[_END], self[_BEGIN]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        self.contexts.append(context_of(word))
        return number

    def of(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the tokens of all texts and of the words before them, hashes and contexts by number, and tokens of each text."""
        if len(self) > _MOST_WORDS:
            self._clear()
        parts, sizes = [], []
        for text in texts:
            found = (text or "").encode("utf-8", "surrogatepass").lower().split()
            parts.append(np.fromiter(map(self.__getitem__, found), np.int32, len(found)))
            parts.append(np.array([self.end], np.int32))
            sizes.append(len(found) + 1)
        numbers, sizes = np.concatenate(parts), np.array(sizes)
        before = np.empty(len(numbers), np.int32)
        before[1:] = numbers[:-1]
        before[np.cumsum(sizes) - sizes] = self.begin
        return numbers, before, np.array(self.hashes, np.uint64), np.array(self.contexts, np.int16), sizes


def pair_counts(docs: DataFrame) -> DataFrame:
    """(w, v, x, c): how often word w of ``docs`` (one text column) follows word v, and the context that v sets.

    Each task adds up its own batches first, so hot pairs bring a few rows per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, before, hashes, contexts, _ = tokens.of(texts_of(batch.column(0)))
            pairs = numbers.astype(np.int64) * len(hashes) + before
            del numbers, before
            pairs.sort()
            first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
            counts, pairs = np.diff(np.append(first, len(pairs))), pairs[first]
            word, before = pairs // len(hashes), pairs % len(hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(hashes[word])), pa.array(_signed(hashes[before])), pa.array(contexts[before]), pa.array(counts)],
                ["w", "v", "x", "c"],
            )

    return docs.mapInArrow(run, "w long, v long, x short, c long").groupBy("w", "v", "x").agg(F.sum("c").alias("c"))


def class_counts(pairs: DataFrame, drawn: DataFrame | None = None) -> DataFrame:
    """(w, n, seats): how often every word occurs, and its customers in each context: the tables of the pairs below.

    A pair has one table, and those beyond it that ``drawn`` tells.
    """
    rows = pairs.select("w", "x", "c", F.lit(1).cast("long").alias("t"))
    if drawn is not None:
        rows = rows.unionByName(drawn.filter("t > 1").select("w", "x", F.lit(0).cast("long").alias("c"), (F.col("t") - 1).alias("t")))
    return (
        rows.groupBy("w", "x")
        .agg(F.sum("c").alias("n"), F.sum("t").alias("c"))
        .groupBy("w")
        .agg(F.sum("n").alias("n"), F.collect_list(F.struct("x", "c")).alias("seats"))
    )


def stirling_logs(discount: float, most: int = EXACT) -> np.ndarray:
    """Logs of generalised Stirling numbers: ways to seat n customers at t tables, weighted by the discount."""
    table = np.zeros((most + 1, most + 1))
    table[1, 1] = 1.0
    for n in range(1, most):
        t = np.arange(1, n + 2)
        table[n + 1, t] = table[n, t - 1] + (n - discount * t) * table[n, t]
    with np.errstate(divide="ignore"):
        return np.log(table)


def draw_tables(customers: np.ndarray, ratio: np.ndarray, discount: float, logs: np.ndarray, rng) -> np.ndarray:
    """Tables of each (restaurant, dish) given its customers and ``ratio``, the weight of a new table for the dish.

    Up to ``EXACT`` customers this is a draw from the conditional of the number of tables t,
    proportional to Stirling(customers, t) * ratio**t: a Gibbs step that reseats all customers of
    the dish at once. Further customers are seated in turn, in growing groups that see the same
    tables.
    """
    tables = np.ones(len(customers), np.int64)
    seated = np.minimum(customers, EXACT)
    for n in range(2, EXACT + 1):
        rows = np.flatnonzero(seated == n)
        if not len(rows):
            continue
        t = np.arange(1, n + 1)
        weight = logs[n, 1 : n + 1] + np.log(ratio[rows])[:, None] * t
        weight = np.exp(weight - weight.max(axis=1, keepdims=True)).cumsum(axis=1)
        tables[rows] = 1 + (weight < rng.random(len(rows))[:, None] * weight[:, -1:]).sum(axis=1)
    rows = np.flatnonzero(customers > EXACT)
    at = np.full(len(rows), EXACT)
    while len(rows):
        group = np.minimum(np.maximum(at // 16, 1), customers[rows] - at)
        new = ratio[rows] / (at - discount * tables[rows] + ratio[rows])
        tables[rows] += rng.binomial(group, new)
        at = at + group
        left = at < customers[rows]
        rows, at = rows[left], at[left]
    return tables


@dataclass
class Totals:
    """What all words add up to: types, tokens, and per level the tables and customers of each restaurant."""

    types: float
    tokens: float
    tables: tuple[np.ndarray, np.ndarray, np.ndarray]  # no context, classes, contexts
    customers: tuple[np.ndarray, np.ndarray, np.ndarray]
    discounts: tuple[float, float, float]

    def backoff(self, level: int) -> np.ndarray:
        """Probability of a new table in each restaurant of a level."""
        d = self.discounts[level]
        return (STRENGTH + d * self.tables[level]) / (STRENGTH + self.customers[level])

    def unknown(self) -> float:
        """Probability of any unknown word without context."""
        return float(self.backoff(0)[0]) * UNKNOWN_SHARE


class Seating:
    """The restaurants of a batch of words: leaves (word, context), branches (word, class) and roots (word)."""

    def __init__(self, word: np.ndarray, context: np.ndarray, customers: np.ndarray, words: int):
        self.word, self.context, self.customers, self.words = word, context, customers, words
        keys, self.branch = np.unique(word * CLASSES + context // PER_CLASS, return_inverse=True)
        self.branch_word, self.branch_class = keys // CLASSES, keys % CLASSES
        self.leaf_tables = np.ones(len(word), np.int64)
        self.branch_tables = np.ones(len(keys), np.int64)
        self.root_tables = np.ones(words, np.int64)

    def up(self) -> tuple[np.ndarray, np.ndarray]:
        """Customers of branches and roots: the tables of the restaurants below."""
        branch = np.bincount(self.branch, self.leaf_tables, len(self.branch_tables)).astype(np.int64)
        return branch, np.bincount(self.branch_word, self.branch_tables, self.words).astype(np.int64)

    def predictive(self, totals: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of each root's, branch's and leaf's word in its restaurant."""
        branch, root = self.up()
        d0, d1, d2 = totals.discounts
        base = (1 - UNKNOWN_SHARE) / max(totals.types, 1)
        p0 = (root - d0 * self.root_tables) / (STRENGTH + totals.customers[0][0]) + totals.backoff(0)[0] * base
        p1 = (branch - d1 * self.branch_tables) / (STRENGTH + totals.customers[1][self.branch_class])
        p1 = p1 + totals.backoff(1)[self.branch_class] * p0[self.branch_word]
        p2 = (self.customers - d2 * self.leaf_tables) / (STRENGTH + totals.customers[2][self.context])
        return p0, p1, p2 + totals.backoff(2)[self.context] * p1[self.branch]

    def sweep(self, totals: Totals, logs: tuple[np.ndarray, np.ndarray, np.ndarray], rng) -> None:
        """Reseat all customers, from the leaves to the roots."""
        p0, p1, _ = self.predictive(totals)
        weight = [STRENGTH + d * t for d, t in zip(totals.discounts, totals.tables, strict=True)]
        self.leaf_tables = draw_tables(
            self.customers, weight[2][self.context] * p1[self.branch], totals.discounts[2], logs[2], rng
        )
        branch, _ = self.up()
        self.branch_tables = draw_tables(
            branch, weight[1][self.branch_class] * p0[self.branch_word], totals.discounts[1], logs[1], rng
        )
        _, root = self.up()
        base = (1 - UNKNOWN_SHARE) / max(totals.types, 1)
        self.root_tables = draw_tables(root, np.full(self.words, weight[0][0] * base), totals.discounts[0], logs[0], rng)

    def added(self) -> np.ndarray:
        """This batch's part of the totals as one vector: see ``_totals``."""
        branch, root = self.up()
        few = [np.sum(n == k) for n in (root, branch, self.customers) for k in (1, 2)]
        return np.concatenate(
            [
                [self.words, self.customers.sum(), self.root_tables.sum()],
                few,
                np.bincount(self.branch_class, self.branch_tables, CLASSES),
                np.bincount(self.context, self.leaf_tables, CONTEXTS),
                np.bincount(self.context, self.customers, CONTEXTS),
            ]
        ).astype(np.float64)


def _totals(v: np.ndarray, discounts: tuple[float, float, float] | None = None) -> Totals:
    """Totals from the added-up vectors; customers of a restaurant are the tables of those below it.

    Discounts are n1 / (n1 + 2 n2) of the customers one by one and two by two, kept from the first round on.
    """
    if discounts is None:
        discounts = tuple(float(np.clip(v[k] / max(v[k] + 2 * v[k + 1], 1), 0.05, 0.95)) for k in (3, 5, 7))
    classes, contexts, customers = v[9 : 9 + CLASSES], v[9 + CLASSES : 9 + CLASSES + CONTEXTS], v[-CONTEXTS:]
    above = contexts.reshape(CLASSES, PER_CLASS).sum(axis=1)
    return Totals(v[0], v[1], (v[2:3], classes, contexts), (np.array([classes.sum()]), above, customers), discounts)


def _seatings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Seating]]:
    for batch in batches:
        if batch.num_rows:
            seats = batch.column(2)
            flat = seats.flatten()
            word = np.repeat(np.arange(batch.num_rows), np.diff(seats.offsets.to_numpy()))
            context = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield batch.column(0).to_numpy(), Seating(word, context, flat.field(1).to_numpy(zero_copy_only=False), batch.num_rows)


def _add_up(counts: DataFrame, totals: Totals | None) -> Totals:
    """Totals over all words: of one table per dish at first, then of the mean over the samples of a round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for words, seating in _seatings(batches):
            drawn = [seating.added()] if totals is None else [s.added() for s in _samples(words, seating, totals)]
            part = np.mean(drawn, axis=0)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "v"])

    rows = counts.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    vector = np.zeros(9 + CLASSES + 2 * CONTEXTS)
    for row in rows:
        vector[row.k] = row.v
    return _totals(vector, totals.discounts if totals else None)


def _samples(words: np.ndarray, seating: Seating, totals: Totals) -> Iterator[Seating]:
    """The seating after each sweep past the burn-in. Draws depend on the words only, so a task that runs again repeats them."""
    rng = np.random.default_rng(int(words.view(np.uint64)[0]))
    logs = tuple(stirling_logs(d) for d in totals.discounts)
    for k in range(BURN_IN + SAMPLES):
        seating.sweep(totals, logs, rng)
        if k >= BURN_IN:
            yield seating


@dataclass
class Model:
    """Totals; the table of words: w, c, and log10 of the averaged probabilities, in no context, classes and contexts;

    the table of pairs: w, v, c, n (count of w) and log10 of the averaged probability of w after v; and the table of
    preceding words: v, customers, tables.
    """

    totals: Totals
    words: DataFrame
    pairs: DataFrame
    before: DataFrame
    discount: float

    def backoff(self) -> Column:
        """Probability of a new table after a preceding word, from its customers and tables."""
        return _backoff(self.discount)


_WORDS = "w long, c long, lp0 double, x1 array<short>, lp1 array<double>, x2 array<short>, lp2 array<double>"


def _backoff(discount: float) -> Column:
    return (STRENGTH + discount * F.col("tables")) / (STRENGTH + F.col("customers"))


def _words(counts: DataFrame, totals: Totals) -> DataFrame:
    """Log probabilities of all words, averaged over the samples of a round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, seating in _seatings([batch]):
                mean = None
                for sample in _samples(words, seating, totals):
                    p = sample.predictive(totals)
                    mean = p if mean is None else tuple(a + b for a, b in zip(mean, p, strict=True))
                p0, p1, p2 = (np.log10(p / SAMPLES) for p in mean)
                bounds = lambda owner, n=seating.words: pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
                listed = lambda owner, values: pa.ListArray.from_arrays(bounds(owner), pa.array(values))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(words),
                        batch.column(1),
                        pa.array(p0),
                        listed(seating.branch_word, seating.branch_class.astype(np.int16)),
                        listed(seating.branch_word, p1),
                        listed(seating.word, seating.context.astype(np.int16)),
                        listed(seating.word, p2),
                    ],
                    ["w", "c", "lp0", "x1", "lp1", "x2", "lp2"],
                )

    return counts.mapInArrow(run, _WORDS)


def _by_context(words: DataFrame) -> DataFrame:
    """(w, x, n, p): count of each word and its probability in each context that it has."""
    each = words.select("w", F.col("c").alias("n"), F.explode(F.arrays_zip("x2", "lp2")).alias("e"))
    return each.select("w", F.col("e.x2").alias("x"), "n", F.pow(F.lit(10.0), "e.lp2").alias("p"))


def draw_pairs(pairs: DataFrame, before: DataFrame, words: DataFrame, discount: float) -> DataFrame:
    """(w, v, x, c, t, mean): tables drawn for the pairs seen more than once, and their mean over the samples.

    Given the totals and the parents' probabilities, pairs do not depend on each other, so each
    draw is one from the exact conditional and needs no burn-in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = stirling_logs(discount)
        for batch in batches:
            if not batch.num_rows:
                continue
            w, v, customers, ratio = (batch.column(k).to_numpy() for k in (0, 1, 3, 4))
            rng = np.random.default_rng([int(w.view(np.uint64)[0]), int(v.view(np.uint64)[0])])
            drawn = [draw_tables(customers, ratio, discount, logs, rng) for _ in range(SAMPLES)]
            columns = [*batch.columns[:4], pa.array(drawn[-1]), pa.array(np.mean(drawn, axis=0))]
            yield pa.RecordBatch.from_arrays(columns, ["w", "v", "x", "c", "t", "mean"])

    ratio = ((STRENGTH + discount * F.col("tables")) * F.col("p")).alias("ratio")
    many = pairs.filter("c > 1").join(before.hint("merge"), "v").join(_by_context(words).hint("merge"), ["w", "x"])
    return many.select("w", "v", "x", "c", ratio).mapInArrow(run, "w long, v long, x short, c long, t long, mean double")


def fit(texts: DataFrame, rounds: int = 1) -> Model:
    """A model of one column of texts (null: empty). ``rounds`` of seating settle the totals before the one that is averaged.

    The classes are seated over one table for each pair first; pairs are drawn under their
    probabilities, and the classes are then seated again over the tables drawn.
    """
    scratch = Scratch(texts.sparkSession)
    stored = scratch.stored
    pairs = stored(pair_counts(texts), "lm-pairs")
    tokens, once, twice = pairs.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    discount = float(np.clip(once / max(once + 2 * twice, 1), 0.05, 0.95))
    alone = stored(pairs.groupBy("v").agg(F.sum("c").alias("customers"), F.count(F.lit(1)).cast("double").alias("tables")), "lm-before")
    counts = stored(class_counts(pairs), "lm-counts")
    drawn = stored(draw_pairs(pairs, alone, _words(counts, _add_up(counts, None)), discount), "lm-drawn")
    scratch.drop(counts)

    more = drawn.groupBy("v").agg(F.sum(F.col("mean") - 1).alias("more"))
    before = stored(
        alone.join(more, "v", "left").select("v", "customers", (F.col("tables") + F.coalesce("more", F.lit(0.0))).alias("tables")),
        "lm-before",
    )
    scratch.drop(alone)
    counts = stored(class_counts(pairs, drawn), "lm-counts")
    totals = _add_up(counts, None)
    for _ in range(rounds):
        totals = _add_up(counts, totals)
    words = stored(_words(counts, totals), "lm-words")
    scratch.drop(counts)

    seated = pairs.filter("c = 1").select("w", "v", "x", "c", F.lit(1.0).alias("mean"))
    seated = seated.unionByName(drawn.select("w", "v", "x", "c", "mean"))
    own = (F.col("c") - discount * F.col("mean")) / (STRENGTH + F.col("customers"))
    seen = (
        seated.join(before.hint("merge"), "v")
        .select("w", "v", "x", "c", own.alias("own"), _backoff(discount).alias("back"))
        .join(_by_context(words).hint("merge"), ["w", "x"])
        .select("w", "v", "c", "n", F.log10(F.col("own") + F.col("back") * F.col("p")).alias("lp"))
    )
    seen = stored(seen, "lm-seen")
    scratch.drop(pairs, drawn)
    return Model(replace(totals, tokens=float(tokens)), words, seen, before, discount)


def _pair_keys(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A 64-bit key of each word and the word before it."""
    return words.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (before.view(np.uint64) ^ np.uint64(0xD6E8FEB86659FD93))


def _hot(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (ascending), counts of the words and log10 probabilities of the most frequent pairs."""
    rows = model.pairs.filter("c > 1").orderBy(F.desc("c"), "w", "v").limit(HOT_WORDS).toArrow()
    keys = _pair_keys(rows.column("w").to_numpy(), rows.column("v").to_numpy())
    order = np.argsort(keys)
    return keys[order], rows.column("n").to_numpy()[order], rows.column("lp").to_numpy()[order]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row; the last is its text's log10 probability.

    Tokens of the most frequent pairs are scored where they are read, from a table of fixed
    size. The others move to their pair's row of the model; those whose pair was never seen go on to
    the row of the word before and to their word's row. Probabilities are added up
    per row of ``docs``; a row that tells the id and what was scored in place goes along. What met its pair is
    stored when this is called, so ``docs`` are read once. Null and empty
    texts are one end token; repeated rows are scored each for itself; an empty table gives no
    rows. Without training texts every token has the base's probability of an unknown word.
    """
    totals = model.totals
    hot_keys, hot_counts, hot_scores = _hot(model)
    spread = float(totals.tokens + totals.types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 36
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, before, hashes, contexts, sizes = tokens.of(texts_of(batch.column(1)))
            words = _signed(hashes)
            keys = _pair_keys(hashes[numbers], hashes[before])
            at = np.searchsorted(hot_keys, keys)
            at[at == len(hot_keys)] = 0
            hot = hot_keys[at] == keys if len(hot_keys) else np.zeros(len(keys), bool)
            owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            by_row = lambda values: np.bincount(owner[hot], values, len(sizes)).astype(np.float64)
            places = at[hot]
            scored = by_row(hot_scores[places])
            based = by_row(np.log10((hot_counts[places] + 1) / spread))
            known = by_row(np.ones(len(places)))
            rows = row + np.arange(len(sizes))
            row += len(sizes)
            cold = np.flatnonzero(~hot)
            nothing = pa.nulls(len(cold), info)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words[numbers[cold]]),
                    pa.array(words[before[cold]]),
                    pa.array(contexts[before[cold]]),
                    pa.array(rows[owner[cold]]),
                    nothing,
                ],
                names,
            )
            facts = pa.StructArray.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(known.astype(np.int64)), pa.array(based), pa.array(scored)],
                fields=list(info),
            )
            # Keys no word has, spread evenly, so that these rows meet no word and crowd no task.
            spare = _signed((rows.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays(
                [pa.array(spare), pa.array(spare), pa.array(np.full(len(sizes), -1, np.int16)), pa.array(rows), facts], names
            )

    names = ["w", "v", "x", "row", "info"]
    info = pa.struct(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]
    )
    moved = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "w long, v long, x short, row long, info struct<doc_id:bigint,n:bigint,known:bigint,base:double,score:double>"
    )
    b1 = F.lit(np.log10(totals.backoff(1)).tolist())
    b2 = F.lit(np.log10(totals.backoff(2)).tolist())
    listed = lambda xs, ps, x: F.get(ps, F.array_position(xs, x).cast("int") - 1)
    kind = F.floor(F.col("x") / PER_CLASS).cast("short")
    alone = F.coalesce("lp0", F.lit(float(np.log10(totals.unknown()))))
    in_class = F.coalesce(listed("x1", "lp1", kind), F.get(b1, kind.cast("int")) + alone)
    in_context = F.coalesce(listed("x2", "lp2", F.col("x")), F.get(b2, F.col("x").cast("int")) + in_class)
    # Stored, as Spark would run the tokens and their exchange anew for each of the two parts.
    met = moved.join(model.pairs.select("w", "v", "n", "lp").hint("merge"), ["w", "v"], "left")
    done = F.col("n").isNotNull() | F.col("info").isNotNull()
    met = met.select("row", "info", "n", "lp", *[F.when(~done, F.col(k)).alias(k) for k in ("w", "v", "x")])
    met = Scratch(docs.sparkSession).stored(met, "lm-met")
    based = lambda n: F.log10((n + 1) / F.lit(spread))
    seen = met.filter(done).select(
        "row",
        "info",
        F.coalesce("info.score", "lp").alias("score"),
        F.coalesce("info.base", based(F.col("n"))).alias("base"),
        F.coalesce("info.known", F.lit(1).cast("long")).alias("known"),
    )
    unseen = met.filter(~done).select("w", "v", "x", "row", "info")
    unseen = unseen.join(model.before.select("v", F.log10(model.backoff()).alias("back")).hint("merge"), "v", "left")
    unseen = unseen.join(model.words.hint("merge"), "w", "left").select(
        "row",
        "info",
        (F.coalesce("back", F.lit(0.0)) + in_context).alias("score"),
        based(F.coalesce("c", F.lit(0))).alias("base"),
        F.col("c").isNotNull().cast("long").alias("known"),
    )
    merged = seen.unionByName(unseen)
    return (
        merged.groupBy("row")
        .agg(
            F.max("info.doc_id").alias("doc_id"),
            F.max("info.n").alias("n_tokens"),
            F.sum("known").alias("n_known"),
            F.sum("base").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .drop("row")
    )
