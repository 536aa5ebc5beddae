"""Jaccard self-join of documents on word n-grams, filtered under several global token orders.

Tokens are 64-bit hashes of word shingles. A global order puts tokens known to be frequent last
and orders the rest by a seeded hash; orders differ in the seed. If two sets are similar
enough, their prefixes (the first tokens, as many as can be missed, and one more) share a
token under every order. Any fixed order keeps this true, so the list of frequent tokens may
be incomplete and of bounded size without losing a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from notewright.llm.graph import components
from notewright.llm.shingles import WordHashes, free_prefix, give_back, mixed, shingle_set, texts_of
from notewright.operators.sizing import join_measured
from notewright.session import materialised, stored

SHINGLE, PERCENT = 4, 85
SEEDS = (11, 23, 47)
FREQUENT = 2_000_000  # tokens put last in the orders, at most
NEIGHBOURS = 3
_HASH_BITS = 48  # of a token's place in an order; the bits above are its rank


def class_key(found: np.ndarray) -> int | None:
    """Equal sets have equal keys; an empty set has none."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - 2**63 if len(found) else None


def least_overlap(size: int, percent: int = PERCENT) -> int:
    """What a set of ``size`` tokens shares at least with any set it links to."""
    return -(-percent * size // 100)


class Order:
    """A global order of tokens: (times seen as frequent, seeded hash)."""

    def __init__(self, seed: int):
        self.seed = np.uint64(seed)

    def prefix(self, found: np.ndarray, ranks: np.ndarray, percent: int = PERCENT, in_order: bool = False) -> np.ndarray:
        """The first tokens of a set, one more than a linked set can lack. ``ranks`` are those of ``Frequent``."""
        length = len(found) - least_overlap(len(found), percent) + 1
        place = (ranks << np.uint64(_HASH_BITS)) | (mixed(found ^ self.seed) >> np.uint64(64 - _HASH_BITS))
        if length == len(found):
            first = np.arange(length)
        else:
            first = np.argpartition(place, length - 1)[:length]
        return found[first[np.lexsort((found[first], place[first]))]] if in_order else found[first]


class Frequent:
    """Tokens known to be frequent and how often they were seen. A table of flags spares most others the search."""

    def __init__(self, tokens: np.ndarray, seen: np.ndarray):
        at = np.argsort(tokens)
        self.tokens, self.seen = tokens[at], np.minimum(seen[at], 2**16 - 1).astype(np.uint16)
        self.flags: np.ndarray | None = None

    def ranks(self, found: np.ndarray) -> np.ndarray:
        ranks = np.zeros(len(found), np.uint64)
        if len(self.tokens):
            if self.flags is None:  # made where it is used, so that it need not travel
                self.flags = np.zeros(1 << 24, bool)
                self.flags[self.tokens >> np.uint64(40)] = True
            likely = np.flatnonzero(self.flags[found >> np.uint64(40)])
            at = np.searchsorted(self.tokens, found[likely])
            at[at == len(self.tokens)] = 0
            ranks[likely] = np.where(self.tokens[at] == found[likely], self.seen[at], 0)
        return ranks


def _frequent(facts: DataFrame) -> Frequent:
    """All tokens seen often enough for the list to hold at most ``FREQUENT`` of them."""
    seen = materialised(facts.filter("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")))
    most = 4096
    by_times = seen.groupBy(F.least("seen", F.lit(most)).cast("int").alias("times")).agg(F.count(F.lit(1)).alias("tokens"))
    held, bound = 0, most + 1
    for row in sorted(by_times.collect(), reverse=True):
        held += row.tokens
        if held > FREQUENT:
            break
        bound = row.times
    rows = seen.filter(F.col("seen") >= bound).toArrow()
    tokens, times = (rows.column(name).to_numpy() for name in ("token", "seen"))
    return Frequent(tokens.view(np.uint64), times)


class Candidate:
    """A set with its prefix under every order."""

    def __init__(self, found: np.ndarray, frequent: Frequent | None, percent: int):
        self.found, self.prefixes = found, []
        if frequent is not None:
            ranks = frequent.ranks(found)
            self.prefixes = [Order(seed).prefix(found, ranks, percent) for seed in SEEDS]


def _meet(a: np.ndarray, b: np.ndarray) -> int:
    """How many members two sets share."""
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def linked(a: Candidate, b: Candidate, percent: int = PERCENT) -> bool:
    """Whether two sets link: sizes, then a shared prefix token under every order, then the exact count."""
    m, n = len(a.found), len(b.found)
    if percent * max(m, n) > 100 * min(m, n) or not all(map(_meet, a.prefixes, b.prefixes)):
        return False
    shared = _meet(a.found, b.found)
    return 100 * shared >= percent * (m + n - shared)


def _facts(docs: DataFrame, shingle: int) -> DataFrame:
    """Rows of two kinds: (doc_id, mark, n, key) of every document, and (token, seen) of tokens that several sets of a batch share.

    ``mark`` is the hash of the text, ``n`` the size and ``key`` the class of its set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            keys, sizes, once = [], [], {}
            for text in texts_of(batch.column(2)):
                found = shingle_set(text, shingle, cache)
                keys.append(class_key(found))
                sizes.append(len(found))
                if len(found):
                    once[keys[-1]] = found
            several, seen = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            if once:
                tokens = np.concatenate(list(once.values()))
                once.clear()
                tokens.sort()
                several, seen = np.unique(tokens[1:][tokens[1:] == tokens[:-1]], return_counts=True)
                seen = seen + 1
            tail = [None] * len(several)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.concat_arrays([batch.column(k), pa.nulls(len(several), pa.int64())]) for k in (0, 1)),
                    pa.array([*sizes, *tail], pa.int64()),
                    pa.array([*keys, *tail], pa.int64()),
                    pa.concat_arrays([pa.nulls(len(keys), pa.int64()), pa.array(several.view(np.int64))]),
                    pa.concat_arrays([pa.nulls(len(keys), pa.int64()), pa.array(seen)]),
                ],
                ["doc_id", "mark", "n", "key", "token", "seen"],
            )
        cache.clear()
        give_back()

    marked = docs.select("doc_id", _mark().alias("mark"), "text")
    return marked.mapInArrow(run, "doc_id long, mark long, n long, key long, token long, seen long")


def _postings(docs: DataFrame, frequent: Frequent, shingle: int, percent: int) -> DataFrame:
    """(token, key, n, at): the prefix in the first order of every class of equal sets; copies within a batch give theirs once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, order = WordHashes(), Order(SEEDS[0])
        for batch in batches:
            seen, parts, keys, sizes = set(), [], [], []
            for text in texts_of(batch.column(0)):
                found = shingle_set(text, shingle, cache)
                key = class_key(found)
                if key is not None and key not in seen:
                    seen.add(key)
                    parts.append(order.prefix(found, frequent.ranks(found), percent, in_order=True))
                    keys.append(key)
                    sizes.append(len(found))
            lengths = [len(p) for p in parts]
            tokens = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tokens.view(np.int64)),
                    pa.array(np.repeat(np.array(keys, np.int64), lengths)),
                    pa.array(np.repeat(np.array(sizes, np.int32), lengths)),
                    pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths] or [np.zeros(0, np.int32)])),
                ],
                ["token", "key", "n", "at"],
            )
        cache.clear()
        give_back()

    return docs.select("text").mapInArrow(run, "token long, key long, n int, at int")


def _verified(
    pairs: DataFrame, docs: DataFrame, facts: DataFrame, frequent: Frequent | None, shingle: int, percent: int
) -> DataFrame:
    """Those of the candidate pairs (a, b) of class keys that link; the orders' filters apply where ``frequent`` is given.

    One text of each class that is in a pair is fetched, by the hash of the text. The texts of
    ``a`` are joined last, so each pair moves one text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        held: tuple = (None, None)
        for batch in batches:
            keep = []
            for k, (a, text_b) in enumerate(zip(batch.column(0).to_pylist(), texts_of(batch.column(3)), strict=True)):
                if held[0] != a:
                    held = (a, Candidate(shingle_set(batch.column(2)[k].as_py(), shingle, cache), frequent, percent))
                other = Candidate(shingle_set(text_b, shingle, cache), frequent, percent)
                keep.append(linked(held[1], other, percent))
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(chosen), batch.column(1).filter(chosen)], ["a", "b"])
        cache.clear()
        give_back()

    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    one = facts.filter("key is not null").groupBy("key").agg(F.min("mark").alias("mark"))
    wanted = materialised(one.join(ends, "key", "left_semi"))
    marked = docs.select(_mark().alias("mark"), "text")
    texts = join_measured(marked, wanted.select("mark").distinct(), "mark", "left_semi").dropDuplicates(["mark"])
    for end in ("a", "b"):
        pairs = pairs.join(wanted.select(F.col("key").alias(end), F.col("mark").alias(f"mark_{end}")), end)
    # Texts are dealt by their marks once; the pairs come to them, last to those of ``a``.
    members = pairs.join(texts.select(F.col("mark").alias("mark_b"), F.col("text").alias("text_b")), "mark_b")
    both = members.join(texts.select(F.col("mark").alias("mark_a"), F.col("text").alias("text_a")), "mark_a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _mark() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _possible(small: str, large: str, percent: int) -> str:
    """Condition on a prefix token that two sets share: sizes near enough, and enough tokens left from here on in both.

    It holds for the first token that linked sets share, as they share none before it.
    """
    needed = f"{percent}L * ({small}.n + {large}.n)"
    left = " and ".join(f"{100 + percent}L * ({x}.n - {x}.at) >= {needed}" for x in (small, large))
    return f"{percent}L * {large}.n <= 100L * {small}.n and {left}"


def links(docs: DataFrame, facts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (a, b) of class keys that link, enough of them to connect all classes that links connect."""
    frequent = _frequent(facts)
    return connect(_postings(docs, frequent, shingle, percent), docs, facts, frequent, shingle, percent)


def connect(
    postings: DataFrame, docs: DataFrame, facts: DataFrame, frequent: Frequent | None, shingle: int, percent: int
) -> DataFrame:
    """Links (a, b) among the classes that share a token of ``postings`` (token, key, n, at).

    First every class of a prefix token is compared with the least of those of about its size
    (a star) and with ``NEIGHBOURS`` others next to it in an order drawn for the token: a few
    pairs per class, not all, and enough to connect most groups of near copies. Then only pairs
    of classes that share a prefix token and are still in different components are compared. All other pairs
    either share no prefix token, and cannot link, or are connected already.
    """
    shared = "count(1) over (partition by token)"
    postings = stored(postings.withColumn("many", F.expr(shared)).filter("many > 1").drop("many"), "shared-postings")
    step = log(100 / percent)
    bucket = F.floor(F.log(F.col("n").cast("double")) / step + 1e-9)
    bucketed = postings.withColumn("bucket", F.explode(F.array(bucket, bucket + 1))).withColumn("own", F.struct("n", "key", "at"))
    drawn = "over (partition by token, bucket order by xxhash64(key, token), key)"
    others = [F.expr("min(own) over (partition by token, bucket)")]
    others += [F.expr(f"lag(own, {k}) {drawn}") for k in range(1, NEIGHBOURS + 1)]
    met = bucketed.withColumn("others", F.array(*others)).select("own", F.explode(F.array_compact("others")).alias("other"))
    met = met.select(F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    stars = materialised(
        met.filter(f"x.key <> y.key and {_possible('x', 'y', percent)}")
        .select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
        .distinct()
    )
    first = materialised(_verified(stars, docs, facts, frequent, shingle, percent))
    labels = components(first)
    labelled = postings.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key")
    )
    apart = labelled.withColumn("least", F.expr("min(component) over (partition by token)")).withColumn(
        "most", F.expr("max(component) over (partition by token)")
    )
    # Where two rows share one of the few tokens before this one, the pair is already taken there.
    earlier = "collect_list(token) over (partition by key order by at, token rows between 8 preceding and 1 preceding)"
    apart = apart.filter("least < most").select("token", "key", "n", "at", "component", F.expr(earlier).alias("earlier"))
    apart = stored(apart, "prefix-apart")
    if apart.isEmpty():
        return first
    x, y = apart.alias("x"), apart.alias("y")
    ordered = "(x.n < y.n or x.n = y.n and x.key < y.key)"
    on = (
        f"x.token = y.token and x.component <> y.component and {ordered} and {_possible('x', 'y', percent)} "
        "and not arrays_overlap(x.earlier, y.earlier)"
    )
    rest = x.join(y, F.expr(on)).select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()
    rest = materialised(rest.join(stars, ["a", "b"], "left_anti"))
    return first.unionByName(_verified(rest, docs, facts, frequent, shingle, percent))


def _placed(docs: DataFrame, shingle: int, percent: int, find=links) -> tuple[DataFrame, DataFrame]:
    """Rows with words as (doc_id, n_shingles, key, component, component_id), and the others as (doc_id, n_shingles)."""
    facts = stored(_facts(docs, shingle), "shingle-facts")
    rows = facts.filter("n is not null").select("doc_id", F.col("n").alias("n_shingles"), "key")
    found = components(materialised(find(docs, facts, shingle, percent)))
    placed = rows.filter("key is not null").join(found.withColumnRenamed("node", "key"), "key", "left")
    placed = placed.withColumn("component", F.coalesce("component", "key"))
    names = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    # A group may hold a third of all rows, so its rows stay where they are if the names can come to them.
    return join_measured(placed, names, "component"), rows.filter("key is null").drop("key")


def _of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def join_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, find=links
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``; ``find`` tells which classes of equal sets link.

    Rows link when 100 * intersection >= percent * union of their shingle sets; component_id is the smallest doc_id
    that links reach. Null and empty texts and texts without words have an empty set, link with
    nothing, and keep their own id; equal sets always link, so repeated rows share a component;
    a text of fewer words than a shingle is one shingle. An empty table gives no rows; other
    columns are ignored.
    """
    placed, alone = _placed(_of(docs, id_col, text_col), shingle, percent, find)
    alone = alone.withColumn("component_id", F.col("doc_id"))
    return placed.select("doc_id", "n_shingles", "component_id").unionByName(alone)


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each group of linked rows, that with the smallest id; same columns.

    Where several rows of a group have that id, the one with the least text stays. Rows
    without words are in no group and stay, and so do rows without an id.
    """
    placed, _ = _placed(_of(docs, id_col, text_col), shingle, percent)
    placed = placed.filter("doc_id is not null").select("doc_id", "key", "component", "component_id")
    placed = stored(placed, "placed-rows")
    several = placed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc_id")
    gone = placed.filter("doc_id <> component_id").select("doc_id").unionByName(several).distinct()
    own = free_prefix([*docs.columns])
    own_id, own_key = f"{own}id", f"{own}key"
    marked = docs.withColumn(own_id, F.col(id_col).cast("long"))
    kept = join_measured(marked, gone.withColumnRenamed("doc_id", own_id), own_id, "left_anti")
    # Ids on several rows are rare; their rows are told apart by their texts' sets.
    again = join_measured(marked, several.withColumnRenamed("doc_id", own_id), own_id, "left_semi")
    keyed = _keyed(again, text_col, shingle, own_key)
    parts = placed.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id", "key"])
    names = {"doc_id": own_id, "key": own_key, "component": f"{own}component", "component_id": f"{own}first"}
    told = keyed.join(parts.select(*[F.col(old).alias(new) for old, new in names.items()]), [own_id, own_key], "left")
    order = f"row_number() over (partition by `{own_id}`, `{own}component` order by `{text_col}`)"
    told = told.withColumn(f"{own}nth", F.expr(order))
    chosen = told.filter(f"`{own_key}` is null or (`{own}nth` = 1 and `{own_id}` = `{own}first`)")
    columns = [f"`{name}`" for name in docs.columns]
    return kept.select(*columns).unionByName(chosen.select(*columns))


def _keyed(docs: DataFrame, text_col: str, shingle: int, into: str) -> DataFrame:
    """``docs`` with ``into``, the class of each text; null without words."""
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            keys = [class_key(shingle_set(text, shingle, cache)) for text in texts_of(batch.column(text_at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, into])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, LongType())]))
