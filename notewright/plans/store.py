"""A record store: records numbered and cut into slabs, an index of first places by id, and postings of character trigrams.

Below its folder lie ``records`` (a folder per slab of ``slab_rows`` places, so that a place names the file that holds it;
ids carry Bloom filters), ``ids`` (the first place of every id, sorted by id), ``slabs`` (rows of each slab) and, where asked
for, ``postings`` (trigram, place; sorted) with ``grams`` (in how many records each trigram occurs).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.functions.arguments import requested_fields, split_filters, within
from notewright.operators.numbering import number_sorted
from notewright.operators.search import Dataset, order_columns
from notewright.operators.sizing import join_measured
from notewright.session import materialised

SLAB_ROWS = 1 << 16
GRAMS_OF_A_NEEDLE = 4  # the rarest ones; more would read more postings to leave out few more records
MOST_SLABS = 1000  # slabs named in a filter; records in more of them are found by a scan


def trigrams(text: Column) -> Column:
    """Distinct runs of three characters, in lower case. A look-ahead keeps this linear in long texts."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(...))"), F.lit(1)))


def write_store(
    records: DataFrame, path: str, order: str | Sequence[str] = "ord", slab_rows: int = SLAB_ROWS, grams: bool = True
) -> None:
    """Write records as a store. ``order`` puts them in file order; equal places are broken arbitrarily but once for all."""
    spark = records.sparkSession
    numbered = number_sorted(records, [F.col(c) for c in order_columns(order)], "position")
    numbered = numbered.withColumn("slab", F.floor(F.col("position") / slab_rows).cast("long"))
    writer = numbered.repartition("slab").sortWithinPartitions("slab", "position").write.partitionBy("slab")
    writer.option("parquet.bloom.filter.enabled#id", "true").parquet(f"{path}/records")
    held = spark.read.parquet(f"{path}/records")
    firsts = held.filter("id IS NOT NULL").groupBy("id").agg(F.min("position").alias("position"))
    materialised(firsts).orderBy("id").write.parquet(f"{path}/ids")
    held.groupBy("slab").agg(F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/slabs")
    if grams:
        found = F.array_distinct(F.flatten(F.transform(F.map_values("text"), trigrams)))
        postings = held.select("position", F.explode(found).alias("gram"))
        postings.orderBy("gram", "position").write.parquet(f"{path}/postings")
        postings = spark.read.parquet(f"{path}/postings")
        counts = materialised(postings.groupBy("gram").agg(F.count(F.lit(1)).alias("records")))
        counts.orderBy("gram").write.parquet(f"{path}/grams")


@dataclass(frozen=True)
class StoredDataset(Dataset):
    """A dataset in a store. Answers are those of ``Dataset``; what differs is how much is read for them."""

    path: str = ""
    slab_rows: int = SLAB_ROWS
    grams: bool = True

    @property
    def spark(self) -> SparkSession:
        return self.records.sparkSession

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def at(self, positions: Sequence[int]) -> DataFrame:
        """Whole records at these places, in order; only the slabs that hold them are opened."""
        if not positions:
            return self.records.filter(F.lit(False))
        slabs = sorted({p // self.slab_rows for p in positions})
        found = self.records.filter(F.col("slab").isin(slabs) & F.col("position").isin(list(positions)))
        return found.orderBy("position")

    def _rarest(self, needles: Sequence[str]) -> list[list[str]] | None:
        """The trigrams to look up for each needle, the rarest first; None where one occurs in no record."""
        sets = [F.array_sort(trigrams(F.lit(n))).alias(f"n{i}") for i, n in enumerate(needles)]
        of_each = list(self.spark.range(1).select(*sets).first())
        every = sorted({g for grams in of_each for g in grams})
        if not every:
            return [[] for _ in needles]
        counts = {r["gram"]: r["records"] for r in self._table("grams").filter(F.col("gram").isin(every)).collect()}
        if any(g not in counts for g in every):
            return None
        return [sorted(grams, key=lambda g: (counts[g], g))[:GRAMS_OF_A_NEEDLE] for grams in of_each]

    def candidates(self, needles: Sequence[str]) -> DataFrame | None:
        """Places of the records that hold all looked up trigrams of all needles; None if no needle has three characters."""
        long = [n for n in needles if len(n) >= 3]
        if not long or not self.grams:
            return None
        chosen = self._rarest(long)
        if chosen is None:
            return self._table("postings").select("position").filter(F.lit(False))
        grams = sorted({g for of in chosen for g in of})
        if not grams:
            return None
        postings = self._table("postings").filter(F.col("gram").isin(grams))
        if len(grams) == 1:
            return postings.select("position")
        return postings.groupBy("position").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams)).select("position")

    def matching(self, query: str | None = None, filters: Mapping[str, Any] | None = None) -> DataFrame:
        """Records that meet all filters and the query: found by their trigrams, then verified by the filters themselves.

        Needles of fewer than three characters, and those whose records lie in more than ``MOST_SLABS`` slabs, are looked for in a scan.
        """
        texts, _ = split_filters(filters or {}, self.text_fields, self.metadata_fields)
        found = self.candidates([*texts.values(), *([query] if query else [])])
        exact = super().matching(query, filters)
        if found is None:
            return exact
        found = materialised(found)
        slab = F.floor(F.col("position") / self.slab_rows).cast("long").alias("slab")
        slabs = [r["slab"] for r in found.select(slab).distinct().limit(MOST_SLABS + 1).collect()]
        if len(slabs) > MOST_SLABS:
            return exact
        return join_measured(exact.filter(F.col("slab").isin(slabs)), found, "position", "left_semi", skewed=False)

    def search(
        self,
        query: str | None = None,
        filters: Mapping[str, Any] | None = None,
        fields: str | Sequence[str] | None = None,
        limit: int = 20,
        offset: int = 0,
    ) -> DataFrame:
        """Formatted records from ``offset`` on. Without conditions a page names its places; else the top-k is over places alone."""
        within("limit", limit, 1, 100)
        within("offset", offset, 0)
        wanted = requested_fields(fields, self.text_fields)
        if query or filters:
            page = self.matching(query, filters).select("position").orderBy("position").offset(offset).limit(limit)
            positions = [r["position"] for r in page.collect()]
        else:
            positions = list(range(offset, offset + limit))
        return self.formatted(self.at(positions), wanted)

    def page_info(self, page_size: int = 20, query: str | None = None, filters: Mapping[str, Any] | None = None) -> DataFrame:
        """One row: ``total`` and ``total_pages``; without conditions the slabs' row counts are added up."""
        if query or filters:
            return super().page_info(page_size, query, filters)
        within("page_size", page_size, 1, 100)
        total = F.coalesce(F.sum("rows"), F.lit(0))
        return self._table("slabs").agg(total.alias("total"), F.ceil(total / page_size).cast("bigint").alias("total_pages"))

    def full_record(self, record_id: str) -> DataFrame:
        """First record with exactly this id: its place from the index, then the one slab that holds it."""
        place = self._table("ids").filter(F.col("id") == record_id).first()
        return self.at([place["position"]] if place else [])

    def first_records(self) -> DataFrame:
        """The first record of every id, by the index."""
        return join_measured(self.records, self._table("ids").select("position"), "position", "left_semi", skewed=False)


def open_store(
    spark: SparkSession, path: str, name: str, text_fields: Sequence[str], metadata_fields: Sequence[str] = ("id", "sheet"),
    slab_rows: int = SLAB_ROWS, grams: bool = True,
) -> StoredDataset:
    """The dataset of a store, to be opened with the ``slab_rows`` and ``grams`` it was written with."""
    records = spark.read.parquet(f"{path}/records")
    return StoredDataset(records, name, text_fields, metadata_fields, "position", path, slab_rows, grams)
