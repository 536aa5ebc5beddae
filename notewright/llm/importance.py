"""Importance resampling towards a target: hashed n-gram counts, weights of documents, and a draw without replacement.

A document's n-grams are never put together. Its words, joined by one space, are scanned
once and the running CRC at every word's start and end is kept. The CRC of any n-gram follows from two
of them: the start's is carried over the n-gram's bytes, a shift over GF(2), and cancelled from the end's.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import accumulate, chain, repeat
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm.shingles import give_back, texts_of
from notewright.operators.numbering import number_sorted
from notewright.session import stored

BUCKETS = 10_000
_POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, lowest bit first
_LENGTHS = 64  # shifts over fewer bytes have a table each; longer ones are put together from powers
_BLOCK = 1 << 20  # bytes of normalised text whose words are held at once


def _separators() -> bytes:
    """Byte map of the normal form: A-Z in lower case, every ASCII byte that is no letter or digit a space."""
    return bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


_NORMAL = _separators()


class Shifts:
    """Multiplication of CRCs by x^(8 n), that is by n zero bytes, for arrays of CRCs and of n."""

    def __init__(self) -> None:
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(_POLYNOMIAL), byte >> 1).astype(np.uint32)
        tables = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
        short = [np.stack(tables)]
        for _ in range(_LENGTHS):
            last = short[-1]
            short.append((last >> np.uint32(8)) ^ byte[last & np.uint32(255)])
        self.short = np.stack(short[:_LENGTHS])
        self.powers = [short[_LENGTHS]]

    @staticmethod
    def _by(table: np.ndarray, values: np.ndarray) -> np.ndarray:
        parts = [table[..., k, :] for k in range(4)]
        found = np.zeros_like(values)
        for k, part in enumerate(parts):
            found ^= part[(values >> np.uint32(8 * k)) & np.uint32(255)]
        return found

    def over(self, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        few = lengths % _LENGTHS
        found = np.zeros_like(values)
        for k in range(4):
            found ^= self.short[few, k, (values >> np.uint32(8 * k)) & np.uint32(255)]
        rest, power = lengths // _LENGTHS, 0
        while rest.any():
            if power == len(self.powers):
                self.powers.append(self._by(self.powers[-1], self.powers[-1]))
            odd = (rest & 1).astype(bool)
            found[odd] = self._by(self.powers[power], found[odd])
            rest, power = rest >> 1, power + 1
        return found


def _word_blocks(text: str) -> Iterator[list[bytes]]:
    """The words of a text, a bounded stretch of it at a time."""
    plain = text.encode("utf-8", "surrogatepass").translate(_NORMAL)
    at = 0
    while at < len(plain):
        end = len(plain)
        if end - at > _BLOCK:
            end = plain.rfind(b" ", at, at + _BLOCK)
            end = plain.find(b" ", at + _BLOCK) if end <= at else end
            end = len(plain) if end < 0 else end
        found = plain[at:end].split()
        if found:
            yield found
        at = end + 1


def ngram_crcs(text: str, least: int, most: int, shifts: Shifts) -> Iterator[tuple[int, np.ndarray]]:
    """(words of this stretch, CRC-32 of every run of ``least`` to ``most`` words that ends in it), stretch by stretch."""
    running, at, keep = 0, 0, most - 1
    starts, ends = np.empty(0, np.uint32), np.empty(0, np.uint32)
    begins, stops = np.empty(0, np.int64), np.empty(0, np.int64)
    for words in _word_blocks(text):
        count, old = len(words), len(starts)
        scanned = chain.from_iterable(zip(words, repeat(b" "), strict=False))
        crcs = np.fromiter(accumulate(scanned, _longer, initial=running), np.uint32, 2 * count + 1)
        stop = at + np.cumsum(np.fromiter(map(len, words), np.int64, count) + 1)
        running, begin, at = int(crcs[-1]), np.concatenate(([at], stop[:-1])), int(stop[-1])
        starts, ends = np.concatenate((starts, crcs[:-1:2])), np.concatenate((ends, crcs[1::2]))
        begins, stops = np.concatenate((begins, begin)), np.concatenate((stops, stop - 1))
        found = []
        for size in range(least, most + 1):
            last = np.arange(max(old, size - 1), len(ends))
            first = last - (size - 1)
            found.append(ends[last] ^ shifts.over(starts[first], stops[last] - begins[first]))
        yield count, np.concatenate(found)
        # Keep what n-grams over the border need.
        kept = max(0, len(starts) - keep)
        starts, ends, begins, stops = starts[kept:], ends[kept:], begins[kept:], stops[kept:]


def _longer(running: int, piece: bytes) -> int:
    return crc32(piece, running)


def bucket_counts(texts: DataFrame, text_col: str, least: int, most: int, buckets: int) -> DataFrame:
    """(bucket, n) over the n-grams of all rows; a task adds up its own rows first, so one short row a bucket leaves it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts, total = Shifts(), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in texts_of(batch.column(0)):
                for _, crcs in ngram_crcs(text or "", least, most, shifts):
                    total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["bucket", "n"])
        give_back()

    counted = texts.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Of every bucket, a thousandfold logarithm of how much likelier it is in the target, both counts smoothed by one."""
    counts = []
    for side in (source, target):
        held = np.zeros(buckets, np.int64)
        for bucket, n in side.toLocalIterator():  # no more rows than buckets
            held[bucket] = n
        counts.append(held.tolist())
    all_s, all_t = (sum(held) + buckets for held in counts)
    shares = (float(t + 1) * all_s / (float(s + 1) * all_t) for s, t in zip(*counts, strict=True))
    return np.array([floor(1000 * log(share)) for share in shares], np.int64)


def weigh(
    docs: DataFrame, gain: np.ndarray, least: int, most: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the sum of gains over a row's n-grams; none gives 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = Shifts()
        for batch in batches:
            rows = []
            for text in texts_of(batch.column(1)):
                words = features = weight = 0
                for count, crcs in ngram_crcs(text or "", least, most, shifts):
                    words, features = words + count, features + len(crcs)
                    weight += int(gain[crcs % np.uint32(len(gain))].sum())
                rows.append((words, features, weight))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "n_features", "weight"])
        give_back()

    picked = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return picked.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """A thousandfold Gumbel variate from the row's id alone, so that a draw is the same wherever it runs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(uniform)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    share_percent: int,
    least: int = 1,
    most: int = 2,
    buckets: int = BUCKETS,
    min_words: int = 20,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """Weight of every row towards the texts of ``target``, and the draw of ``share_percent`` percent of the long enough rows.

    Returns doc_id, n_features, weight, score and rank, all long: ``score`` is the weight with Gumbel noise on it, so the
    highest scores are a weighted draw without replacement; ``rank`` counts the drawn rows from 1 and is null elsewhere.
    Ties go to the smaller doc_id. A null or empty text has no features, weighs 0 and is never drawn unless ``min_words`` is 0. Repeated rows
    are rows of their own with equal scores; a null id comes first among equals. An empty ``target`` leaves the
    smoothed counts alone; an empty ``docs`` gives no rows. Other columns are ignored, whatever their names.
    What goes through the driver is one number for each of ``buckets`` buckets, whatever the tables' size.
    """
    if not 1 <= least <= most or buckets < 1:
        raise ValueError("n-grams need 1 <= least <= most and at least one bucket")
    count = partial(bucket_counts, least=least, most=most, buckets=buckets)
    table = gains(count(docs, text_col), count(target, target_text_col), buckets)
    weighed = weigh(docs, table, least, most, id_col, text_col).withColumn("score", F.col("weight") + noise(seed))
    # The sort samples its input before it runs, so texts are scanned into a table of numbers first.
    weighed = stored(weighed.withColumn("short", F.col("n_words") < min_words), "importance-weights")
    order = [F.col("short"), F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("weight")]
    numbered = number_sorted(weighed, order, "place")
    drawn = share_percent * weighed.agg(F.count_if(~F.col("short"))).first()[0] // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    return numbered.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))
