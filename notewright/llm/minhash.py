"""MinHash fingerprints of documents: universal hash permutations over word shingles, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.ngram_join import class_key, connect, join_documents
from notewright.llm.shingles import WordHashes, shingle_set, texts_of

PERMUTATIONS = 128
SHINGLE = 5
BANDS = 32
_CHUNK = 8192
_FIRST = -(2**63)
PARTS_OF_A_TASK = 4
TASK_BYTES = 128 * 1024 * 1024  # of text in a task that fingerprints ordered runs


def permutations(count: int = PERMUTATIONS, seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd, so each map is a bijection of 32-bit words) and offsets."""
    draw = np.random.default_rng(seed).integers(0, 2**32, (2, count), dtype=np.uint64).astype(np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def signature(found: np.ndarray, chosen: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The low 16 bits of each permutation's least value over a shingle set; all ones for an empty set."""
    least = np.full(len(chosen[0]), 2**32 - 1, dtype=np.uint32)
    values = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(values), _CHUNK):
        table = np.multiply.outer(chosen[0], values[at : at + _CHUNK])
        table += chosen[1][:, None]
        np.minimum(least, table.min(axis=1), out=least)
    return (least & np.uint32(0xFFFF)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two texts: the share of equal components."""
    return float((a == b).mean())


class Fingerprints:
    """Signatures of texts, with the word hashes of one Python worker."""

    def __init__(self, shingle: int = SHINGLE, count: int = PERMUTATIONS):
        self.shingle, self.chosen, self.cache = shingle, permutations(count), WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        return signature(shingle_set(text, self.shingle, self.cache), self.chosen)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint): a hex string of 16 bits per permutation for every row.

    Texts with the same shingle set, equal texts among them, have equal fingerprints; null and
    empty texts have all ones; a text of fewer words than a shingle counts as one shingle;
    repeated rows each get theirs; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Fingerprints(shingle)
        for batch in batches:
            found = [of(text).tobytes().hex() for text in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, fingerprint string"
    )


def band_postings(docs: DataFrame, shingle: int, bands: int = BANDS) -> DataFrame:
    """(token, key, n, at): for every class of equal sets the hash of each band of its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, cache = permutations(), WordHashes()
        for batch in batches:
            rows = {}
            for text in texts_of(batch.column(0)):
                found = shingle_set(text, shingle, cache)
                key = class_key(found)
                if key is not None and key not in rows:
                    parts = np.split(signature(found, chosen), bands)
                    hashed = [xxhash.xxh3_64_intdigest(part.tobytes(), k) for k, part in enumerate(parts)]
                    rows[key] = (len(found), np.array(hashed, np.uint64).view(np.int64))
            sizes = np.array([n for n, _ in rows.values()], np.int32)
            tokens = np.concatenate([t for _, t in rows.values()]) if rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tokens),
                    pa.array(np.repeat(np.array(list(rows), np.int64), bands)),
                    pa.array(np.repeat(sizes, bands)),
                    pa.array(np.zeros(len(tokens), np.int32)),
                ],
                ["token", "key", "n", "at"],
            )

    return docs.select("text").mapInArrow(run, "token long, key long, n int, at int")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, component_id): groups of texts linked by a Jaccard similarity of ``percent`` or more.

    Texts that agree on all components of one of ``BANDS`` bands are joined and their sets
    compared exactly. At a similarity of 0.8 two texts share no band with a probability of 5e-8.
    Empty, null, repeated and short texts are treated as ``join_documents`` does.
    """

    def find(texts: DataFrame, facts: DataFrame, size: int, least: int) -> DataFrame:
        return connect(band_postings(texts, size), texts, facts, None, size, least)

    return join_documents(docs, id_col, text_col, shingle, percent, find)


def parts_for(docs: DataFrame, text_col: str = "text", least: int = 1) -> int:
    """Parts into which ``ordered_with_next`` cuts the table, so that a task gets about ``TASK_BYTES`` of text; ``least`` or more."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()[0]
    return PARTS_OF_A_TASK * max(least, -(-size // TASK_BYTES))


def ordered_with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (part, doc_id, text, guest) such that each part, by doc_id and text, is a run of the table and ends in the next part's first row.

    The parts are cut at quantiles of doc_id and known by their first ids, so of the table only
    ``parts`` numbers reach the driver. Rows with a part's first id also go, as guests, to the
    part before; the last part gets the first part's. Null ids come first.
    """
    docs = docs.select(F.coalesce(F.col("doc_id"), F.lit(_FIRST)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = np.unique(docs.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.1 / parts)) if parts > 1 else []
    cuts = np.array(cuts, dtype=np.float64)

    def first_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            at = np.searchsorted(cuts, ids, side="right")
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(ids)], ["part", "doc_id"])

    firsts = docs.select("doc_id").mapInArrow(first_ids, "part long, doc_id long").groupBy("part").agg(F.min("doc_id"))
    first = dict(sorted(map(tuple, firsts.collect())))
    before = dict(zip(first, [list(first)[-1], *first], strict=False))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            at = np.searchsorted(cuts, ids, side="right")
            guests = np.flatnonzero([first[k] == i for k, i in zip(at.tolist(), ids.tolist(), strict=True)])
            for rows, to, guest in ((None, at, False), (guests, np.array([before[k] for k in at[guests].tolist()]), True)):
                part = batch if rows is None else batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(to, pa.int64()),
                        part.column(0),
                        part.column(1),
                        pa.array([guest] * part.num_rows, pa.bool_()),
                    ],
                    ["part", "doc_id", "text", "guest"],
                )

    moved = docs.mapInArrow(dealt, "part long, doc_id long, text string, guest boolean")
    # Parts are dealt by hash; several to a task even out how many a task happens to get.
    return moved.repartition(max(1, parts // PARTS_OF_A_TASK), "part").sortWithinPartitions("part", "guest", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """The last quarter of the code points (rounded down) replaced by the first as many of the following text."""
    changed = len(text) // 4
    return text[: len(text) - changed] + following[:changed]


def compare_edits(docs: DataFrame, parts: int | None = None, shingle: int = SHINGLE) -> DataFrame:
    """Each row's fingerprint against those of its edited text and of the next row.

    Returns doc_id, n_chars, edited (the text), fingerprint, edited_fingerprint, near_edited
    and near_next. Rows are ordered by doc_id (null first), then text; the last is followed by
    the first, a single row by itself. Null texts count as empty. Without ``parts`` their number follows the size of the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Fingerprints(shingle)
        held: tuple | None = None  # part, doc_id, text, signature of the row whose next is awaited
        for batch in batches:
            out: list[tuple] = []
            for part, doc_id, text, guest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = None if guest and held is None else of(text)
                if held is not None and held[0] == part:
                    changed = edited(held[2], text)
                    mark = of(changed)
                    out.append(
                        (
                            None if held[1] == _FIRST else held[1],
                            len(held[2]),
                            changed,
                            held[3].tobytes().hex(),
                            mark.tobytes().hex(),
                            likeness(held[3], mark),
                            likeness(held[3], own),
                        )
                    )
                held = None if guest else (part, doc_id, text, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[k] for row in out], kind) for k, (_, kind) in enumerate(columns)], [n for n, _ in columns]
            )

    columns = [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], _EDITS)
    return ordered_with_next(docs, parts or parts_for(docs)).mapInArrow(run, _EDITS)


_EDITS = (
    "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
