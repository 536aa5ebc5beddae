"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from notewright.llm.shingles import give_back

SAMPLE_ROWS = 4000  # labelled rows the model is fitted on, at most
SAMPLE_LINES = 400  # lines of such a row, at most; longer rows are not used for fitting
_SLICE = 1 << 20  # characters that are turned into features at once

# Classes of bytes; every byte from 128 up is a class of its own, all others left are one.
_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t",
    b".?",
    b"!",
    b",;:",
    b"'\"()-",
    b"#$%&*@^_~=+<>/\\`",
    b"|[]{}",
    bytes(range(128, 256)),
]
_OTHER = len(_CLASSES)
FEATURES = _OTHER + 1 + 7


def _class_table() -> np.ndarray:
    table = np.full(256, _OTHER, dtype=np.int64)
    for k, members in enumerate(_CLASSES):
        table[list(members)] = k
    return table


_TABLE = _class_table()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the lines of all texts, each line's length in characters, and each text's number of lines.

    Blank lines are no lines. Shares of byte classes (square roots, so that rare ones show),
    length, words, their mean length and variety, repetition of the line within the text, and
    how the line begins and ends.
    """
    lines, counts, repeated, variety, words = [], [], [], [], []
    for text in texts:
        own = [line for line in text.split("\n") if line.strip()]
        seen: dict[str, int] = {}
        for line in own:
            seen[line] = seen.get(line, 0) + 1
        for line in own:
            found = line.split()
            repeated.append(seen[line] > 1)
            words.append(len(found))
            variety.append(len(set(found)) / len(found))
        lines += own
        counts.append(len(own))
    if not lines:
        return np.zeros((0, FEATURES), np.float32), np.zeros(0), np.array(counts, np.int64)
    encoded = [line.encode("utf-8", "surrogatepass") for line in lines]
    sizes = np.array([len(e) for e in encoded])
    codes = _TABLE[np.frombuffer(b"".join(encoded), np.uint8)]
    owner = np.repeat(np.arange(len(lines)) * (_OTHER + 1), sizes)
    shares = np.bincount(owner + codes, minlength=len(lines) * (_OTHER + 1)).reshape(len(lines), -1) / sizes[:, None]
    words = np.array(words)
    features = np.column_stack(
        [
            np.sqrt(shares),
            np.log1p(sizes),
            np.log1p(words),
            np.log(sizes / words),
            variety,
            repeated,
            [line.rstrip()[-1] in ".!?" for line in lines],
            [line.lstrip()[0].isupper() for line in lines],
        ]
    ).astype(np.float32)
    return features, np.array([len(line) for line in lines], np.float64), np.array(counts, np.int64)


def with_neighbours(features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after in its text (zeros at the ends), and flags of both ends."""
    first = np.zeros(len(features), bool)
    last = np.zeros(len(features), bool)
    ends = np.cumsum(counts[counts > 0])
    first[ends - counts[counts > 0]], last[ends - 1] = True, True
    before = np.vstack([np.zeros_like(features[:1]), features[:-1]])
    after = np.vstack([features[1:], np.zeros_like(features[:1])])
    before[first], after[last] = 0, 0
    return np.hstack([features, before, after, first[:, None], last[:, None]]).astype(np.float32)


@dataclass
class Crf:
    """Weights of the state scores and transitions between bad (0) and good (1), scaling, and the document's calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    prior: float = 0.5

    def state_scores(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How much the features of each line favour good over bad."""
        scaled = (features - self.mean) / self.scale
        return with_neighbours(scaled, counts) @ self.weights + self.bias


def _step(message: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Log odds of good after one transition from a line with the given log odds."""
    good = np.logaddexp(message + moves[1, 1], moves[0, 1])
    return good - np.logaddexp(message + moves[1, 0], moves[0, 0])


def forward_backward(scores: np.ndarray, counts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds that each line is good: from the lines up to it, and from those after it; their sum is the marginal.

    All texts take a step at once; those with more lines come first, so the ones still under
    way are always a prefix.
    """
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    lengths = counts[order]
    ahead, behind = np.array(scores, np.float64), np.zeros(len(scores))
    longest = int(lengths[0]) if len(lengths) else 0
    active = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(longest + 1)]  # texts with more than t lines
    for t in range(1, longest):
        at = starts[: active[t]] + t
        ahead[at] += _step(ahead[at - 1], moves)
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        behind[at] = _step(behind[at + 1] + scores[at + 1], moves.T)
    return ahead, behind


def fit_crf(
    features: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 200, ridge: float = 1e-3, rate: float = 0.05
) -> Crf:
    """Likelihood of line labels (each text's own label on all its lines), maximised by Adam on exact gradients."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    inputs = with_neighbours((features - mean) / scale, counts)
    wanted = np.repeat(labels, counts).astype(np.float64)
    inner = np.ones(len(wanted), bool)  # lines with a line before them in their text
    inner[(np.cumsum(counts) - counts)[counts > 0]] = False
    at = np.flatnonzero(inner)
    kept = np.bincount((wanted[at - 1] * 2 + wanted[at]).astype(int), minlength=4).reshape(2, 2)
    theta = np.zeros(inputs.shape[1] + 1 + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        moves = theta[-4:].reshape(2, 2)
        scores = inputs @ theta[:-5] + theta[-5]
        ahead, behind = forward_backward(scores, counts, moves)
        good = 1 / (1 + np.exp(-(ahead + behind)))
        if len(at):
            left = np.stack([np.zeros(len(at)), ahead[at - 1]])
            right = np.stack([np.zeros(len(at)), scores[at] + behind[at]])
            pair = left[:, None] + right[None, :] + moves[:, :, None]
            pair = np.exp(pair - pair.max(axis=(0, 1)))
            expected = (pair / pair.sum(axis=(0, 1))).sum(axis=2)
        else:
            expected = np.zeros((2, 2))
        miss = good - wanted
        gradient = np.concatenate([inputs.T @ miss, [miss.sum()], (expected - kept).ravel()]) / len(wanted) + ridge * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Crf(mean, scale, theta[:-5], float(theta[-5]), theta[-4:].reshape(2, 2))


def aggregate(model: Crf, features: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log odds of each text's mean marginal, lines weighted by length; nan for texts without lines."""
    out = np.full(len(counts), np.nan)
    if len(features):
        ahead, behind = forward_backward(model.state_scores(features, counts), counts, model.moves)
        good = 1 / (1 + np.exp(-np.clip(ahead + behind, -30, 30)))
        begins = (np.cumsum(counts) - counts)[counts > 0]
        share = np.add.reduceat(good * lengths, begins) / np.add.reduceat(lengths, begins)
        share = np.clip(share, 1e-9, 1 - 1e-9)
        out[counts > 0] = np.log(share / (1 - share))
    return out


def calibrate(model: Crf, odds: np.ndarray, labels: np.ndarray) -> None:
    """Logistic regression of the labels on the aggregated log odds, by Newton steps with a little ridge."""
    model.prior = float(labels.mean())
    seen = ~np.isnan(odds)
    x, y = np.column_stack([odds[seen], np.ones(seen.sum())]), labels[seen]
    theta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-(x @ theta)))
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2)
        theta += np.linalg.solve(hessian, x.T @ (y - p) - 1e-3 * theta)
    model.slope, model.offset = map(float, theta)


def probabilities(model: Crf, texts: list[str]) -> np.ndarray:
    """Score of each text, from 0 to 1; texts without lines get the share of good ones among the labelled."""
    out = []
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) <= _SLICE):
            size += len(texts[end])
            end += 1
        odds = aggregate(model, *line_features(texts[begin:end]))
        score = 1 / (1 + np.exp(-np.clip(model.slope * odds + model.offset, -30, 30)))
        out.append(np.where(np.isnan(odds), model.prior, score))
        begin = end
    return np.concatenate(out) if out else np.zeros(0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    sample_lines: int = SAMPLE_LINES,
) -> Crf | None:
    """A model from a bounded sample of labelled rows: the ``sample_rows`` first by hash of the id, of ``sample_lines`` lines at most.

    Only line features of these rows reach the driver. Rows without a label or text are passed over; of
    several labels of an id the mean decides (0.5: good). None if no row is left.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).dropna()
    marks = marks.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    marks = marks.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropna()
    rows = rows.join(F.broadcast(marks), "id").select("id", "text", "label")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                features, lengths, counts = line_features([row["text"]])
                if 0 < counts[0] <= sample_lines:
                    yield pa.RecordBatch.from_pylist(
                        [{"id": row["id"], "label": row["label"], "x": features.tobytes(), "n": lengths.tobytes()}], schema
                    )

    schema = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("x", pa.binary()), ("n", pa.binary())])
    found = rows.mapInArrow(featured, "id long, label int, x binary, n binary").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.id, bytes(r.x)))
    features = np.vstack([np.frombuffer(r.x, np.float32).reshape(-1, FEATURES) for r in found])
    lengths = np.concatenate([np.frombuffer(r.n) for r in found])
    counts = np.array([len(r.n) // 8 for r in found])
    y = np.array([r.label for r in found], np.float64)
    model = fit_crf(features, counts, y)
    calibrate(model, aggregate(model, features, lengths, counts), y)
    return model


def score(docs: DataFrame, model: Crf | None, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability that each row's text is good; only the text is looked at.

    Null, empty and blank texts score the share of good rows among the labelled ones; without
    a model every score is 0.5. Repeated rows score alike; an empty table stays empty; a
    column of that name is an error.
    """
    if into.lower() in [name.lower() for name in docs.columns]:
        raise ValueError(f"column {into} is made here")
    if model is None:
        return docs.withColumn(into, F.lit(0.5))
    fields = StructType([*docs.schema.fields, StructField(into, DoubleType())])
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = probabilities(model, [text or "" for text in batch.column(text_at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, into])
        give_back()

    return docs.mapInArrow(run, fields)
