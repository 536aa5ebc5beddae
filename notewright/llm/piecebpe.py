"""SentencePiece ids of whole texts, found from a table of every prefix's last token, and texts back from ids.

In a merge-type vocabulary each prefix of a text ends in one token only. An automaton
lists the tokens that end at a place; the one that may stand after the last token of the
prefix before it (their pair is compatible) is the place's token. From the end of the text the table is
read backwards. Texts are cut where no piece can cross, and the ids of such a chunk are remembered.
"""

from __future__ import annotations

import contextlib
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.shingles import give_back, texts_of
from notewright.workers import of_worker

SPACE = "▁"  # fixed value: how the library writes a blank
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_LONGEST_REMEMBERED = 48  # characters of a chunk
_MOST_REMEMBERED = 150_000  # chunks in each half, and as many pairs of tokens times ten
_CHARACTERS_AT_ONCE = 2_000_000  # of texts whose ids leave a task together


@dataclass(frozen=True)
class PieceModel:
    """What travels to the tasks of a model file: pieces with ranks (low ones merge first), byte ids, the end id."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    shown: dict[int, str]
    end_id: int
    add_blank: bool


def read_model(path: str) -> PieceModel:
    """The model at ``path``; refuses kinds whose texts are normalised or whose pieces do not come from merges alone."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(Path(path).read_bytes())
    rules, kinds = model.normalizer_spec, proto.ModelProto.SentencePiece
    if model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
        raise ValueError("only merge-type models with byte fallback are supported")
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("only models that leave texts as they are are supported")
    if model.trainer_spec.treat_whitespace_as_suffix or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
        raise ValueError("user-defined and unused pieces and blanks as suffixes are not supported")
    pieces = {p.piece: (i, -p.score) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
    of_byte = {int(_BYTE.fullmatch(p.piece)[1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
    shown = {i: p.piece for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
    shown |= {i: model.trainer_spec.unk_surface for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN}
    end = next((i for i, p in enumerate(model.pieces) if p.piece == model.trainer_spec.eos_piece), -1)
    return PieceModel(pieces, tuple(of_byte[b] for b in range(256)), shown, end, rules.add_dummy_prefix)


class Encoder:
    """Ids of texts under one model, with what a worker remembers of chunks and pairs of tokens."""

    def __init__(self, model: PieceModel):
        import ahocorasick

        self.model = model
        self._ids = {text: i for text, (i, _) in model.pieces.items()}
        self._rank = {text: rank for text, (_, rank) in model.pieces.items()}
        ranks = sorted(self._rank.values())
        self._tied = {a for a, b in zip(ranks, ranks[1:], strict=False) if a == b}
        self._matches = ahocorasick.Automaton()
        for text in self._rank:
            self._matches.add_word(text, (text, len(text)))
        self._matches.make_automaton()
        self._bytes = {i: b for b, i in enumerate(model.byte_ids)}
        self._halves: dict[str, tuple[str, str] | None] = {}
        self._spines: dict[str, tuple[list, list] | None] = {}
        self._pairs: dict[tuple[str, str], bool] = {}
        # Ids as bytes, since the collector looks at arrays again and again.
        self._chunks: dict[str, tuple[bytes, str]] = {}
        self._older: dict[str, tuple[bytes, str]] = {}
        self._cut = self._cuts()

    def _cuts(self) -> re.Pattern | None:
        """Where texts are cut: before blanks, around characters that no longer piece has, and between letters and others.

        Each cut is made only if no piece reaches over it; None where a piece has a blank behind other text.
        """
        longer = [text for text in self._rank if len(text) > 1]
        inner = re.compile(f"[^{SPACE}]{SPACE}")
        if any(inner.search(text) for text in longer):
            return None
        merged = set().union(*longer)
        single = "".join(f"\\x{c:02x}" for c in range(128) if chr(c) not in merged)
        odd = "".join(re.escape(c) for c in sorted(merged) if re.fullmatch(r"[^\W\d_]", c) and not c.isalpha())  # raised digits
        letter, known = rf"[^\W\d_{odd}]", f"{SPACE}{single}"
        if any(re.search(rf"{letter}(?!{letter}).|[^{SPACE}](?<!{letter}){letter}", text, re.S) for text in longer):
            return re.compile(rf"{SPACE}+[^{known}]*|[^{known}]+" + (f"|[{single}]" if single else ""))
        other = rf"(?:[^\w{known}]|(?![{known}])[\d_{odd}])"
        return re.compile(rf"{SPACE}*{letter}+|{SPACE}+{other}*|{other}+" + (f"|[{single}]" if single else ""))

    # Merging as the library does it, for single tokens and doubtful pairs only.

    def _merged(self, text: str) -> list[tuple[str, tuple[str, str] | None]]:
        """Tokens of a short text with their halves: the best rank merges first, the leftmost among equals."""
        parts: list[tuple[str, tuple[str, str] | None]] = [(c, None) for c in text]
        while True:
            joined = [(self._rank.get(a[0] + b[0]), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            best = min((x for x in joined if x[0] is not None), default=None)
            if best is None:
                return parts
            i = best[1]
            a, b = parts[i][0], parts[i + 1][0]
            parts[i : i + 2] = [(a + b, (a, b))]

    def _split(self, token: str) -> tuple[str, str] | None:
        """The two tokens that merge into this one; None for a character."""
        if token not in self._halves:
            found = self._merged(token)
            self._halves[token] = found[0][1] if len(found) == 1 else ("", "")
        return self._halves[token]

    def _reached(self, token: str) -> bool:
        """Whether merging ever makes this token out of its characters."""
        return len(token) == 1 or self._split(token) != ("", "")

    def _spine(self, token: str) -> tuple[list, list] | None:
        """The tokens at the token's left and right edge, whole one first, each with the rank at which it is made.

        None where ranks do not tell the order of merges: two tokens of a rank, or a part that ranks after its whole.
        """
        if token in self._spines:
            return self._spines[token]
        edges = ([], [])
        for side, edge in enumerate(edges):
            at, whole = token, float("inf")
            while at is not None:
                made = self._rank[at] if len(at) > 1 else -1.0
                halves = self._split(at) if len(at) > 1 else None
                if made >= whole or made in self._tied or halves == ("", ""):
                    edges = None
                    break
                edge.append((at, made))
                whole = made
                if halves and max((self._rank[x] for x in halves if len(x) > 1), default=-1.0) >= made:
                    edges = None
                    break
                at = halves[side] if halves else None
            if edges is None:
                break
        self._spines[token] = edges
        return edges

    def _compatible(self, a: str, b: str) -> bool:
        """Whether token ``b`` may follow token ``a``: no merge across their border comes before the merges that make them."""
        if not self._reached(b):
            found = False
        elif len(a) == 1 and a not in self._rank:
            found = True
        elif (left := self._spine(a)) is None or (right := self._spine(b)) is None:
            found = [x for x, _ in self._merged(a + b)] == [a, b]
        else:
            found = self._apart(left[1], right[0])
        if len(self._pairs) >= 10 * _MOST_REMEMBERED:
            self._pairs.clear()
        self._pairs[a, b] = found
        return found

    def _apart(self, ending: list, starting: list) -> bool:
        """Go back in time along the two edges: the later made token falls apart, and what then meets must not merge sooner."""
        i = j = 0
        until, until_left = float("inf"), True  # when the present pair ends, and whether the left token ends it
        while True:
            (a, made_a), (b, made_b) = ending[i], starting[j]
            across = self._rank.get(a + b)
            # At equal ranks the merge further left wins.
            if across is not None and (across < until or across == until and not until_left):
                return False
            if made_a < 0 and made_b < 0:
                return True
            if made_a >= made_b:  # of equal ones the right one is made last
                later_left = made_a > made_b
            else:
                later_left = False
            if later_left:
                until, until_left, i = made_a, True, i + 1
            else:
                until, until_left, j = made_b, False, j + 1

    def _last_tokens(self, chunk: str) -> list[str]:
        """For every prefix of the chunk (by its end, the empty one left out), the one token its encoding ends in."""
        table: list[str] = []
        filled, known, append = 0, self._pairs.get, table.append
        for end, (token, size) in self._matches.iter(chunk):  # by end, the longest first
            if end < filled:
                continue
            if end > filled:  # characters of no piece, which merge with nothing
                table.extend(chunk[filled:end])
                filled = end
            if size <= end:
                before = table[end - size]
                fits = known((before, token))
                if fits is None:
                    fits = self._compatible(before, token)
            else:
                fits = self._reached(token)
            if fits:
                append(token)
                filled += 1
        table.extend(chunk[filled:])
        return table

    def _encode_chunk(self, chunk: str) -> tuple[bytes, str]:
        """Ids and surface of a chunk; the chunks met last are remembered, in two halves of which the older one is dropped."""
        found = self._older.get(chunk)
        if found is None:
            found = self._encoded(chunk)
        if len(chunk) <= _LONGEST_REMEMBERED:
            if len(self._chunks) >= _MOST_REMEMBERED:
                self._older, self._chunks = self._chunks, {}
            self._chunks[chunk] = found
        return found

    def _encoded(self, chunk: str) -> tuple[bytes, str]:
        whole = self._ids.get(chunk)
        if whole is not None and self._reached(chunk):
            return array("i", (whole,)).tobytes(), self._shown((whole,))
        table, tokens, end = self._last_tokens(chunk), [], len(chunk)
        while end:
            token = table[end - 1]
            tokens.append(token)
            end -= len(token)
        tokens.reverse()
        try:
            return array("i", [self._ids[token] for token in tokens]).tobytes(), "".join(tokens)
        except KeyError:  # some are bytes
            known, of_byte = self._ids, self.model.byte_ids
            ids = array("i")
            for token in tokens:
                ids.extend([known[token]] if token in known else [of_byte[b] for b in token.encode("utf-8", "surrogatepass")])
            return ids.tobytes(), self._shown(ids)

    def _shown(self, ids: Iterable[int]) -> str:
        """Surfaces of ids one behind the other, bytes put together; blanks still escaped."""
        with contextlib.suppress(KeyError):  # bytes and control ids
            return "".join([self.model.shown[i] for i in ids])
        out: list[str] = []
        held = bytearray()
        for i in [*ids, None]:
            byte = self._bytes.get(i)
            if byte is not None:
                held.append(byte)
                continue
            if held:
                out.append(_characters(bytes(held)))
                held.clear()
            if i is not None:
                out.append(self.model.shown.get(i, ""))
        return "".join(out)

    def encode(self, text: str) -> tuple[array, str]:
        """The ids of a text without an end id, and the text that they decode to."""
        if not text:
            return array("i"), ""
        escaped = (SPACE if self.model.add_blank else "") + text.replace(" ", SPACE)
        chunks = [escaped] if self._cut is None else self._cut.findall(escaped)
        ids, shown, remembered = [], [], self._chunks
        for chunk in chunks:
            known = remembered.get(chunk)
            if known is None:
                known = self._encode_chunk(chunk)
                remembered = self._chunks
            found, said = known
            ids.append(found)
            shown.append(said)
        return array("i", b"".join(ids)), self._unescaped("".join(shown))

    def _unescaped(self, shown: str) -> str:
        if self.model.add_blank:
            shown = shown.removeprefix(SPACE)
        return shown.replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: control ids say nothing, bytes that make no character become U+FFFD each."""
        return self._unescaped(self._shown(array("i", ids)))


def _characters(held: bytes) -> str:
    try:
        return held.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(held):
            for size in (1, 2, 3, 4):
                try:
                    out.append(held[at : at + size].decode("utf-8"))
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                size = 1
            at += size
        return "".join(out)


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True
) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every row under the model at ``model_path``.

    Ids are those of the library, with the end id behind them where ``end`` says so; ``decoded`` is what
    they decode to. A null or empty text has no ids but the end id and decodes to the empty text. Rows are kept as they are,
    repeated and null ids included; an empty table gives no rows; other columns are ignored.
    Rows stay in their partitions: nothing is shuffled. The file is read on the driver and its pieces travel with the job.
    """
    model = read_model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = of_worker("piecebpe", model, Encoder)
        for batch in batches:
            rows, ids, places, decoded, held = [], array("i"), [0], [], 0
            for key, text in zip(texts_of(batch.column(0)), texts_of(batch.column(1)), strict=True):
                found, said = encoder.encode(text or "")
                ids.extend(found)
                if end:
                    ids.append(model.end_id)
                rows.append(key)
                places.append(len(ids))
                decoded.append(said)
                held += len(said)
                if held > _CHARACTERS_AT_ONCE:
                    yield _encoded(rows, ids, places, decoded)
                    rows, ids, places, decoded, held = [], array("i"), [0], [], 0
            if rows:
                yield _encoded(rows, ids, places, decoded)
        give_back()

    picked = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return picked.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def _encoded(rows: list, ids: array, places: list[int], decoded: list[str]) -> pa.RecordBatch:
    values = pa.array(np.frombuffer(ids, dtype=np.int32) if ids else np.empty(0, np.int32))
    lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), values)
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])
