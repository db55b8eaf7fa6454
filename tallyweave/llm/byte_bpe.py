"""Byte-level BPE encoding and decoding by backtracking over longest matches.

The vocabulary is a rank file (base64 token, rank). Every pretoken, mapped byte by byte to
Latin-1, is searched with an Aho-Corasick automaton for the longest token at a position.
Two adjacent tokens are compatible if merging their joined bytes by rank would give just
these two; the answer is memoised. A sequence whose neighbours are all compatible is the one
that merging by rank gives, so the search takes the longest token that fits, shortens it
while it does not, and steps back when none fits. Positions found to be dead ends are not
entered twice, which bounds the work by the length of the text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import Pretokens
from .tables import text_slices

#: Pairs whose compatibility a worker keeps before it starts anew.
MEMO_ENTRIES = 600_000


class RankedBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the single bytes {missing[:5]}")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.compatible: dict[int, bool] = {}
        self.span = max(ranks.values()) + 1
        self.left = [-1] * self.span
        self.right = [-1] * self.span
        self.merges: dict[int, int] = {}
        self._split_tokens()
        self.shorter = {rank: self._shorter(token) for token, rank in ranks.items()}

    @classmethod
    def read(cls, path: str) -> RankedBpe:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines)
            return cls({base64.b64decode(pair[0]): int(pair[1]) for pair in pairs if pair})

    def _shorter(self, token: bytes) -> int | None:
        for end in range(len(token) - 1, 0, -1):
            if (rank := self.ranks.get(token[:end])) is not None:
                return rank
        return None

    def _merged(self, token: bytes, below: int) -> list[bytes]:
        """Parts of ``token`` after all merges of a rank lower than ``below``."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            joined = [self.ranks.get(a + b, below) for a, b in zip(parts, parts[1:])]
            best = min(joined)
            if best >= below:
                break
            at = joined.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _split_tokens(self) -> None:
        """The two tokens whose merge makes each longer token."""
        for token, rank in self.ranks.items():
            if len(token) > 1:
                parts = self._merged(token, rank)
                if len(parts) != 2:
                    raise ValueError(f"token {rank} is not the merge of two others")
                left, right = self.ranks[parts[0]], self.ranks[parts[1]]
                self.left[rank], self.right[rank] = left, right
                self.merges[left * self.span + right] = rank

    def _fits(self, left: int, right: int) -> bool:
        """Would merging by rank leave ``left`` and ``right`` side by side? Undo the latest
        merge on either side of the border, again and again: the border falls if a merge
        across it comes before the merge that had taken its place."""
        span, lefts, rights, across = self.span, self.left, self.right, self.merges.get
        limit = span + 1
        while True:
            if across(left * span + right, limit) < limit:
                return False
            if lefts[left] >= 0 and (left > right or lefts[right] < 0):
                limit, left = left, rights[left]
            elif lefts[right] >= 0:
                limit, right = right + 1, lefts[right]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one pretoken."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        text, size = piece.decode("latin-1"), len(piece)
        longest, lengths, span, compatible = self.automaton.iter_long, self.lengths, self.span, self.compatible
        if len(compatible) >= MEMO_ENTRIES:
            compatible.clear()
        open_ends = bytearray(b"\x01") * (size + 1)
        out: list[int] = []
        at, last, token = 0, -1, next(longest(text))[1]
        while True:
            end = at + lengths[token]
            if open_ends[end]:
                if last < 0:
                    fits = True
                else:
                    fits = compatible.get(last * span + token)
                    if fits is None:
                        fits = compatible[last * span + token] = self._fits(last, token)
                if fits:
                    out.append(token)
                    if end == size:
                        return out
                    at, last, token = end, token, next(longest(text, end))[1]
                    continue
            shorter = self.shorter[token]
            if shorter is not None:
                token = shorter
                continue
            open_ends[at] = 0
            token = out.pop()
            at -= lengths[token]
            last = out[-1] if out else -1

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_loaded: dict[tuple[str, str], tuple] = {}


def _loaded_for(vocab: str, pattern: str):
    """Encoder and pretokens, kept by a worker from task to task."""
    if (vocab, pattern) not in _loaded:
        bpe = RankedBpe.read(vocab)

        def ids(piece: str) -> bytes:
            return np.array(bpe.encode_piece(piece.encode("utf-8")), "<u4").tobytes()

        _loaded[vocab, pattern] = (bpe, Pretokens(pattern, ids))
    return _loaded[vocab, pattern]


def _with_ids(vocab: str, pattern: str, decode: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pretokens = _loaded_for(vocab, pattern)
        for batch in text_slices(batches):
            ids = [pretokens.encode(text or "") for text in batch.column("text").to_pylist()]
            columns = [batch.column("id"), pa.array(ids, pa.binary())]
            if decode:
                columns.append(pa.array([bpe.decode(np.frombuffer(x, "<u4")) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def encode(docs: DataFrame, id_col: str, text_col: str, vocab: str, pattern: str, *, decoded: bool = False) -> DataFrame:
    """``id``, ``ids`` (little-endian unsigned 32-bit integers in one binary value) and, with
    ``decoded``, the bytes that these ids decode to. One row per input row.

    Pretokens are the matches of ``pattern``; no special token is ever produced. A null text
    counts as empty and gives no ids. Ids of rows, repeated rows and nulls among them pass
    through as they are; other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    fields = [pa.field("id", _arrow_type(rows)), pa.field("ids", pa.binary())]
    ddl = f"id {kind}, ids binary"
    if decoded:
        fields.append(pa.field("decoded", pa.binary()))
        ddl += ", decoded binary"
    return rows.mapInArrow(_with_ids(vocab, pattern, decoded, pa.schema(fields)), ddl)


def decode(encoded: DataFrame, vocab: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id`` and ``decoded``: the bytes of ids that ``encode`` wrote. Null ids give no bytes."""
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = pa.schema([pa.field("id", _arrow_type(rows)), pa.field("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded_for(vocab, "")[0]
        for batch in batches:
            out = [bpe.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], schema=schema)

    return rows.mapInArrow(run, f"id {kind}, decoded binary")


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["id"].dataType)
