"""SentencePiece BPE ids by a table of prefixes, and text from ids.

The merges of a text end in one sequence of tokens, and so do those of each of its prefixes. Each prefix therefore has one
last token, and that token alone tells whether a longer prefix may end in a given piece: the piece must be its own result
of merging, and the two together must come out as themselves. An automaton over all pieces lists the pieces that end at each
character; the first that passes the test against the prefix before it is the prefix's last token. The ids are then read
backwards from the end of the text. No merge is carried out on the text itself.

That two tokens stay two is decided by letting the merges inside both run in the order of their scores and asking, after
each, whether the pair of symbols that meet at the border would have been merged first. Merges never cross the border
before a run of spaces (no piece holds a space after another character), so texts are taken apart there and the results of
short parts are kept in a bounded table of the worker.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHE = 1 << 18
LONGEST = 48
NEVER = float("inf")
#: Rows whose ids are handed over at once hold about so many ids.
BATCH_IDS = 1 << 20


class Pieces:
    """The pieces of one model and what has been found out about them."""

    def __init__(self, model: bytes, stable: tuple[int, ...] | None = None) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rule, trained = proto.normalizer_spec, proto.trainer_spec
        kinds = {p.type for p in proto.pieces}
        plain = not rule.precompiled_charsmap and rule.escape_whitespaces and not rule.remove_extra_whitespaces and not trained.treat_whitespace_as_suffix
        if trained.model_type != trained.BPE or not trained.byte_fallback or not plain or kinds - {1, 2, 3, 6}:
            raise ValueError("the model must be a BPE with byte fallback, without normalisation and without user-defined or unused pieces")
        self.prefix = SPACE if rule.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.rank = {p.piece: -p.score for p in proto.pieces if p.type == 1}
        self.byte_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(proto.pieces) if p.type == 6}
        self.silent = {i for i, p in enumerate(proto.pieces) if p.type == 3}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        if len(self.id_of_byte) != 256:
            raise ValueError("the model has no piece for some bytes")
        text = {1: lambda p: p.replace(SPACE, " ").encode(), 2: lambda p: trained.unk_surface.encode(), 3: lambda p: b"", 6: lambda p: bytes([int(p[3:5], 16)])}
        self.bytes = [text[p.type](p.piece) for p in proto.pieces]
        self.number = {i: p for p, i in self.ids.items()}
        self._steps: dict[str, tuple | None] = {}
        whole = {p: i for p, i in self.ids.items() if self.steps(p) is not None} if stable is None else {self.number[i]: i for i in stable}
        self.stable = list(whole.values())
        self._steps.clear()
        pairs = {pair for p in whole for pair in zip(p, p[1:])}
        letters = sorted({c for pair in pairs for c in pair})
        #: A number for each character that has a neighbour in some piece, and which of them are neighbours there.
        self.letter = np.zeros(sys.maxunicode + 1, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.joined = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for x, y in pairs:
            self.joined[self.letter[ord(x)], self.letter[ord(y)]] = True
        self.automaton = ahocorasick.Automaton()
        for p, i in whole.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self._fits: dict[int, bool] = {}
        self._new: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}

    def steps(self, piece: str) -> tuple | None:
        """Merges of a piece in their order, each with its rank and the first and last symbol after it; None if it does not come out whole."""
        if piece in self._steps:
            return self._steps[piece]
        symbols, out = list(piece), []
        rank = self.rank
        while len(symbols) > 1:
            least, at = min((rank.get(x + y, NEVER), i) for i, (x, y) in enumerate(zip(symbols, symbols[1:])))
            if least == NEVER:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            out.append((least, symbols[0], symbols[-1]))
        found = tuple(out) if len(symbols) == 1 else None
        self._steps[piece] = found
        return found

    def _stay(self, a: int, b: int) -> bool:
        """Whether the text of two tokens is encoded as these two."""
        first, second = self.number[a], self.number[b]
        left, right = self.steps(first), self.steps(second)
        i = j = 0
        x, y = first[-1], second[0]
        while True:
            next_left = left[i][0] if i < len(left) else NEVER
            next_right = right[j][0] if j < len(right) else NEVER
            across = self.rank.get(x + y, NEVER)
            # Of equal ranks, what stands further left is merged first.
            if across < next_left and across <= next_right:
                return False
            if next_left == next_right == NEVER:
                return True
            if next_left <= next_right:
                x = left[i][2]
                i += 1
            else:
                y = right[j][1]
                j += 1

    def prefix_table(self, part: str) -> list[int]:
        """The last token of each prefix; -1 for the empty one and for prefixes that end in a character no piece has."""
        last = [-1] * (len(part) + 1)
        fits = self._fits
        for at, (n, token) in self.automaton.iter(part):
            if last[at + 1] >= 0:
                continue
            before = last[at + 1 - n]
            if before >= 0:
                pair = before << 32 | token
                good = fits.get(pair)
                if good is None:
                    if len(fits) >= CACHE:
                        fits.clear()
                    good = fits[pair] = self._stay(before, token)
                if not good:
                    continue
            last[at + 1] = token
        return last

    def part_ids(self, part: str) -> list[int]:
        """Ids of a text whose spaces are already replaced, read backwards from its prefix table."""
        last, n = self.prefix_table(part), len(part)
        out: list[int] = []
        while n:
            token = last[n]
            if token < 0:
                out += [self.id_of_byte[b] for b in reversed(part[n - 1].encode())]
                n -= 1
            else:
                out.append(token)
                n -= len(self.number[token])
        out.reverse()
        return out

    def _remember(self, part: str, ids: tuple[int, ...]) -> None:
        if len(part) <= LONGEST:
            if len(self._new) >= CACHE:
                self._old, self._new = self._new, {}
            self._new[part] = ids

    def _missed(self, part: str) -> tuple[int, ...]:
        ids = self._new.get(part) or self._old.get(part) or tuple(self.part_ids(part))
        self._remember(part, ids)
        return ids

    def parts(self, text: str) -> list[str]:
        """The text cut where no merge can join what stands on both sides."""
        if not text:
            return []
        letter = self.letter[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        cut = (np.flatnonzero(~self.joined[letter[:-1], letter[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cut], [*cut, len(text)])]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as the library gives them, without begin or end."""
        parts = self.parts(self.prefix + text.replace(" ", SPACE) if text else "")
        found = list(map(self._new.get, parts))
        if None in found:
            found = [self._missed(part) if ids is None else ids for part, ids in zip(parts, found)]
        return np.fromiter(chain.from_iterable(found), np.int32)

    def decode(self, ids: list[int]) -> str:
        """Text of ids as the library gives it: one leading space goes, bytes are put together, broken ones replaced."""
        first = next((i for i in ids if self.bytes[i]), None)
        space = self.prefix and first in self.number and self.number[first].startswith(SPACE)
        try:
            if not self.silent.isdisjoint(ids):
                raise ValueError
            # A piece begins with the first byte of a character, so the whole is sound if each run of bytes is.
            return b"".join(map(self.bytes.__getitem__, ids)).decode()[bool(space) :]
        except ValueError:
            # A piece without a text ends a run of bytes, too.
            out = [from_bytes(b"".join(map(self.bytes.__getitem__, run))) for _, run in groupby(ids, self.byte_of.__contains__)]
            return "".join(out)[bool(space) :]


def from_bytes(run: bytes) -> str:
    """Characters of a run of bytes; each byte that belongs to none becomes U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[i : i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                i += 1
        return "".join(out)


@lru_cache(maxsize=2)
def _pieces(model: bytes, stable: tuple[int, ...] | None = None) -> Pieces:
    return Pieces(model, stable)


def _schema(table: DataFrame, more: str) -> str:
    return ", ".join([*[f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in table.schema.fields], more])


def encode(docs: DataFrame, model: str, keys: tuple[str, ...] = ("doc_id",), text: str = "text", decoded: str | None = None) -> DataFrame:
    """Key columns of every row with `ids`, the ids of its whole text, and on demand a column with the text of these ids.

    model: path of a SentencePiece model on the driver, a BPE with byte fallback and without normalisation (else
    ValueError); its content is broadcast. No begin or end ids and no sampling. A null or empty text has no ids and decodes
    to an empty text. Each row is encoded by itself, repeated ones alike; other columns are not read. A very long text takes
    memory in proportion to it.
    """
    content = Path(model).read_bytes()
    shared = docs.sparkSession.sparkContext.broadcast((content, tuple(_pieces(content).stable)))
    source = docs.select(*[docs[k] for k in keys], docs[text].cast("string").alias("_text"))
    head = source.select(*[source[k] for k in keys])
    names = [*keys, "ids", *([decoded] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(*shared.value)

        def rows(batch: pa.RecordBatch, first: int, found: list[np.ndarray]) -> pa.RecordBatch:
            own = batch.slice(first, len(found))
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.int32), *found])
            more = [pa.array([pieces.decode(x.tolist()) for x in found], pa.string())] if decoded else []
            return pa.RecordBatch.from_arrays([*[own.column(i) for i in range(len(keys))], pa.ListArray.from_arrays(offsets, values), *more], names=names)

        for batch in batches:
            first, size, found = 0, 0, []
            for cell in batch.column(len(keys)):
                found.append(pieces.encode(cell.as_py() or ""))
                size += len(found[-1])
                if size >= BATCH_IDS:
                    yield rows(batch, first, found)
                    first, size, found = first + len(found), 0, []
            if found:
                yield rows(batch, first, found)

    return source.mapInArrow(run, _schema(head, f"ids array<int>, `{decoded}` string" if decoded else "ids array<int>"))


def decode(rows: DataFrame, model: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns of the rows but `ids`, which becomes the column `name`: the text of the ids.

    Ids without a text (begin, end) give nothing; null or no ids give an empty text. An id that the model does not have is an
    error.
    """
    content = Path(model).read_bytes()
    shared = rows.sparkSession.sparkContext.broadcast((content, tuple(_pieces(content).stable)))
    kept = [c for c in rows.columns if c != ids]
    source = rows.select(*[rows[c] for c in kept], F.coalesce(rows[ids], F.array().cast("array<int>")).alias(ids))
    head = source.select(*[source[c] for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(*shared.value)
        for batch in batches:
            column = batch.column(len(kept))
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            found = pa.array([pieces.decode(values[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], found], names=[*kept, name])

    return source.mapInArrow(run, _schema(head, f"`{name}` string"))
