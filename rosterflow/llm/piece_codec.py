"""SentencePiece encoding and decoding that keeps offsets.

The text is normalised by longest-prefix matches in the model's compiled character map;
every normalised byte remembers the source byte it came from. Byte-pair merges then run
over chunks of the normalised text: two neighbouring characters that stand side by side in
no piece can never be merged, so every such place is a chunk bound and equal chunks have
equal pieces. The distinct chunks of a batch are merged together, one merge per chunk and
round, best score first and leftmost on ties. Every piece is projected through the source
alignment to the byte span of the original text.

Null and empty texts have no pieces, decode to the empty text, and are kept. Model files
are read on the driver and shipped to the tasks (a vocabulary, not data that grows).
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rosterflow.llm import arrays

#: Fixed values of the model file format: kinds of pieces and the mark that stands for a space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE_MARK = "▁"
UNKNOWN_SURFACE = " ⁇ "
_MARK_BYTES = SPACE_MARK.encode()
#: Chunks with more characters are merged one by one over a heap.
WIDE = 48
#: Distinct chunks remembered by a worker between batches.
REMEMBERED = 300_000
_NONE = np.int32(2**31 - 1)


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a serialised message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        elif tag & 7 == 2:
            size, at = varint(at)
            value, at = message[at : at + size], at + size
        else:
            size = 4 if tag & 7 == 5 else 8
            value, at = message[at : at + size], at + size
        yield tag >> 3, value


class CharacterMap:
    """Longest-prefix replacement by a compiled double-array trie; an empty map changes nothing."""

    def __init__(self, compiled: bytes):
        self.empty = not compiled
        if compiled:
            (size,) = struct.unpack_from("<I", compiled)
            self.units = struct.unpack_from(f"<{size // 4}I", compiled, 4)
            self.replacements = compiled[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement of the longest key that ``text`` has at ``at``, and the key's length."""

        def offset(unit: int) -> int:
            return (unit >> 10) << ((unit & 512) >> 6)

        found, node = None, offset(self.units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= offset(unit)
            if unit >> 8 & 1:
                found = (self.units[node] & 0x7FFFFFFF, i + 1 - at)
        if found is None:
            return None
        begin = found[0]
        return self.replacements[begin : self.replacements.index(0, begin)], found[1]


class PieceModel:
    """A byte-pair model with byte fallback, read from the bytes of its file."""

    def __init__(self, serialised: bytes):
        self.pieces: list[str] = []
        scores, self.kinds = [], []
        compiled, self.dummy_prefix, self.squeeze, escape, kind, fallback, suffix = b"", True, True, True, 1, False, False
        for number, value in _fields(serialised):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
                kind, fallback, suffix = trainer.get(3, 1), trainer.get(35, 0), trainer.get(24, 0)
            elif number == 3:
                rules = dict(_fields(value))
                compiled, self.dummy_prefix = rules.get(2, b""), bool(rules.get(3, 1))
                self.squeeze, escape = bool(rules.get(4, 1)), bool(rules.get(5, 1))
        if kind != 2 or not fallback or not escape or suffix or {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("only byte-pair models with byte fallback, escaped spaces and no user-defined or unused pieces are supported")
        self.map = CharacterMap(compiled)
        self._index(scores)

    def _index(self, scores: list[float]) -> None:
        """Symbols are the piece numbers, then the characters that only occur inside pieces."""
        normal = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        inner = sorted({c for p in normal for c in p} - set(normal))
        symbol = normal | {c: len(self.pieces) + i for i, c in enumerate(inner)}
        self.inner = np.array([ord(c) for c in inner], np.int64)
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for text, i in symbol.items():
            if len(text) == 1:
                self.symbol_of[ord(text)] = i
        self.symbol_of[0x20] = self.symbol_of[ord(SPACE_MARK)]
        pairs, neighbours = {}, np.zeros((256, 256), bool)
        for text, i in normal.items():
            for cut in range(1, len(text)):
                left, right = symbol.get(text[:cut]), symbol.get(text[cut:])
                a, b = (" " if c == SPACE_MARK else c for c in text[cut - 1 : cut + 1])
                neighbours[a.encode()[-1], b.encode()[0]] = True
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.neighbours = neighbours.ravel()
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_pieces = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)
        # equal scores share a rank, so that the leftmost of them is merged first
        _, rank = np.unique(-np.array(scores, np.float32), return_inverse=True)
        self.rank = rank.astype(np.int32)
        self.byte_piece = np.zeros(256, np.int32)
        spelled = []
        for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)):
            if k == BYTE:
                self.byte_piece[int(p[3:5], 16)] = i
                spelled.append(bytes([int(p[3:5], 16)]))
            else:
                spelled.append({CONTROL: b"", UNKNOWN: UNKNOWN_SURFACE.encode()}.get(k, p.replace(SPACE_MARK, " ").encode()))
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_first = np.concatenate([[0], np.cumsum([len(s) for s in spelled])])
        self.widths = np.diff(self.spelled_first)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two neighbouring symbols make, or -1."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_pieces[at], -1)

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, a space standing for the mark, and the source byte of each; last, where the source ends."""
        if not text:
            return b"", np.zeros(1, np.int32)
        if self.map.empty and not self.squeeze and _MARK_BYTES not in text:
            lead = int(self.dummy_prefix)
            return b" " * lead + text, np.maximum(np.arange(len(text) + lead + 1, dtype=np.int32) - lead, 0)
        out, source, at = bytearray(), [], 0

        def step() -> tuple[bytes, int]:
            found = None if self.map.empty else self.map.longest(text, at)
            if found:
                return found[0].replace(_MARK_BYTES, b" "), found[1]
            size = 1 if text[at] < 0x80 else 2 if text[at] < 0xE0 else 3 if text[at] < 0xF0 else 4
            char = text[at : at + size]
            return (b" " if char == _MARK_BYTES else char), size

        if self.squeeze:
            while at < len(text):
                given, size = step()
                if given != b" ":
                    break
                at += size
            if at == len(text):
                return b"", np.zeros(1, np.int32)
        if self.dummy_prefix:
            out += b" "
            source.append(at)
        after_space = self.squeeze
        while at < len(text):
            given, size = step()
            if after_space:
                given = given.lstrip(b" ")
            if given:
                out += given
                source += [at] * len(given)
                after_space = self.squeeze and given.endswith(b" ")
            at += size
        if self.squeeze:
            while out.endswith(b" "):
                out.pop()
                at = source.pop()
        return bytes(out), np.array([*source, at], np.int32)

    def _merged(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of equally many symbols, merged to the end: places of finished rows and their symbols."""
        rows = np.arange(len(symbols))
        made = self.pair(symbols[:, :-1], symbols[:, 1:])
        ranks = np.where(made >= 0, self.rank[made], _NONE)
        while len(rows):
            if symbols.shape[1] == 1:
                yield rows, symbols
                return
            j = ranks.argmin(1)
            line = np.arange(len(rows))
            going = ranks[line, j] < _NONE
            if not going.all():
                yield rows[~going], symbols[~going]
                rows, symbols, ranks, j = rows[going], symbols[going], ranks[going], j[going]
                line = np.arange(len(rows))
                if not len(rows):
                    return
            piece = self.pair(symbols[line, j], symbols[line, j + 1])
            place = np.arange(symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, place + (place > j[:, None]), 1)
            symbols[line, j] = piece
            place = place[:-1]
            ranks = np.take_along_axis(ranks, place + (place >= j[:, None]), 1)
            for at in (j - 1, j):
                ok = (at >= 0) & (at < ranks.shape[1])
                here, at = line[ok], at[ok]
                made = self.pair(symbols[here, at], symbols[here, at + 1])
                ranks[here, at] = np.where(made >= 0, self.rank[made], _NONE)

    def _merged_long(self, symbols: list[int]) -> list[int]:
        """The same for one long chunk, over a heap of neighbouring pairs."""
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        table, heap = self._pair_table(), []

        def push(i: int, j: int) -> None:
            piece = table.get(symbols[i] << 32 | symbols[j]) if i >= 0 and j >= 0 and symbols[i] >= 0 and symbols[j] >= 0 else None
            if piece is not None:
                heapq.heappush(heap, (int(self.rank[piece]), i, j, symbols[i], symbols[j], piece))

        for i in range(len(symbols) - 1):
            push(i, i + 1)
        gone = [False] * len(symbols)
        while heap:
            _, i, j, left, right, piece = heapq.heappop(heap)
            if gone[i] or gone[j] or after[i] != j or (symbols[i], symbols[j]) != (left, right):
                continue
            symbols[i], gone[j], after[i] = piece, True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            push(before[i], i)
            push(i, after[i])
        return [s for s, dead in zip(symbols, gone, strict=True) if not dead]

    def _pair_table(self) -> dict[int, int]:
        if not hasattr(self, "_pairs"):
            self._pairs = dict(zip(self.pair_keys.tolist(), self.pair_pieces.tolist(), strict=True))
        return self._pairs

    def chunk_pieces(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of each byte span, and the bounds of each."""
        spelled, first = _gather(data, start, stop)
        heads = np.concatenate([[0], np.cumsum((spelled & 0xC0) != 0x80)])
        first = heads[first]
        points = np.frombuffer(spelled.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        symbols = self.symbol_of[points]
        symbols = np.where(symbols >= 0, symbols, -1 - points).astype(np.int32)
        lengths = np.diff(first)
        owners, found = [], []
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            if length <= WIDE:
                for done, held in self._merged(symbols[first[rows][:, None] + np.arange(length)]):
                    owners.append(np.repeat(rows[done], held.shape[1]))
                    found.append(held.ravel())
            else:
                for row in rows.tolist():
                    held = self._merged_long(symbols[first[row] : first[row + 1]].tolist())
                    owners.append(np.full(len(held), row))
                    found.append(np.array(held, np.int32))
        owner, held = np.concatenate(owners), np.concatenate(found)
        order = np.argsort(owner, kind="stable")
        owner, held = owner[order], held[order]
        bare = np.flatnonzero((held < 0) | (held >= len(self.pieces)))
        if len(bare):  # characters that are no piece become their bytes
            point = np.where(held[bare] < 0, -1 - held[bare].astype(np.int64), self.inner[np.clip(held[bare] - len(self.pieces), 0, None)] if len(self.inner) else 0)
            size = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
            times = np.ones(len(held), np.int64)
            times[bare] = size
            spot = np.cumsum(times) - times
            owner, held = np.repeat(owner, times), np.repeat(held, times)
            spot = np.repeat(spot[bare], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            raw = np.frombuffer("".join(map(chr, point.tolist())).encode(), np.uint8)
            held[spot] = self.byte_piece[raw]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(start)))])
        return held.astype(np.int32), bounds


def _gather(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = stop - start
    first = np.concatenate([[0], np.cumsum(lengths)])
    return data[np.arange(first[-1]) + np.repeat(start - first[:-1], lengths)], first


class Codec:
    """A model with the chunks that its worker has met; bounded, and emptied when full."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.number: dict[int, int] = {}
        self.held, self.bounds = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]

    def _pieces(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of each chunk, and the pieces and bounds of all that are remembered."""
        listed = keys.tolist()
        number = np.array([self.number.get(k, -1) for k in listed], np.int64)
        new = np.flatnonzero(number < 0)
        if len(self.number) + len(new) > REMEMBERED and self.number:
            self._forget()
            number[:], new = -1, np.arange(len(listed))
        if len(new):
            held, bounds = self.model.chunk_pieces(data, start[new], stop[new])
            known = len(self.number)
            number[new] = np.arange(known, known + len(new))
            self.number.update(zip(keys[new].tolist(), range(known, known + len(new)), strict=True))
            self.held = [np.concatenate([*self.held, held])]
            self.bounds = [np.concatenate([self.bounds[0], bounds[1:] + self.bounds[0][-1]])]
        return number, self.held[0], self.bounds[0]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of all texts, bounds of each text, and the source byte where each piece begins and ends."""
        parts = [self.model.normalise(t) for t in texts]
        lengths = np.fromiter((len(p) for p, _ in parts), np.int64, len(parts))
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(p for p, _ in parts), np.uint8)
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
        bound = np.ones(len(data) + 1, bool)
        side = data[:-1].astype(np.uint16) << 8 | data[1:]
        bound[1:-1] = ~self.model.neighbours[side] & ((data[1:] & 0xC0) != 0x80)
        bound[ends] = True
        bound[-1] = True
        cuts = np.flatnonzero(bound)
        start, stop = cuts[:-1], cuts[1:]
        hashes = arrays.span_hashes(data, start, stop, fold=False)
        sample, kind = arrays.kinds(hashes)
        number, held, bounds = self._pieces(hashes[sample], data, start[sample], stop[sample])
        place, _ = arrays.spread(bounds, number[kind])
        ids = held[place]
        to = np.cumsum(self.model.widths[ids])
        first = np.concatenate([[0], np.searchsorted(to, ends, "right")])
        # a piece begins and ends at places of its text's alignment, which has one entry more than bytes
        source = np.concatenate([s for _, s in parts])
        text = np.repeat(np.arange(len(parts)), np.diff(first))
        begin = source[to - self.model.widths[ids] + text]
        end = source[to + text]
        return ids, first, begin, end

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[str]:
        """The text of each run of pieces."""
        model = self.model
        place, _ = arrays.spread(model.spelled_first, ids.astype(np.int64))
        raw = model.spelled[place].tobytes()
        ends = np.concatenate([[0], np.cumsum(model.widths[ids])])[first]
        out = []
        for i in range(len(first) - 1):
            text = raw[ends[i] : ends[i + 1]]
            try:
                spelled = text.decode()
            except UnicodeDecodeError:
                spelled = self._decode_damaged(ids[first[i] : first[i + 1]])
            # the leading space of the first piece is the one that encoding has added
            if spelled.startswith(" ") and (model.dummy_prefix or model.squeeze) and self._leads(ids[first[i] : first[i + 1]]):
                spelled = spelled[1:]
            out.append(spelled)
        return out

    def _leads(self, ids: np.ndarray) -> bool:
        for i in ids:
            if self.model.kinds[i] != CONTROL:
                return self.model.kinds[i] == NORMAL
        return False

    def _decode_damaged(self, ids: np.ndarray) -> str:
        """Byte pieces that are not UTF-8 give one replacement character for each stray byte."""
        out, run = [], b""
        for i in [*ids.tolist(), None]:
            if i is not None and self.model.kinds[i] == BYTE:
                run += bytes([int(self.model.pieces[i][3:5], 16)])
                continue
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[:size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                run = run[size:]
            if i is not None:
                out.append(self.model.spelled[self.model.spelled_first[i] : self.model.spelled_first[i + 1]].tobytes().decode())
        return "".join(out)


def load(path: str) -> PieceModel:
    with open(path, "rb") as file:
        return PieceModel(file.read())


def encode(documents: DataFrame, model: PieceModel, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns of ``documents`` (or those in ``keep``), ``ids``, ``begins``, ``ends`` (bytes of the text) and ``decoded``.

    One pass without a shuffle.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    held: list[Codec] = []

    def compute(column: pa.Array) -> list[pa.Array]:
        if not held:
            held.append(Codec(shared.value))
        ids, first, begin, end = held[0].encode([v or b"" for v in column.cast(pa.binary()).to_pylist()])
        bounds = pa.array(first, pa.int32())
        lists = [pa.ListArray.from_arrays(bounds, pa.array(v, pa.int32())) for v in (ids, begin, end)]
        return [*lists, pa.array(held[0].decode(ids, first), pa.string())]

    added = {"ids": "array<int>", "begins": "array<int>", "ends": "array<int>", "decoded": "string"}
    return arrays.with_columns(documents, compute, added, keep=keep)


def decode(frame: DataFrame, model: PieceModel) -> DataFrame:
    """All columns and ``decoded``, the text of the pieces in ``ids``; null or empty lists give the empty text."""
    arrays.prepare(frame.sparkSession)
    kept = frame.drop("decoded").withColumn("ids", F.col("ids").cast("array<int>"))
    at, shared = kept.columns.index("ids"), frame.sparkSession.sparkContext.broadcast(model)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                piece = batch.slice(row, 500)
                lists = [v or [] for v in piece.column(at).to_pylist()]
                first = np.concatenate([[0], np.cumsum([len(v) for v in lists])]).astype(np.int64)
                ids = np.array([i for v in lists for i in v], np.int32)
                yield piece.append_column("decoded", pa.array(codec.decode(ids, first), pa.string()))

    return kept.mapInArrow(part, StructType([*kept.schema, StructField("decoded", StringType())]))
