"""SentencePiece BPE models: offset-preserving encoding of whole texts and exact decoding.

Normalisation walks the text by longest prefixes of the compiled character map and notes for every normalised
character which source bytes it stands for. Merges run on units (blanks and the word after them): no piece of such a
model goes on over the blank after a word, so units merge independently and repeated words are merged once per task.
Piece bounds are projected through the alignment to spans of source bytes.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.frames import text_or_empty

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Texts are handed on after this many characters, and merged units forgotten after this many.
BATCH_CHARS, KNOWN_UNITS = 1_500_000, 300_000
#: Ids decoded at a time (a longer list by itself).
BATCH_IDS = 400_000
#: Units over this length are merged one by one.
SHORT_UNIT, FAR = 48, 1 << 40


def _fields(blob: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = blob[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(blob):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        elif tag & 7 == 2:
            size, at = number(at)
            value, at = blob[at : at + size], at + size
        else:
            size = 4 if tag & 7 == 5 else 8
            value, at = struct.unpack("<f" if size == 4 else "<d", blob[at : at + size])[0], at + size
        yield tag >> 3, value


class CharacterMap:
    """Compiled map from source strings to normalised ones: a double array over UTF-8 bytes and the target strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0]
        self.cells = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.targets = blob[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, str] | None:
        """Length and target of the longest source string of the map that stands at ``at``."""

        def jump(cell: int) -> int:
            return (cell >> 10) << ((cell & 512) >> 6)

        found, node = None, jump(self.cells[0])
        for i in range(at, len(source)):
            node ^= source[i]
            if node >= len(self.cells):
                break
            cell = self.cells[node]
            if cell & 0x800000FF != source[i]:
                break
            node ^= jump(cell)
            if cell >> 8 & 1:
                found = (i + 1 - at, self.cells[node] & 0x7FFFFFFF)
        if found is None:
            return None
        length, start = found
        return length, self.targets[start : self.targets.index(b"\0", start)].decode()


class PieceModel:
    """A BPE model with byte fallback, read from its file's bytes."""

    def __init__(self, blob: bytes):
        self.pieces, self.scores, self.kinds = [], [], []
        trainer, normalizer = {}, {}
        for field, value in _fields(blob):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(piece.get(2, 0.0))
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError("only BPE models with byte fallback and blanks as prefixes are supported")
        if USER_DEFINED in self.kinds:
            raise ValueError("models with user defined symbols are not supported")
        self.end_id = self.pieces.index("</s>")
        self.map = CharacterMap(normalizer[2]) if normalizer.get(2) else None
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.single_blanks = bool(normalizer.get(4, 1))
        self.space = SPACE if normalizer.get(5, 1) else " "
        self.id_of = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, UNUSED)}
        self.cost = {p: -self.scores[i] for p, i in self.id_of.items()}
        of_byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.byte_ids = np.array([of_byte[b] for b in range(256)])
        self.is_byte = np.array([k == BYTE for k in self.kinds])
        self.is_high = np.array([k == BYTE and int(p[3:5], 16) > 127 for p, k in zip(self.pieces, self.kinds)])
        # Characters that a piece stands for; the bytes of one character count at its first.
        self.chars = np.array([
            int(int(p[3:5], 16) & 0xC0 != 0x80) if k == BYTE else len(p) for p, k in zip(self.pieces, self.kinds)
        ])
        self.shown = [p.replace(SPACE, " ") if k in (NORMAL, UNUSED) else "" for p, k in zip(self.pieces, self.kinds)]
        raw = [bytes([int(p[3:5], 16)]) if k == BYTE else t.encode() for p, k, t in zip(self.pieces, self.kinds, self.shown)]
        self.shown_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.shown_offsets = np.cumsum([0] + [len(r) for r in raw])
        self.units = self._unit_pattern().findall
        self.forget()
        self.pair_keys: np.ndarray | None = None

    def _unit_pattern(self) -> re.Pattern:
        """Blanks and what follows them, cut wherever no piece has the two characters side by side.

        Characters that stand side by side in a piece, blanks left out, make up a group; a unit holds one group.
        """
        group: dict[str, str] = {}

        def top(c: str) -> str:
            while group.setdefault(c, c) != c:
                c = group[c]
            return c

        for piece in self.id_of:
            bare = piece.lstrip(self.space)
            if self.space in bare:
                return re.compile(".+", re.S)
            for a, b in zip(bare, bare[1:]):
                group[top(a)] = top(b)
        groups: dict[str, list[str]] = {}
        for c in group:
            groups.setdefault(top(c), []).append(re.escape(c))
        space = re.escape(self.space)
        sets = sorted(("".join(sorted(g)) for g in groups.values() if len(g) > 1), key=len, reverse=True)
        return re.compile(f"{space}*(?:{''.join(f'[{g}]+|' for g in sets)}[^{space}])|{space}+", re.S)

    def normalize(self, text: str) -> tuple[str, np.ndarray | None]:
        """Normalised text; per character the source byte it begins at, one more for the end.

        None stands for the plain alignment: characters are those of the text, after a dummy prefix of no bytes.
        """
        if self.map is None and not self.single_blanks:
            if not text:
                return "", None
            return (self.space if self.dummy_prefix else "") + text.replace(" ", self.space), None
        source, chars, begins, at = text.encode(), [], [], 0
        while at < len(source):
            found = self.map.longest(source, at) if self.map else None
            if found is None:
                lead = source[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = size, source[at : at + size].decode()
            for c in found[1]:
                if not (self.single_blanks and c == " " and (not chars or chars[-1] == " ")):
                    chars.append(c)
                    begins.append(at)
            at += found[0]
        if self.single_blanks and chars and chars[-1] == " ":
            at = begins.pop()
            chars.pop()
        if chars and self.dummy_prefix:
            chars.insert(0, " ")
            begins.insert(0, begins[0])
        return "".join(chars).replace(" ", self.space), np.array([*begins, at], np.int64)

    def learn(self, units: list[str]) -> None:
        """Merge new units and remember their ids. All units of one batch take their next merge together: the best
        score, the leftmost among equals."""
        if self.pair_keys is None:
            self._tabulate()
        long = [u for u in units if len(u) > SHORT_UNIT]
        short = sorted((u for u in units if len(u) <= SHORT_UNIT), key=len)
        found = [self._learn_short(short[lo : lo + 20_000]) for lo in range(0, len(short), 20_000)]
        found += [(np.array([len(ids)]), ids) for ids in (self.ids_of(self.parts_of_long(u)) for u in long)]
        if found:
            counts, ids = (np.concatenate(x) for x in zip(*found))
            ends = self.pool_offsets[-1] + np.cumsum(counts)
            self.known.update(zip(short + long, range(len(self.pool_offsets) - 1, len(self.pool_offsets) - 1 + len(units))))
            self.pool_offsets = np.concatenate([self.pool_offsets, ends])
            self.pool = np.concatenate([self.pool, ids.astype(np.int32)])

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool, self.pool_offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn_short(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each unit, and all ids."""
        n, width, vocab = len(units), len(units[-1]), len(self.pieces)
        sizes = np.array([len(u) for u in units])
        filled = np.arange(width) < sizes[:, None]
        points = np.zeros((n, width), np.int64)
        points[filled] = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        symbols = np.where(filled, self.symbol_of_char[points], -1).astype(np.int64)
        symbols = np.where(symbols == vocab, vocab + points, symbols)
        rows, done = np.arange(n), []
        costs, _ = self._pairs(symbols[:, :-1], symbols[:, 1:])
        while True:
            at = costs.argmin(1) if width > 1 else np.zeros(len(rows), np.int64)
            each = np.arange(len(rows))
            open_ = costs[each, at] < FAR if width > 1 else np.zeros(len(rows), bool)
            if not open_.all():
                left = np.arange(width) < sizes[~open_][:, None]
                done.append((np.repeat(rows[~open_], sizes[~open_]), symbols[~open_][:, :width][left]))
            if not open_.any():
                break
            rows, symbols, costs, sizes, at = rows[open_], symbols[open_], costs[open_], sizes[open_] - 1, at[open_]
            each = np.arange(len(rows))
            _, merged = self._pairs(symbols[each, at], symbols[each, at + 1])
            step = np.arange(width - 1)
            symbols = np.take_along_axis(symbols, step + (step > at[:, None]), 1)
            step = step[:-1]
            costs = np.take_along_axis(costs, step + (step > at[:, None]), 1)
            symbols[each, at] = merged
            width -= 1
            if width > 1:
                right = at < width - 1
                costs[each[right], at[right]] = self._pairs(symbols[each[right], at[right]], symbols[each[right], at[right] + 1])[0]
                left = at > 0
                costs[each[left], at[left] - 1] = self._pairs(symbols[each[left], at[left] - 1], symbols[each[left], at[left]])[0]
        row, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(row, kind="stable")
        row, ids = row[order], ids[order]
        odd = ids >= vocab  # characters of no piece: their bytes
        if odd.any():
            raw = "".join(map(chr, (ids[odd] - vocab).tolist()))
            repeat = np.ones(len(ids), np.int64)
            repeat[odd] = [len(c.encode()) for c in raw]
            row, ids, odd = np.repeat(row, repeat), np.repeat(ids, repeat), np.repeat(odd, repeat)
            ids[odd] = self.byte_ids[np.frombuffer(raw.encode(), np.uint8)]
        return np.bincount(row, minlength=n), ids

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost and merged symbol of adjacent symbols, ``FAR`` and -1 where they don't merge."""
        keys = left << 21 | right
        at = np.searchsorted(self.pair_keys, keys)
        found = (self.pair_keys[at] == keys) & (right >= 0)
        return np.where(found, self.pair_costs[at], FAR), np.where(found, self.pair_merged[at], -1)

    def _tabulate(self) -> None:
        """All pairs of symbols that merge, and the symbol of every character (those of no piece share one mark)."""
        self.symbol_of_char = np.full(0x110000, len(self.pieces), np.int32)
        for piece, i in self.id_of.items():
            if len(piece) == 1:
                self.symbol_of_char[ord(piece)] = i
        symbol = lambda p: self.id_of.get(p, len(self.pieces) + ord(p) if len(p) == 1 else None)
        pairs = {}
        for piece, i in self.id_of.items():
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 21 | right] = (self.cost[piece], i)
        keys = sorted(pairs)
        self.pair_keys = np.array([*keys, 2**62], np.int64)
        _, ranks = np.unique([*(pairs[k][0] for k in keys), 0.0], return_inverse=True)
        self.pair_costs = ranks.astype(np.int64)
        self.pair_merged = np.array([*(pairs[k][1] for k in keys), -1], np.int64)

    def parts_of_long(self, unit: str) -> list[str]:
        """The unit after all merges, by a queue; for units of any length."""
        chars, n = list(unit), len(unit)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < n and (cost := self.cost.get(chars[left] + chars[right])) is not None:
                heapq.heappush(queue, (cost, left, right, len(chars[left]) + len(chars[right])))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, left, right, size = heapq.heappop(queue)
            if not chars[left] or after[left] != right or not chars[right] or len(chars[left]) + len(chars[right]) != size:
                continue
            chars[left] += chars[right]
            chars[right] = ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [c for c in chars if c]

    def ids_of(self, parts: list[str]) -> np.ndarray:
        ids: list[int] = []
        for piece in parts:
            known = self.id_of.get(piece)
            ids += [known] if known is not None else self.byte_ids[np.frombuffer(piece.encode(), np.uint8)].tolist()
        return np.array(ids, np.int64)

    def encode(self, texts: list[str], spans: bool = False) -> list[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]:
        """Per text its ids without an end id; with ``spans`` also the source bytes ``[begin, end)`` of each."""
        normal = [self.normalize(t) for t in texts]
        units = [self.units(n) for n, _ in normal]
        if len(self.known) > KNOWN_UNITS:
            self.forget()
        self.learn([u for u in set().union(*units) if u not in self.known])
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(units)), np.int64)
        begins, counts = self.pool_offsets[which], self.pool_offsets[which + 1] - self.pool_offsets[which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = self.pool[np.arange(ends[-1]) + np.repeat(begins - ends[:-1], counts)]
        found, at = [], 0
        for text, (normalized, starts), own in zip(texts, normal, units):
            part = ids[ends[at] : ends[at + len(own)]]
            at += len(own)
            found.append((part, *(self._spans(text, normalized, starts, part) if spans else (None, None))))
        return found

    def _spans(self, text: str, normal: str, starts: np.ndarray | None, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if starts is None:
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            sizes = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            starts = np.concatenate([[0] * bool(self.dummy_prefix and len(normal)), [0], np.cumsum(sizes)]).astype(np.int64)
        end = np.cumsum(self.chars[ids])  # bytes after the first of a character add nothing
        begin = end - np.maximum(self.chars[ids], 1)
        return starts[begin], starts[end]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and their offsets for lists of ids: control ids show nothing, bytes that are no UTF-8 show U+FFFD."""
        sizes = self.shown_offsets[ids + 1] - self.shown_offsets[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        where = np.arange(ends[-1]) + np.repeat(self.shown_offsets[ids] - ends[:-1], sizes)
        data, bounds = self.shown_bytes[where], ends[offsets]
        high = np.flatnonzero(self.is_high[ids])
        odd = np.unique(np.searchsorted(offsets, high, side="right") - 1) if len(high) else high
        mended = {}
        for i in odd.tolist():
            raw = data[bounds[i] : bounds[i + 1]].tobytes()
            try:
                raw.decode()
            except UnicodeDecodeError:
                mended[i] = self._decode_odd(ids[offsets[i] : offsets[i + 1]]).encode()
        if mended:
            texts = [mended.get(i, data[b:e].tobytes()) for i, (b, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()))]
            data = np.frombuffer(b"".join(texts), np.uint8)
            bounds = np.cumsum([0] + [len(t) for t in texts])
        if self.dummy_prefix and len(data):
            filled = bounds[:-1] < bounds[1:]
            strip = filled & (data[np.minimum(bounds[:-1], len(data) - 1)] == 32)
            first = np.searchsorted(ends, ends[offsets[:-1]], side="right") - 1  # the piece that shows the first byte
            strip &= ~self.is_byte[ids[np.minimum(first, len(ids) - 1)]]
            data = np.delete(data, bounds[:-1][strip])
            bounds = bounds - np.concatenate([[0], np.cumsum(strip)])
        return data, bounds

    def _decode_odd(self, ids: np.ndarray) -> str:
        text, raw = [], bytearray()
        for i in ids.tolist():
            if self.kinds[i] == BYTE:
                raw.append(int(self.pieces[i][3:5], 16))
                continue
            text += [_lenient(raw), self.shown[i]]
            raw.clear()
        return "".join([*text, _lenient(raw)])


def _lenient(raw: bytearray) -> str:
    """UTF-8 text; each byte that belongs to no valid character becomes U+FFFD."""
    text = ""
    while True:
        try:
            return text + raw.decode()
        except UnicodeDecodeError as bad:
            text += raw[: bad.start].decode() + "\ufffd"
            raw = raw[bad.start + 1 :]


def encode_documents(docs: DataFrame, model_blob: bytes, text: str = "text", spans: bool = False) -> DataFrame:
    """All columns of ``docs`` but those of the result, with ``ids`` (the end id last); with ``spans`` also
    ``begins`` and ``ends``, the source bytes of every id but the end id.

    ``model_blob`` is the model file's content (about half a megabyte). Null and empty texts give the end id alone.
    Rows are worked on one by one, so repeated rows and ties need no rule.
    """
    added = ["ids", "begins", "ends"] if spans else ["ids"]
    rest = [c for c in docs.columns if c not in added]
    types = "ids array<int>" + ", begins array<long>, ends array<long>" * spans

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(model_blob)
        for batch in batches:
            texts = batch.column("_text")
            lengths = np.cumsum(np.asarray(pc.binary_length(texts)))
            cuts = np.flatnonzero(np.diff(lengths // BATCH_CHARS)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                found = model.encode(texts[lo:hi].to_pylist(), spans)
                end = np.array([model.end_id], np.int32)
                columns = [[np.concatenate([f[0], end]) for f in found], [f[1] for f in found], [f[2] for f in found]]
                made = [_lists(c, t) for c, t, _ in zip(columns, (pa.int32(), pa.int64(), pa.int64()), added)]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], *made], names=[*rest, *added])

    schema = docs.select(*[F.col(f"`{c}`") for c in rest]).schema
    full = schema.fields + docs.sparkSession.createDataFrame([], types).schema.fields
    wide = docs.select(*[F.col(f"`{c}`") for c in rest], text_or_empty(text).alias("_text"))
    return wide.mapInArrow(work, type(schema)(full))


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def decode_documents(encoded: DataFrame, model_blob: bytes, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` but ``name``, with the text of ``ids`` as ``name``; no ids give an empty text."""
    rest = [c for c in encoded.columns if c != name]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(model_blob)
        for batch in batches:
            lists = batch.column(ids)
            counts = lists.value_lengths().fill_null(0).to_numpy()
            flat, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(counts)])
            cuts = (np.flatnonzero(np.diff(ends[1:] // BATCH_IDS)) + 1).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                data, bounds = model.decode(flat[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo])
                texts = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], texts.cast(pa.string())], names=[*rest, name])

    schema = encoded.select(*[F.col(f"`{c}`") for c in rest]).schema
    return encoded.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(work, schema.add(name, "string"))
