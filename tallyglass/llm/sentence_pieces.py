"""SentencePiece encoding that keeps offsets: every piece knows its bytes of the text.

Normalisation replaces, at every place, the longest prefix that the model's
compiled character map knows (a double array of bytes, walked as it is in the
model file), or else keeps the character. With the normalised bytes goes an array
with the source byte that each came from, through the white space that the model
adds, removes or rewrites. The ends of a piece in normalised bytes are then looked
up in that array, which gives its span of original bytes. A character that is no
piece becomes its bytes; as in the library, the last of these carries the span.

Pieces come from merging: symbols are characters, of all neighbours that together
are a piece those of the best score join first, the leftmost of several. White
space never follows anything else inside a piece, so text between white space is
encoded on its own, distinct units of a batch together in arrays, and kept in a
bounded cache of the worker. Where a model has other pieces, texts stay whole.

Cases: null texts are empty and have no piece; characters outside the model need
its byte pieces, else the unknown id; texts of any length are encoded whole, long
units with a heap. Decoding replaces bytes that are no UTF-8 one by one, control
ids give nothing and null ids null. Null and repeated ids of documents and other columns pass
through, columns of the added names are replaced; an empty table gives an empty
result. Models that are not of the merging kind or have user-defined or unused
pieces are refused.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyglass.functions.columns import quoted
from tallyglass.llm.common import by_bytes, without
from tallyglass.llm.pieces import PieceCache

# Kinds of pieces, and the character that stands for a space. Fixed values.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGING = 2
SPACE = "▁"

NEVER = np.iinfo(np.int32).max
# Units up to this many characters are merged together in arrays.
LONGEST_TOGETHER = 64
CHARACTERS_TOGETHER = 1 << 18

codecs.register_error("tallyglass-each-byte", lambda e: ("�", e.start + 1))


class CharacterMap:
    """Longest-prefix look-ups in a compiled map of byte strings."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self._units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
        self._pool = compiled[4 + size :]
        firsts = self._first_characters()
        self._candidates = re.compile(f"[{''.join(map(re.escape, firsts))}]") if firsts else None

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _step(self, node: int, byte: int) -> tuple[int, int] | None:
        """Unit and node below ``node`` along ``byte``."""
        at = node ^ byte
        if at >= len(self._units) or self._units[at] & 0x800000FF != byte:
            return None
        return self._units[at], at ^ self._offset(self._units[at])

    def _first_characters(self) -> list[str]:
        found, open_ = [], [(self._offset(self._units[0]), b"")]
        while open_:
            node, prefix = open_.pop()
            for byte in range(1, 256):
                if step := self._step(node, byte):
                    key = prefix + bytes([byte])
                    try:
                        found.append(key.decode())
                    except UnicodeDecodeError:
                        open_.append((step[1], key))
        return sorted(found)

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """Length of the longest key at ``start`` and what replaces it."""
        node, found = self._offset(self._units[0]), None
        for place in range(start, len(text)):
            step = self._step(node, text[place])
            if step is None:
                break
            unit, node = step
            if unit >> 8 & 1:
                value = self._units[node] & 0x7FFFFFFF
                found = place + 1 - start, self._pool[value : self._pool.index(b"\0", value)]
        return found

    def replacements(self, text: str) -> list[tuple[int, int, bytes]]:
        """(start, end, replacement) in bytes of ``text``, in order."""
        if self._candidates is None or not self._candidates.search(text):
            return []
        raw, found = text.encode(), []
        characters = at = 0  # the place reached, in characters and in bytes
        done = 0
        for match in self._candidates.finditer(text):
            at += len(text[characters : match.start()].encode())
            characters = match.start()
            if at < done:
                continue
            if (hit := self.longest(raw, at)) is not None:
                done = at + hit[0]
                found.append((at, done, hit[1]))
        return found


class PieceModel:
    """What a model file says, arranged for arrays."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        trainer, normalizer = proto.trainer_spec, proto.normalizer_spec
        kinds = np.array([p.type for p in proto.pieces])
        if trainer.model_type != MERGING or np.isin(kinds, (USER_DEFINED, UNUSED)).any():
            raise ValueError(f"{path} is no plain model of the merging kind")
        if trainer.treat_whitespace_as_suffix or not normalizer.escape_whitespaces:
            raise ValueError(f"{path} treats white space in a way that is not supported")
        compiled = normalizer.precompiled_charsmap
        self.map = CharacterMap(compiled) if compiled else None
        self.prefix, self.tidy = normalizer.add_dummy_prefix, normalizer.remove_extra_whitespaces
        names = [p.piece for p in proto.pieces]
        self.unknown = int(np.nonzero(kinds == UNKNOWN)[0][0])
        of_byte = {int(names[i], 16): i for i in np.nonzero(kinds == BYTE)[0].tolist() for names[i] in [names[i][1:-1]]}
        self.byte_ids = [of_byte[b] for b in range(256)] if trainer.byte_fallback else None
        self.is_byte = kinds == BYTE
        self.is_control = kinds == CONTROL
        normal = {names[i]: i for i in np.nonzero(kinds == NORMAL)[0].tolist()}
        # Bytes of every piece in normalised text, and decoded.
        self.sizes = np.array([len(n.encode()) for n in names])
        self.sizes[self.is_byte] = 1
        self.surfaces = [n.replace(SPACE, " ").encode() for n in names]
        for byte, i in of_byte.items():
            self.surfaces[i] = bytes([byte])
        for i in np.nonzero(self.is_control)[0].tolist():
            self.surfaces[i] = b""
        self.surfaces[self.unknown] = trainer.unk_surface.encode()
        self.starts_with_space = np.array([k == NORMAL and n[0] == SPACE for n, k in zip(names, kinds)])
        self._characters(normal)
        self._pairs(normal, [p.score for p in proto.pieces])
        longer = [p for p in normal if len(p) > 1]
        inside = re.compile(f"[^{SPACE}]{SPACE}")
        self.splits = not any(map(inside.search, longer))
        self.splits_lines = not any("\n" in p for p in longer)

    def _characters(self, normal: dict[str, int]) -> None:
        """Symbols of characters: ids of pieces, numbers above these for characters that
        only longer pieces have, negative for others."""
        self.of_character = -1 - np.arange(0x110000, dtype=np.int32)
        hidden = len(self.sizes)
        for character in sorted({c for p in normal for c in p}):
            if character not in normal:
                normal, hidden = {**normal, character: hidden}, hidden + 1
            self.of_character[ord(character)] = normal[character]
        self.size = hidden
        self.shown = len(self.sizes)
        self._symbols = normal

    def _pairs(self, normal: dict[str, int], scores: list[float]) -> None:
        symbols, keys, results = self._symbols, [], []
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    results.append(i)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self._keys = np.array(keys, dtype=np.int64)[order]
        self._results = np.array(results, dtype=np.int32)[order]
        # Equal scores have equal ranks.
        ranks = np.unique(-np.array(scores), return_inverse=True)[1].astype(np.int32)
        self._ranks = ranks[self._results] if results else np.zeros(0, np.int32)
        self._pair_of: dict[int, tuple[int, int]] | None = None

    def joined(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of pairs; NEVER for those that are no piece."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left < 0) | (right < 0)] = -1
        if not len(self._keys):
            return np.full(len(keys), NEVER), np.full(len(keys), -1)
        at = np.searchsorted(self._keys, keys)
        at[at == len(self._keys)] = 0
        hit = self._keys[at] == keys
        return np.where(hit, self._ranks[at], NEVER), self._results[at]

    def merge_long(self, symbols: list[int]) -> list[int]:
        """One unit of any length, with a heap of pairs."""
        if self._pair_of is None:
            self._pair_of = dict(zip(self._keys.tolist(), zip(self._ranks.tolist(), self._results.tolist())))
        pair_of, size = self._pair_of, self.size
        after, before = [*range(1, len(symbols)), -1], list(range(-1, len(symbols) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and symbols[i] >= 0 and symbols[j] >= 0:
                if (pair := pair_of.get(symbols[i] * size + symbols[j])) is not None:
                    heapq.heappush(heap, (pair[0], i, symbols[i], symbols[j], pair[1]))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        gone = -(1 << 31)
        while heap:
            _, i, left, right, result = heapq.heappop(heap)
            j = after[i]
            if j < 0 or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], symbols[j] = result, gone
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i, after[i])
            offer(before[i], i)
        return [s for s in symbols if s != gone]

    def merge_together(self, symbols: np.ndarray, lengths: np.ndarray) -> Iterator[tuple]:
        """Many units that stand one after the other in ``symbols``. Yields some at a time:
        their numbers, their symbols after merging, and how many each has."""
        units = np.arange(len(lengths))
        ends = np.cumsum(lengths)
        rank = np.full(len(symbols), NEVER, dtype=np.int64)
        result = np.zeros(len(symbols), dtype=np.int32)
        rank[:-1], result[:-1] = self.joined(symbols[:-1], symbols[1:])
        rank[ends - 1] = NEVER
        while len(units):
            # The least rank of every unit and its leftmost place in one number.
            best = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), ends - lengths)
            at = best & 0xFFFFFFFF
            open_ = best >> 32 < NEVER
            if not open_.all():
                keep = np.repeat(open_, lengths)
                yield units[~open_], symbols[~keep], lengths[~open_]
                at = (np.cumsum(keep) - 1)[at[open_]]
                symbols, rank, result = symbols[keep], rank[keep], result[keep]
                units, lengths = units[open_], lengths[open_]
                if not len(units):
                    break
            symbols[at] = result[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            at = (np.cumsum(keep) - 1)[at]
            symbols, rank, result = symbols[keep], rank[keep], result[keep]
            lengths = lengths - 1
            ends = np.cumsum(lengths)
            rank[at] = NEVER
            here = at[at + 1 < ends]
            rank[here], result[here] = self.joined(symbols[here], symbols[here + 1])
            here = at[at > ends - lengths] - 1
            rank[here], result[here] = self.joined(symbols[here], symbols[here + 1])


# ------------------------------------------------------------------- encoding


class OffsetEncoder:
    """Ids and spans of whole texts."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._cache = PieceCache(self._units, tight=False)
        lines = r"\n" if model.splits_lines else ""
        self._split = re.compile(f"{SPACE}*[^{SPACE}{lines}]+|{SPACE}+" + (r"|\n" if lines else ""))

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The text that pieces cover, and for each of its bytes and its end the byte of
        ``text`` it came from."""
        model = self.model
        replaced = model.map.replacements(text) if model.map else []
        if not replaced and not model.tidy:
            raw = np.frombuffer(text.encode(), np.uint8)
            source = _character_starts(raw)
            return self._escaped(raw, source, text, len(raw))
        raw = text.encode()
        flat = np.frombuffer(raw, np.uint8)
        starts = _character_starts(flat)
        bytes_, sources, at = [], [], 0
        for start, end, replacement in replaced:
            bytes_ += [raw[at:start], replacement]
            sources += [starts[at:start], np.full(len(replacement), start, dtype=np.int32)]
            at = end
        flat = np.frombuffer(b"".join([*bytes_, raw[at:]]), np.uint8)
        source = np.concatenate([*sources, starts[at:]])
        end, skipped = len(raw), 0
        if model.tidy:
            space = flat == 0x20
            words = np.nonzero(~space)[0]
            if not len(words):
                return "", np.zeros(1, dtype=np.int32)
            if words[-1] + 1 < len(flat):
                end = int(source[words[-1] + 1])
            skipped = int(source[words[0]])
            keep = ~space | np.concatenate([[False], ~space[:-1]])
            keep[words[-1] + 1 :] = False
            flat, source = flat[keep], source[keep]
        norm, whole = self._escaped(flat, source, flat.tobytes().decode(), end, skipped)
        if model.tidy and norm.endswith(SPACE):  # written as such in the text
            norm = norm.rstrip(SPACE)
            whole = whole[: len(norm.encode()) + 1]
        return norm, whole

    def _escaped(self, flat: np.ndarray, source: np.ndarray, text: str, end: int, skipped: int = 0):
        if not len(flat):
            return "", np.zeros(1, dtype=np.int32)
        if " " in text:
            source = np.repeat(source, np.where(flat == 0x20, 3, 1))
        before = np.full(3 * self.model.prefix, skipped, dtype=np.int32)
        whole = np.concatenate([before, source, np.array([end], dtype=np.int32)])
        return SPACE * self.model.prefix + text.replace(" ", SPACE), whole

    def _separated(self, norm: str) -> str:
        """Units with a space between them; a normalised text has no other space."""
        if not self.model.splits:
            return norm
        if SPACE * 2 in norm:
            return " ".join(self._split.findall(norm))
        if self.model.splits_lines:
            norm = norm.replace("\n", " \n ")
        return norm.replace(SPACE, " " + SPACE)

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of every unit as bytes of 32-bit integers."""
        found: list[bytes] = [b""] * len(units)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        order = np.argsort(lengths, kind="stable")
        order = order[np.searchsorted(lengths[order], 1) :]
        together = np.searchsorted(lengths[order], LONGEST_TOGETHER, side="right")
        for i in order[together:].tolist():
            found[i] = self._shown(self.model.merge_long(self._symbols(units[i]).tolist()))
        order = order[:together]
        slots = np.cumsum(lengths[order]) // CHARACTERS_TOGETHER
        for chosen in np.split(order, np.nonzero(np.diff(slots))[0] + 1):
            symbols = self._symbols("".join([units[i] for i in chosen.tolist()]))
            for some, merged, counts in self.model.merge_together(symbols, lengths[chosen]):
                ends = np.cumsum(counts)
                raw = merged.astype(np.int32).tobytes()
                for i, a, b in zip(chosen[some].tolist(), (4 * (ends - counts)).tolist(), (4 * ends).tolist()):
                    found[i] = raw[a:b]
                odd = (merged < 0) | (merged >= self.model.shown)
                if odd.any():
                    for k in np.nonzero(np.logical_or.reduceat(odd, ends - counts))[0].tolist():
                        own = merged[ends[k] - counts[k] : ends[k]]
                        found[int(chosen[some[k]])] = self._shown(own.tolist())
        return found

    def _symbols(self, text: str) -> np.ndarray:
        return self.model.of_character[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def _shown(self, symbols: list[int]) -> bytes:
        """Characters that are no piece become their bytes or the unknown id."""
        model, ids = self.model, []
        for s in symbols:
            if 0 <= s < model.shown:
                ids.append(s)
            elif model.byte_ids is None:
                ids.append(model.unknown)
            else:
                character = chr(-1 - s) if s < 0 else chr(int(np.nonzero(model.of_character == s)[0][0]))
                ids += [model.byte_ids[b] for b in character.encode()]
        return np.array(ids, dtype=np.int32).tobytes()

    def ids(self, norms: Sequence[str]) -> list[np.ndarray]:
        made = self._cache.joined([self._separated(n) for n in norms], b"".join)
        return [np.frombuffer(x, np.int32) for x in made]

    def spans(self, norm: str, source: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last bytes, the latter excluded, of every piece in the original text."""
        model = self.model
        if model.byte_ids is None and (ids == model.unknown).any():
            return self._spans_with_unknown(norm, source, ids)
        ends = np.cumsum(model.sizes[ids])
        first, last = source[ends - model.sizes[ids]], source[ends]
        loose = np.nonzero(model.is_byte[ids])[0]
        if len(loose):
            raw = np.frombuffer(norm.encode() + b" ", np.uint8)
            inner = loose[raw[ends[loose]] & 0xC0 == 0x80]
            last[inner] = first[inner]
        return first, last

    def _spans_with_unknown(self, norm: str, source: np.ndarray, ids: np.ndarray):
        sizes, at = [], 0
        raw = norm.encode()
        for i in ids.tolist():
            size = int(self.model.sizes[i])
            if i == self.model.unknown:  # one character
                size = 1
                while at + size < len(raw) and raw[at + size] & 0xC0 == 0x80:
                    size += 1
            sizes.append(size)
            at += size
        ends = np.cumsum(sizes)
        return source[ends - sizes], source[ends]

    def encode(self, texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, first bytes, last bytes) of every text."""
        normalised = [self.normalised(t) for t in texts]
        ids = self.ids([n for n, _ in normalised])
        return [(i, *self.spans(n, s, i)) for i, (n, s) in zip(ids, normalised)]


def _character_starts(raw: np.ndarray) -> np.ndarray:
    """For every byte the place of the first byte of its character."""
    places = np.arange(len(raw), dtype=np.int32)
    if len(raw) and raw.max() >= 0x80:
        places[raw & 0xC0 == 0x80] = 0
        places = np.maximum.accumulate(places)
    return places


class PieceDecoder:
    """Texts of ids: bytes of all pieces by one look-up."""

    def __init__(self, model: PieceModel):
        self._model = model
        self._flat = np.frombuffer(b"".join(model.surfaces), np.uint8)
        self._sizes = np.array([len(s) for s in model.surfaces])
        self._starts = np.cumsum(self._sizes) - self._sizes

    def text(self, ids: np.ndarray) -> str:
        model = self._model
        lengths = self._sizes[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ids) else 0
        place = np.repeat(self._starts[ids] - (ends - lengths), lengths) + np.arange(total)
        raw = self._flat[place].tobytes()
        # The space that stands before every text is no part of it.
        if model.prefix or model.tidy:
            for i in ids.tolist():
                if model.is_control[i]:
                    continue
                if not model.starts_with_space[i]:
                    break
                raw = raw[1:]
                if not (model.tidy and model.surfaces[i] == b" "):
                    break
        return raw.decode("utf-8", "tallyglass-each-byte")


# -------------------------------------------------------------------- on Spark


@lru_cache(maxsize=2)
def encoder(model_path: str) -> OffsetEncoder:
    """One per worker process, so that its cache outlives a task."""
    return OffsetEncoder(PieceModel(model_path))


@lru_cache(maxsize=2)
def decoder(model_path: str) -> PieceDecoder:
    return PieceDecoder(encoder(model_path).model)


def _lists(arrays: Sequence[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


_ADDED = {
    "n_tokens": "bigint",
    "ids": "array<int>",
    "first_bytes": "array<int>",
    "last_bytes": "array<int>",
    "decoded": "string",
}


def _with_columns(df: DataFrame, names: Sequence[str]):
    df = without(df, *names)
    kept = [quoted(c) for c in df.columns]
    return df, df.selectExpr(*kept, *[f"CAST(NULL AS {_ADDED[n]}) AS {n}" for n in names]).schema


def _encoded(part: pa.RecordBatch, text_column: str, model_path: str) -> tuple[list, list[pa.Array]]:
    found = encoder(model_path).encode([t or "" for t in part.column(text_column).to_pylist()])
    counts = pa.array([len(i) for i, _, _ in found], pa.int64())
    return found, [counts, *(_lists([f[k] for f in found]) for k in range(3))]


def encode(docs: DataFrame, model_path: str, text_column: str = "text") -> DataFrame:
    """``docs`` and n_tokens, ids, first_bytes and last_bytes: the span of a piece in the UTF-8
    bytes of the text, its end excluded. Every executor reads the model at that path."""
    docs, schema = _with_columns(docs, list(_ADDED)[:4])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, text_column):
                yield pa.record_batch([*part.columns, *_encoded(part, text_column, model_path)[1]], schema.names)

    return docs.mapInArrow(work, schema)


def decode(encoded: DataFrame, model_path: str, ids_column: str = "ids") -> DataFrame:
    """``encoded`` and the column decoded."""
    encoded, schema = _with_columns(encoded, ["decoded"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(ids_column)
            texts = [
                decoder(model_path).text(r.values.to_numpy(zero_copy_only=False)) if r.is_valid else None
                for r in rows
            ]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return encoded.mapInArrow(work, schema)


def round_trip(docs: DataFrame, model_path: str, text_column: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass."""
    docs, schema = _with_columns(docs, list(_ADDED))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, text_column):
                found, added = _encoded(part, text_column, model_path)
                texts = [decoder(model_path).text(ids) for ids, _, _ in found]
                yield pa.record_batch([*part.columns, *added, pa.array(texts, pa.string())], schema.names)

    return docs.mapInArrow(work, schema)
