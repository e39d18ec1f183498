"""SentencePiece encoding with byte offsets, and decoding.

A text is normalised here: at each place the longest key of the model's compiled character map is
replaced, else one character is kept, and for every byte of the normalised text the byte of the
original that it came from is recorded. The library segments the normalised text (its own
normaliser is switched off), and each piece is projected to its span of original bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortspark.llm.common import appended

MARK = "▁"  # stands for a blank in pieces
MARK_BYTES = MARK.encode()


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = raw[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """Number, value and whole encoding of each field of a protocol-buffer message."""
    at = 0
    while at < len(raw):
        begin = at
        tag, at = _varint(raw, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(raw, at)
        else:
            size, at = _varint(raw, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = raw[at : at + size], at + size
        yield tag >> 3, value, raw[begin:at]


def _length_delimited(number: int, body: bytes) -> bytes:
    size, out = len(body), bytearray([number << 3 | 2])
    while size > 127:
        out.append(size & 127 | 128)
        size >>= 7
    return bytes(out) + bytes([size]) + body


class CharacterMap:
    """Longest-prefix replacement by a compiled map: a double-array trie and the replaced texts.

    The map holds the trie's size, its 32-bit units, and NUL-ended replacements; a leaf's value is
    the place of its replacement. An empty map replaces nothing.
    """

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = struct.unpack_from(f"<{size // 4}I", compiled, 4) if size else ()
        self.texts = compiled[4 + size :]

    @staticmethod
    def _base(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, raw: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest key at ``raw[at:]`` and the key's length."""
        if not self.units:
            return None
        found, node = None, self._base(self.units[0])
        for i in range(at, len(raw)):
            byte = raw[i]
            node ^= byte
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._base(unit)
            if unit >> 8 & 1:
                begin = self.units[node] & 0x7FFFFFFF
                found = self.texts[begin : self.texts.index(b"\0", begin)], i + 1 - at
        return found


class Encoder:
    """Encodes whole texts with a model given as bytes.

    ``encode(text)`` gives ids and, for each id, begin and end of its bytes in the original text.
    The end id covers nothing. ``decode(ids)`` gives the text of ids.
    """

    def __init__(self, model: bytes, add_end: bool = True):
        import sentencepiece

        spec, trainer, kinds, rest = {}, {}, [], []
        for number, value, whole in _fields(model):
            if number == 3:
                spec = {n: v for n, v, _ in _fields(value)}
            else:
                rest.append(whole)
            if number == 2:
                trainer = {n: v for n, v, _ in _fields(value)}
            if number == 1:
                kinds.append({n: v for n, v, _ in _fields(value)}.get(3, 1))
        self.map = CharacterMap(spec.get(2, b""))
        self.prefix = bool(spec.get(3, 1))
        self.squeeze = bool(spec.get(4, 1))
        self.escape = bool(spec.get(5, 1))
        self.suffix = bool(trainer.get(24, 0))
        plain = _length_delimited(3, _length_delimited(1, b"identity") + b"\x18\x00\x20\x00\x28\x00")
        self.segment = sentencepiece.SentencePieceProcessor(model_proto=b"".join(rest) + plain)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end = [self.whole.eos_id()] if add_end and self.whole.eos_id() >= 0 else []
        names = [self.whole.id_to_piece(i) for i in range(self.whole.get_piece_size())]
        self.decimal = list(map(str, range(len(names))))
        self.sizes = np.array([1 if k == 6 else 0 if k == 3 else len(p.encode()) for p, k in zip(names, kinds, strict=True)])
        # without byte pieces the unknown piece has no fixed length
        self.fixed = trainer.get(35, 0) == 1
        self.simple = not self.map.units and self.prefix and not self.squeeze and self.escape and not self.suffix
    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text and, for each of its bytes and its end, the place in the original."""
        raw = text.encode()
        if not raw:
            return "", np.zeros(1, np.int64)
        if self.simple:
            byte = np.frombuffer(raw, np.uint8)
            times = np.where(byte == 32, len(MARK_BYTES), 1)
            origin = np.repeat(np.arange(len(raw)), times)
            return MARK + text.replace(" ", MARK), np.concatenate([np.zeros(len(MARK_BYTES), np.int64), origin, [len(raw)]])
        blank = MARK_BYTES if self.escape else b" "
        steps, at = [], 0
        while at < len(raw):
            step = self.map.longest(raw, at)
            if step is None:
                size = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
                step = raw[at : at + size], size
            steps.append((*step, at))
            at += step[1]
        out, origin = bytearray(), []
        first = 0
        if self.squeeze:
            while first < len(steps) and steps[first][0] == b" ":
                first += 1
            if first == len(steps):
                return "", np.array([len(raw)])
        if self.prefix and not self.suffix:
            out += blank
            origin += [steps[first][2]] * len(blank)
        after_blank = self.squeeze
        for new, _, begin in steps[first:]:
            if after_blank:
                new = new.lstrip(b" ")
            if new:
                put = new.replace(b" ", blank)
                out += put
                origin += [begin] * len(put)
                after_blank = self.squeeze and new.endswith(b" ")
        stop = len(raw)
        if self.squeeze:
            while out.endswith(blank):
                stop = origin[len(out) - len(blank)]
                del out[-len(blank) :], origin[-len(blank) :]
        if self.prefix and self.suffix:
            out += blank
            origin += [stop] * len(blank)
        return out.decode(), np.array([*origin, stop])

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        normal, origin = self.normalise(text or "")
        ids = self.segment.encode(normal, out_type="numpy")
        if self.fixed:
            sizes = self.sizes[ids]
        else:
            sizes = np.array([len(p.encode()) for p in self.segment.encode(normal, out_type=str)], np.int64)
        ends = np.cumsum(sizes)
        if len(origin) - 1 != (ends[-1] if len(ends) else 0):
            raise ValueError("pieces do not cover the normalised text")
        begin = origin[ends - sizes]
        end = origin[ends]
        if self.end:
            last = np.array([len((text or "").encode())])
            begin, end = np.concatenate([begin, last]), np.concatenate([end, last])
        return np.concatenate([ids, np.array(self.end, ids.dtype)]), begin, end

    def id_text(self, ids: np.ndarray) -> str:
        return " ".join(map(self.decimal.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.whole.decode(ids)


FIELDS = {
    "n_tokens": T.LongType(),
    "ids": T.ArrayType(T.IntegerType()),
    "begins": T.ArrayType(T.LongType()),
    "ends": T.ArrayType(T.LongType()),
    "id_text": T.StringType(),
    "covered": T.LongType(),
    "decoded": T.StringType(),
}


def encode_documents(
    docs: DataFrame, model: str | bytes, text: str = "text", fields: tuple[str, ...] = ("ids", "begins", "ends"), add_end: bool = True
) -> DataFrame:
    """``docs`` with the encoding of a text column: one row for each row, all columns kept.

    ``model`` is the path of a model file on the driver, or its bytes; it travels with the tasks.
    ``fields`` picks what is returned: ``n_tokens``, ``ids``, spans of original bytes as ``begins``
    and ``ends``, ``id_text`` (decimal ids joined by blanks), ``covered`` (original bytes that the
    spans cover, all of them unless the normaliser drops blanks) and ``decoded``.

    A null or empty text has no piece but the end id. Texts of any length are encoded whole; equal
    rows give equal results. A column of ``docs`` with the name of a field gives way to it.
    """
    if isinstance(model, str):
        with open(model, "rb") as file:
            model = file.read()

    def make():
        encoder = Encoder(model, add_end)

        def call(texts):
            out: dict[str, list] = {f: [] for f in fields}
            for one in texts:
                ids, begin, end = encoder.encode(one)
                for f in fields:
                    if f == "n_tokens":
                        value = len(ids)
                    elif f == "ids":
                        value = ids
                    elif f == "begins":
                        value = begin
                    elif f == "ends":
                        value = end
                    elif f == "id_text":
                        value = encoder.id_text(ids)
                    elif f == "covered":
                        value = int((np.maximum.accumulate(end) - begin).clip(0).sum()) if len(end) else 0
                    else:
                        value = encoder.decode(ids)
                    out[f].append(value)
            return list(out.values())

        return call

    return appended(docs, text, [(f, FIELDS[f]) for f in fields], make)
