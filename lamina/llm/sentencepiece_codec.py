"""SentencePiece encoding that keeps the source offsets of every piece, and decoding.

The text is normalised as the model says: at each place the longest key of the
compiled character map is replaced, white space is escaped, and for every
normalised byte the source byte it came from is recorded. Piece lengths cut the
normalised bytes; the record projects the cuts to byte spans of the source.

Defined results: a NULL text is encoded as the empty text (which has the end id
alone); rows repeat as they come; an empty table gives none; other columns are
ignored unless named in ``keep``.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import text_slices, texts_of

SPACE_MARK = "▁".encode()


# ---- the model's settings --------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass(frozen=True)
class NormalizerSpec:
    """What a model file says about normalisation."""

    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True
    space_as_suffix: bool = False
    user_symbols: tuple[str, ...] = ()


def read_spec(model: bytes) -> NormalizerSpec:
    """Normaliser settings of a serialised model; the numbers are the public schema's."""
    charsmap, flags, suffix, symbols = b"", {3: 1, 4: 1, 5: 1}, False, []
    for number, value in _fields(model):
        if number == 1:  # a piece: text 1, score 2, type 3 (4: user defined)
            piece = dict(_fields(value))
            if piece.get(3) == 4:
                symbols.append(piece[1].decode())
        elif number == 2:  # trainer settings
            suffix = bool(dict(_fields(value)).get(24, 0))
        elif number == 3:  # normaliser settings
            for inner, setting in _fields(value):
                if inner == 2:
                    charsmap = setting
                elif inner in flags:
                    flags[inner] = setting
    return NormalizerSpec(charsmap, bool(flags[3]), bool(flags[4]), bool(flags[5]), suffix, tuple(symbols))


def charsmap_rules(charsmap: bytes) -> dict[bytes, bytes]:
    """The compiled map as source bytes to replacement bytes, found by walking its double array.

    A unit holds a label in its low byte, an offset to its children, and a mark
    for "a key ends below"; the value unit gives the replacement's place.
    """
    if not charsmap:
        return {}
    (size,) = struct.unpack_from("<I", charsmap)
    units = np.frombuffer(charsmap, "<u4", size // 4, 4)
    texts = charsmap[4 + size :]
    rules: dict[bytes, bytes] = {}

    def children(at: int) -> int:
        unit = int(units[at])
        return at ^ ((unit >> 10) << ((unit & 512) >> 6))

    stack = [(children(0), b"")]
    labels = np.arange(1, 256)
    while stack:
        base, key = stack.pop()
        places = base ^ labels
        inside = places < len(units)
        found = units[places[inside]]
        for label in labels[inside][(found & np.uint32(0x800000FF)) == labels[inside]].tolist():
            place = base ^ label
            below = children(place)
            if int(units[place]) >> 8 & 1:
                start = int(units[below]) & 0x7FFFFFFF
                rules[key + bytes([label])] = texts[start : texts.index(b"\0", start)]
            stack.append((below, key + bytes([label])))
    return rules


# ---- normalisation with alignment ------------------------------------------


@dataclass
class Aligned:
    """Normalised bytes; ``source[i]`` is the source byte where byte ``i`` came from, the last one the end."""

    data: bytes
    source: np.ndarray


@dataclass
class Normalizer:
    spec: NormalizerSpec
    rules: dict[bytes, bytes] = field(init=False)
    finder: re.Pattern | None = field(init=False)

    def __post_init__(self) -> None:
        self.rules = {symbol.encode(): symbol.encode() for symbol in self.spec.user_symbols}
        plain = {key: to for key, to in charsmap_rules(self.spec.charsmap).items() if key not in self.rules}
        # User symbols stand before the map; longer keys stand before their prefixes.
        order = sorted(self.rules, key=len, reverse=True) + sorted(plain, key=len, reverse=True)
        self.rules |= plain
        self.finder = self._compile(order)

    @staticmethod
    def _compile(keys: list[bytes]) -> re.Pattern | None:
        if not keys:
            return None
        return re.compile(b"|".join(map(re.escape, keys)))

    def _mapped(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes after the map; the source start of each; the source end of the replaced part each belongs to."""
        plain = np.frombuffer(text, np.uint8)
        starts = np.arange(len(plain))
        ends = starts + 1
        if self.finder is None:
            return plain, starts, ends
        parts, begin, until, last = [], [], [], 0
        for match in self.finder.finditer(text):
            to = np.frombuffer(self.rules[match.group()], np.uint8)
            parts += [plain[last : match.start()], to]
            begin += [starts[last : match.start()], np.full(len(to), match.start(), np.int64)]
            until += [ends[last : match.start()], np.full(len(to), match.end(), np.int64)]
            last = match.end()
        return (
            np.concatenate([*parts, plain[last:]]),
            np.concatenate([*begin, starts[last:]]),
            np.concatenate([*until, ends[last:]]),
        )

    def align(self, text: str) -> Aligned:
        raw = text.encode()
        data, starts, ends = self._mapped(raw)
        spec = self.spec
        lead_from, tail_at = 0, len(raw)
        if spec.trim_spaces:
            blank = data == 32
            held = np.flatnonzero(~blank)
            if not len(held):
                return Aligned(b"", np.zeros(1, np.int64))
            lead_from = int(ends[held[0] - 1]) if held[0] else 0
            tail_at = int(starts[held[-1] + 1]) if held[-1] + 1 < len(data) else len(raw)
            stay = ~(blank & np.append(True, blank[:-1]))
            stay[held[-1] + 1 :] = False
            data, starts = data[stay], starts[stay]
        elif not len(data):
            return Aligned(b"", np.zeros(1, np.int64))
        mark = SPACE_MARK if spec.escape_spaces else b" "
        width = np.where(data == 32, len(mark), 1)
        source = np.repeat(starts, width)
        out = data.tobytes().replace(b" ", mark)
        if spec.dummy_prefix and not spec.space_as_suffix:
            out, source = mark + out, np.append(np.full(len(mark), lead_from, np.int64), source)
        elif spec.dummy_prefix:
            out, source = out + mark, np.append(source, np.full(len(mark), tail_at, np.int64))
        return Aligned(out, np.append(source, tail_at))

    @property
    def only_spaces(self) -> bool:
        """True if all that normalisation does is to escape spaces and put one before the text."""
        spec = self.spec
        return not self.rules and spec.escape_spaces and spec.dummy_prefix and not (spec.trim_spaces or spec.space_as_suffix)

    def project(self, text: str, cuts: np.ndarray) -> np.ndarray:
        """Source byte of each place in the normalised bytes; raises unless the last place is their end."""
        if not self.only_spaces or not text:
            aligned = self.align(text)
            size, found = len(aligned.data), aligned.source
        else:
            # The same record, kept at the spaces only: each moves what follows it.
            data = text.encode()
            blanks = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
            wide, more = len(SPACE_MARK), len(SPACE_MARK) - 1
            size = wide + len(data) + more * len(blanks)
            if cuts[-1] == size:
                ends = blanks + 2 * wide + more * np.arange(len(blanks))
                before = np.searchsorted(ends, cuts, "right")
                following = np.append(blanks, len(data))[before]
                return np.clip(cuts - wide - more * before, 0, following)
            found = None
        if cuts[-1] != size:
            raise ValueError(f"pieces cover {cuts[-1]} of {size} normalised bytes")
        return found[cuts]


# ---- encoding and decoding ---------------------------------------------------


@dataclass
class Encoded:
    """Ids of a text and, for each, the source bytes it covers (end exclusive)."""

    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


WORD = re.compile(" +[^ ]+(?: +\\Z)?| +")
REMEMBERED = 300_000
LONGEST_REMEMBERED = 40


class Codec:
    """A model with its normaliser, its piece lengths and an optional end id.

    If no piece of the vocabulary goes on over a space, merges never cross one:
    words are encoded one by one, and a bounded number of them is remembered.
    """

    def __init__(self, model_file: str, add_end: bool = True) -> None:
        import sentencepiece

        with open(model_file, "rb") as file:
            model = file.read()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normalizer = Normalizer(read_spec(model))
        self.end = np.array([self.model.eos_id()] if add_end else [], np.int32)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = any("▁" in piece.lstrip("▁") for piece in pieces)
        sizes = [
            0 if self.model.is_control(i) else 1 if self.model.is_byte(i) else len(piece.encode())
            for i, piece in enumerate(pieces)
        ]
        self.sizes = np.array(sizes, np.int64)
        self.unknown = self.model.unk_id()
        self.by_word = not crossing and self.normalizer.only_spaces
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            found = self.model.encode(texts, num_threads=1, add_bos=False, add_eos=False)
            return [np.append(np.array(one, np.int32), self.end) for one in found]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        passing: dict[str, bytes] = {}
        split = [_words(text) for text in texts]
        fresh = list(dict.fromkeys(word for words in split for word in words if word not in known))
        for word, found in zip(fresh, self.model.encode(fresh, num_threads=1) if fresh else ()):
            (known if len(word) <= LONGEST_REMEMBERED else passing)[word] = struct.pack(f"<{len(found)}i", *found)
        look = (known | passing if passing else known).__getitem__
        return [np.append(np.frombuffer(b"".join(map(look, words)), "<i4"), self.end) for words in split]

    def spans(self, text: str, ids: np.ndarray) -> Encoded:
        """Projects the pieces to byte spans of ``text``."""
        sizes = self.sizes[ids]
        if (ids == self.unknown).any():
            sizes = self._unknown_sizes(self.normalizer.align(text).data, ids, sizes)
        cuts = np.cumsum(np.append(0, sizes))
        at = self.normalizer.project(text, cuts)
        return Encoded(ids, at[:-1], at[1:])

    def _unknown_sizes(self, data: bytes, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """An unknown piece covers what stands before the next known one."""
        sizes, at = sizes.copy(), 0
        for place, one in enumerate(ids.tolist()):
            if one == self.unknown:
                known = next((i for i in ids[place + 1 :].tolist() if self.sizes[i] and i != self.unknown), None)
                end = len(data) if known is None else data.find(self.model.id_to_piece(known).encode(), at)
                sizes[place] = (end if end >= 0 else len(data)) - at
            at += int(sizes[place])
        return sizes

    def encode(self, texts: list[str]) -> list[Encoded]:
        return [self.spans(text, ids) for text, ids in zip(texts, self.ids(texts))]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.model.decode(ids, num_threads=1) if ids else []


def _words(text: str) -> list[str]:
    """The text cut at each space that follows something else, without that space.

    The model puts a space before whatever it encodes, which stands for the one cut off.
    A text that holds the space mark itself is one word, as marks merge with each other.
    """
    if "▁" in text:
        return [text]
    if "  " not in text and text[:1] != " " and text[-1:] not in (" ", ""):
        return text.split(" ")
    return [word[1:] for word in WORD.findall(" " + text)] if text else []


_codecs: dict[tuple[str, bool], Codec] = {}


def codec(model_file: str, add_end: bool = True) -> Codec:
    """One codec a worker process, kept between its tasks."""
    if (model_file, add_end) not in _codecs:
        _codecs[model_file, add_end] = Codec(model_file, add_end)
    return _codecs[model_file, add_end]


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32), kind))


def encode_documents(
    docs: DataFrame,
    model_file: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    add_end: bool = True,
    decoded: bool = False,
    slice_bytes: int = 1 << 20,
) -> DataFrame:
    """``keep``, then ids, begins and ends (source bytes, end exclusive), and the decoded text if asked for.

    Narrow: texts are encoded where they are read, in slices of bounded bytes.
    Ids and offsets are 32-bit; Spark strings are below 2 GiB.
    """
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"k{i} {kinds[name]}" for i, name in enumerate(keep))
    schema += ", ids array<int>, begins array<int>, ends array<int>" + ", decoded string" * decoded
    names = [f"k{i}" for i in range(len(keep))] + ["ids", "begins", "ends"] + ["decoded"] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model_file, add_end)
        for batch in batches:
            for part in text_slices(batch, "_text", slice_bytes):
                found = tool.encode(texts_of(part, "_text"))
                columns = [part.column(i) for i in range(len(keep))]
                columns += [_lists([getattr(one, name) for one in found], pa.int32()) for name in ("ids", "begins", "ends")]
                if decoded:
                    columns.append(pa.array(tool.decode([one.ids.tolist() for one in found]), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(*[F.col(name).alias(f"k{i}") for i, name in enumerate(keep)], F.col(text).alias("_text"))
    out = rows.mapInArrow(run, schema)
    return out.withColumnsRenamed({f"k{i}": name for i, name in enumerate(keep)})


def decode_documents(rows: DataFrame, model_file: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the text of each row's ids; NULL ids give NULL."""
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"k{i} {kinds[name]}" for i, name in enumerate(keep)), "decoded string"])
    names = [*(f"k{i}" for i in range(len(keep))), "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model_file)
        for batch in batches:
            given = batch.column("_ids").to_pylist()
            texts = iter(tool.decode([one for one in given if one is not None]))
            column = pa.array([None if one is None else next(texts) for one in given], pa.string())
            columns = [*(batch.column(i) for i in range(len(keep))), column]
            yield pa.RecordBatch.from_arrays(columns, names)

    picked = rows.select(*[F.col(name).alias(f"k{i}") for i, name in enumerate(keep)], F.col(ids).alias("_ids"))
    return picked.mapInArrow(run, schema).withColumnsRenamed({f"k{i}": name for i, name in enumerate(keep)})
