"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The model file is compiled into one transducer, three composed: the normaliser (a space at the start of a
text that is not empty, and every space read as U+2581), the pieces with one state for each, the piece
read last, and the byte fallback, arcs that read a character without a piece and write its UTF-8
bytes' pieces. Every arc has what it reads and the ids it writes (``writes``). An arc from piece a to piece b weighs 0
where merging leaves a, b apart, and infinity (no path) where merges by score would have joined or cut
them differently: a sequence of pieces is the one that the model's merges give if and only if every two
neighbours in it are. So composed with a text, in the tropical semiring, exactly the model's
segmentation has a finite weight, and the shortest path is found in one pass over the text: a position
keeps its best last piece; as weights are 0 or infinity, that is the first one found. Models of another kind than BPE, and those with a table of normalisation or
that squeeze spaces, are refused.

No piece has U+2581 after another character, so a path may be cut before each run of them, and the ids
of each stretch are kept in a table of bounded size.

Defined results: null texts are empty and have no ids; U+2581 itself reads as a space, as the library
has it; decoding undoes the normaliser and gives U+FFFD for each byte that is no UTF-8; repeated rows
each get a row; an empty table gives an empty table; only the columns for ids and texts are read, so
names of others don't matter.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE, UNIGRAM = 2, 1  # a model that names no kind is of the latter
KEPT, KEPT_CHARS, HISTORIES, APART = 1 << 17, 48, 1 << 16, 1 << 18  # what a worker remembers at most
INF = float("inf")
#: How bytes that are no UTF-8 are decoded: as one U+FFFD each.
EACH_BYTE = "textengine-each-byte"
codecs.register_error(EACH_BYTE, lambda e: ("\ufffd" * (e.end - e.start), e.end))


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a message in the protocol buffer wire format."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            n = number() if kind == 2 else {5: 4, 1: 8}[kind]
            yield key >> 3, data[at : at + n]
            at += n


class Kept(dict):
    """What make gives for a short stretch; of the older half, what was not read again goes when the newer is full."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, stretch: str) -> bytes:
        got = self.older.get(stretch)
        if got is None:
            got = self.make(stretch)
        if len(stretch) <= KEPT_CHARS:
            if len(self) >= KEPT // 2:
                self.older = dict(self)
                self.clear()
            self[stretch] = got
        return got


class Transducer:
    """The compiled model. encode and decode are those of the model's library."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        kind, self.prefix, charsmap, squeeze = UNIGRAM, True, b"", True
        for f, value in _fields(model):
            if f == 1:
                one = dict(_fields(value))
                self.pieces.append(one.get(1, b"").decode())
                scores.append(struct.unpack("<f", one[2])[0] if 2 in one else 0.0)
                self.kinds.append(one.get(3, NORMAL))
            elif f == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif f == 3:
                spec = dict(_fields(value))
                charsmap, self.prefix, squeeze = spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if kind != BPE:
            raise ValueError("only BPE models are compiled")
        if charsmap or squeeze:
            raise ValueError("only models with the identity normaliser that keep white space are compiled")
        self.scores = scores
        #: The normaliser's arcs: a character read and what the others read instead; its start writes a space.
        self.normaliser = [(" ", SPACE)]
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k in (NORMAL, USER, UNUSED)}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space after another character")
        self.bytes = [-1] * 256
        for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)):
            if k == BYTE:
                self.bytes[int(p[3:5], 16)] = i
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        #: What the arc of a piece writes; those of characters without a piece are added as they are met.
        self.writes: dict[str, tuple[int, ...]] = {p: (i,) for p, i in self.ids.items()}
        # Letters never share a piece with other characters here, so a path may be cut between them too.
        if any(x.isalpha() != y.isalpha() and x != SPACE for p in self.ids for x, y in zip(p, p[1:], strict=False)):
            self.stretches = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        else:
            self.stretches = re.compile(rf"{SPACE}*(?:[^\W\d_]+|(?:[^\w{SPACE}]|[\d_])+)|{SPACE}+").findall
        # An arc: characters read, piece, its ids as little-endian uint32, and whether it and the piece after it stay apart.
        self.arcs = ahocorasick.Automaton()
        every = [self.arc(p) for p in self.ids]
        for arc in every:
            self.arcs.add_word(arc[1], arc)
        self.arcs.make_automaton()
        self.start = (0, None, b"", {})
        self.rows = [arc[3] for arc in (self.start, *every)]
        self.others: dict[str, tuple] = {}  # arcs of characters without a piece
        self.single = {p for p in self.ids if len(p) == 1}
        self.score = {p: scores[i] for p, i in self.ids.items()}
        self.histories: dict[str, tuple] = {}
        self.known = 0
        self.kept = Kept(self._stretch)

    def merges(self, text: str) -> list[str]:
        """The model's merges, done one by one: the definition of the arcs' weights (short texts only)."""
        parts = list(text)
        while True:
            best = max(((self.scores[i], -k) for k in range(len(parts) - 1) if (i := self.ids.get(parts[k] + parts[k + 1])) is not None), default=None)
            if best is None:
                return parts
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def history(self, piece: str) -> tuple[list[float], list[str], list[str], bool]:
        """Of merging a piece alone: the merges' scores, the last and the first part after each, whether one part is left."""
        got = self.histories.get(piece)
        if got is None:
            parts, scores, lasts, firsts = list(piece), [], [piece[-1]], [piece[0]]
            while True:
                best = max(((s, -k) for k in range(len(parts) - 1) if (s := self.score.get(parts[k] + parts[k + 1])) is not None), default=None)
                if best is None:
                    break
                k = -best[1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                scores.append(best[0])
                lasts.append(parts[-1])
                firsts.append(parts[0])
            if len(self.histories) >= HISTORIES:
                self.histories.clear()
            got = self.histories[piece] = scores, lasts, firsts, len(parts) == 1
        return got

    def stay_apart(self, a: str, b: str) -> bool:
        """Whether merging a + b gives a, b: their own merges go on by score, and none across comes first."""
        left, lasts, _, one = self.history(a)
        right, _, firsts, other = self.history(b)
        if not (one and other):
            return False
        i = j = 0
        score = self.score.get
        while True:
            across = score(lasts[i] + firsts[j])
            of_a = left[i] if i < len(left) else -INF
            of_b = right[j] if j < len(right) else -INF
            if across is not None and across > of_a and across >= of_b:
                return False
            if i == len(left) and j == len(right):
                return True
            if of_a >= of_b:
                i += 1
            else:
                j += 1

    def written(self, piece: str) -> tuple[int, ...]:
        """The ids that the arc of a piece or character writes: its own, or those of its bytes, or the unknown one."""
        got = self.writes.get(piece)
        if got is None:
            got = self.writes[piece] = tuple(self.bytes[b] for b in piece.encode()) if min(self.bytes) >= 0 else (self.unknown,)
        return got

    def arc(self, piece: str) -> tuple[int, str, bytes, dict[str, bool]]:
        ids = self.written(piece)
        return len(piece), piece, struct.pack(f"<{len(ids)}I", *ids), {}

    def other(self, char: str) -> tuple[int, str, bytes, dict[str, bool]]:
        got = self.others.get(char)
        if got is None:
            if len(self.others) >= HISTORIES:
                self.others.clear()
            got = self.others[char] = self.arc(char)
        return got

    def finite(self, before: tuple, piece: str) -> bool:
        """Whether the arc of piece weighs 0 after the arc before, and not infinity; known from then on."""
        if self.known >= APART:
            for row in self.rows:
                row.clear()
            self.others.clear()
            self.known = 0
        self.known += 1
        got = before[3][piece] = self.history(piece)[3] if before[1] is None else self.stay_apart(before[1], piece)
        return got

    def path(self, stretch: str) -> list[tuple]:
        """The arcs of the shortest path over the stretch's characters (an unknown character has its own)."""
        n = len(stretch)
        last: list[tuple | None] = [self.start] + [None] * n  # the arc that a path of weight 0 to here ends with
        finite, done = self.finite, 0
        unknown = not self.single.issuperset(stretch)

        def single(end: int) -> None:  # a character that no piece ends at and that is none itself
            char = stretch[end - 1]
            if last[end] is None and last[end - 1] is not None and char not in self.ids and finite(last[end - 1], char):
                last[end] = self.other(char)

        for at, arc in self.arcs.iter(stretch):
            if unknown:
                while done < at:
                    done += 1
                    single(done)
            if last[at + 1] is None:  # without negative weights nothing is shorter than 0
                before = last[at + 1 - arc[0]]
                if before is not None:
                    ok = before[3].get(arc[1])
                    if ok is None:
                        ok = finite(before, arc[1])
                    if ok:
                        last[at + 1] = arc
        if unknown:
            while done < n:
                done += 1
                single(done)
        out, at = [], n
        while at:
            arc = last[at]
            out.append(arc)
            at -= arc[0]
        return out[::-1]

    def _stretch(self, stretch: str) -> bytes:
        return b"".join([arc[2] for arc in self.path(stretch)])

    def encode_bytes(self, text: str) -> bytes:
        """The ids as little-endian uint32."""
        if not text:
            return b""
        for read, written in self.normaliser:
            text = text.replace(read, written)
        text = (SPACE if self.prefix else "") + text
        return b"".join(map(self.kept.__getitem__, self.stretches(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int] | np.ndarray) -> str:
        if not hasattr(self, "out"):
            self.out = pa.array([b"" if k == CONTROL else bytes([int(p[3:5], 16)]) if k == BYTE else " ⁇ ".encode() if k == UNKNOWN else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, self.kinds, strict=True)], pa.large_binary())
        _, ends, written = self.out.take(pa.array(np.asarray(ids, "<u4"))).buffers()
        size = np.frombuffer(ends, "<i8")[len(ids)] if len(ids) else 0
        text = str(memoryview(written)[:size], "utf-8", EACH_BYTE) if size else ""
        return text[1:] if self.prefix and text[:1] == " " else text


_compiled: dict[str, Transducer] = {}


def compiled(model: bytes) -> Transducer:
    """One transducer a Python worker and model."""
    if model not in _compiled:
        _compiled.clear()
        _compiled[model] = Transducer(model)
    return _compiled[model]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, decoded: bool = False) -> DataFrame:
    """(id, n_tokens, ids: little-endian uint32[, text][, decoded]) for every row of docs. The model is a broadcast of its file's size.

    With decoded the ids written are decoded beside it, by the same transducer in the same worker; that is
    ``decode(encode(...))`` with half of its Python workers.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [t.encode_bytes(x or "") for x in part.column(1).to_pylist()]
                columns = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if keep_text:
                    columns.append(part.column(1))
                if decoded:
                    columns.append(pa.array([t.decode(np.frombuffer(x, "<u4")) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_tokens", "ids", *(["text"] if keep_text else []), *(["decoded"] if decoded else [])]
    schema = f"`{id_col}` {kind}, n_tokens long, ids binary" + ", text string" * keep_text + ", decoded string" * decoded
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id") -> DataFrame:
    """The rows of encoded(id, n_tokens, ids[, text]) with decoded."""
    with open(model_path, "rb") as f:
        model = encoded.sparkSession.sparkContext.broadcast(f.read())
    at_ids = encoded.columns.index("ids")
    names = [*encoded.columns, "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t.decode(np.frombuffer(x or b"", "<u4")) for x in part.column(at_ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, decoded string")
