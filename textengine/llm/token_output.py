"""Token-id output: independent Zstandard frames with a seek table and a checksum for each.

A part file holds the ids of consecutive documents, in ascending order of their ids:

    one Zstandard frame a document       its token ids, little-endian, `width` bytes each
    a skippable frame (magic 0x184D2A50)  the index: header and each document's id as int64, Zstandard
    a skippable frame (magic 0x184D2A5E)  the seek table of the public Zstandard seekable format:
                                          for each frame compressed size, size and checksum (uint32,
                                          the low half of XXH64 of its content), then the number of
                                          frames, a descriptor byte and magic 0x8F92EAB1

Any Zstandard decoder reads a part as one stream of ids; a reader that wants some documents reads the
two tables at the end and decompresses the frames of those documents only, each checked by itself.

Parts are written next to each other under a name of the attempt and then moved to the name of their
place in the order, so a repeated task replaces its part by the same bytes and a lost executor loses
nothing that was finished.

Defined results: null texts are empty; null ids go first, with repeated ids in order of their texts; an
empty document has its end id only; an empty table gives no parts and no rows. Ids are those of the
library with its own settings and add_special_tokens=False: an added token's content in a text, such as
<|endoftext|>, is that token. Only the columns for ids and texts are read, so names of others don't
matter. A text of any length is one frame, encoded in one task.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textengine.llm.common import partitions, scratch

INDEX, TABLE, TABLE_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
LEVEL = 3
MANIFEST = "part int, path string, documents long, tokens long, bytes long"


class PartWriter:
    """Writes one part to an open binary stream."""

    def __init__(self, out, width: int, level: int = LEVEL):
        import zstandard

        self.out, self.width = out, width
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=True)
        self.at = self.tokens = 0
        self.ids: list[int | None] = []
        self.entries: list[bytes] = []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, raw: bytes) -> None:
        """A document: its ids, little-endian."""
        import xxhash

        frame = self.pack.compress(raw)
        self._write(frame)
        self.entries.append(struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.tokens += len(raw) // self.width

    def close(self) -> None:
        known = np.array([0 if i is None else i for i in self.ids], "<i8")
        missing = [k for k, i in enumerate(self.ids) if i is None]
        head = json.dumps({"width": self.width, "documents": len(self.ids), "tokens": self.tokens, "null_ids": missing}).encode()
        index = self.pack.compress(struct.pack("<I", len(head)) + head + known.tobytes())
        self._write(struct.pack("<II", INDEX, len(index)) + index)
        table = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), 0x80, TABLE_END)
        self._write(struct.pack("<II", TABLE, len(table)) + table)


class PartReader:
    """Random access to a part: a seekable binary stream of known size."""

    def __init__(self, stream, size: int):
        self.stream = stream
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != TABLE_END or not flags & 0x80:
            raise ValueError("not a part file: its seek table is missing")
        start = size - 9 - 12 * n - 8
        self.table = np.frombuffer(self._read(start + 8, 12 * n), "<u4").reshape(n, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        index = self._unpack(self._read(int(self.offsets[-1]) + 8, start - int(self.offsets[-1]) - 8))
        (k,) = struct.unpack_from("<I", index)
        self.head = json.loads(index[4 : 4 + k])
        known = np.frombuffer(index, "<i8", n, 4 + k).tolist()
        missing = set(self.head["null_ids"])
        self.ids = [None if i in missing else x for i, x in enumerate(known)]
        self.kind = {2: "<u2", 4: "<u4"}[self.head["width"]]

    def _read(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(n)

    def _unpack(self, frame: bytes) -> bytes:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(frame)

    def lengths(self) -> np.ndarray:
        """Ids in each document, from the seek table alone."""
        return self.table[:, 1].astype(np.int64) // self.head["width"]

    def document(self, i: int) -> np.ndarray:
        """The ids of the part's i-th document; only its frame is read."""
        import xxhash

        raw = self._unpack(self._read(int(self.offsets[i]), int(self.table[i, 0])))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[i, 2]:
            raise ValueError(f"document {i} of the part is damaged")
        return np.frombuffer(raw, self.kind)


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


#: White space with the letters, or the other characters, that follow it; letters after an apostrophe go with it.
#: The first branch finds nothing else than the second one, only faster.
_WS = r" \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = re.compile(rf" ?[A-Za-zÀ-ÖØ-öø-ÿ]+[^\W\d_]*|[{_WS}]*(?:[^\W\d_]+|(?:'[^\W\d_]+|[^\w{_WS}]|[\d_])+)|[{_WS}]+").findall
KEPT_PIECES = 1_000_000
#: A space, or none, and Latin letters that every version of Unicode here calls letters: one piece of the library's too.
_PLAIN = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+").fullmatch


def _byte_letters() -> dict[int, str]:
    """How a byte-level tokenizer writes each byte; 0xFF, which is in no UTF-8, as a blank, which is how none is written."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)} | {255: " "}


class Encoder:
    """Encodes with the tokenizers library, each different piece of text once while it is kept.

    A byte-level tokenizer splits a text before its merges, always before white space, and between
    letters and other characters. So a text's ids are those of its pieces in order, which are
    kept in a table of bounded size, of which the earlier half, with the more frequent ones, stays when it is
    full. New runs of letters are encoded many at a time, one a line; where each ends follows from the ids'
    lengths in bytes. Those of Latin letters go to the library's model straight away, split by blanks in place
    of its regular expression. A tokenizer of another kind gets whole texts.

    The library takes added tokens out of a text before anything else, so texts are cut at them first and
    each is a piece of its own. With special_text the contents of special ones are ordinary text instead.
    """

    def __init__(self, path: str, end_id: int, special_text: bool = True):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = special_text
        size = self.library.get_vocab_size()
        self.width = 2 if max(size, end_id + 1) <= 1 << 16 else 4
        self.code, self.kept = {2: "H", 4: "I"}[self.width], {}
        state = json.loads(self.library.to_str())
        before = state["pre_tokenizer"] or {}
        self.by_piece = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not state["normalizer"]
        added = [t for t in state["added_tokens"] if not (special_text and t["special"])]
        # Tokens that take in their surroundings, or that are looked for in a second pass, are left to the library.
        self.by_piece = self.by_piece and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        self.added = {t["content"] for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})").split if added else None
        self.merger, self.letters = Tokenizer(self.library.model), _byte_letters()
        self.merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        # A byte-level token is written with one character for each of its bytes.
        self.bytes_of = np.array([len(self.library.id_to_token(i) or "") for i in range(size)])

    def _whole(self, texts: list[str]) -> list[bytes]:
        return self._ids(self.library, texts)

    def _ids(self, library, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in library.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, text: str) -> list[str]:
        if not self.cut:
            return _PIECES(text)
        sections = self.cut(text)
        if len(sections) == 1:
            return _PIECES(text)
        return [p for i, s in enumerate(sections) for p in ([s] if i % 2 else _PIECES(s))]

    def _learn(self, pieces: list[str]) -> None:
        plain = [p for p in pieces if _PLAIN(p) and p not in self.added]
        known = {*plain, *self.added}
        in_line = {p for p in pieces if p not in known and p.lstrip(" ").isalpha() and p[:2] != "  "}
        rest = [p for p in pieces if p not in in_line and (p not in known or p in self.added)]
        self.kept.update(zip(rest, self._whole(rest), strict=True))
        self._learn_joined([p for p in pieces if p in in_line], 1, lambda chunk: "\n".join(p.decode() for p in chunk), self.library)
        self._learn_joined(plain, 0, lambda chunk: b"\xff".join(chunk).decode("latin-1").translate(self.letters), self.merger)

    def _learn_joined(self, pieces: list[str], between: int, joined: Callable[[list[bytes]], str], library) -> None:
        """Pieces of one pre-token each, 500 in a text; between: ids, of a byte each, that stand between two of them."""
        for at in range(0, len(pieces), 500 * 64):
            chunks = [pieces[i : i + 500] for i in range(at, min(at + 500 * 64, len(pieces)), 500)]
            coded = [[p.encode() for p in chunk] for chunk in chunks]
            for chunk, raw, ids in zip(chunks, coded, self._ids(library, [joined(raw) for raw in coded]), strict=True):
                ends = np.cumsum([len(p) + between for p in raw]) - between
                reached = np.cumsum(self.bytes_of[np.frombuffer(ids, f"<u{self.width}")])
                cuts = np.searchsorted(reached, ends)  # the token that ends each piece
                if (reached[cuts] != ends).any():
                    raise ValueError("the tokenizer joined two pieces")
                start = 0
                for p, last in zip(chunk, ((cuts + 1) * self.width).tolist(), strict=True):
                    self.kept[p] = ids[start:last]
                    start = last + between * self.width

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian, `width` bytes each."""
        if not self.by_piece:
            return self._whole(texts)
        split = [self._pieces(t) for t in texts]
        kept = self.kept
        new = set().union(*split).difference(kept)
        if len(kept) + len(new) > KEPT_PIECES:
            for p in list(islice(kept, KEPT_PIECES // 2, None)):
                del kept[p]
            new = set().union(*split).difference(kept)
        if new:
            self._learn(list(new))
        get = self.kept.__getitem__
        return [b"".join(map(get, s)) for s in split]


@lru_cache(maxsize=1)
def encoder_of(path: str, end_id: int) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path, end_id, special_text=False)


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        encoder = encoder_of(tokenizer, end_id)
        end = array(encoder.code, [end_id]).tobytes()
        context = TaskContext.get()
        part = context.partitionId()
        fs, root = _file_system(folder)
        name, attempt = f"{root}/part-{part:06d}.ids", f"{root}/.attempt-{part:06d}-{context.taskAttemptId()}"
        with fs.open_output_stream(attempt) as out:
            writer = PartWriter(out, encoder.width)
            for batch in (b for some in ([first], batches) for b in some):
                ids = batch.column(0).to_pylist()
                for at in range(0, len(ids), 64):
                    texts = [t or "" for t in batch.column(1).slice(at, 64).to_pylist()]
                    for i, raw in zip(ids[at : at + 64], encoder.encode(texts), strict=True):
                        writer.add(i, raw + end)
            writer.close()
        fs.move(attempt, name)
        row = [part, f"{folder}/part-{part:06d}.ids", len(writer.ids), writer.tokens, writer.at]
        yield pa.RecordBatch.from_pylist([dict(zip(["part", "path", "documents", "tokens", "bytes"], row, strict=True))], pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())]))

    return run


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> list:
    """Writes the parts and returns the manifest: a row (part, path, documents, tokens, bytes) for each, in order.

    The manifest has a row for every part file, not for documents; parts follow from the number of
    shuffle partitions, which grows with the input.
    """
    parts = parts or partitions(docs.sparkSession)
    fs, root = _file_system(folder)
    fs.create_dir(root, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(parts, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    return sorted(ordered.mapInArrow(_writer(folder, tokenizer, end_id), MANIFEST).collect(), key=lambda r: r.part)


def read_ids(spark: SparkSession, manifest: list) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 for every document, read from the part files."""
    starts = np.concatenate([[0], np.cumsum([r.tokens for r in manifest], dtype=np.int64)]).tolist()
    files = spark.createDataFrame([(r.path, s) for r, s in zip(manifest, starts, strict=False)], "path string, start long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, at = _file_system(path)
                with fs.open_input_file(at) as stream:
                    part = PartReader(stream, stream.size())
                    lengths = part.lengths()
                    crcs = [zlib.crc32(part.document(i).astype("<u4").tobytes()) for i in range(len(part.ids))]
                before = start + np.concatenate([[0], np.cumsum(lengths)])[:-1]
                yield pa.RecordBatch.from_arrays([pa.array(part.ids, pa.int64()), pa.array(before.astype(np.int64)), pa.array(lengths), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = files.repartition(max(1, len(manifest)))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    spark = docs.sparkSession
    return read_ids(spark, write_ids(docs, scratch(spark, "ids"), tokenizer, end_id))
