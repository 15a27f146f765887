"""Python data sources that read files in chunks: sequence pieces by byte range, and facts about whole files.

Files are opened through ``pyarrow.fs``, so any store it knows will do; a range never holds more than a block in
memory, whatever the length of a line, a record or a file.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow.fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK = 1 << 20
RANGE_BYTES = 32 << 20
HEADER_BYTES = 1 << 20  # no header line is longer
BLANKS = b" \t\r\n"


class FileRange(NamedTuple):
    path: str
    number: int
    begin: int
    end: int
    size: int


class _Split(InputPartition):
    def __init__(self, part: FileRange) -> None:
        self.value = part


def plain(uri: str) -> str:
    """A local file's URI as its path."""
    return re.sub("^file:/+", "/", uri)


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(plain(uri))


def files_below(uri: str) -> list[tuple[str, int]]:
    """Path and size of a file, or of all files below a folder that are not hidden, in order."""
    store, path = open_store(uri)
    info = store.get_file_info(path)
    if info.type == pyarrow.fs.FileType.NotFound:
        raise FileNotFoundError(uri)
    listed = [info] if info.is_file else store.get_file_info(pyarrow.fs.FileSelector(path, recursive=True))
    prefix = plain(uri).removesuffix(path)
    return sorted((prefix + f.path, f.size) for f in listed if f.is_file and (info.is_file or f.base_name[0] not in "._"))


class _Files(DataSource):
    """Options: ``path`` (or several, one a line, in ``paths``) and ``rangeBytes``."""

    def uris(self) -> list[str]:
        given = self.options.get("paths") or self.options["path"]
        return [p for p in given.split("\n") if p]


class FastaPieces(_Files):
    """Residues of sequence files in pieces; a piece before the first header of its range has no id yet.

    ``start`` counts residues from the header, or from the start of the range where there is none. A header without
    residues gives one empty piece.
    """

    @classmethod
    def name(cls) -> str:
        return "fasta_pieces"

    def schema(self) -> str:
        return "file string, range long, piece long, record long, seq_id string, start long, residues string"

    def reader(self, schema) -> DataSourceReader:
        return _PieceReader(self.uris(), int(self.options.get("rangeBytes", RANGE_BYTES)), int(self.options.get("pieceLength", 1 << 16)))


class _PieceReader(DataSourceReader):
    def __init__(self, uris: list[str], range_bytes: int, length: int) -> None:
        self.uris, self.range_bytes, self.length = uris, range_bytes, length

    def partitions(self) -> list[_Split]:
        out = []
        for uri in self.uris:
            for path, size in files_below(uri):
                step = max(size, 1) if path.endswith(".gz") else self.range_bytes  # compressed files have one range
                out += [_Split(FileRange(path, k, a, min(a + step, size), size)) for k, a in enumerate(range(0, size, step))]
        return out

    def read(self, partition: _Split) -> Iterator[tuple]:
        part = partition.value
        for piece, (record, seq_id, start, residues) in enumerate(pieces_of_range(part, self.length)):
            yield part.path, part.number, piece, record, seq_id, start, residues


class _Bytes:
    """Bytes of a file from a position on, block by block."""

    def __init__(self, part: FileRange) -> None:
        store, path = open_store(part.path)
        if path.endswith(".gz"):
            self._stream, self.end = store.open_input_stream(path, compression="gzip"), None
        else:
            self._stream, self.end = store.open_input_file(path), part.end
            self._stream.seek(part.begin)
        self.at = part.begin

    def block(self, past_end: bool = False) -> bytes:
        wanted = BLOCK if self.end is None or past_end else min(BLOCK, self.end - self.at)
        data = self._stream.read(wanted) if wanted > 0 else b""
        self.at += len(data)
        return data


def _opens_inside_header(part: FileRange) -> tuple[bool, bool]:
    """Whether a range starts inside a header line, and whether it starts a line."""
    if part.begin == 0:
        return False, True
    store, path = open_store(part.path)
    with store.open_input_file(path) as f:
        reach, line = 4096, None
        while line is None:
            low = max(0, part.begin - reach)
            f.seek(low)
            before = f.read(part.begin - low)
            at = before.rfind(b"\n")
            if at >= 0 or low == 0:
                line = before[at + 1 :]
            elif reach >= HEADER_BYTES:
                return False, False
            reach *= 16
    return line.startswith(b">"), not line


def pieces_of_range(part: FileRange, length: int) -> Iterator[tuple[int, str | None, int, str]]:
    """(record, id or None, start, residues) of the residues whose bytes lie in the range, and of headers that start in it."""
    inside_header, at_line_start = _opens_inside_header(part)
    source = _Bytes(part)
    record, seq_id, start, held = 0, None, 0, bytearray()
    data, spent = source.block(), False

    def pieces(final: bool) -> Iterator[tuple[int, str | None, int, str]]:
        nonlocal start
        while len(held) >= length or (final and held):
            cut = bytes(held[:length])
            del held[:length]
            yield record, seq_id, start, cut.decode("latin-1")
            start += len(cut)

    while data:
        if inside_header:
            at = data.find(b"\n")
            inside_header, at_line_start = at < 0, at >= 0
            data = data[at + 1 :] if at >= 0 else b""
        elif at_line_start and data[:1] == b">":
            while b"\n" not in data and not spent:
                more = source.block(past_end=True)
                data, spent = data + more, not more
                if len(data) > HEADER_BYTES + BLOCK:
                    raise ValueError(f"header of more than {HEADER_BYTES} bytes in {part.path}")
            yield from pieces(True)
            line, _, rest = data.partition(b"\n")
            # what was read past the end of the range to finish the header belongs to the next range
            beyond = 0 if source.end is None else max(0, source.at - source.end)
            data = rest[: max(0, len(rest) - beyond)] if beyond else rest
            if beyond:
                spent = True
            record, start = record + 1, 0
            seq_id = (line[1:].split() or [b""])[0].decode("utf-8", "replace")
            yield record, seq_id, 0, ""
            at_line_start = True
        else:
            at = data.find(b"\n>")
            body, data = (data, b"") if at < 0 else (data[: at + 1], data[at + 1 :])
            at_line_start = body.endswith(b"\n")
            held += body.translate(None, BLANKS)
            yield from pieces(False)
        if not data and not spent:
            data = source.block()
    yield from pieces(True)


class FileFacts(_Files):
    """Size, digest, line and record counts and the first line with content of whole files, in one pass over each."""

    @classmethod
    def name(cls) -> str:
        return "file_facts"

    def schema(self) -> str:
        return "path string, size_bytes long, sha256 string, n_lines long, n_records long, n_content_lines long, first_line string"

    def reader(self, schema) -> DataSourceReader:
        return _FactReader(self.uris())


class _FactReader(DataSourceReader):
    def __init__(self, uris: list[str]) -> None:
        self.uris = uris

    def partitions(self) -> list[_Split]:
        return [_Split(FileRange(path, 0, 0, size, size)) for uri in self.uris for path, size in files_below(uri)]

    def read(self, partition: _Split) -> Iterator[tuple]:
        yield file_facts(partition.value.path)


def file_facts(uri: str) -> tuple[str, int, str, int, int, int, str | None]:
    """Facts about a file from one pass in blocks; lines and records of a compressed file are those of its content.

    Content lines are neither blank nor comments (``#``); records are lines that start with ``>``.
    """
    store, path = open_store(uri)
    digest, size = hashlib.sha256(), 0
    lines = records = content = 0
    first: str | None = None
    begun = b""  # up to 4096 bytes of the line that is not over yet
    open_line = False
    with store.open_input_stream(path, compression=None) as raw:
        inflate = _Inflate() if path.endswith(".gz") else None
        while block := raw.read(BLOCK):
            digest.update(block)
            size += len(block)
            for data in inflate(block) if inflate else (block,):
                parts = data.split(b"\n")
                for i, piece in enumerate(parts):
                    if len(begun) < 4096:
                        begun += piece[: 4096 - len(begun)]
                    open_line |= bool(piece)
                    if i + 1 < len(parts):
                        lines, records, content, first = _line(begun, lines, records, content, first)
                        begun, open_line = b"", False
    if open_line:
        lines, records, content, first = _line(begun, lines, records, content, first)
    return uri, size, digest.hexdigest(), lines, records, content, first


def _line(begun: bytes, lines: int, records: int, content: int, first: str | None) -> tuple[int, int, int, str | None]:
    text = begun.strip(BLANKS)
    filled = bool(text) and not text.startswith(b"#")
    if filled and first is None:
        first = text.decode("utf-8", "replace")
    return lines + 1, records + begun.startswith(b">"), content + filled, first


class _Inflate:
    """Content of gzip members in blocks of bounded size."""

    def __init__(self) -> None:
        import zlib

        self._new = lambda: zlib.decompressobj(31)
        self._state = self._new()

    def __call__(self, block: bytes) -> Iterator[bytes]:
        while block:
            data = self._state.decompress(block, BLOCK)
            if data:
                yield data
            if self._state.eof:
                block, self._state = self._state.unused_data, self._new()
            else:
                block = self._state.unconsumed_tail
                if not block and not data:
                    return


def register(spark: SparkSession) -> None:
    for source in (FastaPieces, FileFacts):
        spark.dataSource.register(source)
