"""7z archives, in plain Python: the header is read first, so sizes are known before anything is expanded.

Folders whose coders follow one another are read: copy, LZMA, LZMA2, deflate, bzip2, and LZMA behind delta or a branch
filter. Encrypted ones are refused, as are coders with several streams.
"""

from __future__ import annotations

import bz2
import lzma
import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache

#: Format, fixed values: signature, property numbers, and coders by their number.
SIGNATURE = b"7z\xbc\xaf\x27\x1c"
END, HEADER, MAIN, FILES, PACK, UNPACK, SUB, SIZE, CRC, FOLDER, UNPACKED, STREAMS, EMPTY, EMPTY_FILE, NAMES, ENCODED = 0, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 17, 23
CODERS = {
    b"\x00": "copy", b"\x21": "lzma2", b"\x03\x01\x01": "lzma", b"\x04\x01\x08": "deflate", b"\x04\x02\x02": "bzip2",
    b"\x03": "delta", b"\x03\x03\x01\x03": "x86", b"\x04": "x86", b"\x06\xf1\x07\x01": "aes"
}


class Cursor:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise ValueError("the archive's header ends early")
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self) -> int:
        """One to nine bytes: the leading ones of the first tell how many follow."""
        first = self.take(1)[0]
        more = 0
        while more < 8 and first & 0x80 >> more:
            more += 1
        value = int.from_bytes(self.take(more), "little")
        return value if more == 8 else value + ((first & (0x7F >> more)) << 8 * more)

    def bits(self, n: int) -> list[bool]:
        raw = self.take((n + 7) // 8)
        return [bool(raw[k // 8] & 0x80 >> k % 8) for k in range(n)]

    def digests(self, n: int) -> list[int | None]:
        there = [True] * n if self.take(1)[0] else self.bits(n)
        return [struct.unpack("<I", self.take(4))[0] if x else None for x in there]


@dataclass
class Folder:
    coders: list[tuple[str, bytes]] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    digest: int | None = None
    packed_at: int = 0
    packed: int = 0
    files: list[tuple[int, int | None]] = field(default_factory=list)  # sizes and digests

    def expanded(self, data: bytes) -> bytes:
        raw = data[self.packed_at : self.packed_at + self.packed]
        names, size = [name for name, _ in self.coders], self.sizes[0]
        if names == ["copy"]:
            out = raw
        elif names == ["deflate"]:
            out = zlib.decompressobj(-15).decompress(raw, size)
        elif names == ["bzip2"]:
            out = bz2.BZ2Decompressor().decompress(raw, size)
        else:
            out = lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=[_filter(*c) for c in self.coders]).decompress(raw, size)
        if len(out) != size:
            raise ValueError("a folder does not expand to its size")
        if self.digest is not None and zlib.crc32(out) != self.digest:
            raise ValueError("a folder differs from its checksum")
        return out


def _filter(name: str, about: bytes) -> dict:
    if name == "lzma2":
        code = about[0]
        return {"id": lzma.FILTER_LZMA2, "dict_size": min(0xFFFFFFFF, (2 | code & 1) << code // 2 + 11)}
    if name == "lzma":
        rest, lc = divmod(about[0], 9)
        pb, lp = divmod(rest, 5)
        return {"id": lzma.FILTER_LZMA1, "dict_size": max(4096, struct.unpack_from("<I", about, 1)[0]), "lc": lc, "lp": lp, "pb": pb}
    if name == "delta":
        return {"id": lzma.FILTER_DELTA, "dist": about[0] + 1}
    if name == "x86":
        return {"id": lzma.FILTER_X86}
    raise ValueError("the archive is encrypted" if name == "aes" else f"coder {name}")


def _folder(c: Cursor) -> Folder:
    out, inputs, outputs = Folder(), 0, 0
    for _ in range(c.number()):
        flags = c.take(1)[0]
        name = CODERS.get(kind := c.take(flags & 15), kind.hex())
        ins, outs = (c.number(), c.number()) if flags & 16 else (1, 1)
        about = c.take(c.number()) if flags & 32 else b""
        if (ins, outs) != (1, 1):
            raise ValueError(f"coder {name} has several streams")
        inputs, outputs = inputs + ins, outputs + outs
        out.coders.append((name, about))
    for k in range(outputs - 1):
        if (c.number(), c.number()) != (k, k + 1):  # each reads what the next one writes
            raise ValueError("coders do not follow one another")
    return out


def _streams(c: Cursor) -> list[Folder]:
    """Folders with their places and the files in each."""
    at, packed, folders = 0, [], []
    while (kind := c.number()) != END:
        if kind == PACK:
            at, n = 32 + c.number(), c.number()
            while (part := c.number()) != END:
                if part == SIZE:
                    packed = [c.number() for _ in range(n)]
                elif part == CRC:
                    c.digests(n)
        elif kind == UNPACK:
            if c.number() != FOLDER:
                raise ValueError("damaged header")
            n = c.number()
            if c.take(1)[0]:
                raise ValueError("folders outside the header")
            folders = [_folder(c) for _ in range(n)]
            while (part := c.number()) != END:
                if part == UNPACKED:
                    for f in folders:
                        f.sizes = [c.number() for _ in f.coders]
                elif part == CRC:
                    for f, digest in zip(folders, c.digests(n)):
                        f.digest = digest
        elif kind == SUB:
            _files(c, folders)
    if len(packed) < len(folders):
        raise ValueError("damaged header")
    for f, size in zip(folders, packed):
        f.packed_at, f.packed = at, size
        at += size
        if not f.files and f.sizes:
            f.files = [(f.sizes[0], f.digest)]
    return folders


def _files(c: Cursor, folders: list[Folder]) -> None:
    counts = [1] * len(folders)
    kind = c.number()
    if kind == STREAMS:
        counts = [c.number() for _ in folders]
        kind = c.number()
    sizes = []
    for f, n in zip(folders, counts):
        own = [c.number() if kind == SIZE else 0 for _ in range(n - 1)]
        sizes.append([*own, f.sizes[0] - sum(own)] if n else [])
    if kind == SIZE:
        kind = c.number()
    known = [n == 1 and f.digest is not None for f, n in zip(folders, counts)]
    missing = sum(n for n, k in zip(counts, known) if not k)
    digests: list[int | None] = [None] * missing
    while kind != END:
        if kind == CRC:
            digests = c.digests(missing)
        kind = c.number()
    for f, own, k in zip(folders, sizes, known):
        f.files = [(own[0], f.digest)] if k else [(size, digests.pop(0)) for size in own]


def _header(data: bytes) -> Cursor:
    if data[:6] != SIGNATURE:
        raise ValueError("not a 7z archive")
    offset, size, digest = struct.unpack_from("<QQI", data, 12)
    raw = data[32 + offset : 32 + offset + size]
    if len(raw) != size or zlib.crc32(raw) != digest:
        raise ValueError("the archive's header is damaged")
    while raw[:1] == bytes([ENCODED]):
        c = Cursor(raw)
        c.number()
        raw = _streams(c)[0].expanded(data)
    return Cursor(raw)


def entries(data: bytes) -> list[tuple[str, int, Callable[[], bytes]]]:
    """(name, size, how to read it) of each file; folders' contents are expanded once, when the first file is read."""
    c = _header(data)
    if not c.data:
        return []
    if c.number() != HEADER:
        raise ValueError("damaged header")
    folders: list[Folder] = []
    names: list[str] = []
    empty: list[bool] = []
    is_file: list[bool] = []
    while (kind := c.number()) != END:
        if kind == MAIN:
            folders = _streams(c)
        elif kind == FILES:
            n = c.number()
            empty = [False] * n
            while (part := c.number()) != END:
                own = Cursor(c.take(c.number()))
                if part == EMPTY:
                    empty = own.bits(n)
                elif part == EMPTY_FILE:
                    is_file = own.bits(sum(empty))
                elif part == NAMES:
                    own.take(1)
                    names = own.data[1:].decode("utf-16-le").split("\0")[:n]
        else:
            raise ValueError(f"property {kind} of the archive is not known")

    @lru_cache(maxsize=1)
    def content(k: int) -> bytes:
        return folders[k].expanded(data)

    def reader(k: int, at: int, size: int, digest: int | None) -> Callable[[], bytes]:
        def read() -> bytes:
            out = content(k)[at : at + size]
            if len(out) != size or digest is not None and zlib.crc32(out) != digest:
                raise ValueError("a file differs from its checksum")
            return out

        return read

    held = []
    for k, f in enumerate(folders):
        at = 0
        for size, digest in f.files:
            held.append((size, reader(k, at, size, digest)))
            at += size
    out, blank = [], iter([*is_file, *[False] * len(names)])
    for name, nothing in zip(names, empty):
        if not nothing:
            size, read = held.pop(0)
            out.append((name, size, read))
        elif next(blank):
            out.append((name, 0, lambda: b""))
    return out
