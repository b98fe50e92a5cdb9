"""Compound files, the containers of older office formats: streams in chains of sectors, small ones in a stream of their own,
named by a tree. Reading is bounded by the file's size, whatever its chains and its tree say."""

from __future__ import annotations

import struct
import zlib

_MAGIC = bytes.fromhex("D0CF11E0A1B11AE1")
_END, _FREE, _FAT, _DIFAT, _NONE = 0xFFFFFFFE, 0xFFFFFFFF, 0xFFFFFFFD, 0xFFFFFFFC, 0xFFFFFFFF
_STORAGE, _STREAM, _ROOT = 1, 2, 5
_IN_HEADER = 109


class Damaged(ValueError):
    """The file is no compound file, or a chain or the tree leads nowhere or in a circle."""


class Compound:
    def __init__(self, data: bytes):
        if data[:8] != _MAGIC or len(data) < 512:
            raise Damaged("no compound file")
        self.data = data
        shift, mini_shift = struct.unpack_from("<HH", data, 30)
        if shift not in (9, 12) or mini_shift != 6:
            raise Damaged("sector size")
        self.sector, self.mini = 1 << shift, 1 << mini_shift
        _, directory, _, self.least, mini_fat, _, difat, _ = struct.unpack_from("<8I", data, 44)
        tables, seen = list(struct.unpack_from(f"<{_IN_HEADER}I", data, 76)), set()
        while difat not in (_END, _FREE):
            if difat in seen:
                raise Damaged("circle of tables")
            seen.add(difat)
            *more, difat = struct.unpack(f"<{self.sector // 4}I", self._at(difat))
            tables += more
        self.fat = [n for t in tables if t != _FREE for n in struct.unpack(f"<{self.sector // 4}I", self._at(t))]
        entries = self._chain(directory)
        self.places: dict[str, tuple[int, int]] = {}
        root = entries[:128]
        if len(root) < 128 or root[66] != _ROOT:
            raise Damaged("no root")
        self._walk(entries, struct.unpack_from("<I", root, 76)[0])
        start, size = struct.unpack_from("<IQ", root, 116)
        self.small = self._chain(start)[:size] if size else b""
        packed = self._chain(mini_fat) if mini_fat not in (_END, _FREE) else b""
        self.mini_fat = list(struct.unpack(f"<{len(packed) // 4}I", packed))

    def _at(self, n: int) -> bytes:
        begin = (n + 1) * self.sector
        part = self.data[begin : begin + self.sector]
        if not part:
            raise Damaged("sector beyond the end")
        return part.ljust(self.sector, b"\0")  # the last one may be cut short

    def _numbers(self, start: int, links: list[int]) -> list[int]:
        out: list[int] = []
        while start != _END:
            if start >= len(links) or len(out) >= len(links):
                raise Damaged("chain without an end")
            out.append(start)
            start = links[start]
        return out

    def _chain(self, start: int) -> bytes:
        return b"".join(map(self._at, self._numbers(start, self.fat)))

    def _walk(self, entries: bytes, child: int) -> None:
        """Names of all streams below the root, in the order of the tree (left, itself, its children, right)."""
        seen, todo = set(), [(child, "", False)]
        while todo:
            n, above, ready = todo.pop()
            if n == _NONE:
                continue
            entry = entries[128 * n : 128 * n + 128]
            if len(entry) < 128:
                raise Damaged("entry beyond the directory")
            left, right, inner = struct.unpack_from("<3I", entry, 68)
            if not ready:
                if n in seen:
                    raise Damaged("circle in the tree")
                seen.add(n)
                todo += [(right, above, False), (n, above, True), (left, above, False)]
                continue
            name = above + entry[: max(struct.unpack_from("<H", entry, 64)[0] - 2, 0)].decode("utf-16-le", "replace")
            if entry[66] == _STREAM:
                start, size = struct.unpack_from("<IQ", entry, 116)
                self.places[name] = start, size & 0xFFFFFFFF if self.sector == 512 else size
            elif entry[66] == _STORAGE:
                todo.append((inner, f"{name}/", False))

    def names(self) -> list[str]:
        return list(self.places)

    def __contains__(self, name: str) -> bool:
        return name in self.places

    def stream(self, name: str) -> bytes:
        start, size = self.places[name]
        if size >= self.least:
            data = self._chain(start)
        else:
            data = b"".join(self.small[n * self.mini : (n + 1) * self.mini] for n in self._numbers(start, self.mini_fat)) if size else b""
        if len(data) < size:
            raise Damaged(f"{name} is cut short")
        return data[:size]


def _padded(data: bytes, size: int) -> bytes:
    return data + b"\0" * (-len(data) % size)


def build(streams: dict[str, bytes], least: int = 4096) -> bytes:
    """A compound file of `streams` by path (`storage/name`), with sectors of 512 bytes; streams below `least` bytes go into the small
    ones' stream. Siblings hang in one line to the right."""
    sector, mini = 512, 64
    nodes: list[list] = [["Root Entry", _ROOT, None, b""]]  # name, kind, parent, data
    folders = {"": 0}
    for path, data in streams.items():
        *above, name = path.split("/")
        for k in range(len(above)):
            folder = "/".join(above[: k + 1])
            if folder not in folders:
                folders[folder] = len(nodes)
                nodes.append([above[k], _STORAGE, folders["/".join(above[:k])], b""])
        nodes.append([name, _STREAM, folders["/".join(above)], data])
    small, mini_fat, body, fat, where = b"", [], b"", [], {}

    def put(data: bytes) -> int:
        nonlocal body
        if not data:
            return _END
        first, n = len(fat), -(-len(data) // sector)
        fat.extend([*range(first + 1, first + n), _END])
        body += _padded(data, sector)
        return first

    for k, (_, kind, _, data) in enumerate(nodes):
        if kind == _STREAM and len(data) < least:
            n = -(-len(data) // mini)
            where[k] = len(mini_fat) if n else _END
            mini_fat += [*range(len(mini_fat) + 1, len(mini_fat) + n), _END] if n else []
            small += _padded(data, mini)
        elif kind == _STREAM:
            where[k] = put(data)
    where[0] = put(small)
    first_mini = put(struct.pack(f"<{len(mini_fat)}I", *mini_fat)) if mini_fat else _END
    children: dict[int, list[int]] = {}
    for k, (_, _, parent, _) in enumerate(nodes):
        if parent is not None:
            children.setdefault(parent, []).append(k)
    right = {a: b for line in children.values() for a, b in zip(line, line[1:])}
    directory = b""
    for k, (name, kind, _, data) in enumerate(nodes):
        coded = name.encode("utf-16-le")
        size = len(small) if k == 0 else len(data)
        links = struct.pack("<3I", _NONE, right.get(k, _NONE), children[k][0] if k in children else _NONE)
        directory += coded.ljust(64, b"\0") + struct.pack("<HBB", len(coded) + 2, kind, 1) + links + bytes(36) + struct.pack("<IQ", where.get(k, 0), size)
    first_directory = put(directory)
    per = sector // 4
    tables = difats = 0
    while True:  # the tables have entries for themselves
        need = -(-(len(fat) + tables + difats) // per)
        more = max(0, -(-(need - _IN_HEADER) // (per - 1)))
        if (need, more) == (tables, difats):
            break
        tables, difats = need, more
    at = list(range(len(fat), len(fat) + tables))
    first_difat = len(fat) + tables if difats else _END
    fat += [_FAT] * tables + [_DIFAT] * difats
    body += struct.pack(f"<{tables * per}I", *fat, *[_FREE] * (tables * per - len(fat)))
    rest = at[_IN_HEADER:]
    for k in range(difats):
        part = rest[k * (per - 1) : (k + 1) * (per - 1)]
        body += struct.pack(f"<{per}I", *part, *[_FREE] * (per - 1 - len(part)), first_difat + k + 1 if k + 1 < difats else _END)
    head = [*at[:_IN_HEADER], *[_FREE] * (_IN_HEADER - len(at[:_IN_HEADER]))]
    header = _MAGIC + bytes(16) + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + bytes(6) + struct.pack("<I", 0)
    header += struct.pack("<8I", tables, first_directory, 0, least, first_mini, -(-len(mini_fat) // per), first_difat, difats) + struct.pack(f"<{_IN_HEADER}I", *head)
    return header + body


def hwp_section(text: str, compressed: bool = True) -> bytes:
    """A body section with one paragraph of `text`, as `files.hwp_paragraphs` reads it; control characters other than line ends and tabs
    are left out."""
    units = b"".join(b"\r\0" if c in "\r\n" else b"\t\0" + bytes(6) if c == "\t" else c.encode("utf-16-le") for c in text if c >= " " or c in "\r\n\t")
    size = len(units)
    head = struct.pack("<I", 67 | size << 20) if size < 0xFFF else struct.pack("<II", 67 | 0xFFF << 20, size)
    if not compressed:
        return head + units
    packer = zlib.compressobj(wbits=-15)
    return packer.compress(head + units) + packer.flush()
