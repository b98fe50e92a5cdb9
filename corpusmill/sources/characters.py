"""The characters of a text file, read at any place and never held whole."""

from __future__ import annotations

import codecs
import io
import sys
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import BinaryIO

from ..functions.text import SPACES

#: Bytes of a file that are decoded at once.
BLOCK_BYTES = 1 << 20
#: Tried in this order; the last one reads any bytes.
CODES = ("utf-8", "cp949", "euc-kr", "utf-16", "latin-1")


class Characters:
    """What `files.plain_text` makes of a file that `opened` opens anew each time. One pass finds the code and notes, for each block
    of bytes, its first character and the decoder's state there, so reading may begin at any block."""

    def __init__(self, opened: Callable[[], BinaryIO], block_bytes: int = 0):
        self.opened, self.block_bytes = opened, block_bytes or BLOCK_BYTES
        for code in CODES:
            try:
                self._noted(code)
                return
            except UnicodeDecodeError:
                continue
        raise AssertionError

    def _decoder(self) -> io.IncrementalNewlineDecoder:
        return io.IncrementalNewlineDecoder(codecs.getincrementaldecoder(self.code)(), True)

    def _noted(self, code: str) -> None:
        """The code, blocks, number of characters, and how many there are without the white space at both ends."""
        self.code, self.skipped, self.starts, self.states, self.length = code, 0, [], [], 0
        first, end = 0, 0
        with self.opened() as f:
            if code == "utf-16":  # its own decoder takes no stream without a mark
                mark = f.read(2)
                self.skipped = 2 if mark in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE) else 0
                self.code = "utf-16-be" if mark == codecs.BOM_UTF16_BE or (not self.skipped and sys.byteorder == "big") else "utf-16-le"
            f.seek(self.skipped)
            decoder, data = self._decoder(), b"-"
            while data:
                data = f.read(self.block_bytes)
                self.starts.append(self.length)
                self.states.append(decoder.getstate())
                block = decoder.decode(data, final=not data)
                if rest := block.lstrip(SPACES):
                    first = first if end else self.length + len(block) - len(rest)
                    end = self.length + len(block.rstrip(SPACES))
                self.length += len(block)
        self.stripped_length = end - first

    def blocks(self, start: int, end: int) -> Iterator[str]:
        """The characters from `start` to before `end`, a block at a time."""
        k = bisect_right(self.starts, start) - 1
        at, decoder, data = self.starts[k], self._decoder(), b"-"
        decoder.setstate(self.states[k])
        with self.opened() as f:
            f.seek(self.skipped + k * self.block_bytes)
            while data and at < end:
                data = f.read(self.block_bytes)
                block = decoder.decode(data, final=not data)
                yield block[max(0, start - at) : end - at]
                at += len(block)
