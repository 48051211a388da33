"""Gzip archives unpacked member by member, so that damage costs what is damaged only."""

from __future__ import annotations

import zlib

_READ = 1 << 20
_MOST = 8 << 20  # bytes unpacked at a time
_STEP = 1 << 9  # bytes fed at a time near damage
_MAGIC = b"\x1f\x8b\x08"


class Members:
    """Unpacked bytes of an archive, read by lines or by counts.

    Where a member is damaged or cut off, reading stops as at the end of a file and
    ``problem`` says why; ``resume`` goes on at the next member that can be unpacked. What was
    unpacked before the damage is delivered first.
    """

    def __init__(self, raw):
        self._raw = raw
        self._packed = b""
        self._ended = False  # no more packed bytes
        self._member = None
        self._ready = bytearray()
        self._at = 0
        self._seeking = False  # for the next header behind damage
        self._skip_own = False
        self.problem: str | None = None
        self.in_member = 0  # bytes delivered from the member being read

    def _more_packed(self) -> bool:
        if not self._packed and not self._ended:
            self._packed = self._raw.read(_READ) or b""
            self._ended = not self._packed
        return bool(self._packed)

    def _unpack(self) -> bool:
        """Unpack some more; False at the end or at damage."""
        while self.problem is None:
            if self._member is None:
                if not self._find_member():
                    return False
                self._member, self.in_member = zlib.decompressobj(31), 0
            if not self._more_packed():
                self._fail("cut off")
                return False
            before, packed = self._member.copy(), self._packed
            try:
                found = self._member.decompress(packed, _MOST)
                self._packed = self._member.unused_data if self._member.eof else self._member.unconsumed_tail
            except zlib.error:
                found = self._up_to_damage(before, packed)
            if self._member is not None and self._member.eof:
                self._member = None
            if found:
                self._ready = self._ready[self._at :] + found
                self._at = 0
                self.in_member += len(found)
                return True
        return False

    def _up_to_damage(self, member, packed: bytes) -> bytes:
        """What a damaged piece still holds; it is fed in small steps until it fails."""
        found = []
        for at in range(0, len(packed), _STEP):
            try:
                found.append(member.decompress(packed[at : at + _STEP]))
            except zlib.error as error:
                self._packed = packed[at:]
                self._fail(str(error))
                break
        return b"".join(found)

    def _fail(self, reason: str) -> None:
        self.problem = f"damaged compression: {reason}"
        self._member = None
        self._seeking = True

    def _find_member(self) -> bool:
        """Stand at a member's header; behind damage, at the next one that looks like one."""
        while self._more_packed():
            if not self._seeking:
                if self._packed.startswith(b"\0"):  # padding between members
                    self._packed = self._packed.lstrip(b"\0")
                    continue
                if _MAGIC.startswith(self._packed[:3]) or self._packed.startswith(_MAGIC):
                    return True
                self._fail("no gzip header")
                return False
            at = self._packed.find(_MAGIC, 1 if self._skip_own else 0)
            if at >= 0:
                self._packed, self._seeking = self._packed[at:], False
                return True
            # a header may lie across two reads
            kept = self._packed[-2:]
            rest = self._raw.read(_READ) or b""
            self._packed, self._ended = (kept + rest, False) if rest else (b"", True)
            self._skip_own = False
        return False

    def resume(self) -> None:
        """Go on behind the damage that ``problem`` tells of."""
        self.problem = None
        self._ready, self._at = bytearray(), 0
        self._skip_own = True

    def readline(self) -> bytes:
        start = self._at
        while True:
            end = self._ready.find(b"\n", start)
            if end >= 0:
                line = bytes(self._ready[self._at : end + 1])
                self._at = end + 1
                return line
            start = len(self._ready) - self._at
            if not self._unpack():
                line = bytes(self._ready[self._at :])
                self._at = len(self._ready)
                return line

    def read(self, count: int) -> bytes:
        while len(self._ready) - self._at < count and self._unpack():
            pass
        data = bytes(self._ready[self._at : self._at + count])
        self._at += len(data)
        return data

    def skip(self, count: int) -> int:
        """Pass over bytes without keeping them; how many there were."""
        left = count
        while left:
            here = min(left, len(self._ready) - self._at)
            self._at += here
            left -= here
            if left and not self._unpack():
                break
        return count - left
