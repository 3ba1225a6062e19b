"""Media columns: payloads as Ogg physical streams.

``to_ogg`` stores each payload as 8-bit mono samples in one logical stream, multiplexed with a second stream
that holds the payload's own length; ``from_ogg`` verifies every page's checksum, reassembles packets from
lacing values, separates the logical streams by serial number and takes time stamps from granule positions.

Defined results: a null text counts as empty, and an empty one is stored as 64 zero bytes; equal texts give equal
bytes and features; an empty table gives no rows. A damaged page is counted and skipped, and packets that it held
part of are dropped; its stream is then marked incomplete. Long texts are stored whole.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import slices

BLOCK, RATE, PACKET = 64, 8000, 4000
SAMPLES, LENGTH = 1, 2  # serial numbers
_HEAD = struct.Struct("<4sBBqIIIB")
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, complete boolean"


def checksum(page: bytes) -> int:
    """The container's CRC-32: polynomial 0x04C11DB7, most significant bit first, from 0. zlib has the same one with bits reversed."""
    crc = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int(f"{crc:032b}"[::-1], 2)


def lacing(n: int) -> bytes:
    return b"\xff" * (n // 255) + bytes([n % 255])


class _Writer:
    """Pages of one logical stream; a page takes whole segments, so a long packet runs on into the next."""

    def __init__(self, serial: int):
        self.serial, self.sequence = serial, 0

    def pages(self, packets: list[bytes], granules: list[int], first: bool, last: bool):
        """Pages for some packets; a packet's granule position stands on the page on which it ends."""
        laces = b"".join(map(lacing, map(len, packets)))
        body, ends, at = b"".join(packets), np.cumsum([len(p) // 255 + 1 for p in packets]), 0
        for lo in range(0, len(laces), 255):
            table = laces[lo : lo + 255]
            size, done = sum(table), int(np.searchsorted(ends, lo + len(table), side="right"))
            granule = granules[done - 1] if done and ends[done - 1] > lo else -1
            flags = (lo > 0 and laces[lo - 1] == 255) | (first and lo == 0) << 1 | (last and lo + 255 >= len(laces)) << 2
            head = _HEAD.pack(b"OggS", 0, flags, granule, self.serial, self.sequence, 0, len(table))
            page = head + table + body[at : at + size]
            yield page[:22] + struct.pack("<I", checksum(page)) + page[26:]
            at, self.sequence = at + size, self.sequence + 1


def encode(payload: bytes, n_bytes: int, packet: int = PACKET, rate: int = RATE) -> bytes:
    """The payload as a stream of 8-bit samples beside a stream of one packet that names ``n_bytes``."""
    samples, length = _Writer(SAMPLES), _Writer(LENGTH)
    out = [*samples.pages([struct.pack("<8sIBB", b"PCM8    ", rate, 1, 8)], [0], True, not payload), *length.pages([b"LENGTH  "], [0], True, False)]
    out += length.pages([struct.pack("<Q", n_bytes)], [0], False, True)
    per_page = max(1, 255 // (packet // 255 + 1))
    cuts = range(0, len(payload), packet)
    for i in range(0, len(cuts), per_page):
        part = [payload[c : c + packet] for c in cuts[i : i + per_page]]
        out += samples.pages(part, [min(len(payload), c + packet) for c in cuts[i : i + per_page]], False, i + per_page >= len(cuts))
    return b"".join(out)


@dataclass
class Stream:
    """A logical stream as read: packets with the granule position of the page each ended on (-1: not the last to end there)."""

    packets: list[tuple[bytes, int]] = field(default_factory=list)
    pages: int = 0
    complete: bool = True
    ended: bool = False
    open: list[bytes] | None = None
    sequence: int = 0


def decode(media: bytes) -> tuple[dict[int, Stream], int]:
    """Logical streams by serial number, and how many pages were damaged. Reading goes on at the next capture pattern."""
    streams: dict[int, Stream] = {}
    bad, at = 0, media.find(b"OggS")
    while 0 <= at:
        head = media[at : at + 27]
        n = head[26] if len(head) == 27 else 0
        table = media[at + 27 : at + 27 + n]
        size = 27 + n + sum(table)
        page = media[at : at + size]
        if len(head) < 27 or len(table) < n or len(page) < size or head[4] or checksum(page[:22] + b"\0\0\0\0" + page[26:]) != int.from_bytes(page[22:26], "little"):
            bad, at = bad + 1, media.find(b"OggS", at + 4)
            continue
        _, _, flags, granule, serial, sequence, _, _ = _HEAD.unpack(head)
        s = streams.setdefault(serial, Stream())
        if sequence != s.sequence:  # a page is missing
            s.complete, s.open = False, None
        s.sequence, s.pages, s.ended = sequence + 1, s.pages + 1, s.ended or bool(flags & 4)
        lost = bool(flags & 1) and s.open is None  # goes on with a packet whose start was lost
        if not flags & 1:
            s.open = None
        begin = pos = 27 + n
        ended_here = []
        for v in table:
            pos += v
            if v < 255:
                if not lost:
                    ended_here.append(b"".join([*(s.open or []), page[begin:pos]]))
                s.open, begin, lost = None, pos, False
        if table and table[-1] == 255:
            s.open = None if lost else [*(s.open or []), page[begin:pos]]
        s.packets += [(p, granule if i == len(ended_here) - 1 else -1) for i, p in enumerate(ended_here)]
        at = media.find(b"OggS", at + size)
    return streams, bad


def timestamps(stream: Stream, rate: int) -> list[float]:
    """Seconds at which the packets after the header end: counted back from each page's granule position by packet lengths."""
    out, later = [], 0
    for data, granule in reversed(stream.packets[1:]):
        later = granule if granule >= 0 else later
        out.append(later / rate)
        later -= len(data)
    return out[::-1]


def features(media: bytes) -> tuple:
    """(n_bytes, payload, feature, complete) of a stored payload."""
    streams, bad = decode(media)
    samples, length = streams.get(SAMPLES, Stream()), streams.get(LENGTH, Stream())
    rate = int.from_bytes(samples.packets[0][0][8:12], "little") if samples.packets else RATE
    payload = b"".join(p for p, _ in samples.packets[1:])
    n_bytes = int.from_bytes(length.packets[1][0], "little") if len(length.packets) > 1 else None
    times, x = timestamps(samples, rate), np.frombuffer(payload, np.uint8)
    complete = not bad and all(s.complete and s.ended and s.open is None for s in (samples, length)) and (not times or times[-1] == len(payload) / rate)
    energy = int((np.bincount(x, minlength=256) * (np.arange(256) - 128) ** 2).sum()) // max(1, len(x))
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    feature = f"streams={len(streams)};pages={sum(s.pages for s in streams.values())};packets={len(samples.packets) - 1};ms={round(1000 * (times[-1] if times else 0))};energy={energy};crossings={crossings};bad={bad}"
    return n_bytes, payload, feature, complete


def to_ogg(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, media): the text's UTF-8 bytes, with zeros up to a positive multiple of 64, as an Ogg stream."""

    def store(batches):
        for b in slices(batches):
            out = []
            for v in b.column(1).cast(pa.large_binary()).to_pylist():
                raw = v or b""
                out.append(encode(raw + b"\0" * (-len(raw) % BLOCK or (0 if raw else BLOCK)), len(raw)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=[key, "media"])

    return docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias("text")).mapInArrow(store, f"{key} long, media binary")


def from_ogg(stored: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row of FEATURES for each row of ``stored`` (key, media); a null media reads as an empty, incomplete stream."""

    def read(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for v in b.column(1):
                media = v.as_py() or b""
                n_bytes, payload, feature, complete = features(media)
                row = (n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), feature, complete)
                for c, x in zip(cols, row):
                    c.append(x)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=_NAMES)

    return stored.select(F.col(key).cast("long").alias("doc_id"), "media").mapInArrow(read, FEATURES)


_NAMES = [c.split()[0] for c in FEATURES.split(", ")]
