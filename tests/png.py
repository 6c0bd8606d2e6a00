"""A minimal PNG writer: 8 bits per channel, no filters."""

import struct
import zlib


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def write_png(path, rows) -> None:
    """Rows of pixels: ints (gray), 3-tuples (R,G,B) or 4-tuples (R,G,B,A)."""
    first = rows[0][0]
    colour = 0 if isinstance(first, int) else {3: 2, 4: 6}[len(first)]
    lines = b"".join(
        b"\0" + b"".join(bytes([p]) if isinstance(p, int) else bytes(p) for p in row) for row in rows
    )
    header = struct.pack(">IIBBBBB", len(rows[0]), len(rows), 8, colour, 0, 0, 0)
    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", header))
        f.write(_chunk(b"IDAT", zlib.compress(lines)) + _chunk(b"IEND", b""))
