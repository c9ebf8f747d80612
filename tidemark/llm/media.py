"""MPEG audio as a column: write frames, resynchronise and parse them, check them, index them.

``store`` puts bytes into MPEG-1 layer III frames of variable bitrate. The frames decode to silence (empty granules), the payload lies
in their ancillary bytes; an ID3v2 tag, a Xing table with a table of contents, header checksums and an ID3v1 tag go with them.
``parse`` reads any MPEG-1/2/2.5 audio of layers I to III: it skips tags and junk, finds frame headers again after damage, reads Xing,
Info and VBRI tables, verifies the 16-bit checksums of layers I and III (layer II protects bits whose number depends on allocation
tables; its frames count as unchecked), and gives the exact duration as samples over rate, and each frame's byte offset.

Null or empty text: one block of 192 spaces is stored. Null media: no frames, nulls or zeros. Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BLOCK = 192
# Fixed values of the MPEG audio header (kbit/s by index 0 to 14, Hz by index 0 to 2).
BITRATES = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {1: (44100, 48000, 32000), 2: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}
#: Blocks in a frame: the index of the smallest bitrate (mono, 48 kHz) whose frame holds them.
BLOCK_BITRATE = {1: 6, 2: 10, 3: 12, 4: 14}
SIDE = 17  # bytes of side information of MPEG-1 layer III, one channel
HEAD = 4 + 2 + SIDE


def crc16(data: bytes) -> int:
    """The audio header checksum: polynomial 0x8005, start 0xFFFF."""
    c = 0xFFFF
    for x in data:
        c ^= x << 8
        for _ in range(8):
            c = (c << 1 ^ 0x8005 if c & 0x8000 else c << 1) & 0xFFFF
    return c


def header(data: bytes, at: int) -> tuple | None:
    """version, layer, protected, rate, frame bytes, samples, channels of the header at this place; None if it is none."""
    if at + 4 > len(data) or data[at] != 0xFF or data[at + 1] & 0xE0 != 0xE0:
        return None
    a, b, c = data[at + 1], data[at + 2], data[at + 3]
    version, layer = {0: 2.5, 2: 2, 3: 1}.get(a >> 3 & 3), {1: 3, 2: 2, 3: 1}.get(a >> 1 & 3)
    index, rate = b >> 4, b >> 2 & 3
    if version is None or layer is None or index in (0, 15) or rate == 3 or c & 3 == 2:
        return None
    hertz, kbit, pad = RATES[version][rate], BITRATES[1 if version == 1 else 2, layer][index], b >> 1 & 1
    samples = 384 if layer == 1 else 1152 if layer == 2 or version == 1 else 576
    size = (12 * kbit * 1000 // hertz + pad) * 4 if layer == 1 else samples // 8 * kbit * 1000 // hertz + pad
    return version, layer, not a & 1, hertz, size, samples, 1 if c >> 6 == 3 else 2


def side_bytes(version: float, channels: int) -> int:
    return (17 if channels == 1 else 32) if version == 1 else (9 if channels == 1 else 17)


def frame_head(index: int) -> bytes:
    """Header, checksum and empty side information of a frame of our own: MPEG-1 layer III, 48 kHz, one channel, protected."""
    head = bytes((0xFF, 0xFA, index << 4 | 1 << 2, 0xC0))
    return head + struct.pack(">H", crc16(head[2:] + bytes(SIDE))) + bytes(SIDE)


OWN_HEADS = {n: frame_head(i) for n, i in BLOCK_BITRATE.items()}
OWN_SIZES = {n: header(h, 0)[4] for n, h in OWN_HEADS.items()}


def syncsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def to_audio(text: str | None) -> bytes:
    """The text's UTF-8 bytes, padded with spaces to whole blocks, as one MPEG stream."""
    raw = (text or "").encode()
    blocks = max(1, -(-len(raw) // BLOCK))
    payload = raw.ljust(blocks * BLOCK)
    full, rest = divmod(blocks, 4)
    frames = np.zeros((full, OWN_SIZES[4]), np.uint8)
    frames[:, :HEAD] = np.frombuffer(OWN_HEADS[4], np.uint8)
    frames[:, HEAD : HEAD + 4 * BLOCK] = np.frombuffer(payload, np.uint8, full * 4 * BLOCK).reshape(full, 4 * BLOCK)
    body = frames.tobytes()
    if rest:
        body += (OWN_HEADS[rest] + payload[full * 4 * BLOCK :]).ljust(OWN_SIZES[rest], b"\0")
    # The table's frame is silent too and counts as none of the stream's frames.
    size, n = OWN_SIZES[1], full + bool(rest)
    starts = [size + min(p * n // 100, full) * OWN_SIZES[4] for p in range(100)]
    toc = bytes(min(255, s * 256 // (size + len(body))) for s in starts)
    xing = (OWN_HEADS[1] + b"Xing" + struct.pack(">III", 7, n, size + len(body)) + toc).ljust(size, b"\0")
    note = b"\x03n_bytes\x00" + str(len(raw)).encode()
    tag = b"TXXX" + syncsafe(len(note)) + b"\0\0" + note
    return b"ID3\x04\0\0" + syncsafe(len(tag)) + tag + xing + body + b"TAG" + b"n_bytes".ljust(125, b"\0")


def parse(data: bytes | None) -> dict:
    """Everything that the stream says; ``payload`` is what our own frames carry."""
    data = data or b""
    out = {"tag_text": None, "id3v1": 0, "vbr": "", "vbr_frames": -1, "vbr_bytes": -1, "toc_crc32": 0, "junk_bytes": 0, "crc_ok": 0, "crc_bad": 0, "crc_unchecked": 0}
    at, end = 0, len(data)
    while data[at : at + 3] == b"ID3" and at + 10 <= end:
        size = sum(x << s for x, s in zip(data[at + 6 : at + 10], (21, 14, 7, 0), strict=True))
        p, stop, syncsafe_sizes = at + 10, min(end, at + 10 + size), data[at + 3] >= 4
        while p + 10 <= stop and data[p : p + 4].strip(b"\0"):
            n = sum(x << s for x, s in zip(data[p + 4 : p + 8], (21, 14, 7, 0) if syncsafe_sizes else (24, 16, 8, 0), strict=True))
            if data[p : p + 4] == b"TXXX":
                out["tag_text"] = data[p + 11 : p + 10 + n].decode("utf-8", "replace").replace("\0", "=")
            p += 10 + n
        at += 10 + size + 10 * bool(data[at + 5] & 0x10)
    if end - at >= 128 and data[end - 128 : end - 125] == b"TAG":
        out["id3v1"], end = 1, end - 128
    offsets, payload, samples, rate, known, first = [], [], 0, 0, {}, True
    mixed = 0
    while at + 4 <= end:
        h = known.get(data[at : at + 4])
        if h is None and (h := header(data, at)) is not None:
            known[data[at : at + 4]] = h
        # a header counts if the stream ends with its frame, or another header follows
        if h is None or at + h[4] > end or (at + h[4] + 4 <= end and known.get(data[at + h[4] : at + h[4] + 4]) is None and header(data, at + h[4]) is None):
            nxt = data.find(b"\xff", at + 1, end)
            out["junk_bytes"] += (nxt if nxt >= 0 else end) - at
            at = nxt if nxt >= 0 else end
            continue
        version, layer, protected, hertz, size, n, channels = h
        body = at + 4 + 2 * protected
        side = side_bytes(version, channels) if layer == 3 else 0
        if protected:
            covered = data[at + 2 : at + 4] + data[body : body + (side if layer == 3 else 16 * channels)]
            if layer == 2:
                out["crc_unchecked"] += 1
            else:
                good = known.get(covered)
                if good is None:
                    good = known[covered] = crc16(covered)
                out["crc_ok" if good == int.from_bytes(data[at + 4 : at + 6], "big") else "crc_bad"] += 1
        if first and layer == 3:
            p = body + side
            if data[p : p + 4] in (b"Xing", b"Info"):
                flags = int.from_bytes(data[p + 4 : p + 8], "big")
                out["vbr"], p = data[p : p + 4].decode(), p + 8
                if flags & 1:
                    out["vbr_frames"], p = int.from_bytes(data[p : p + 4], "big"), p + 4
                if flags & 2:
                    out["vbr_bytes"], p = int.from_bytes(data[p : p + 4], "big"), p + 4
                if flags & 4:
                    out["toc_crc32"] = zlib.crc32(data[p : p + 100])
            elif data[at + 36 : at + 40] == b"VBRI":
                out["vbr"], out["vbr_bytes"], out["vbr_frames"] = "VBRI", *struct.unpack(">II", data[at + 46 : at + 54])
        if not (first and out["vbr"]):
            offsets.append(at)
            samples += n
            mixed |= bool(rate and rate != hertz)
            rate = rate or hertz
            if blocks := OWN_BLOCKS.get(data[at : at + 4]):
                payload.append(data[at + HEAD : at + HEAD + blocks * BLOCK])
        first = False
        at += size
    out["junk_bytes"] += max(0, end - at)
    return out | {"offsets": offsets, "samples": samples, "rate": rate, "mixed_rates": int(mixed), "payload": b"".join(payload)}


OWN_BLOCKS = {h[:4]: n for n, h in OWN_HEADS.items()}


def store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, media: each text as MPEG audio."""
    return common.map_rows(df, [id_col, text_col], {"doc_id": "long", "media": "binary"}, lambda: lambda ids, texts: [ids, [to_audio(t) for t in texts]])


FEATURES = {
    "doc_id": "long", "n_bytes": "long", "payload": "binary", "media_bytes": "long", "media_sha256": "string", "frames": "long", "samples": "long", "rate": "long", "duration_us": "long",
    "vbr": "string", "vbr_frames": "long", "vbr_bytes": "long", "toc_crc32": "long", "crc_ok": "long", "crc_bad": "long", "crc_unchecked": "long", "junk_bytes": "long", "mixed_rates": "long", "seek_offsets": "array<long>",
}


def read(df: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row per stream with FEATURES: what ``parse`` finds; the exact duration is samples / rate seconds (duration_us: rounded down)."""

    def make():
        def f(ids, medias):
            rows = []
            for i, m in zip(ids, medias, strict=True):
                p = parse(m)
                note = p["tag_text"] or ""
                n = int(note[8:]) if note.startswith("n_bytes=") and note[8:].isdigit() else len(p["payload"])
                rows.append((
                    i, n, p["payload"], len(m or b""), hashlib.sha256(m or b"").hexdigest(), len(p["offsets"]), p["samples"], p["rate"], p["samples"] * 1_000_000 // max(1, p["rate"]),
                    p["vbr"], p["vbr_frames"], p["vbr_bytes"], p["toc_crc32"], p["crc_ok"], p["crc_bad"], p["crc_unchecked"], p["junk_bytes"], p["mixed_rates"], p["offsets"],
                ))
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in FEATURES]

        return f

    return common.map_rows(df, [id_col, media_col], FEATURES, make)


def digests(df: DataFrame) -> DataFrame:
    """The columns of op3: digests of what ``read`` gives, made by Spark's own functions."""
    seek = F.sha2(F.array_join(F.col("seek_offsets").cast("array<string>"), ","), 256)
    labels = ("frames", "samples", "rate", "duration_us", "vbr", "vbr_frames", "vbr_bytes", "toc_crc32", "crc_ok", "crc_bad", "junk_bytes")
    return df.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -16, 16)")).alias("tail_crc32"), "media_bytes", "media_sha256",
        F.concat_ws(";", F.lit("mpeg1 layer3"), *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in labels), F.concat(F.lit("seek_sha256="), seek)).alias("feature"),
        "frames", "samples", "rate",
    )
