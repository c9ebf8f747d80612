import hashlib
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import media

from .conftest import EDGE_IDS, EDGE_TEXTS


def padded(text):
    raw = (text or "").encode()
    return raw.ljust(192 * max(1, -(-len(raw) // 192)))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=900))
def test_round_trip(text):
    text = text.encode("utf-8", "ignore").decode()
    p = media.parse(media.to_audio(text))
    assert p["payload"] == padded(text) and p["crc_bad"] == 0 and p["junk_bytes"] == 0
    assert p["vbr_frames"] == len(p["offsets"]) == p["crc_ok"] - 1 and p["samples"] == 1152 * len(p["offsets"])


def naive(data):
    """A walk that knows layer III of MPEG-1 at 48 kHz alone: tag, then frame by frame; sums bit by bit."""
    size = sum(b << s for b, s in zip(data[6:10], (21, 14, 7, 0), strict=True))
    at, frames, good = 10 + size, [], 0
    kbits = [0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320]
    while data[at : at + 2] == b"\xff\xfa":
        length = 144 * kbits[data[at + 2] >> 4] * 1000 // 48000
        register = 0xFFFF
        for byte in data[at + 2 : at + 4] + data[at + 6 : at + 23]:
            for bit in range(7, -1, -1):
                top = register >> 15 ^ (byte >> bit & 1)
                register = (register << 1 & 0xFFFF) ^ (0x8005 if top else 0)
        good += register == int.from_bytes(data[at + 4 : at + 6], "big")
        frames.append((at, data[at : at + length]))
        at += length
    (table_at, table), *frames = frames
    where = table.index(b"Xing")
    told, total = (int.from_bytes(table[where + k : where + k + 4], "big") for k in (8, 12))
    carried = b"".join(f[23 : 23 + (len(f) - 23) // 192 * 192] for _, f in frames)
    return {"offsets": [o for o, _ in frames], "crc_ok": good, "vbr_frames": told, "vbr_bytes": total, "samples": 1152 * len(frames), "rest": data[at:], "carried": carried, "span": at - table_at}


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=3000))
def test_parse_equals_a_naive_walk(text):
    text = text.encode("utf-8", "ignore").decode()
    data = media.to_audio(text)
    want, got = naive(data), media.parse(data)
    assert {k: got[k] for k in ("offsets", "crc_ok", "vbr_frames", "vbr_bytes", "samples")} == {k: want[k] for k in ("offsets", "crc_ok", "vbr_frames", "vbr_bytes", "samples")}
    assert want["rest"][:3] == b"TAG" and len(want["rest"]) == 128 and want["vbr_bytes"] == want["span"] and want["carried"].startswith(padded(text)) and got["payload"] == padded(text)


def test_resynchronises_after_damage():
    a = media.to_audio("x" * 192 * 14)
    whole = media.parse(a)
    second = whole["offsets"][1]
    hurt = media.parse(a[:second] + b"\xff\xfbjunk" * 3 + a[second:])
    # what follows the first of them looks like a header, but no frame ends where it says
    assert hurt["offsets"] == [o + 18 * (o >= second) for o in whole["offsets"]] and hurt["junk_bytes"] == 18 and hurt["payload"] == whole["payload"]
    flipped = bytearray(a)
    flipped[second + 5] ^= 1
    assert media.parse(bytes(flipped))["crc_bad"] == 1
    assert media.parse(a[: second + 100])["junk_bytes"] == 100
    assert media.parse(None)["offsets"] == [] and media.parse(b"no audio at all")["junk_bytes"] == 15


def test_headers_of_other_kinds():
    assert media.header(bytes((0xFF, 0xFB, 0x90, 0x00)), 0) == (1, 3, False, 44100, 417, 1152, 2)
    assert media.header(bytes((0xFF, 0xF3, 0x40, 0xC0)), 0)[3:] == (22050, 104, 576, 1)
    assert media.header(bytes((0xFF, 0xFF, 0x14, 0x00)), 0)[1:5] == (1, False, 48000, 32)
    assert media.header(b"\xff\xff\xff\xff", 0) is None


def test_rows(edge, empty):
    got = media.digests(media.read(media.store(edge))).collect()
    want = sorted(str((i, len((t or "").encode()), len(padded(t)), hashlib.sha256(padded(t)).hexdigest(), zlib.crc32(padded(t)[-16:]))) for i, t in zip(EDGE_IDS, EDGE_TEXTS, strict=True))
    assert sorted(str((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32)) for r in got) == want
    assert all(hashlib.sha256(media.to_audio(t)).hexdigest() in {r.media_sha256 for r in got} for t in EDGE_TEXTS)
    assert media.digests(media.read(media.store(empty))).count() == 0
