"""Progressive JPEG and WARC: round trips, a scalar encoder of all scan kinds, damaged archives."""

import base64
import hashlib
import random

import numpy as np
import pytest

from folioframe.llm import media, progressive_jpeg as pj, warc


def test_payloads_round_trip():
    rng = random.Random(1)
    texts = [b"", b"x", bytes(range(256)) * 5, b" " * 192, bytes([127, 128, 129] * 64), "é€😀".encode() * 400, bytes(rng.randrange(256) for _ in range(5000))]
    payloads, lengths, tensors = media.decode(media.encode(texts))
    assert payloads == [t.ljust(max(1, -(-len(t) // 192)) * 192) for t in texts] and lengths == [len(t) for t in texts]
    assert all(t.dtype == np.uint8 and t.shape[2] == 3 for t in tensors)
    alone = [media.encode([t])[0] for t in texts]
    assert alone == media.encode(texts), "a file doesn't depend on its batch"


def test_a_long_payload():
    text = bytes(random.Random(3).randrange(256) for _ in range(300_000))
    payloads, lengths, tensors = media.decode(media.encode([text, b"short"]))
    assert payloads[0][: len(text)] == text and lengths == [len(text), 5] and tensors[0].shape[0] * tensors[0].shape[1] * 1.5 >= len(text)


def test_chroma_is_subsampled():
    """The written files are 4:2:0, so that reading upsamples: the chroma of a pixel is that of its 2 x 2 square."""
    images, coef = pj.read(media.encode([bytes(range(256)) * 30]))
    assert [c[1:3] for c in images[0].components] == [(2, 2), (1, 1), (1, 1)]
    columns = images[0].shapes[1][1]
    base = images[0].bases[1]
    coef[: images[0].bases[1]] = 0  # flat luma: what is left comes from the chroma
    coef[base : base + columns, 1:] = 0
    tensor = pj.rgb(images, coef)[0]
    assert (tensor[::2] == tensor[1::2]).all() and (tensor[:, ::2] == tensor[:, 1::2]).all() and len(np.unique(tensor)) > 4


class Bits:
    def __init__(self):
        self.text = ""

    def put(self, value, n):
        self.text += format(value, f"0{n}b") if n else ""

    def bytes(self):
        raw = int(self.text + "1" * (-len(self.text) % 8) or "0", 2).to_bytes((len(self.text) + 7) // 8, "big") if self.text else b""
        return raw.replace(b"\xff", b"\xff\x00")


def scalar_file(blocks, sampling, grid, scans, quant=1):
    """A progressive file by a plain encoder with end-of-band runs and refinement; no restart intervals.

    blocks: per component rows x columns x 64 zigzag coefficients.
    """
    dc_code, dc_len = pj._codes(pj.DC_COUNTS, pj.DC_SYMBOLS)
    symbols = [r << 4 | s for r in range(16) for s in range(11)]
    symbols += [r << 4 for r in range(15) if r << 4 not in symbols]
    counts = [0] * 7 + [0, len(symbols)] + [0] * 7
    ac_code, ac_len = pj._codes(counts, symbols)
    out = b"\xff\xd8" + pj._segment(0xDB, bytes([0, *[quant] * 64])) + pj._segment(0xC4, bytes([0, *pj.DC_COUNTS, *pj.DC_SYMBOLS])) + pj._segment(0xC4, bytes([0x10, *counts, *symbols]))
    wide, high = max(h for h, _ in sampling), max(v for _, v in sampling)
    height, width = grid
    out += pj._segment(0xC2, bytes([8, *height.to_bytes(2, "big"), *width.to_bytes(2, "big"), len(sampling), *(x for i, (h, v) in enumerate(sampling) for x in (i + 1, h << 4 | v, 0))]))
    mcus = (-(-height // (8 * high)), -(-width // (8 * wide)))
    for parts, first, last, ah, al in scans:
        order = []
        if len(parts) > 1:
            for my in range(mcus[0]):
                for mx in range(mcus[1]):
                    order += [(c, my * sampling[c][1] + y, mx * sampling[c][0] + x) for c in parts for y in range(sampling[c][1]) for x in range(sampling[c][0])]
        else:
            h, v = sampling[parts[0]]
            order = [(parts[0], y, x) for y in range(-(-height * v // (8 * high))) for x in range(-(-width * h // (8 * wide)))]
        bits, before, eob, held = Bits(), {c: 0 for c in parts}, 0, []

        def symbol(s, bits=bits):
            bits.put(int(ac_code[s]), int(ac_len[s]))

        def flush():
            nonlocal eob, held
            if eob:
                r = eob.bit_length() - 1
                symbol(r << 4)
                bits.put(eob - (1 << r), r)
                for b in held:
                    bits.put(b, 1)
            eob, held = 0, []

        for c, y, x in order:
            z = [int(q) for q in blocks[c][y][x]]
            if first == 0 and not ah:
                v = z[0] >> al
                d = v - before[c]
                before[c] = v
                n = abs(d).bit_length()
                bits.put(int(dc_code[n]), int(dc_len[n]))
                bits.put(d if d >= 0 else d + (1 << n) - 1, n)
            elif first == 0:
                bits.put(z[0] >> al & 1, 1)
            elif not ah:
                run = 0
                for k in range(first, last + 1):
                    v = abs(z[k]) >> al
                    if not v:
                        run += 1
                        continue
                    flush()
                    while run > 15:
                        symbol(0xF0)
                        run -= 16
                    n = v.bit_length()
                    symbol(run << 4 | n)
                    bits.put(v if z[k] > 0 else (1 << n) - 1 - v, n)
                    run = 0
                if run:
                    eob += 1
                    if eob == 32767:
                        flush()
            else:
                run, tail = 0, []
                newest = max((k for k in range(first, last + 1) if abs(z[k]) >> al == 1), default=0)
                for k in range(first, last + 1):
                    v = abs(z[k]) >> al
                    if not v:
                        run += 1
                        continue
                    while run > 15 and k <= newest:
                        flush()
                        symbol(0xF0)
                        for b in tail:
                            bits.put(b, 1)
                        run, tail = run - 16, []
                    if v > 1:
                        tail.append(v & 1)
                        continue
                    flush()
                    symbol(run << 4 | 1)
                    bits.put(1 if z[k] > 0 else 0, 1)
                    for b in tail:
                        bits.put(b, 1)
                    run, tail = 0, []
                if run or tail:
                    eob += 1
                    held += tail
        flush()
        out += pj._scan_header([c + 1 for c in parts], first, last, ah, al) + bits.bytes()
    return out + b"\xff\xd9"


SCRIPT = [([0, 1, 2], 0, 0, 0, 1), ([0], 1, 5, 0, 2), ([2], 1, 63, 0, 1), ([1], 1, 63, 0, 1), ([0], 6, 63, 0, 2), ([0], 1, 63, 2, 1), ([0, 1, 2], 0, 0, 1, 0), ([2], 1, 63, 1, 0), ([1], 1, 63, 1, 0), ([0], 1, 63, 1, 0)]


@pytest.mark.parametrize("sampling", [[(1, 1)] * 3, [(2, 2), (1, 1), (1, 1)], [(2, 1), (1, 1), (1, 1)]])
@pytest.mark.parametrize("size", [(8, 8), (37, 50)])
def test_all_scan_kinds(sampling, size):
    rng = np.random.default_rng(4)
    wide, high = max(h for h, _ in sampling), max(v for _, v in sampling)
    mcus = (-(-size[0] // (8 * high)), -(-size[1] // (8 * wide)))
    blocks = []
    for h, v in sampling:
        b = np.where(rng.random((mcus[0] * v, mcus[1] * h, 64)) < 0.12, rng.integers(-40, 41, (mcus[0] * v, mcus[1] * h, 64)), 0)
        b[..., 0] = rng.integers(-200, 200, b.shape[:2])
        used = (-(-size[0] * v // (8 * high)), -(-size[1] * h // (8 * wide)))
        b[used[0] :, :, 1:] = 0
        b[:, used[1] :, 1:] = 0
        blocks.append(b)
    data = scalar_file(blocks, sampling, size, SCRIPT, quant=2)
    images, coef = pj.read([data, media.encode([b"other"])[0], data])
    for image in (images[0], images[2]):
        for base, (r, c), b in zip(image.bases, image.shapes, blocks, strict=True):
            assert (coef[base : base + r * c].reshape(r, c, 64) == b).all()
    tensor = pj.rgb(images, coef)[0]
    assert tensor.shape == (*size, 3)
    # one luma sample and its colours by the definition
    y, x = size[0] - 1, size[1] - 3

    def sample(c):
        h, v = sampling[c]
        yy, xx = y * v // high, x * h // wide
        f = np.zeros(64)
        f[pj.ZIGZAG] = blocks[c][yy // 8][xx // 8] * 2
        u = np.arange(8)
        k = np.where(u == 0, np.sqrt(1 / 8), 0.5)
        value = np.einsum("u,v,uv->", k * np.cos((2 * (yy % 8) + 1) * u * np.pi / 16), k * np.cos((2 * (xx % 8) + 1) * u * np.pi / 16), f.reshape(8, 8))
        return np.clip(round(value + 128), 0, 255)

    luma, cb, cr = sample(0), sample(1) - 128, sample(2) - 128
    want = [luma + 1.402 * cr, luma - 0.344136 * cb - 0.714136 * cr, luma + 1.772 * cb]
    assert np.abs(np.clip(want, 0, 255) - tensor[y, x]).max() <= 2.5


def test_damaged_jpeg_raises():
    good = media.encode([b"some text" * 50])[0]
    with pytest.raises(ValueError):
        pj.read([b"nothing"])
    with pytest.raises(ValueError):
        pj.read([good.replace(b"\xff\xd1", b"", 1)])


DOCS = "doc_id long, text string, media string, feature string"


def test_media_column(spark):
    rows = [(1, "abc"), (2, None), (3, ""), (4, "é" * 500), (5, "abc"), (5, "abc")]
    df = spark.createDataFrame([(i, t, "m", "f") for i, t in rows], DOCS)
    got = media.digests(media.read_media(media.media_column(df))).collect()
    assert len(got) == 6
    for r, (i, t) in zip(sorted(got, key=lambda r: r.doc_id), rows, strict=True):
        raw = (t or "").encode()
        padded = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
        assert (r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256) == (i, len(raw), len(padded), hashlib.sha256(padded).hexdigest())
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].media_sha256 == by_id[5].media_sha256 and by_id[1].feature == by_id[5].feature and by_id[2].media_sha256 == by_id[3].media_sha256
    tensor = media.digests(media.read_media(media.media_column(df), tensors=True)).where("doc_id = 4").first()
    assert tensor.payload_sha256 == by_id[4].payload_sha256 and len(tensor.rgb) == tensor.height * tensor.width * 3
    assert media.read_media(media.media_column(df.limit(0))).count() == 0


PAGES = "page_id long, url string, html string, digest string, archive string"


def test_warc_round_trip(spark):
    rows = [(5, "http://a/", "same"), (3, "http://b/", "same"), (9, None, "same"), (4, "http://c/\r\nX: y", None), (2, "u", ""), (7, "é", "é" * 30_000), (8, "x", "\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame([(i, u, h, "d", "a") for i, u, h in rows], PAGES)
    got = {r.page_id: r for r in warc.round_trip(df).collect()}
    for i, _, h in rows:
        raw = (h or "").encode()
        first = min(j for j, _, x in rows if (x or "") == (h or ""))
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", first))
    least = {r.page_id: r.record_type for r in warc.round_trip(df, least=1).collect()}
    assert least[4] == least[2] == "response" and least[9] == "revisit"
    assert warc.round_trip(df.limit(0)).count() == 0
    plain = warc.read_archives(warc.write_archives(warc.plan_records(df), compressed=False))
    assert plain.where("kind = 'record' AND digest_ok").count() == 7


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage(compressed):
    rng = random.Random(2)
    records = [warc.record(i, "u", bytes(rng.randrange(32, 127) for _ in range(200 + i)), "A") for i in range(30)]
    members = [warc.member(r) if compressed else r for r in records]
    whole = b"".join(members)
    assert [k for k, *_ in warc.salvage(whole)] == ["record"] * 30
    starts = np.cumsum([0, *map(len, members)]).tolist()
    for _ in range(60):
        hurt = rng.randrange(1, 29)
        at = rng.randrange(starts[hurt] + 12, starts[hurt + 1] - 6)
        kind = rng.choice(["flip", "cut", "insert"])
        data = whole[:at] + {"flip": bytes([whole[at] ^ 0x55]) + whole[at + 1 :], "cut": whole[at + 5 :], "insert": b"\x00junk" + whole[at:]}[kind]
        found = list(warc.salvage(data))
        assert found[0][1] == 0 and found[-1][2] == len(data) and all(a[2] == b[1] for a, b in zip(found, found[1:], strict=False)), "the parts cover the archive"
        ids = [h["warc-record-id"] for k, _, _, _, h, _ in found if k == "record"]
        assert set(ids) >= {f"<urn:page:{i}>" for i in range(30) if i != hurt}, "only the damaged record is lost"
    assert list(warc.salvage(b"")) == [] and [x[:3] for x in warc.salvage(b"garbage")] == [("gap", 0, 7)]


def test_warc_repeated_identifiers(spark):
    """Rows that share an identifier: no payload is lost, and one of the rows with the smallest one is the response."""
    rows = [(3, "u", "same"), (3, "u", "same"), (9, "u", "same"), (9, "u", "of its own"), (8, "u", "of its own"), (1, "u", "first"), (1, "v", "first"), (None, "u", "same"), (None, "u", "nobody else's")]
    df = spark.createDataFrame([(i, u, h, "d", "a") for i, u, h in rows], PAGES).coalesce(1)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()), key=repr)
    want = [(3, 4, "response", None), (3, 4, "revisit", 3), (9, 4, "revisit", 3), (9, 10, "revisit", 8), (8, 10, "response", None), (1, 5, "response", None), (1, 5, "revisit", 1), (None, 4, "revisit", 3), (None, 13, "response", None)]
    assert got == sorted(want, key=repr)
    payloads = warc.read_archives(warc.write_archives(warc.plan_records(df))).where("payload IS NOT NULL").collect()
    assert sorted(bytes(r.payload).decode() for r in payloads) == sorted({h for _, _, h in rows})


def test_warc_text_identifiers(spark):
    rows = [("a b>", "u", "x"), ("é", "u", "x"), (None, "u", "y")]
    df = spark.createDataFrame([(i, u, h, "d", "a") for i, u, h in rows], PAGES.replace("page_id long", "page_id string"))
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(df).collect()}
    assert got == {"a b>": ("response", None), "é": ("revisit", "a b>"), None: ("response", None)}


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("old, new", [(b"Content-Length: 5\r\n\r\n", b"Content-Length: abc\r\n\r\n"), (b"Content-Length: 5\r\n\r\n", b"Content-Length: " + b"9" * 5000 + b"\r\n\r\n"), (b"Content-Length: 83\r\n", b"Content-Length: " + b"8" * 5000 + b"\r\n")])
def test_malformed_lengths_are_quarantined(spark, compressed, old, new):
    """Lengths that are no numbers, or too long to be one, fail a check; the records around are read."""
    good = [warc.record(i, "u", b"hello", "A") for i in range(3)]
    assert b"Content-Length: 83\r\n" in good[1] and b"Content-Length: 5\r\n\r\n" in good[1]
    bad = good[1].replace(old, new)
    if b"WARC-Block-Digest" in bad:  # a valid digest, so that the length alone is wrong
        block = bad.split(b"\r\n\r\n", 1)[1][:-4]
        bad = bad.replace(warc.sha1_base32(good[1].split(b"\r\n\r\n", 1)[1][:-4]).encode(), warc.sha1_base32(block).encode()).replace(b"Content-Length: 83\r\n", b"Content-Length: %d\r\n" % len(block))
    data = b"".join((warc.member(r) if compressed else r) for r in (good[0], bad, good[2]))
    df = spark.createDataFrame([("a", bytearray(data))], "archive string, data binary")
    got = warc.read_archives(df).orderBy("start").collect()
    assert [r.kind for r in got] == ["record", "gap", "record"] and got[1].reason == "no content length"
    assert [r.page_id for r in got] == ["0", None, "2"] and got[-1].end == len(data)


def test_members_are_bounded(monkeypatch):
    monkeypatch.setattr(warc, "MEMBER", 10_000)
    big, small = (warc.member(warc.record(i, "u", b"x" * n, "A")) for i, n in ((1, 50_000), (2, 50)))
    found = list(warc.salvage(big + small))
    assert [x[0] for x in found] == ["gap", "record"] and found[0][3] == "member unpacks to too many bytes"
