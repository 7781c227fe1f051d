import hashlib
import math
import random

import numpy as np

from ledgerflow.llm import fingerprint as S

from .conftest import ODD


def plain(data, bits=256):
    """Fingerprint bit by bit."""
    data, tf = data.lower(), {}
    for at in range(max(len(data) - 4, min(len(data), 1))):
        t = data[at:at + 5]
        x = len(t)
        for b in t:
            x = (x << 8 | b) & S.WORD
        tf[x] = tf.get(x, 0) + 1
    votes = [0] * bits
    for x, f in tf.items():
        w = math.floor(16 * (1 + math.log(f)))
        for k in range(bits // 64):
            h = (x + S.SEED * (k + 1)) & S.WORD
            h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & S.WORD
            h = ((h ^ h >> 27) * 0x94D049BB133111EB) & S.WORD
            h ^= h >> 31
            for j, byte in enumerate(h.to_bytes(8, "little")):
                for b in range(8):
                    votes[64 * k + 8 * j + b] += w if byte >> 7 - b & 1 else -w
    out = 0
    for v in votes:
        out = out << 1 | (v > 0)
    return out.to_bytes(bits // 8, "big")


def test_votes_equal_plain_counting(monkeypatch):
    monkeypatch.setattr(S, "STEP", 10)
    rng = random.Random(0)
    for n in (0, 1, 2, 4, 5, 6, 80):
        data = "".join(rng.choice("abAB é中\n") for _ in range(n)).encode()
        assert S.fingerprint(data) == plain(data) and S.fingerprint(data, 128) == plain(data, 128)
    assert S.fingerprint(b"") == bytes(32) and S.likeness(b"\x00\xff", b"\x0f\xff") == 0.75


def brute(rows, radius, every=100):
    prints = [plain((t or "").encode()) for _, t, _, _ in rows]
    order = sorted(range(len(rows)), key=lambda i: -math.inf if rows[i][0] is None else rows[i][0], reverse=True)
    out = []
    for at, i in enumerate(order):
        t, nx = rows[i][1] or "", order[(at + 1) % len(order)]
        k = len(t) // 3
        edited = (t[:len(t) - k] + (rows[nx][1] or "")[:k]).encode()
        ep = plain(edited)
        near = sum((int.from_bytes(prints[i], "big") ^ int.from_bytes(p, "big")).bit_count() <= radius for p in prints) - 1
        asks = rows[i][0] is not None and rows[i][0] % every == 0
        out.append((rows[i][0], len(t), hashlib.sha256(edited).hexdigest(), prints[i].hex(), ep.hex(), S.likeness(prints[i], ep),
                    S.likeness(prints[i], prints[nx]), near if asks else None))
    return out


def test_rows_equal_brute_force(spark, docs_of):
    rng = random.Random(1)
    words = [f"w{i}é" for i in range(300)]
    rows = [(5, "", "en", "a"), (100, None, "en", None), (300, "ab", "en", "a"), (None, "x" * 50, "en", "a"), (301, "Ünï 中文 " * 9, "en", "a")]
    for i in range(40):
        t = [rng.choice(words) for _ in range(rng.randint(1, 200))]
        rows.append((400 + 50 * i, " ".join(t), "en", "a"))
        rows += [(401 + 50 * i + j, " ".join([*t[:-1], rng.choice(words)]), "en", "a") for j in range(i % 4)]
    got = S.document_fingerprints(docs_of(rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows, 7)))
    one = S.document_fingerprints(docs_of(rows[2:3])).collect()
    assert [tuple(r) for r in one] == brute(rows[2:3], 7) and one[0].near_next == 1.0
    assert S.document_fingerprints(docs_of(rows[:0])).count() == 0


def test_odd_rows(spark, docs_of):
    got = S.document_fingerprints(docs_of(ODD)).collect()
    assert len(got) == len(ODD) and sorted(r.n_chars for r in got) == sorted(len(r[1] or "") for r in ODD)
    by_text = {}
    for r in got:
        by_text.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert len(by_text[1, len(ODD[0][1])]) == 1                       # repeated rows agree


def test_tables_find_all_within_the_radius(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, (3, 16), dtype=np.uint8)
    fps = []
    for _ in range(400):
        f = np.unpackbits(base[rng.integers(0, 3)])
        f[rng.integers(0, 128, rng.integers(0, 9))] ^= 1
        fps.append(np.packbits(f).tobytes())
    fps += fps[:30]
    df = spark.createDataFrame([(bytearray(f), i % 5 == 0) for i, f in enumerate(fps)], "fp binary, asks boolean")
    asked = {f for i, f in enumerate(fps) if i % 5 == 0}
    num = {f: int.from_bytes(f, "big") for f in fps}
    for radius, tile in ((0, 8192), (5, 16), (9, 8192)):
        got = {bytes(r.fp): r.n for r in S.near_counts(df, radius, 128, tile).collect()}
        assert got == {f: sum((num[f] ^ num[g]).bit_count() <= radius for g in fps) for f in asked}
