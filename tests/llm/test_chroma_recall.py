import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm.chroma import LEAST_FRAMES, LEAST_PASSAGE, RATE, TOLERANT_SEEDS, align, alike, fingerprint, fingerprints


def song(seed, note, noise=0.0, skip=0, seconds=6.0):
    notes = 220 * 2 ** (np.random.default_rng(seed).integers(0, 36, int(seconds / note) + 1) / 12)
    time = np.arange(int(seconds * RATE)) / RATE
    wave = np.sin(2 * np.pi * np.repeat(notes, int(note * RATE))[: len(time)] * time)[skip:]
    return (8000 * (wave + noise * np.random.default_rng(seed + 999).standard_normal(len(wave)))).astype("<i2").tobytes()


def brute_force(a, b):
    """The least bit error over all offsets and passages of them that count."""
    least, out = min(len(a), len(b), LEAST_FRAMES), 1.0
    for k in range(least - len(a), len(b) - least + 1):
        x, y = a[max(0, -k) :], b[max(0, k) :]
        n = min(len(x), len(y))
        total = np.concatenate([[0], np.cumsum(np.bitwise_count(x[:n] ^ y[:n]).astype(int))])
        out = min(out, total[-1] / (32 * n))
        if n > LEAST_PASSAGE:
            out = min(out, *((total[m:] - total[:-m]).min() / (32 * m) for m in range(LEAST_PASSAGE, n + 1)))
    return out


#: Note length, noise and samples left out at the start: half a hop is 64.
@pytest.mark.parametrize("note, noise, skip, least", [(0.1, 0.05, 64, 12), (0.3, 0.05, 64, 12), (0.3, 0.2, 0, 12), (0.1, 0.4, 0, 12), (0.3, 0.4, 64, 12)])
def test_noisy_and_shifted_copies_are_found(spark, note, noise, skip, least):
    rows = [(20 * k, song(k, note)) for k in range(12)] + [(20 * k + 1, song(k, note, noise, skip)) for k in range(12)]
    prints = {k: fingerprint(pcm) for k, pcm in rows}
    assert all(brute_force(prints[20 * k], prints[20 * k + 1]) <= 0.25 for k in range(12))
    recordings = fingerprints(spark.createDataFrame(rows, "id long, pcm binary"))
    found = {(r["id"], r["match_id"]) for r in align(recordings, F.col("id") % 20 == 0, kinds=TOLERANT_SEEDS).collect() if r["match_id"] is not None}
    assert len([k for k in range(12) if (20 * k, 20 * k + 1) in found]) >= least
    assert all(brute_force(prints[a], prints[b]) <= 0.25 for a, b in found)


def test_shared_passages_are_found(spark):
    rows = []
    for k in range(8):
        rows.append((20 * k, song(100 + k, 0.1, seconds=9) + song(300 + k, 0.1) + song(400 + k, 0.1, seconds=9)))
        rows.append((20 * k + 1, song(200 + k, 0.1, seconds=12) + song(300 + k, 0.1) + song(500 + k, 0.1)))
    found = {(r["id"], r["match_id"]): r for r in align(fingerprints(spark.createDataFrame(rows, "id long, pcm binary")), F.col("id") % 20 == 0, kinds=TOLERANT_SEEDS).collect() if r["match_id"] is not None}
    assert set(found) == {(20 * k, 20 * k + 1) for k in range(8)}
    assert all(abs(r["offset"] - 3 * RATE / 128) <= 1 and r["frames"] >= 170 and r["bit_error"] <= 0.25 for r in found.values())


def test_a_later_offset_is_tried_and_passages_are_the_longest():
    rnd = np.random.default_rng(3)
    for _ in range(30):
        a, b = rnd.integers(0, 1 << 32, 200), rnd.integers(0, 1 << 32, 200)
        at = int(rnd.integers(0, 40))
        b[at : at + 100] = a[at : at + 100]
        wrong = np.bitwise_count(a ^ b).astype(int)
        longest = max(j - i for i in range(200) for j in range(i, 201) if wrong[i:j].sum() <= 8 * (j - i))
        assert alike(a, b, 0)[0] == longest >= LEAST_PASSAGE


def test_the_offset_of_most_votes_can_fail(spark):
    rnd = np.random.default_rng(4)
    a, b = rnd.integers(0, 1 << 32, 300), rnd.integers(0, 1 << 32, 300)
    b[100:124] = a[10:34]  # more equal seeds, but too short a passage
    b[140:290] = a[110:260] ^ np.where(np.arange(150) % 12 < 6, 0, 1)
    b[140:290:7] ^= 0xFF
    found = align(spark.createDataFrame([(0, a.tolist()), (1, b.tolist())], "id long, prints array<long>"), F.col("id") == 0).where("match_id is not null").collect()
    assert [r["offset"] for r in found] == [30]
