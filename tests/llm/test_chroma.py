import numpy as np
from pyspark.sql import functions as F

from spanloom.llm.chroma import EQUAL_SEEDS, FRAME, HOP, RATE, SILENT, TOLERANT_SEEDS, align, filters, fingerprint, fingerprints, pitch_classes, seeds_of
from spanloom.llm.chroma import tune as play

SCHEMA = "id long, pcm binary, prints string, asks int"


def tune(seed, seconds=6.0, noise=0.0, skip=0.0):
    rnd = np.random.default_rng(seed)
    notes = 220 * 2 ** (rnd.integers(0, 36, int(seconds / 0.1)) / 12)
    time = np.arange(int(seconds * RATE)) / RATE
    wave = np.sin(2 * np.pi * np.repeat(notes, int(0.1 * RATE))[: len(time)] * time)
    wave = wave[int(skip * RATE) :]
    return (8000 * (wave + noise * np.random.default_rng(99).standard_normal(len(wave)))).astype("<i2").tobytes()


def test_recordings_align_and_strangers_do_not(spark):
    rows = [(0, tune(1), None, None), (1, tune(1, noise=0.02), None, None), (2, tune(1, skip=0.96), None, None), (3, tune(1), None, None), (20, tune(2), None, None), (21, tune(2, noise=0.05), None, None)]
    rows += [(30 + k, tune(50 + k), None, None) for k in range(12)]
    found = [tuple(r) for r in align(fingerprints(spark.createDataFrame(rows, SCHEMA)), F.col("id") % 20 == 0).collect()]
    assert {r[0] for r in found} == {r[0] for r in rows}
    matches = {(r[0], r[2]): r for r in found if r[2] is not None}
    assert set(matches) == {(0, 1), (0, 2), (20, 21)}
    assert matches[0, 2][3] == -round(0.96 * RATE / 128)
    assert next(r for r in found if r[0] == 3)[1] == 0
    assert all(r[5] <= 0.25 for r in matches.values())


def test_matches_are_those_of_brute_force(spark):
    rng = np.random.default_rng(5)
    prints = {k: rng.integers(0, 6, 40).tolist() for k in range(40)}
    for k in range(20, 40, 5):
        prints[k] = prints[0][7:] + rng.integers(0, 6, 7).tolist()
    prints[41], prints[42] = [], prints[0]
    found = align(spark.createDataFrame(list(prints.items()), "id long, prints array<long>"), F.col("id") % 20 == 0, most_error=1.0).collect()
    expected = set()
    for q in (0, 20):
        for r in prints:
            if r in (q, 41, 42) or prints[r] == prints[q] and r != q:
                continue
            votes = {}
            for i in range(35):
                for j in range(35):
                    if any(k and (x[k], x[k + 5]) == (x[k - 1], x[k + 4]) for x, k in ((prints[q], i), (prints[r], j))):
                        continue  # of a run of one seed the first counts
                    if prints[q][i] == prints[r][j] and prints[q][i + 5] == prints[r][j + 5]:
                        votes[j - i] = votes.get(j - i, 0) + 1
            whole = lambda k: sum(prints[q][i] == prints[r][i + k] and prints[q][i + 5] == prints[r][i + k + 5] for i in range(35) if 0 <= i + k < 35) >= 3 or k == 0
            best = min(((-n, abs(k), k) for k, n in votes.items() if n + max(votes.get(k - 1, 0), votes.get(k + 1, 0)) >= 3 and whole(k)), default=None)
            if best and prints[r] not in [prints[x] for x in prints if x < r]:
                expected.add((q, r, best[2]))
    assert {(r["id"], r["match_id"], r["offset"]) for r in found if r["match_id"] is not None} == expected


def test_silence_and_held_notes_make_few_seeds():
    time = np.arange(8 * RATE) / RATE
    held = fingerprint((8000 * np.sin(2 * np.pi * 440 * time)).astype("<i2").tobytes())
    assert set(fingerprint(bytes(60000)).tolist()) == {SILENT}
    assert len(seeds_of(fingerprint(bytes(60000)), TOLERANT_SEEDS)[0]) == 0
    assert len(held) > 200 and len(seeds_of(held, TOLERANT_SEEDS)[0]) <= 4 * len(TOLERANT_SEEDS)
    song = fingerprint(tune(1))
    keys, places = seeds_of(song, EQUAL_SEEDS)
    assert len(keys) > 100 and places.max() < len(song) - 5 and len(seeds_of(song[:3], TOLERANT_SEEDS)[0]) == 0


def test_areas_are_plain_sums():
    """A filter's bits from sums over the frames themselves, without the integral image."""
    pcm = tune(3, noise=0.1)
    samples = np.frombuffer(pcm, dtype="<i2").astype(float)
    n = (len(samples) - FRAME) // HOP + 1
    chroma = np.array([np.abs(np.fft.rfft(samples[HOP * i : HOP * i + FRAME] * np.hanning(FRAME))) ** 2 @ pitch_classes() for i in range(n)])
    chroma /= np.maximum(np.linalg.norm(chroma, axis=1, keepdims=True), 1e-9)
    found = fingerprint(pcm)
    for at in (0, 7, len(found) - 1):
        for k, (kind, y, height, width) in enumerate(filters()):
            part, h, w = chroma[at : at + width, y : y + height], height // 2, width // 2
            a = {0: part[:, :h].sum(), 1: part[:w].sum(), 2: part[:w, :h].sum() + part[w:, h:].sum(), 3: part[width // 3 : width // 3 + max(1, width // 3)].sum()}[kind]
            step = sum(np.round(np.log((0.1 + a) / (0.1 + part.sum() - a)), 4) > e for e in (-0.25, 0.0, 0.25))
            assert int(found[at]) >> 2 * k & 3 == (0, 1, 3, 2)[step]


def test_odd_tables(spark):
    rows = [(None, tune(1), None, None), (1, None, None, None), (2, b"", None, None), (3, b"\1", None, None), (4, bytes(60000), None, None), (5, tune(1), None, None), (5, tune(1), None, None)]
    found = sorted((r["id"] is None, r["id"] or 0, r["class_id"] or -1) for r in align(fingerprints(spark.createDataFrame(rows, SCHEMA)), F.col("id") > 0).collect())
    assert (False, 1, -1) in found and (False, 5, 5) in found and len(found) == 6
    assert align(fingerprints(spark.createDataFrame([], SCHEMA)), F.col("id") > 0).count() == 0
    assert len(fingerprint(bytes(60000))) > 0 and len(fingerprint(None)) == 0
    assert [len(x) if x is not None else None for x in map(play, (None, [0.1, None, 0.5] * 20, []))] == [None, 60 * 512, 0]
    vectors = spark.createDataFrame([(1, None), (2, [0.1, None, 0.5] * 20), (3, [])], "vec_id long, embedding array<float>")
    found = {r["id"]: len(r["prints"]) for r in fingerprints(vectors, "vec_id", "embedding", decode=play).collect()}
    assert found[1] == found[3] == 0 and found[2] > 50
