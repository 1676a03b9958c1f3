"""Reverberation and noises: probabilities, choices and cycles against plain Python."""

import hashlib
from collections import Counter

from corpusflow.operators import augment as A


def u(*key):
    return int(hashlib.md5("/".join(map(str, key)).encode()).hexdigest()[:8], 16) / 2**32


def chosen(x, items):
    upto = 0.0
    for name, p in items:
        upto += p
        if x < upto:
            return name
    return items[-1][0]


def test_smoothed_as_published(spark):
    def plain(ps, weight):
        none, given = sum(p is None for p in ps), sum(p or 0 for p in ps)
        even = (1 - given) / none if none and given < 1 else 0
        out = [even if p is None else (1 - weight) * p + weight * even for p in ps]
        return [p / sum(out) for p in out]

    for ps in ([0.2, None, 0.3, None], [0.5, 0.5], [0.7, 0.6, None], [None, None, None], [0.1]):
        for weight in (0.0, 0.3, 1.0 if None in ps and sum(p or 0 for p in ps) < 1 else 0.5):
            d = spark.createDataFrame(list(enumerate(ps)), "i int, probability double")
            got = {r.i: r.probability for r in A.smoothed(d, weight).collect()}
            assert all(abs(got[i] - p) < 1e-12 for i, p in enumerate(plain(ps, weight)))


def test_copies_noises_and_cycles(spark):
    rirs = [(f"r{i:02}", f"room{i % 3}", p) for i, p in enumerate([0.05, 0.1, 0.2, 0.05, 0.3, 0.1, 0.15, 0.05])]
    noises = [("n1", "foreground", 0.25), ("n2", "background", 0.5), ("n3", "foreground", 0.25)]
    utts = [(f"u{i}", 10.0 * i) for i in range(40)]
    rooms = spark.createDataFrame(rirs, "rir string, room string, probability double")
    wet = A.reverberated(A.copies(spark.createDataFrame(utts, "utt string, dur double"), 2, original=True), rooms, 0.7)
    rows = {r.name: r for r in wet.collect()}
    assert set(rows) == {f"rvb{k}-{x}" for k in range(3) for x, _ in utts}
    for name, r in rows.items():
        assert r.rir == chosen(u("rir", name), [(x, p) for x, _, p in rirs]) and r.wet == (u("wet", name) < 0.7)
        assert r.room == dict((x, room) for x, room, _ in rirs)[r.rir]
    got = sorted(A.noises_added(wet, spark.createDataFrame(noises, "noise string, kind string, probability double"), rooms, [20.0, 10.0, 5.0], [15.0, 0.0], 0.8, 2.0).collect(), key=lambda r: (r.name, r.k))
    want = []
    for name, r in sorted(rows.items()):
        most = int(2.0 * r.dur / 60)
        if most < 1 or u("noisy", name) >= 0.8:
            continue
        for k in range(1, int(u("count", name) * most) + 2):
            noise = chosen(u("noise", name, k), [(x, p) for x, _, p in noises])
            own = [(x, p) for x, room, p in rirs if room == r.room]
            rir = chosen(u("noise rir", name, k) * sum(p for _, p in own), own)
            kind = dict((x, kd) for x, kd, _ in noises)[noise]
            want.append((name, k, noise, kind, rir, round(u("start", name, k) * r.dur, 2) if kind == "foreground" else 0.0))
    assert [(r.name, r.k, r.noise, r.kind, r.rir) for r in got] == [w[:5] for w in want]
    assert all(abs(r.start - w[5]) < 0.0101 for r, w in zip(got, want, strict=True))
    for kind, values in (("foreground", 3), ("background", 2)):
        of = [r.snr for r in got if r.kind == kind]
        assert len(set(of)) == values and max(Counter(of).values()) - min(Counter(of).values()) <= 1
        assert all(of[i] == of[i % values] for i in range(len(of)))
