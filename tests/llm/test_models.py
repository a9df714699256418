"""Kneser-Ney models and spectral fingerprints against plain loops."""

import cmath
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from chainlake.llm import media, toxicity


def brute_ratio(words, toxic, ordinary, discount, tested):
    """Log-likelihood ratio of each tested word by dictionaries of n-grams."""
    n = toxicity.ORDER
    grams = lambda w: [(f"{chr(2) * (n - 1)}{w}{chr(3)}")[i : i + n] for i in range(len(w) + 1)]
    counts = [Counter(), Counter()]
    for w, a, b in zip(words, toxic, ordinary):
        for g in grams(w):
            counts[0][g] += a
            counts[1][g] += b
    kinds = set(counts[0])
    lower = {}  # n-gram of each length below the highest -> continuation count
    level = kinds
    for k in range(n - 1, 0, -1):
        lower[k] = Counter(g[1:] for g in level)
        level = set(lower[k])

    def continuation(g):
        k = len(g)
        if k == 1:
            return lower[1][g] / sum(lower[1].values())
        same = [c for x, c in lower[k].items() if x[:-1] == g[:-1]]
        return max(lower[k][g] - toxicity.DISCOUNT, 0) / sum(same) + toxicity.DISCOUNT * len(same) / sum(same) * continuation(g[1:])

    by_context = defaultdict(list)
    for g in kinds:
        by_context[g[:-1]].append(g)

    def discounted(count, d, context):
        own = [count[g] for g in by_context[context]]
        total = sum(own)
        return total, (sum(min(c, d) for c in own) / total if total else 1.0)

    def p(c, g):
        context = g[:-1]
        both = counts[0] + counts[1]
        total, rest = discounted(both, toxicity.DISCOUNT, context)
        shared = max(both[g] - toxicity.DISCOUNT, 0) / total + rest * continuation(g[1:])
        total, rest = discounted(counts[c], discount, context)
        return max(counts[c][g] - discount, 0) / max(total, 1) + rest * shared

    out = []
    for w in tested:
        ratio = 0.0
        for g in grams(w):
            if g in kinds:
                ratio += math.log(p(0, g)) - math.log(p(1, g))
            elif g[:-1] in by_context:  # the shared probability of an unseen character cancels
                ratio += math.log(discounted(counts[0], discount, g[:-1])[1]) - math.log(discounted(counts[1], discount, g[:-1])[1])
        out.append(ratio)
    return out


@pytest.mark.parametrize("discount", [0.75, 2.0, 5.0])
def test_kneser_ney_equals_plain_dictionaries(discount):
    rng = random.Random(int(discount * 4))
    words = sorted({"".join(rng.choices("abcé", k=rng.randint(1, 9))) for _ in range(60)})
    toxic, ordinary = (np.array([float(rng.choice([0, 0, 1, 2, 9])) for _ in words]) for _ in range(2))
    ordinary[toxic + ordinary == 0] = 1.0
    model = toxicity.fit_model(words, toxic, ordinary, discount)
    tested = [*words, *("".join(rng.choices("abcéx", k=rng.randint(1, 12))) for _ in range(60))]
    want = brute_ratio(words, toxic, ordinary, discount, tested)
    assert model.words(tested) == pytest.approx(want, abs=1e-4)


def test_fingerprint_equals_plain_loops():
    rng = random.Random(9)
    text = " ".join("".join(rng.choices("abcdefghijklmnop ", k=rng.randint(3, 40))) for _ in range(120)).encode()
    samples = media.payload(text)
    signal = [b - 128 for b in samples]
    window = [0.5 - 0.5 * math.cos(2 * math.pi * i / (media.WINDOW - 1)) for i in range(media.WINDOW)]
    frames = [signal[a : a + media.WINDOW] for a in range(0, len(signal) - media.WINDOW + 1, media.HOP)]
    turn = [cmath.exp(-2j * math.pi * k / media.WINDOW) for k in range(media.WINDOW)]
    power = [[abs(sum(x * w * turn[i * k % media.WINDOW] for i, (x, w) in enumerate(zip(f, window)))) for k in range(media.WINDOW // 2 + 1)] for f in frames]
    best = [[max(range(a, b), key=lambda k: (p[k], -k)) for a, b in media.BANDS] for p in power]  # noqa: B023
    tops = [[p[k] for k in own] for p, own in zip(power, best)]
    peaks = []
    for t in range(len(frames)):
        for band in range(len(media.BANDS)):
            own = tops[t][band]
            around = [tops[u][band] for u in range(max(0, t - 2), min(len(frames), t + 3)) if u != t]
            if own > sum(power[t][1:]) / (len(power[t]) - 1) and all(own > x for x in around):
                peaks.append((t, best[t][band]))
    want = sorted((t, a << 16 | b << 8 | u - t) for i, (t, a) in enumerate(peaks) for u, b in peaks[i + 1 : i + 4] if u - t <= 32)
    time, code = media.fingerprint(samples)
    assert len(want) > 50 and list(zip(time.tolist(), code.tolist())) == want
    assert media.fingerprint(samples)[1].tolist() == media.fingerprint(media.from_wav(media.to_wav(samples)))[1].tolist()
