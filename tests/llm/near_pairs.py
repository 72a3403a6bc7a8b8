"""Pairs of texts that differ by one kind of edit, and their five-word similarity."""

import random

KINDS = {"append": 0.22, "truncate": 0.18, "block": 0.10, "scattered": 0.024}


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def edited(words, kind, share, rng):
    n, m = len(words), max(1, int(len(words) * share))
    new = [f"q{rng.getrandbits(40):x}" for _ in range(m)]
    if kind == "append":
        return words + new
    if kind == "truncate":
        return words[: n - m]
    if kind == "block":
        at = rng.randrange(n - m + 1)
        return words[:at] + new + words[at + m :]
    words = list(words)
    for x, at in zip(new, rng.sample(range(n), m), strict=True):
        words[at] = x
    return words


def pairs(texts, kind, low, high, n, seed=1):
    """``n`` pairs of an own text and its edit with a similarity from ``low`` up to ``high``."""
    rng, out = random.Random(seed), []
    for _ in range(200 * n):
        words = rng.choice(texts).split()
        other = edited(words, kind, KINDS[kind] * rng.uniform(0.4, 1.6), rng)
        a, b = " ".join(words), " ".join(other)
        if low <= similarity(a, b) < high:
            out.append((a, b))
            if len(out) == n:
                return out
    raise ValueError("too few pairs")
