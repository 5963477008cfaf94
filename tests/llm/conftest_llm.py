"""Invented prose for tests."""

from __future__ import annotations

import random

WORDS = "the of and lorem ipsum dolor sit amet erat magna quam felis nunc orci urna vel Straße café naïve 東京 été über".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(40)) if rng.random() < 0.6 else "") for _ in range(n))
