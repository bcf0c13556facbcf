"""Made-up prose for tests."""

import random

WORDS = "the quick brown fox jumps over one lazy dog while seven bold cats watch from a warm red wall near town".split()


def prose(n: int, seed: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(60)) for _ in range(n))
