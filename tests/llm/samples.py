"""Values that several test modules use."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
LONG = "Ein langer Satz, der sich wiederholt. " * 3000


def random_texts(seed: int, n: int, alphabet: str, most: int = 60) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice(alphabet) for _ in range(draw.randrange(most))) for _ in range(n)]
