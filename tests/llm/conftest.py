import random

import pytest

WORDS = [f"w{i}" for i in range(300)]


@pytest.fixture
def near_copies():
    """Texts of which many are edited copies of others, with repeated ids' worth of corner cases at the end."""
    dice = random.Random(3)
    bases = [[dice.choice(WORDS) for _ in range(dice.randint(3, 60))] for _ in range(12)]
    rows = []
    for i in range(160):
        words = list(dice.choice(bases[:3] if i % 2 else bases))
        for _ in range(dice.randint(0, 3)):
            at = dice.randrange(len(words))
            words[at:at + 1] = dice.choice([[dice.choice(WORDS)], [], [words[at], dice.choice(WORDS)]]) or ["x"]
        rows.append((i, dice.choice([" ", "\n", "  "]).join(words)))
    return [*rows, (1000, ""), (1001, None), (1002, "A b"), (1003, "a B "), (1004, ""), (1005, "one " * 3000)]
