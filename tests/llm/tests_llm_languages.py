"""Three invented languages of different syllables."""

import random


def make():
    rng = random.Random(9)
    syllables = {"aa": ["ka", "to", "mi", "re", "so"], "bb": ["schu", "ung", "lich", "ver", "ei"], "cc": ["ção", "lho", "nha", "os", "ra"]}
    rows = []
    for i in range(240):
        lang = "abc"[i % 3] * 2
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 80))]
        rows.append((i, " ".join(words), lang, 0))
    return rows
