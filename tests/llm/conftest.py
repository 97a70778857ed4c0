import pytest


@pytest.fixture(scope="session")
def texts():
    """Words of a small invented language, from a fixed rule."""
    import random

    rng = random.Random(5)
    syllables = ["ka", "to", "mi", "re", "sul", "an", "ö", "dé", "pra", "lin"]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(400)]

    def make(n, seed):
        own = random.Random(seed)
        return [own.choice(vocabulary) for _ in range(n)]

    return make
