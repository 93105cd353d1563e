import random


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    stems = ["".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    return " ".join(rng.choice(stems) + rng.choice(["", "", "", ",", "."]) for _ in range(words))
