"""Plain-Python counterparts used by the brute-force tests."""
import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER) if lower else text)


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def prose(rng: random.Random, n: int, vocabulary: int = 3000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng: random.Random, w: list[str], edits: int) -> list[str]:
    w = list(w)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return w
