"""Small documents with every awkward case, and plain-Python forms of what the operators compute."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, `Size` int, terms int"
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def documents(spark, extra=()):
    """Rows with clashing column names; nulls in every column, empty and very long texts, repeated rows."""
    rng = random.Random(3)
    texts = [sentence(rng, rng.randint(1, 120)) for _ in range(40)]
    rows = [(i, t, "en", f"s{i % 3}", len(t), "x", 1, 2) for i, t in enumerate(texts)]
    long = sentence(rng, 30_000)
    rows += [
        (100, None, None, None, None, None, None, None), (101, "", "de", "s1", 0, "y", 3, 4), (102, " \n\t ", "de", None, 4, None, None, None),
        (103, long, "en", "s0", len(long), "x", 1, 2), (104, "é ü ß 漢字 𝒳", None, "s2", None, "x", 1, 2), (105, "one", "en", "s2", 3, "x", 1, 2),
        (None, "a text without an id " * 5, "en", "s1", None, None, 1, 1), (None, None, None, None, None, None, None, None),
        *[(106, "the same row twice and again", "en", "s1", 1, "x", 1, 2)] * 2,
    ]
    return spark.createDataFrame([*rows, *extra], SCHEMA)


def words(text: str | None) -> list[str]:
    return SPACE_WORD.findall(text or "")


def shingles(text: str | None, n: int = 5) -> set[tuple[str, ...]]:
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(texts: dict[int, str | None]) -> dict[int, int]:
    """Smallest id reachable over links of all pairs."""
    sets, comp = {k: shingles(v) for k, v in texts.items()}, {k: k for k in texts}
    ids = sorted(texts)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            if comp[a] != low or comp[b] != low:
                comp[a] = comp[b] = low
                changed = True
    return comp
