"""Counts of documents and of their lines, whole slices of a batch at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidestar.llm.textops import U64, Slice, grams, hashes, mix, mixed, words


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


SYMBOL = _table("#*$%&|<>")
DIGIT = _table("0123456789")
CAPITAL = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTER = CAPITAL | _table("abcdefghijklmnopqrstuvwxyz")
LETTER[128:] = True  # bytes of letters outside ASCII, in the main
STOP = _table(".,;:?")
LOUD = _table("!")
START = np.ones(256, bool)
START[0x80:0xC0] = False  # bytes that begin no character


def _summed(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _within(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return sums[ends] - sums[starts]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key: whether it is there twice or more, and whether an equal one comes before it."""
    _, first, inverse, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    later = np.ones(len(keys), bool)
    later[first] = False
    return count[inverse] > 1, later


@dataclass
class Measures:
    """``rows``: counts for each row; ``lines``: for each line; ``line_at[i]:line_at[i + 1]`` are the lines of row i."""

    rows: dict[str, np.ndarray]
    lines: dict[str, np.ndarray]
    line_at: np.ndarray


def measure(part: Slice) -> Measures:
    """Words are runs of anything but white space; lines are pieces between line feeds, an empty text has one."""
    data, offsets = part.data, part.offsets
    n = len(part)
    starts, ends = words(part)
    at = part.per_row(starts)
    row_of = np.repeat(np.arange(n), np.diff(at))
    hashed = hashes(data, starts, ends)
    salt = mix(np.arange(1, n + 1, dtype=U64))

    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.r_[offsets[:-1], breaks + 1])
    line_ends = np.sort(np.r_[offsets[1:], breaks])
    line_row = np.repeat(np.arange(n), 1 + np.diff(part.per_row(breaks)))
    line_at = np.searchsorted(line_row, np.arange(n + 1))
    word_at = np.searchsorted(starts, np.r_[line_starts, len(data)])
    line_words = np.diff(word_at)

    three = grams(hashed, 3)
    whole = row_of[: len(three)] == row_of[2:] if len(three) else np.zeros(0, bool)
    place = np.flatnonzero(whole)
    again, _ = _repeated(three[place] + salt[row_of[place]] * U64(mixed(3) | 1)) if len(place) else (np.zeros(0, bool), None)
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[place[again] + k] = True

    worded = np.flatnonzero(line_words > 0)
    line_key = hashes(data, line_starts[worded], line_ends[worded]) + salt[line_row[worded]] * U64(mixed(5) | 1)
    twice, later = _repeated(line_key) if len(worded) else (np.zeros(0, bool), np.zeros(0, bool))
    line_twice = np.zeros(len(line_starts), bool)
    line_twice[worded] = twice

    sums = {k: _summed(t[data]) for k, t in (("chars", START), ("symbols", SYMBOL), ("digits", DIGIT), ("capitals", CAPITAL), ("letters", LETTER), ("stops", STOP), ("loud", LOUD))}
    word_chars = _within(sums["chars"], starts, ends)
    per_word = {
        "word_chars": word_chars, "repeat_words": covered, "long_words": word_chars >= 12, "bare_words": _within(sums["letters"], starts, ends) == 0,
        "symbol_words": _within(sums["symbols"], starts, ends) > 0,
    }
    rows = {f"n_{k}": _within(v, offsets[:-1], offsets[1:]) for k, v in sums.items()}
    lines = {f"n_{k}": _within(v, line_starts, line_ends) for k, v in sums.items()}
    rows["n_words"], lines["n_words"] = np.diff(at), line_words
    for k, v in per_word.items():
        total = _summed(v)
        rows[k], lines[k] = _within(total, at[:-1], at[1:]), _within(total, word_at[:-1], word_at[1:])
    rows["n_dup_lines"] = np.bincount(line_row[worded[later]], minlength=n)
    rows["n_lines"] = np.diff(line_at)
    key = hashed + salt[row_of] * U64(mixed(1) | 1)
    _, first = np.unique(key, return_index=True)
    rows["distinct_words"] = np.bincount(row_of[first], minlength=n)
    lines["twice"] = line_twice
    final = np.zeros(len(line_starts), np.uint8)
    full = line_ends > line_starts
    final[full] = data[line_ends[full] - 1]
    lines["stopped"] = STOP[final] | LOUD[final]
    return Measures(rows, lines, line_at)


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(whole)), where=whole > 0)
