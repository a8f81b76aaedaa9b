"""Runs of repeated word sequences, found by minimizers at several scales.

A run is a stretch of words that repeats itself with some period, as often as
``MIN_EXPONENT`` times or more, and that can't be made longer. Periods up to
``DIRECT`` words are found by comparing the words with themselves at each lag.
A scale looks for the periods in (P, 2 P]: each P words are a block with a hash;
of each P neighbouring blocks the one with the least hash is selected. Such a
window covers 2 P - 1 words, so in a run it is found again one period later, and
selects the same block there: two selected blocks with equal hashes at the
distance of the period. Each such pair is a seed, which is extended word by word
in both directions. Scales double until no text is long enough.

Blocks that are periodic themselves, with a third of their length or less, lie in
runs of an earlier scale and are never selected. They can't fill all windows of
a run of a longer smallest period, and other blocks have equal ones at distances
over P / 3 only, so there are a few seeds for each selected block, whatever the
text. Work grows with the words times the number of scales.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.llm import textops
from tidestar.llm.shared import col, ship, table

MIN_WORDS = 24
MIN_EXPONENT = 3
DIRECT = 32  # a power of two, not under MIN_WORDS

U64 = np.uint64
LOW_32 = U64((1 << 32) - 1)
NEVER = U64((1 << 64) - 1)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, NEVER)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def _equal_ahead(a: np.ndarray, b: np.ndarray) -> int:
    """How many first values are equal, looked at in pieces that double."""
    done, piece, n = 0, 64, min(len(a), len(b))
    while done < n:
        other = np.flatnonzero(a[done : min(done + piece, n)] != b[done : min(done + piece, n)])
        if len(other):
            return done + int(other[0])
        done, piece = done + piece, piece * 2
    return n


def _seeds(x: np.ndarray, block: np.ndarray, p: int, found: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place, distance) of equal selected blocks of ``p`` words, distances in (p, 2 p]."""
    count = len(x) - p + 1
    own = np.zeros(count + 1, np.int64)
    for (start, end), period in found.items():
        if 3 * period <= p <= end - start:
            own[start] += 1
            own[end - p + 1] -= 1
    order = (block[:count] & ~LOW_32) | np.arange(count, dtype=U64)
    order[np.cumsum(own[:-1]) > 0] = NEVER
    least = _sliding_least(order, p)
    least = least[least != NEVER]
    at = np.unique((least & LOW_32).astype(np.int64))
    at = at[np.lexsort((at, block[at]))]
    places, distances = [], []
    step, open_ = 1, np.arange(len(at))
    while True:  # the next one of an equal hash, the one after it, ... as far as 2 p words
        open_ = open_[open_ + step < len(at)]
        gap = at[open_ + step] - at[open_]
        near = (block[at[open_ + step]] == block[at[open_]]) & (gap <= 2 * p)
        open_, gap = open_[near], gap[near]
        if not len(open_):
            break
        places.append(at[open_[gap > p]])
        distances.append(gap[gap > p])
        step += 1
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(distances)


def runs_of(x: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of word hashes, by start and then period.

    ``min_exponent`` is 3 or more, ``min_words`` at most ``DIRECT``.
    """
    if min_exponent < 3 or min_words > DIRECT:
        raise ValueError("runs repeat three times or more, and the least length is at most that of the first blocks")
    found: dict[tuple[int, int], int] = {}
    n = len(x)
    for p in range(1, min(DIRECT, n // min_exponent) + 1):
        same = np.flatnonzero(x[p:] == x[:-p])
        if not len(same):
            continue
        cut = np.flatnonzero(np.diff(same) != 1)
        first, last = same[np.r_[0, cut + 1]], same[np.r_[cut, len(same) - 1]]
        long = last - first + 1 + p >= max(min_words, min_exponent * p)
        for start, end in zip(first[long].tolist(), (last[long] + 1 + p).tolist(), strict=True):
            found.setdefault((start, end), p)  # a multiple of a run's period gives the same stretch again
    block, p = x, 1
    while min_exponent * (p + 1) <= n:
        if p >= DIRECT:
            places, distances = _seeds(x, block, p, found)
            order = np.lexsort((places, distances))
            seen = (0, 0)  # distance and end of the stretch looked at last
            for m, q in zip(places[order].tolist(), distances[order].tolist(), strict=True):
                if seen[0] == q and m < seen[1]:
                    continue
                ahead = _equal_ahead(x[m:], x[m + q :])
                back = _equal_ahead(x[:m][::-1], x[: m + q][::-1][: m])
                start, end = m - back, m + q + ahead
                seen = (q, m + ahead)
                if end - start >= max(min_words, min_exponent * q):
                    found.setdefault((start, end), q)
        # The hash of 2 p words from those of its halves.
        with np.errstate(over="ignore"):
            block = textops.mix(block[:-p] * U64(textops.mixed(p) | 1) + block[p:])
        p *= 2
    return sorted((start, end - start, q) for (start, end), q in found.items())


def _grouped_runs(x: np.ndarray, at: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs of each text of a slice. ``at``: first word of each text, and their number.

    Short texts are looked at together, with a word of its own between any two: no
    stretch of ``MIN_EXPONENT`` periods can reach over it.
    """
    sizes = np.diff(at)
    own = np.flatnonzero(sizes >= MIN_WORDS)
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    if not len(own):
        return out
    joined = np.empty(int(sizes[own].sum()) + len(own), U64)
    begin = np.r_[0, np.cumsum(sizes[own] + 1)]
    keep = np.ones(len(joined), bool)
    keep[begin[1:] - 1] = False
    inside = np.zeros(len(x), bool)
    for d in own.tolist():
        inside[at[d] : at[d + 1]] = True
    joined[keep] = x[inside]
    joined[~keep] = textops.mix(np.arange(1, len(own) + 1, dtype=U64) << U64(40))  # marks, each its own
    for start, length, q in runs_of(joined):
        d = int(np.searchsorted(begin, start, side="right")) - 1
        out[int(own[d])].append((start - int(begin[d]), length, q))
    return out


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """The words that no run holds after its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) == 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, runs (by start, then period), collapsed.

    Words are runs of anything but white space, numbered from 0, and compared by
    64-bit hashes. ``collapsed`` is the text without the words that a run holds
    after its first period, the others joined by one space. A null or empty text
    has no words, no runs and an empty ``collapsed``. Nulls elsewhere, repeated
    rows and an empty table need no care; other columns are ignored.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch.column(1)):
                starts, ends = textops.words(part)
                at = part.per_row(starts)
                runs = _grouped_runs(textops.hashes(part.data, starts, ends), at)
                raw, texts = part.data.tobytes(), []
                for d, own in enumerate(runs):
                    words = raw[part.offsets[d] : part.offsets[d + 1]].split()
                    if own:
                        words = [words[i] for i in np.flatnonzero(_kept(len(words), own)).tolist()]
                    texts.append(b" ".join(words))
                listed = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], _RUNS)
                ids = batch.column(0).slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(at)), listed, pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"],
                )

    frame = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    return frame.mapInArrow(run, f"doc_id {frame.schema[0].dataType.simpleString()}, n_words bigint, runs {RUNS}, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The texts of the contract: every tenth one, by the CRC of its id, goes on from a place of its own with repeats of what stands there."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(doc_id.cast("string").cast("binary"))

    def repeated(w: Column) -> Column:
        n, g = F.size(w).cast("bigint"), F.floor(h / 10)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p))
        moved = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(w, place(i).cast("int")))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise(text)

    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), repeated), 0)).otherwise(text)


def op11_multi_scale_minimizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs.withColumn("text", planted(F.col("doc_id"), F.col("text"))))
    best = F.aggregate(
        "runs", F.get("runs", 0),
        # Longer in exact proportion; of equal ones the first, as runs are in order of start and period.
        lambda top, r: F.when(r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        sha(listed).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


# Words are joined with equal ones further on in their text, and neighbours at one distance make a stretch.
# The CRC takes bytes one by one through the table of its polynomial.
OP11_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i AS n, i::UBIGINT AS x, 0 AS k FROM range(256) AS r(i)
  UNION ALL SELECT n, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END), k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(x ORDER BY n) AS t FROM bits WHERE k = 8),
d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS h
  FROM documents, crc),
m AS (SELECT doc_id, w, h, len(w) AS n, h // 10 AS g FROM d),
p AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM m),
x AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w FROM p),
e AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM x),
q AS (SELECT a.doc_id, b.i - a.i AS q, a.i FROM e a JOIN e b ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i AND 3 * (b.i - a.i) <= a.n),
s AS (SELECT doc_id, q, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch, i FROM q),
f AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY doc_id, q, stretch HAVING count(*) + q >= greatest(24, 3 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM f GROUP BY doc_id, start, length),
b AS (
  SELECT doc_id, start, length, period FROM r
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
l AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
c AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM e
  WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = e.doc_id AND e.i >= r.start + r.period AND e.i < r.start + r.length) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length, b.period::BIGINT AS period,
  (1000 * b.length // b.period)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)
"""
