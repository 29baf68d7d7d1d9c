"""Periodic runs of words by multi-scale minimizers, and texts with their runs collapsed to one period.

A run is a stretch of words that repeats with a smallest period q, at least three times over, and that no
neighbouring word extends. Short periods are found by scanning each lag. For longer ones the words are looked at
on scales W = 48, 96, 192, ...: inside a run whose period is in [W, 2W) the minimizers of windows of grams repeat at
a distance of the period, so pairs of equal minimizers so far apart are the seeds from which runs are extended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from shelfcast.llm.common import IS_SEPARATOR, PIECE, WORD, U, arrow_schema, mix, powers, ship, span_hashes, text_pieces, word_spans

# Words of the shortest run, and periods of the shortest run.
LEAST_WORDS, LEAST_TIMES = 24, 3
# Periods below the first scale are scanned lag by lag. Grams of half that many words are long enough to hold a run.
FIRST_SCALE = 2 * LEAST_WORDS
_BASE = 0xC6BC279692B5C323
_INVERSE = pow(_BASE, -1, 1 << 64)


def least_length(period: int) -> int:
    return max(LEAST_WORDS, LEAST_TIMES * period)


def reach(x: np.ndarray, m: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The largest [start, stop) around m in which x[i] == x[i + lag]; low and high bound the words to look at.
    Words are compared in blocks that double, so the cost follows the stretch's length."""
    stop, step, most = m, 64, high - lag
    while stop < most:
        end = min(most, stop + step)
        same = x[stop:end] == x[stop + lag : end + lag]
        if not same.all():
            stop += int(same.argmin())
            break
        stop, step = end, 2 * step
    start, step = m, 64
    while start > low:
        begin = max(low, start - step)
        same = (x[begin:start] == x[begin + lag : start + lag])[::-1]
        if not same.all():
            start -= int(same.argmin())
            break
        start, step = begin, 2 * step
    return start, stop


def prime_factors(n: int) -> list[int]:
    out, k = [], 2
    while k * k <= n:
        if n % k == 0:
            out.append(k)
            while n % k == 0:
                n //= k
        k += 1
    return [*out, n] if n > 1 else out


def is_smallest(x: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch from `start` on, two periods long at least, has no smaller period. A smaller one would
    divide this one, and then show within one period."""
    for f in prime_factors(period):
        q = period // f
        if np.array_equal(x[start : start + period], x[start + q : start + q + period]):
            return False
    return True


@dataclass
class Texts:
    """Words of several texts end to end, as 64-bit hashes, and where each text's words begin and end."""

    x: np.ndarray
    first: np.ndarray

    def __post_init__(self) -> None:
        self.owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _extended(texts: Texts, seeds: np.ndarray, lag: int, found: list[tuple[int, int, int]]) -> None:
    """Runs of period `lag` around the seeds (ascending); a seed within the stretch of an earlier one is done."""
    done = -1
    for m in seeds.tolist():
        if m < done:
            continue
        text = texts.owner[m]
        start, stop = reach(texts.x, m, lag, texts.first[text], texts.first[text + 1])
        done = max(stop, m + 1)
        if stop - start + lag >= least_length(lag) and is_smallest(texts.x, start, lag):
            found.append((start, stop - start + lag, lag))


def _scanned(texts: Texts, lag: int, found: list[tuple[int, int, int]]) -> None:
    """Runs of one short period. A run has at least `need` words that equal the one a lag on, so three places in a
    row, a quarter of that apart, are among them; only such places are extended."""
    need = least_length(lag) - lag
    step = need // 4
    same = texts.x[:-lag:step] == texts.x[lag::step]
    three = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * step
    if len(three):
        three = three[texts.owner[three] == texts.owner[three + lag]]
        _extended(texts, three, lag, found)


def _prefix_hashes(x: np.ndarray):
    """A function that gives the hash of the n words from each of some places on."""
    up, down = powers(_BASE, len(x) + 1), powers(_INVERSE, len(x) + 1)
    sums = np.concatenate((np.zeros(1, U), np.cumsum(x * up[:-1])))

    def at(starts: np.ndarray, n: int | np.ndarray) -> np.ndarray:
        return mix((sums[starts + n] - sums[starts]) * down[starts])

    return at


def _window_minima(key: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each n keys in a row."""
    width = 1
    while 2 * width <= n:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    return key if width == n else np.minimum(key[: len(key) - (n - width)], key[n - width :])


def minimizers(texts: Texts, scale: int, found: list[tuple[int, int, int]], hashes) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that are smallest in some window, on a scale W: grams of W/2 words, W/2 of them
    in a window, the leftmost of equal ones.

    Grams that hold a period of at most a third of their words are left out: they lie in runs found on earlier scales,
    and equal ones of the others are then more than a third of their words apart, so that no place has many
    partners. Whether a gram is left out depends on its words alone, and not all grams of a period can be, so a run
    of a period in [W, 2W) keeps a window whose minimizer is found again one period on.
    """
    gram = window = scale // 2
    n = len(texts.x) - gram + 1
    places = np.arange(n)
    out = texts.owner[:n] != texts.owner[gram - 1 :]
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        if LEAST_TIMES * period <= gram <= length:
            edge[start] += 1
            edge[min(n, start + length - gram + 1)] -= 1
    out |= np.cumsum(edge[:-1]) > 0
    full = hashes(places, gram)
    key = np.where(out, ~U(0), (full >> U(32) << U(32)) | places.astype(U))
    if n < window:
        return np.empty(0, np.int64), np.empty(0, U)
    smallest = _window_minima(key, window)
    chosen = smallest[np.flatnonzero(np.diff(smallest, prepend=~smallest[:1]))]
    chosen = np.unique((chosen[chosen != ~U(0)] & U(0xFFFFFFFF)).astype(np.int64))
    return chosen, full[chosen]


def _seeds(texts: Texts, scale: int, found: list[tuple[int, int, int]], hashes) -> dict[int, np.ndarray]:
    """By distance, the places from which an equal minimizer lies that far on, in [scale, 2 scale), and a whole period
    on one side of which repeats."""
    places, values = minimizers(texts, scale, found, hashes)
    order = np.lexsort((places, values))
    places, values = places[order], values[order]
    seeds, lags, ahead = [], [], 1
    while ahead < len(places):
        near = (values[ahead:] == values[:-ahead]) & (places[ahead:] - places[:-ahead] < 2 * scale)
        if not near.any():
            break  # grams further on are further apart
        at = np.flatnonzero(near & (places[ahead:] - places[:-ahead] >= scale))
        seeds.append(places[at])
        lags.append(places[at + ahead] - places[at])
        ahead += 1
    if not seeds:
        return {}
    seed, lag = np.concatenate(seeds), np.concatenate(lags)
    low, high = texts.first[texts.owner[seed]], texts.first[texts.owner[seed] + 1]
    inside = seed + lag < high
    seed, lag, low, high = seed[inside], lag[inside], low[inside], high[inside]
    # Two thirds of a run equal the words a period on, so from any such word a whole period does, ahead or behind.
    good = np.zeros(len(seed), bool)
    fits = np.flatnonzero(seed + 2 * lag <= high)
    good[fits] = hashes(seed[fits], lag[fits]) == hashes(seed[fits] + lag[fits], lag[fits])
    fits = np.flatnonzero((seed - lag >= low) & ~good)
    good[fits] = hashes(seed[fits] - lag[fits], lag[fits]) == hashes(seed[fits], lag[fits])
    return {int(d): np.sort(seed[good & (lag == d)]) for d in np.unique(lag[good])}


def runs_of(texts: Texts) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of texts laid end to end, by start, then period; starts count through."""
    found: list[tuple[int, int, int]] = []
    longest = int(np.diff(texts.first).max(initial=0))
    for lag in range(1, min(FIRST_SCALE, longest // LEAST_TIMES + 1)):
        if len(texts.x) - lag >= LEAST_WORDS - lag and longest >= least_length(lag):
            _scanned(texts, lag, found)
    scale = FIRST_SCALE
    while LEAST_TIMES * scale <= longest:
        # Only texts long enough for a period of this scale go on.
        long = np.flatnonzero(np.diff(texts.first) >= LEAST_TIMES * scale)
        sizes = np.diff(texts.first)[long]
        first = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
        shift = texts.first[long] - first[:-1]
        part = Texts(np.concatenate([texts.x[texts.first[k] : texts.first[k + 1]] for k in long]), first)
        back = np.full(len(texts.first) - 1, -1)
        back[long] = np.arange(len(long))
        known = [(s - shift[back[texts.owner[s]]], n, q) for s, n, q in found if back[texts.owner[s]] >= 0]
        fresh: list[tuple[int, int, int]] = []
        for lag, seeds in _seeds(part, scale, known, _prefix_hashes(part.x)).items():
            _extended(part, seeds, lag, fresh)
        found.extend((int(s + shift[part.owner[s]]), n, q) for s, n, q in fresh)
        scale *= 2
    return sorted({(int(s), int(n), int(q)) for s, n, q in found}, key=lambda r: (r[0], r[2]))


def dropped_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of a text's n words lie in some run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, drop: np.ndarray | None) -> bytes:
    """The words that stay, joined by one space."""
    if drop is not None:
        starts, ends = starts[~drop], ends[~drop]
    if not len(starts):
        return b""
    lengths = ends - starts + 1  # with the byte after, which becomes the space
    upto = np.cumsum(lengths)
    source = np.arange(upto[-1]) + np.repeat(starts - (upto - lengths), lengths)
    out = data[np.minimum(source, len(data) - 1)]
    out[upto - 1] = 32
    return out[:-1].tobytes()


def analysed(column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Of every text: number of words, runs, and the collapsed text."""
    for i, j, data, offsets in text_pieces(column, PIECE):
        starts, ends, first = word_spans(data, offsets, IS_SEPARATOR)
        texts = Texts(span_hashes(data, starts, ends), first)
        by_text: dict[int, list[tuple[int, int, int]]] = {}
        for start, length, period in runs_of(texts):
            text = int(texts.owner[start])
            by_text.setdefault(text, []).append((start - int(first[text]), length, period))
        for k in range(j - i):
            a, z = int(first[k]), int(first[k + 1])
            runs = by_text.get(k, [])
            drop = dropped_words(z - a, runs) if runs else None
            yield z - a, runs, collapsed(data, starts[a:z], ends[a:z], drop)


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equal ones the first to start, then the shortest period."""
    best = None
    for run in runs:
        if best is None or (-run[1] * best[2], run[0], run[2]) < (-best[1] * run[2], best[0], best[2]):
            best = run
    return best


DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(DIGEST)
    for batch in batches:
        rows = []
        for _, runs, kept in analysed(batch.column("text")):
            best = strongest(runs)
            top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
            rows.append((len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
        columns = zip(*rows, strict=True) if rows else [[]] * (len(schema) - 1)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], schema=schema)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        runs, texts = [], []
        for _, found, kept in analysed(batch.column("text")):
            runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
            texts.append(kept.decode())
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(runs, kind), pa.array(texts, pa.string())], names=["row", "runs", "text"])


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per row of `docs`: `row`, the row itself as a struct (so that no name clashes), `runs`, all its runs (start,
    length, period: word numbers from 0), and `text`, the words that are left, joined by one space, when those go
    that lie in a run after its first period.

    Words are compared by 64-bit hashes. Each text is worked on alone, whole, in one task and with arrays in
    proportion to its length; nothing is shuffled. Null, empty and wordless texts have no runs and an empty text.
    Repeated rows are rows of their own. An empty table gives an empty one.
    """
    ship(docs.sparkSession)
    run = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
    schema = StructType([StructField("row", docs.schema), StructField("runs", ArrayType(run)), StructField("text", StringType())])
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_collapse, schema)


def run_digests(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_runs; start, length, period and exponent_milli (1000 length /
    period, cut) of its strongest run, null without one; runs_sha256, the hash of all runs as lines of
    `start,length,period`; and collapsed_sha256, the hash of what `periodic_runs` leaves of the text. The rest is as
    there; a null id stays null."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_digests, DIGEST)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of `docs`, where every tenth document by h = crc32(doc_id), those with h % 10 = 0, repeats
    itself: with g = h / 10 cut and n words, words from a = g % n on repeat the first p = 1 + (n - a) / (3 + g % 8),
    cut, of them, joined by one space. A null id counts as an empty one."""
    h: Column = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    text = F.col("text").cast("string")
    planted = F.pmod(h, F.lit(10)) == 0
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    some = docs.select("doc_id", text.alias("text"), h.alias("h"), F.when(planted, words).alias("w"))
    shaped = some.withColumn("g", F.floor(F.col("h") / 10).cast("long")).withColumn("n", F.size("w").cast("long"))
    repeated = F.expr(
        """array_join(transform(sequence(0L, n - 1), i -> element_at(w, cast(1 + if(i < g % n, i,
            g % n + (i - g % n) % (1 + (n - g % n) div (3 + g % 8))) AS int))), ' ')"""
    )
    return shaped.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))
