"""Periodic runs of words: stretches that repeat a block of words over and over.

A run is a stretch of words with smallest period q (words q apart are equal),
of at least ``times`` * q words and at least ``least`` words, that no
neighbouring word extends.  Every run is found:

* **Harmonic grid.** A run of ``times`` * q words holds (times - 1) * q places
  whose word equals the one q later, so one of the places 0, (times - 1) * q,
  2 * (times - 1) * q, ... is in it.  Over all q that is n / (times - 1) * (1 +
  1/2 + 1/3 + ...) places.  At each whose words agree, the longest common
  extension (LCE) of place and place + q, forwards and backwards, gives the
  whole stretch.
* **LCE by a difference cover.** The places whose number modulo ``v`` lies in a
  difference cover are the samples; any two places reach two samples by the
  same step of less than ``v`` words.  Only the samples' suffixes are sorted (by
  doubling in steps of v words), so an LCE compares a few words directly and
  asks a sparse table of minima over the sorted samples for the rest.
* A stretch with several periods keeps the smallest.

Texts are spread over Spark's tasks; a task joins the words of a slice of
texts into one sequence with a distinct mark after each text, so one sort
serves many texts and no extension leaves its text.

Defined cases: a null or empty text has no words and no runs; a null ``doc_id``
is a value; repeated rows are each analysed; an empty table gives an empty
result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, words_of

# Workers get this module's functions with the task; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST, TIMES = 6, 4
#: Bytes of text that a worker joins into one sequence (or one longer text), and grid places it holds at a time.
SLICE_BYTES, PLACES = 1 << 20, 1 << 20
MODULUS = 32


def difference_cover(v: int) -> list[int]:
    """Residues such that every difference modulo v occurs: 0 to r-1 and the multiples of r, r about the root of v."""
    r = int(np.ceil(np.sqrt(v)))
    return sorted({*range(r), *(x % v for x in range(0, v + r, r))})


class Extensions:
    """Longest common extensions of any two places of a sequence of numbers."""

    def __init__(self, words: np.ndarray, v: int = MODULUS):
        self.n, self.v = len(words), v
        self.words = np.concatenate([words, words.max(initial=0) + 1 + np.arange(2 * v)])  # beyond the end nothing is equal
        cover = np.array(difference_cover(v))
        # step[(i mod v), (j mod v)]: the least d with i + d and j + d both samples.
        inside = np.zeros(v, dtype=bool)
        inside[cover] = True
        both = inside[(np.arange(v)[:, None, None] + np.arange(v)) % v] & inside[(np.arange(v)[None, :, None] + np.arange(v)) % v]
        self.step = both.argmax(axis=2)
        places = np.arange(self.n + v)
        self.samples = places[inside[places % v]]
        self.index = np.full(self.n + 2 * v, -1, dtype=np.int64)
        self.index[self.samples] = np.arange(len(self.samples))
        self._sort()

    def _sort(self) -> None:
        s, v, m = self.samples, self.v, len(self.samples)
        # Ranks of the samples' first v words, from the last word to the first; as many words at once as a number holds.
        base = int(self.words.max()) + 1
        per = max(1, (62 - (m + 1).bit_length()) // base.bit_length())
        rank = np.zeros(m, dtype=np.int64)
        for end in range(v, 0, -per):
            key = np.zeros(m, dtype=np.int64)
            for d in range(max(0, end - per), end):
                key = key * base + self.words[s + d]
            rank = np.unique(key * (m + 1) + rank, return_inverse=True)[1].astype(np.int64)
        # Names of v, 2v, 4v, ... words at the samples: a step of v words leads from sample to sample.
        self.levels, reach = [rank], v
        while rank.max(initial=0) < m - 1 and reach < self.n + v:
            far = s + reach
            ok = far < self.n + v
            after = np.zeros(m, dtype=np.int64)
            after[ok] = rank[self.index[far[ok]]] + 1
            rank = np.unique(rank * (m + 1) + after, return_inverse=True)[1].astype(np.int64)
            self.levels.append(rank)
            reach *= 2
        order = np.argsort(rank, kind="stable")
        self.rank = np.empty(m, dtype=np.int64)
        self.rank[order] = np.arange(m)
        # Words that neighbours in this order share: whole levels first, then up to v - 1 words.
        a, b = s[order[:-1]], s[order[1:]]
        shared = np.zeros(max(m - 1, 0), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a + shared, b + shared
            ok = np.maximum(x, y) < self.n + v
            same = np.zeros(len(a), dtype=bool)
            same[ok] = self.levels[k][self.index[x[ok]]] == self.levels[k][self.index[y[ok]]]
            shared[same] += v << k
        shared += self._direct(a + shared, b + shared, np.full(len(a), v))
        self.levels = None
        # minima[k][i]: the least of the 2^k numbers from i.
        self.minima = [shared]
        while len(self.minima[-1]) > 1 << (len(self.minima) - 1):
            half = 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(self.minima[-1][:-half], self.minima[-1][half:]))

    def _direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, up to ``most``, by comparing words."""
        out = np.zeros(len(i), dtype=np.int64)
        going = np.arange(len(i))
        for d in range(int(most.max(initial=0))):
            going = going[d < most[going]]
            x, y = np.minimum(i[going] + d, self.n + self.v), np.minimum(j[going] + d, self.n + self.v)
            going = going[(self.words[x] == self.words[y]) & (x < self.n) & (y < self.n)]
            if not len(going):
                break
            out[going] += 1
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i != j, both within the sequence)."""
        step = self.step[i % self.v, j % self.v]
        out = self._direct(i, j, step)
        full = np.flatnonzero(out == step)
        x, y = self.rank[self.index[i[full] + step[full]]], self.rank[self.index[j[full] + step[full]]]
        low, size = np.minimum(x, y), np.abs(x - y)
        k = np.frexp(size.astype(np.float64))[1] - 1  # floor(log2(size))
        rest = np.empty(len(full), dtype=np.int64)
        for level in np.unique(k):
            at = np.flatnonzero(k == level)
            table = self.minima[level]
            rest[at] = np.minimum(table[low[at]], table[low[at] + size[at] - (1 << int(level))])
        out[full] += rest
        return out


def _places(starts: np.ndarray, sizes: np.ndarray, least: int, times: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The harmonic grid of every text as (place, period), at most about ``most`` at a time."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    q, longest = 1, int(sizes.max(initial=0))
    while times * q <= longest and longest >= least:
        held = int(np.searchsorted(-sizes, -max(least, times * q), "right"))  # texts that can hold the period
        # As many periods at once as ``most`` places allow.
        per = int((sizes[:held] // ((times - 1) * q) + 1).sum())
        top = min(q + max(1, most // max(per, 1)), longest // times + 1)
        periods = np.repeat(np.arange(q, top), held)
        first, size = np.tile(starts[:held], top - q), np.tile(sizes[:held], top - q)
        stride = (times - 1) * periods
        count = np.maximum(0, -(-(size - periods) // stride)) * (size >= times * periods)
        ends = np.cumsum(count)
        step = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)
        yield np.repeat(first, count) + step * np.repeat(stride, count), np.repeat(periods, count)
        q = top


def runs_of(words: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES,
            v: int = MODULUS, most: int = PLACES) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of every run; ``words`` holds the texts' word numbers one after another."""
    sizes = np.asarray(sizes, dtype=np.int64)
    none = (np.empty(0, dtype=np.int64),) * 4
    if not len(words) or sizes.max(initial=0) < least:
        return none
    # One sequence with a number of its own after each text.
    ends = np.cumsum(sizes)
    marks = words.max() + 1 + np.arange(len(sizes))
    joined = np.insert(words.astype(np.int64), ends, marks)
    starts = ends - sizes + np.arange(len(sizes))
    hits = [(g[same], q[same]) for g, q in _places(starts, sizes, least, times, most) if len(same := np.flatnonzero(joined[g] == joined[g + q]))]
    if not hits:
        return none
    g, q = (np.concatenate(x) for x in zip(*hits))
    ahead, back = Extensions(joined, v), Extensions(joined[::-1].copy(), v)
    n = len(joined)
    forth = ahead.lce(g, g + q)
    before = np.zeros(len(g), dtype=np.int64)
    inner = g > 0
    before[inner] = back.lce(n - g[inner], n - g[inner] - q[inner])  # from the words before both places, backwards
    start, length = g - before, q + forth + before
    ok = length >= np.maximum(least, times * q)
    start, length, q = start[ok], length[ok], q[ok]
    # Of one stretch the smallest period, each once.
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[new], length[new], q[new]
    order = np.lexsort((q, start))
    start, length, q = start[order], length[order], q[order]
    text = np.searchsorted(starts, start, "right") - 1
    return text, start - starts[text], length, q


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of up to ``SLICE_BYTES`` bytes, or one longer text."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = done = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, "right")))
        yield texts.slice(a, b - a)
        a, done = b, int(sizes[b - 1])


def _analyse(texts: pa.Array, least: int, times: int) -> tuple[np.ndarray, list[list[dict]], pa.Array]:
    """Words per text, its runs, and the text with every run cut to its first period."""
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)  # white space at an end gives empty parts
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    bounds = np.concatenate([[0], np.cumsum(real)])[offsets]
    words = flat.filter(pa.array(real))
    sizes = np.diff(bounds)
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    text, start, length, period = runs_of(numbers, sizes, least, times)
    runs: list[list[dict]] = [[] for _ in sizes]
    for t, s, n, q in zip(text.tolist(), start.tolist(), length.tolist(), period.tolist()):
        runs[t].append({"start": s, "length": n, "period": q})
    # Words that lie in a run behind its first period: a sum of +1 and -1 marks.
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, bounds[text] + start + period, 1)
    np.add.at(edge, bounds[text] + start + length, -1)
    keep = np.cumsum(edge[:-1]) == 0
    kept = words.filter(pa.array(keep))
    kept_bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
    lists = pa.LargeListArray.from_arrays(kept_bounds, kept) if pa.types.is_large_string(kept.type) else pa.ListArray.from_arrays(kept_bounds.astype("int32"), kept)
    return sizes, runs, pc.binary_join(lists, " ")


RUNS = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs by start, then period, and the words that remain when every run
    keeps its first period only, joined by one space."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    run = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])

    @F.arrow_udf(f"struct<n_words:long,runs:{RUNS},collapsed:string>")
    def find(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            done = [_analyse(some, least, times) for some in _slices(texts)]
            yield pa.StructArray.from_arrays([
                pa.array(np.concatenate([s for s, _, _ in done]) if done else [], pa.int64()),
                pa.array([r for _, runs, _ in done for r in runs], pa.list_(run)),
                pa.concat_arrays([c.cast(pa.string()) for _, _, c in done]) if done else pa.array([], pa.string())],
                names=["n_words", "runs", "collapsed"])

    return rows.select("doc_id", find("t").alias("f")).select("doc_id", "f.n_words", "f.runs", "f.collapsed")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) where every tenth id by crc32 has its words from place a on repeat the p original words there:
    h = crc32(decimal id), g = h div 10, a = g mod n, p = 1 + (n - a) div (3 + g mod 8).  A null id changes nothing."""
    g = F.floor(F.crc32(F.col("doc_id").cast("string")) / 10).cast("long")
    n = F.size("w").cast("long")
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    hit = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    rows = rows.withColumn("w", F.when(hit, words_of(F.col("text"))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    changed = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(n > 0, F.concat_ws(" ", changed)).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: least start, then period) and digests of all runs and of the collapsed text."""
    best: Column = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
