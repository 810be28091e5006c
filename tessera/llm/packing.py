"""Packing token sequences by non-negative least squares.

A document's ids are cut into full windows and a remainder, so only the
remainders need packing.  Their lengths, rounded up to ``GRAIN``, give a
histogram of at most window / GRAIN bins.  Shallow combinations (up to three
lengths) that fill a window exactly are enumerated; non-negative least squares
finds how often to repeat each so that together they use up the histogram;
counts are rounded down to what the histogram holds, and what remains is packed
greedily, longest first, on the histogram.  The result is a short list of
(combination, repeats).  Remainders are ranked within their bin and take the
slots of the combinations in order, so placing them is arithmetic on the
rank, distributed over all tasks.

Tokenising runs in Arrow batches; only the histogram (at most 256 counts)
reaches the driver.

Defined cases: a null or empty text is the end id alone; a null ``doc_id`` is
a value; repeated rows are packed each; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gapless_rank, stage_table, text_of

# Workers get this module's functions with the task; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, GRAIN, DEPTH, END_ID = 2048, 8, 3, 1
VOCABULARY = "word_bpe_49k.json"
#: Entries in a worker's memory of tokenised words; it starts afresh beyond that.
MEMORY = 100_000
#: Bytes of text that a worker tokenises at a time.
SLICE_BYTES = 1 << 20


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# Letters whose lower case and normal form stand alone (ASCII, Latin-1 and Extended-A but for the dotted I), then ASCII marks.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)([!-&(-/:-@\\[-`{-~]*)")
#: Stands for the end of a word in byte strings; it never occurs in UTF-8.
_END = b"\xff"


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next free one from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizer:
    """ids of a text as the tokenizer gives them.

    The vocabulary's splitter never joins text across a space, so a text's ids
    are those of its parts between ASCII white space; parts are remembered.  A
    part of plain letters and marks is merged by tiktoken's faster merge over
    the same vocabulary (its merges are numbered in id order, which is checked,
    so least id first is least merge first); every other part goes to the
    tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Given
        self.given, self.memory, self.merge = Given.from_file(path), {}, None
        model = json.loads(Path(path).read_text("utf-8"))["model"]
        vocabulary, end = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        first = len(vocabulary) - len(merges) - sum(t.startswith("<|") for t in vocabulary)
        if end and all(vocabulary.get(a + b) == first + i for i, (a, b) in enumerate(merges)):
            import tiktoken
            letters = _byte_letters()
            ranks = {}
            for token, i in vocabulary.items():
                if not token.startswith("<|"):
                    ends = token.endswith(end) and token != end
                    core = token[:-len(end)] if ends else token
                    ranks[bytes(letters[c] for c in core) + (_END if ends else b"")] = i
            self.merge = tiktoken.Encoding("packing", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def _part(self, text: str) -> bytes:
        plain = self.merge and _PLAIN.fullmatch(text)
        if plain:
            letters, marks = plain.groups()
            ids = self.merge(letters.lower().encode() + _END)
            if marks:
                ids = ids + self.merge(marks.encode() + _END)
        else:
            ids = self.given.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; every distinct part is looked up once."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        distinct, memory = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.memory
        if len(memory) > MEMORY:
            memory.clear()
        known = []
        for p in distinct:
            ids = memory.get(p)
            if ids is None:
                ids = memory[p] = self._part(p)
            known.append(ids)
        flat = np.frombuffer(b"".join(known), dtype="<u4")
        size = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        codes = coded.indices.to_numpy(zero_copy_only=False)
        per = size[codes]
        ends = np.concatenate([[0], np.cumsum(per)])
        # Where each id of each part lies in ``flat``.
        start = (np.cumsum(size) - size)[codes] - ends[:-1]
        ids = flat[np.repeat(start, per) + np.arange(ends[-1])]
        bounds = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def ids(self, text: str) -> np.ndarray:
        return self.batch(pa.array([text], pa.large_string()))[0]


def _by_size(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Slices of up to ``most`` bytes (or one longer text), so that a worker's arrays stay small."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = done = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(sizes, done + most, "right")))
        yield texts.slice(a, b - a)
        a, done = b, int(sizes[b - 1])


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
           end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): full windows and a remainder per row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    piece = "struct<start:long,length:long,ids_crc32:long" + (",ids:array<int>" if keep_ids else "") + ">"
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * keep_ids
    kind = pa.struct([("doc_tokens", pa.int64()), ("pieces", pa.list_(pa.struct(fields)))])

    def row(ids: np.ndarray) -> dict:
        ids = np.append(ids, np.uint32(end_id))
        cut = [(a, ids[a:a + window]) for a in range(0, len(ids), window)]
        return {"doc_tokens": len(ids),
                "pieces": [{"start": a, "length": len(x), "ids_crc32": zlib.crc32(x.tobytes())} | ({"ids": x.astype("int32")} if keep_ids else {}) for a, x in cut]}

    @F.arrow_udf(f"struct<doc_tokens:long,pieces:array<{piece}>>")
    def cut(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = Tokenizer(path)
        for texts in parts:
            yield pa.array([row(ids) for some in _by_size(texts) for ids in tokenizer.batch(some)], kind)

    got = rows.select(F.col("doc_id").cast(id_type), cut("t").alias("c"))
    return got.select("doc_id", "c.doc_tokens", F.inline("c.pieces")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * keep_ids)


def nnls(a: np.ndarray, b: np.ndarray, most: int = 3000) -> np.ndarray:
    """Non-negative least squares by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, dtype=bool)
    scale = max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(most):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        k = int(slope.argmax())
        if slope[k] <= 1e-9 * scale:
            break
        free[k] = True
        while True:
            idx = np.flatnonzero(free)
            z = np.linalg.lstsq(a[:, idx], b, rcond=None)[0]
            if (z > 1e-9).all():
                x[:] = 0
                x[idx] = z
                break
            low = z <= 1e-9
            step = (x[idx][low] / np.maximum(x[idx][low] - z[low], 1e-300)).min()
            x[idx] += min(1.0, step) * (z - x[idx])
            gone = idx[(x[idx] <= 1e-9)]
            if not len(gone):
                gone = idx[low][:1]
            x[gone] = 0
            free[gone] = False
    return x


def combinations(bins: list[int], full: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Multisets of up to ``depth`` of the given lengths whose sum is ``full``."""
    have, out = set(bins), []

    def grow(head: tuple[int, ...], rest: int):
        if rest == 0:
            out.append(head)
        elif len(head) < depth:
            for b in sorted(have):
                if b <= rest and (not head or b <= head[-1]):
                    grow((*head, b), rest - b)

    grow((), full)
    return out


def strategies(histogram: dict[int, int], full: int, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(combination of bins, repeats) that together use every count of the histogram."""
    left = {b: n for b, n in histogram.items() if n > 0}
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(combo: tuple[int, ...], times: int) -> None:
        times = min([times, *(left.get(b, 0) // combo.count(b) for b in set(combo))])
        if times > 0:
            plan.append((combo, times))
            for b in combo:
                left[b] -= times

    combos = combinations(list(left), full, depth)
    if combos:
        place = {b: i for i, b in enumerate(sorted(left))}
        a = np.zeros((len(place), len(combos)))
        for j, c in enumerate(combos):
            for b in c:
                a[place[b], j] += 1
        repeats = nnls(a, np.array([left[b] for b in place], dtype=float))
        for j in np.argsort(-repeats, kind="stable"):
            take(combos[j], int(repeats[j]))
    while any(left.values()):  # each turn uses up one bin at least
        combo: list[int] = []
        room = full
        for b in sorted((b for b in left if left[b]), reverse=True):
            n = min(room // b, left[b])
            combo += [b] * n
            room -= n * b
        take(tuple(combo), max(left.values()))
    return plan


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, grain: int = GRAIN,
         depth: int = DEPTH, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded (the sequence's
    length after padding)[, ids].  ``keep_ids`` carries the ids along."""
    cut = stage_table(pieces(docs, path, id_col, text_col, window, end_id, keep_ids)
                      .withColumn("bin", F.ceil(F.col("length") / grain).cast("int")), "pieces")
    top = window // grain
    histogram = {r["bin"]: r["count"] for r in cut.groupBy("bin").count().collect()}  # at most window / grain rows
    plan = strategies(histogram, top, depth)
    # Slots per bin: where each combination's share starts, its slots per copy, and its first sequence.
    slots: dict[int, list[tuple[int, int, int]]] = {b: [] for b in histogram}
    taken, first = dict.fromkeys(histogram, 0), 0
    for combo, times in plan:
        for b in set(combo):
            slots[b].append((taken[b], combo.count(b), first))
            taken[b] += combo.count(b) * times
        first += times
    table = cut.sparkSession.createDataFrame(
        [(b, [x[0] for x in s], [x[1] for x in s], [x[2] for x in s]) for b, s in slots.items()],
        "s_bin int, starts array<long>, per array<long>, firsts array<long>")  # at most window / grain rows
    ranked = gapless_rank(cut, "bin", ["doc_id", "start", "ids_crc32"], "rank")
    at = F.size(F.filter("starts", lambda s: s <= F.col("rank")))
    placed = (ranked.join(F.broadcast(table), F.col("bin") == F.col("s_bin")).withColumn("_at", at)
              .withColumn("sequence_id", F.expr("firsts[_at - 1] + (rank - starts[_at - 1]) div per[_at - 1]")))
    placed = placed.select(*[c for c in cut.columns if c != "bin"], "sequence_id")
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")  # at most ``window`` pieces
    whole = Window.partitionBy("sequence_id")
    total = F.sum("length").over(whole)
    power = F.pow(F.lit(2.0), F.ceil(F.log2(total))).cast("long") == total
    out = placed.withColumn("offset", F.coalesce(F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = out.withColumn("padded", F.when(power, total).otherwise(F.lit(window).cast("long")))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded", *["ids"] * keep_ids)
