"""Exact token counts at every prefix of a text, by dynamic programming.

A byte-pair encoding has two properties: an encoding less its last token is the
encoding of the shorter text, and a sequence of tokens is an encoding if each
neighbouring pair is one.  So the last token of a prefix is the one token that
ends there and agrees with the last token of the prefix before it, and

    count(prefix) = count(prefix less its last token) + 1.

One pass over a text gives the count at each of its prefixes.  With the counts
stored, "how many tokens are the first k characters" is a lookup and "how much
of the text fits a budget" a search; neither encodes again.

A prefix is counted as the library counts it when given that prefix alone,
though cutting a text can change how it is split: white space before a cut is
one piece, and a cut contraction or special token is plain text.  Positions are
code points.

Texts are cut at ASCII white space after a character that surely is none; such
chunks never share a piece, so each distinct chunk goes through the dynamic
programme once per worker (memory of bounded size) and the counts of a text are
those of its chunks added up.

Defined cases: a null text is empty and has no tokens; a null ``doc_id`` is a
value; repeated rows are counted each; an empty table gives an empty result;
further columns are ignored, whatever their names.  Only byte-level vocabularies
of the common splitting pattern are taken; others raise ``ValueError``.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import accumulate
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

# Workers get this module's functions with the task; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Chunks that a worker remembers, in two halves of which the older one is let go, and the longest of them.
MEMORY, LONGEST_KEPT = 800_000, 64
#: Bytes of text that a worker counts at a time, and counts in a stored block.
SLICE_BYTES, BLOCK = 1 << 20, 4096

#: Bytes at the start of a piece whose states are remembered.
STEM = 5
_CHUNK = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_SIMPLE = re.compile("(\n?)((?:(?<!\n) )?[A-Za-zÀ-ÖØ-öø-ſ]+)([!-&(-/:-@\\[-`{-~]?[!-/:-@\\[-`{-~]*)")
# Characters that some definition calls white space; no chunk starts after one.
_DOUBT = "\x1c-\x1f\x85\xa0 ᠎ -‏ -  -⁠　﻿"
_HAS_DOUBT = re.compile(f"[{_DOUBT}]")
_ENDS_IN_DOUBT = re.compile(f"[{_DOUBT}]\\Z")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next free one from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    """Token counts at every prefix, exactly those of the vocabulary's own library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        conf = json.loads(Path(path).read_text("utf-8"))
        model, split = conf["model"], conf.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or split.get("type") != "ByteLevel" or not split.get("use_regex", True) or split.get("add_prefix_space")
                or conf.get("normalizer") or model.get("dropout") or model.get("ignore_merges")):
            raise ValueError(f"not a plain byte-level vocabulary: {path}")
        added = conf.get("added_tokens") or []
        if any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"special tokens with white space or conditions: {path}")
        specials = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.letters = _byte_letters()
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for i, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.ranks[self._bytes(a), self._bytes(b)] = i
        made = {bytes([b]): -1 for b in range(256)} | {a + b: i for (a, b), i in self.ranks.items()}
        if any(made[a] >= i or made[b] >= i for (a, b), i in self.ranks.items()):
            raise ValueError(f"a merge comes before its parts: {path}")
        self.tokens = set(made)
        # The sizes of tokens, largest first, by their last three bytes (or all, if fewer); shorter ones by theirs.
        sizes: dict[bytes, set[int]] = {}
        for t in self.tokens:
            sizes.setdefault(t[-3:], set()).add(len(t))
        for end in [e for e in sizes if len(e) == 3]:
            sizes[end] |= {len(e) for e in (end[1:], end[2:]) if e in self.tokens}
        for end in [bytes([x, y]) for x in range(256) for y in range(256)]:
            sizes[end] = sizes.get(end, set()) | {1}
        self.sizes = {end: sorted(found, reverse=True) for end, found in sizes.items()}
        self.spines: dict[bytes, tuple[list, list] | None] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.pieces: dict[bytes, list[int]] = {}
        self.stems: dict[bytes, tuple[list, list]] = {}
        self.memory: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        # A word and marks are two pieces, if no special token can hide in them.
        self.simple = None if any(_SIMPLE.search(x).group() == x for x in specials if _SIMPLE.search(x)) else _SIMPLE.fullmatch

    def _bytes(self, letters: str) -> bytes:
        return bytes(self.letters[c] for c in letters)

    def _spine(self, token: bytes) -> tuple[list, list] | None:
        """The token's parts along its left and its right edge, each with the rank of the merge that ends it;
        None if the token's bytes are encoded otherwise."""
        if token in self.spines:
            return self.spines[token]
        parts = [token[i:i + 1] for i in range(len(token))]
        never = len(self.ranks)
        left, right = [], []
        while len(parts) > 1:  # least rank first, leftmost first
            rank, i = min((self.ranks.get(p, never), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == never:
                break
            if i == 0:
                left.append((parts[0], rank))
            if i == len(parts) - 2:
                right.append((parts[-1], rank))
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        found = ([*left, (token, never)], [*right, (token, never)]) if len(parts) == 1 else None
        self.spines[token] = found
        return found

    def _agree(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens are an encoding: no merge joins parts at their border while both parts are there.
        At one rank the leftmost merge comes first.  An empty first one asks it of the second alone."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > MEMORY:
                self.pairs.clear()
            after, before, get = self._spine(b), self._spine(a) if a else ([], []), self.ranks.get
            known = after is not None and before is not None
            if known:
                for x, x_end in before[1]:
                    for y, y_end in after[0]:
                        rank = get((x, y))
                        if rank is not None and rank < x_end and rank <= y_end:
                            known = False
            self.pairs[a, b] = known
        return known

    def piece(self, text: bytes) -> list[int]:
        """Counts at the byte prefixes 0, 1, ... of one piece."""
        known = self.pieces.get(text)
        if known is not None:
            return known
        tokens, sizes, pairs = self.tokens, self.sizes, self.pairs
        stem = self.stems.get(text[:STEM])
        last, count = (stem[0].copy(), stem[1].copy()) if stem else ([b""], [0])
        for j in range(len(last), len(text) + 1):
            for size in sizes.get(text[j - 3 if j > 3 else 0:j]) or sizes[text[j - 2:j]]:
                if size > j:
                    continue
                t = text[j - size:j]
                if t in tokens:
                    a = last[j - size]
                    ok = pairs.get((a, t))
                    if ok or ok is None and self._agree(a, t):
                        last.append(t)
                        count.append(count[j - size] + 1)
                        break
        if not stem and len(text) >= STEM:
            if len(self.stems) > MEMORY // 2:
                self.stems.clear()
            self.stems[text[:STEM]] = last[:STEM + 1], count[:STEM + 1]
        if len(text) <= LONGEST_KEPT:
            if len(self.pieces) > MEMORY // 2:
                self.pieces.clear()
            self.pieces[text] = count
        return count

    def _plain(self, text: str) -> list[int]:
        """Counts at the character prefixes 1, 2, ... of text without special tokens."""
        out: list[int] = []
        at = before = base = 0
        previous = ""
        for letters, _ in self.split(text):
            raw = self._bytes(letters)
            here = raw.decode("utf-8")
            counts = self.piece(raw)
            if len(raw) == len(here):
                out += [before + c for c in counts[1:]]
            else:
                out += [before + counts[e] for e in accumulate(len(c.encode()) for c in here)]
            # A cut inside the first two characters can join the piece to white space before it, or part a contraction.
            if here[0] == "'" or previous.isspace():
                start = at - len(previous)
                for j in range(at + 1, at + 1 + min(2, len(here))):
                    out[j - 1] = base + sum(self.piece(self._bytes(x))[-1] for x, _ in self.split(text[start:j]))
            base = before
            before += counts[-1]
            at, previous = at + len(here), here
        return out

    def _chunk(self, text: str) -> bytes:
        """Counts at the prefixes of one chunk as int32 bytes."""
        simple = self.simple and self.simple(text)
        if simple:
            line, word, marks = simple.groups()
            raw = word.encode()
            counts = self.piece(raw)[1:]
            if len(raw) != len(word):  # only the ends of characters
                counts = [c for c, after in zip(counts, raw[1:] + b" ") if after & 0xC0 != 0x80]
            if marks:
                counts += [counts[-1] + c for c in self.piece(marks.encode())[1:]]
            if line:
                counts = [1, *(c + 1 for c in counts)]
            return array("i", counts).tobytes()
        out: list[int] = []
        at = base = 0
        for m in self.special.finditer(text) if self.special else ():
            whole = self._plain(text[at:m.end()])  # cut inside the special token: plain text
            out += [base + c for c in whole[:-1]]
            base += (self._plain(text[at:m.start()])[-1] if m.start() > at else 0) + 1
            out.append(base)
            at = m.end()
        if at < len(text):
            out += [base + c for c in self._plain(text[at:])]
        return array("i", out).tobytes()

    def _chunks(self, text: str) -> list[str]:
        found = _CHUNK.findall(text)
        if not _HAS_DOUBT.search(text):
            return found
        joined: list[list[str]] = []
        open_end = False
        for c in found:
            if open_end:
                joined[-1].append(c)
            else:
                joined.append([c])
            open_end = _ENDS_IN_DOUBT.search(c) is not None
        return ["".join(x) for x in joined]

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """For each text its counts at the prefixes of 1, 2, ... code points."""
        if len(self.memory) > MEMORY // 2:  # the chunks of late stay known for a while
            self.earlier, self.memory = self.memory, {}
        memory, earlier = self.memory, self.earlier
        found: list[bytes] = []
        per_text = []
        for text in texts:
            chunks = self._chunks(text)
            per_text.append(len(chunks))
            for c in chunks:
                got = memory.get(c)
                if got is None:
                    got = earlier.get(c) or self._chunk(c)
                    if len(c) <= LONGEST_KEPT:
                        memory[c] = got
                found.append(got)
        flat = np.frombuffer(b"".join(found), dtype="i4")
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        ends = np.cumsum(size)
        total = flat[ends - 1].astype(np.int64)
        before = np.cumsum(total) - total  # tokens before each chunk, over the whole slice
        counts = flat + np.repeat(before, size)
        chunk_end = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)
        char_end = np.concatenate([[0], ends])[chunk_end]
        base = np.concatenate([before, [total.sum()]])[chunk_end[:-1]]
        return [counts[a:b] - x for a, b, x in zip(char_end[:-1], char_end[1:], base, strict=True)]


def counter_of(path: str) -> PrefixCounter:
    """The worker's counter, made once per process: a worker serves many tasks, and what it remembers serves them all.
    It is kept on the tokenizers module, since this one travels by value and is new in each task."""
    import tokenizers
    kept = tokenizers.__dict__.setdefault("_tessera_prefix_counters", {})
    if path not in kept:
        kept[path] = PrefixCounter(path)
    return kept[path]


def _by_size(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts): up to ``most`` bytes, or one longer text."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = done = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(sizes, done + most, "right")))
        yield a, texts.slice(a, b - a).to_pylist()
        a, done = b, int(sizes[b - 1])


def fitting(counts: np.ndarray, limit: int) -> int:
    """The length of the longest prefix of at most ``limit`` tokens (counts can fall by a character more)."""
    at = np.flatnonzero(counts <= limit)
    return int(at[-1]) + 1 if len(at) else 0


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, cut_chars): the count of the whole text and the length in code points of
    its longest prefix of at most ``limit`` tokens, both read off the counts of its prefixes."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    kind = pa.struct([("n_tokens", pa.int64()), ("cut_chars", pa.int64())])

    @F.arrow_udf("struct<n_tokens:long,cut_chars:long>")
    def ask(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = counter_of(path)
        for texts in parts:
            yield pa.array([{"n_tokens": int(c[-1]) if len(c) else 0, "cut_chars": fitting(c, limit)}
                            for _, some in _by_size(texts) for c in counter.batch(some)], kind)

    got = rows.select("doc_id", F.octet_length("t").cast("long").alias("n_bytes"), ask("t").alias("c"))
    return got.select("doc_id", "n_bytes", "c.n_tokens", (F.col("c.n_tokens") > limit).alias("over_limit"), "c.cut_chars")


BLOCKS = "array<struct<start:long,before:long,least:long,counts:array<int>>>"


def prefix_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, n_chars, n_tokens, blocks): the stored counts of every prefix.

    A block covers ``block`` code points from ``start``: ``before`` is the count at ``start``, ``counts`` those behind
    each of its characters less ``before`` (small numbers, which Parquet packs tightly), ``least`` the smallest count.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    item = pa.struct([("start", pa.int64()), ("before", pa.int64()), ("least", pa.int64()), ("counts", pa.list_(pa.int32()))])

    def blocks(c: np.ndarray) -> list[dict]:
        out = []
        for a in range(0, len(c), block):
            part, before = c[a:a + block], int(c[a - 1]) if a else 0
            out.append({"start": a, "before": before, "least": int(part.min()), "counts": (part - before).astype("int32")})
        return out

    def store(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for batch in parts:
            ids, texts = batch.column("doc_id"), batch.column("t")
            for a, some in _by_size(texts):  # small batches out: counts take more room than text
                counts = counter.batch(some)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, len(some)), pa.array(map(len, counts), pa.int64()),
                    pa.array([int(c[-1]) if len(c) else 0 for c in counts], pa.int64()),
                    pa.array(map(blocks, counts), pa.list_(item))], names=["doc_id", "n_chars", "n_tokens", "blocks"])

    return rows.mapInArrow(store, f"doc_id {id_type}, n_chars long, n_tokens long, blocks {BLOCKS}")


def tokens_at(chars: Column, blocks: str = "blocks", block: int = BLOCK) -> Column:
    """The stored count of the first ``chars`` code points; null beyond the text."""
    at = chars.cast("long")
    held = F.try_element_at(F.col(blocks), (F.floor((at - 1) / block) + 1).cast("int"))
    count = held["before"] + F.try_element_at(held["counts"], (F.pmod(at - 1, F.lit(block)) + 1).cast("int"))
    return F.when(at == 0, F.lit(0)).when(at > 0, count).cast("long")


def chars_within(limit: Column, blocks: str = "blocks") -> Column:
    """The longest prefix, in code points, whose stored count is at most ``limit``: the last block that holds such a count is searched."""
    last = F.try_element_at(F.filter(blocks, lambda b: b["least"] <= limit), F.lit(-1))
    ends = F.transform(last["counts"], lambda c, i: F.when(last["before"] + c <= limit, last["start"] + i + 1).otherwise(F.lit(0)))
    return F.coalesce(F.array_max(ends), F.lit(0)).cast("long")
