"""Secret scans over a trigram inverted index.

Each rule is a regular expression.  :func:`trigram_query` derives from it a
Boolean query in disjunctive form: a text can only match if, for some
alternative, it holds all trigrams of that alternative.  Postings (trigram,
document) are built for the trigrams that the rules ask for, intersected per
document, and only candidates are read again and verified with the regular
expression.  A rule from which no mandatory trigram follows is run on every text.

Only DataFrame functions are used.  Index and candidates hold no text.

Defined cases: a null text is read as empty; a null ``doc_id`` is a value like
any other; repeated rows give repeated result rows; an empty table gives an
empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _parser as regex_tree

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of


@dataclass(frozen=True)
class Rule:
    """``group`` (0: the whole match) must have at least ``least`` characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
EXTRA_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
)
RULES = BASE_RULES + EXTRA_RULES

# A set of at most this many characters is spelled out; more alternatives
# than MOST_ALTERNATIVES count as a gap (the rule then asks for fewer trigrams,
# at worst for none, and scans fully).
MOST_CHARS, MOST_ALTERNATIVES = 8, 64
_GAP = None


def _joined(a: list, b: list) -> list:
    """Two part lists (literal strings and gaps) one after the other."""
    if a and b and isinstance(a[-1], str) and isinstance(b[0], str):
        return [*a[:-1], a[-1] + b[0], *b[1:]]
    return [*a, *b]


def _alternatives(tree) -> list[list]:
    """All spellings of a parsed expression as part lists."""
    found: list[list] = [[""]]
    for op, arg in tree:
        kind = str(op)
        if kind == "LITERAL":
            more = [[chr(arg).lower()]]
        elif kind == "IN":
            chars: set[str] | None = set()
            for o, x in arg:
                if str(o) == "LITERAL":
                    chars.add(chr(x).lower())
                elif str(o) == "RANGE" and x[1] - x[0] < MOST_CHARS:
                    chars |= {chr(i).lower() for i in range(x[0], x[1] + 1)}
                else:
                    chars = None
                    break
            more = [[c] for c in sorted(chars)] if chars and len(chars) <= MOST_CHARS else [[_GAP]]
        elif kind == "SUBPATTERN":
            more = _alternatives(arg[-1])
        elif kind == "BRANCH":
            more = [x for branch in arg[1] for x in _alternatives(branch)]
        elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = arg
            once = _alternatives(inner)
            if low == 0:
                more = [[""], *once] if high == 1 else [[_GAP]]
            else:
                more = once if high == 1 else [_joined(x, [_GAP]) for x in once]
        elif kind == "AT":
            more = [[""]]
        else:
            more = [[_GAP]]
        if len(found) * len(more) > MOST_ALTERNATIVES:
            more = [[_GAP]]
        found = [_joined(a, b) for a in found for b in more]
    return found


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each a set of lower-cased trigrams that must all occur;
    None if some spelling has no mandatory trigram."""
    sets = [frozenset(part[i:i + 3] for part in parts if part for i in range(len(part) - 2))
            for parts in _alternatives(regex_tree.parse(pattern))]
    if not all(sets):
        return None
    return [s for s in dict.fromkeys(sets) if not any(other < s for other in sets)]  # a larger set adds nothing


def postings(rows: DataFrame, keys: list[str], text: str, grams: list[str]) -> DataFrame:
    """Inverted index (gram, keys) over lower-cased texts, for the trigrams asked for."""
    low = F.lower(F.col(text))
    hit = F.array_compact(F.array(*[F.when(F.contains(F.col("_low"), F.lit(g)), F.lit(g)) for g in grams]))
    return (rows.select(*keys, low.alias("_low"))
            .select(*keys, F.explode(hit).alias("gram")))


def candidates(index: DataFrame, keys: list[str], queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """Intersect postings: the rows that satisfy at least one rule's query, with the kinds to verify."""
    held = index.groupBy(*keys).agg(F.collect_set("gram").alias("_grams"))

    def satisfied(sets) -> Column:
        each = [F.size(F.array_except(F.array(*map(F.lit, sorted(s))), F.col("_grams"))) == 0 for s in sets]
        return reduce(lambda a, b: a | b, each)

    kinds = F.array_compact(F.array(*[F.when(satisfied(q), F.lit(k)) for k, q in queries.items()]))
    return held.select(*keys, kinds.alias("_kinds")).where(F.size("_kinds") > 0)


_SPANS = "array<struct<s:int,k:int,e:int,kind:string>>"


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Leftmost non-overlapping matches, too short ones dropped, as (start, order, end, kind)
    in code points.  The pieces between matches give the positions."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    pieces = F.split(text, rule.pattern, -1)
    met = F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("p"), found.alias("m"), judged.alias("g"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(acc, x):
        start = acc["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        one = F.array(F.struct(start.alias("s"), F.lit(order).alias("k"), end.alias("e"), F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"),
                        F.when(F.length(x["g"]) >= rule.least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    got = F.aggregate(met, zero, step)["out"]
    return F.when(text.rlike(rule.pattern), got).otherwise(F.array().cast(_SPANS))


def _full_scan_form(rule: Rule) -> Rule:
    """``[class]+`` with a least length n is the same as ``[class]{n,}``: its matches are whole runs."""
    tree = list(regex_tree.parse(rule.pattern))
    if rule.group == 0 and rule.pattern.endswith("]+") and len(tree) == 1 and str(tree[0][0]) == "MAX_REPEAT":
        return Rule(rule.kind, f"{rule.pattern[:-1]}{{{rule.least},}}", 0, rule.least)
    return rule


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``spans``, an array of (s, k, e, kind) ordered by start, then rule."""
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t")).withColumn("_h", F.xxhash64("_t"))
    keys = ["_id", "_h"]
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not None}
    grams = sorted({g for q in indexed.values() for s in q for g in s})
    whole = [(i, r) for i, r in enumerate(rules) if r.kind not in indexed]
    part = [(i, r) for i, r in enumerate(rules) if r.kind in indexed]
    none = F.array().cast(_SPANS)
    scanned = rows.select(*keys, F.concat(none, *[spans(F.col("_t"), _full_scan_form(r), i) for i, r in whole]).alias("_full"))
    if not part:
        return scanned.select(F.col("_id").alias(id_col), F.sort_array("_full").alias("spans"))
    cand = candidates(postings(rows, keys, "_t", grams), keys, indexed).toDF("_cid", "_ch", "_kinds")
    verified = (rows.join(cand, (F.col("_h") == F.col("_ch")) & F.col("_id").eqNullSafe(F.col("_cid")))
                .select(F.col("_cid"), F.col("_ch"), F.concat(none, *[
                    F.when(F.array_contains("_kinds", r.kind), spans(F.col("_t"), r, i)).otherwise(none) for i, r in part]).alias("_some"))
                .where(F.size("_some") > 0)
                .groupBy("_cid", "_ch").agg(F.first("_some").alias("_some")))  # repeated rows: once
    out = scanned.join(verified, (F.col("_h") == F.col("_ch")) & F.col("_id").eqNullSafe(F.col("_cid")), "left")
    return out.select(F.col("_id").alias(id_col),
                      F.sort_array(F.concat(F.col("_full"), F.coalesce(F.col("_some"), none))).alias("spans"))


def _is(value: str):
    return lambda x: x == F.lit(value)


def digest(found: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans as text."""
    def joined(c: Column) -> Column:
        return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")

    kinds = [r.kind for r in base]
    base_spans = F.filter("spans", lambda x: x["kind"].isin(kinds))
    counts = [F.size(F.filter(F.transform("spans", lambda x: x["kind"]), _is(k))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(joined(base_spans), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
