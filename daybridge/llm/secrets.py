"""Secret scan: patterns, and sliding-window Shannon entropy per character class.

Base kinds are patterns. Beyond them, every maximal run of the characters of a class (``CLASSES``)
that is long enough is a candidate: a window slides over it while the counts of its characters are
kept up to date, one character in and one out, and with them the sum of n log2 n that the entropy
follows from. Overlapping windows that reach the entropy of the class make a span, from the first to
the last of them, unless the span matches the allow-list or overlaps a base span. Lower-case path
parts and runs of equal characters end a candidate, so that a secret beside them is a candidate of its own.

DataFrame functions alone, nothing is shuffled. Positions are in code points, ends exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.columns import indices, let

# The base patterns, with the least length of the match or of its second group.
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6


@dataclass(frozen=True)
class CharClass:
    """A class of candidates: its alphabet, the least length, the window and the least entropy in bits.

    ``needs`` are patterns that a candidate must all hold.
    """

    kind: str
    alphabet: str
    members: str
    window: int
    bits: float
    needs: tuple[str, ...] = ()


# Character classes; thresholds lie between those of text and of random strings. The last
# three do not ask for three kinds of characters, but for entropies that words do not reach.
CLASSES = (
    CharClass("upper_hex", "0-9A-F", "0123456789ABCDEF", 24, 2.9, ("[0-9]", "[A-F]")),
    CharClass(
        "base64",
        "A-Za-z0-9+/_-",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
        20,
        3.75,
        ("[0-9]", "[a-z]", "[A-Z]"),
    ),
    CharClass("lower_alnum", "a-z0-9", "abcdefghijklmnopqrstuvwxyz0123456789", 20, 3.6, ("[0-9][a-z]+[0-9]|[a-z][0-9]+[a-z]",)),
    CharClass("base32", "A-Z2-7", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16, 3.1, ("[2-7]",)),
    CharClass("letters", "A-Za-z", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 24, 4.15),
)
# Spans that are known not to be secrets; and what ends a candidate: a lower-case path part
# up to its slash, and all but the last seven of eight or more equal characters.
ALLOW_LIST = (r"(?i)example|sample|placeholder|changeme",)
PATH_PART = r"(?<![A-Za-z0-9+_-])([a-z]+)/"
EQUAL_SIGNS, EQUAL_RUN = "A-Za-z0-9+/_-", 8
EQUAL = rf"([{EQUAL_SIGNS}])(?=\1{{{EQUAL_RUN - 1}}})"
SPAN = "struct<start:int,rank:int,end:int,kind:string>"
EMPTY = f"array<{SPAN}>"


def _spans(text: Column, pattern: str, kind: str, rank: int, keep=None) -> Column:
    """Spans of all matches that pass ``keep``. A match starts after the gaps and matches before it."""

    def located(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,m:string>>").alias("out"))

        def step(a: Column, x: Column) -> Column:
            begin = a["at"] + F.length(x["gap"])
            one = F.array(F.struct(begin.alias("s"), x["match"].alias("m")))
            return F.struct((begin + F.length(x["match"])).alias("at"), F.concat(a["out"], one).alias("out"))

        pieces = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
        placed = F.aggregate(pieces, start, step, lambda a: a["out"])
        if keep is not None:
            placed = F.filter(placed, lambda x: keep(x["m"]))
        return F.transform(
            placed,
            lambda x: F.struct(
                x["s"].alias("start"),
                F.lit(rank).alias("rank"),
                (x["s"] + F.length(x["m"])).alias("end"),
                F.lit(kind).alias("kind"),
            ),
        ).cast(EMPTY)

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(matches, lambda found: F.when(F.size(found) > 0, located(found)).otherwise(F.array().cast(EMPTY)))


def _nlogn(n: int) -> int:
    return round(n * math.log2(n) * (1 << 20)) if n else 0


def entropy_groups(candidate: Column, c: CharClass) -> Column:
    """Array of struct(first, last): starts of the first and last of each group of overlapping windows of the class's entropy.

    H = log2 W - sum(n log2 n) / W, so a window qualifies if its sum of n log2 n, kept in whole
    multiples of 2^-20, is at most W (log2 W - bits).
    """
    limit = math.floor(c.window * (math.log2(c.window) - c.bits) * (1 << 20))
    table = F.split(F.lit(",".join(str(_nlogn(n)) for n in range(c.window + 2))), ",").cast("array<bigint>")
    groups = "array<struct<first:int,last:int>>"
    begin = F.struct(
        F.array_repeat(F.lit(0), len(c.members) + 1).alias("n"),
        F.lit(0).cast("bigint").alias("sum"),
        F.array().cast(groups).alias("out"),
    )
    code = lambda at: F.position(F.substring(candidate, at + 1, F.lit(1)), F.lit(c.members))

    def moved(v: Column, at: Column, by: int) -> Column:
        counted = F.struct(v["n"].alias("n"), v["sum"].alias("sum"), code(at).alias("c"))
        return let(
            counted,
            lambda u: F.struct(
                F.transform(u["n"], lambda x, k: F.when(k == u["c"], x + by).otherwise(x)).alias("n"),
                (u["sum"] + F.get(table, F.get(u["n"], u["c"]) + by) - F.get(table, F.get(u["n"], u["c"]))).alias("sum"),
            ),
        )

    def grown(out: Column, at: Column) -> Column:
        one = lambda first: F.array(F.struct(first.alias("first"), at.alias("last"))).cast(groups)
        joins = (F.size(out) > 0) & (at - F.get(out, F.size(out) - 1)["last"] < c.window)
        longer = F.concat(F.slice(out, 1, F.size(out) - 1), one(F.get(out, F.size(out) - 1)["first"]))
        return F.when(joins, longer).otherwise(F.concat(out, one(at)))

    def step(a: Column, i: Column) -> Column:
        at = i - (c.window - 1)
        full = let(moved(a, i, 1), lambda v: F.when(i >= c.window, moved(v, i - c.window, -1)).otherwise(v))
        return let(
            full,
            lambda v: F.struct(
                v["n"].alias("n"),
                v["sum"].alias("sum"),
                F.when((at >= 0) & (v["sum"] <= limit), grown(a["out"], at)).otherwise(a["out"]).alias("out"),
            ),
        )

    return F.aggregate(indices(0, F.length(candidate) - 1), begin, step, lambda a: a["out"])


def _entropy_spans(text: Column, c: CharClass, rank: int, allow: tuple[str, ...]) -> Column:
    """Spans of the groups of windows of all candidates of a masked text, each held against the allow-list by itself."""
    pattern = rf"(?<![{c.alphabet}])[{c.alphabet}]{{{c.window},}}"

    def wanted(m: Column) -> Column:
        ok = F.lit(True)
        for need in c.needs:
            ok = ok & m.rlike(need)
        return ok

    def of_run(x: Column) -> Column:
        found = let(F.substring(text, x["start"] + 1, x["end"] - x["start"]), lambda m: entropy_groups(m, c))
        return F.transform(
            found,
            lambda g: F.struct(
                (x["start"] + g["first"]).alias("start"),
                x["rank"].alias("rank"),
                (x["start"] + g["last"] + c.window).alias("end"),
                x["kind"].alias("kind"),
            ),
        ).cast(EMPTY)

    def allowed(x: Column) -> Column:
        m = F.substring(text, x["start"] + 1, x["end"] - x["start"])
        ok = wanted(m)
        for known in allow:
            ok = ok & ~m.rlike(known)
        return ok

    runs = _spans(text, pattern, c.kind, rank, wanted)
    return F.filter(let(runs, lambda found: F.flatten(F.transform(found, of_run))), allowed)


def entropy_spans(text: Column, allow: tuple[str, ...]) -> Column:
    """Spans of all classes. What ends a candidate is masked by a blank, so that positions stay."""
    masked = F.regexp_replace(F.regexp_replace(text, PATH_PART, "$1 "), EQUAL, " ")
    return let(
        masked, lambda m: F.sort_array(F.concat(*(_entropy_spans(m, c, 3 + i, allow) for i, c in enumerate(CLASSES))))
    )


def secret_spans(text: Column, allow: tuple[str, ...] = ALLOW_LIST) -> tuple[Column, Column]:
    """Base spans and entropy spans of a non-null text column, each sorted by start, then kind as listed."""
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_VALUE
    base = F.concat(
        _spans(text, ASSIGN, "assign", 0, value), _spans(text, ACCESS, "access", 1), _spans(text, HEX, "hex", 2)
    )
    return F.sort_array(base), entropy_spans(text, allow)


def find_secrets(
    docs: DataFrame, allow: tuple[str, ...] = ALLOW_LIST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, base and added: arrays of spans (start, rank, end, kind) in every row's whole text.

    A null or empty text has no spans. One row per input row, whether ids repeat or are null; other
    columns are ignored. An added span that overlaps a base span or an earlier added span is left out.
    """
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    base, found = secret_spans(F.col("text"), allow)
    both = texts.select("doc_id", base.alias("base"), found.alias("found"))
    return both.select("doc_id", "base", _apart(F.col("found"), F.col("base")).alias("added"))


def _apart(found: Column, base: Column) -> Column:
    def clear(of: Column, x: Column) -> Column:
        return ~F.exists(of, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))

    return F.aggregate(
        found,
        F.array().cast(EMPTY),
        lambda a, x: F.when(clear(base, x) & clear(a, x), F.concat(a, F.array(x))).otherwise(a),
    )


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined in the spans' order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact_secrets(
    docs: DataFrame,
    mark: str = "[SECRET]",
    allow: tuple[str, ...] = ALLOW_LIST,
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, with every span (overlapping ones merged) replaced by ``mark``.

    A null text stays null. Rows are treated one by one, repeated or not; an empty table stays empty.
    """
    text = F.col(text_col)

    def replaced(t: Column) -> Column:
        base, added = secret_spans(t, allow)
        spans = F.sort_array(F.concat(base, added))
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def step(a: Column, s: Column) -> Column:
            gap = F.substring(t, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
            fresh = F.when(s["start"] >= a["at"], F.concat(a["out"], gap, F.lit(mark))).otherwise(a["out"])
            return F.struct(F.greatest(a["at"], s["end"]).alias("at"), fresh.alias("out"))

        rebuilt = lambda x: F.aggregate(
            x, start, step, lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.length(t)))
        )
        return let(spans, lambda x: F.when(F.size(x) > 0, rebuilt(x)).otherwise(t))

    return docs.withColumn(text_col, F.when(text.isNotNull(), let(text.cast("string"), replaced)))
