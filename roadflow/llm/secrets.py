"""Secret scan with DataFrame functions only.

Base kinds are patterns. The method adds strings that look random: for each
character class, a window slides over every candidate string; the counts of
the characters in it change by the one that enters and the one that leaves, and
so does the sum of c * log2(c) from which the Shannon entropy follows. A
candidate with a window over the class's threshold gives a span from its first
such window's start to its last one's end. Candidates on the allow-list, and
those that overlap a base span, are suppressed; base spans always stay.

Defined results: null and empty texts have no spans; repeated rows get equal
results; an empty table gives an empty result; texts of any length are read
whole; other columns pass through, but one named like ``to`` is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPAN, fresh, let, match_spans, ordered, replace_spans, text_of

# The base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = ["assign", "access", "hex"]


class CharClass(NamedTuple):
    kind: str
    candidate: str
    alphabet: str
    threshold: float  # bits a character
    must: tuple[str, ...]  # patterns that a candidate must hold, so that plain words are none


DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
WINDOW = 20
CLASSES = (
    CharClass("entropy_hex", rf"(?<![0-9A-Za-z])[0-9A-Fa-f]{{{WINDOW},}}+(?![0-9A-Za-z])",
              DIGITS + "abcdefABCDEF", 2.9, ("[0-9]", "[A-Fa-f]")),
    CharClass("entropy_base64", rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}+",
              LETTERS + LETTERS.upper() + DIGITS + "+/_=-", 3.8, ("[0-9]", "[A-Z]", "[a-z]")),
)
ALLOW = (
    r"(?i)example|placeholder|changeme|dummy|your[-_]?(api|secret|token)|x{6,}",
    r"(?i)abcdefgh|01234567|12345678",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)^(sha(1|256|384|512)|md5)[-_=]",
)


def base_spans(text: Column) -> Column:
    value = rf"^{ASSIGN}"
    return F.concat(
        match_spans(text, ASSIGN, "assign", lambda m: F.length(F.regexp_extract(m, value, 1)) >= 6),
        match_spans(text, ACCESS, "access"), match_spans(text, HEX, "hex"))


def _weight(count: Column) -> Column:
    """c * log2(c)."""
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def hot_range(candidate: Column, alphabet: str, threshold: float, window: int) -> Column:
    """(first, last) in code points, end exclusive, of the windows over the threshold; last is 0 if there is none."""
    symbols = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(alphabet), c))

    def slide(chars: Column) -> Column:
        zero = F.struct(
            F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"), F.lit(0.0).alias("sum"),
            F.lit(-1).alias("first"), F.lit(0).alias("last"))

        def step(acc: Column, i: Column) -> Column:
            come, gone = F.get(chars, i), F.when(i >= window, F.get(chars, i - window)).otherwise(F.lit(-1))
            more = F.get(acc["counts"], come)
            # The one that leaves is counted after the other has come, in case both are the same character.
            less = F.when(gone >= 0, F.get(acc["counts"], gone) + F.when(gone == come, 1).otherwise(0))
            total = (acc["sum"] + _weight(more + 1) - _weight(more)
                     + F.when(gone >= 0, _weight(less - 1) - _weight(less)).otherwise(F.lit(0.0)))

            def moved(total: Column) -> Column:
                hot = (i >= window - 1) & (F.log2(F.lit(float(window))) - total / window >= threshold - 1e-9)
                return F.struct(
                    F.transform(acc["counts"], lambda n, k: n + F.when(k == come, 1).otherwise(0)
                                - F.when(k == gone, 1).otherwise(0)).alias("counts"),
                    total.alias("sum"),
                    F.when(hot & (acc["first"] < 0), i - window + 1).otherwise(acc["first"]).alias("first"),
                    F.when(hot, i + 1).otherwise(acc["last"]).alias("last"))

            return let(total, moved)

        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), zero, step, lambda acc: F.struct(
            acc["first"].alias("first"), acc["last"].alias("last")))

    return let(symbols, slide)


def entropy_spans(text: Column, classes: Sequence[CharClass] = CLASSES, window: int = WINDOW,
                  allow: Sequence[str] = ALLOW) -> Column:
    """Spans of strings that look random, by class."""
    def of_class(c: CharClass) -> Column:
        def wanted(m: Column) -> Column:
            good = F.lit(True)
            for pattern in c.must:
                good = good & m.rlike(pattern)
            for pattern in allow:
                good = good & ~m.rlike(pattern)
            return good

        def hot(s: Column) -> Column:
            return let(hot_range(s["match"], c.alphabet, c.threshold, window), lambda r: F.struct(
                (s["start"] + r["first"]).alias("start"), (s["start"] + r["last"]).alias("end"),
                s["kind"].alias("kind"), F.when(r["last"] > 0, s["match"]).alias("match")))

        spans = match_spans(text, c.candidate, c.kind, wanted)
        return F.filter(F.transform(spans, hot), lambda s: s["match"].isNotNull()).cast(SPAN)

    return F.concat(*map(of_class, classes))


def scan(docs: DataFrame, text_col: str = "text", to: str = "spans") -> DataFrame:
    """``docs`` with all spans (start, end, kind), sorted by start, in ``to``."""
    text = text_of(text_col)

    def together(base: Column) -> Column:
        def apart(spans: Column) -> Column:
            return F.filter(spans, lambda s: ~F.exists(
                base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

        def added(spans: Column) -> Column:
            # A string may be a candidate of several classes; the first class that finds it reports it.
            return F.filter(spans, lambda s, i: ~F.exists(F.slice(spans, F.lit(1), i), lambda o: (
                o["start"] < s["end"]) & (s["start"] < o["end"])))

        return F.concat(base, let(apart(entropy_spans(text)), added))

    return docs.withColumn(to, ordered(let(base_spans(text), together), [*BASE_KINDS, *(c.kind for c in CLASSES)],
                                       kind_first=False))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by [SECRET]."""
    spans = fresh(docs, "__spans")
    found = scan(docs, text_col, spans)
    text = F.when(F.size(spans) > 0, replace_spans(
        text_of(text_col), F.col(spans), lambda s: F.lit("[SECRET]"))).otherwise(F.col(text_col))
    return found.withColumn(text_col, text).drop(spans)
