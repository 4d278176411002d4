"""Personal data by patterns and information-theoretic sanitisation, with DataFrame functions only.

Base kinds are patterns with checks. The method then asks which words give
such entities away: over all lines of the corpus it counts how often a term
occurs (n_t), how often a line holds an entity of a kind (n_e), and both
(n_te). From these follow

    PMI(t; e) = log2(n_te * N / (n_t * n_e)),   IC(e) = -log2(n_e / N)

and the disclosure PMI / IC, the share of the entity's information that the
term reveals (1: the term never stands without the entity). In lines that hold
an entity, terms over the lower threshold are generalised to the name of what
they hint at, those over the upper one are removed. A term needs ``SUPPORT``
joint lines, as smaller counts estimate nothing.

Defined results: null and empty texts have no spans and count no lines with
entities; repeated rows count as often as they occur and get equal results; an
empty table has no terms; other columns are ignored and not returned; texts of
any length are read whole; of overlapping spans a replacement takes the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (SPAN, broadcast_if_small, content_key, let, match_spans, materialise, offsets, ordered,
                     replace_spans, text_of)

KINDS = ["email", "ip", "card", "phone"]
TERM_KINDS = ["term", "term_removed"]
# The base patterns. Loops are possessive and starts are tied to the left edge of a run where
# that matches the same strings: no deep recursion and no quadratic scan on very long runs.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"
WORD = r"\p{L}{3,}+"
GENERALISE, REMOVE, SUPPORT = 0.6, 0.9, 3


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a digit string is right."""
    def part(d: Column, i: Column) -> Column:
        n = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(n > 9, n - 9).otherwise(n)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), part), F.lit(0), lambda a, n: a + n) % 10 == 0


def base_spans(text: Column) -> Column:
    def card(m: Column) -> Column:
        return let(_digits(m), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False)))

    return F.concat(
        match_spans(text, EMAIL, "email", may=F.contains(text, F.lit("@"))),
        match_spans(text, IP, "ip", lambda m: F.forall(F.split(m, r"\."), lambda p: p.rlike(IP_PART))),
        match_spans(text, CARD, "card", card),
        match_spans(text, PHONE, "phone", lambda m: F.length(_digits(m)).between(9, 15),
                    may=F.contains(text, F.lit("+"))))


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, key, text, base (spans) for each row of ``docs``."""
    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).select(
        "id", content_key(F.col("text")).alias("key"), "text",
        ordered(base_spans(F.col("text")), KINDS, kind_first=False).alias("base"))


def lines_of(found: DataFrame, only_hit: bool = False) -> DataFrame:
    """id, key, line, start (of the line, in code points) and a flag for each kind of entity in it.

    Entities are blanked out (by as many spaces), so their parts are no terms.
    """
    rows = found.filter(F.size("base") > 0) if only_hit else found
    # Overlapping entities: what the first leaves uncovered stays, which blanks too little but moves nothing.
    blank = replace_spans(F.col("text"), F.col("base"), lambda s: F.repeat(F.lit(" "), (s["end"] - s["start"]).cast("int")))
    cut = rows.select("id", "key", "base", F.split(blank, "\n", -1).alias("lines"))
    starts = offsets(F.transform("lines", lambda x: F.length(x).cast("long") + 1))
    each = cut.select("id", "key", "base", F.explode(F.arrays_zip("lines", starts.alias("starts"))).alias("x")).select(
        "id", "key", "base", F.col("x.lines").alias("line"), F.col("x.starts").alias("start"))
    end = F.col("start") + F.length("line")

    def holds(kind: str) -> Column:
        return (F.size("base") > 0) & F.exists("base", lambda s: (s["kind"] == kind) & (s["start"] >= F.col("start"))
                                               & (s["start"] < end))

    out = each.select("id", "key", "line", "start", *[holds(k).alias(k) for k in KINDS])
    return out.filter(" OR ".join(KINDS)) if only_hit else out


def disclosure(found: DataFrame, lower: float = GENERALISE, support: int = SUPPORT) -> DataFrame:
    """term, hint (the kind it reveals most), share (its disclosure) of terms from the lower threshold on."""
    lines = lines_of(found)
    # One pass: the empty term stands in every line and so counts the lines.
    terms = F.array_append(F.array_distinct(F.regexp_extract_all(F.lower("line"), F.lit(WORD), F.lit(0))), F.lit(""))
    counts = materialise(lines.select(*KINDS, F.explode(terms).alias("term")).groupBy("term").agg(
        F.count("*").alias("n"), *[F.sum(F.col(k).cast("long")).alias(k) for k in KINDS]).filter(
        (F.greatest(*KINDS) >= support) | (F.col("term") == "")), "terms")
    total = counts.filter("term = ''").first()
    if total is None:
        return counts.select("term", F.lit("").alias("hint"), F.lit(0.0).alias("share")).limit(0)

    def share(kind: str) -> Column:
        n_e = total[kind]
        if not 0 < n_e < total["n"]:
            return F.lit(0.0)  # an entity in every line or in none has no information to reveal
        pmi = F.log2(F.col(kind) * F.lit(float(total["n"])) / (F.col("n") * F.lit(float(n_e))))
        information = F.log2(F.lit(float(total["n"]) / n_e))
        return F.when(F.col(kind) >= support, pmi / information).otherwise(F.lit(0.0))

    best = F.array_max(F.array(*[F.struct(share(k).alias("share"), F.lit(k).alias("hint")) for k in KINDS]))
    return counts.filter("term <> ''").select("term", best.alias("b")).select(
        "term", "b.hint", "b.share").filter(F.col("share") >= lower - 1e-9)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lower: float = GENERALISE,
         upper: float = REMOVE, support: int = SUPPORT) -> DataFrame:
    """id, key, text, spans (by kind, then start; entities and revealing terms) for each row of ``docs``.

    A term's span stands in a line that holds the kind of entity it reveals.
    """
    found = found_spans(docs, id_col, text_col)
    terms = materialise(disclosure(found, lower, support), "disclosing")
    words = lines_of(found, only_hit=True)
    place = F.explode(match_spans(F.col("line"), WORD, "term")).alias("w")
    words = words.select("id", "key", "start", *KINDS, place).select(
        "id", "key", *KINDS, F.lower("w.match").alias("term"), (F.col("start") + F.col("w.start")).alias("start"),
        (F.col("start") + F.col("w.end")).alias("end"))
    small = broadcast_if_small(terms, terms.count(), 100)
    hinted = F.coalesce(*[F.when(F.col("hint") == k, F.col(k)) for k in KINDS])
    kind = F.when(F.col("share") >= upper - 1e-9, "term_removed").otherwise("term")
    hits = words.join(small, "term").filter(hinted).groupBy(
        F.col("id").alias("hit_id"), F.col("key").alias("hit_key")).agg(F.collect_set(F.struct(
            "start", "end", kind.alias("kind"), F.col("hint").alias("match"))).alias("terms"))
    spans = F.concat("base", F.transform(F.coalesce("terms", F.array().cast(SPAN)), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    joined = found.join(hits, found["id"].eqNullSafe(hits["hit_id"]) & (found["key"] == hits["hit_key"]), "left")
    return joined.select("id", "key", "text", "base", ordered(spans, KINDS + TERM_KINDS, kind_first=True).alias("spans"),
                         F.coalesce("terms", F.array().cast(SPAN)).alias("terms"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and text, entities replaced by their kind, terms generalised ([email term]) or removed."""
    rows = scan(docs, id_col, text_col)
    marked = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                               F.concat(F.lit("["), s["kind"], F.lit("]")).alias("label"))),
        F.transform("terms", lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.when(s["kind"] == "term_removed", "").otherwise(
                F.concat(F.lit("["), s["match"], F.lit(" term]"))).alias("label")))))
    return rows.select(F.col("id").alias(id_col),
                       let(marked, lambda m: replace_spans(F.col("text"), m, lambda s: s["label"])).alias(text_col))
