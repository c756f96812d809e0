"""Licence scan by ordered signature rules, in DataFrame functions only.

1. Every text is counted: ``n_words``.
2. A prefilter lets through texts with a word that some rule needs (``GATE``); the rest have no labels.
3. The rules (``license_rules``) are a table of a few hundred rows. A text takes the rules whose keyword it holds, and the pattern of each gives
   intervals of the normalised text.
4. An interval inside another one of stronger rank, or inside a longer one of the same rank, is suppressed: a bare name
   within a versioned name, a name within a grant. The rest give the labels; the score is the weight of the best of them.
5. Base phrases are found word by word, and are never suppressed.

All steps belong to a row, so nothing is shuffled and no key can be hot. Suppression sorts the intervals of a text and walks over them once, so a
text costs in proportion to its length, however many of them it holds.

Nulls and edges: a null or empty text has no words, no labels and score 0. Repeated rows are scanned one by one. Columns other than the text pass unread;
``scanned`` adds one struct column.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import LOWER, UPPER
from carelake.llm.license_rules import Rule, rules

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
BASE_WEIGHT = 0.8
RANKS = max(r.rank for r in rules())
CHUNK = 64  # items whose results share a list

# At least one of these stands, lower-cased, in every text that a rule or a base phrase can match.
GATE = (
    "licen", "gpl", "attribution", "bsd", "wtfpl", "perl", "odbl", "pddl", "cc0", "cecill", "commons", "cc", "mozilla",
    "eclipse", "sil", "boost", "permission", "redistribut", "contributors", "advertising", "warranty", "unencumbered",
    "copyright", "copies", "reserved", "domain", "confidential", "prohibited", "commercial", "fair",
)
MARK = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
MARKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def word_count(text: Column) -> Column:
    """Pieces between runs of marks, without the empty ones that a mark at either end leaves."""
    ends = F.substring(text, 1, 1).rlike(MARK).cast("long") + F.substring(text, -1, 1).rlike(MARK).cast("long")
    return F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, f"{MARK}+")) - ends).cast("long")


def normalised(text: Column) -> Column:
    """Lower-case words with one blank between them and around."""
    words = F.regexp_replace(F.translate(text, UPPER, LOWER), MARKS, " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def gated(lowered: Column) -> Column:
    """Whether a gate word stands in the lower-cased text."""
    return reduce(or_, (F.contains(lowered, F.lit(word)) for word in GATE))


def rule_table(found: list[Rule]) -> Column:
    """The rules as one constant array, by keyword."""
    by_keyword: dict[str, list[dict]] = {}
    for r in found:
        own = {"rank": r.rank, "label": r.label, "pattern": f"(?<= )(?:{r.pattern})(?= )", "weight": r.weight}
        by_keyword.setdefault(r.keyword, []).append(own)
    rows = [{"keyword": keyword, "rules": own} for keyword, own in by_keyword.items()]
    rule = "struct<rank:int,label:string,pattern:string,weight:double>"
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<keyword:string,rules:array<{rule}>>>")


def matched(text: Column, held: Column) -> Column:
    """The rules that match, each with its matches."""
    tried = F.transform(
        held, lambda r: F.struct(r.alias("rule"), F.regexp_extract_all(text, r["pattern"], F.lit(0)).alias("matches"))
    )
    return F.filter(tried, lambda h: F.size(h["matches"]) > 0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def walked(items: Column, start: Column, carry: Callable[[Column, Column], Column], out: Callable[[Column, Column], Column], kind: str) -> Column:
    """What ``out`` gives for each item and the state before it (an array of none or one), in one list.

    A list in the state of ``aggregate`` is copied at every step. So the state without a list goes over the items first and is kept for each
    chunk of CHUNK items; then each chunk makes its own short list, and the cost grows with the number of items, not its square.
    """
    none = F.array().cast(f"array<{kind}>")

    def lists(all_items: Column) -> Column:
        last = ((F.size(all_items) - 1) / CHUNK).cast("int")
        return let(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_items, i * CHUNK + 1, F.lit(CHUNK))), by_chunk)

    def by_chunk(chunks: Column) -> Column:
        kept = F.slice(F.array(start), 1, 0)
        starts = F.aggregate(
            chunks, F.struct(start.alias("now"), kept.alias("all")),
            lambda s, chunk: F.struct(F.aggregate(chunk, s["now"], carry).alias("now"), F.concat(s["all"], F.array(s["now"])).alias("all")),
            lambda s: s["all"],
        )
        return F.flatten(F.zip_with(chunks, starts, lambda chunk, first: F.aggregate(
            chunk, F.struct(first.alias("now"), none.alias("out")),
            lambda s, x: F.struct(carry(s["now"], x).alias("now"), F.concat(s["out"], out(s["now"], x)).alias("out")),
            lambda s: s["out"],
        )))

    return let(items, lambda x: F.when(F.size(x) > 0, lists(x)).otherwise(none))


def intervals(text: Column, hit: Column) -> Column:
    """Where a rule matches: the matches, and what stands between them, add up to the places."""
    rule = hit["rule"]
    gaps = F.transform(F.split(text, rule["pattern"], -1), lambda x: F.length(x))
    sizes = F.transform(hit["matches"], lambda m: F.length(m))
    parts = F.zip_with(F.slice(gaps, 1, F.size(hit["matches"])), sizes, lambda gap, size: F.struct(gap.alias("gap"), size.alias("size")))
    places = walked(
        parts, F.lit(0), lambda at, part: at + part["gap"] + part["size"],
        lambda at, part: F.array(F.struct((at + part["gap"]).alias("lo"), (at + part["gap"] + part["size"]).alias("hi"))),
        "struct<lo:int,hi:int>",
    )
    return F.transform(places, lambda p: F.struct(
        p["lo"].alias("lo"), p["hi"].alias("hi"), rule["rank"].alias("rank"),
        rule["label"].alias("label"), rule["weight"].alias("weight"),
    ))


def unsuppressed(found: Column) -> Column:
    """The intervals that none of stronger rank, and no longer one of their own rank, contains.

    By start, the longer first and the stronger first among equals, whatever contains an interval comes before it. So one walk does it, which
    carries for each rank the furthest end so far and the earliest start that reached it.
    """
    order = F.array_sort(F.transform(found, lambda x: F.struct(
        x["lo"].alias("lo"), (-x["hi"]).alias("back"), x["rank"].alias("rank"), x["label"].alias("label"), x["weight"].alias("weight"),
    )))
    kind = "struct<lo:int,hi:int,rank:int,label:string,weight:double>"
    nothing = F.struct(F.lit(-1).alias("hi"), F.lit(-1).alias("lo"))

    def carry(ends: Column, x: Column) -> Column:
        here = F.struct((-x["back"]).alias("hi"), x["lo"].alias("lo"))
        return F.transform(ends, lambda e, i: F.when((i == x["rank"]) & (-x["back"] > e["hi"]), here).otherwise(e))

    def out(ends: Column, x: Column) -> Column:
        low, high, own = x["lo"], -x["back"], ends[x["rank"]]
        stronger = F.exists(F.slice(ends, 1, x["rank"]), lambda e: e["hi"] >= high)
        longer = (own["hi"] > high) | ((own["hi"] == high) & (own["lo"] < low))
        value = F.struct(low.alias("lo"), high.alias("hi"), x["rank"].alias("rank"), x["label"].alias("label"), x["weight"].alias("weight"))
        return F.when(stronger | longer, F.array().cast(f"array<{kind}>")).otherwise(F.array(value))

    return walked(order, F.array_repeat(nothing, RANKS + 1), carry, out, kind)


def places(words: Column, phrase: str) -> Column:
    """Word places, from 0, at which the phrase begins. Each word stands beside those that follow it, so a place is one comparison."""
    parts = phrase.split(" ")
    beside = F.arrays_zip(*(F.slice(words, k + 1, F.size(words)).alias(f"w{k}") for k in range(len(parts))))

    def here(x: Column, i: Column) -> Column:
        return F.when(reduce(and_, (x[f"w{k}"] == part for k, part in enumerate(parts))), i)

    return F.filter(F.transform(beside, here), lambda x: x.isNotNull())


def base_places(norm: Column, words: Column, phrase: str, label: str) -> Column:
    """The phrase's places with its label."""
    none = F.array().cast("array<struct<label:string,place:bigint>>")
    marked = F.transform(
        places(words, phrase), lambda i: F.struct(F.lit(label).alias("label"), i.cast("long").alias("place"))
    )
    return F.when(F.contains(norm, F.lit(f" {phrase} ")), marked).otherwise(none)


def scanned(docs: DataFrame, text: str = "text", name: str = "licenses") -> DataFrame:
    """``docs`` with a struct ``name``: n_words, base (label and place), detections (lo, hi, rank, label, weight), base_labels, labels, score."""
    given = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != name)).alias("row")
    whole = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    rows = docs.select(given).select("row", whole.alias("whole"), F.lower(whole).alias("lowered"))
    whole = F.col("whole")
    rows = rows.select(
        "row", word_count(whole).alias("n_words"),
        F.when(gated(F.col("lowered")), normalised(whole)).alias("norm"),
    )
    norm = F.col("norm")
    groups = F.filter(rule_table(rules()), lambda g: F.contains(norm, g["keyword"]))
    held = F.flatten(F.transform(groups, lambda g: g["rules"]))
    rows = rows.withColumn("found", F.when(
        norm.isNotNull(), F.flatten(F.transform(matched(norm, held), lambda h: intervals(norm, h)))
    ))
    words = F.split(F.trim(norm), " ")
    parts = [base_places(norm, words, phrase, label) for phrase, label in BASE.items()]
    rows = rows.withColumn("base", F.when(F.contains(norm, F.lit(" license ")), F.concat(*parts)))
    kept = F.when(F.size("found") > 0, unsuppressed(F.col("found")))
    rows = rows.withColumn("detections", F.coalesce(kept, F.array().cast("array<struct<lo:int,hi:int,rank:int,label:string,weight:double>>")))
    rows = rows.withColumn("base", F.coalesce("base", F.array().cast("array<struct<label:string,place:bigint>>")))
    base_labels = F.array_sort(F.array_distinct(F.col("base.label")))
    labels = F.array_sort(F.array_union(F.col("base.label"), F.col("detections.label")))
    score = F.greatest(
        F.coalesce(F.array_max(F.col("detections.weight")), F.lit(0.0)),
        F.when(F.size("base") > 0, F.lit(BASE_WEIGHT)).otherwise(F.lit(0.0)),
    )
    return rows.select("row.*", F.struct(
        "n_words", "base", "detections", base_labels.alias("base_labels"), labels.alias("labels"), score.alias("score")
    ).alias(name))
