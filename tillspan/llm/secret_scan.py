"""Operator 4: secrets in texts, by shape and by sliding-window entropy. Only DataFrame functions.

Three shapes are searched directly (assign, access, hex). Beyond them every long run of key-like characters is a
candidate. A candidate has a character class, the smallest of hex, alnum (base 62) and base64 that holds all of it.
A window slides over it; the counts of the class's characters follow by one that enters and one that leaves, and
with them the Shannon entropy of the window. A candidate whose best window exceeds the threshold of its class is
reported as `entropy`, unless the allow list knows it (digests that are named as such, UUIDs, published example keys,
runs that shapes have reported already).

Positions count code points from 0, the end is exclusive. Defined results: NULL is an empty text; a text without
matches has empty spans; matches of one kind never overlap; spans are ordered by start, then by kind. Rows are
independent of each other, so repeated rows give repeated results.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The shapes of the contract and their order.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
ALPHABETS = {
    "hex": "0123456789abcdef",
    "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-",
}
# Bits per character a window has to exceed. Entropies of windows are far from these values, so sums of doubles decide.
THRESHOLDS = {"hex": 2.99, "alnum": 3.73, "base64": 3.83}
# A candidate has letters and digits; words and numbers have but one of them.
MIXED = r"^(?=.*[0-9])(?=.*[A-Za-z])"
ALLOWED = [
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # a UUID
    r"(?i)^(sha(1|224|256|384|512)|md5)[-_=]",  # a digest that says so
    r"(?i)example",  # keys published as examples
]


def _spans(text: Column, pattern: str, keep, kind: int) -> Column:
    """Spans of all leftmost, non-overlapping matches that `keep` accepts, as an array of (start, kind, end, found).

    What lies between the matches and the matches themselves alternate, so the ends are running sums of lengths.
    """
    entry = "struct<start:int,kind:int,end:int,found:string>"
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{entry}>").alias("spans"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["between"])
        end = begin + F.length(pair["found"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["found"].alias("found"))
        spans = F.when(keep(pair["found"]), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    pairs = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("between"), found.alias("found"))
    spans = F.aggregate(pairs, start, step, lambda acc: acc["spans"])
    # Most texts have no match: one search settles those.
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(F.array().cast(f"array<{entry}>"))


def char_class(candidate: Column) -> Column:
    return (
        F.when(F.rlike(candidate, F.lit(r"^[0-9a-fA-F]+$")), "hex")
        .when(F.rlike(candidate, F.lit(r"^[0-9A-Za-z]+$")), "alnum")
        .otherwise("base64")
    )


def _best_window(candidate: Column, alphabet: str, window: int) -> Column:
    """The largest entropy of all windows, from counts that change by one character in and one out."""
    size = len(alphabet)
    chars = F.filter(F.split(candidate, ""), lambda c: c != "")
    codes = F.transform(chars, lambda c: F.instr(F.lit(alphabet), c))
    # c * log2(c) for every count a window can have.
    weight = F.transform(
        F.sequence(F.lit(0), F.lit(window + 1)), lambda c: F.when(c < 2, F.lit(0.0)).otherwise(c * F.log2(c))
    )
    start = F.struct(
        F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), F.lit(0).alias("n")
    )

    def step(acc: Column, pair: Column) -> Column:
        into, out = pair["into"], pair["out"]
        had = F.element_at(acc["counts"], into)
        left = F.when(out.isNull(), F.lit(0)).otherwise(
            F.element_at(acc["counts"], F.coalesce(out, F.lit(1))) + F.when(out == into, 1).otherwise(0)
        )
        total = (
            acc["sum"]
            + F.element_at(weight, had + 2)
            - F.element_at(weight, had + 1)
            + F.when(out.isNull(), F.lit(0.0)).otherwise(
                F.element_at(weight, F.greatest(left, F.lit(1))) - F.element_at(weight, F.greatest(left, F.lit(1)) + 1)
            )
        )
        counts = F.transform(
            acc["counts"],
            lambda c, k: c
            + F.when(k + 1 == into, 1).otherwise(0)
            - F.when(k + 1 == F.coalesce(out, F.lit(0)), 1).otherwise(0),
        )
        n = acc["n"] + 1
        entropy = F.lit(window).cast("double")
        entropy = F.log2(entropy) - total / entropy
        best = F.when((n >= window) & (entropy > acc["best"]), entropy).otherwise(acc["best"])
        return F.struct(counts.alias("counts"), total.alias("sum"), best.alias("best"), n.alias("n"))

    leaving = F.concat(F.array_repeat(F.lit(None).cast("int"), window), codes)
    pairs = F.arrays_zip(codes.alias("into"), F.slice(leaving, 1, F.size(codes)).alias("out"))
    return F.aggregate(pairs, start, step, lambda acc: acc["best"])


def is_random(candidate: Column, window: int = WINDOW) -> Column:
    """Whether some window of the candidate has more entropy than words or identifiers of its class have."""
    kind = char_class(candidate)
    tests = F.lit(False)
    for name, alphabet in ALPHABETS.items():
        # Hex digits come in either case; they are one alphabet.
        text = F.lower(candidate) if name == "hex" else candidate
        tests = F.when(kind == name, _best_window(text, alphabet, window) > THRESHOLDS[name]).otherwise(tests)
    return tests


def scan(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """All columns of `df` and `found_spans`: an array of (start, kind, end), kind as an index of KINDS."""
    whole = F.coalesce(F.col(text), F.lit(""))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,found:string>>")
    based = df.withColumns(
        {
            "_assign": _spans(whole, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6, 0),
            "_access": _spans(whole, ACCESS, lambda m: F.length(m) >= 20, 1),
            # Runs are maximal, so asking for 24 characters at once is the same as dropping shorter ones.
            "_hex": _spans(whole, HEX, lambda m: F.lit(True), 2),
            "_runs": _spans(whole, CANDIDATE, lambda m: F.rlike(m, F.lit(MIXED)), 3),
        }
    )
    base = F.concat("_assign", "_access", "_hex")
    allowed = lambda m: reduce(or_, [F.rlike(m, F.lit(p)) for p in ALLOWED])
    added = F.filter(
        F.col("_runs"),
        lambda run: ~allowed(run["found"])
        & ~F.exists(F.col("_base"), lambda b: (b["start"] <= run["start"]) & (b["end"] >= run["end"]))
        & is_random(run["found"], window),
    )
    added = F.when(F.size("_runs") > 0, added).otherwise(empty)
    return (
        based.withColumn("_base", F.array_sort(base))
        .withColumn("_added", added)
        .drop("_assign", "_access", "_hex", "_runs")
    )


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def secret_spans(documents: DataFrame) -> DataFrame:
    """One row per row of `documents` (doc_id, text): counts of the three shapes, their digest, and all spans."""
    found = scan(documents.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter(F.col("_base"), lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(span_text(F.col("_base")), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat("_base", "_added"))).alias("spans"),
        F.size("_added").cast("long").alias("n_entropy"),
    )
