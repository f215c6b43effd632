"""Secrets in texts: key patterns and windows of high Shannon entropy.

Everything is DataFrame expressions. A pattern's matches are placed by the
lengths of the pieces between them (`split`) and of themselves. Candidate
strings are folded over once, character by character: the window's counts per
character and per character class change by the character that enters and the
one that leaves, and with them the sum of c·log2(c), kept in whole billionths
so that no rounding gathers. A window counts when its entropy reaches the
threshold of the narrowest class that holds all its characters, that of letters
if it has hardly a digit, and when it touches nothing on the allow-list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weirflow.llm.common import query
from weirflow.plans.registry import table

# Fixed values of the base rules.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_VALUE_CHARS = 8

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
LEAST_DIGITS = 2
#: Bits per character that a window outside the hex class must reach if it has
#: fewer digits than that: words, and words joined by separators, stay below.
LETTERS_THRESHOLDS = {"entropy_alnum": 3.7, "entropy_base64": 3.75}
#: Bits per character that a window of the class must reach.
THRESHOLDS = {"entropy_hex": 2.75, "entropy_alnum": 3.4, "entropy_base64": 3.7}
ALLOWED_WORDS = r"(?i)(example|placeholder|changeme|dummy|sample|xxxx)"
#: What is known not to be a secret: whole candidates by the first two, and by the
#: words only the letters and digits around one, up to the next separator.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^sha(256-[A-Za-z0-9+/]{43}=|384-[A-Za-z0-9+/]{64}|512-[A-Za-z0-9+/]{86}==)$",
    ALLOWED_WORDS,
)
ALLOWED_PART = rf"(?<![A-Za-z0-9])[A-Za-z0-9]*{ALLOWED_WORDS}[A-Za-z0-9]*"

_SCALE = 10**9
_FIRST, _SYMBOLS = ord("+"), ord("z") - ord("+") + 1
SPAN = "struct<start:int,kind:int,end:int>"


def _no_spans() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _span(start: Column, kind: Column | int, end: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, int) else kind
    return F.struct(
        start.cast("int").alias("start"), kind.cast("int").alias("kind"),
        end.cast("int").alias("end"),
    )


def _found(text: Column, pattern: str, groups: Sequence[int]) -> Column:
    """Array of (gap, match, group values …) for leftmost matches in order."""
    parts = [F.split(text, pattern, -1)] + [
        F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, *groups)
    ]
    names = ["gap", "match", *[f"g{g}" for g in groups]]
    return F.arrays_zip(*[p.alias(n) for p, n in zip(parts, names)])


def pattern_spans(text: Column, pattern: str, kind: int, gate: str, value_chars: int = 0) -> Column:
    """Spans of the matches, of which group 2 has `value_chars` characters or
    more if that is given. Texts in which `gate` finds nothing have none."""
    matches = _found(text, pattern, [2] if value_chars else [])

    def step(state: Column, found: Column) -> Column:
        start = state["at"] + F.length(found["0"])
        end = start + F.length(found["1"])
        passes = found["1"].isNotNull()
        if value_chars:
            passes = passes & (F.length(found["2"]) >= value_chars)
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(passes, F.array_append(state["spans"], _span(start, kind, end)))
            .otherwise(state["spans"]).alias("spans"),
        )

    first = F.struct(F.lit(0).alias("at"), _no_spans().alias("spans"))
    numbered = F.transform(matches, _by_position(3 if value_chars else 2))
    spans = F.aggregate(numbered, first, step, lambda s: s["spans"])
    return F.when(text.rlike(gate), spans).otherwise(_no_spans())


def _by_position(fields: int):
    names = ["gap", "match", "g2"][:fields]
    return lambda x: F.struct(*[x[n].alias(str(i)) for i, n in enumerate(names)])


def _weights() -> Column:
    """c·log2(c) in billionths for c = 0 … WINDOW + 1."""
    values = [0] + [round(c * math.log2(c) * _SCALE) for c in range(1, WINDOW + 2)]
    return F.array(*[F.lit(v).cast("long") for v in values])


def most_weight(kind: str) -> int:
    """The largest sum of c·log2(c) at which a window reaches the threshold."""
    return _most_weight(THRESHOLDS[kind])


def _most_weight(threshold: float) -> int:
    return math.floor(WINDOW * (math.log2(WINDOW) - threshold) * _SCALE)


def _let(value: Column, then) -> Column:
    """`then(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _changed(counts: Column, at: Column, by: int) -> Column:
    return F.concat(
        F.slice(counts, F.lit(1), at - 1), F.array(F.element_at(counts, at) + by),
        F.slice(counts, at + 1, F.lit(_SYMBOLS) - at),
    )


def _between(x: Column, first: str, last: str) -> Column:
    return x.between(ord(first) - _FIRST + 1, ord(last) - _FIRST + 1)


def _is_digit(x: Column) -> Column:
    return _between(x, "0", "9")


def _is_plain(x: Column) -> Column:
    return _is_digit(x) | _between(x, "a", "z")


def _is_hex(x: Column) -> Column:
    return _is_digit(x) | _between(x, "a", "f") | _between(x, "A", "F")


def _moves(candidate: Column) -> Column:
    """Per character (enters, leaves, end): its code, that of the character the
    window loses (null while it fills), and the window's end."""
    def shifted(codes: Column) -> Column:
        size = F.size(codes)
        lost = F.concat(
            F.array_repeat(F.lit(None).cast("int"), F.least(size, F.lit(WINDOW))),
            F.slice(codes, F.lit(1), F.greatest(size - WINDOW, F.lit(0))),
        )
        both = F.zip_with(
            codes, lost, lambda c, l: F.struct(c.alias("enters"), l.alias("leaves"))
        )
        return F.transform(both, lambda x, i: F.struct(
            x["enters"].alias("enters"), x["leaves"].alias("leaves"), (i + 1).alias("end")
        ))

    return _let(
        F.transform(F.split(candidate, ""), lambda c: F.ascii(c) - F.lit(_FIRST - 1)), shifted
    )


def entropy_spans(candidate: Column, allowed: Column) -> Column:
    """Spans of the windows of a candidate that count and touch none of the
    `allowed` spans, those of one class joined where they overlap."""
    weights = _weights()
    one, zero = F.lit(1), F.lit(0)

    def weight_of(count: Column) -> Column:
        return F.element_at(weights, count + 1)

    def entered(state: Column, x: Column) -> Column:
        before = F.element_at(state["counts"], x["enters"])
        return F.struct(
            _changed(state["counts"], x["enters"], 1).alias("counts"),
            (state["weight"] + weight_of(before + 1) - weight_of(before)).alias("weight"),
        )

    def moved(state: Column, x: Column, now: Column) -> Column:
        full = x["leaves"].isNotNull()
        gone = F.element_at(now["counts"], F.coalesce(x["leaves"], one))

        def number(name: str, test) -> Column:
            plus = F.when(test(x["enters"]), one).otherwise(zero)
            minus = F.when(full & test(x["leaves"]), one).otherwise(zero)
            return (state[name] + plus - minus).alias(name)

        return F.struct(
            F.when(full, _changed(now["counts"], F.coalesce(x["leaves"], one), -1))
            .otherwise(now["counts"]).alias("counts"),
            F.when(full, now["weight"] + weight_of(F.greatest(gone - 1, zero)) - weight_of(gone))
            .otherwise(now["weight"]).alias("weight"),
            number("digits", _is_digit), number("plain", _is_plain), number("hex", _is_hex),
        )

    def judged(state: Column, x: Column, new: Column) -> Column:
        kind = F.when(new["hex"] == WINDOW, F.lit(3)).when(new["plain"] == WINDOW, F.lit(4)).otherwise(5)
        most = F.when(new["hex"] == WINDOW, F.lit(most_weight("entropy_hex"))).when(
            new["plain"] == WINDOW, F.lit(most_weight("entropy_alnum"))
        ).otherwise(F.lit(most_weight("entropy_base64")))
        lettered = (new["hex"] == WINDOW) | (new["digits"] >= LEAST_DIGITS) | (
            new["weight"] <= F.when(
                new["plain"] == WINDOW, F.lit(_most_weight(LETTERS_THRESHOLDS["entropy_alnum"]))
            ).otherwise(F.lit(_most_weight(LETTERS_THRESHOLDS["entropy_base64"])))
        )
        counts = (
            (x["end"] >= WINDOW) & (new["weight"] <= most) & lettered & (new["digits"] < WINDOW)
            & ~F.exists(allowed, lambda a: (a["start"] < x["end"]) & (a["end"] > x["end"] - WINDOW))
        )
        start, spans = x["end"] - WINDOW, state["spans"]
        last = F.try_element_at(spans, F.lit(-1))
        joins = F.coalesce((last["kind"] == kind) & (last["end"] >= start), F.lit(False))
        longer = F.concat(
            F.slice(spans, one, F.greatest(F.size(spans) - 1, zero)),
            F.array(_span(last["start"], kind, x["end"])),
        )
        return F.struct(
            new["counts"].alias("counts"), new["weight"].alias("weight"),
            new["digits"].alias("digits"), new["plain"].alias("plain"), new["hex"].alias("hex"),
            F.when(counts & joins, longer)
            .when(counts, F.array_append(spans, _span(start, kind, x["end"])))
            .otherwise(spans).alias("spans"),
        )

    def step(state: Column, x: Column) -> Column:
        return _let(entered(state, x), lambda now: _let(
            moved(state, x, now), lambda new: judged(state, x, new)
        ))

    first = F.struct(
        F.array_repeat(zero, _SYMBOLS).alias("counts"), F.lit(0).cast("long").alias("weight"),
        zero.alias("digits"), zero.alias("plain"), zero.alias("hex"), _no_spans().alias("spans"),
    )
    return F.aggregate(_moves(candidate), first, step, lambda s: s["spans"])


def candidate_spans(text: Column) -> Column:
    """Entropy spans of all candidates of a text that are not on the allow-list
    as a whole."""
    def scanned(match: Column) -> Column:
        allowed = F.lit(False)
        for pattern in ALLOWED[:2]:
            allowed = allowed | match.rlike(pattern)
        return ~allowed

    def spans_of(match: Column) -> Column:
        allowed = pattern_spans(match, ALLOWED_PART, 5, ALLOWED_WORDS)
        return _let(allowed, lambda parts: entropy_spans(match, parts))

    places = pattern_spans(text, CANDIDATE, 5, CANDIDATE)
    matches = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    paired = F.filter(
        F.transform(
            F.arrays_zip(places.alias("place"), matches.alias("match")),
            lambda x: F.struct(x["place"]["start"].alias("at"), x["match"].alias("match")),
        ),
        lambda x: scanned(x["match"]),
    )
    shifted = F.transform(
        paired,
        lambda x: F.transform(
            spans_of(x["match"]),
            lambda s: _span(s["start"] + x["at"], s["kind"], s["end"] + x["at"]),
        ),
    )
    return F.when(text.rlike(CANDIDATE), F.flatten(shifted)).otherwise(_no_spans())


def secret_spans(text: Column) -> Column:
    """All spans (start, kind, end) of a text by start and kind: code points
    from 0, end exclusive, kind a place in `KINDS`. A null text has none."""
    whole = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(
        pattern_spans(
            whole, ASSIGN, 0, ASSIGN[:-2] + f"{{{ASSIGN_VALUE_CHARS},}})", ASSIGN_VALUE_CHARS
        ),
        pattern_spans(whole, ACCESS, 1, ACCESS),
        pattern_spans(whole, HEX, 2, HEX),
        candidate_spans(whole),
    ))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
            s["end"].cast("string"),
        )),
        ",",
    )


def masked(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with every span, overlapping ones together, replaced by `mask`."""

    def step(state: Column, s: Column) -> Column:
        opens = s["start"] > state["end"]
        between = F.substring(text, state["end"] + 1, F.greatest(s["start"] - state["end"], F.lit(0)))
        return F.struct(
            F.when(opens | (state["end"] == 0) & (F.length(state["done"]) == 0),
                   F.concat(state["done"], between, F.lit(mask)))
            .otherwise(state["done"]).alias("done"),
            F.greatest(state["end"], s["end"]).alias("end"),
        )

    first = F.struct(F.lit("").alias("done"), F.lit(0).alias("end"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, first, step,
        lambda s: F.concat(s["done"], F.substring(text, s["end"] + 1, F.length(text))),
    ))


@query("op3_secrets")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secret_spans(F.col("text")).alias("found"))

    def number(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = spans_text(F.filter("found", lambda s: s["kind"] < 3))
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"),
        number(2).alias("n_hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
    )


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents stay, with `[secret]` in the place of every
    span and `n_chars` counted anew where the text changed."""
    columns = docs.columns
    found = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"),
                        secret_spans(docs["text"]).alias("found"))
    row, changed = F.col("row"), F.size("found") > 0
    text = masked(row["text"], F.col("found"))
    return found.select(*[
        text.alias(c) if c == "text"
        else F.when(changed, F.length(text).cast("long")).otherwise(row[c]).alias(c)
        if c == "n_chars" else row[c].alias(c)
        for c in columns
    ])
