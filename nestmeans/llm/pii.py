"""Personal data in text: patterns propose spans, checksums confirm them, context adjusts scores.

Built-in functions only; map-only, so no row ever moves. Per kind one pattern is run over the text
(``regexp_extract_all``); where it matches, splitting at the same pattern gives the stretches
between the matches, and running lengths give every span's place in code points. The patterns are
written so that each is linear in the text: they start at the first character of a run only and
use possessive repeats, which match the same as the plain forms noted beside them.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are kept whenever their validator agrees. The added
kinds ``iban`` (mod-97) and ``ssn`` (ranges) are kept from a score of ``MIN_SCORE``: each kind has a
base score, and a context word close to the span raises it.

Defined cases: NULL text counts as empty and stays NULL when redacting; repeated rows give repeated
results; overlapping spans of different kinds are all reported and masked as one stretch under the
kind that starts first. Work per document grows with its text and with the square of its number of
spans (array appends), which stays small up to tens of thousands of spans.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmeans.llm.common import let

MIN_SCORE = 0.5
CONTEXT_BONUS = 0.3
BEFORE, AFTER = 40, 20

_SPAN = "array<struct<start:int,end:int,kind:string,score:double>>"
_LOCAL = "A-Za-z0-9._%+-"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    values = F.transform(
        F.split(F.reverse(digits), "(?!^|$)"),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (letters and digits) passes the mod-97 check."""
    bare = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substr(bare, F.lit(5)), F.substr(bare, F.lit(1), F.lit(4)))
    values = F.transform(F.split(turned, "(?!^|$)"), lambda c: F.ascii(c))
    rest = F.aggregate(
        values, F.lit(0),
        lambda a, c: F.when(c >= 65, (a * 100 + c - 55) % 97).otherwise((a * 10 + c - 48) % 97),
    )
    return rest == 1


def _card(m: Column) -> Column:
    return luhn(_digits(m))


def _phone(m: Column) -> Column:
    return F.length(_digits(m)).between(8, 15)


def _ip(m: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(bare) <= 3) & (F.substr(bare, F.lit(1), F.lit(3)).cast("int") <= 255)

    return F.forall(F.split(m, r"\."), small)


def _iban(m: Column) -> Column:
    return F.length(F.regexp_replace(m, " ", "")).between(15, 34) & mod97(m)


def _ssn(m: Column) -> Column:
    area = F.substr(m, F.lit(1), F.lit(3))
    return (
        ~area.isin("000", "666") & (area < "900")
        & (F.substr(m, F.lit(5), F.lit(2)) != "00") & (F.substr(m, F.lit(8), F.lit(4)) != "0000")
    )


def _any(m: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    """One kind of personal data. ``needs`` is a literal that every match contains."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    needs: str = ""


BASE = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _any, 0.9,
         "mail|contact|write", "@"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++", _ip, 0.6,
         "address|host|server|login", "."),
    # [0-9]([\x20-]?[0-9])+ of 16 to 19 digits
    Kind("card", r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
         _card, 0.8, "card|visa|credit|debit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.6, "phone|call|tel|mobile|fax", "+"),
)
ADDED = (
    Kind("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban, 0.9,
         "iban|bank|account"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _ssn, 0.35,
         "ssn|social security|taxpayer", "-"),
)


def find_spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind with their scores, in order of place."""
    empty = F.array().cast(_SPAN)

    def placed(matches: Column) -> Column:
        def walk(gaps: Column) -> Column:
            n = F.size(matches)
            parts = F.zip_with(
                F.arrays_zip(F.slice(gaps, 1, n).alias("gap"), matches.alias("match")),
                F.slice(gaps, 2, n),
                lambda x, after: F.struct(
                    F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("size"),
                    kind.valid(x["match"]).alias("valid"),
                    F.lower(F.concat(F.right(x["gap"], F.lit(BEFORE)), F.lit(" "), F.left(after, F.lit(AFTER))))
                    .rlike(kind.context).alias("near"),
                ),
            )
            start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

            def step(acc: Column, x: Column) -> Column:
                first = acc["at"] + x["gap"]
                span = F.struct(
                    first.alias("start"), (first + x["size"]).alias("end"), F.lit(kind.name).alias("kind"),
                    F.when(x["near"], min(1.0, kind.score + CONTEXT_BONUS)).otherwise(kind.score).alias("score"),
                )
                return F.struct(
                    (first + x["size"]).alias("at"),
                    F.when(x["valid"], F.concat(acc["out"], F.array(span).cast(_SPAN)))
                    .otherwise(acc["out"]).alias("out"),
                )

            return F.aggregate(parts, start, step, lambda acc: acc["out"])

        return F.when(F.size(matches) == 0, empty).otherwise(let(F.split(text, kind.pattern, -1), walk))

    found = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), placed)
    return F.when(F.contains(text, F.lit(kind.needs)), found).otherwise(empty) if kind.needs else found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``(id, base, added)``: arrays of ``(start, end, kind, score)``; with the text if wanted."""
    known = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kinds = known.select(
        id_col, "text",
        F.concat(*[find_spans(F.col("text"), k) for k in BASE]).alias("base"),
        F.filter(F.concat(*[find_spans(F.col("text"), k) for k in ADDED]), lambda s: s["score"] >= MIN_SCORE)
        .alias("added"),
    )
    # The arrays are computed once for each row, however often the columns are used.
    once = kinds.select(id_col, *["text"] * keep_text, F.explode(F.array(F.struct("base", "added"))).alias("s"))
    return once.select(id_col, *["text"] * keep_text, "s.base", "s.added")


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every stretch of spans replaced by ``[KIND]``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.struct(
            s["end"].alias("at"),
            F.concat(
                acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]),
                F.lit("["), F.upper(s["kind"]), F.lit("]"),
            ).alias("out"),
        )
        joined = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], fresh).otherwise(joined)

    return F.aggregate(
        F.array_sort(spans), start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1))
    )


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in the text; ``length_col`` follows where the text changes."""
    text = F.col(text_col)
    spans = F.concat(
        *[find_spans(text, k) for k in BASE],
        F.filter(F.concat(*[find_spans(text, k) for k in ADDED]), lambda s: s["score"] >= MIN_SCORE),
    )
    clean = let(spans, lambda s: F.when(F.size(s) > 0, masked(text, s)).otherwise(text))
    once = docs.select("*", F.explode(F.array(F.struct(clean.alias("text")))).alias("__clean"))
    columns = []
    for name in docs.columns:
        if name == text_col:
            columns.append(F.col("__clean.text").alias(name))
        elif name == length_col:
            changed = F.col("__clean.text") != text
            columns.append(
                F.when(changed, F.length("__clean.text").cast(docs.schema[name].dataType))
                .otherwise(F.col(f"`{name}`")).alias(name)
            )
        else:
            columns.append(F.col(f"`{name}`"))
    return once.select(*columns)
