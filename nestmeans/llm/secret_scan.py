"""Secrets in text: patterns propose spans, the corpus-wide ownership of each value tells what they are.

A value that many owners hold is an example that everyone copies from the same manual; one that a
single owner holds, and that looks random, is likely live. So every span's value is hashed, the
hashes are counted by distinct owners and by distinct repositories over the whole corpus, and the counts go back to the spans.
Counting is done in steps that each combine before they shuffle (value, owner and repository; then value and owner;
then value), so a value that a third of all rows hold is spread over all tasks. Only values that more than
``max_owners`` hold are joined back, from a written table that Spark broadcasts when it is small
and else joins with its skew handling.

Built-in functions only. The texts are read once, in a map; spans, not texts, move after that. The
patterns are linear in the text: each starts at the first character of a run and uses possessive repeats, which
match the same as the plain forms noted beside them.

Spans of the base kinds are kept whenever their length test agrees. The added kinds are kept when they overlap no
base span; a span of kind ``mixed`` (a long run of small and capital letters and digits) only when it is judged live.
Verdicts: ``example`` when more than ``max_owners`` owners hold the value, else ``live`` when it looks random, else ``plain``.

Defined cases: NULL text counts as empty; NULL owners are one owner together and NULL repositories of an owner one
repository; repeated rows give repeated results and count as one repository; an empty table gives an
empty result; texts of any length are read whole; spans that start together are ordered by kind as listed; other
columns are not read, whatever their names. Work per document grows with its text and with the square of its
number of spans (array appends).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmeans.llm.common import let
from nestmeans.scratch import materialize

MAX_OWNERS = 2
LEAST_SYMBOLS = 8
# Fragments of made-up credentials.
PLACEHOLDERS = "example|sample|dummy|changeme|placeholder|your|xxxx|12345678|abcdefgh"

_SPAN = "array<struct<start:int,kind:string,end:int,value:string,random:boolean>>"
_WORDS = ("password", "passwd", "secret", "token", "api_?key")


def either_case(pattern: str) -> str:
    """The pattern with every letter a-z in either case; other letters that fold to them do not match."""
    return "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in pattern)


_NAMES = "|".join(either_case(w) for w in _WORDS)


@dataclass(frozen=True)
class Kind:
    """One kind of secret: ``pattern`` proposes, ``valid`` (a pattern for the whole span) confirms; ``group``
    of ``valid`` is the value. ``needs`` is a literal that every match contains."""

    name: str
    pattern: str
    valid: str
    group: int = 0
    needs: str = ""


BASE = (
    # (password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+), then 12 or more
    Kind("assign", rf"""(?:{_NAMES})["']?+\x20*+[:=]\x20*+["']?+[A-Za-z0-9+/_.=-]++""",
         rf"""^(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{{12,}})$""", 1),
    # AKIA[A-Z0-9]+, then 18 or more
    Kind("access", "AKIA[A-Z0-9]{14,}+", "^AKIA[A-Z0-9]{14,}$", needs="AKIA"),
    # [0-9a-f]+, then 16 or more
    Kind("hex", "[0-9a-f](?<![0-9a-f][0-9a-f])[0-9a-f]{15,}+", "^[0-9a-f]{16,}$"),
)
ADDED = (
    # [A-Za-z0-9_-]+, then the fixed forms that services give out
    Kind("service", "[A-Za-z0-9_-](?<![A-Za-z0-9_-][A-Za-z0-9_-])[A-Za-z0-9_-]{15,}+",
         "^(?:gh[opsu]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{16,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})$"),
    # -----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*
    Kind("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]*+", r"PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]{32,}$",
         needs="PRIVATE KEY-----"),
    # [A-Za-z0-9_-]+ of 24 or more with a small letter, a capital and a digit; tested piece by piece
    Kind("mixed", "[A-Za-z0-9_-](?<![A-Za-z0-9_-][A-Za-z0-9_-])[A-Za-z0-9_-]{23,}+", "^[A-Za-z0-9_-]{24,}$"),
)
ORDER = tuple(k.name for k in (*BASE, *ADDED))


def looks_random(value: Column) -> Column:
    """Whether a value has enough different symbols, letters and digits, and no placeholder in it."""
    symbols = F.size(F.array_distinct(F.split(value, "")))
    return (
        (symbols >= LEAST_SYMBOLS) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
        & ~F.lower(value).rlike(PLACEHOLDERS)
    )


def find_spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind, in order of place: splitting at the pattern gives the stretches
    between the matches, and running lengths give each span's place in code points."""
    empty = F.array().cast(_SPAN)

    def confirmed(match: Column) -> Column:
        valid = match.rlike(kind.valid)
        if kind.name == "mixed":
            valid = valid & match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]")
        return valid

    def placed(matches: Column) -> Column:
        def walk(gaps: Column) -> Column:
            parts = F.zip_with(
                matches, F.slice(gaps, 1, F.size(matches)),
                lambda m, gap: F.struct(F.length(gap).alias("gap"), m.alias("match"), confirmed(m).alias("valid")),
            )
            start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

            def step(acc: Column, x: Column) -> Column:
                first = acc["at"] + x["gap"]
                end = first + F.length(x["match"])
                value = F.regexp_extract(x["match"], kind.valid, kind.group) if kind.group else x["match"]
                span = F.struct(
                    first.alias("start"), F.lit(kind.name).alias("kind"), end.alias("end"),
                    F.sha2(value, 256).alias("value"), looks_random(value).alias("random"),
                )
                grown = F.when(x["valid"], F.concat(acc["out"], F.array(span).cast(_SPAN))).otherwise(acc["out"])
                return F.struct(end.alias("at"), grown.alias("out"))

            return F.aggregate(parts, start, step, lambda acc: acc["out"])

        return F.when(F.size(matches) == 0, empty).otherwise(let(F.split(text, kind.pattern, -1), walk))

    found = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), placed)
    return F.when(F.contains(text, F.lit(kind.needs)), found).otherwise(empty) if kind.needs else found


def proposals(text: Column) -> Column:
    """All spans of a text: the base kinds, and the added ones that overlap none of them."""
    base = F.concat(*[find_spans(text, k) for k in BASE])
    added = F.concat(*[find_spans(text, k) for k in ADDED])

    def joined(base: Column) -> Column:
        apart = F.filter(added, lambda a: ~F.exists(base, lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"])))
        return F.concat(base, apart)

    return let(base, joined)


def ownership(candidates: DataFrame) -> DataFrame:
    """``(value, n_owners, n_repos)`` from rows of ``(value, owner, repo)``.

    A repository belongs to its owner: the same name under two owners is two repositories.
    """
    each = candidates.select("value", "owner", "repo").distinct()
    owners = each.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    return owners.groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repos"))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """``(id, spans)`` for every row: an array of ``(start, place, kind, end, value, verdict, n_owners, n_repos)``.

    ``place`` is the kind's number, ``value`` the SHA-256 of the secret; the counts are NULL up to ``max_owners``.
    """
    found = docs.select(
        F.col(id_col).alias("id"), F.col(owner_col).alias("owner"), F.col(repo_col).alias("repo"),
        proposals(F.coalesce(F.col(text_col), F.lit(""))).alias("spans"),
    )
    # numbered as it is written, so the numbers stay as they are
    found = materialize(found.withColumn("row", F.monotonically_increasing_id()), "secrets")
    spans = found.where(F.size("spans") > 0).select("row", "id", "owner", "repo", F.explode("spans").alias("s"))
    spans = spans.select("row", "id", "owner", "repo", "s.*")
    wide = materialize(ownership(spans).where(F.col("n_owners") > max_owners), "owners")
    verdict = F.when(F.col("n_owners").isNotNull(), "example").when(F.col("random"), "live").otherwise("plain")
    place = F.array_position(F.array(*[F.lit(n) for n in ORDER]), F.col("kind")).cast("int")
    judged = spans.join(wide, "value", "left").withColumn("verdict", verdict).where("kind <> 'mixed' OR verdict = 'live'")
    one = F.struct("start", place.alias("place"), "kind", "end", "value", "verdict", "n_owners", "n_repos")
    judged = judged.groupBy("row").agg(F.array_sort(F.collect_list(one)).alias("spans"))
    rows = found.where(F.size("spans") > 0).select("row", "id").join(judged, "row", "left")
    none = F.array().cast(judged.schema["spans"].dataType)
    rows = rows.select("id", F.coalesce("spans", none).alias("spans"))
    rest = found.where(F.size("spans") == 0).select("id", none.alias("spans"))
    return rows.unionByName(rest).withColumnRenamed("id", id_col)


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def is_base(span: Column) -> Column:
    return span["place"] <= len(BASE)


def count_of(spans: Column, field: str, value: str) -> Column:
    return F.size(F.filter(spans, lambda s: s[field] == value)).cast("bigint")
