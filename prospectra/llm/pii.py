"""Personal data: patterns propose, checksums confirm, context words adjust the score.

All work is column functions. A pattern's matches and the pieces between them come from
Spark's own regular expressions; positions are running sums of their lengths. Patterns are
written so that no text makes them step back over a run: a run of characters is entered
at its first character (or where the last match ended) and never given back.

Every confirmed span of the base kinds stays whatever its score. The added kinds stay when
their score, raised by context words in front of them, reaches the least score.

Null and empty texts have no spans. Repeated rows are searched one by one. Spans count code
points and texts are searched whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions.identity import let
from prospectra.functions.regex import running_sums
from prospectra.llm.common import fields
from prospectra.operators.stage import staged

#: Characters in front of a span in which context words count, and what a word adds.
REACH, CONTEXT = 40, 0.35
LEAST_SCORE = 0.5


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``needs`` is a cheap pattern or a literal without which no text has a match."""

    name: str
    pattern: str
    needs: str
    score: float
    words: str
    base: bool = True


# The kinds in their order, with context words.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write|reach"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, r"\bip\b|address|host|server|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", 0.8, "card|visa|credit|pay|master"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, "phone|call|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", "", 0.9, "iban|account|bank", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, "ssn|social|security|tax", False),
)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether letters and digits, the first four moved to the end, leave 1 modulo 97."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def add(rest: Column, char: Column) -> Column:
        letter = char.rlike("[A-Z]")
        return (rest * F.when(letter, 100).otherwise(10) + F.when(letter, F.ascii(char) - 55).otherwise(F.ascii(char) - 48)) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


def confirmed(kind: str, hit: Column) -> Column:
    """The validator of a kind."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    small = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: hit.rlike(rf"^{small}(?:\.{small}){{3}}$"),
        "card": lambda: F.length(digits).between(16, 19) & luhn(digits),
        "phone": lambda: F.length(digits).between(8, 15),
        "iban": lambda: let(F.regexp_replace(hit, " ", ""), lambda c: F.length(c).between(15, 34) & mod97(c)),
        "ssn": lambda: ~hit.rlike("^(?:000|666|9)|-00-|-0000$"),
    }[kind]()


SPAN = "array<struct<kind:string,start:long,end:long,score:double>>"


def spans_of(text: Column, kind: Kind) -> Column:
    """The confirmed spans of one kind in a text, with their scores."""
    pattern = F.lit(kind.pattern)

    def found(hits: Column) -> Column:
        pairs = F.zip_with(
            F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(hits)), hits,
            lambda gap, hit: F.struct(
                (F.length(gap) + F.length(hit)).cast("long").alias("step"), F.lower(F.right(gap, F.lit(REACH))).alias("front"), hit.alias("hit")
            ),
        )
        return let(pairs, scored)

    def scored(pairs: Column) -> Column:
        placed = F.zip_with(running_sums(F.transform(pairs, lambda p: p["step"])), pairs, lambda end, p: F.struct(
            F.lit(kind.name).alias("kind"), (end - F.length(p["hit"])).alias("start"), end.alias("end"),
            F.least(F.lit(1.0), kind.score + F.when(p["front"].rlike(kind.words), CONTEXT).otherwise(0.0)).alias("score"),
            confirmed(kind.name, p["hit"]).alias("good"),
        ))
        kept = F.filter(placed, lambda s: s["good"] if kind.base else s["good"] & (s["score"] >= LEAST_SCORE))
        return F.transform(kept, lambda s: F.struct(s["kind"], s["start"], s["end"], s["score"])).cast(SPAN)

    none = F.array().cast(SPAN)
    spans = let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda hits: F.when(F.size(hits) > 0, found(hits)).otherwise(none))
    return F.when(text.contains(kind.needs), spans).otherwise(none) if kind.needs else spans


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``key`` and ``spans`` (kind, start, end, score; by kind as listed, then start) of every row."""
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = staged(rows, {f"_{k.name}": spans_of(F.col("_text"), k) for k in kinds}, ("_text",))
    return rows.select(key, F.concat(*[F.col(f"_{k.name}") for k in kinds]).alias("spans"))


def span_digests(found: DataFrame, key: str = "doc_id", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Counts per base kind, the digest of the base spans, all spans and their scores as text."""
    base = [k.name for k in kinds if k.base]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    made = F.struct(
        *map(count, base), F.sha2(shown(F.filter("spans", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )
    return fields(found.select(key, made.alias("_s")), [key], "_s")
