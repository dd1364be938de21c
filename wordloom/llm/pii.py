"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Everything is a built-in expression on the row of the document: no shuffle, no
Python. A text is cut at the matches of a pattern, and the lengths of the pieces
give the places of the matches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The four base patterns. They are written so that a failed or
# long match is never tried again from inside the same run of characters.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: A chain of digits with single blanks or hyphens, taken whole. Chains of other
#: lengths than 13 to 19 digits cannot pass, so the pattern leaves them out.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Kinds of this operator's own.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"

#: Code points before and after a match that count as its context.
BEFORE, AFTER = 48, 24
#: Own kinds below this score are not reported.
LEAST_SCORE = 0.5
#: Elements of a running sum that are added up in one go.
_BLOCK = 128


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(F.reverse(digits), place, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod_97(code: Column) -> Column:
    """Whether a bank account number passes the mod-97 check."""
    plain = F.regexp_replace(code, r"\x20", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def add(rest: Column, character: Column) -> Column:
        value = F.ascii(character)
        return F.when(value >= 65, (rest * 100 + value - 55) % 97).otherwise((rest * 10 + value - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(add(rest, c))) == 1


def _address_parts(match: Column) -> Column:
    part = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
    return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


@dataclass(frozen=True)
class Kind:
    """One kind of personal data: how it looks, what confirms it, what its context says."""

    name: str
    pattern: str
    #: A cheap test that is true wherever the pattern can match.
    possible: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    #: Words nearby that raise the score, and such that lower it.
    raised_by: str
    lowered_by: str = r"$^"
    base: bool = True


KINDS = (
    Kind(
        "email", EMAIL, lambda t: t.contains("@"), lambda m: F.lit(True), 0.75,
        r"e-?mail|contact|write|kontakt|correo|courriel", r"example|noreply|no-reply",
    ),
    Kind(
        "ip", IP, lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), _address_parts, 0.55,
        r"\bip\b|address|host|server|client|login|adresse", r"version|\bv\.?$|release|section|chapter",
    ),
    Kind(
        "card", CARD, lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), lambda m: luhn(_digits(m)), 0.65,
        r"card|visa|master|credit|debit|payment|karte|carte|tarjeta", r"isbn|order|serial|tracking",
    ),
    Kind(
        "phone", PHONE, lambda t: t.rlike(r"\+[0-9]"),
        lambda m: F.length(_digits(m)).between(9, 15), 0.6,
        r"phone|\btel|call|fax|mobile|cell|whatsapp|telefon|tel[eé]fono|t[eé]l[eé]phone", r"utc|gmt",
    ),
    Kind(
        "iban", IBAN, lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"), mod_97, 0.9,
        r"iban|bank|account|konto|cuenta|compte", base=False,
    ),
    Kind(
        "ssn", SSN, lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"), lambda m: F.lit(True), 0.3,
        r"ssn|social\s+security", base=False,
    ),
)


def _running_sums(sizes: Column) -> Column:
    """Sums of all elements up to and including each, block by block."""
    def within(block: Column, start: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("sums")),
            lambda acc, size: F.struct(
                (acc["at"] + size).alias("at"),
                F.array_append(acc["sums"], acc["at"] + size).alias("sums"),
            ),
            lambda acc: acc["sums"],
        )

    blocks = F.transform(
        F.sequence(F.lit(1), F.size(sizes), F.lit(_BLOCK)), lambda at: F.slice(sizes, at, F.lit(_BLOCK))
    )
    zero = F.lit(0).cast("bigint")

    def after(acc: Column, block: Column) -> Column:
        total = F.aggregate(block, zero, lambda a, b: a + b)
        return F.struct(
            (acc["at"] + total).alias("at"), F.array_append(acc["starts"], acc["at"]).alias("starts")
        )

    starts = F.aggregate(
        blocks,
        F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts")),
        after,
        lambda acc: acc["starts"],
    )
    sums = F.flatten(F.zip_with(blocks, starts, within))
    return F.when(F.size(sizes) > 0, sums).otherwise(F.array().cast("array<bigint>"))


_SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def _pieces(text: Column, kind: Kind) -> Column:
    """The text around the matches, and the matches: one more piece than matches."""
    return F.when(
        kind.possible(text),
        F.struct(
            F.split(text, kind.pattern, -1).alias("around"),
            F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("matches"),
        ),
    )


def _judged(kind: Kind, pieces: Column) -> Column:
    """Each match with its validity and score: array<struct<match, valid, score, before>>."""
    def judge(match: Column, place: Column) -> Column:
        context = F.lower(
            F.concat(
                F.right(F.get(pieces["around"], place), F.lit(BEFORE)),
                F.lit(" "),
                F.left(F.get(pieces["around"], place + 1), F.lit(AFTER)),
            )
        )
        score = (
            F.lit(kind.score)
            + F.when(context.rlike(kind.raised_by), 0.25).otherwise(0.0)
            - F.when(context.rlike(kind.lowered_by), 0.25).otherwise(0.0)
        )
        score = F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 2)
        valid = kind.valid(match)
        if not kind.base:
            valid = valid & (score >= LEAST_SCORE)
        return F.struct(
            match.alias("match"),
            valid.alias("valid"),
            score.alias("score"),
            F.get(pieces["around"], place).alias("before"),
        )

    return F.transform(pieces["matches"], judge)


def _spans(kind: Kind, judged: Column) -> Column:
    ends = _running_sums(
        F.transform(judged, lambda m: (F.length(m["before"]) + F.length(m["match"])).cast("bigint"))
    )
    placed = F.zip_with(
        judged,
        ends,
        lambda m, end: F.when(
            m["valid"],
            F.struct(
                F.lit(kind.name).alias("kind"),
                (end - F.length(m["match"])).alias("start"),
                end.alias("end"),
                m["score"].alias("score"),
            ),
        ),
    )
    return F.array_compact(placed).cast(_SPANS)


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of personal data per document: (doc_id, spans).

    ``spans`` is an array of (kind, start, end, score) by kind in the order of
    ``KINDS``, then start; code points, end exclusive. One row per input row;
    other columns are left out. A null or empty text has no spans; the matches
    of one kind never overlap, those of two kinds may.
    """
    found = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    found = found.select("doc_id", *[_pieces(F.col("body"), kind).alias(kind.name) for kind in KINDS])
    judged = found.select("doc_id", *[_judged(kind, F.col(kind.name)).alias(kind.name) for kind in KINDS])
    none = F.array().cast(_SPANS)
    return judged.select(
        "doc_id",
        F.concat(
            *[
                F.when(F.size(kind.name) > 0, _spans(kind, F.col(kind.name))).otherwise(none)
                for kind in KINDS
            ]
        ).alias("spans"),
    )


def _without(kind: Kind, text: Column, least_score: float) -> Column:
    pieces = _pieces(text, kind)
    filled = F.transform(
        _judged(kind, pieces),
        lambda m: F.concat(
            m["before"],
            F.when(m["valid"] & (m["score"] >= least_score), F.lit(f"[{kind.name.upper()}]")).otherwise(m["match"]),
        ),
    )
    return F.when(
        F.size(pieces["matches"]) > 0,
        F.concat(F.array_join(filled, ""), F.element_at(pieces["around"], -1)),
    ).otherwise(text)


def redact(docs: DataFrame, text: str = "text", least_score: float = 0.3) -> DataFrame:
    """``docs`` with each confirmed span of at least this score replaced by its kind.

    Kinds are replaced one after another, account numbers and cards before
    phone numbers, so overlapping spans leave nothing behind. All rows and
    columns stay; null texts stay null.
    """
    order = ["iban", "card", "ssn", "phone", "ip", "email"]
    kinds = {kind.name: kind for kind in KINDS}
    for name in order:
        docs = docs.withColumn(text, _without(kinds[name], F.col(text), least_score))
    return docs


def digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the spans of these kinds, joined by commas."""
    written = F.transform(
        F.filter(spans, lambda s: s["kind"].isin(*kinds)),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(written, ",")
