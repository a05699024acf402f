"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

DataFrame expressions only. A text split by a pattern alternates with the pattern's matches, so the
lengths of the pieces give the position of every match in code points. Per kind matches do not
overlap, leftmost first. The four base kinds (email, ip, card, phone) are settled by their pattern
and check alone. Further kinds are proposed by their own pattern, must pass their check (mod 97 for
an IBAN, the issuing rules for a social security number, mixed and varied characters for a secret) and then reach a score: a start value for
the kind, raised by a word of its context list within ``CONTEXT`` characters, lowered by a word that
speaks against it. Base spans get a score as well, but always stay.

Patterns are written without backtracking into a run of word characters (possessive repeats, and a
match may only begin where a run begins or the previous match ended), so time is linear in the text.

Edge cases: a null or empty text has no spans; a text may hold any number of spans (positions are
summed in blocks, so cost stays near linear); repeated rows each get their result; an empty table
gives an empty result; columns of other names are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters looked at on either side of a span.
CONTEXT = 48
#: Score from which a further kind is reported.
THRESHOLD = 0.6
#: Different characters in a secret, at least.
LEAST_DISTINCT = 9
BLOCK = 256


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def part(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (n - i) % 2 == 1
        return F.when(twice, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), part), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN (upper case, no blanks) has the remainder 1 by 97."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        value = F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(value < 10, (rest * 10 + value) % 97).otherwise((rest * 100 + value) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _is_ip(match: Column) -> Column:
    def fits(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+", "")
        return (F.length(short) <= 3) & (F.when(short == "", 0).otherwise(F.substring(short, 1, 3).cast("int")) <= 255)

    return F.forall(F.split(match, r"\."), fits)


def _is_card(match: Column) -> Column:
    n = F.length(_digits(match))
    return F.when(n.between(14, 19), luhn(_digits(match))).otherwise(False)


def _is_phone(match: Column) -> Column:
    return F.length(_digits(match)).between(10, 15)


def _is_iban(match: Column) -> Column:
    plain = F.regexp_replace(match, " ", "")
    return F.when(F.length(plain).between(15, 34), mod97(plain)).otherwise(False)


def _is_ssn(match: Column) -> Column:
    area, group, serial = (F.substring(match, i, n) for i, n in ((1, 3), (5, 2), (8, 4)))
    return ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")


def _is_secret(match: Column) -> Column:
    """Letters and digits mixed, and as many different characters as random text of 16 and more would have."""
    return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(match, ""))) >= LEAST_DISTINCT)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    check: Callable[[Column], Column] | None
    probe: str  # a cheap necessary condition on the whole text
    start: float
    context: str  # words that raise the score
    against: str  # words that lower it
    base: bool = True


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, "@", 0.9, "mail|e-mail|contact|write|reach", "example|noreply"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", _is_ip, ".", 0.6, r"ip\b|address|host|server|login", r"version|release|v\."),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", _is_card, "", 0.8, "card|visa|master|amex|credit|debit|payment", "isbn|order|tracking"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", _is_phone, "+", 0.7, r"phone|tel\b|call|mobile|fax|contact", "order|isbn"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _is_iban, "", 0.8, "iban|bank|account|konto|transfer", "serial|key", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _is_ssn, "-", 0.4, r"ssn|social|security|tax|insurance", "part|serial|order", False),
    # keys of known shape, told without context, and other random-looking runs beside a word for a secret
    Kind(
        "key",
        r"(?<![A-Za-z0-9_-])(?:A[KS]IA[0-9A-Z]{16}|gh[opsur]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|xox[abprs]-[A-Za-z0-9-]{10,72}+|[rs]k_(?:live|test)_[A-Za-z0-9]{16,99}+|AIza[A-Za-z0-9_-]{35})(?![A-Za-z0-9_-])",
        _is_secret, "", 0.7, "key|token|secret|credential|access", "example|sample|dummy", False,
    ),
    Kind(
        "secret", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}+={0,2}+(?![A-Za-z0-9+/_=-])",
        _is_secret, "", 0.3, r"token|secret|passw|pwd|api[ _-]?key|bearer|credential|authorization|private[ _-]key", r"commit|checksum|sha-?(?:1|256)|md5|uuid|revision|example", False,
    ),
)


def _starts(lengths: Column) -> Column:
    """For an array of lengths, the sum of those before each place. Summed in blocks: appending to
    one long array would cost the square of its length."""

    def append(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def begin(at: Column) -> Column:
        return F.struct(at.cast("long").alias("at"), F.array().cast("array<long>").alias("out"))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK)), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x))
    bases = F.aggregate(totals, begin(F.lit(0)), append, lambda acc: acc["out"])
    inner = F.zip_with(blocks, bases, lambda b, at: F.aggregate(b, begin(at), append, lambda acc: acc["out"]))
    return F.flatten(inner)


def _spans(kind: Kind, order: int) -> tuple[Column, Callable[[Column, Column], Column]]:
    """From the columns ``_m`` (matches) and ``_p`` (pieces around them): the ends of the matches, to
    be named ``_e``, and the function that makes a span of a match and its place."""
    matches, pieces = F.col("_m"), F.col("_p")
    # piece and match in turn: the start of a match is the sum of all before it
    lengths = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: (F.length(p) + F.length(m)).cast("long"))
    ends = F.zip_with(_starts(lengths), lengths, lambda a, n: a + n)

    def span(m: Column, i: Column) -> Column:
        before = F.lower(F.substring(pieces[i], -CONTEXT, CONTEXT))
        after = F.lower(F.substring(pieces[i + 1], 1, CONTEXT))
        near = F.concat(before, F.lit(" "), after)
        score = F.lit(kind.start) + F.when(near.rlike(kind.context), 0.3).otherwise(0.0) - F.when(near.rlike(kind.against), 0.2).otherwise(0.0)
        return F.struct(
            (F.col("_e")[i] - F.length(m)).alias("start"),
            F.lit(order).alias("order"),
            F.lit(kind.name).alias("kind"),
            F.col("_e")[i].alias("end"),
            F.round(F.least(F.lit(1.0), score), 2).alias("score"),
            m.alias("text"),
        )

    return ends, span


def _passes(check: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda span: check(span["text"])


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans: array of (start, order, kind, end, score, text) by start, then kind as listed.
    Positions are code points, ends exclusive."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.select(F.col(id_col).alias("doc_id"), text.alias("_t"))
    empty = "array<struct<start:bigint,order:int,kind:string,end:bigint,score:double,text:string>>"
    for order, kind in enumerate(KINDS):
        may = F.contains(F.col("_t"), F.lit(kind.probe)) if kind.probe else F.lit(True)
        out = out.withColumn("_m", F.when(may, F.regexp_extract_all("_t", F.lit(kind.pattern), 0)).otherwise(F.array().cast("array<string>")))
        some = F.size("_m") > 0
        out = out.withColumn("_p", F.when(some, F.split("_t", kind.pattern, -1)))
        ends, span = _spans(kind, order)
        out = out.withColumn("_e", F.when(some, ends))
        found = F.transform("_m", span)
        if kind.check is not None:
            found = F.filter(found, _passes(kind.check))
        if not kind.base:
            found = F.filter(found, lambda s: s["score"] >= THRESHOLD)
        out = out.withColumn(f"_{kind.name}", F.when(some, found).otherwise(F.array().cast(empty)))
    every = F.concat(*[F.col(f"_{k.name}") for k in KINDS])
    return out.select("doc_id", F.array_sort(every).alias("spans"))


def listed(spans: Column, base_only: bool) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    if base_only:
        spans = F.filter(spans, lambda s: s["kind"].isin([k.name for k in KINDS if k.base]))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
