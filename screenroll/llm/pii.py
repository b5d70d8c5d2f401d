"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Everything is a built-in expression, so the operator is one narrow pass over the texts: no
shuffle, no Python on the executors. Positions come from the pieces between the matches of a
pattern (``split`` and ``regexp_extract_all`` see the same matches), added up in blocks so that
a text with very many matches costs little more than linear time.

Defined results: a NULL text counts as empty and has no spans; equal rows give equal results;
an empty table gives an empty result; other columns pass through, and a column of ``df`` that
has the name of a result column is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let as _let

BLOCK = 128
CONTEXT_CHARS = 40


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``pattern`` is the plain form (for other engines), ``java`` the same language without
    backtracking into what it has read. ``hint`` is text that every match contains. ``base``
    kinds are reported whenever they are confirmed; others need ``threshold``.
    """

    name: str
    pattern: str
    java: str
    confirm: str
    score: float
    context: str
    base: bool = True
    hint: str | None = None


# Patterns of the four base kinds and limits of their digits.
KINDS = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "any", 0.9, "mail|contact|write", hint="@"),
    Kind("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "octets", 0.7, "ip|host|server|address",
         hint="."),
    Kind("card", r"[0-9]([\x20-]?[0-9])+", r"[0-9](?:[\x20-]?[0-9])++", "luhn", 0.8,
         "card|visa|credit|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", "digits", 0.7,
         "phone|tel|call|mobile|fax", hint="+"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?",
         r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", "mod97", 0.8,
         "iban|account|bank|konto|compte|cuenta", base=False),
    Kind("ssn", r"[0-9]+-[0-9]+-[0-9]+", r"(?<![0-9])[0-9]++-[0-9]++-[0-9]++", "ssn", 0.3,
         "ssn|social|security|insurance", base=False, hint="-"),
    Kind("local_phone", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
         r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}", "any", 0.3,
         "phone|tel|call|mobile|fax", base=False),
)
CONTEXT_BONUS = 0.3
THRESHOLD = 0.6

_OCTET = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    digits = F.reverse(_digits(text))
    doubled = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substring(digits, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0)) % 10 == 0


def _mod97(text: Column) -> Column:
    plain = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))
    values = F.transform(
        F.sequence(F.lit(1), F.length(turned)),
        lambda i: F.conv(F.substring(turned, i, F.lit(1)), 36, 10).cast("int"),
    )
    rest = F.aggregate(
        values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def _confirmed(kind: Kind, m: Column) -> Column:
    if kind.confirm == "octets":
        return m.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    if kind.confirm == "luhn":
        return F.length(_digits(m)).between(12, 19) & _luhn(m)
    if kind.confirm == "digits":
        return F.length(_digits(m)).between(9, 15)
    if kind.confirm == "mod97":
        return _mod97(m)
    if kind.confirm == "ssn":
        return m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
    return F.lit(True)


def _located(items: Column) -> Column:
    """Items (gap before, length, ...) with their start position, summed block by block."""
    width = lambda a, x: a + x["gap"] + x["len"]
    block = lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK))
    numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    sums = F.transform(numbers, lambda b: F.aggregate(block(b), F.lit(0), width))

    def placed(b: Column, before: Column) -> Column:
        start = F.aggregate(F.slice(before, F.lit(1), b), F.lit(0), lambda a, x: a + x)
        return _let(start, lambda first: _let(block(b), lambda rows: F.transform(
            rows,
            lambda x, i: F.struct(
                (first + F.aggregate(F.slice(rows, F.lit(1), i), F.lit(0), width) + x["gap"]).alias("start"),
                x["len"].alias("len"), x["m"].alias("m"), x["context"].alias("context"),
            ),
        )))

    return _let(sums, lambda before: F.flatten(F.transform(numbers, lambda b: placed(b, before))))


def _spans(text: Column, kind: Kind, order: int) -> Column:
    """Confirmed spans of a kind: start, kind number, end, score, base."""
    pieces = F.split(text, kind.java, -1)
    found = F.regexp_extract_all(text, F.lit(kind.java), F.lit(0))
    items = F.filter(
        F.zip_with(pieces, found, lambda p, m: F.struct(
            F.length(p).alias("gap"), F.length(m).alias("len"), m.alias("m"),
            F.lower(F.right(p, F.lit(CONTEXT_CHARS))).alias("context"),
        )),
        lambda x: x["m"].isNotNull(),
    )
    score = lambda x: F.lit(kind.score) + F.when(x["context"].rlike(kind.context), CONTEXT_BONUS).otherwise(0.0)
    keep = lambda x: _confirmed(kind, x["m"]) & (F.lit(kind.base) | (score(x) >= THRESHOLD))
    spans = F.transform(
        F.filter(_located(items), keep),
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(order).alias("kind"), (x["start"] + x["len"]).alias("end"),
            F.least(score(x), F.lit(1.0)).alias("score"),
        ),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int,score:double>>")
    # The cheap tests come first: most texts have no match of most kinds.
    some = text.contains(kind.hint) if kind.hint else F.lit(True)
    return F.when(some & text.rlike(kind.java), spans).otherwise(none)


def find_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``pii``: spans (start, kind number, end, score) by start, then kind.

    Positions are code points, the end exclusive. Kind numbers index ``KINDS``. Base kinds are
    reported whenever confirmed, whatever their score.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    found = [_spans(value, kind, i) for i, kind in enumerate(KINDS)]
    return df.withColumn("pii", F.array_sort(F.concat(*found)))


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` (with ``pii``) whose text has ``<KIND>`` in place of each span.

    Of spans that overlap, the one that starts first (then the first kind) names the mask, which
    covers them all.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        mask = F.concat(F.lit("<"), F.upper(F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), s["kind"] + 1)), F.lit(">"))
        fresh = F.array(F.substring(value, acc["at"] + 1, s["start"] - acc["at"]), mask)
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], fresh)).otherwise(acc["out"]).alias("out"),
        )

    done = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(value, acc["at"] + 1, F.length(value)))
    masked = F.when(F.size("pii") > 0, F.aggregate("pii", start, step, done)).otherwise(F.col(text))
    return df.withColumn(text, masked)


def _count(kind: int) -> Column:
    return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")


def report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: counts and digest of the base spans, and all spans."""
    n_base = sum(k.base for k in KINDS)
    rows = find_pii(df.select(key, text), text)
    base = F.filter("pii", lambda s: s["kind"] < n_base)
    counts = [_count(i).alias(f"n_{KINDS[i].name}") for i in range(n_base)]
    return rows.select(
        key, *counts, F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("pii")).alias("spans"),
    )
