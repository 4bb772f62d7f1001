"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby move their score.

Positions come from the text around the matches: ``split`` returns the gaps between the matches that
``regexp_extract_all`` returns, and the lengths of both, summed up, are the places.  A kind's pattern runs only on texts
with a sign of it (an ``@``, a ``+``, enough digits).  Words nearby count whole, in four languages.  Patterns are possessive and start at the start of a run, so they
take linear time on long runs and do not recurse.

Kinds: the base kinds email, ip, card and phone are kept whenever their check holds.  The kinds iban (mod-97) and ssn (nine
digits in the usual grouping) are kept from a score of 50 on; an ssn needs a word nearby for that.

Defined cases: a null text is empty and has no spans; ids are passed through, repeated or null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tarmac.llm.batches import small_batches
from tarmac.llm.names import numbered

LEAST_SCORE = 50
NEARBY = 40  # code points before a span in which a word counts
WORD_BONUS = 30
_BLOCK = 256  # matches whose spans are gathered before they join the others


@dataclass(frozen=True)
class Kind:
    name: str
    sign: str  # a text without this pattern has no span of the kind
    pattern: str
    check: str  # SQL over the matched text m
    score: int
    words: str  # any of these shortly before the span adds WORD_BONUS
    base: bool = True


def _digits(name: str) -> str:
    return f"regexp_replace({name}, '[^0-9]', '')"


_DIGIT = "CAST(substr(d, -i, 1) AS INT)"
_LUHN = (
    f"aggregate(sequence(1, length(d)), 0, (a, i) -> a + {_DIGIT} * (2 - i % 2) - IF(i % 2 = 0 AND {_DIGIT} > 4, 9, 0)) % 10 = 0"
)
# letters count 10 to 35; each character appends its decimal digits to the number
_MOD97 = (
    "aggregate(transform(split(d, ''), c -> IF(c BETWEEN '0' AND '9', ascii(c) - 48, ascii(c) - 55)), 0, "
    "(a, v) -> (a * IF(v > 9, 100, 10) + v) % 97) = 1"
)

KINDS = (
    Kind(
        "email",
        "@",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "true",
        60,
        "e-?mail|mail|contact|write|reach|kontakt|schreiben|courriel|contacter|correo|escribir",
    ),
    Kind(
        "ip",
        r"[0-9]\.[0-9]",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "forall(split(m, '[.]'), p -> length(ltrim('0', p)) <= 3 AND CAST(right(p, 3) AS INT) <= 255)",
        50,
        "ip|host|server|address|login|adresse|rechner|serveur|servidor|direccion",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9]){15}",
        r"[0-9](?:[\x20-]?[0-9])++",
        "length(m) >= 16 AND exists(filter(array(" + _digits("m") + "), d -> length(d) BETWEEN 16 AND 19), d -> " + _LUHN + ")",
        70,
        "card|visa|payment|credit|pay|karte|kreditkarte|zahlung|carte|paiement|tarjeta|pago",
    ),
    Kind(
        "phone",
        r"\+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "length(" + _digits("m") + ") BETWEEN 8 AND 15",
        50,
        "phone|call|tel|mobile|fax|telefon|anruf|telephone|appeler|telefono|llamar|movil",
    ),
    Kind(
        "iban",
        "[A-Z]{2}[0-9]{2}[A-Z0-9]{11}",
        "[A-Za-z0-9]{15,}+",
        "m RLIKE '^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$' AND exists(array(concat(substr(m, 5), left(m, 4))), d -> " + _MOD97 + ")",
        60,
        "iban|account|bank|transfer|konto|compte|banque|virement|cuenta|banco|transferencia",
        base=False,
    ),
    Kind(
        "ssn",
        "[0-9]{3}-[0-9]{2}-[0-9]{4}",
        "[0-9][0-9-]*+",
        "m RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$'",
        30,
        "ssn|social security|tax id|steuernummer|securite sociale|seguridad social",
        base=False,
    ),
)


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _nearby(words: str) -> str:
    """Any of the words, whole, in either case."""
    return f"(?i)(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"


def spans_of(kind: Kind, text: str) -> Column:
    """Array of (kind, start, end, score) of the confirmed spans of one kind, in order of start."""
    pattern = _quoted(kind.pattern)
    check = kind.check.replace("\\", "\\\\")
    # the words are sought in the text shortly before the span, which the state carries along as ``tail``
    score = f"IF(right(concat(s.tail, z.gap), {NEARBY}) RLIKE {_quoted(_nearby(kind.words))}, least(100, {kind.score + WORD_BONUS}), {kind.score})"
    span = (
        f"named_struct('kind', '{kind.name}', 'start', s.at + length(z.gap), "
        f"'end', s.at + length(z.gap) + length(z.hit), 'score', {score})"
    )
    empty = "CAST(array() AS array<struct<kind:string,start:int,end:int,score:int>>)"
    # matches go in blocks, so that a list of spans is not copied whole for each of them
    found = f"""
        aggregate(
          array(zip_with(split({text}, {pattern}, -1), regexp_extract_all({text}, {pattern}, 0),
                         (g, h) -> named_struct('gap', g, 'hit', h))),
          {empty},
          (x, matches) -> aggregate(
            sequence(0, size(matches) - 1, {_BLOCK}),
            named_struct('at', 0, 'tail', '', 'spans', {empty}),
            (b, low) -> aggregate(
              slice(matches, low + 1, {_BLOCK}),
              named_struct('at', b.at, 'tail', b.tail, 'spans', {empty}),
              (s, z) -> named_struct(
                'at', s.at + length(z.gap) + coalesce(length(z.hit), 0),
                'tail', right(concat(s.tail, right(z.gap, {NEARBY}), coalesce(right(z.hit, {NEARBY}), '')), {NEARBY}),
                'spans', IF(exists(array(z.hit), m -> m IS NOT NULL AND ({check})), concat(s.spans, array({span})), s.spans)),
              s -> named_struct('at', s.at, 'tail', s.tail, 'spans', concat(b.spans, s.spans))),
            b -> b.spans))"""
    spans = F.when(F.col(text).rlike(kind.sign), F.expr(found)).otherwise(F.expr(empty))
    if kind.base:
        return spans
    return F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: all spans, kinds in the order of ``KINDS``, each by start.  Offsets are code points.

    A column ``spans`` of ``docs`` is replaced.
    """
    plain, names = numbered(docs.drop("spans"))
    filled = plain.withColumn("body", F.coalesce(F.col(names[text]), F.lit("")))
    found = filled.withColumn("spans", F.concat(*[spans_of(kind, "body") for kind in KINDS])).drop("body")
    return found.toDF(*names, "spans")


def joined(spans: Column, *parts: str) -> Column:
    """``kind:start:end`` (or the given parts) of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", *[s[p].cast("string") for p in parts])), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in brackets; of overlapping spans the first counts.

    Texts without a span keep their very content, null included.
    """
    small_batches(docs.sparkSession)
    plain, names = numbered(docs)
    found, text = find_spans(plain, names[text]), names[text]
    # spans go in blocks: each cuts its section out of the text once, and its parts out of the section
    section = f"substr({text}, a.at + 1, greatest(0, element_at(slice(ordered, low + 1, {_BLOCK}), -1).end - a.at))"
    body = F.expr(
        f"""
        aggregate(
          array(array_sort(spans, (l, r) -> CASE WHEN l.start < r.start THEN -1 WHEN l.start > r.start THEN 1
                                                 WHEN l.end > r.end THEN -1 WHEN l.end < r.end THEN 1 ELSE 0 END)),
          '',
          (x, ordered) -> aggregate(
            sequence(0, size(ordered) - 1, {_BLOCK}),
            named_struct('at', 0, 'parts', CAST(array() AS array<string>)),
            (a, low) -> aggregate(
              array({section}),
              a,
              (o, cut) -> aggregate(
                slice(ordered, low + 1, {_BLOCK}),
                named_struct('at', a.at, 'parts', CAST(array() AS array<string>)),
                (p, s) -> IF(s.start < p.at, p, named_struct(
                  'at', s.end,
                  'parts', concat(p.parts, array(substr(cut, p.at - a.at + 1, s.start - p.at), concat('[', upper(s.kind), ']'))))),
                p -> named_struct('at', p.at, 'parts', concat(a.parts, array(array_join(p.parts, '')))))),
            a -> concat(array_join(a.parts, ''), substr({text}, a.at + 1))))"""
    )
    return found.withColumn(text, F.when(F.size("spans") > 0, body).otherwise(F.col(text))).drop("spans").toDF(*docs.columns)
