"""Personal data (operator 5): patterns, checksums and context words.

Regular expressions propose spans, validators confirm them (part ranges of IP
addresses, digit counts, Luhn for cards, mod-97 for IBANs), and words near a
span adjust its score. E-mail, IP, card and phone spans that their validator
confirms always stay; IBANs and social security numbers are added when their
score reaches ``MIN_SCORE``. Only DataFrame functions are used.

Places come from the text between the matches: the n-th match starts after all
earlier pieces and matches, so ``split`` and ``regexp_extract_all`` with one
pattern give every span. The patterns are written to scan in linear time and
without recursion (possessive runs, starts at run boundaries); cards and e-mails
are matched on texts of the same length in which separators that do not stand
between two digits, or dots that do not join two labels, are replaced.

Edge cases: a null text is empty and has no spans; matches that fail their
check are dropped without another try inside them; spans of different kinds may
overlap; places are code points, ends exclusive; rows that repeat are each
searched; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The span kinds in the order of their listing.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]

_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    # a match starts where a run of local characters starts or a match ended
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x20-]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without this cannot hold a card.
_CARD_LIKE = r"[0-9][0-9\x20-]{12,}[0-9]"
_LOOSE_SEPARATOR = r"[\x20-](?![0-9])|(?<![0-9])[\x20-]"
_LOOSE_DOT = r"\.(?![A-Za-z0-9-])|(?<![A-Za-z0-9-])\."
_IP_PART = r"0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
_IP = rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$"

#: Score of a confirmed span, and what a context word adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT_GAIN = 0.2
CONTEXT_GAINS = {"ssn": 0.5}
CONTEXT_CHARS = 40
MIN_SCORE = 0.5
CONTEXT = {
    "email": "e-?mail|mail|contact|correo|courriel|kontakt",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|telefon|fon|appel",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social security",
}
#: Matches whose places are summed at a time (keeps long lists from being copied per match).
BLOCK = 256


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    places = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)),
                         lambda d, i: F.when(i % 2 == 0, d.cast("int"))
                         .when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2))
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether a compact IBAN leaves remainder 1."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    return F.aggregate(
        F.regexp_extract_all(turned, F.lit("[A-Z0-9]"), F.lit(0)), F.lit(0),
        lambda r, c: F.when(c.rlike("[0-9]"), (r * 10 + c.cast("int")) % 97)
        .otherwise((r * 100 + F.ascii(c) - 55) % 97)) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(_IP)
    if kind == "card":
        n = F.length(_digits(match))
        return (n >= 14) & (n <= 19) & luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        compact = F.regexp_replace(match, r"\x20", "")
        return F.length(compact).between(15, 34) & mod97(compact)
    return F.lit(True)


_PAIRS = "array<struct<gap:int,match:string>>"
_PLACES = "array<struct<start:int,end:int,match:string>>"


def _pairs(matches: Column, text: Column, pattern: str) -> Column:
    """(code points before it, match) for each match."""
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    return F.when(F.size(matches) > 0, F.zip_with(gaps, matches, lambda g, m: F.struct(
        F.length(g).alias("gap"), m.alias("match")))).otherwise(F.array().cast(_PAIRS))


def _places(pairs: Column) -> Column:
    """Start, end and text of each match."""
    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["match"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["match"].alias("match")))).alias("out"))

    def block(acc, b):
        part = F.aggregate(F.slice(pairs, b * BLOCK + 1, F.lit(BLOCK)),
                           F.struct(acc["at"].alias("at"), F.array().cast(_PLACES).alias("out")), step)
        return F.struct(part["at"].alias("at"), F.concat(acc["out"], part["out"]).alias("out"))

    blocks = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int"))
    found = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast(_PLACES).alias("out")), block)["out"]
    return F.when(F.size(pairs) > 0, found).otherwise(F.array().cast(_PLACES))


def _scored(kind: str, places: Column, text: Column) -> Column:
    near = rf"(?i)(?<![a-z])(?:{CONTEXT[kind]})(?![a-z])"
    gain = CONTEXT_GAINS.get(kind, CONTEXT_GAIN)

    def span(x):
        before = F.substr(text, F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0)) + 1,
                          F.least(x["start"], F.lit(CONTEXT_CHARS)))
        after = F.substr(text, x["end"] + 1, F.lit(CONTEXT_CHARS))
        score = F.when(F.concat(before, F.lit(" "), after).rlike(near), F.lit(SCORES[kind] + gain)) \
            .otherwise(F.lit(SCORES[kind]))
        return F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"),
                        F.lit(kind).alias("kind"), F.least(score, F.lit(1.0)).alias("score"),
                        F.substr(text, x["start"] + 1, x["end"] - x["start"]).alias("text"))

    return F.transform(F.filter(places, lambda x: _confirmed(kind, x["match"])), span)


def find_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and its spans, ordered by start and kind, as
    structs (start, rank of the kind, end, kind, score, text)."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # An intermediate column that is used twice stays a projection of its own,
    # so no pattern is searched again per match.
    df = df.select(
        "*", F.when(F.col("text").rlike(_CARD_LIKE), F.regexp_replace("text", _LOOSE_SEPARATOR, "x"))
        .otherwise(F.lit("")).alias("t_card"),
        F.when(F.col("text").contains("@"), F.regexp_replace("text", _LOOSE_DOT, "_"))
        .otherwise(F.lit("")).alias("t_email"))
    source = {k: F.col("t_" + k) if k in ("card", "email") else F.col("text") for k in KINDS}
    df = df.select("*", *[F.regexp_extract_all(source[k], F.lit(PATTERNS[k]), F.lit(0)).alias("m_" + k) for k in KINDS])
    df = df.select("doc_id", "text", *[_pairs(F.col("m_" + k), source[k], PATTERNS[k]).alias("p_" + k) for k in KINDS])
    df = df.select("doc_id", "text", *[_places(F.col("p_" + k)).alias("s_" + k) for k in KINDS])
    df = df.select("doc_id", *[_scored(k, F.col("s_" + k), F.col("text")).alias("k_" + k) for k in KINDS])
    added = F.filter(F.concat("k_iban", "k_ssn"), lambda s: s["score"] >= MIN_SCORE)
    return df.select("doc_id", F.array_sort(F.concat(*[F.col("k_" + k) for k in BASE_KINDS], added)).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(found: DataFrame) -> DataFrame:
    """Counts and digests per document from ``find_spans``."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS))
    of = lambda i: F.size(F.filter("spans", lambda s: s["rank"] == i)).cast("long")
    return found.select("doc_id", *[of(i).alias("n_" + k) for i, k in enumerate(BASE_KINDS)],
                        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
