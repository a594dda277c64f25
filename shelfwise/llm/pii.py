"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

Everything is a column expression over one document; nothing is shuffled.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import aside, whole_text

#: Characters of context on each side of a candidate.
CONTEXT = 40
#: Candidates of the added kinds are kept from this score on; those of the base kinds always.
KEEP = 0.6
#: Positions are summed in blocks of so many, so a text with many candidates costs no square of them.
BLOCK = 256

_LOCAL = "A-Za-z0-9._%+-"


@dataclass(frozen=True)
class Kind:
    """One kind of personal data: a cheap test, the pattern, words that support it, scores without and with them."""

    name: str
    hint: str
    pattern: str
    context: str
    score: float
    base: bool


#: In the order that breaks ties of equal starts. The patterns find what the plain ones of the contract find,
#: but start only where a run of their characters starts (or the last find ended), so that long runs cost no
#: square, and repeat possessively, so that they need no stack. Card keeps only runs of 12 to 19 digits.
KINDS = (
    Kind("email", "@", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "mail|contact|write|send", 0.7, True),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "ip|server|host|addr|login", 0.5, True),
    Kind("card", r"[0-9](?:[ -]?[0-9]){11}", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])", "card|visa|credit|debit|payment", 0.7, True),
    Kind("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", "phone|call|tel|mobile|fax", 0.6, True),
    Kind("iban", r"[A-Z]{2}[0-9]{2}[ A-Z0-9]", r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9_])", "iban|account|bank|transfer", 0.7, False),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])", "ssn|social|security", 0.4, False),
)
BOOST = 0.3


def running_start(sizes: Column) -> Column:
    """For each element of an array the sum of those before it, block by block."""

    def sums(values: Column) -> Column:
        empty = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<bigint>").alias("before"))
        return F.aggregate(values, empty, lambda acc, x: F.struct((acc["total"] + x).alias("total"), F.concat(acc["before"], F.array(acc["total"])).alias("before")))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda b: sums(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))))
    offsets = sums(F.transform(blocks, lambda b: b["total"]))["before"]
    return F.when(F.size(sizes) == 0, F.array().cast("array<bigint>")).otherwise(
        F.flatten(F.zip_with(blocks, offsets, lambda b, offset: F.transform(b["before"], lambda x: x + offset)))
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def mod97(value: Column) -> Column:
    """The remainder of an IBAN by 97 with its first four characters last and letters as 10 to 35."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(step(rest, c)))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")
    if kind == "card":
        return F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return mod97(value) == 1
    if kind == "ssn":
        return value.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
    return F.lit(True)


def _candidates(docs: DataFrame, kind: Kind) -> DataFrame:
    """Adds the column of one kind: its validated spans with start, end, score and place in the list of kinds."""
    place = [k.name for k in KINDS].index(kind.name)
    text, parts, finds = F.col("__text"), F.col("__parts"), F.col("__finds")
    hinted = F.contains(text, F.lit("@")) if kind.hint == "@" else text.rlike(kind.hint)
    none = F.array().cast("array<string>")
    # the pieces between finds and the finds themselves give the positions
    docs = docs.withColumn("__finds", F.when(hinted, F.regexp_extract_all(text, F.lit(f"({kind.pattern})"), F.lit(1))).otherwise(none))
    docs = docs.withColumn("__parts", F.when(F.size("__finds") > 0, F.split(text, kind.pattern, -1)).otherwise(none))
    gaps = F.transform(finds, lambda v, i: F.char_length(F.get(parts, i)) + F.char_length(v))
    docs = docs.withColumn("__before", running_start(gaps))
    spans = F.transform(
        finds,
        lambda v, i: F.struct(
            (F.get("__before", i) + F.char_length(F.get(parts, i))).cast("int").alias("start"),
            (F.get("__before", i) + F.char_length(F.get(parts, i)) + F.char_length(v)).cast("int").alias("end"),
            F.lit(place).alias("kind"),
            v.alias("value"),
            F.lower(F.concat(F.right(F.get(parts, i), F.lit(CONTEXT)), F.lit(" "), F.left(F.get(parts, i + 1), F.lit(CONTEXT)))).alias("near"),
        ),
    )
    scored = F.transform(
        F.filter(spans, lambda s: _valid(kind.name, s["value"])),
        lambda s: F.struct(s["start"], s["end"], s["kind"], (F.lit(kind.score) + F.when(s["near"].rlike(kind.context), BOOST).otherwise(0.0)).alias("score")),
    )
    if not kind.base:
        scored = F.filter(scored, lambda s: s["score"] >= KEEP)
    # a text without the kind skips the rest
    made = F.when(F.size("__finds") > 0, scored).otherwise(F.array().cast("array<struct<start:int,end:int,kind:int,score:double>>"))
    return docs.withColumn(f"__{kind.name}", made).drop("__finds", "__parts", "__before")


def find_pii(docs: DataFrame) -> DataFrame:
    """All rows and columns of `docs` with `pii`: array of (start, end, kind, score, base), by start, then kind.

    Positions are code points, end exclusive. Kinds: email, ip, card (Luhn), phone, and two that only score and
    checksum let through: iban (mod 97) and ssn (with supporting words nearby). A null text counts as empty and
    has no spans; repeated rows have the same; rows are never moved, so neither ids nor hot values matter. A
    column `pii` of `docs` is replaced.
    """
    docs, back = aside(docs)
    found = docs.withColumn("__text", whole_text())
    for kind in KINDS:
        found = _candidates(found, kind)
    every = F.array_sort(F.concat(*(F.transform(f"__{k.name}", lambda s: F.struct(s["start"], s["kind"], s["end"], s["score"])) for k in KINDS)))
    names, base = F.array(*(F.lit(k.name) for k in KINDS)), F.array(*(F.lit(k.base) for k in KINDS))
    pii = F.transform(every, lambda s: F.struct(s["start"], s["end"], F.get(names, s["kind"]).alias("kind"), s["score"], F.get(base, s["kind"]).alias("base")))
    return back(found.withColumn("pii", pii).drop("__text", *(f"__{k.name}" for k in KINDS)))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """Per document the counts of the base kinds, a hash of their spans, and all spans as text."""
    found = find_pii(docs.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(k.name) for k in KINDS if k.base),
        F.sha2(listed(F.filter("pii", lambda s: s["base"])), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"),
        F.coalesce(F.round(F.array_max(F.transform("pii", lambda s: s["score"])), 2), F.lit(0.0)).alias("top_score"),
    )
